"""Document fingerprints: SimHash with block tables and flipped bits.

Terms are runs of ``WIDTH`` words; each distinct term of a text votes with its
weight (1 + ln of its count) for or against each of 128 bits, by the bits of
its hash.  The sign of the vote is the bit.

``search`` finds all fingerprints within a Hamming radius r: the bits are cut
into four blocks of 32, of which at least one differs in r // 4 bits or less.
So every block of a query, with each choice of so many bits flipped, is looked
up in a table of that block (one equi-join for all tables) and the distance is
verified.  Only distinct fingerprints enter the tables, once per block.

``with_next`` needs the next document in descending order of id.  Rows are
ordered by a range shuffle, each task streams its rows, and only the first and
last row of each task are completed in a second step over these edges.

Edge cases: null text is an empty text.  A text without words has the
fingerprint of no votes (all zero); texts of one to ``WIDTH - 1`` words have
one term of all their words.  Null ids come last, equal ids by text; repeated
rows follow each other, so each is the next one of the other.  A table of one
row is its own next.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import blocks, mix64, shingle_hashes, written

BITS, WIDTH, RADIUS = 128, 2, 11
BLOCK_BITS = 32
EMPTY = "0" * (BITS // 4)


def fingerprints(texts: list[str], width: int = WIDTH) -> list[str]:
    """Fingerprint of each text as 32 hex digits."""
    out = [EMPTY] * len(texts)
    for a, b in blocks(texts, 1 << 17):
        hashes, doc = shingle_hashes(texts[a:b], width)
        if len(hashes) == 0:
            continue
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        first = np.ones(len(hashes), bool)
        first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(first)
        count = np.diff(np.append(at, len(hashes)))
        hashes, doc = hashes[at], doc[at]
        weight = (1 + np.log(count)).astype(np.float32)
        words = np.stack([hashes, mix64(hashes + np.uint64(BITS))], axis=1)
        bits = np.unpackbits(words.astype(">u8").view(np.uint8), axis=1)
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        votes = np.add.reduceat(bits * weight[:, None], starts, axis=0)
        total = np.add.reduceat(weight, starts)
        signs = np.packbits(2 * votes > total[:, None], axis=1)
        for row, owner in zip(signs, doc[starts]):
            out[a + owner] = row.tobytes().hex()
    return out


def likeness(a: str, b: str) -> float:
    return 1.0 - (int(a, 16) ^ int(b, 16)).bit_count() / BITS


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of ``following``."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every row."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Long texts need a third of the next one at most; the order needs them whole once.
    ordered = (rows.repartitionByRange(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"))
    done = (f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double")
    names = [c.split()[0] for c in done.split(", ")]
    integer = id_type in ("bigint", "int")

    def frame(columns: dict, n: int) -> pd.DataFrame:
        out = pd.DataFrame({c: pd.Series(columns.get(c, [None] * n), dtype=object)
                            for c in [*names, "edge", "task", "text"]})
        if integer:
            out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    def result(ids, texts, prints, next_texts, next_prints):
        after = [edited(t, n) for t, n in zip(texts, next_texts)]
        after_prints = fingerprints(after, width)
        return frame({
            "doc_id": ids, "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in after],
            "fingerprint": prints, "edited_fingerprint": after_prints,
            "near_edited": [likeness(x, y) for x, y in zip(prints, after_prints)],
            "near_next": [likeness(x, y) for x, y in zip(prints, next_prints)]}, len(texts))

    def plain(ids):
        return [None if pd.isna(x) else x for x in ids.array]

    def stream(batches):
        task = TaskContext.get().partitionId()
        last = None

        def edge(kind, one, body, mark):
            return frame({"doc_id": [one], "fingerprint": [mark], "edge": [kind], "task": [task], "text": [body]}, 1)

        for pdf in batches:
            ids, texts = plain(pdf["doc_id"]), pdf["text"].tolist()
            if not texts:
                continue
            prints = fingerprints(texts, width)
            if last is None:
                yield edge("first", ids[0], texts[0], prints[0])
            else:
                ids, texts, prints = [last[0], *ids], [last[1], *texts], [last[2], *prints]
            for a, b in blocks(texts[:-1], 1 << 22):
                yield result(ids[a:b], texts[a:b], prints[a:b], texts[a + 1:b + 1], prints[a + 1:b + 1])
            last = ids[-1], texts[-1], prints[-1]
        if last is not None:
            yield edge("last", *last)

    table = written(ordered.mapInPandas(stream, done + ", edge string, task int, text string"), "simhash-stream")
    # Two rows per task: the last row of a task is followed by the first of the next one.
    edges = table.where("edge is not null").select("doc_id", "edge", "task", "text", "fingerprint")
    heads = edges.where("edge = 'first'").select("task", F.col("text").alias("next_text"),
                                                 F.col("fingerprint").alias("next_print"))
    by_task = Window.orderBy("task")
    following = (heads.select("task").withColumn("next_task", F.lead("task").over(by_task))
                 .withColumn("next_task", F.coalesce("next_task", F.min("task").over(Window.partitionBy()))))
    open_rows = (edges.where("edge = 'last'").join(following, "task")
                 .join(heads.withColumnRenamed("task", "next_task"), "next_task")
                 .select("doc_id", "text", "fingerprint", "next_text", "next_print"))

    def close(batches):
        for pdf in batches:
            if len(pdf):
                yield result(plain(pdf["doc_id"]), pdf["text"].tolist(), pdf["fingerprint"].tolist(),
                             pdf["next_text"].tolist(), pdf["next_print"].tolist())[names]

    closed = open_rows.mapInPandas(close, done)
    return table.where("edge is null").select(*names).unionByName(closed)


def search(queries: DataFrame, prints: DataFrame, *, radius: int = RADIUS) -> DataFrame:
    """(query_print, print, distance): every distinct fingerprint of ``prints``
    within ``radius`` of each distinct one of ``queries`` (columns
    ``fingerprint``, hex), itself included."""
    n_blocks = BITS // BLOCK_BITS
    near = radius // n_blocks
    if near > 3:
        raise ValueError("radius too large for flips of a block")
    flips = [sum(1 << i for i in c) for n in range(near + 1) for c in combinations(range(BLOCK_BITS), n)]
    digits = BLOCK_BITS // 4

    def tables(df, name):
        cuts = F.array(*[F.conv(F.substring(name, digits * i + 1, digits), 16, 10).cast("long") for i in range(n_blocks)])
        return (df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
                .select(name, F.posexplode(cuts).alias("block", "value")))

    def half(name, i):
        return F.conv(F.substring(name, 16 * i + 1, 16), 16, -10).cast("long")

    distance = sum((F.bit_count(half("query_print", i).bitwiseXOR(half("print", i))) for i in range(BITS // 64)), F.lit(0))
    probes = (tables(queries, "query_print").withColumn("flip", F.explode(F.array(*map(F.lit, flips)).cast("array<bigint>")))
              .select("query_print", "block", F.col("value").bitwiseXOR(F.col("flip")).alias("value")))
    # Spark takes the probes for small (it does not count the flips) and would broadcast them.
    pairs = probes.join(tables(prints, "print").hint("merge"), ["block", "value"])
    return (pairs.withColumn("distance", distance).where(F.col("distance") <= radius)
            .select("query_print", "print", "distance").distinct())
