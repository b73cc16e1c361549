"""MinHash near-duplicates by improved consistent weighted sampling.

1. Equal texts collapse to one node (their SHA-256 digest).
2. Shingles of five words are weighted by tf * idf, where idf falls from 2 to
   1 with the share of the texts that hold the shingle.  Shares of 0.01 or more
   are counted exactly, in two passes: cells of hashes that may hold such a
   shingle, then the shingles of these cells.  All rarer shingles weigh 2.
3. Improved consistent weighted sampling draws ``bands * rows`` samples of a
   text; two texts agree on a sample with a probability equal to their
   weighted Jaccard similarity.  ``rows`` samples form a band key.
4. In each bucket every member is first paired with one centre.  Pairs are
   verified by exact weighted Jaccard similarity; links form components.
5. In buckets that still hold several components, all members are compared
   with all members of other components, in hashed pairs of blocks.  A bound
   of the overlap excludes pairs; the others are verified as before, unless
   verified links have already joined their components.

The consistent random variates (r, c, beta) of a shingle and a sample come
from a table of 65,536 draws, addressed by a hash of both, so that all tasks
draw the same ones.

Edge cases: null text is an empty text.  Texts without a word are compared by
equality alone; texts of one to four words have one shingle.  Rows with a
null id are not grouped (class null).  Repeated rows share their class.
An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import blocks, mix64, shingle_hashes, written
from obslake.llm.components import components

WIDTH = 5            # words of a shingle
THRESHOLD = 0.8
BANDS, ROWS = 10, 3  # a pair at 0.8 is missed by all bands with p = 0.0008
HEAVY = 0.01         # share of the texts from which a shingle's frequency counts
RARE = 2.0           # weight of the shingles below that share
CELL_BITS = 18       # leading bits of the hashes by which heavy shingles are looked for
HELD = 1 << 21       # shingles that a task counts before it hands them on
DRAWS = 1 << 16
BLOCK = 256          # members of a bucket that are compared at a time with as many others
COLUMNS = 4096       # shingles of one step of a block's overlap matrix
_SEED = 0x5EED


def digest(text: str) -> Column:
    """128 bits of the SHA-256 of a text (null: empty)."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), 1, 32))


def unique_shingles(texts: list[str], width: int):
    """Sorted distinct (text, shingle) pairs: (shingle, text index, count)."""
    hashes, doc = shingle_hashes(texts, width)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return hashes[at], doc[at], np.diff(np.append(at, len(hashes)))


class Idf(NamedTuple):
    """Weights of shingles: ``value`` for those listed in ``heavy`` (sorted
    hashes), ``RARE`` for all others.  ``cells`` marks the leading bits that a
    listed shingle may have."""

    cells: np.ndarray
    heavy: np.ndarray
    value: np.ndarray


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def cell_frequencies(nodes: DataFrame, width: int = WIDTH) -> DataFrame:
    """(cell, df): how many (text, shingle) pairs fall in a cell of hashes, an
    upper bound of the document frequency of each of its shingles.  Each task
    adds up its own table of ``2 ** CELL_BITS`` counts."""

    def count(batches):
        total = np.zeros(1 << CELL_BITS, dtype=np.int64)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in blocks(texts):
                hashes, _, _ = unique_shingles(texts[a:b], width)
                total += np.bincount(_cell(hashes), minlength=1 << CELL_BITS)
        hit = np.flatnonzero(total)
        for i in range(0, len(hit), 1 << 16):
            part = hit[i:i + (1 << 16)]
            yield pd.DataFrame({"cell": part, "df": total[part]})

    return (nodes.select("text").mapInPandas(count, "cell int, df long")
            .groupBy("cell").agg(F.sum("df").alias("df")))


def shingle_frequencies(nodes: DataFrame, cells: np.ndarray, width: int = WIDTH) -> DataFrame:
    """(shingle, df): exact document frequencies of the shingles whose cell is
    marked.  Each task adds up its shingles before the shuffle, a bounded
    number at a time."""

    def merged(parts):
        hashes, at = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
        return hashes, np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)

    def frame(hashes, counts):
        return pd.DataFrame({"shingle": hashes.view(np.int64), "df": counts})

    def count(batches):
        parts, size = [], 0
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in blocks(texts):
                hashes, _, _ = unique_shingles(texts[a:b], width)
                hashes = hashes[cells[_cell(hashes)]]
                parts.append((hashes, np.ones(len(hashes))))
                size += len(hashes)
                if size > HELD:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > HELD // 2:
                        yield frame(*parts[0])
                        parts, size = [], 0
        if parts:
            yield frame(*merged(parts))

    return (nodes.select("text").mapInPandas(count, "shingle long, df long")
            .groupBy("shingle").agg(F.sum("df").alias("df")))


def idf_of(nodes: DataFrame, n_texts: int, width: int = WIDTH) -> Idf:
    """The weights of the shingles of ``n_texts`` texts.

    A shingle in a share p of all texts weighs 1 + ln(p) / ln(HEAVY) where p
    is HEAVY or more (1 if all texts have it), and RARE otherwise: shares
    alone decide, so a pair keeps its similarity when the corpus grows.  A
    text of m distinct shingles on average has at most m / HEAVY such
    shingles in all, whatever the corpus, so the driver may hold them."""
    least = HEAVY * n_texts
    found = cell_frequencies(nodes, width).where(F.col("df") >= least).select("cell").toPandas()
    cells = np.zeros(1 << CELL_BITS, bool)
    cells[found["cell"].to_numpy(np.int64)] = True
    if not cells.any():
        return Idf(cells, np.zeros(0, np.uint64), np.zeros(0, np.float32))
    rows = shingle_frequencies(nodes, cells, width).where(F.col("df") >= least).toPandas()
    heavy = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(heavy)
    heavy, share = heavy[order], rows["df"].to_numpy(float)[order] / max(n_texts, 1)
    cells[:] = False
    cells[_cell(heavy)] = True
    return Idf(cells, heavy, (1.0 + np.log(share) / np.log(HEAVY)).astype(np.float32))


def weights(hashes: np.ndarray, counts: np.ndarray, idf: Idf) -> np.ndarray:
    each = np.full(len(hashes), RARE, np.float32)
    maybe = np.flatnonzero(idf.cells[_cell(hashes)])
    if len(maybe):
        at = np.minimum(np.searchsorted(idf.heavy, hashes[maybe]), len(idf.heavy) - 1)
        same = idf.heavy[at] == hashes[maybe]
        each[maybe[same]] = idf.value[at[same]]
    return counts * each


def _draws():
    rng = np.random.default_rng(_SEED)
    r, c = rng.gamma(2.0, 1.0, DRAWS), rng.gamma(2.0, 1.0, DRAWS)
    f32 = np.float32
    return r.astype(f32), (1 / r).astype(f32), np.log(c).astype(f32), rng.random(DRAWS).astype(f32)


def band_keys(texts: list[str], idf: Idf, bands: int, rows: int, width: int,
              draws) -> np.ndarray:
    """One 64-bit key per text and band; 0 for texts without a shingle."""
    r, inverse_r, log_c, beta = draws
    out = np.zeros((len(texts), bands), dtype=np.uint64)
    hashes, doc, counts = unique_shingles(texts, width)
    if len(hashes) == 0:
        return out
    log_w = np.log(weights(hashes, counts, idf)).astype(np.float32)
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    owner = doc[starts]
    size = np.diff(np.append(starts, len(doc)))
    for k in range(bands * rows):
        odd = int(mix64(np.array([2 * k + 1], np.uint64))[0]) | 1
        at = ((hashes * np.uint64(odd)) >> np.uint64(48)).astype(np.int32)
        own_beta = beta[at]
        t = np.floor(log_w * inverse_r[at] + own_beta)
        log_a = log_c[at] - r[at] * (t - own_beta + 1)
        best = np.minimum.reduceat(log_a, starts)
        hit = np.flatnonzero(log_a == np.repeat(best, size))
        group = np.searchsorted(starts, hit, side="right") - 1
        arg = np.empty(len(starts), dtype=np.int64)
        arg[group[::-1]] = hit[::-1]             # ties: the smallest shingle hash
        sample = mix64(hashes[arg] ^ mix64(t[arg].astype(np.int64).view(np.uint64) + np.uint64(k)))
        key = out[owner, k // rows]
        out[owner, k // rows] = mix64(key * np.uint64(31) + sample + np.uint64(1))
    return out


def signatures(nodes: DataFrame, idf: Idf, bands: int, rows: int, width: int) -> DataFrame:
    """(node, bands) of the nodes that have a shingle."""

    def sign(batches):
        draws = _draws()
        for pdf in batches:
            texts, keys = pdf["text"].tolist(), []
            for a, b in blocks(texts):
                keys.append(band_keys(texts[a:b], idf, bands, rows, width, draws))
            if keys:
                found = np.concatenate(keys)
                keep = np.flatnonzero(found.any(axis=1))
                yield pd.DataFrame({"node": pdf["node"].to_numpy()[keep],
                                    "bands": list(found[keep].view(np.int64))})

    return nodes.mapInPandas(sign, "node binary, bands array<long>")


def weighted_jaccard(a: list[str], b: list[str], idf: Idf, width: int) -> np.ndarray:
    """Sum of minima over sum of maxima of the shingle weights of each pair."""
    sums = []
    both: list[str] = []
    for x, y in zip(a, b):
        both += [x, y]
    hashes, doc, counts = unique_shingles(both, width)
    w = weights(hashes, counts, idf)
    pair = doc // 2
    order = np.lexsort((doc, hashes, pair))
    hashes, pair, w = hashes[order], pair[order], w[order]
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (pair[1:] == pair[:-1]))
    least = np.bincount(pair[same], np.minimum(w[same], w[same + 1]), minlength=len(a))
    total = np.bincount(pair, w, minlength=len(a))
    sums = total - least
    return np.divide(least, sums, out=np.zeros(len(a)), where=sums > 0)


def verified(pairs: DataFrame, texts: DataFrame, idf: Idf, threshold: float,
             width: int) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def check(batches):
        for pdf in batches:
            x, y = pdf["text_a"].tolist(), pdf["text_b"].tolist()
            good = np.zeros(len(x), bool)
            for i, j in blocks([s + t for s, t in zip(x, y)]):
                good[i:j] = weighted_jaccard(x[i:j], y[i:j], idf, width) >= threshold
            yield pdf.loc[good, ["a", "b"]]

    return (pairs.join(left, "a").join(right, "b")
            .mapInPandas(check, "a binary, b binary"))


def links(nodes: DataFrame, *, threshold: float = THRESHOLD, width: int = WIDTH,
          bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, root) of the nodes that belong to a component of similar texts.

    ``nodes``: (node, text), one row per distinct text, read more than once.
    """
    n = nodes.count()
    idf = idf_of(nodes, n, width)
    signed = written(signatures(nodes, idf, bands, rows, width), "neardup-signatures")
    keyed = signed.select("node", F.posexplode("bands").alias("band", "hash")).select(
        "node", F.xxhash64("band", "hash").alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = written(keyed.join(crowded, "key"), "neardup-members")
    involved = members.select("node").distinct()
    texts = written(nodes.join(involved, "node", "left_semi"), "neardup-texts")

    centres = members.groupBy("key").agg(F.min("node").alias("b"))
    pairs = (members.join(centres, "key").where("node <> b")
             .select(F.col("b").alias("a"), F.col("node").alias("b")).distinct())
    rooted = members.select("node").distinct().select("node", F.col("node").alias("root"))
    rooted = _merged(rooted, verified(written(pairs, "neardup-pairs"), texts, idf, threshold, width))
    rest = written(_open_members(members, rooted), "neardup-open")
    if rest.isEmpty():
        return rooted
    return _merged(rooted, _links_between(_block_pairs(rest), texts, idf, threshold, width))


def _merged(rooted: DataFrame, found: DataFrame) -> DataFrame:
    """``rooted`` with the components that the links ``found`` join made one."""
    found = written(found, "neardup-links")
    if found.isEmpty():
        return rooted
    merged = components(_between_roots(found, rooted)).select(
        F.col("node").alias("root"), F.col("root").alias("up"))
    return written(rooted.join(merged, "root", "left")
                   .select("node", F.coalesce("up", "root").alias("root")), "neardup-roots")


def _between_roots(found: DataFrame, rooted: DataFrame) -> DataFrame:
    """Links (a, b) as edges between the roots of their ends."""
    for end in ("a", "b"):
        at = rooted.select(F.col("node").alias(end), "root")
        found = found.join(at, end).drop(end).withColumnRenamed("root", end)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _open_members(members: DataFrame, rooted: DataFrame) -> DataFrame:
    """(key, node, root) of the buckets that hold several components."""
    current = members.join(rooted, "node")
    several = (current.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
               .where("low < high").select("key"))
    return current.join(several, "key").select("key", "node", "root")


def _block_pairs(rest: DataFrame) -> DataFrame:
    """(key, low, high, block, node, root): the members of each bucket dealt
    into hashed blocks of about ``BLOCK``, one row per pair of blocks that a
    member is compared in.

    Members of a bucket's largest component are not compared with each other,
    so their blocks meet only those of all other members."""
    sizes = rest.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    whole = F.col("n") <= BLOCK
    in_main = ~whole & (F.col("root") == F.col("main.root"))
    n_main = F.when(whole, 0).otherwise(F.ceil(F.col("main.n") / BLOCK)).cast("int")
    n_other = F.when(whole, 1).otherwise(F.ceil((F.col("n") - F.col("main.n")) / BLOCK)).cast("int")
    dealt = F.xxhash64(F.lit("block"), "node")
    block = F.when(in_main, n_other + F.pmod(dealt, n_main)).otherwise(F.pmod(dealt, n_other)).cast("int")
    last = F.when(in_main, n_other).otherwise(n_other + n_main) - 1
    return (rest.join(largest, "key")
            .select("key", "node", "root", block.alias("block"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
            .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "block", "node", "root"))


def _packs(batches):
    """Frames of whole block pairs from sorted batches; small ones together."""
    held = None
    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if len(pdf) == 0:
            continue
        of = pdf[["key", "low", "high"]].to_numpy()
        starts = np.flatnonzero(np.append(True, (of[1:] != of[:-1]).any(axis=1)))
        begin = 0
        for at in starts[1:]:
            if at - begin >= BLOCK or at == starts[-1]:
                yield pdf.iloc[begin:at]
                begin = at
        held = pdf.iloc[begin:]
    if held is not None and len(held):
        yield held


def _overlap_bound(texts: list[str], idf: Idf, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight of each text, and for each two texts an upper bound of the sum of
    minima: the sum of sqrt(w * w') (equal to it where the weights are equal)."""
    hashes, doc, counts = unique_shingles(texts, width)
    w = weights(hashes, counts, idf)
    total = np.bincount(doc, w, minlength=len(texts))
    bound = np.zeros((len(texts), len(texts)), np.float32)
    _, column, texts_with = np.unique(hashes, return_inverse=True, return_counts=True)
    kept = np.flatnonzero(texts_with[column] > 1)
    column, doc, v = column[kept], doc[kept], np.sqrt(w[kept]).astype(np.float32)
    order = np.argsort(column, kind="stable")
    doc, v = doc[order], v[order]
    column = np.cumsum(np.diff(column[order], prepend=-1) != 0) - 1
    edges = np.searchsorted(column, np.arange(0, column[-1] + COLUMNS + 1, COLUMNS)) if len(column) else []
    for k, (i, j) in enumerate(zip(edges, edges[1:])):
        part = np.zeros((len(texts), COLUMNS), np.float32)
        part[doc[i:j], column[i:j] - k * COLUMNS] = v[i:j]
        bound += part @ part.T
    return total, bound


def _nearest(pdf: pd.DataFrame, idf: Idf, threshold: float, width: int) -> pd.DataFrame:
    """Verified links (a, b) that join the components of each block pair as all
    its verified links would."""
    none = pd.DataFrame({"a": [], "b": []}, dtype=object)
    group = pdf.groupby(["key", "low", "high"], sort=False).ngroup().to_numpy()
    label = pd.factorize(pdf["root"])[0]
    block = pdf["block"].to_numpy()
    alone = (pdf["low"] == pdf["high"]).to_numpy()
    wanted = (group[:, None] == group) & (label[:, None] != label) & (alone[:, None] | (block[:, None] != block))
    wanted = np.triu(wanted, 1)
    if not wanted.any():
        return none
    texts, nodes = pdf["text"].tolist(), pdf["node"].to_numpy()
    total, bound = _overlap_bound(texts, idf, width)
    # A share of 1e-4 is left for rounding; what passes is verified exactly.
    enough = bound * 1.0001 >= threshold / (1 + threshold) * (total[:, None] + total)
    x, y = np.nonzero(wanted & enough)
    order = np.argsort(-bound[x, y], kind="stable")
    x, y = x[order], y[order]
    out: list[tuple] = []
    while len(x):
        # The most promising pair of each component; then what is still apart.
        first = np.zeros(len(x), bool)
        for side in (label[x], label[y]):
            first[np.unique(side, return_index=True)[1]] = True
        a, b = [texts[i] for i in x[first]], [texts[i] for i in y[first]]
        good = np.zeros(len(a), bool)
        for i, j in blocks([s + t for s, t in zip(a, b)]):
            good[i:j] = weighted_jaccard(a[i:j], b[i:j], idf, width) >= threshold
        for i, j in zip(x[first][good], y[first][good]):
            if label[i] != label[j]:
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
        left = ~first & (label[x] != label[y])
        x, y = x[left], y[left]
    return pd.DataFrame(out, columns=["a", "b"]) if out else none


def _links_between(rows: DataFrame, texts: DataFrame, idf: Idf, threshold: float, width: int) -> DataFrame:
    """Links (a, b) between different components of a bucket.  Every pair of
    nodes of different components is bounded, and verified unless the bound
    excludes it or verified links have joined its components."""

    def compare(batches):
        for pdf in _packs(batches):
            yield _nearest(pdf, idf, threshold, width)

    return (rows.join(texts, "node").repartition("key", "low", "high")
            .sortWithinPartitions("key", "low", "high")
            .select("key", "low", "high", "block", "node", "root", "text")
            .mapInPandas(compare, "a binary, b binary").distinct())


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD, width: int = WIDTH,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, node, class_id, kept) of every row: ``node`` is the digest of the
    text, ``class_id`` the smallest id of the row's class of similar texts,
    ``kept`` whether the row carries the smallest (id, node) of its class.
    Rows with a null id are kept, without a class."""
    ids = written(docs.select(F.col(doc_id).alias("id"), digest(text).alias("node")), "neardup-ids")
    first = docs.select(digest(text).alias("node"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                        F.col(doc_id).alias("id")).where("id is not null")
    # One row per distinct text: the rows that carry the smallest id of the text.
    least = ids.where("id is not null").groupBy("node").agg(F.min("id").alias("id"))
    nodes = written(first.join(least, ["node", "id"], "left_semi").select("node", "text")
                    .dropDuplicates(["node"]), "neardup-nodes")
    rooted = links(nodes, threshold=threshold, width=width, bands=bands, rows=rows)
    classes = written(least.join(rooted, "node", "left")
                      .select("node", "id", F.coalesce("root", "node").alias("root")), "neardup-classes")
    smallest = classes.groupBy("root").agg(F.min(F.struct("id", "node")).alias("first"))
    named = classes.join(smallest, "root").select("node", "first")
    known = F.col("id").isNotNull()
    return (ids.join(named, "node", "left")
            .select("id", "node", F.when(known, F.col("first.id")).alias("class_id"),
                    (~known | F.coalesce(F.col("first") == F.struct("id", "node"), F.lit(False))).alias("kept")))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """One row (all columns) of each class of similar texts: the one with the
    smallest id.  Of repeated rows (equal id and text) one stays; rows with a
    null id all stay."""
    keys = written(near_duplicates(docs, doc_id=doc_id, text=text, threshold=threshold)
                   .where("kept and id is not null").groupBy("id", "node").agg(F.count("*").alias("n"))
                   .select(F.col("id").alias("_obslake_id"), F.col("node").alias("_obslake_node"), "n"),
                   "neardup-kept")
    keyed = docs.withColumn("_obslake_node", digest(text)).withColumn("_obslake_id", F.col(doc_id))
    on = ["_obslake_id", "_obslake_node"]
    kept = keyed.where(F.col("_obslake_id").isNotNull()).join(keys.select(*on), on, "left_semi")
    if not keys.where("n > 1").isEmpty():
        kept = kept.dropDuplicates(on)
    kept = kept.unionByName(keyed.where(F.col("_obslake_id").isNull()))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
