"""Sequence packing: shortest-pack-first over the length histogram.

1. Documents become token ids and are cut every ``size`` tokens into pieces.
2. The histogram of piece lengths (at most ``size`` rows) goes to the driver,
   which places the lengths longest first: each piece goes to the open pack
   with the fewest tokens, or to a new pack where it does not fit.  Packs of the
   same content are one entry with a count, so the work depends on the lengths
   and ``size``, not on the number of pieces.
3. The placements are joined back by rank: the i-th piece of a length takes
   the i-th place of that length.  Ranks are dealt in hashed groups with a
   prefix sum, so no task sees all pieces of a frequent length.

Edge cases: null text is an empty text, which is the end token alone.  A text of
any length is encoded whole (see ``rank_encoder`` for very long runs) and cut
into pieces, of which a task holds some 16 MB at a time.
Repeated rows and null ids are packed like any other.  An empty table gives an
empty result.  A sequence is padded to ``size`` unless its tokens are a power
of two in number (``padded_tokens``).
"""

from __future__ import annotations

import base64
import heapq
import math
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import written

SIZE = 2048
END_ID = 1
SPECIAL = {"<|endoftext|>": 50256}  # as in the vocabulary's ``tokenizers`` file
LONG_RUN = 4096


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def rank_encoder(path: str | None = None, json_path: str | None = None) -> Callable[[str], list[int]]:
    """Encoder of the byte-level BPE vocabulary given as ranks.  Its ids are
    those of the same vocabulary's ``tokenizers`` file without added special
    tokens, where a special token that the text itself holds is one id (five
    times as fast; the tests compare both).

    The pattern that splits a text backtracks over a run of white space, and a
    run of letters is one piece; texts with a run of ``LONG_RUN`` characters of
    a kind go through the ``tokenizers`` file itself."""
    import public_tokenizers
    import tiktoken

    with open(path or public_vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens=SPECIAL)
    half = LONG_RUN // 2
    whole = None

    def long_run(text: str) -> bool:
        """Such a run covers a whole block of half its length, which then has one word at most."""
        return any(len(text[i:i + half].split(None, 1)) < 2 for i in range(0, len(text) - half + 1, half))

    def encode(text: str) -> list[int]:
        nonlocal whole
        if len(text) >= LONG_RUN and long_run(text):
            whole = whole or json_encoder(json_path)
            return whole(text)
        return encoding.encode(text, allowed_special="all")

    return encode


def json_encoder(path: str | None = None) -> Callable[[str], list[int]]:
    """Encoder of a ``tokenizers`` file."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path or public_vocabulary("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


PIECE = "doc_id {id}, start long, length long, {ids}ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
           encoder: Callable[[], Callable[[str], list[int]]] = rank_encoder,
           with_ids: bool = True) -> DataFrame:
    """One row per piece of at most ``size`` tokens of each document.

    ``ids`` (binary) holds the ids as little-endian unsigned 32-bit numbers,
    ``ids_crc32`` their checksum, ``doc_tokens`` the document's tokens with the
    end id."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        encode = encoder()
        for pdf in batches:
            rows: list[tuple] = []
            held = 0
            for one, body in zip(pdf["doc_id"].array, pdf["text"]):
                ids = np.array([*encode(body), END_ID], dtype="<u4")
                one = None if pd.isna(one) else one
                for start in range(0, len(ids), size):
                    raw = ids[start:start + size].tobytes()
                    rows.append((one, start, len(raw) // 4, raw, zlib.crc32(raw), len(ids)))
                    held += len(raw)
                if held > 1 << 24:
                    yield frame(rows)
                    rows, held = [], 0
            yield frame(rows)

    def frame(rows):
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens"])
        if id_type in ("bigint", "int"):
            out["doc_id"] = out["doc_id"].astype("Int64")
        return out if with_ids else out.drop(columns="ids")

    return narrow.mapInPandas(cut, PIECE.format(id=id_type, ids="ids binary, " * with_ids))


def place(histogram: dict[int, int], size: int = SIZE):
    """Shortest-pack-first over ``{length: count}``.

    Returns the placements ``{length: [(first rank, first pack, offset)]}``
    (ranks of a length ascending, each run as long as up to the next) and the
    packs ``[(first pack, count, tokens)]`` by first pack.
    """
    placements: dict[int, list[tuple[int, int, int]]] = {}
    open_packs: list[tuple[int, int, int]] = []    # heap of (tokens, first pack, count)
    closed: list[tuple[int, int, int]] = []
    n_packs = 0

    def put_back(tokens: int, first: int, count: int) -> None:
        if tokens == size:
            closed.append((tokens, first, count))
        elif count:
            heapq.heappush(open_packs, (tokens, first, count))

    for length in sorted(histogram, reverse=True):
        left, rank, runs = histogram[length], 0, []
        # Packs of equal content take a piece each before any of them is the shortest again.
        while left and open_packs and open_packs[0][0] + length <= size:
            tokens, first, count = heapq.heappop(open_packs)
            used = min(left, count)
            runs.append((rank, first, tokens))
            put_back(tokens, first + used, count - used)
            put_back(tokens + length, first, used)
            left, rank = left - used, rank + used
        # No open pack fits: new ones take pieces until they are full, the last what is left.
        per = size // length
        for packs_of, pieces_of in ((left // per, per), (1, left % per)):
            if packs_of and pieces_of:
                for k in range(pieces_of):
                    runs.append((rank, n_packs, k * length))
                    rank += packs_of
                put_back(pieces_of * length, n_packs, packs_of)
                n_packs += packs_of
        placements[length] = runs
    packs = sorted((first, count, tokens) for tokens, first, count in closed + open_packs)
    return placements, packs


def pack(cut: DataFrame, *, size: int = SIZE) -> DataFrame:
    """``cut`` (a table of pieces; read more than once) with ``sequence_id``,
    ``offset``, ``sequence_tokens`` and ``padded_tokens``."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placements, packs = place(counts, size)
    # As many rank groups a length as a group has rows: both grow as the square root.
    groups = F.array(*[F.lit(math.isqrt(counts.get(n, 1) - 1) + 1) for n in range(size + 1)])
    dealt = cut.withColumn("rank_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"),
                                                F.element_at(groups, F.col("length").cast("int") + 1)))
    before = Window.partitionBy("length").orderBy("rank_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("length", "rank_group").agg(F.count("*").alias("n"))
               .select("length", "rank_group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))
    within = Window.partitionBy("length", "rank_group").orderBy("doc_id", "start", "ids_crc32")
    ranked = (dealt.withColumn("rank", F.row_number().over(within) - 1)
              .join(offsets, ["length", "rank_group"])
              .withColumn("rank", F.col("rank") + F.col("ahead")).drop("rank_group", "ahead"))

    # Bounded by the number of lengths: a few runs each.
    lengths = sorted(placements)
    at = {n: i for i, n in enumerate(lengths)}
    first_run = np.cumsum([0] + [len(placements[n]) for n in lengths])
    runs = np.array([r for n in lengths for r in placements[n]], dtype=np.int64).reshape(-1, 3)
    pack_first = np.array([p[0] for p in packs], dtype=np.int64)
    pack_tokens = np.array([p[2] for p in packs], dtype=np.int64)

    @F.pandas_udf("sequence_id long, offset long, sequence_tokens long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        index = length.map(at).to_numpy(np.int64)
        ranks = rank.to_numpy(np.int64)
        run = np.empty(len(ranks), dtype=np.int64)
        for i in np.unique(index):
            own = index == i
            low, high = first_run[i], first_run[i + 1]
            run[own] = low + np.searchsorted(runs[low:high, 0], ranks[own], side="right") - 1
        sequence = runs[run, 1] + ranks - runs[run, 0]
        tokens = pack_tokens[np.searchsorted(pack_first, sequence, side="right") - 1]
        return pd.DataFrame({"sequence_id": sequence, "offset": runs[run, 2], "sequence_tokens": tokens})

    tokens = F.col("place.sequence_tokens")
    power = tokens.bitwiseAND(tokens - 1) == 0
    kept = [c for c in cut.columns]
    return (ranked.withColumn("place", look_up("length", "rank"))
            .select(*kept, "place.sequence_id", "place.offset", "place.sequence_tokens",
                    F.when(power, tokens).otherwise(F.lit(size)).cast("long").alias("padded_tokens")))


def pack_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
                   encoder=rank_encoder, with_ids: bool = True) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    cut = written(pieces(docs, doc_id=doc_id, text=text, size=size, encoder=encoder,
                         with_ids=with_ids), "packing-pieces")
    return pack(cut, size=size)
