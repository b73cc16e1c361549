"""Sharding by a Feistel permutation of global row numbers (DataFrame functions only).

1. One range shuffle sorts the rows by the order columns; a row's place in its
   partition plus the rows of the partitions before it is its global number.
2. A Feistel network over Z_a x Z_b, with a = ceil(sqrt(rows)) and
   b = ceil(rows / a), permutes the numbers 0 .. a * b - 1.  A value outside the
   rows walks on along its cycle until it is inside.  Fewer than ``a`` values lie
   outside, so hardly any row walks.
3. With v the permuted number, the shard is v mod shards and the slot v div
   shards: counts differ by one at most and slots have no gaps.

The same rows, seed and shards give the same places, whatever the files,
partitions or cluster.  Anybody who knows the number of rows can compute the
place of a row number (``place``) and the row number at a place
(``number_at``) without the table.

Edge cases: null order values come first.  A null text counts as no bytes.
Repeated rows have a number each; rows that agree in all order columns are told
apart by their place in the scan, after the hot ones were spread over several
partitions.  Texts of any length are only measured, never moved, unless the
shards are written.  With fewer rows than shards some shards are empty; an
empty table gives an empty result.  Columns of any name are kept, but for
``row_number``, ``shard`` and ``slot``, which this module sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import written

ROUNDS = 6
WALK = 64           # steps along a cycle; a longer walk stops the job rather than misplacing a row
ROW_BYTES = 16      # what a row weighs besides its text


def half_sizes(rows: int) -> tuple[int, int]:
    """Sizes (a, b) of the two halves; a * b is less than ``rows + a``."""
    a = math.isqrt(max(rows, 1) - 1) + 1
    return a, max(1, -(-rows // a))


def _mixed(seed: int, step: Column, half: Column) -> Column:
    """60 bits of the MD5 of ``seed:step:half``."""
    text = F.concat_ws(":", F.lit(str(seed)), step.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _network(value: Column, rows: int, seed: int, inverse: bool) -> Column:
    """One pass of the network; odd steps change the half below ``a``."""
    a, b = half_sizes(rows)

    def step(halves: Column, k: Column) -> Column:
        left, right = halves["l"], halves["r"]
        sign = -1 if inverse else 1
        odd = k % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(left + sign * (_mixed(seed, k, right) % a), F.lit(a).cast("long"))).otherwise(left).alias("l"),
            F.when(odd, right).otherwise(F.pmod(right + sign * (_mixed(seed, k, left) % b), F.lit(b).cast("long"))).alias("r"))

    steps = F.array(*[F.lit(k) for k in (range(ROUNDS, 0, -1) if inverse else range(1, ROUNDS + 1))])
    start = F.struct((value % a).cast("long").alias("l"), F.floor(value / a).cast("long").alias("r"))
    return F.aggregate(steps, start, step, lambda h: h["l"] + h["r"] * a)


def permuted(value: Column, rows: int, *, seed: int = 0, inverse: bool = False) -> Column:
    """``value`` in 0 .. rows - 1 permuted within that range (or back)."""
    once = _network(value, rows, seed, inverse)
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once,
                       lambda v, _: F.when(v < rows, v).otherwise(_network(v, rows, seed, inverse)))
    return F.when(once < rows, once).otherwise(
        F.when(walk < rows, walk).otherwise(F.raise_error(F.lit("cycle longer than the walk: choose another seed")).cast("long")))


def place(number: Column, rows: int, shards: int, *, seed: int = 0) -> Column:
    """Struct (shard int, slot long) of a row number."""
    at = F.transform(F.array(permuted(number, rows, seed=seed)), lambda v: F.struct(
        (v % shards).cast("int").alias("shard"), F.floor(v / shards).cast("long").alias("slot")))
    return F.element_at(at, 1)


def number_at(shard: Column, slot: Column, rows: int, shards: int, *, seed: int = 0) -> Column:
    """The row number at a place; null where the shard has no such slot."""
    at = slot.cast("long") * shards + shard
    return F.when(at < rows, permuted(at, rows, seed=seed, inverse=True))


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` (0 on, by the ``order`` columns, nulls
    first), and their number.

    The scan's own row id ends the order, so that many equal rows are dealt
    over several partitions.  What goes to every task is one offset a
    partition."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(f"`{c}`").asc_nulls_first() for c in order], F.col("_obslake_tie")]
    dealt = (rows.withColumn("_obslake_tie", F.monotonically_increasing_id())
             .repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_obslake_tie")
             .withColumn("_obslake_at", F.monotonically_increasing_id()))
    dealt = written(dealt, "sharding-dealt")
    # monotonically_increasing_id: the partition above bit 33, the row in it below.
    part, at = F.shiftright("_obslake_at", 33), F.col("_obslake_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = dealt.groupBy(part.alias("_obslake_part")).agg(F.count("*").alias("_obslake_n"))
    before = Window.orderBy("_obslake_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select("_obslake_part", "_obslake_n", F.coalesce(
        F.sum("_obslake_n").over(before), F.lit(0)).alias("_obslake_ahead")), "sharding-offsets")
    total = offsets.agg(F.sum("_obslake_n")).first()[0] or 0
    # At most one row a partition: a proven bound for a broadcast.
    out = (dealt.withColumn("_obslake_part", part)
           .join(F.broadcast(offsets.select("_obslake_part", "_obslake_ahead")), "_obslake_part")
           .withColumn("row_number", F.col("_obslake_ahead") + at)
           .drop("_obslake_part", "_obslake_ahead", "_obslake_at"))
    return out, total


def placed(rows: DataFrame, order: list[str], shards: int, *, seed: int = 0) -> DataFrame:
    """``rows`` with ``row_number``, ``shard`` and ``slot``."""
    out, total = numbered(rows, order)
    return (out.withColumn("_obslake_place", place(F.col("row_number"), total, shards, seed=seed))
            .withColumn("shard", F.col("_obslake_place.shard")).withColumn("slot", F.col("_obslake_place.slot"))
            .drop("_obslake_place"))


def measured(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32): UTF-8 bytes plus ``ROW_BYTES``, and the
    unsigned CRC-32 of the text (null: none)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))


def shard_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int = 40,
                    seed: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) of every row."""
    return placed(measured(docs, doc_id=doc_id, text=text), ["doc_id", "text_crc32", "size"], shards, seed=seed)


def write_shards(rows: DataFrame, path: str, order: list[str], shards: int, *, seed: int = 0) -> None:
    """All columns of ``rows`` as ``path/shard=N``, each shard in the order of
    its slots over one or more files (a shard is split where it is large)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (placed(rows, order, shards, seed=seed).repartitionByRange(parts, "shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
