"""Global ranks, exact selection and as-of joins over range partitions.

None of them sorts or scans all rows in one task: rows are range-partitioned
(with a tie-break, so that many equal keys are spread over partitions), each
partition works on its own, and one value a partition goes through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.session import scratch_path

_PART, _ROW = 33, (1 << 33) - 1      # monotonically_increasing_id: partition above, row below


def _dealt(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` sorted over range partitions and written to the shared scratch
    folder, with ``_part`` and ``_at`` (place in the partition)."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*order, F.col("_tie")]
    out = (tied.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
           .withColumn("_at", F.monotonically_increasing_id()).drop("_tie")
           .withColumn("_part", F.shiftright("_at", _PART).cast("int"))
           .withColumn("_at", F.col("_at").bitwiseAND(F.lit(_ROW))))
    path = scratch_path(spark, "ranks", uuid.uuid4().hex)
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _per_part(values: dict[int, object], kind: str) -> Column:
    """The value of ``_part``: a literal array with one entry a partition."""
    size = max(values, default=0) + 1
    return F.element_at(F.array(*[F.lit(values.get(i)).cast(kind) for i in range(size)]), F.col("_part") + 1)


def global_rank(df: DataFrame, order: Sequence[Column], alias: str = "rank") -> DataFrame:
    """``df`` with its 0-based row number by ``order``."""
    dealt = _dealt(df, order)
    counts = {r["_part"]: r["n"] for r in dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    ahead, total = {}, 0
    for part in sorted(counts):
        ahead[part], total = total, total + counts[part]
    return dealt.withColumn(alias, F.col("_at") + _per_part(ahead, "bigint")).drop("_part", "_at")


def label_ranks(df: DataFrame, label: str, index_col: str) -> DataFrame:
    """AGG-7 / ML-1 for any number of labels: index 0.0 for the most frequent,
    ties alphabetical; null labels get none.  ``StringIndexer`` gives the same
    indexes, but brings every label to the driver."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    ranked = global_rank(counts, [F.desc("_n"), F.asc(label)], "_rank")
    return ranked.select(label, F.col("_rank").cast("double").alias(index_col))


def kth_smallest(values: DataFrame, col: str, k: int, bits: int, step: int = 15) -> tuple[int, int]:
    """(the k-th smallest of the non-negative ``bits``-bit numbers in ``col``,
    how many are smaller), for 1 <= k <= rows.

    Each round counts one finer histogram (at most 2^step rows reach the
    driver) inside the bucket that holds the k-th."""
    low, below, left = 0, 0, bits
    while left:
        fine = min(step, left)
        left -= fine
        bucket = F.shiftright(F.col(col), left)
        inside = values.where(F.col(col).between(low, low + (1 << (left + fine)) - 1))
        for r in sorted(inside.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()):
            if below + r["n"] >= k:
                low = r["b"] << left
                break
            below += r["n"]
    return low, below


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Every row of ``left`` with the columns of the last row of ``right``
    whose ``right_on`` is at or below its ``left_on`` (null where there is
    none, or where the key is null).  Of right rows with equal keys the one
    that is greatest by its columns counts.

    The sorted union of the keys is range-partitioned; the last right key is
    carried forward inside a partition, and into it from the partitions before.
    Right rows are then fetched by that key."""
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    rights = (right.where(F.col(right_on).isNotNull()).groupBy(right_on)
              .agg(F.max(F.struct(*right.columns)).alias("_r")).select("_r.*"))
    kind = right.schema[right_on].dataType
    both = left.select(F.col(left_on).cast(kind).alias("_key"), F.lit(1).alias("_side"),
                       F.struct(*left.columns).alias("_l")).unionByName(
        rights.select(F.col(right_on).alias("_key"), F.lit(0).alias("_side")), allowMissingColumns=True)
    dealt = _dealt(both.where("_key is not null"), [F.col("_key"), F.col("_side")])
    is_right = F.when(F.col("_side") == 0, F.col("_key"))
    ends = {r["_part"]: r["k"] for r in dealt.groupBy("_part").agg(F.max(is_right).alias("k")).collect()}
    before, last = {}, None
    for part in sorted(ends):
        before[part], last = last, ends[part] if ends[part] is not None else last
    run = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    carried = (dealt.withColumn("_found", F.coalesce(F.last(is_right, ignorenulls=True).over(run),
                                                     _per_part(before, kind.simpleString())))
               .where("_side = 1").select("_found", "_l.*"))
    none = left.where(F.col(left_on).cast(kind).isNull()).select(F.lit(None).cast(kind).alias("_found"), *left.columns)
    return (carried.unionByName(none).join(rights.withColumn("_found", F.col(right_on)), "_found", "left")
            .select(*left.columns, *right.columns))
