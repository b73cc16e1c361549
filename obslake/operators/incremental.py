"""Per-day states that are merged with each load instead of rescanning all rows.

* Completeness (AGG-6): a bitmap of the sources seen, per batch.  OR is
  idempotent, so a replayed load changes nothing.
* Moments (AGG-8 / ML-3): (n, mean, M2) per load, day and feature.  A load
  replaces what it wrote before, so a replayed load changes nothing.

Both rewrite only the days (or the load) they touch, by dynamic partition
overwrite from a table already written, so a job lost half-way can be rerun.
One writer per state.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.expr import day_of_batch
from obslake.operators.ranks import global_rank
from obslake.schema import BATCH_COL, PARTITION_COL, SOURCE_COL
from obslake.session import path_exists, scratch_path

SOURCES = "source string, position bigint"
SEEN = f"{BATCH_COL} string, bucket bigint, seen binary, {PARTITION_COL} date"
MOMENTS = f"feature string, n bigint, mean double, m2 double, load string, {PARTITION_COL} date"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _replace(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrites the partitions of ``df``; it is written in full before any
    partition is touched, since it may have been read from them."""
    spark = df.sparkSession
    staged = scratch_path(spark, "staged", uuid.uuid4().hex)
    df.write.parquet(staged)
    (spark.read.schema(df.schema).parquet(staged).hint("rebalance", *by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


# --- completeness ------------------------------------------------------------

def source_positions(rows: DataFrame, state: str, source_col: str = SOURCE_COL) -> DataFrame:
    """(source, position): the number of each source seen so far; new sources
    are appended after the old ones, in their order."""
    spark = rows.sparkSession
    path = f"{state.rstrip('/')}/sources"
    known = _read(spark, path, SOURCES)
    new = (rows.select(F.col(source_col).alias("source")).where("source is not null").distinct()
           .join(known, "source", "left_anti"))
    if not new.isEmpty():
        at = known.agg(F.coalesce(F.max("position") + 1, F.lit(0))).first()[0]
        (global_rank(new, [F.col("source")], "position")
         .select("source", (F.col("position") + at).alias("position")).write.mode("append").parquet(path))
    return _read(spark, path, SOURCES)


def merge_completeness(rows: DataFrame, state: str, batch_col: str = BATCH_COL, source_col: str = SOURCE_COL) -> None:
    """Adds a load's (batch, source) pairs to the state, reading and writing
    only the days of the load (one value per day it spans).  Batches whose key
    is no day, and null sources, are left out."""
    spark = rows.sparkSession
    pairs = (rows.select(F.col(batch_col).alias(BATCH_COL), F.col(source_col).alias("source"))
             .where("source is not null").withColumn(PARTITION_COL, day_of_batch(BATCH_COL))
             .where(F.col(PARTITION_COL).isNotNull()).distinct())
    positions = source_positions(rows, state, source_col)
    fresh = (pairs.join(positions, "source")
             .groupBy(PARTITION_COL, BATCH_COL, F.bitmap_bucket_number("position").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("seen")))
    days = [r[0] for r in pairs.select(PARTITION_COL).distinct().collect()]
    if not days:
        return
    path = f"{state.rstrip('/')}/seen"
    old = _read(spark, path, SEEN).where(F.col(PARTITION_COL).isin(days))
    merged = (old.unionByName(fresh).groupBy(PARTITION_COL, BATCH_COL, "bucket")
              .agg(F.bitmap_or_agg("seen").alias("seen")))
    _replace(merged.select(BATCH_COL, "bucket", "seen", PARTITION_COL), path, [PARTITION_COL])


def completeness(spark: SparkSession, state: str, days: Sequence | None = None) -> DataFrame:
    """(batch, n_sources) of the state (of the given days only)."""
    seen = _read(spark, f"{state.rstrip('/')}/seen", SEEN)
    if days is not None:
        seen = seen.where(F.col(PARTITION_COL).isin(list(days)))
    return seen.groupBy(BATCH_COL).agg(F.sum(F.bitmap_count("seen")).alias("n_sources"))


def complete_batches(spark: SparkSession, state: str, expected: int, days: Sequence | None = None) -> DataFrame:
    """AGG-6 (strict) from the state: batches with ``expected`` sources."""
    return completeness(spark, state, days).where(F.col("n_sources") == expected).select(BATCH_COL)


# --- moments -----------------------------------------------------------------

def merge_moments(rows: DataFrame, state: str, load: str, day_col: str, features: Sequence[str]) -> None:
    """Adds the states of one load (named by ``load``); nulls and NaNs of a
    feature are left out of it.  M2, the sum of squared distances from the
    mean, comes from Spark's own mergeable variance, never from a sum of squares."""
    each = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features]
    long = (rows.select(F.col(day_col).cast("date").alias(PARTITION_COL), F.inline(F.array(*each)))
            .where("x is not null and not isnan(x)"))
    states = long.groupBy(PARTITION_COL, "feature").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("x")).alias("m2"))
    _replace(states.select("feature", "n", "mean", "m2", F.lit(load).alias("load"), PARTITION_COL), state,
             ["load", PARTITION_COL])


def merged_moments(spark: SparkSession, state: str) -> DataFrame:
    """(feature, n, mean, std): all states merged.  M2 of the union is the sum
    of M2 plus n (mean - common mean)^2; distances are taken before they are
    squared, so a large common offset costs no digits."""
    parts = _read(spark, state, MOMENTS)
    # Means are added as distances from one of them, for the same reason.
    base = parts.groupBy("feature").agg(F.min("mean").alias("base"), F.sum("n").alias("total"))
    near = parts.join(base, "feature")
    common = near.groupBy("feature", "base", "total").agg(
        (F.sum(F.col("n") * (F.col("mean") - F.col("base"))) / F.col("total")).alias("shift"))
    both = parts.join(common, "feature").withColumn("d", F.col("mean") - F.col("base") - F.col("shift"))
    out = both.groupBy("feature", "base", "shift", "total").agg(
        F.sum(F.col("m2") + F.col("n") * F.col("d") * F.col("d")).alias("m2"))
    return out.select("feature", F.col("total").alias("n"), (F.col("base") + F.col("shift")).alias("mean"),
                      F.when(F.col("total") > 1, F.sqrt(F.col("m2") / (F.col("total") - 1))).otherwise(F.lit(0.0)).alias("std"))


def scaled(df: DataFrame, moments: DataFrame, features: Sequence[str], prefix: str = "z_") -> DataFrame:
    """ML-3 from a merged state: ``df`` with (x - mean) / std of each feature; a
    constant feature is 0.0.  The moments (one row a feature) become literals."""
    known = {r["feature"]: (r["mean"], r["std"]) for r in moments.where(F.col("feature").isin(list(features))).collect()}
    out = {}
    for f in features:
        mean, std = known[f]
        out[f"{prefix}{f}"] = (F.col(f) - F.lit(mean)) * F.lit(1 / std if std else 0.0)
    return df.withColumns(out)
