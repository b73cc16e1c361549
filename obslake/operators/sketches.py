"""Approximate distinct counts per batch as mergeable HyperLogLog sketches.

For sources too many for ``collect_set`` or a bitmap: one sketch of at most
``2 ** lg_k`` bytes a batch, whatever the number of sources.  Union is
idempotent, so a replayed load changes nothing, and any set of batches (a day,
a month) is counted from their sketches.  The relative standard error is about
``1.04 / sqrt(2 ** lg_k)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.expr import day_of_batch
from obslake.operators.incremental import _read, _replace
from obslake.schema import BATCH_COL, PARTITION_COL, SOURCE_COL

LG_K = 12
SKETCHES = f"{BATCH_COL} string, sketch binary, {PARTITION_COL} date"


def merge_sketches(rows: DataFrame, state: str, batch_col: str = BATCH_COL, source_col: str = SOURCE_COL,
                   lg_k: int = LG_K) -> None:
    """Adds a load to the state, reading and writing only the days it spans.
    Batches whose key is no day, and null sources, are left out."""
    seen = (rows.select(F.col(batch_col).alias(BATCH_COL), F.col(source_col).cast("string").alias("source"))
            .where("source is not null").withColumn(PARTITION_COL, day_of_batch(BATCH_COL))
            .where(F.col(PARTITION_COL).isNotNull()))
    days = [r[0] for r in seen.select(PARTITION_COL).distinct().collect()]
    if not days:
        return
    fresh = seen.groupBy(PARTITION_COL, BATCH_COL).agg(F.hll_sketch_agg("source", F.lit(lg_k)).alias("sketch"))
    old = _read(rows.sparkSession, state, SKETCHES).where(F.col(PARTITION_COL).isin(days))
    merged = old.unionByName(fresh).groupBy(PARTITION_COL, BATCH_COL).agg(F.hll_union_agg("sketch").alias("sketch"))
    _replace(merged.select(BATCH_COL, "sketch", PARTITION_COL), state, [PARTITION_COL])


def approximate_sources(spark: SparkSession, state: str, by: Sequence[Column | str] = (BATCH_COL,)) -> DataFrame:
    """(by..., n_sources) from the state: distinct sources of each group of
    batches, estimated from the union of their sketches."""
    return (_read(spark, state, SKETCHES).groupBy(*by)
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_sources")))
