"""Batch completeness and row-quality operators (AGG-1..6, FLT-1..5, JN-1)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.schema import BATCH_COL, SOURCE_COL, SOURCES_PER_BATCH


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """AGG-1: the row count as a one-row table (AGG-2 is ``df.count()``)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def rows_per(df: DataFrame, col: str, alias: str = "n") -> DataFrame:
    """AGG-3/4/5: rows per value of ``col`` (partial + final aggregate)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(alias))


def batch_sizes(df: DataFrame, batch_col: str = BATCH_COL, source_col: str = SOURCE_COL,
                strict: bool = False, alias: str = "n") -> DataFrame:
    """Rows per batch, or with ``strict`` distinct sources per batch (a source
    landed twice then counts once)."""
    agg = F.count_distinct(source_col) if strict else F.count(F.lit(1))
    return df.groupBy(batch_col).agg(agg.alias(alias))


def complete_batches(df: DataFrame, expected: int = SOURCES_PER_BATCH,
                     batch_col: str = BATCH_COL, source_col: str = SOURCE_COL,
                     strict: bool = False) -> DataFrame:
    """AGG-6 / FLT-1: keys of batches holding ``expected`` rows (or distinct
    sources with ``strict``).  One row per batch key: its size grows with
    the number of batches, not with rows."""
    return (batch_sizes(df, batch_col, source_col, strict, "_n")
            .where(F.col("_n") == expected).select(batch_col))


def incomplete_batches(df: DataFrame, expected: int = SOURCES_PER_BATCH,
                       batch_col: str = BATCH_COL, source_col: str = SOURCE_COL,
                       strict: bool = False, alias: str = "n") -> DataFrame:
    """FLT-2: batches below the expected size, with their size."""
    return (batch_sizes(df, batch_col, source_col, strict, alias)
            .where(F.col(alias) < expected))


def keep_complete(df: DataFrame, expected: int = SOURCES_PER_BATCH,
                  batch_col: str = BATCH_COL, source_col: str = SOURCE_COL,
                  strict: bool = False, how: str = "left_semi") -> DataFrame:
    """JN-1: rows of complete batches.

    ``left_semi`` keeps the row shape; ``inner`` is the USING-join form (batch
    key first).  No broadcast is forced: AQE turns the join into a broadcast
    hash join when the measured key set is small, and otherwise keeps a
    sort-merge join whose skewed partitions it splits.
    """
    keys = complete_batches(df, expected, batch_col, source_col, strict)
    return df.join(keys, batch_col, how)


def drop_rows_with_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """FLT-4: drop rows with any null (in ``subset`` when given)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def exclude_batches(df: DataFrame, bad: Iterable[str], batch_col: str = BATCH_COL) -> DataFrame:
    """FLT-5: drop known-bad batches (pushed to the scan as a NOT IN filter,
    and to partition pruning on a partitioned table)."""
    return df.where(~F.col(batch_col).isin(list(bad)))


def sources_wide(df: DataFrame, sources: Sequence[str], value_col: str,
                 batch_col: str = BATCH_COL, source_col: str = SOURCE_COL) -> DataFrame:
    """One row per batch with one column per source (null where the source
    did not report).  ``sources`` is given explicitly so the pivot needs no
    extra pass to discover them."""
    return df.groupBy(batch_col).pivot(source_col, list(sources)).agg(F.max(value_col))
