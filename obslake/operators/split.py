"""SMP-1 / SMP-2: train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.expr import hash_bucket
from obslake.operators.ranks import kth_smallest


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2),
                 seed: int = 42) -> list[DataFrame]:
    """SMP-1: Spark's ``randomSplit``.  Reproducible only for an identical
    partitioning of the input; prefer :func:`hash_split`."""
    return df.randomSplit(list(weights), seed=seed)


def hash_split(df: DataFrame, key: Sequence[str] | str, train_pct: int = 80,
               col: str = "split") -> DataFrame:
    """SMP-2: label each row ``train`` or ``test`` from a hash of its key.

    Same answer for any partitioning, any run and any engine that has md5."""
    keys = [key] if isinstance(key, str) else list(key)
    k = F.col(keys[0]).cast("string") if len(keys) == 1 else F.concat_ws("|", *keys)
    return df.withColumn(col, F.when(hash_bucket(k) < train_pct, F.lit("train"))
                              .otherwise(F.lit("test")))


HASH_BITS = 60


def _hash_number(text: Column) -> Column:
    """The first 60 bits of an MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def exact_split(df: DataFrame, key: Sequence[str] | str, train_share: float = 0.8, col: str = "split") -> DataFrame:
    """SMP-1 with an exact size: the ``floor(train_share * rows)`` rows with the
    smallest key hash are ``train``, the others ``test``.

    The border is found by refining histograms, without a sort.  Rows of equal
    key hash are told apart by a hash of all columns, rows that are equal in
    all columns by their place in the scan (which of them goes where makes no
    difference).  So the answer is the same for any partitioning."""
    keys = [key] if isinstance(key, str) else list(key)
    every = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    levels = [("_h0", _hash_number(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])), HASH_BITS),
              ("_h1", _hash_number(every), HASH_BITS), ("_h2", F.monotonically_increasing_id(), 62)]
    rows = df
    for name, hashed, _ in levels:
        rows = rows.withColumn(name, hashed)
    k = int(df.count() * train_share + 1e-9)
    inside, tied = F.lit(False), F.lit(True)
    for name, _, bits in levels:
        if k <= 0:
            break
        border, below = kth_smallest(rows.where(tied).select(name), name, k, bits)
        inside = inside | (tied & (F.col(name) < border))
        tied = tied & (F.col(name) == border)
        k -= below
        if rows.where(tied).limit(k + 1).count() == k:
            inside, k = inside | tied, 0
    return rows.withColumn(col, F.when(inside, F.lit("train")).otherwise(F.lit("test"))).drop(*[n for n, _, _ in levels])
