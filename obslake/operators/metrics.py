"""Grading and summary operators (AGG-8..11, LIM-2, SET-1).

All are aggregates that combine map-side: the shuffled data is bounded by the
number of (label, prediction) pairs or groups, whatever the row count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """AGG-8: mean and sample standard deviation per feature, one row per
    feature, in one pass (what StandardScaler fits)."""
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_samp(f).alias(f"s_{f}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{f}', `m_{f}`, `s_{f}`" for f in features)
    return wide.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, mean, std)")


def confusion(df: DataFrame, label: str, prediction: str, alias: str = "n") -> DataFrame:
    """AGG-11: rows per (label, prediction)."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias(alias))


def accuracy(df: DataFrame, label: str, prediction: str,
             by: Sequence[str] | None = None, alias: str = "accuracy") -> DataFrame:
    """AGG-9: share of rows whose prediction equals the label, per group."""
    hit = F.avg((F.col(label) == F.col(prediction)).cast("double")).alias(alias)
    return df.groupBy(*(by or [])).agg(hit)


def precision_by_label(df: DataFrame, label: str, prediction: str,
                       alias: str = "precision") -> DataFrame:
    """AGG-10: TP / (TP + FP) for every label seen as label or prediction;
    0.0 for a label that is never predicted (as Spark's evaluator).

    One chain over ``df`` (one scan): the confusion counts, then each count
    votes once for its label (0 predicted) and once for its prediction
    (n predicted, n hits when prediction == label), summed per label."""
    conf = confusion(df, label, prediction, "_n")
    lab, pred, n = F.col(label), F.col(prediction), F.col("_n")
    zero = F.lit(0).cast("long")
    votes = conf.select(F.explode(F.array(
        F.struct(lab.alias("v"), zero.alias("p"), zero.alias("t")),
        F.struct(pred.alias("v"), n.alias("p"), F.when(pred == lab, n).otherwise(zero).alias("t")),
    )).alias("e"))
    per_label = votes.groupBy(F.col("e.v").alias(label)).agg(
        F.sum("e.p").alias("_predicted"), F.sum("e.t").alias("_tp"))
    return per_label.select(
        label,
        F.when(F.col("_predicted") == 0, F.lit(0.0))
         .otherwise(F.col("_tp") / F.col("_predicted")).alias(alias))


def point_lookup(df: DataFrame, by: str, value: str, order: str,
                 alias: str | None = None) -> DataFrame:
    """LIM-2: per group, the value of the first row by ``order`` — one
    aggregate instead of one filter+first() job per group."""
    return df.groupBy(by).agg(F.min_by(value, order).alias(alias or value))


def union_sources(frames: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    """SET-1: UNION ALL of several reads; by name (missing columns null) or,
    as the positional form, by position."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True) if by_name else out.union(f)
    return out
