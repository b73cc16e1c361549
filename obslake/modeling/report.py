"""ML-8 / ML-10: per-batch score reports from one pass over the scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.expr import pct_text, sorted_map
from obslake.schema import BATCH_COL, LABEL_INDEX_COL, SOURCE_COL


def score_report(scored: DataFrame, model_location: str,
                 batch_col: str = BATCH_COL, source_col: str = SOURCE_COL,
                 label_col: str = LABEL_INDEX_COL, prediction_col: str = "prediction",
                 order_col: str = "file_path", positive_label: float = 0.0,
                 model_type: str = "PipelineModel") -> DataFrame:
    """One report row per batch: accuracy, precision of ``positive_label``
    (Spark evaluator's default label 0.0; 0.0 when never predicted), the
    precision of every label seen in the batch (``precision_by_label``, keyed
    by label index), and per source its label index and the model's guess
    (those of the source's first row by ``order_col``).

    The scored rows are read once, by one chain of partial aggregates with
    no branch (a branch would scan the source and run the model twice):

    1. counts per (batch, source, label, prediction) with the smallest
       ``order_col`` of each: bounded by batches x sources x labels^2;
    2. each count row becomes one entry for its source and one for its label
       and for its prediction (precision votes), summed per
       (batch, kind, key);
    3. one row per batch: sums, and maps built from at most
       sources + labels entries.

    This replaces the evaluator jobs and one filter+first() job per source."""
    pred, lab = F.col(prediction_col), F.col(label_col)
    pos = F.lit(positive_label)
    counts = scored.groupBy(batch_col, source_col, lab.alias("_lab"), pred.alias("_pred")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(order_col).alias("_first_order"))
    lab, pred, n = F.col("_lab"), F.col("_pred"), F.col("_n")
    zero = F.lit(0).cast("long")
    hit = F.when(pred == lab, n).otherwise(zero)
    # Smallest order first (a null order never wins), then label, guess.
    first = F.struct(F.col("_first_order").isNull().alias("o_null"),
                     F.col("_first_order").alias("o"), lab.alias("i"), pred.alias("p"))
    no_first = F.lit(None).cast(counts.select(first.alias("f")).schema["f"].dataType)

    def entry(kind, key, rows, hits, tp, predicted, first_row, votes, vote_hits):
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"),
                        rows.alias("rows"), hits.alias("hits"), tp.alias("tp"),
                        predicted.alias("predicted"), first_row.alias("first"),
                        votes.alias("votes"), vote_hits.alias("vote_hits"))

    label_key = lambda c: c.cast("int").cast("string")
    entries = counts.select(batch_col, F.explode(F.array(
        entry("source", F.col(source_col), n, hit,
              F.when((pred == pos) & (lab == pos), n).otherwise(zero),
              F.when(pred == pos, n).otherwise(zero), first, zero, zero),
        # Each row votes once for its label (0 predicted) and once for its
        # prediction (n predicted, n hits when prediction == label).
        entry("label", label_key(lab), zero, zero, zero, zero, no_first, zero, zero),
        entry("label", label_key(pred), zero, zero, zero, zero, no_first, n, hit),
    )).alias("e")).select(batch_col, "e.*")
    per_key = entries.groupBy(batch_col, "kind", "key").agg(
        F.sum("rows").alias("rows"), F.sum("hits").alias("hits"), F.sum("tp").alias("tp"),
        F.sum("predicted").alias("predicted"), F.min("first").alias("first"),
        F.sum("votes").alias("votes"), F.sum("vote_hits").alias("vote_hits"))
    is_source, is_label = F.col("kind") == "source", F.col("kind") == "label"
    per_batch = per_key.groupBy(batch_col).agg(
        (F.sum("hits") / F.sum("rows")).alias("_accuracy"),
        F.when(F.sum("predicted") == 0, F.lit(0.0))
         .otherwise(F.sum("tp") / F.sum("predicted")).alias("_precision"),
        sorted_map("key", F.col("first.i"), where=is_source).alias("city_indexes"),
        sorted_map("key", F.col("first.p"), where=is_source).alias("city_guesses"),
        sorted_map("key", F.when(F.col("votes") == 0, F.lit(0.0))
                           .otherwise(F.col("vote_hits") / F.col("votes")),
                   where=is_label).alias("precision_by_label"),
    )
    return per_batch.select(
        F.lit(model_type).alias("model_type"),
        F.lit(model_location).alias("model_location"),
        F.col(batch_col).alias("datetime"),
        pct_text(F.col("_accuracy")).alias("accuracy"),
        pct_text(F.col("_precision")).alias("precision"),
        "city_indexes",
        "city_guesses",
        "precision_by_label",
        F.col(batch_col),
    )


REPORT_SCHEMA = ("model_type string, model_location string, datetime string, accuracy string, "
                 "precision string, city_indexes map<string,double>, "
                 "city_guesses map<string,double>, precision_by_label map<string,double>")


def read_reports(spark, root: str, multiline: bool = False):
    """Report documents under ``root`` (``date=``/``day=`` directories are
    discovered as columns).  ``multiline`` reads pretty-printed files holding
    one document each."""
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", multiline).json(root)
