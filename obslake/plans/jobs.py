"""The three scheduled jobs of the reading lake, as Spark jobs.

* Load  — scan the lake, quarantine bad documents, insert new (batch, source)
  rows into the flat Parquet table exactly once per key.
* Train — complete batches of the flat table, null rows dropped, fit the
  four-stage classifier, save it under ``date=<day>`` with its metadata.
* Score — one or more batches: load the newest model saved on or before the
  batch's day, score, write one report document per batch.

Each takes paths, so the same code runs on a laptop and on a cluster; the
scheduler (cron, a workflow tool, a streaming trigger) stays outside.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslake.functions.expr import day_of_batch
from obslake.modeling import stages as ml
from obslake.modeling.expression import label_index, prediction
from obslake.modeling.report import score_report
from obslake.operators import quality
from obslake.operators import incremental
from obslake.operators.flatten import flatten
from obslake.operators.ranks import asof_join
from obslake.schema import (
    BATCH_COL, FEATURE_COLUMNS, LABEL_INDEX_COL, PARTITION_COL, RAW, SOURCE_COL,
    SOURCES_PER_BATCH,
)
from obslake.session import path_exists
from obslake.sinks.table import insert_if_absent, write_documents
from obslake.sources.lake import scan_batch, scan_lake, with_reject_reason


@dataclass
class LoadResult:
    inserted: int
    quarantined_path: str | None


def load_job(spark: SparkSession, lake_root: str, target: str,
             quarantine: str | None = None, batches: Sequence[str] | None = None) -> LoadResult:
    """Load: lake -> flat table (insert-if-absent on (date, city)).

    Rejected documents (malformed body, wrong shape, no source in the path)
    are appended to ``quarantine`` when given, never to the flat table.  The
    scan is read once: good and rejected rows are split from one persisted
    frame."""
    raw = (scan_batch(spark, lake_root, list(batches), keep_corrupt=True) if batches
           else scan_lake(spark, lake_root, keep_corrupt=True))
    flagged = with_reject_reason(raw)
    if quarantine:
        flagged = flagged.persist()
    good = flatten(flagged.where(F.col("reject_reason").isNull()))
    inserted = insert_if_absent(good, target)
    if quarantine:
        bad = flagged.where(F.col("reject_reason").isNotNull()).select(
            "file_path", BATCH_COL, "reject_reason", "_corrupt_record")
        if path_exists(spark, quarantine):
            # A rerun quarantines nothing twice: files already there are
            # skipped (the quarantine holds only rejected documents, so its
            # path column is small next to the lake).
            seen = spark.read.schema("file_path string").parquet(quarantine)
            bad = bad.join(seen, "file_path", "left_anti")
        bad.withColumn(PARTITION_COL, day_of_batch(BATCH_COL)) \
           .write.mode("append").partitionBy(PARTITION_COL).parquet(quarantine)
        flagged.unpersist()
    return LoadResult(inserted, quarantine)


def training_rows(flat: DataFrame, features: Sequence[str] = tuple(FEATURE_COLUMNS),
                  expected: int = SOURCES_PER_BATCH, strict: bool = False) -> DataFrame:
    """Rows of complete batches with no null in a feature or the label."""
    clean = quality.keep_complete(flat, expected, strict=strict)
    return quality.drop_rows_with_nulls(clean, [*features, SOURCE_COL])


def train_job(spark: SparkSession, flat_path: str, model_store: str, day: str,
              features: Sequence[str] = tuple(FEATURE_COLUMNS),
              expected: int = SOURCES_PER_BATCH, strict: bool = False,
              train_pct: int | None = None, seed: int | None = 42,
              completeness_state: str | None = None) -> str:
    """Train: fit on the flat table's complete batches, save the model and
    its metadata document; returns the model path.

    With ``completeness_state`` (see ``operators.incremental``) the complete
    batches come from the state that the loads keep, without a pass over the rows.

    With ``train_pct`` the rows are split by key hash (stable across runs and
    partitionings) and only the train side is fitted."""
    from obslake.operators.split import hash_split
    flat = spark.read.parquet(flat_path)
    if completeness_state is None:
        rows = training_rows(flat, features, expected, strict)
    else:
        keys = incremental.complete_batches(spark, completeness_state, expected)
        rows = quality.drop_rows_with_nulls(flat.join(keys, BATCH_COL, "left_semi"), [*features, SOURCE_COL])
    split_text = "None"
    if train_pct is not None:
        rows = hash_split(rows, [BATCH_COL, SOURCE_COL], train_pct).where(F.col("split") == "train")
        split_text = f"hash(date,city) {train_pct}/{100 - train_pct}"
    model, n_rows = ml.fit_counted(ml.build_stages(features, seed=seed), rows)
    path = ml.save_model(model, model_store, day)
    meta = ml.metadata_document(spark, features, n_rows, split_text)
    write_documents(meta.coalesce(1), f"{model_store.rstrip('/')}/date={day}/custom_model_metadata",
                    mode="overwrite")
    return path


def score_job(spark: SparkSession, lake_root: str, batches: Sequence[str] | None, model_store: str,
              report_root: str | None = None, schema: StructType = RAW,
              prepare: Callable[[DataFrame], DataFrame] | None = None,
              as_of_day: str | None = None) -> DataFrame:
    """Score: the given batches (all batches when None), newest model on or
    before ``as_of_day`` (default: the first batch's day), one report row per
    batch (written as JSON under ``day=`` when ``report_root`` is given, once
    per (batch, model): a rerun adds no second document).
    ``prepare`` derives model inputs from the flattened documents when they
    are not stored as-is."""
    day = as_of_day or (min(batches)[:10] if batches else None)
    path = ml.latest_model_path(spark, model_store, day)
    if path is None:
        raise FileNotFoundError(f"no model on or before {day} in {model_store}")
    model = ml.for_scoring(ml.PipelineModel.load(path))
    raw = scan_batch(spark, lake_root, list(batches), schema) if batches else scan_lake(spark, lake_root, schema)
    docs = flatten(raw)
    if prepare is not None:
        docs = prepare(docs)
    scored = model.transform(docs.dropna(subset=list(_assembler_inputs(model))))
    report = score_report(scored, path, label_col=LABEL_INDEX_COL)
    if report_root:
        out = report.withColumn(PARTITION_COL, day_of_batch(BATCH_COL))
        if path_exists(spark, report_root):
            # One report per (batch, model): a rerun or retried job writes
            # nothing twice.  Only the report days of the named batches are
            # read (taken from the batch keys, so no extra pass over the lake).
            done = spark.read.schema(
                f"datetime string, model_location string, {PARTITION_COL} date").json(report_root)
            if batches:
                days = sorted({dt.date.fromisoformat(b[:10]) for b in batches})
                done = done.where(F.col(PARTITION_COL).isin(days))
            out = out.join(done.select("datetime", "model_location"),
                           ["datetime", "model_location"], "left_anti")
        write_documents(out, report_root, partition_col=PARTITION_COL)
    return report


MODELS_PER_PASS = 16


def registry(spark: SparkSession, model_store: str) -> DataFrame:
    """(model_day, model_path) of every saved model."""
    path = f"{model_store.rstrip('/')}/_registry"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no models in {model_store}")
    return spark.read.schema("model_day string, model_path string").parquet(path)


def models_of_batches(spark: SparkSession, batches: DataFrame, model_store: str) -> DataFrame:
    """(batch, model_day, model_path): for each distinct batch key the newest
    model saved on or before its day; null where there is none yet."""
    days = (batches.select(BATCH_COL).distinct()
            .withColumn("batch_day", day_of_batch(BATCH_COL).cast("string")))
    return (asof_join(days, registry(spark, model_store), "batch_day", "model_day")
            .select(BATCH_COL, "model_day", "model_path"))


def score_as_of(spark: SparkSession, rows: DataFrame, model_store: str,
                models_per_pass: int = MODELS_PER_PASS) -> DataFrame:
    """Score over many days: every row by the newest model of its own batch's
    day, as if each batch had been scored on arrival.

    Adds ``model_day``, ``model_path``, the label index and ``prediction``;
    rows of batches before the first model, and rows with a null feature, keep
    a null prediction.  A model is one CASE expression (see
    ``modeling.expression``), so one pass over the rows serves
    ``models_per_pass`` models: each row evaluates the branch of its own."""
    chosen = models_of_batches(spark, rows, model_store)
    dated = rows.join(chosen, BATCH_COL, "left")
    used = sorted(r[0] for r in chosen.select("model_path").distinct().where("model_path is not null").collect())
    passes = [used[i:i + models_per_pass] for i in range(0, len(used), models_per_pass)]
    none = F.lit(None).cast("double")
    out = dated.where("model_path is null").withColumns({LABEL_INDEX_COL: none, "prediction": none})
    for paths in passes:
        index, guess = none, none
        for path in paths:
            model = ml.PipelineModel.load(path)
            own = F.col("model_path") == path
            index = F.when(own, label_index(model)).otherwise(index)
            guess = F.when(own, prediction(model)).otherwise(guess)
        out = out.unionByName(dated.where(F.col("model_path").isin(paths))
                              .withColumns({LABEL_INDEX_COL: index, "prediction": guess}))
    return out


def _assembler_inputs(model) -> list[str]:
    from pyspark.ml.feature import VectorAssembler
    for st in model.stages:
        if isinstance(st, VectorAssembler):
            return st.getInputCols()
    return []


def stream_load_job(spark: SparkSession, lake_root: str, target: str, checkpoint: str,
                    trigger: dict | None = None, max_files_per_trigger: int | None = None,
                    max_file_age: str = "36500d"):
    """Load as Structured Streaming: each trigger picks up only new files.

    ``max_files_per_trigger`` caps the files in one micro-batch, so a backfill
    over a large lake runs as a series of bounded micro-batches (an
    ``availableNow`` trigger still drains everything) instead of one.
    ``max_file_age``: a file older than the newest seen by more than this is
    not read; the default (100 years) leaves none out, where Spark's own (a
    week) would skip late files."""
    from obslake.streaming.ingest import start_load_stream
    reader = spark.readStream.schema(RAW).option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = (reader.json(lake_root)
              .select("*", F.col("_metadata.file_path").alias("file_path")))
    good = flatten(with_reject_reason(stream).where(F.col("reject_reason").isNull()))
    return start_load_stream(good, target, checkpoint, trigger=trigger)
