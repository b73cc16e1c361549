"""Score-on-arrival: each micro-batch of readings is scored into a keyed
table, and every batch that this micro-batch completes gets its report once.

This is the streaming form of the hourly Land -> Score chain: a batch is
graded as soon as all of its sources have landed, not on a clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from obslake.functions.expr import day_of_batch
from obslake.modeling.report import score_report
from obslake.modeling.stages import for_scoring
from obslake.schema import BATCH_COL, KEY_COLUMNS, PARTITION_COL, SOURCES_PER_BATCH
from obslake.session import path_exists
from obslake.sinks.table import insert_if_absent, write_documents


def _new_reports(scored_table: DataFrame, touched: DataFrame, expected: int,
                 model_location: str, order_col: str) -> DataFrame:
    """Reports of the touched batches that now hold ``expected`` sources."""
    rows = scored_table.join(touched, [PARTITION_COL, BATCH_COL], "left_semi")
    complete = (rows.groupBy(BATCH_COL).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") == expected).select(BATCH_COL))
    graded = rows.join(complete, BATCH_COL, "left_semi")
    return score_report(graded, model_location, order_col=order_col)


def start_report_stream(model: PipelineModel, readings: DataFrame, scored_path: str,
                        report_path: str, checkpoint: str, model_location: str,
                        expected: int = SOURCES_PER_BATCH,
                        order_by: Sequence[str] = ("file_path", "time"),
                        keep: Sequence[str] | None = None,
                        trigger: dict | None = None) -> StreamingQuery:
    """Per micro-batch:

    1. score the new readings and insert them into ``scored_path`` once per
       (batch, source) (first wins, replay-safe);
    2. for the batches this micro-batch touched, read their rows back from
       the scored table (partition-pruned to their days) and keep those with
       all ``expected`` sources;
    3. append a report for each such batch not reported before (anti-join on
       the batch key against the reports of the touched days).

    Every step is a partial aggregate or a semi/anti-join on batch keys; no
    state is kept in the stream itself, so restarts and replays are safe."""
    model = for_scoring(model)

    def run(batch: DataFrame, _id: int) -> None:
        batch.persist()
        try:
            scored = model.transform(batch)
            cols = list(dict.fromkeys([*KEY_COLUMNS, *order_by, *(keep or []),
                                       "city_index", "prediction"]))
            insert_if_absent(scored.select(*cols), scored_path, order_by=order_by)
            spark = batch.sparkSession
            touched = batch.select(BATCH_COL).distinct() \
                .withColumn(PARTITION_COL, day_of_batch(BATCH_COL))
            # The days this micro-batch touched: one value per day it spans.
            # As a literal IN list they prune the scored table and the
            # reports to those days' partitions, so a micro-batch never reads
            # the whole history.
            days = [r[0] for r in touched.select(PARTITION_COL).distinct().collect()]
            scored_days = spark.read.parquet(scored_path).where(F.col(PARTITION_COL).isin(days))
            reports = _new_reports(scored_days, touched, expected, model_location, order_by[0])
            reports = reports.withColumn(PARTITION_COL, day_of_batch(BATCH_COL))
            if path_exists(spark, report_path):
                done = (spark.read.schema(f"{BATCH_COL} string, {PARTITION_COL} date")
                        .json(report_path)
                        .where(F.col(PARTITION_COL).isin(days))
                        .select(BATCH_COL))
                reports = reports.join(done, BATCH_COL, "left_anti")
            write_documents(reports, report_path, partition_col=PARTITION_COL)
        finally:
            batch.unpersist()

    return (readings.writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start())
