"""STR-3: batch completeness as event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.expr import batch_key
from obslake.schema import SOURCE_COL


def batch_completeness(readings: DataFrame, event_time: str, source_col: str = SOURCE_COL,
                       window: str = "1 hour", delay: str = "2 hours",
                       expected: int | None = None) -> DataFrame:
    """Distinct sources per tumbling window, with a watermark bounding how
    late a reading may arrive.

    ``withWatermark`` needs a TIMESTAMP (not TIMESTAMP_NTZ) column, so the
    event time is cast; the window start is cast back before formatting so the
    batch key is the original wall-clock hour.  The per-window state is a set
    of sources (bounded by the number of sources).

    Run it in ``append`` mode in production: a window is emitted once the
    watermark passes its end and its state is dropped then.  ``complete`` mode
    (used only to compare with a batch answer) keeps every window's state."""
    ts = F.col(event_time).cast("timestamp")
    df = readings.withColumn("_et", ts).withWatermark("_et", delay)
    out = df.groupBy(F.window("_et", window).alias("w")).agg(
        F.size(F.collect_set(source_col)).alias("n_sources"))
    out = out.select(batch_key(F.col("w.start").cast("timestamp_ntz")).alias("batch"),
                     F.col("n_sources"))
    if expected is not None:
        out = out.withColumn("complete", F.col("n_sources") == expected)
    return out
