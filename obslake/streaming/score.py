"""STR-2: score each newly landed batch as it arrives."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from obslake.modeling.stages import score


def start_score_stream(model: PipelineModel, readings: DataFrame, sink_path: str,
                       checkpoint: str, trigger: dict | None = None,
                       columns: tuple[str, ...] | None = None) -> StreamingQuery:
    """Append predictions of every new reading to a Parquet table; the
    transform is a per-row projection, so no state is kept."""
    scored = score(model, readings)
    if columns:
        scored = scored.select(*columns)
    return (scored.writeStream.format("parquet")
            .option("path", sink_path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or {"availableNow": True}))
            .start())
