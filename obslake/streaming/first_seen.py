"""STR-4 at once: the first reading of a key is emitted in the micro-batch
that brings it, and the key is remembered for a time to live."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructField, StructType, TimestampType, VariantType

from obslake.schema import KEY_COLUMNS

HELD_ROWS = 100_000  # candidates that a task holds before it passes them on


def _first_of_each(rows: pa.Table, keys: list[str], order: list[str]) -> pa.Table:
    """The first row of each key by ``order``, nulls last."""
    at = pc.sort_indices(rows, [(c, "ascending") for c in order], null_placement="at_end") if order else None
    rows = rows if at is None else rows.take(at)
    place = pa.table({**{f"k{i}": rows[c] for i, c in enumerate(keys)}, "place": pa.array(range(rows.num_rows))})
    # Arrow's own threads don't survive the fork of a Python worker.
    first = place.group_by([f"k{i}" for i in range(len(keys))], use_threads=False).aggregate([("place", "min")])
    return rows.take(first["place_min"])


def _rank(row: dict, order: list[str]) -> tuple:
    """Sorts as Spark does: values, then NaN, then null."""
    out = []
    for c in order:
        value = row[c]
        kind = 2 if value is None else 1 if value != value else 0
        out.append((kind, None if kind else value))
    return tuple(out)


def first_seen_stream(readings: DataFrame, event_time: str, order_by: Sequence[str],
                      keys: Sequence[str] = tuple(KEY_COLUMNS), delay: str = "48 hours",
                      ttl_hours: float = 48) -> DataFrame:
    """The first reading of each key, at once.

    Of the rows of one micro-batch the smallest by ``order_by`` wins (nulls
    last, ties by the other columns of simple types); rows of a key in later
    micro-batches are repeats, until the watermark is ``ttl_hours`` past the
    newest of its rows that reached the state.  No window has to close: a late
    row of a new key is emitted, unless it is later than ``delay``.

    Before the shuffle each task reduces its rows to one a key, holding
    at most ``HELD_ROWS`` keys at a time, so a key with a third of the rows
    reaches its state as a few rows a task, packed so that every type stays
    exact.  The state is one flag a live key.
    Null keys are a key of their own.  An empty micro-batch emits nothing."""
    keys = list(keys)
    plain = [f.name for f in readings.schema.fields
             if not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    key_schema = readings.select(*keys).schema
    order = list(dict.fromkeys([c for c in order_by if c not in keys] + [c for c in plain if c not in keys]))

    ttl_ms = int(ttl_hours * 3_600_000)
    arrow_schema = to_arrow_schema(readings.schema)

    def packed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        body = pa.array([pickle.dumps(r) for r in rows.drop_columns("_et").to_pylist()], pa.binary())
        yield from pa.table([*[rows[c] for c in keys], rows["_et"], body], names=[*keys, "_et", "_row"]).to_batches()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = _first_of_each(rows if held is None else pa.concat_tables([held, rows]), keys, order)
            if held.num_rows > HELD_ROWS:
                yield from packed(held)
                held = None
        if held is not None:
            yield from packed(held)

    def first_seen(key, frames, state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        new, best, newest = not state.exists, None, state.getCurrentWatermarkMs()
        for frame in frames:
            times = frame["_et"].dropna()
            if len(times):
                newest = max(newest, int(times.max().timestamp() * 1000))
            if new:
                rows = [pickle.loads(r) for r in frame["_row"]]
                best = min(rows if best is None else [best, *rows], key=lambda r: _rank(r, order))
        state.update((True,))
        state.setTimeoutTimestamp(newest + ttl_ms)
        if new:
            yield pd.DataFrame({"_row": [pickle.dumps(best)]})

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pickle.loads(r) for r in batch.column(0).to_pylist()]
            yield from pa.Table.from_pylist(rows, schema=arrow_schema).to_batches()

    timed = readings.withColumn("_et", F.col(event_time).cast("timestamp"))
    packed_schema = StructType([*key_schema.fields, StructField("_et", TimestampType()), StructField("_row", BinaryType())])
    return (timed.mapInArrow(combine, packed_schema).withWatermark("_et", delay).groupBy(*keys)
            .applyInPandasWithState(first_seen, "_row binary", "seen boolean", "append", GroupStateTimeout.EventTimeTimeout)
            .mapInArrow(unpacked, readings.schema))


def start_first_seen_stream(readings: DataFrame, out_path: str, checkpoint: str, event_time: str,
                            order_by: Sequence[str], keys: Sequence[str] = tuple(KEY_COLUMNS),
                            delay: str = "48 hours", ttl_hours: float = 48,
                            trigger: dict | None = None) -> StreamingQuery:
    """Append each key's first reading to a Parquet table, once (the file sink
    commits a micro-batch once, however often it is tried)."""
    return (first_seen_stream(readings, event_time, order_by, keys, delay, ttl_hours).writeStream.format("parquet")
            .option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"availableNow": True})).start())
