"""First-wins at once: emitted when first seen, once per time to live."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from obslake.streaming import first_seen, start_first_seen_stream
SCHEMA = "ts timestamp_ntz, city string, v int, extra struct<a: int>, date string"


class Source:
    def __init__(self, spark, root):
        self.spark, self.src = spark, os.path.join(root, "in")
        self.out, self.checkpoint = os.path.join(root, "out"), os.path.join(root, "ck")

    def put(self, name, rows):
        (self.spark.createDataFrame(rows, "ts string, city string, v int").select(
            F.to_timestamp("ts").cast("timestamp_ntz").alias("ts"), "city", "v", F.struct(F.col("v").alias("a")).alias("extra"),
            F.date_format(F.to_timestamp("ts"), "yyyy-MM-dd_HH00").alias("date"))
         .coalesce(1).write.parquet(os.path.join(self.src, name)))

    def run(self, **options):
        s = (self.spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.src))
        start_first_seen_stream(s, self.out, self.checkpoint, "ts", ["ts", "v"],
                                **{"delay": "96 hours", **options}).awaitTermination()
        rows = self.spark.read.schema(SCHEMA).parquet(self.out).collect()
        return sorted(((r.date, r.city, r.v, r.extra.a) for r in rows), key=str)


@pytest.fixture()
def source(spark, tmpdir_path):
    return Source(spark, tmpdir_path)


def test_each_key_is_emitted_once_when_first_seen(source):
    hot = [("2024-01-01 10:05:00", "a", v) for v in range(500, 0, -1)]
    source.put("f1", [*hot, ("2024-01-01 10:05:00", "a", None), ("2024-01-01 10:20:00", "b", 3),
                      ("2024-01-01 10:10:00", None, 6), ("2024-01-01 10:09:00", None, None)])
    first = [("2024-01-01_1000", "a", 1, 1), ("2024-01-01_1000", "b", 3, 3), ("2024-01-01_1000", None, None, None)]
    assert source.run() == sorted(first, key=str)          # at once: no hour has closed
    # Repeats, an earlier row of a known key, and a late row of a new key.
    source.put("f2", [("2024-01-01 10:01:00", "a", 9), ("2024-01-03 11:00:00", "b", 5)])
    source.put("f3", [("2024-01-01 08:00:00", "c", 4), ("2024-01-01 10:05:00", "a", 1)])
    more = [*first, ("2024-01-03_1100", "b", 5, 5), ("2024-01-01_0800", "c", 4, 4)]
    assert source.run() == sorted(more, key=str)
    assert source.run() == sorted(more, key=str)            # nothing new: nothing emitted


def test_replayed_files_and_small_holds_change_nothing(source, monkeypatch):
    monkeypatch.setattr(first_seen, "HELD_ROWS", 2)
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:00", c, h * m) for h in range(6) for m in (50, 10, 30) for c in "abc"]
    source.put("f1", rows)
    want = sorted((f"2024-01-01_{h:02d}00", c, h * 10, h * 10) for h in range(6) for c in "abc")
    assert source.run() == want
    source.put("again", rows)
    assert source.run() == want


def test_a_key_may_return_after_its_time_to_live(source):
    options = {"keys": ["city"], "delay": "0 seconds", "ttl_hours": 1}
    source.put("f1", [("2024-01-01 10:05:00", "a", 1)])
    assert len(source.run(**options)) == 1
    source.put("f2", [("2024-01-01 10:50:00", "a", 9), ("2024-01-01 12:00:00", "b", 2)])   # 12:00: a's time is over
    assert len(source.run(**options)) == 2
    source.put("f3", [("2024-01-01 12:30:00", "a", 3), ("2024-01-01 11:00:00", "c", 4)])   # c is too late
    assert sorted(r[2] for r in source.run(**options)) == [1, 2, 3]
