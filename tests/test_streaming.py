"""Streaming forms equal the batch answers; late data and replays."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from obslake.operators.flatten import flatten
from obslake.sinks.table import insert_if_absent
from obslake.sources.lake import scan_lake
from obslake.schema import RAW
from obslake.streaming import batch_completeness, dedupe_stream, start_load_stream
from tests.conftest import reading


def test_stream_load_equals_batch_and_replay_adds_nothing(spark, lake, tmpdir_path):
    for d in ("2025-09-09_1500", "2025-09-09_1600"):
        for c in ("miami", "nassau", "havana"):
            lake.put(d, c, reading())
    lake.put("2025-09-09_1600", "miami", reading(temp=1.0), name="miami_zz.json")
    target = os.path.join(tmpdir_path, "flat")
    stream = (spark.readStream.schema(RAW).option("maxFilesPerTrigger", 2).json(lake.root)
              .select("*", F.col("_metadata.file_path").alias("file_path")))
    q = start_load_stream(flatten(stream), target, os.path.join(tmpdir_path, "ck1"))
    q.awaitTermination()
    t = spark.read.parquet(target)
    assert t.count() == 6
    batch_target = os.path.join(tmpdir_path, "flat_batch")
    insert_if_absent(flatten(scan_lake(spark, lake.root)), batch_target)
    cols = ["date", "city", "temperature_2m"]
    assert sorted(t.select(cols).collect()) == sorted(spark.read.parquet(batch_target).select(cols).collect())
    # Same files again under a fresh checkpoint: every key exists, nothing added.
    stream2 = (spark.readStream.schema(RAW).json(lake.root)
               .select("*", F.col("_metadata.file_path").alias("file_path")))
    start_load_stream(flatten(stream2), target, os.path.join(tmpdir_path, "ck2")).awaitTermination()
    assert spark.read.parquet(target).count() == 6


def _write_events(spark, path, rows):
    spark.createDataFrame(rows, "ts string, city string").select(
        F.to_timestamp("ts").cast("timestamp_ntz").alias("ts"), "city"
    ).coalesce(1).write.mode("overwrite").parquet(path)


def test_completeness_window_drops_late_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "events")
    _write_events(spark, os.path.join(src, "f1"),
                  [("2024-01-01 10:05:00", "a"), ("2024-01-01 10:20:00", "b"),
                   ("2024-01-01 13:10:00", "a")])
    _write_events(spark, os.path.join(src, "f2"),
                  [("2024-01-01 13:40:00", "b"), ("2024-01-01 17:00:00", "a")])
    # Late rows are judged against the previous micro-batch's watermark
    # (12:10 after f1's batch), so the late row comes in a third batch.
    _write_events(spark, os.path.join(src, "f3"),
                  [("2024-01-01 09:30:00", "c"), ("2024-01-01 17:10:00", "b")])
    schema = "ts timestamp_ntz, city string"
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(src))
    res = batch_completeness(s, "ts", "city", "1 hour", "1 hour", expected=2)
    out = os.path.join(tmpdir_path, "out")
    q = (res.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.batch, r.n_sources) for r in spark.read.parquet(out).collect()}
    # 10:00 closed with a and b; the late 09:30 row never opens a window.
    assert ("2024-01-01_1000", 2) in got
    assert not any(b == "2024-01-01_0900" for b, _ in got)


def test_dedupe_within_watermark(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "ev")
    _write_events(spark, src, [("2024-01-01 10:05:00", "a"), ("2024-01-01 10:06:00", "a"),
                               ("2024-01-01 10:07:00", "b")])
    s = spark.readStream.schema("ts timestamp_ntz, city string").parquet(src) \
        .withColumn("date", F.lit("2024-01-01_1000")).withColumn("et", F.col("ts").cast("timestamp"))
    d = dedupe_stream(s, "et", "2 hours").select("date", "city")
    out = os.path.join(tmpdir_path, "o")
    (d.writeStream.format("parquet").option("path", out)
       .option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
       .trigger(availableNow=True).start().awaitTermination())
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [
        ("2024-01-01_1000", "a"), ("2024-01-01_1000", "b")]


def test_report_stream_reports_each_batch_once_when_complete(spark, lake, tmpdir_path):
    from obslake.modeling import stages as ml
    from obslake.modeling.report import read_reports
    from obslake.plans import jobs
    from obslake.streaming.reports import start_report_stream
    temps = {"miami": 90.0, "nassau": 80.0, "havana": 70.0}
    for h in range(6):
        for c, t in temps.items():
            lake.put(f"2025-09-09_0{h}00", c, reading(temp=t + h % 2))
    flat = os.path.join(tmpdir_path, "flat")
    jobs.load_job(spark, lake.root, flat)
    model = ml.fit(ml.build_stages(seed=1), jobs.training_rows(spark.read.parquet(flat), expected=3))

    live = os.path.join(tmpdir_path, "live")
    from tests.conftest import Lake
    live_lake = Lake(live)
    scored, reports, ck = (os.path.join(tmpdir_path, n) for n in ("scored", "reports", "ck"))

    def run():
        s = (spark.readStream.schema(RAW).option("maxFilesPerTrigger", 2).json(live)
             .select("*", F.col("_metadata.file_path").alias("file_path")))
        start_report_stream(model, flatten(s), scored, reports, ck, "m", expected=3).awaitTermination()

    live_lake.put("2025-09-10_0000", "miami", reading(temp=90.0))
    live_lake.put("2025-09-10_0000", "nassau", reading(temp=80.0))
    run()
    import glob
    assert not glob.glob(os.path.join(reports, "day=*"))   # incomplete: no report yet
    live_lake.put("2025-09-10_0000", "havana", reading(temp=70.0))
    live_lake.put("2025-09-10_0100", "havana", reading(temp=70.0))
    run()
    rep = read_reports(spark, reports).collect()
    assert [r.datetime for r in rep] == ["2025-09-10_0000"] and rep[0].accuracy == "100.00%"
    # Same files again under a new checkpoint: no second report.
    ck = os.path.join(tmpdir_path, "ck2")
    run()
    assert read_reports(spark, reports).count() == 1


def test_first_wins_stream_is_exact_and_emits_closed_hours_once(spark, tmpdir_path):
    """Per key the smallest (ts, v) row, like the batch first-wins; a key is
    emitted once its hour closes; a reading later than the delay is ignored."""
    from obslake.operators.dedupe import first_wins
    from obslake.streaming import first_wins_stream
    src = os.path.join(tmpdir_path, "ev")

    def put(name, rows):
        spark.createDataFrame(rows, "ts string, city string, v int").select(
            F.to_timestamp("ts").cast("timestamp_ntz").alias("ts"), "city", "v",
            F.date_format(F.to_timestamp("ts"), "yyyy-MM-dd_HH00").alias("date"),
        ).coalesce(1).write.mode("overwrite").parquet(os.path.join(src, name))

    # A hot key: many readings of (10:00, a), the smallest ts wins (tie on ts
    # broken by v).
    put("f1", [("2024-01-01 10:30:00", "a", 5), ("2024-01-01 10:05:00", "a", 9),
               ("2024-01-01 10:05:00", "a", 7), ("2024-01-01 10:50:00", "a", 1),
               ("2024-01-01 10:20:00", "b", 3), ("2024-01-01 11:10:00", "a", 4)])
    # Moves the watermark to 13:30 - 1h: the 10:00 and 11:00 hours close.
    put("f2", [("2024-01-01 13:30:00", "b", 8)])
    # Later than the watermark: ignored.  13:00 stays open (not emitted).
    put("f3", [("2024-01-01 10:40:00", "a", 0)])
    schema = "ts timestamp_ntz, city string, v int, date string"
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
         .option("recursiveFileLookup", "true").parquet(src))
    out = os.path.join(tmpdir_path, "o")
    (first_wins_stream(s, "ts", ["ts", "v"], delay="1 hour").writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
        .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    got = sorted((r.date, r.city, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01_1000", "a", 7), ("2024-01-01_1000", "b", 3),
                   ("2024-01-01_1100", "a", 4)]
    # The same rule in batch over the emitted hours gives the same rows.
    batch = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(src) \
        .where(F.col("date") < "2024-01-01_1300").where(F.col("v") != 0)
    want = sorted((r.date, r.city, r.v) for r in first_wins(batch, ["date", "city"], ["ts", "v"]).collect())
    assert got == want
