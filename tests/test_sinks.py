"""Keyed insert-if-absent, landing round trip, documents."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from obslake.operators.dedupe import first_wins
from obslake.operators.flatten import flatten
from obslake.sinks.lake import land_documents
from obslake.sinks.table import insert_if_absent, write_documents
from obslake.sources.lake import scan_lake
from tests.conftest import reading

D1, D2 = "2025-09-09_1500", "2025-09-09_1600"


def test_insert_if_absent_first_wins_and_replay(spark, lake, tmpdir_path):
    lake.put(D1, "miami", reading(temp=1.0))
    lake.put(D1, "miami", reading(temp=2.0), name="miami_z.json")
    lake.put(D1, "nassau", reading(temp=3.0))
    target = os.path.join(tmpdir_path, "flat")
    flat = flatten(scan_lake(spark, lake.root))
    assert insert_if_absent(flat, target) == 2
    got = {(r.city, r.temperature_2m) for r in spark.read.parquet(target).collect()}
    # file_path order: miami_2025... < miami_z.json
    assert got == {("miami", 1.0), ("nassau", 3.0)}
    # Replay adds nothing.
    assert insert_if_absent(flat, target) == 0
    assert spark.read.parquet(target).count() == 2
    # A later batch with one new key and one old key inserts only the new one.
    lake.put(D2, "havana", reading(temp=9.0))
    flat2 = flatten(scan_lake(spark, lake.root))
    assert insert_if_absent(flat2, target) == 1
    t = spark.read.parquet(target)
    assert t.count() == 3 and "day" in t.columns


def test_null_key_never_inserted(spark, lake, tmpdir_path):
    lake.put(D1, "miami", reading())
    lake.put(D1, "nassau", reading(), name="bad.json.bak")
    target = os.path.join(tmpdir_path, "flat")
    assert insert_if_absent(flatten(scan_lake(spark, lake.root)), target) == 1


def test_first_wins_deterministic_on_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "w"), ("a", 2, "a"), ("b", 5, "q")],
                               "k string, t int, v string")
    got = sorted(tuple(r) for r in first_wins(df, ["k"], ["t"]).collect())
    assert got == [("a", 1, "w"), ("b", 5, "q")]


def test_land_and_rescan_round_trip(spark, tmpdir_path):
    docs = spark.createDataFrame(
        [(D1, "miami", 1.0), (D1, "nassau", 2.0), (D2, "miami", 3.0)],
        "date string, city string, rain double",
    ).select(F.struct("rain").alias("current"), "date", "city")
    root = os.path.join(tmpdir_path, "lake")
    land_documents(docs, root)
    back = flatten(scan_lake(spark, root, schema="current struct<rain double>, date string"))
    assert sorted((r.date, r.city, r.rain) for r in back.collect()) == [
        (D1, "miami", 1.0), (D1, "nassau", 2.0), (D2, "miami", 3.0)]


def test_documents_partitioned(spark, tmpdir_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "day string, v int")
    out = os.path.join(tmpdir_path, "docs")
    write_documents(df, out, partition_col="day")
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == ["_SUCCESS", "day=a", "day=b"]


def test_insert_across_days_keeps_untouched_days_and_skips_known_keys(spark, tmpdir_path):
    """The target is read only for the days a batch touches; keys there are
    skipped, other days are left as they are, an empty batch inserts 0."""
    cols = "date string, city string, time string, v double"
    target = os.path.join(tmpdir_path, "flat")
    first = spark.createDataFrame(
        [("2025-09-01_0000", "miami", "t1", 1.0), ("2025-09-02_0000", "miami", "t1", 2.0),
         ("2025-09-03_0000", "miami", "t1", 3.0)], cols)
    assert insert_if_absent(first, target, order_by=("time",)) == 3
    batch = spark.createDataFrame(
        [("2025-09-02_0000", "miami", "t0", 20.0),     # known key: skipped (first wins)
         ("2025-09-02_0000", "nassau", "t1", 21.0),    # new key on a known day
         ("2025-09-04_0000", "miami", "t1", 40.0),     # new day
         ("2025-09-04_0000", "miami", "t2", 41.0)],    # same key, later: deduplicated
        cols)
    assert insert_if_absent(batch, target, order_by=("time",)) == 2
    got = sorted((r.date, r.city, r.v) for r in spark.read.parquet(target).collect())
    assert got == [("2025-09-01_0000", "miami", 1.0), ("2025-09-02_0000", "miami", 2.0),
                   ("2025-09-02_0000", "nassau", 21.0), ("2025-09-03_0000", "miami", 3.0),
                   ("2025-09-04_0000", "miami", 40.0)]
    assert insert_if_absent(batch.limit(0), target, order_by=("time",)) == 0
    assert insert_if_absent(batch, target, order_by=("time",)) == 0
    assert spark.read.parquet(target).count() == 5
