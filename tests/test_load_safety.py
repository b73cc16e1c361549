"""Load with clean, rejected and oddly named documents, and null order values."""

from __future__ import annotations

import json
import os
import tempfile

from obslake.functions.expr import json_text
from obslake.operators.dedupe import first_wins
from obslake.plans.jobs import load_job, stream_load_job

from .conftest import reading


def test_clean_first_load_with_quarantine_can_be_repeated(spark, lake):
    out = tempfile.mkdtemp(prefix="obslake-out-")
    lake.put("2025-09-09_1500", "delhi", reading())
    for inserted in (1, 0):
        assert load_job(spark, lake.root, out + "/flat", quarantine=out + "/bad").inserted == inserted


def test_all_rejected_first_load_does_not_break_the_next(spark, lake):
    out = tempfile.mkdtemp(prefix="obslake-out-")
    lake.put("2025-09-09_1500", "delhi", "<html>")
    assert load_job(spark, lake.root, out + "/flat", quarantine=out + "/bad").inserted == 0
    lake.put("2025-09-09_1600", "delhi", reading())
    assert load_job(spark, lake.root, out + "/flat", quarantine=out + "/bad").inserted == 1


def test_a_batch_key_that_is_no_day_is_quarantined(spark, lake):
    out = tempfile.mkdtemp(prefix="obslake-out-")
    lake.put("2025-09-09_1500", "delhi", reading())
    lake.put("unknown", "delhi", reading())
    assert load_job(spark, lake.root, out + "/flat", quarantine=out + "/bad").inserted == 1
    assert [r.reject_reason for r in spark.read.parquet(out + "/bad").collect()] == ["bad_batch_key"]


def test_stream_load_reads_files_with_an_old_modification_time(spark, lake):
    out = tempfile.mkdtemp(prefix="obslake-out-")
    lake.put("2025-09-09_1500", "delhi", reading())
    old = lake.put("2025-09-09_1600", "delhi", reading())
    os.utime(old, (1_600_000_000, 1_600_000_000))
    stream_load_job(spark, lake.root, out + "/flat", out + "/ck", trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(out + "/flat").count() == 2


def test_null_order_value_loses(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "t", "b"), (2, None, "c")], "k int, t string, v string")
    assert {r.k: r.v for r in first_wins(df, ["k"], ["t"]).collect()} == {1: "b", 2: "c"}


def test_null_fields_stay_in_json(spark):
    row = spark.createDataFrame([(1, None)], "a int, b string").select(json_text("a", "b").alias("j")).head()
    assert json.loads(row.j) == {"a": 1, "b": None}
