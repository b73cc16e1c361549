"""Golden end-to-end on a small weather lake: Load -> Train -> Score."""

from __future__ import annotations

import json
import os

from obslake.modeling.report import read_reports
from obslake.plans import jobs
from tests.conftest import reading

CITIES = {"miami": 90.0, "nassau": 80.0, "havana": 70.0}


def _fill(lake, hours):
    for h in hours:
        d = f"2025-09-09_{h:02d}00"
        for c, base in CITIES.items():
            lake.put(d, c, reading(temp=base + (h % 3), rain=0.1 * h))
    return lake


def test_load_train_score(spark, lake, tmpdir_path):
    _fill(lake, range(0, 12))
    lake.put("2025-09-09_1200", "miami", reading())            # incomplete batch
    lake.put("2025-09-09_1300", "nassau", "<html>oops</html>")  # quarantined
    flat = os.path.join(tmpdir_path, "flat")
    quar = os.path.join(tmpdir_path, "quarantine")
    r = jobs.load_job(spark, lake.root, flat, quar)
    assert r.inserted == 12 * 3 + 1
    assert spark.read.parquet(quar).count() == 1
    # Re-running the load adds nothing, to the table or the quarantine.
    assert jobs.load_job(spark, lake.root, flat).inserted == 0
    assert jobs.load_job(spark, lake.root, flat, quar).inserted == 0
    assert spark.read.parquet(quar).count() == 1

    models = os.path.join(tmpdir_path, "models")
    path = jobs.train_job(spark, flat, models, "2025-09-09")
    meta = spark.read.json(os.path.join(models, "date=2025-09-09", "custom_model_metadata")).first()
    assert meta.training_entries_count == 36 and meta.training_split_used == "None"

    # A new hour lands, with an unseen fourth city; it is scored and graded.
    lake.put("2025-09-09_1400", "miami", reading(temp=91.0))
    lake.put("2025-09-09_1400", "nassau", reading(temp=81.0))
    lake.put("2025-09-09_1400", "havana", reading(temp=71.0))
    lake.put("2025-09-09_1400", "key_west", reading(temp=85.0))
    reports = os.path.join(tmpdir_path, "reports")
    rep = jobs.score_job(spark, lake.root, ["2025-09-09_1400"], models, reports).collect()
    assert len(rep) == 1 and rep[0].model_location == path
    assert set(rep[0].city_indexes) == {"miami", "nassau", "havana", "key_west"}
    assert rep[0].city_indexes["key_west"] == 3.0   # unseen -> number of labels
    # Temperatures separate the three known cities perfectly: 3 of 4 right.
    assert rep[0].accuracy == "75.00%"
    # A rerun (or a retried job) writes no second report for the batch.
    jobs.score_job(spark, lake.root, ["2025-09-09_1400"], models, reports)
    assert read_reports(spark, reports).where("datetime = '2025-09-09_1400'").count() == 1
    files = [f for f in os.listdir(os.path.join(reports, "day=2025-09-09")) if f.endswith(".json")]
    doc = json.loads(open(os.path.join(reports, "day=2025-09-09", files[0])).readline())
    assert doc["datetime"] == "2025-09-09_1400" and doc["accuracy"] == "75.00%"


def test_stream_load_job(spark, lake, tmpdir_path):
    _fill(lake, range(0, 3))
    lake.put("2025-09-09_0300", "havana", "{\"error\": true}")
    flat = os.path.join(tmpdir_path, "flat")
    jobs.stream_load_job(spark, lake.root, flat, os.path.join(tmpdir_path, "ck")).awaitTermination()
    assert spark.read.parquet(flat).count() == 9


def test_stream_load_job_bounded_micro_batches(spark, lake, tmpdir_path):
    _fill(lake, range(0, 3))
    flat = os.path.join(tmpdir_path, "flat")
    q = jobs.stream_load_job(spark, lake.root, flat, os.path.join(tmpdir_path, "ck"),
                             max_files_per_trigger=2)
    q.awaitTermination()
    assert spark.read.parquet(flat).count() == 9
    # Nine files at two per trigger: at least five micro-batches, all drained.
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 5


def test_load_named_batches_only(spark, lake, tmpdir_path):
    _fill(lake, range(0, 4))
    lake.put("2025-09-09_0200", "miami", "<html>bad</html>", name="miami_x.json")
    flat = os.path.join(tmpdir_path, "flat")
    quar = os.path.join(tmpdir_path, "q")
    r = jobs.load_job(spark, lake.root, flat, quar, batches=["2025-09-09_0100", "2025-09-09_0200"])
    assert r.inserted == 6
    assert spark.read.parquet(quar).count() == 1
    assert {x.date for x in spark.read.parquet(flat).select("date").collect()} == {
        "2025-09-09_0100", "2025-09-09_0200"}


def test_cli_load_train_score(spark, lake, tmpdir_path, capsys):
    from obslake.__main__ import main
    _fill(lake, range(0, 6))
    flat, models, reports = (os.path.join(tmpdir_path, n) for n in ("flat", "models", "reports"))
    main(["load", "--lake", lake.root, "--target", flat])
    assert "inserted 18" in capsys.readouterr().out
    main(["train", "--flat", flat, "--models", models, "--day", "2025-09-09"])
    assert capsys.readouterr().out.strip().endswith("date=2025-09-09/model")
    main(["score", "--lake", lake.root, "--models", models, "--batch", "2025-09-09_0500",
          "--reports", reports])
    from obslake.modeling.report import read_reports
    r = read_reports(spark, reports).collect()
    assert [x.datetime for x in r] == ["2025-09-09_0500"]
    # Streaming load with bounded micro-batches, into a fresh table.
    streamed = os.path.join(tmpdir_path, "streamed")
    main(["stream-load", "--lake", lake.root, "--target", streamed,
          "--checkpoint", os.path.join(tmpdir_path, "ck"), "--max-files", "4"])
    assert spark.read.parquet(streamed).count() == 18


def test_train_with_hash_split_records_split(spark, lake, tmpdir_path):
    from obslake.operators.split import hash_split
    _fill(lake, range(0, 10))
    flat, models = os.path.join(tmpdir_path, "flat"), os.path.join(tmpdir_path, "models")
    jobs.load_job(spark, lake.root, flat)
    jobs.train_job(spark, flat, models, "2025-09-10", train_pct=70)
    meta = spark.read.json(os.path.join(models, "date=2025-09-10", "custom_model_metadata")).first()
    rows = jobs.training_rows(spark.read.parquet(flat), expected=3)
    n_train = hash_split(rows, ["date", "city"], 70).where("split = 'train'").count()
    assert meta.training_split_used == "hash(date,city) 70/30"
    assert meta.training_entries_count == n_train and 0 < n_train < 30
