"""Lake scan, provenance, quarantine, completeness (FIXTURES cases)."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.functions.expr import source_from_path
from obslake.operators import quality
from obslake.operators.flatten import flatten
from obslake.schema import FLAT
from obslake.sources.lake import scan_batch, scan_lake, with_reject_reason
from tests.conftest import reading

CITIES = ("miami", "nassau", "havana")
D1, D2, D3 = "2025-09-09_1500", "2025-09-09_1600", "2025-09-09_1700"


def _complete_lake(lake):
    for d in (D1, D2):
        for i, c in enumerate(CITIES):
            lake.put(d, c, reading(temp=80.0 + i))
    return lake


def test_scan_flatten_provenance(spark, lake):
    _complete_lake(lake)
    flat = flatten(scan_lake(spark, lake.root))
    assert set(flat.columns) == set(FLAT.fieldNames())
    rows = flat.select("date", "city").collect()
    assert sorted((r.date, r.city) for r in rows) == sorted((d, c) for d in (D1, D2) for c in CITIES)
    # Types are declared, not inferred.
    types = dict(flat.dtypes)
    assert types["rain"] == "double" and types["interval"] == "bigint" and types["date"] == "string"


def test_complete_and_missing_city(spark, lake):
    _complete_lake(lake)
    lake.put(D3, "miami", reading())
    lake.put(D3, "nassau", reading())
    flat = flatten(scan_lake(spark, lake.root))
    assert sorted(r.date for r in quality.complete_batches(flat, 3).collect()) == [D1, D2]
    inc = quality.incomplete_batches(flat, 3).collect()
    assert [(r.date, r.n) for r in inc] == [(D3, 2)]
    kept = quality.keep_complete(flat, 3)
    assert kept.count() == 6
    inner = quality.keep_complete(flat, 3, how="inner")
    assert inner.columns[0] == "date" and inner.count() == 6


def test_duplicate_city_fools_row_count_not_strict(spark, lake):
    lake.put(D1, "miami", reading())
    lake.put(D1, "miami", reading(temp=70.0), name="miami_again.json")
    lake.put(D1, "nassau", reading())
    flat = flatten(scan_lake(spark, lake.root))
    assert [r.date for r in quality.complete_batches(flat, 3).collect()] == [D1]
    assert quality.complete_batches(flat, 3, strict=True).count() == 0


def test_number_drift_is_one_type(spark, lake):
    lake.put(D1, "miami", '{"current": {"rain": 0}, "latitude": 1, "longitude": 2}')
    lake.put(D1, "nassau", '{"current": {"rain": 0.0}, "latitude": 1.5, "longitude": 2}')
    flat = flatten(scan_lake(spark, lake.root))
    assert dict(flat.dtypes)["rain"] == "double"
    assert sorted(r.rain for r in flat.collect()) == [0.0, 0.0]


def test_null_measurement_dropped(spark, lake):
    _complete_lake(lake)
    lake.put(D3, "miami", reading(drop=("rain",)))
    flat = flatten(scan_lake(spark, lake.root))
    assert flat.where(F.col("rain").isNull()).count() == 1
    assert quality.drop_rows_with_nulls(flat, ["rain"]).count() == 6


def test_quarantine_malformed_wrong_shape_and_bad_path(spark, lake):
    _complete_lake(lake)
    lake.put(D3, "miami", "<html><body>502 Bad Gateway</body></html>")
    lake.put(D3, "nassau", '{"error": true, "reason": "quota"}')
    lake.put(D3, "havana", reading(), name="havana.json.bak")
    raw = with_reject_reason(scan_lake(spark, lake.root, keep_corrupt=True))
    flagged = flatten(raw, carry=("date", "reject_reason"))
    reasons = {(r.date, r.city, r.reject_reason) for r in flagged.collect()}
    assert (D3, "miami", "malformed") in reasons
    assert (D3, "nassau", "missing_body") in reasons
    assert (D3, None, "no_source_in_path") in reasons
    assert flagged.where(F.col("reject_reason").isNull()).count() == 6


def test_source_regex_both_layouts(spark):
    df = spark.createDataFrame(
        [("s3a://b/data/weather/date=2025-09-09_1500/miami/miami_2025-09-09_1500.json",),
         ("file:/x/date=2025-09-09_1500/city=nassau/part-0000.json",),
         ("file:/x/date=2025-09-09_1500/havana/havana.json.bak",)], "p string")
    got = [r.c for r in df.select(source_from_path("p").alias("c")).collect()]
    assert got == ["miami", "nassau", None]


def test_batch_scan_reads_only_its_directories(spark, lake):
    _complete_lake(lake)
    df = flatten(scan_batch(spark, lake.root, D2))
    assert sorted((r.date, r.city) for r in df.collect()) == sorted((D2, c) for c in CITIES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"date={D2}" in plan and f"date={D1}" not in plan
    # Many batches, or a missing one: root scan + partition filter.
    many = flatten(scan_batch(spark, lake.root, [D1, D2, "2030-01-01_0000"], max_direct=1))
    assert many.count() == 6
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date#" in plan or "PartitionFilters: [isnotnull(date" in plan
    assert flatten(scan_batch(spark, lake.root, ["2030-01-01_0000"])).count() == 0


def test_provenance_does_not_block_pruning(spark, lake):
    _complete_lake(lake)
    df = flatten(scan_lake(spark, lake.root)).where(F.col("date") == D1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert D1 in plan.split("PartitionFilters:")[1].split("]")[0]


def test_inferred_schema_mode_and_plain_regex(spark, lake):
    lake.put(D1, "miami", '{"current": {"rain": 0}, "latitude": 1.0, "longitude": 2.0}')
    lake.put(D1, "nassau", '{"current": {"rain": 0.5}, "latitude": 1.0, "longitude": 2.0}')
    lake.put(D1, "havana", reading(), name="x.json.bak")
    df = scan_lake(spark, lake.root, schema=None)
    assert dict(df.dtypes)["date"] == "string"
    got = df.select(source_from_path("file_path", empty_as_null=False).alias("c")).collect()
    assert sorted(r.c for r in got) == ["", "miami", "nassau"]
