"""Drifting payloads, compaction of the flat table, distinct-count sketches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from obslake.operators import sketches
from obslake.sinks import compact
from obslake.sinks.table import insert_if_absent
from obslake.sources.rescue import field_counts, with_rescue


def test_rescue_keeps_whatever_was_sent(spark):
    texts = ['{"k":69}', '{"k":"69","x":{"y":[1,2.5]}}', "<html>", None, "[1]", '{"k":1.5,"z":null}', "{}", "",
             '{"k":null,"a.b":1}', '{"k":99999999999999999999}', '{"k":1,"k":2}', '{"f":1,"k":2}', '{"f":"x"}',
             '{"k":1,"t":"' + "x" * 1_000_000 + '"}']
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id int, body string, extra string")
    out = with_rescue(df, "body", {"k": "bigint", "f": "double"})
    assert out.columns == ["id", "body", "extra", "doc", "rescued"]
    got = {r[0]: r[1:] for r in out.select("id", "doc.k", "doc.f", F.to_json("rescued"), F.col("doc").isNotNull()).collect()}
    long_text = '{"t":"' + "x" * 1_000_000 + '"}'
    assert got == {
        0: (69, None, None, True), 1: (None, None, '{"k":"69","x":{"y":[1,2.5]}}', True),
        2: (None, None, '"<html>"', False), 3: (None, None, None, False), 4: (None, None, "[1]", False),
        5: (None, None, '{"k":1.5,"z":null}', True), 6: (None, None, None, True), 7: (None, None, '""', False),
        8: (None, None, '{"a.b":1}', True), 9: (None, None, '{"k":99999999999999999999}', True),
        10: (None, None, '"{\\"k\\":1,\\"k\\":2}"', False), 11: (2, 1.0, None, True),
        12: (None, None, '{"f":"x"}', True), 13: (1, None, long_text, True)}


def test_rescue_refuses_types_without_a_rule(spark):
    with pytest.raises(ValueError):
        with_rescue(spark.createDataFrame([], "body string"), "body", {"k": "map<string,int>"})


def test_rescue_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "body string")
    assert with_rescue(empty, "body", {"k": "bigint"}).count() == 0
    assert field_counts(empty, "body").count() == 0


def test_field_counts_at_every_depth(spark):
    texts = ['{"a":{"b":[{"c":1},{"c":"x"},[true]]}}', '{"a":1.5}', "no json", None, '{"d e":null}', "3"]
    got = {tuple(r) for r in field_counts(spark.createDataFrame([(t,) for t in texts], "body string"), "body").collect()}
    assert got == {("$", "OBJECT", 3), ("$", "INVALID", 1), ("$", "BIGINT", 1), ("$.a", "OBJECT", 1),
                   ("$.a", "DECIMAL", 1), ("$['d e']", "VOID", 1), ("$.a.b", "ARRAY", 1),
                   ("$.a.b[*]", "OBJECT", 2), ("$.a.b[*]", "ARRAY", 1), ("$.a.b[*].c", "BIGINT", 1),
                   ("$.a.b[*].c", "STRING", 1), ("$.a.b[*][*]", "BOOLEAN", 1)}


def _loaded(spark, path, loads=4):
    for i in range(loads):
        insert_if_absent(_readings(spark, i, loads), path, order_by=["time"])


def _readings(spark, i, loads):
    return spark.range(i, 24 * 3, loads).select(
        F.date_format(F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(id as int))"),
                      "yyyy-MM-dd_HHmm").alias("date"), F.lit("a").alias("city"), F.col("id").alias("time"))


def _rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("date", "city", "time").collect())


def _files(spark, path):
    return {str(r["day"]): r["n_files"] for r in compact.day_files(spark, path).collect()}


def test_compaction_rewrites_closed_days_once(spark, tmpdir_path):
    path = f"{tmpdir_path}/flat"
    assert compact.compact_days(spark, path, "2024-01-03") == []
    _loaded(spark, path)
    before, files = _rows(spark, path), _files(spark, path)
    assert len(before) == 72 and min(files.values()) >= 4
    open_day = {r[0] for r in spark.read.parquet(path).where("day = '2024-01-03'").select("_metadata.file_path").collect()}
    assert [str(d) for d in compact.compact_days(spark, path, "2024-01-03")] == ["2024-01-01", "2024-01-02"]
    assert _rows(spark, path) == before
    after = _files(spark, path)
    assert max(after["2024-01-01"], after["2024-01-02"]) <= 3
    assert after["2024-01-03"] == files["2024-01-03"]
    assert {r[0] for r in spark.read.parquet(path).where("day = '2024-01-03'")
            .select("_metadata.file_path").collect()} == open_day
    assert compact.compact_days(spark, path, "2024-01-03") == []
    # A replay of an old load still adds nothing, a new key is added.
    assert insert_if_absent(_readings(spark, 0, 4), path, order_by=["time"]) == 0


def test_a_compaction_lost_half_way_is_finished(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/flat"
    _loaded(spark, path)
    before, real = _rows(spark, path), compact._apply

    def lost(spark, path, staged, schema, *_):
        # One day is overwritten by a part of its rows, then the job dies.
        (spark.read.schema(schema).parquet(f"{staged}/rows").where("day = '2024-01-01'").limit(3)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))
        raise RuntimeError("lost")

    monkeypatch.setattr(compact, "_apply", lost)
    with pytest.raises(RuntimeError):
        compact.compact_days(spark, path, "2024-01-03")
    assert _rows(spark, path) != before
    monkeypatch.setattr(compact, "_apply", real)
    late = spark.createDataFrame([("2024-01-01_0030", "b", 99)], "date string, city string, time long")
    insert_if_absent(late, path, order_by=["time"])
    compact.compact_days(spark, path, "2024-01-03")
    assert _rows(spark, path) == sorted([*before, ("2024-01-01_0030", "b", 99)])
    assert not compact.recover(spark, path, spark.read.parquet(path).schema)


def test_sketches_merge_within_their_error(spark, tmpdir_path):
    rows = spark.range(60_000).select(
        F.concat(F.lit("2024-01-0"), (1 + F.col("id") % 2).cast("string"), F.lit("_0000")).alias("date"),
        F.concat(F.lit("s"), (F.col("id") % 40_000).cast("string")).alias("city"))
    state = f"{tmpdir_path}/sketches"
    for part in (rows.where("city < 's3'"), rows.where("city >= 's2'"), rows.where("city < 's3'"),
                 spark.createDataFrame([("bad", "x"), (None, "x"), ("2024-01-01_0000", None)], "date string, city string")):
        sketches.merge_sketches(part, state)
    exact = {r[0]: r[1] for r in rows.groupBy("date").agg(F.countDistinct("city")).collect()}
    got = {r[0]: r[1] for r in sketches.approximate_sources(spark, state).collect()}
    assert got.keys() == exact.keys()
    for day, n in exact.items():
        assert abs(got[day] - n) <= 4 * 1.04 / 2 ** (sketches.LG_K / 2) * n
    total = sketches.approximate_sources(spark, state, []).first()["n_sources"]
    assert abs(total - 40_000) <= 4 * 1.04 / 2 ** (sketches.LG_K / 2) * 40_000
