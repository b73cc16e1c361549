"""As-of joins, exact splits, wide label ranks, mergeable states, the tree as SQL."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from obslake.modeling import stages as ml
from obslake.modeling.expression import label_index, prediction, prediction_sql
from obslake.operators import incremental, ranks, split
from obslake.plans.jobs import models_of_batches, score_as_of

SOURCES = ["a", "b", "c"]


# --- as-of join ----------------------------------------------------------------

@pytest.mark.parametrize("parts", ["1", "3", "8"])
def test_asof_join_equals_brute_force(spark, parts):
    rng = random.Random(int(parts))
    left = [(i, rng.choice([None, *range(0, 60, 3)])) for i in range(200)] + [(i, 30) for i in range(200, 400)]  # a hot key
    right = [(rng.randrange(10, 50), f"r{i}") for i in range(25)] + [(None, "none"), (30, "z"), (30, "a")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = ranks.asof_join(spark.createDataFrame(left, "i int, at int"),
                              spark.createDataFrame(right, "since int, name string"), "at", "since").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

    def want(at):
        found = [r for r in right if r[0] is not None and at is not None and r[0] <= at]
        return max(found) if found else (None, None)

    assert sorted(map(tuple, got), key=lambda r: r[0]) == [(i, at, *want(at)) for i, at in left]


def test_asof_join_of_empty_sides(spark):
    left, right = spark.createDataFrame([(1, 5)], "i int, at int"), spark.createDataFrame([], "since int, name string")
    assert [tuple(r) for r in ranks.asof_join(left, right, "at", "since").collect()] == [(1, 5, None, None)]
    assert ranks.asof_join(left.limit(0), right, "at", "since").collect() == []
    with pytest.raises(ValueError, match="at"):
        ranks.asof_join(left, left, "at", "at")


# --- ranks, selection, splits ----------------------------------------------------

def test_label_ranks_equal_the_indexer_without_a_single_task(spark):
    rng = random.Random(1)
    rows = [(f"l{int(rng.expovariate(0.02))}",) for _ in range(3000)] + [(None,)] * 3
    df = spark.createDataFrame(rows, "label string")
    ranked = ranks.label_ranks(df, "label", "i")
    known = df.where("label is not null")
    want = StringIndexer(inputCol="label", outputCol="i").fit(known).transform(known).distinct()
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, want.collect()))
    assert "SinglePartition" not in ranked._jdf.queryExecution().toString()
    assert ranks.label_ranks(df.limit(0), "label", "i").collect() == []


def test_kth_smallest(spark):
    rng = random.Random(2)
    values = [rng.randrange(1 << 20) for _ in range(500)] + [7] * 50 + [0, (1 << 20) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 2, 40, 300, len(values)):
        want = sorted(values)[k - 1]
        assert ranks.kth_smallest(df, "v", k, 20, step=7) == (want, sum(v < want for v in values))


def test_exact_split_is_exact_and_stable(spark):
    rows = [(i, i % 5, None if i % 3 else "x") for i in range(1000)] + [(7, 7, "hot")] * 900 + [(8, i, "same key") for i in range(100)]
    df = spark.createDataFrame(rows, "k long, v long, t string")
    answers = []
    for d in (df, df.repartition(1), df.repartition(7)):
        out = split.exact_split(d, "k").collect()
        answers.append(sorted(map(repr, out)))
        assert sum(r.split == "train" for r in out) == int(0.8 * len(rows))
    assert answers[0] == answers[1] == answers[2]
    for share, n in ((0.0, 0), (1.0, len(rows)), (0.5, len(rows) // 2)):
        assert split.exact_split(df, "k", share).where("split = 'train'").count() == n
    assert split.exact_split(df.limit(0), "k").collect() == []


# --- completeness ------------------------------------------------------------------

def test_completeness_merges_loads_and_touches_only_their_days(spark, tmpdir_path):
    def load(rows):
        incremental.merge_completeness(spark.createDataFrame(rows, "date string, city string"), tmpdir_path)

    def state():
        return {r["date"]: r["n_sources"] for r in incremental.completeness(spark, tmpdir_path).collect()}

    def days():
        files = spark.read.parquet(f"{tmpdir_path}/seen").select("day", "_metadata.file_path").distinct().collect()
        return {(r["day"], r["file_path"]) for r in files}

    assert incremental.complete_batches(spark, tmpdir_path, 3).collect() == []
    first = [("2024-01-01_0000", "b"), ("2024-01-01_0000", "b"), ("2024-01-01_0100", "a"), ("2024-01-02_0000", "a")]
    load(first)
    assert state() == {"2024-01-01_0000": 1, "2024-01-01_0100": 1, "2024-01-02_0000": 1}
    old = days()
    load([("2024-01-01_0000", s) for s in SOURCES] + [(None, "a"), ("2024-01-01_0000", None), ("no day", "a")])
    assert state()["2024-01-01_0000"] == 3 and state()["2024-01-01_0100"] == 1
    assert {p for d, p in days() if d == dt.date(2024, 1, 2)} == {p for d, p in old if d == dt.date(2024, 1, 2)}
    after = state()
    load(first)                                    # a replay
    load([])
    assert state() == after
    assert [r["date"] for r in incremental.complete_batches(spark, tmpdir_path, 3).collect()] == ["2024-01-01_0000"]
    assert incremental.completeness(spark, tmpdir_path, [dt.date(2024, 1, 2)]).count() == 1
    plan = incremental.completeness(spark, tmpdir_path, [dt.date(2024, 1, 2)])._jdf.queryExecution().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]


# --- moments -------------------------------------------------------------------------

@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_moments_merge_without_losing_digits(spark, tmpdir_path, offset):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=900) + offset, rng.random(900) * 1e-3
    rows = [(dt.date(2024, 1, 1 + i % 9), float(a), float(b), 5.0, None if i else float("nan")) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "day date, x double, y double, c double, n double")
    parts = [df.where("day < '2024-01-04'"), df.where("day between '2024-01-04' and '2024-01-06'"), df.where("day > '2024-01-06'")]
    for i in (0, 1, 2, 1):                          # one load is replayed
        incremental.merge_moments(parts[i], tmpdir_path, f"load{i}", "day", ["x", "y", "c", "n"])
    got = {r["feature"]: r for r in incremental.merged_moments(spark, tmpdir_path).collect()}
    assert set(got) == {"x", "y", "c"} and {r["n"] for r in got.values()} == {900}
    for name, values in (("x", x), ("y", y)):
        exact = np.array(values, dtype=np.longdouble)
        assert abs(got[name]["mean"] - float(exact.mean())) <= 1e-15 * max(1.0, offset)
        assert abs(got[name]["std"] / float(exact.std(ddof=1)) - 1) < (1e-7 if offset else 1e-9)
    out = incremental.scaled(df, incremental.merged_moments(spark, tmpdir_path), ["x", "c"])
    s = out.agg(F.avg("z_x").alias("m"), F.stddev_samp("z_x").alias("s"), F.max(F.abs("z_c")).alias("c")).head()
    assert abs(s.m) < 1e-6 and abs(s.s - 1) < 1e-6 and s.c == 0.0


# --- the tree as an expression ----------------------------------------------------------

def readings(spark, n=600, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day, city = 1 + i % 20, rng.choice(SOURCES)
        rows.append((f"2024-01-{day:02d}_0000", city, rng.gauss({"a": 0, "b": 3, "c": 6}[city] + day / 4, 1.0), rng.random(), 7.0))
    return spark.createDataFrame(rows, "date string, city string, x double, y double, k double")


def test_expression_equals_transform_here_and_in_another_engine(spark):
    df = readings(spark)
    model = ml.fit(ml.build_stages(["x", "y", "k"], seed=1), df)
    both = ml.score(model, df).withColumns({"guess": prediction(model), "index": label_index(model)})
    assert both.where("guess <> prediction or index <> city_index").count() == 0
    assert both.select("guess").distinct().count() > 1
    pdf = both.select("x", "y", "k", "prediction").toPandas()
    con = duckdb.connect()
    con.register("rows", pdf)
    sql = prediction_sql(model, quote='"')
    assert con.sql(f"SELECT count(*) FROM rows WHERE ({sql}) IS DISTINCT FROM prediction").fetchall() == [(0,)]
    odd = spark.createDataFrame([(None, 1.0, 7.0, "a"), (1.0, 1.0, 7.0, "new"), (1.0, 1.0, 7.0, None)], "x double, y double, k double, city string")
    r = odd.select(prediction(model).alias("p"), label_index(model).alias("i")).collect()
    assert r[0].p is None and r[1].p is not None and [x.i for x in r[1:]] == [3.0, 3.0]


def test_score_as_of_uses_each_days_model(spark, tmpdir_path):
    df = readings(spark)
    models = {}
    for day in ("2024-01-05", "2024-01-12", "2024-01-13"):
        models[day] = ml.fit(ml.build_stages(["x", "y", "k"], seed=1), df.where(F.col("date") < day))
        ml.save_model(models[day], tmpdir_path, day)
    for per_pass in (16, 2):
        scored = score_as_of(spark, df, tmpdir_path, models_per_pass=per_pass)
        assert scored.count() == df.count()
        got = {(r["date"], r.city, r.x): (r.model_day, r.city_index, r.prediction) for r in scored.collect()}
        for day, until in (("2024-01-05", "2024-01-12"), ("2024-01-12", "2024-01-13"), ("2024-01-13", "2024-02-01")):
            own = df.where((F.col("date") >= day) & (F.col("date") < until))
            for r in ml.score(models[day], own).collect():
                assert got[r["date"], r.city, r.x] == (day, r.city_index, r.prediction)
        early = [v for k, v in got.items() if k[0] < "2024-01-05"]
        assert early and set(early) == {(None, None, None)}
    chosen = models_of_batches(spark, df, tmpdir_path)
    assert chosen.count() == 20 and chosen.where("model_day is null").count() == 4
