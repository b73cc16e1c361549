"""Property tests against brute force (pandas) on small random inputs, and
brute-force checks for the queries that have no SQL oracle."""

from __future__ import annotations

from collections import Counter

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obslake.modeling import stages as ml
from obslake.modeling.report import score_report
from obslake.operators import quality, split
from obslake.operators.dedupe import first_wins
from obslake.plans import standins as si
from tests.conftest import SF_SMALL

ROWS = st.lists(
    st.tuples(st.sampled_from(["b1", "b2", "b3"]), st.sampled_from(["x", "y", "z"]),
              st.integers(0, 5), st.integers(0, 1000)),
    min_size=0, max_size=25)
SCHEMA = "date string, city string, t int, v int"
SET = settings(max_examples=12, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


@SET
@given(ROWS)
def test_first_wins_equals_sort_then_first(spark, rows):
    got = sorted(tuple(r) for r in first_wins(spark.createDataFrame(rows, SCHEMA),
                                              ["date", "city"], ["t"]).collect())
    pdf = pd.DataFrame(rows, columns=["date", "city", "t", "v"])
    want = sorted(
        tuple(x) for x in pdf.sort_values(["date", "city", "t", "v"])
        .groupby(["date", "city"], as_index=False).first()[["date", "city", "t", "v"]]
        .itertuples(index=False, name=None)) if rows else []
    assert got == want


@SET
@given(ROWS, st.booleans())
def test_complete_batches_equals_brute_force(spark, rows, strict):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(r.date for r in quality.complete_batches(df, 3, strict=strict).collect())
    pdf = pd.DataFrame(rows, columns=["date", "city", "t", "v"])
    if not rows:
        assert got == []
        return
    sizes = pdf.groupby("date")["city"].nunique() if strict else pdf.groupby("date").size()
    assert got == sorted(sizes[sizes == 3].index)
    kept = quality.keep_complete(df, 3, strict=strict).count()
    assert kept == int(pdf["date"].isin(sizes[sizes == 3].index).sum())


def test_random_split_partitions_rows(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    train, test = split.random_split(li)
    # (l_orderkey, l_linenumber) repeats in the synthetic data: compare
    # multisets — every row lands on exactly one side.
    a = Counter(tuple(r) for r in train.collect())
    b = Counter(tuple(r) for r in test.collect())
    allrows = Counter(tuple(r) for r in li.collect())
    assert a + b == allrows
    assert 0.7 < sum(a.values()) / sum(allrows.values()) < 0.9


def test_hash_split_is_stable_under_repartition(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    a = split.hash_split(li, ["l_orderkey", "l_linenumber"]).where("split = 'train'")
    b = split.hash_split(li.repartition(7), ["l_orderkey", "l_linenumber"]).where("split = 'train'")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_tree_report_equals_brute_force(spark):
    """The report of a fitted tree (no SQL oracle) recomputed in pandas."""
    o = si.observations(spark, SF_SMALL, grain="day", columns=["value", "user_id", "props"])
    rows = si.with_event_features(o)
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=7), rows)
    scored = ml.score(model, rows).select("date", "city", "event_id", "city_index", "prediction")
    rep = {r.datetime: r for r in score_report(scored, "m", order_col="event_id").collect()}
    pdf = scored.toPandas()
    assert len(rep) == pdf["date"].nunique()
    for d, g in pdf.groupby("date"):
        r = rep[d]
        acc = (g.prediction == g.city_index).mean() * 100
        pred0 = g[g.prediction == 0.0]
        prec = 0.0 if len(pred0) == 0 else (pred0.city_index == 0.0).mean() * 100
        assert r.accuracy == f"{acc:.2f}%" and r.precision == f"{prec:.2f}%"
        labels = set(g.city_index) | set(g.prediction)
        want = {}
        for lab in labels:
            pr = g[g.prediction == lab]
            want[str(int(lab))] = 0.0 if len(pr) == 0 else float((pr.city_index == lab).mean())
        assert r.precision_by_label.keys() == want.keys()
        for k, v in want.items():
            assert r.precision_by_label[k] == pytest.approx(v, abs=1e-12)
        first = g.sort_values("event_id").groupby("city").first()
        assert r.city_indexes == first["city_index"].to_dict()
        assert r.city_guesses == first["prediction"].to_dict()


LABELED = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=0, max_size=30)


@SET
@given(LABELED)
def test_precision_by_label_equals_brute_force(spark, pairs):
    from obslake.operators import metrics
    df = spark.createDataFrame([(float(y), float(p)) for y, p in pairs], "y double, p double")
    got = {r.y: r.precision for r in metrics.precision_by_label(df, "y", "p").collect()}
    want = {}
    for v in {y for y, _ in pairs} | {p for _, p in pairs}:
        predicted = [y for y, p in pairs if p == v]
        want[float(v)] = (sum(1 for y in predicted if y == v) / len(predicted)) if predicted else 0.0
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12)
