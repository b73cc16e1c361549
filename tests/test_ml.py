"""ML invariants: index order, scaling, evaluator parity, save/load, report."""

from __future__ import annotations

import os

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from obslake.modeling import stages as ml
from obslake.modeling.report import score_report
from obslake.operators import metrics
from obslake.plans import standins as si
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def training(spark):
    from obslake.operators import quality
    o = si.observations(spark, SF_SMALL, grain="day", columns=["value", "user_id", "props"])
    return si.with_event_features(quality.keep_complete(o, 5)).cache()


def test_label_index_is_frequency_order(spark):
    df = spark.createDataFrame([(c,) for c in "bbbaaacd"], "city string")
    t = {r.city: r.city_index for r in ml.label_index_table(df, "city").collect()}
    # a and b tie at 3: alphabetical; c and d tie at 1.
    assert t == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}


def test_scaler_moments_and_constant_column(spark):
    li = si.lineitem_features(spark, SF_SMALL)
    v = VectorAssembler(inputCols=si.LINEITEM_FEATURES, outputCol="raw").transform(li)
    m = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True).fit(v)
    stats = {r.feature: (r.mean, r.std) for r in metrics.feature_moments(li, si.LINEITEM_FEATURES).collect()}
    for i, f in enumerate(si.LINEITEM_FEATURES):
        assert m.mean[i] == pytest.approx(stats[f][0], rel=1e-9, abs=1e-12)
        assert m.std[i] == pytest.approx(stats[f][1], rel=1e-9, abs=1e-12)
    z = m.transform(v).select(vector_to_array("z").alias("z"))
    agg = z.agg(*[F.avg(F.col("z")[i]).alias(f"m{i}") for i in range(5)],
                *[F.stddev_samp(F.col("z")[i]).alias(f"s{i}") for i in range(5)]).first()
    for i in range(4):
        assert abs(agg[f"m{i}"]) < 1e-9 and agg[f"s{i}"] == pytest.approx(1.0, rel=1e-9)
    assert agg["m4"] == 0.0 and agg["s4"] == 0.0  # constant interval -> 0.0


def test_evaluator_parity(spark):
    s = si.lineitem_features(spark, SF_SMALL)
    from pyspark.ml.feature import StringIndexer
    s = StringIndexer(inputCol="l_returnflag", outputCol="y").fit(s).transform(s) \
        .withColumn("p", si.quantity_band_prediction())
    acc = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p",
                                            metricName="accuracy").evaluate(s)
    ours = metrics.accuracy(s, "y", "p").first()["accuracy"]
    assert ours == pytest.approx(acc, abs=1e-12)
    prec = {r.y: r.precision for r in metrics.precision_by_label(s, "y", "p").collect()}
    for lab in (0.0, 1.0, 2.0):
        ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p",
                                               metricName="precisionByLabel", metricLabel=lab)
        assert prec[lab] == pytest.approx(ev.evaluate(s), abs=1e-12)


def test_precision_zero_when_label_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (2.0, 2.0)], "y double, p double")
    prec = {r.y: r.precision for r in metrics.precision_by_label(df, "y", "p").collect()}
    assert prec[0.0] == 0.0 and prec[1.0] == 0.5 and prec[2.0] == 1.0


def test_fit_save_load_identical_and_latest_resolver(spark, training, tmpdir_path):
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), training)
    store = os.path.join(tmpdir_path, "models")
    p1 = ml.save_model(model, store, "2024-01-10")
    p2 = ml.save_model(model, store, "2024-01-20")
    assert ml.save_model(model, store, "2024-01-20") == p2      # rerun of a day
    assert spark.read.parquet(os.path.join(store, "_registry")).count() == 2
    assert ml.latest_model_path(spark, store, "2024-01-15") == p1
    assert ml.latest_model_path(spark, store) == p2
    assert ml.latest_model_path(spark, store, "2023-12-31") is None
    loaded = ml.load_model(spark, store, "2024-01-25")
    a = ml.score(model, training).select("event_id", "prediction")
    b = ml.score(loaded, training).select("event_id", F.col("prediction").alias("p2"))
    assert a.join(b, "event_id").where("prediction != p2").count() == 0
    meta = ml.training_metadata(training, si.EVENT_FEATURES).first()
    assert meta.training_entries_count == training.count()
    assert meta.input_columns == si.EVENT_FEATURES and meta.paramGridBuilderValues is None


def test_unseen_source_scores_with_keep(spark, training):
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), training)
    n_labels = len(ml.label_order(model))
    new = training.limit(1).withColumn("city", F.lit("atlantis"))
    row = ml.score(model, new).select("city_index", "prediction").first()
    assert row.city_index == float(n_labels) and row.prediction is not None


def test_null_feature_fails_assembler(spark, training):
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), training)
    bad = training.limit(1).withColumn("value", F.lit(None).cast("double"))
    with pytest.raises(Exception):
        ml.score(model, bad).collect()


def test_report_three_rows(spark):
    scored = spark.createDataFrame(
        [("b1", "miami", "f1", 1.0, 1.0), ("b1", "nassau", "f2", 2.0, 1.0),
         ("b1", "havana", "f3", 0.0, 2.0)],
        "date string, city string, file_path string, city_index double, prediction double")
    r = score_report(scored, "m").first()
    assert r.accuracy == "33.33%" and r.precision == "0.00%"
    assert r.city_indexes == {"havana": 0.0, "miami": 1.0, "nassau": 2.0}
    assert r.city_guesses == {"havana": 2.0, "miami": 1.0, "nassau": 1.0}
    # Label 0 never predicted -> 0.0; label 1 predicted twice, right once.
    assert r.precision_by_label == {"0": 0.0, "1": 0.5, "2": 0.0}


def test_models_without_registry_are_discovered(spark, training, tmpdir_path):
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), training)
    store = os.path.join(tmpdir_path, "models")
    for day in ("2025-09-01", "2025-09-09"):
        model.write().overwrite().save(f"{store}/date={day}/model")
    assert ml.latest_model_path(spark, store, "2025-09-05") == f"{store}/date=2025-09-01/model"
    assert ml.latest_model_path(spark, store) == f"{store}/date=2025-09-09/model"
    assert ml.latest_model_path(spark, os.path.join(tmpdir_path, "nothing")) is None


def test_read_pretty_printed_documents(spark, tmpdir_path):
    import json
    from obslake.modeling.report import read_reports
    d = os.path.join(tmpdir_path, "reports", "hourly", "date=2025-09-09_1500")
    os.makedirs(d)
    doc = {"model_type": "PipelineModel", "model_location": "m", "datetime": "2025-09-09_1500",
           "accuracy": "66.67%", "precision": "100.00%",
           "city_indexes": {"miami": 0.0, "nassau": 1.0, "havana": 2.0},
           "city_guesses": {"miami": 0.0, "nassau": 2.0, "havana": 2.0}}
    with open(os.path.join(d, "2025-09-09_1500_report.json"), "w") as f:
        f.write(json.dumps(doc, indent=2))
    r = read_reports(spark, os.path.join(tmpdir_path, "reports", "hourly"), multiline=True).first()
    assert r.date == "2025-09-09_1500" and r.city_guesses["nassau"] == 2.0
    m = os.path.join(tmpdir_path, "meta")
    os.makedirs(m)
    with open(os.path.join(m, "custom_model_metadata.json"), "w") as f:
        f.write(json.dumps({"input_columns": ["a", "b"], "training_split_used": "None",
                            "training_entries_count": 7, "paramGridBuilderValues": None}, indent=2))
    row = ml.read_metadata(spark, m, multiline=True).first()
    assert row.input_columns == ["a", "b"] and row.training_entries_count == 7
