"""Plan properties that matter at scale."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.operators import quality
from obslake.operators.dedupe import first_wins
from obslake.plans import catalog
from obslake.plans import standins as si
from tests.conftest import SF_SMALL

PURE = ["batch_counts", "city_counts", "complete_batches", "complete_batches_strict",
        "clean_rows", "clean_city_counts", "drop_null_rows", "pct_text", "city_map",
        "point_lookup", "confusion", "precision_by_label", "feature_stats", "scaled_features",
        "decode_payload", "json_doc", "hash_split"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_plans(spark):
    for name in PURE:
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
            assert node not in plan, (name, node)


def test_column_pruning_reaches_scan(spark):
    plan = _plan(catalog.q_city_counts(spark, SF_SMALL))
    assert "ReadSchema: struct<event_type:string>" in plan


def test_first_wins_is_partial_aggregate(spark):
    r = si.event_readings(spark, SF_SMALL).select("date", "city", "ts", "event_id", "value")
    plan = _plan(first_wins(r, ["date", "city"], si.EVENT_ORDER))
    assert "partial_min" in plan and "Window" not in plan


def test_completeness_join_is_semi_and_not_forced_broadcast(spark):
    o = si.observations(spark, SF_SMALL, columns=["value"])
    df = quality.keep_complete(o, 5)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in logical and "broadcast" not in logical.lower()


def test_filter_pushed_to_parquet(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = _plan(ev.where(F.col("event_type") == "view").select("event_id"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan


def test_score_report_reads_scored_rows_once(spark):
    """Every report figure comes from one chain over the scored rows: one
    scan of the source (a branched plan would scan it, and run the model,
    twice)."""
    from obslake.modeling.report import score_report
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    scored = ev.select(F.date_format("ts", "yyyy-MM-dd").alias("date"),
                       F.col("event_type").alias("city"), "event_id",
                       (F.col("user_id") % 3).cast("double").alias("city_index"),
                       (F.col("event_id") % 3).cast("double").alias("prediction"))
    rep = score_report(scored, "m", order_col="event_id")
    initial = rep._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert initial.count("FileScan parquet") == 1
    assert rep.count() == scored.select("date").distinct().count()


def test_precision_by_label_scans_once(spark):
    from obslake.operators import metrics
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    scored = li.select((F.col("l_linenumber") % 3).cast("double").alias("y"),
                       (F.col("l_orderkey") % 4).cast("double").alias("p"))
    df = metrics.precision_by_label(scored, "y", "p")
    initial = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert initial.count("FileScan parquet") == 1
    assert {r.y for r in df.collect()} == {0.0, 1.0, 2.0, 3.0}


class _Conf:
    def __init__(self, d):
        self.d = d

    def get(self, k, default=None):
        return self.d.get(k, default)


class _Ctx:
    def __init__(self, master, conf):
        self.master, self._conf = master, _Conf(conf)

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Ctx(master, conf or {})


def test_scratch_is_the_shared_checkpoint_dir_and_never_local_on_a_cluster():
    import pytest
    from obslake.session import checkpoint_root, scratch_path
    shared = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt/"})
    assert checkpoint_root(shared) == "hdfs://nn/ckpt"
    assert scratch_path(shared, "tables", "t") == "hdfs://nn/ckpt/obslake/tables/t"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("spark://master:7077"))
