"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each reads the driver tables (or data Spark derives from them) in full.
Matching DuckDB oracles live in :mod:`obslake.plans.oracle`; column names
are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.expr import (
    batch_key, day_key, day_of_batch, document_key, json_text, map_text, pct_text, sorted_map,
)
from obslake.modeling.expression import label_index, prediction
from obslake.modeling.report import read_reports, score_report
from obslake.modeling import stages as ml
from obslake.operators import incremental, metrics, quality, ranks, sketches, split
from obslake.operators.flatten import flatten
from obslake.plans import standins as si
from obslake.session import scratch_path
from obslake.sinks.compact import allowed_files, compact_days, day_files
from obslake.sinks.table import insert_if_absent, preview, write_documents
from obslake.sources.lake import decode_payload, scan_batch, scan_lake
from obslake.sources.rescue import field_counts, with_rescue
from obslake.sources.tables import read_table

N = si.SOURCES_PER_EVENT_BATCH
# Batches known to be bad (FLT-5 example list).
BAD_BATCHES = ["2024-01-01_0000", "2024-01-15_1200"]
# Earlier load that the insert query must not overwrite: batches before this.
PRIOR_LOAD_BEFORE = "2024-01-16_0000"
# Days before this one are closed for loads.
COMPACT_BEFORE = "2024-01-25"
OBS_COLS = ["date", "city", "event_id", "value"]


def _obs(spark, sf_dir, cols=("value",)):
    return si.observations(spark, sf_dir, columns=list(cols))


# --- scans and lake (SRC-*, SNK-3, PRJ-1) ----------------------------------

def q_lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scan_lake(spark, si.event_lake(spark, sf_dir), si.EVENT_DOC)
    return flatten(raw, carry=("date",)).select("event_id", "date", "city", "value")


def q_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    latest = ev.agg(batch_key(F.max("ts")).alias("b")).first()["b"]
    raw = scan_batch(spark, si.event_lake(spark, sf_dir), latest, si.EVENT_DOC)
    return flatten(raw, carry=("date",)).select("event_id", "date", "city", "value")


def q_provenance_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scan_lake(spark, si.event_lake(spark, sf_dir), si.EVENT_DOC)
    return quality.rows_per(flatten(raw, carry=("date",)), "city")


def q_decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    d = decode_payload(ev, "props", "k bigint")
    bad = F.col("doc._corrupt_record").isNotNull() | F.col("doc.k").isNull()
    return d.select("event_id", F.col("doc.k").alias("k"), bad.cast("int").alias("rejected"))


def q_payload_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5 with fields that drift: the declared one, and what else was sent."""
    d = with_rescue(si.drifting_payloads(spark, sf_dir), "payload", {"k": "bigint"})
    return d.select("event_id", F.col("doc.k").alias("k"), F.to_json("rescued").alias("rescued"))


def q_payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: paths and kinds of all payloads, with counts."""
    return field_counts(si.drifting_payloads(spark, sf_dir), "payload")


def q_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = si.event_readings(spark, sf_dir)
    nested = r.select(
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
                 "event_id", "user_id", "value", "props").alias("current"),
        "date", "city")
    return nested.select("current.*", "date", "city")


def q_select_attr_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return preview(ev.select(ev.event_id, ev.value, ev.event_type), 60, ["event_id"])


# --- counts and completeness (AGG-1..6, FLT-1..5, JN-1) ---------------------

def q_batch_counts(spark, sf_dir):
    return quality.rows_per(_obs(spark, sf_dir), "date")


def q_city_counts(spark, sf_dir):
    return quality.rows_per(si.event_readings(spark, sf_dir), "city")


def q_total_rows(spark, sf_dir):
    return quality.row_count(read_table(spark, sf_dir, "events"))


def q_complete_batches(spark, sf_dir):
    return quality.complete_batches(_obs(spark, sf_dir), N)


def q_complete_batches_strict(spark, sf_dir):
    return quality.complete_batches(si.event_readings(spark, sf_dir), N, strict=True)


def q_complete_batches_incremental(spark, sf_dir):
    """AGG-6 from bitmaps kept per day: three loads that overlap by a day."""
    r = si.event_readings(spark, sf_dir).select("date", "city")
    state = scratch_path(spark, "state", "completeness", unique=True)
    for rows in (r.where("date < '2024-01-12'"), r.where("date >= '2024-01-11' and date < '2024-01-22'"),
                 r.where("date >= '2024-01-21' or date is null")):
        incremental.merge_completeness(rows, state)
    return incremental.complete_batches(spark, state, N)


def q_approximate_users(spark, sf_dir):
    """AGG-6 / STR-3 for sources too many to list: the distinct users of each
    day, from hourly sketches of three loads that overlap by a day."""
    r = si.event_readings(spark, sf_dir).select("date", "user_id")
    state = scratch_path(spark, "state", "sketches", unique=True)
    for rows in (r.where("date < '2024-01-12'"), r.where("date >= '2024-01-11' and date < '2024-01-22'"),
                 r.where("date >= '2024-01-21' or date is null")):
        sketches.merge_sketches(rows, state, source_col="user_id", lg_k=16)
    return sketches.approximate_sources(spark, state, ["day"]).select(
        F.col("day").cast("string").alias("day"), F.col("n_sources").alias("n_users"))


def q_incomplete_batches(spark, sf_dir):
    return quality.incomplete_batches(_obs(spark, sf_dir), N)


def q_clean_rows(spark, sf_dir):
    return quality.keep_complete(_obs(spark, sf_dir), N).select(*OBS_COLS)


def q_clean_rows_inner(spark, sf_dir):
    return quality.keep_complete(_obs(spark, sf_dir), N, how="inner").select(*OBS_COLS)


def q_clean_city_counts(spark, sf_dir):
    return quality.rows_per(quality.keep_complete(_obs(spark, sf_dir), N), "city")


def q_drop_null_rows(spark, sf_dir):
    wide = quality.sources_wide(_obs(spark, sf_dir), si.EVENT_SOURCES, "value")
    return quality.drop_rows_with_nulls(wide)


def q_exclude_batches(spark, sf_dir):
    return quality.exclude_batches(_obs(spark, sf_dir), BAD_BATCHES).select(*OBS_COLS)


def q_eq_filter(spark, sf_dir):
    o = _obs(spark, sf_dir)
    return o.where(o.city == "view").select("date", "event_id", "value")


# --- sinks (SNK-1, JN-2) ----------------------------------------------------

def q_insert_new(spark, sf_dir):
    target = scratch_path(spark, "tables", "insert_new", unique=True)
    r = si.event_readings(spark, sf_dir).select("date", "city", "ts", "event_id", "value")
    # An earlier load kept the *latest* reading of each key before the cut-off.
    prior = r.where(F.col("date") < PRIOR_LOAD_BEFORE)
    prior = prior.groupBy("date", "city").agg(F.max(F.struct("ts", "event_id", "value")).alias("w")) \
                 .select("date", "city", "w.ts", "w.event_id", "w.value")
    insert_if_absent(prior, target, order_by=si.EVENT_ORDER)
    insert_if_absent(r, target, order_by=si.EVENT_ORDER)
    return spark.read.parquet(target).select(*OBS_COLS)


def q_lake_load(spark, sf_dir):
    """The Load job end to end: lake -> flatten -> provenance -> insert."""
    target = scratch_path(spark, "tables", "lake_load", unique=True)
    raw = scan_lake(spark, si.event_lake(spark, sf_dir), si.EVENT_DOC)
    flat = flatten(raw, carry=("date",))
    insert_if_absent(flat, target, order_by=("time", "event_id"))
    return spark.read.parquet(target).select(*OBS_COLS)


def q_compacted_table(spark, sf_dir):
    """SNK-1 / STR-1: five loads leave five files a day; the days before a cut
    are compacted.  Every row, and whether its closed day has few files."""
    target = scratch_path(spark, "tables", "compacted", unique=True)
    r = si.event_readings(spark, sf_dir).select("date", "city", "ts", "event_id", "value")
    part = F.pmod(F.substring("date", 12, 2).cast("int"), F.lit(5))
    for i in range(5):
        insert_if_absent(r.where(part == i), target, order_by=si.EVENT_ORDER)
    compact_days(spark, target, COMPACT_BEFORE)
    closed = day_files(spark, target).where(F.col("day") < F.lit(COMPACT_BEFORE).cast("date")).select(
        "day", (F.col("n_files") <= allowed_files()).alias("few_files"))
    return spark.read.parquet(target).join(closed, "day", "left").select(*OBS_COLS, "few_files")


# --- splits, unions, expressions --------------------------------------------

def q_hash_split(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return quality.rows_per(split.hash_split(li, ["l_orderkey", "l_linenumber"]), "split")


def q_random_split(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    train, test = split.random_split(li)
    parts = train.select(F.lit("train").alias("split")).unionByName(
        test.select(F.lit("test").alias("split")))
    return parts.agg(F.count(F.lit(1)).alias("n_total"))


def q_exact_split(spark, sf_dir):
    """SMP-1: exactly 80 % of the rows, the same after any repartition."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return split.exact_split(li, ["l_orderkey", "l_linenumber"])


def q_union_cities(spark, sf_dir):
    """SET-1: one read per source (as the Score job read one file per city),
    every source, unioned by name."""
    o = _obs(spark, sf_dir).select(*OBS_COLS)
    parts = [o.where(F.col("city") == c) for c in si.EVENT_SOURCES]
    return metrics.union_sources(parts)


def q_union_positional(spark, sf_dir):
    o = _obs(spark, sf_dir).select(*OBS_COLS)
    parts = [o.where(F.col("city") == c) for c in si.EVENT_SOURCES]
    return metrics.union_sources(parts, by_name=False)


def q_pct_text(spark, sf_dir):
    """Share of each source's readings that fall in complete batches, as
    percentage text.  The complete-batch keys flag the readings (one row per
    batch on the right, so the left join adds no rows); one aggregate then
    counts both."""
    o = _obs(spark, sf_dir, cols=())
    keys = quality.complete_batches(o, N).withColumn("_complete", F.lit(1))
    per = o.join(keys, "date", "left").groupBy("city").agg(
        F.count(F.lit(1)).alias("n_obs"), F.count("_complete").alias("n_clean"))
    return per.select("city", pct_text(F.col("n_clean") / F.col("n_obs")).alias("share"))


def q_batch_key(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", batch_key("ts").alias("batch"), day_key("ts").alias("day"))


def q_object_key(spark, sf_dir):
    return _obs(spark, sf_dir, cols=()).select("date", "city", document_key().alias("object_key"))


def q_json_doc(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("city"))
    return ev.select("event_id", json_text("event_id", "city").alias("doc"))


def q_city_map(spark, sf_dir):
    o = _obs(spark, sf_dir)
    m = o.groupBy("date").agg(sorted_map("city", "value").alias("m"))
    return m.select("date", map_text("m", "%.2f").alias("city_values"))


def q_point_lookup(spark, sf_dir):
    r = si.event_readings(spark, sf_dir)
    return metrics.point_lookup(r, "city", "value", "event_id")


# --- model-side aggregates (AGG-7..11) --------------------------------------

def _lineitem_scored_by_rule(spark, sf_dir):
    li = si.lineitem_features(spark, sf_dir)
    idx = StringIndexer(inputCol=si.LINEITEM_LABEL, outputCol="label_index").fit(li)
    return idx.transform(li).withColumn("prediction", si.quantity_band_prediction())


def q_label_index(spark, sf_dir):
    li = si.lineitem_features(spark, sf_dir)
    return ml.label_index_table(li, si.LINEITEM_LABEL, "label_index")


def q_label_ranks(spark, sf_dir):
    """AGG-7 over a column with many labels: the parts of the order lines."""
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("part"))
    return ranks.label_ranks(li, "part", "label_index")


def q_feature_stats_incremental(spark, sf_dir):
    """AGG-8 / ML-3 from per-day states of three loads, one of them replayed."""
    li = si.lineitem_features(spark, sf_dir)
    state = scratch_path(spark, "state", "moments", unique=True)
    year = F.year("l_shipdate")
    for load, rows in (("a", li.where(year < 1994)), ("b", li.where(year.between(1994, 1996))),
                       ("c", li.where((year > 1996) | year.isNull())), ("b", li.where(year.between(1994, 1996)))):
        incremental.merge_moments(rows, state, load, "l_shipdate", si.LINEITEM_FEATURES)
    return incremental.merged_moments(spark, state).select(
        "feature", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


def q_tree_predictions(spark, sf_dir):
    """ML-4 / ML-7: a tree of two levels over all lines, scored by its
    expression; ``n_other`` counts rows on which ``transform`` differs."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("band", si.price_band())
    model = ml.fit(Pipeline(stages=[
        *ml.build_stages(si.TREE_FEATURES, label="band", label_index="band_index").getStages()[:3],
        DecisionTreeClassifier(featuresCol="features", labelCol="band_index", maxDepth=2, maxBins=128, seed=42)]), li)
    both = ml.score(model, li).withColumns({"guess": prediction(model), "index": label_index(model)})
    other = (F.col("guess") != F.col("prediction")) | (F.col("index") != F.col("band_index"))
    return both.groupBy("l_quantity", "l_discount", "l_tax", "band", F.col("index").alias("label_index"),
                        F.col("guess").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(other.cast("long")).alias("n_other"))


def q_feature_stats(spark, sf_dir):
    li = si.lineitem_features(spark, sf_dir)
    m = metrics.feature_moments(li, si.LINEITEM_FEATURES)
    return m.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def q_scaled_features(spark, sf_dir):
    li = si.lineitem_features(spark, sf_dir)
    asm = VectorAssembler(inputCols=si.LINEITEM_FEATURES, outputCol="raw")
    scaler = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True)
    v = asm.transform(li)
    z = scaler.fit(v).transform(v).select("l_orderkey", "l_linenumber",
                                          vector_to_array("z").alias("z"))
    return z.select("l_orderkey", "l_linenumber",
                    *[F.round(F.col("z")[i], 6).alias(f"z_{f}")
                      for i, f in enumerate(si.LINEITEM_FEATURES)])


def q_confusion(spark, sf_dir):
    return metrics.confusion(_lineitem_scored_by_rule(spark, sf_dir), "label_index", "prediction")


def q_accuracy_by_batch(spark, sf_dir):
    s = _lineitem_scored_by_rule(spark, sf_dir).withColumn("year", F.year("l_shipdate"))
    a = metrics.accuracy(s, "label_index", "prediction", by=["year"])
    return a.select("year", F.round("accuracy", 6).alias("accuracy"))


def q_precision_by_label(spark, sf_dir):
    p = metrics.precision_by_label(_lineitem_scored_by_rule(spark, sf_dir),
                                   "label_index", "prediction")
    return p.select("label_index", F.round("precision", 6).alias("precision"))


# --- reports and the model (ML-*, SNK-4..6, SRC-4) --------------------------

def _report_text(rep: DataFrame) -> DataFrame:
    return rep.select("datetime", "model_type", "model_location", "accuracy", "precision",
                      map_text("city_indexes").alias("city_indexes"),
                      map_text("city_guesses").alias("city_guesses"),
                      map_text("precision_by_label", "%.4f").alias("precision_by_label"))


def q_batch_report(spark, sf_dir):
    """Score job's grading with a rule standing in for the tree; the report is
    written as one JSON document per batch and read back."""
    o = _obs(spark, sf_dir)
    idx = StringIndexer(inputCol="city", outputCol="city_index").fit(o)
    scored = idx.transform(o).withColumn("prediction", si.value_band_prediction())
    rep = score_report(scored, "rule:value-band", order_col="event_id")
    out = scratch_path(spark, "reports", "batch_report", unique=True)
    write_documents(rep.withColumn("day", day_of_batch("date")), out, partition_col="day")
    return _report_text(read_reports(spark, out))


def _clean_event_training(spark, sf_dir):
    o = _obs(spark, sf_dir, cols=("value", "user_id", "props"))
    return si.with_event_features(quality.keep_complete(o, N))


def q_train_score_report(spark, sf_dir):
    """Train on complete batches, score every batch, grade per batch."""
    train = _clean_event_training(spark, sf_dir)
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), train)
    every = si.with_event_features(_obs(spark, sf_dir, cols=("value", "user_id", "props")))
    rep = score_report(ml.score(model, every), "memory:fitted", order_col="event_id")
    return _report_text(rep)


def q_model_roundtrip(spark, sf_dir):
    train = _clean_event_training(spark, sf_dir)
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), train)
    store = scratch_path(spark, "models", unique=True)
    ml.save_model(model, store, "2024-01-30")
    loaded = ml.load_model(spark, store, as_of_day="2024-01-31")
    every = si.with_event_features(_obs(spark, sf_dir, cols=("value", "user_id", "props")))
    first = ml.score(model, every).select(*every.columns, F.col("prediction").alias("p_saved"))
    both = ml.score(loaded, first)
    return both.agg(F.sum((F.col("p_saved") != F.col("prediction")).cast("long"))
                    .cast("bigint").alias("n_diff"))


def q_model_metadata(spark, sf_dir):
    meta = ml.training_metadata(_clean_event_training(spark, sf_dir), si.EVENT_FEATURES)
    out = scratch_path(spark, "models", "metadata", unique=True)
    write_documents(meta.coalesce(1), out)
    back = ml.read_metadata(spark, out)
    return back.select(F.array_join("input_columns", ",").alias("input_columns"),
                       "training_split_used", "training_entries_count", "paramGridBuilderValues")


def _event_flat_table(spark, sf_dir) -> str:
    """The Load job's output for the events stand-in, with model inputs."""
    flat = scratch_path(spark, "tables", "event_flat", unique=True)
    r = si.with_event_features(si.event_readings(spark, sf_dir))
    insert_if_absent(r, flat, order_by=si.EVENT_ORDER)
    return flat


def q_train_job(spark, sf_dir):
    """The Train job as run in production: flat table -> complete batches ->
    fit -> model + metadata document; the metadata is read back."""
    from obslake.plans.jobs import train_job
    store = scratch_path(spark, "models", "train_job", unique=True)
    train_job(spark, _event_flat_table(spark, sf_dir), store, "2024-01-31",
              features=si.EVENT_FEATURES, expected=N)
    meta = ml.read_metadata(spark, f"{store}/date=2024-01-31/custom_model_metadata")
    return meta.select(F.array_join("input_columns", ",").alias("input_columns"),
                       "training_split_used", "training_entries_count", "paramGridBuilderValues")


def q_score_job(spark, sf_dir):
    """The Score job over every batch of the document lake with a model the
    Train job saved; reported per batch.  The deterministic part of the
    report (label index per source) is returned for the oracle."""
    from obslake.plans.jobs import score_job, train_job
    store = scratch_path(spark, "models", "score_job", unique=True)
    train_job(spark, _event_flat_table(spark, sf_dir), store, "2024-01-31",
              features=si.EVENT_FEATURES, expected=N)
    rep = score_job(spark, si.event_lake(spark, sf_dir), None, store, schema=si.EVENT_DOC,
                    prepare=si.with_event_features,
                    as_of_day="2024-01-31")
    return rep.select("datetime", "model_type", map_text("city_indexes").alias("city_indexes"))


def q_score_as_of(spark, sf_dir):
    """SRC-4 over every batch: two models, saved on two days; each batch is
    scored by the newest one of its own day (none before the first)."""
    from obslake.plans.jobs import score_as_of
    store = scratch_path(spark, "models", "score_as_of", unique=True)
    rows = si.with_event_features(_obs(spark, sf_dir, cols=("value", "user_id", "props")))
    for day in ("2024-01-10", "2024-01-20"):
        train = rows.where(F.col("date") < day)
        ml.save_model(ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), train), store, day)
    scored = score_as_of(spark, rows, store)
    return scored.groupBy("date", "model_day").agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_scored"),
        F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "city", F.col("city_index").cast("string")))), ",").alias("indexes"))


# --- streaming (STR-*) -------------------------------------------------------

def _event_stream(spark, sf_dir):
    ev_schema = read_table(spark, sf_dir, "events").schema
    # Every trigger takes all newly arrived files (no per-trigger file cap).
    src = (spark.readStream.schema(ev_schema)
           .option("pathGlobFilter", "events.parquet")
           .parquet(sf_dir))
    return si.event_readings(spark, sf_dir, events=src)


def q_stream_ingest(spark, sf_dir):
    from obslake.streaming.ingest import start_load_stream
    target = scratch_path(spark, "tables", "stream_ingest", unique=True)
    ckpt = scratch_path(spark, "checkpoints", "stream_ingest", unique=True)
    r = _event_stream(spark, sf_dir).select("date", "city", "ts", "event_id", "value")
    q = start_load_stream(r, target, ckpt, order_by=si.EVENT_ORDER)
    q.awaitTermination()
    return spark.read.parquet(target).select(*OBS_COLS)


def q_stream_dedupe(spark, sf_dir):
    from obslake.streaming.ingest import dedupe_stream
    out = scratch_path(spark, "tables", "stream_dedupe", unique=True)
    ckpt = scratch_path(spark, "checkpoints", "stream_dedupe", unique=True)
    r = _event_stream(spark, sf_dir).select("date", "city", F.col("ts").cast("timestamp").alias("et"))
    d = dedupe_stream(r, "et", "2 hours").select("date", "city")
    q = (d.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("date string, city string").parquet(out)


def q_stream_first_wins(spark, sf_dir):
    """STR-4 exact form: first reading per (batch, source) by (ts, event_id),
    emitted once per key when its hour closes under the watermark."""
    from obslake.streaming.ingest import first_wins_stream
    out = scratch_path(spark, "tables", "stream_first_wins", unique=True)
    ckpt = scratch_path(spark, "checkpoints", "stream_first_wins", unique=True)
    r = _event_stream(spark, sf_dir).select("date", "city", "ts", "event_id", "value")
    q = (first_wins_stream(r, "ts", si.EVENT_ORDER).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select(*OBS_COLS)


def q_stream_first_seen(spark, sf_dir):
    """STR-4 at once: every (batch, source) when its first reading arrives."""
    from obslake.streaming.first_seen import start_first_seen_stream
    out = scratch_path(spark, "tables", "stream_first_seen", unique=True)
    ckpt = scratch_path(spark, "checkpoints", "stream_first_seen", unique=True)
    r = _event_stream(spark, sf_dir).select("date", "city", "ts", "event_id", "value")
    start_first_seen_stream(r, out, ckpt, "ts", si.EVENT_ORDER).awaitTermination()
    return spark.read.parquet(out).select(*OBS_COLS)


def q_stream_score(spark, sf_dir):
    from obslake.streaming.score import start_score_stream
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), _clean_event_training(spark, sf_dir))
    out = scratch_path(spark, "tables", "stream_score", unique=True)
    ckpt = scratch_path(spark, "checkpoints", "stream_score", unique=True)
    stream = si.with_event_features(_event_stream(spark, sf_dir))
    q = start_score_stream(model, stream, out, ckpt,
                           columns=("event_id", "date", "city", "city_index", "prediction"))
    q.awaitTermination()
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n_scored"))


def q_stream_completeness(spark, sf_dir):
    from obslake.streaming.completeness import batch_completeness
    out = scratch_path(spark, "tables", "stream_completeness", unique=True)
    ckpt = scratch_path(spark, "checkpoints", "stream_completeness", unique=True)
    res = batch_completeness(_event_stream(spark, sf_dir), "ts", "city", "1 hour", "2 hours")

    def overwrite(df: DataFrame, _id: int) -> None:
        df.write.mode("overwrite").parquet(out)

    q = (res.writeStream.outputMode("complete").foreachBatch(overwrite)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("batch", F.col("n_sources").cast("bigint").alias("n_sources"))


def q_stream_reports(spark, sf_dir):
    """Score-on-arrival: reports for every batch once all five sources are in.
    The deterministic part (batch, label index per source) is returned."""
    from obslake.streaming.reports import start_report_stream
    model = ml.fit(ml.build_stages(si.EVENT_FEATURES, seed=42), _clean_event_training(spark, sf_dir))
    scored = scratch_path(spark, "tables", "stream_reports_scored", unique=True)
    reports = scratch_path(spark, "reports", "stream_reports", unique=True)
    ckpt = scratch_path(spark, "checkpoints", "stream_reports", unique=True)
    stream = si.with_event_features(_event_stream(spark, sf_dir))
    q = start_report_stream(model, stream, scored, reports, ckpt, "memory:fitted",
                            expected=N, order_by=si.EVENT_ORDER)
    q.awaitTermination()
    rep = read_reports(spark, reports)
    return rep.select("datetime", "model_type", map_text("city_indexes").alias("city_indexes"))


# --- flagship ----------------------------------------------------------------

def flagship(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Which batches are complete, and how many readings per source survive."""
    o = si.observations(spark, sf_dir, grain=grain, columns=["value"])
    return quality.rows_per(quality.keep_complete(o, N), "city")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lake_scan": q_lake_scan,
    "batch_scan": q_batch_scan,
    "provenance_city": q_provenance_city,
    "decode_payload": q_decode_payload,
    "payload_rescue": q_payload_rescue,
    "payload_fields": q_payload_fields,
    "flatten": q_flatten,
    "select_attr_preview": q_select_attr_preview,
    "batch_counts": q_batch_counts,
    "city_counts": q_city_counts,
    "total_rows": q_total_rows,
    "complete_batches": q_complete_batches,
    "complete_batches_strict": q_complete_batches_strict,
    "complete_batches_incremental": q_complete_batches_incremental,
    "approximate_users": q_approximate_users,
    "incomplete_batches": q_incomplete_batches,
    "clean_rows": q_clean_rows,
    "clean_rows_inner": q_clean_rows_inner,
    "clean_city_counts": q_clean_city_counts,
    "drop_null_rows": q_drop_null_rows,
    "exclude_batches": q_exclude_batches,
    "eq_filter": q_eq_filter,
    "insert_new": q_insert_new,
    "lake_load": q_lake_load,
    "compacted_table": q_compacted_table,
    "hash_split": q_hash_split,
    "random_split": q_random_split,
    "exact_split": q_exact_split,
    "union_cities": q_union_cities,
    "union_positional": q_union_positional,
    "pct_text": q_pct_text,
    "batch_key": q_batch_key,
    "object_key": q_object_key,
    "json_doc": q_json_doc,
    "city_map": q_city_map,
    "point_lookup": q_point_lookup,
    "label_index": q_label_index,
    "label_ranks": q_label_ranks,
    "feature_stats": q_feature_stats,
    "feature_stats_incremental": q_feature_stats_incremental,
    "scaled_features": q_scaled_features,
    "confusion": q_confusion,
    "accuracy_by_batch": q_accuracy_by_batch,
    "precision_by_label": q_precision_by_label,
    "batch_report": q_batch_report,
    "train_score_report": q_train_score_report,
    "tree_predictions": q_tree_predictions,
    "model_roundtrip": q_model_roundtrip,
    "model_metadata": q_model_metadata,
    "train_job": q_train_job,
    "score_job": q_score_job,
    "score_as_of": q_score_as_of,
    "stream_ingest": q_stream_ingest,
    "stream_dedupe": q_stream_dedupe,
    "stream_first_wins": q_stream_first_wins,
    "stream_first_seen": q_stream_first_seen,
    "stream_score": q_stream_score,
    "stream_completeness": q_stream_completeness,
    "stream_reports": q_stream_reports,
}
