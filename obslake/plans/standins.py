"""Driver tables standing in for the reading lake.

``events`` plays the readings: batch key = hour of ``ts`` (``yyyy-MM-dd_HHmm``),
source = ``event_type``, measurement = ``value``, raw payload = ``props``.
``lineitem`` plays the feature table of the model: label = ``l_returnflag``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from obslake.functions.expr import batch_key, day_key
from obslake.operators.dedupe import first_wins
from obslake.session import path_exists, scratch_path
from obslake.sinks.lake import land_documents
from obslake.sources.tables import read_table

# --- fixed values of the stand-in mapping ---
EVENT_SOURCES = ["click", "error", "purchase", "signup", "view"]
SOURCES_PER_EVENT_BATCH = 5
EVENT_ORDER = ["ts", "event_id"]
EVENT_FEATURES = ["value", "k", "user_id", "interval"]
INTERVAL_SECONDS = 3600
LINEITEM_LABEL = "l_returnflag"
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "interval"]
LAKE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# --- end fixed values ---

EVENT_CURRENT = StructType([
    StructField("time", StringType(), True),
    StructField("event_id", LongType(), True),
    StructField("user_id", LongType(), True),
    StructField("value", DoubleType(), True),
    StructField("props", StringType(), True),
])
EVENT_DOC = StructType([
    StructField("current", EVENT_CURRENT, True),
    StructField("date", StringType(), True),
])


def event_readings(spark: SparkSession, sf_dir: str, grain: str = "hour",
                   events: DataFrame | None = None) -> DataFrame:
    """Raw readings: every event with its batch key and source."""
    ev = events if events is not None else read_table(spark, sf_dir, "events")
    key = batch_key("ts") if grain == "hour" else day_key("ts")
    return ev.select(
        key.alias("date"),
        F.col("event_type").alias("city"),
        "event_id", "ts", "user_id", "value", "props",
    )


def with_event_features(readings: DataFrame) -> DataFrame:
    """Numeric inputs of the reading model: value, the payload's ``k``, user,
    and a constant ``interval`` (a constant input scales to 0.0)."""
    return readings.withColumns({
        "k": F.from_json("props", "k bigint")["k"].cast("double"),
        "user_id": F.col("user_id").cast("double"),
        "interval": F.lit(float(INTERVAL_SECONDS)),
    })


def observations(spark: SparkSession, sf_dir: str, grain: str = "hour",
                 columns: list[str] | None = None) -> DataFrame:
    """The flat table: first reading per (batch, source) by (ts, event_id),
    the first-wins rule of the keyed insert."""
    r = event_readings(spark, sf_dir, grain)
    if columns is not None:
        r = r.select(*dict.fromkeys(["date", "city", *EVENT_ORDER, *columns]))
    return first_wins(r, ["date", "city"], EVENT_ORDER)


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events shaped as landed documents: nested ``current`` + keys."""
    r = event_readings(spark, sf_dir)
    return r.select(
        F.struct(
            F.date_format("ts", LAKE_TIME_FORMAT).alias("time"),
            "event_id", "user_id", "value", "props",
        ).alias("current"),
        "date", "city",
    )


def event_lake(spark: SparkSession, sf_dir: str, fresh: bool = False) -> str:
    """Land the events as a document lake (SNK-3) once per input directory
    in the shared scratch folder; later calls reuse it (``_SUCCESS`` marks a
    finished write).  ``fresh`` lands it again even when it exists."""
    # Keyed by input folder and document format, so a format change never
    # reuses a lake landed by older code.
    fmt = EVENT_DOC.json() + LAKE_TIME_FORMAT
    # And by the table's files, so changed events never meet an old lake.
    files = read_table(spark, sf_dir, "events").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    fmt += files.agg(F.md5(F.to_json(F.sort_array(F.collect_list(F.struct("*")))))).first()[0]
    tag = hashlib.sha1((sf_dir.rstrip("/") + "|" + fmt).encode()).hexdigest()[:12]
    root = scratch_path(spark, "lakes", f"events-{tag}")
    if fresh or not path_exists(spark, f"{root}/_SUCCESS"):
        land_documents(event_documents(spark, sf_dir), root, mode="overwrite")
    return root


def drifting_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, payload): the events' payloads as their senders might change
    them: errors send ``k`` as text, purchases add a buyer, signups send a
    null ``k``; the others are as given."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    buyer = F.concat(F.lit('{"k": '), k, F.lit(', "buyer": {"id": '), F.col("user_id").cast("string"),
                     F.lit(', "tags": ["new", 1]}}'))
    payload = (F.when(F.col("event_type") == "error", F.concat(F.lit('{"k": "'), k, F.lit('"}')))
               .when(F.col("event_type") == "purchase", buyer)
               .when(F.col("event_type") == "signup", F.lit('{"k": null}'))
               .otherwise(F.col("props")))
    return ev.select("event_id", payload.alias("payload"))


def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", LINEITEM_LABEL, "l_shipdate",
                     "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     F.lit(float(INTERVAL_SECONDS)).alias("interval"))


TREE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def price_band():
    """A label that quantity and discount nearly decide, for a tree to learn."""
    x = F.col("l_quantity") * (1 - 4 * F.col("l_discount"))
    return F.when(x < 12, "low").when(x < 24, "mid").otherwise("high")


def quantity_band_prediction(col: str = "l_quantity"):
    """A fixed rule standing in for a model, so grading is exactly checkable:
    quantity <= 17 -> 0.0, <= 34 -> 1.0, else 2.0."""
    q = F.col(col)
    return F.when(q <= 17, F.lit(0.0)).when(q <= 34, F.lit(1.0)).otherwise(F.lit(2.0))


def value_band_prediction(col: str = "value"):
    """Rule model over readings: ``floor(value / 100)`` clipped to 0..4."""
    return F.least(F.floor(F.col(col) / 100), F.lit(4)).cast("double")
