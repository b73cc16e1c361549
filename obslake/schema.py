"""Declared schemas and fixed names.

The lake is never schema-inferred: inference costs a full pass over every
document and lets a number landed as ``0`` in one file and ``0.0`` in another
change type between reads.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values (must equal the source system's for compatible results) ---
# Measurement fields of one reading, in the order the flat table lists them.
MEASUREMENT_FIELDS = [
    ("apparent_temperature", DoubleType()),
    ("cloud_cover", DoubleType()),
    ("interval", LongType()),
    ("is_day", LongType()),
    ("precipitation", DoubleType()),
    ("pressure_msl", DoubleType()),
    ("rain", DoubleType()),
    ("relative_humidity_2m", DoubleType()),
    ("showers", DoubleType()),
    ("surface_pressure", DoubleType()),
    ("temperature_2m", DoubleType()),
    ("time", StringType()),
    ("weather_code", LongType()),
    ("wind_direction_10m", DoubleType()),
    ("wind_gusts_10m", DoubleType()),
    ("wind_speed_10m", DoubleType()),
]
# The twelve model inputs, in assembler order.
FEATURE_COLUMNS = [
    "apparent_temperature", "cloud_cover", "interval",
    "precipitation", "pressure_msl",
    "rain", "relative_humidity_2m", "showers",
    "temperature_2m",
    "wind_direction_10m", "wind_gusts_10m", "wind_speed_10m",
]
# Batch key text format (hourly batches) and day format of model directories.
BATCH_KEY_FORMAT = "yyyy-MM-dd_HHmm"
DAY_KEY_FORMAT = "yyyy-MM-dd"
# Object key of one landed document, and the regex that recovers the source
# (city) from it.  ``(?:city=)?`` also accepts Spark's ``city=<c>`` directories.
DOCUMENT_KEY_TEMPLATE = "data/weather/date={date}/{city}/{city}_{date}.json"
SOURCE_FROM_PATH_REGEX = r"date=[^/]+/(?:city=)?([^/]+)/[^/]+\.json$"
# Report location template.
REPORT_KEY_TEMPLATE = "reports/hourly/date={date}/{date}_report.json"
# Expected number of sources per complete batch.
SOURCES_PER_BATCH = 3
# --- end fixed values ---

BATCH_COL = "date"
# Physical partition column of the flat table and of reports: the day of the
# batch key (24 hourly batches per directory instead of one each).
PARTITION_COL = "day"
SOURCE_COL = "city"
KEY_COLUMNS = [BATCH_COL, SOURCE_COL]
LABEL_INDEX_COL = "city_index"

CURRENT = StructType([StructField(n, t, True) for n, t in MEASUREMENT_FIELDS])

# one raw document.  ``date`` is the partition column discovered from the
# directory name; declaring it pins its type to string.
RAW = StructType(
    [
        StructField("current", CURRENT, True),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField(BATCH_COL, StringType(), True),
    ]
)

# the flat table, 21 columns, unique on (date, city).
FLAT = StructType(
    list(CURRENT.fields)
    + [
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("file_path", StringType(), True),
        StructField(SOURCE_COL, StringType(), True),
        StructField(BATCH_COL, StringType(), True),
    ]
)
