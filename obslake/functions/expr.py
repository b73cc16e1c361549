"""Scalar expressions used across the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from obslake.schema import (
    BATCH_KEY_FORMAT,
    DAY_KEY_FORMAT,
    SOURCE_FROM_PATH_REGEX,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def source_from_path(path="file_path", regex: str = SOURCE_FROM_PATH_REGEX,
                     empty_as_null: bool = True) -> Column:
    """SCL-1: the source directory of a landed document.

    ``regexp_extract`` yields '' on no match; by default '' is mapped to null
    so that unparseable paths never collapse into one key
    (``empty_as_null=False`` keeps the plain '' result)."""
    out = F.regexp_extract(_c(path), regex, 1)
    return F.nullif(out, F.lit("")) if empty_as_null else out


def batch_key(ts) -> Column:
    """SCL-5: hourly batch key ``yyyy-MM-dd_HHmm`` of a timestamp.

    Formatted straight from the wall-clock value (minutes forced to 00), so a
    TIMESTAMP_NTZ column is never shifted through the session time zone.
    """
    hour_fmt = BATCH_KEY_FORMAT.replace("mm", "'00'")
    return F.date_format(_c(ts), hour_fmt)


def day_key(ts) -> Column:
    """SCL-6: ``yyyy-MM-dd``."""
    return F.date_format(_c(ts), DAY_KEY_FORMAT)


def day_of_batch(batch="date") -> Column:
    """The day of a batch key, as a DATE (what partition discovery reads
    back from a ``day=yyyy-MM-dd`` directory); null for a key that is no day."""
    return F.try_to_timestamp(F.substring(_c(batch), 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def pct_text(ratio) -> Column:
    """SCL-4: a ratio in [0, 1] as percentage text with two decimals."""
    return F.format_string("%.2f%%", _c(ratio) * F.lit(100.0))


def document_key(batch="date", source="city", root: str = "data/weather") -> Column:
    """SCL-8: object key of one landed document:
    ``<root>/date=<d>/<c>/<c>_<d>.json``."""
    b, s = _c(batch), _c(source)
    return F.concat(F.lit(f"{root}/date="), b, F.lit("/"), s, F.lit("/"), s,
                    F.lit("_"), b, F.lit(".json"))


def json_text(*cols: str) -> Column:
    """SCL-7: a record as JSON text; null fields are written as null."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def sorted_map(key, value, where: Column | None = None) -> Column:
    """SCL-9 (aggregate): key -> value map built inside a groupBy, entries
    sorted by key; only rows meeting ``where`` when given.  Meant for groups
    bounded by the number of keys (one row per source in a batch), never for
    raw rows."""
    entry = F.struct(_c(key).alias("k"), _c(value).alias("v"))
    if where is not None:
        entry = F.when(where, entry)
    return F.map_from_entries(F.array_sort(F.collect_list(entry)))


def map_text(m, value_fmt: str = "%.1f") -> Column:
    """A string map rendered as ``k=v,k=v`` in key order (for comparisons and
    logs; maps have no stable text form across engines)."""
    entries = F.array_sort(F.map_entries(_c(m)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="),
                                                F.format_string(value_fmt, e["value"]))),
        ",",
    )


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets) from the first 32 bits of md5(key).

    Independent of partitioning and of the engine, unlike ``rand``."""
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(buckets)).cast("int")
