"""Compaction of the flat table (SNK-1 / STR-1).

A load every few minutes leaves hundreds of small files in each day.  Closed
days are rewritten into files of about ``target_bytes``, sorted by key ranges,
so that a read by key skips most of a day's row groups.

The rewritten rows are staged in full before any day is touched, and an intent
names them until the days are overwritten.  A job lost half-way is finished by
the next call (:func:`recover`), which also keeps rows that a load added to
those days in between.  One writer per table, as for the loads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslake.schema import KEY_COLUMNS, PARTITION_COL
from obslake.session import path_exists, scratch_path

TARGET_BYTES = 128 << 20
INTENT = "number long, staged string, n_files int"


def day_files(spark: SparkSession, path: str, partition_col: str = PARTITION_COL) -> DataFrame:
    """(day, n_files, bytes, rows) of a table; reads footers, no column."""
    files = spark.read.schema(f"{partition_col} date").parquet(path).select(
        partition_col, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    per_file = files.groupBy(partition_col, "file").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy(partition_col).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows"))


def allowed_files(bytes_col: str = "bytes", target_bytes: int = TARGET_BYTES):
    """Files a compacted day may have: ranges are cut by a sample, and a range
    may begin and end inside a day."""
    return 2 * F.ceil(F.col(bytes_col) / target_bytes) + 1


def _home(spark: SparkSession, path: str) -> str:
    return scratch_path(spark, "compaction", hashlib.sha1(path.rstrip("/").encode()).hexdigest()[:16])


def _stage(rows: DataFrame, path: str, n_files: int, partition_col: str, keys: Sequence[str]) -> str:
    """Writes the rows in key ranges below the scratch folder, then appends the
    intent.  Intents are never overwritten, so one always names all rows of
    the days that are being replaced; the last one counts."""
    spark = rows.sparkSession
    staged = scratch_path(spark, "compaction", "rows", unique=True)
    (rows.repartitionByRange(n_files, partition_col, *keys).sortWithinPartitions(partition_col, *keys)
     .write.parquet(f"{staged}/rows"))
    last = _last_intent(spark, path)
    intent = spark.createDataFrame([(last["number"] + 1 if last else 0, staged, n_files)], INTENT)
    intent.coalesce(1).write.mode("append").json(_home(spark, path))
    return staged


def _last_intent(spark: SparkSession, path: str):
    home = _home(spark, path)
    if not path_exists(spark, home):
        return None
    return spark.read.schema(INTENT).json(home).orderBy(F.desc("number")).first()


def _apply(spark: SparkSession, path: str, staged: str, schema: StructType, n_files: int,
           partition_col: str, keys: Sequence[str]) -> None:
    """Overwrites the days of the staged rows, then closes the intent."""
    (spark.read.schema(schema).parquet(f"{staged}/rows")
     .repartitionByRange(n_files, partition_col, *keys).sortWithinPartitions(partition_col, *keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    spark.range(1).coalesce(1).write.mode("overwrite").json(f"{staged}/done")


def recover(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = tuple(KEY_COLUMNS),
            partition_col: str = PARTITION_COL) -> bool:
    """Finishes a compaction that was lost after its rows were staged.  The
    staged rows are joined by the rows of those days whose key is not among
    them (later loads).  Returns whether there was one."""
    intent = _last_intent(spark, path)
    if intent is None or path_exists(spark, f"{intent['staged']}/done/_SUCCESS"):
        return False
    old = spark.read.schema(schema).parquet(f"{intent['staged']}/rows")
    days = [r[0] for r in old.select(partition_col).distinct().collect()]
    now = spark.read.schema(schema).parquet(path).where(F.col(partition_col).isin(days)).alias("now")
    known = old.select(partition_col, *keys).distinct().alias("known")
    same = [F.col(f"now.{c}").eqNullSafe(F.col(f"known.{c}")) for c in (partition_col, *keys)]
    added = now.join(known, same, "left_anti").select("now.*")
    n_files = intent["n_files"]
    staged = _stage(old.unionByName(added), path, n_files, partition_col, keys)
    _apply(spark, path, staged, schema, n_files, partition_col, keys)
    return True


def compact_days(spark: SparkSession, path: str, before: str, keys: Sequence[str] = tuple(KEY_COLUMNS),
                 partition_col: str = PARTITION_COL, target_bytes: int = TARGET_BYTES) -> list:
    """Rewrites the days before ``before`` that hold more files than
    :func:`allowed_files`; no other day is read or written.  Returns those
    days (one value per day; none on a second run).

    Every task reads and writes about ``target_bytes``, however the rows are
    spread over the days: ranges cut a large day and join small ones."""
    if not path_exists(spark, path):
        return []
    schema = spark.read.parquet(path).schema
    recover(spark, path, schema, keys, partition_col)
    files = day_files(spark, path, partition_col).where(F.col(partition_col) < F.lit(before).cast("date"))
    many = files.where(F.col("n_files") > allowed_files(target_bytes=target_bytes)).collect()
    if not many:
        return []
    days = sorted(r[partition_col] for r in many)
    n_files = max(1, -(-sum(r["bytes"] for r in many) // target_bytes))
    rows = spark.read.schema(schema).parquet(path).where(F.col(partition_col).isin(days))
    staged = _stage(rows, path, n_files, partition_col, keys)
    _apply(spark, path, staged, schema, n_files, partition_col, keys)
    return days
