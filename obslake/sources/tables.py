"""Driver tables (one parquet file each under an sf directory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; later selects and filters are pruned/pushed into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
