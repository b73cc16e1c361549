"""The flat table and document sinks."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obslake.operators.dedupe import first_wins
from obslake.session import path_exists
from obslake.functions.expr import day_of_batch
from obslake.schema import BATCH_COL, KEY_COLUMNS, PARTITION_COL


def read_table_or_none(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """The columns ``schema`` of the Parquet table at ``path``, or None before
    its first write."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(schema).parquet(path)


def insert_if_absent(batch: DataFrame, target_path: str,
                     keys: Sequence[str] = tuple(KEY_COLUMNS),
                     order_by: Sequence[str] = ("file_path", "time"),
                     partition_col: str = PARTITION_COL,
                     partition_expr: Column | None = None) -> int:
    """SNK-1 / JN-2: keyed insert-if-absent ("ON CONFLICT DO NOTHING").

    1. first-wins inside the batch: per key, the row with the smallest
       ``order_by`` tuple (a partial aggregate, so a hot key is combined
       map-side instead of landing in one task);
    2. rows with a null key are never inserted (they belong to quarantine);
    3. anti-join against the keys already in the target, reading only the key
       columns of the target partitions this batch touches (partition
       pruning by the batch's days);
    4. append, partitioned by ``partition_col`` (by default the day of the
       batch key, computed by ``partition_expr``).

    A replay of the same batch adds nothing, so a retried micro-batch or job
    is harmless.  Returns the number of rows inserted, observed during the
    write itself (no second pass).

    One writer per target (one job or one streaming query): two concurrent
    writers could both find a key absent.  Concurrent writers need a table
    format with an atomic MERGE.
    """
    spark = batch.sparkSession
    if partition_expr is None and partition_col == PARTITION_COL:
        partition_expr = day_of_batch(BATCH_COL)
    rows = first_wins(batch.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)),
                      keys, order_by)
    if partition_expr is not None:
        rows = rows.withColumn(partition_col, partition_expr)
    # With a declared schema, a target without a file yet is an empty table.
    existing = read_table_or_none(spark, target_path, rows.select(partition_col, *keys).schema)
    cached = None
    if existing is not None:
        # The touched days and the anti-join both read the deduplicated rows:
        # persisted (memory, spilling to disk) for this write only, so the
        # batch is scanned and deduplicated once.  The touched days are one
        # value per day the batch spans (bounded by its time range, not its
        # rows); as a literal IN list they prune the target's partitions in
        # the plan, so only the key columns of those days are read.
        rows = cached = rows.persist(StorageLevel.MEMORY_AND_DISK)
        days = [r[0] for r in rows.select(partition_col).distinct().collect()]
        existing_keys = (existing.where(F.col(partition_col).isin(days))
                         .select(partition_col, *keys))
        rows = rows.join(existing_keys, [partition_col, *keys], "left_anti")
    cols = list(dict.fromkeys([*batch.columns, partition_col]))
    seen = Observation("insert_if_absent")
    out = rows.select(*cols).observe(seen, F.count(F.lit(1)).alias("inserted"))
    try:
        # Cluster by the partition column so each directory gets few files (a
        # plain write opens one file per task per directory); AQE splits a
        # partition value that holds a large share of the rows.
        (out.hint("rebalance", partition_col)
            .write.mode("append").partitionBy(partition_col).parquet(target_path))
    finally:
        if cached is not None:
            cached.unpersist()
    try:
        return int(seen.get["inserted"])
    except Py4JJavaError:
        # AQE replaces a plan it proves empty (e.g. a full replay) with an
        # empty relation, dropping the metrics node: nothing was written.
        return 0


def append_jdbc(df: DataFrame, url: str, table: str,
                properties: dict[str, str] | None = None) -> None:
    """SNK-2: bulk append to a SQL table through Spark's JDBC writer.

    Each task opens one connection and inserts its partition in batches;
    ``numPartitions`` in ``properties`` caps concurrent connections."""
    df.write.mode("append").jdbc(url=url, table=table, properties=properties or {})


def write_documents(df: DataFrame, path: str, partition_col: str | None = None,
                    mode: str = "append") -> None:
    """SNK-5 / SNK-6: rows as JSON documents (metadata next to a model,
    reports under ``<partition_col>=<value>`` directories)."""
    if partition_col:
        df.hint("rebalance", partition_col).write.mode(mode).partitionBy(partition_col).option("ignoreNullFields", "false").json(path)
    else:
        df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def preview(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """SNK-7 / LIM-1: first ``n`` rows as a DataFrame; ordered when asked,
    so the answer is defined (Spark plans order+limit as a top-k)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)

