"""The document lake: ``<root>/date=<batch>/<source>/<file>.json``.

SRC-1 full scan with a declared schema and discovered ``date`` partition,
SRC-2 batch-pinned scan (partition pruning), SRC-3 provenance through the
hidden ``_metadata`` column, SRC-5 raw payload decoding with quarantine.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from obslake.schema import BATCH_COL, RAW, SOURCE_COL
from obslake.functions.expr import day_of_batch, source_from_path

CORRUPT_COL = "_corrupt_record"


def _with_corrupt(schema: StructType | str) -> StructType:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if CORRUPT_COL in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType(), True)])


def scan_lake(spark: SparkSession, root: str, schema: StructType | str | None = RAW,
              keep_corrupt: bool = False, multiline: bool = False) -> DataFrame:
    """SRC-1 + SRC-3: every document under ``root`` with its source file.

    The schema is declared (no inference pass).  ``file_path`` comes from the
    file source's ``_metadata`` column rather than ``input_file_name()``: the
    latter is nondeterministic and blocks partition pruning and predicate
    pushdown above it, while ``_metadata`` lets a later ``date`` filter reach
    ``PartitionFilters`` and lets dynamic partition pruning act on joins.

    ``schema=None`` infers the schema instead (an extra pass over every
    document, and a field's type may differ between runs); meant for
    exploring a lake whose fields are not known yet.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(_with_corrupt(schema) if keep_corrupt else schema)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    if multiline:
        reader = reader.option("multiLine", "true")
    df = reader.json(root)
    return df.select("*", F.col("_metadata.file_path").alias("file_path"))


_PLAIN_KEY = re.compile(r"^[A-Za-z0-9_.-]+$")


def scan_batch(spark: SparkSession, root: str, batches: str | Iterable[str],
               schema: StructType = RAW, max_direct: int = 256,
               keep_corrupt: bool = False) -> DataFrame:
    """SRC-2: only the documents of the given batch key(s).

    A handful of batches is read straight from their ``date=<key>``
    directories with ``basePath`` set to the lake root, so only those
    directories are listed and ``date`` is still a column; all sources of a
    batch come back in one read (no per-source read + union).  Many batches
    (or keys that would need path escaping) fall back to one root scan with a
    filter on the partition column, which Catalyst turns into
    ``PartitionFilters``."""
    keys = [batches] if isinstance(batches, str) else list(batches)
    if 0 < len(keys) <= max_direct and all(_PLAIN_KEY.match(k) for k in keys):
        from obslake.session import path_exists
        base = root.rstrip("/")
        paths = [f"{base}/{BATCH_COL}={k}" for k in keys]
        paths = [p for p in paths if path_exists(spark, p)]
        if paths:
            reader = spark.read.schema(_with_corrupt(schema) if keep_corrupt else schema) \
                .option("mode", "PERMISSIVE").option("basePath", base)
            if keep_corrupt:
                reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
            df = reader.json(paths)
            return df.select("*", F.col("_metadata.file_path").alias("file_path"))
    return scan_lake(spark, root, schema, keep_corrupt).where(F.col(BATCH_COL).isin(keys))


def with_reject_reason(df: DataFrame, body_col: str = "current",
                       source_col: str = SOURCE_COL) -> DataFrame:
    """SRC-5 quarantine rule as a column: null for a good document, else why
    it is rejected.

    A body that is not JSON (``<html>…``) sets the corrupt-record column; a
    well-formed body of the wrong shape (``{"error": true}``) does not, it only
    leaves the measurement struct null, so both are tested.  A document whose
    path names no source is rejected too: it has no key.  Apply it to the
    scanned documents (before flattening); the source is derived from
    ``file_path`` when not yet present.
    """
    if source_col not in df.columns and "file_path" in df.columns:
        df = df.withColumn(source_col, source_from_path("file_path"))
    reasons: list[tuple[Column, str]] = []
    if CORRUPT_COL in df.columns:
        reasons.append((F.col(CORRUPT_COL).isNotNull(), "malformed"))
    if body_col in df.columns:
        reasons.append((F.col(body_col).isNull(), "missing_body"))
    if source_col in df.columns:
        reasons.append((F.col(source_col).isNull(), "no_source_in_path"))
    if BATCH_COL in df.columns:
        reasons.append((F.col(BATCH_COL).isNull(), "no_batch_in_path"))
        reasons.append((day_of_batch(BATCH_COL).isNull(), "bad_batch_key"))
    expr = F.lit(None).cast("string")
    for cond, why in reversed(reasons):
        expr = F.when(cond, F.lit(why)).otherwise(expr)
    return df.withColumn("reject_reason", expr)


def decode_payload(df: DataFrame, text_col: str, schema: StructType | str,
                   out_col: str = "doc") -> DataFrame:
    """SRC-5 for payloads held as text (a landing column, a Kafka value):
    ``from_json`` in PERMISSIVE mode, keeping the raw text of a body that does
    not parse in ``_corrupt_record``."""
    schema = _with_corrupt(schema)
    parsed = F.from_json(F.col(text_col), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    return df.withColumn(out_col, parsed)
