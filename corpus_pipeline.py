"""The corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of ``obslake.llm``, takes ``(spark, docs,
sf_dir)`` and returns a DataFrame.  ``run`` writes the result of each stage as
Parquet below the shared ``spark.checkpoint.dir`` and reads it again as the
next stage's documents.  All stages but the last return the columns of
``documents``.

1. toxicity: rows the classifier scores at or above 0.7 go.
2. near_dedup: one row of each class of near-duplicate texts stays.
3. decontamination: rows that hold a benchmark item go.
4. secrets: secrets in the text are masked; ``n_chars`` follows the text.
5. packing: pieces of at most 2,048 tokens with their place in a sequence;
   ``ids`` are little-endian unsigned 32-bit token ids.

Edge cases are those of the operators: null text stays null up to packing
(where it is the end token alone), rows with null ids are never
near-duplicates, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obslake.llm import decontaminate, neardup, packing, secrets, toxicity
from obslake.llm.common import table, written
from obslake.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is fitted on the labels; held-out rows are only scored."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(model) < toxicity.THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, scratch_path(spark, "llm", "secret-ledger", unique=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# A fitted classifier, weighted sampling and a tokenizer are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
