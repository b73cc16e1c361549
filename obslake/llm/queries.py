"""Registered queries of the operators: thin digests over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import (conversations, decontaminate, langid, licenses, neardup, packing, secrets, sharding,
                         simhash, spelling, toxicity, urls, warc)
from obslake.llm.common import table, written
from obslake.session import scratch_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one ledger, as when rows arrive in two loads: the second,
    over all rows, scans only the blobs that the first did not see."""
    docs = table(spark, sf_dir, "documents")
    ledger = scratch_path(spark, "llm", "secret-ledger", unique=True)
    secrets.scan(docs.where(F.xxhash64("doc_id") > 0), ledger)
    found = secrets.findings(docs, ledger)

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE_RULES]))
    return found.select("doc_id", *[n(r.kind) for r in secrets.BASE_RULES],
                        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "llm", "warc", unique=True)
    warc.write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "intact")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         "offset", "padded_tokens")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``near_rows``, for ids divisible by 100: rows of the table whose
    fingerprint is within the radius (the row itself included)."""
    prints = written(simhash.with_next(table(spark, sf_dir, "documents")), "simhash-prints")
    queries = prints.where(F.col("doc_id") % 100 == 0)
    rows = prints.groupBy(F.col("fingerprint").alias("print")).agg(F.count("*").alias("n"))
    near = (simhash.search(queries, prints).join(rows, "print")
            .groupBy(F.col("query_print").alias("fingerprint")).agg(F.sum("n").alias("n")))
    asked = queries.select("doc_id", "fingerprint").distinct().join(near, "fingerprint")
    return prints.join(asked.select("doc_id", "fingerprint", F.col("n").alias("near_rows")),
                       ["doc_id", "fingerprint"], "left").select(*prints.columns, "near_rows")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "kept")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", toxicity.is_held_out("doc_id").alias("held_out"),
                        toxicity.score(model).alias("score"))
            .withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law is ``rows``: a row's place follows from its number, not from its
    key, so there is no ``grown_shard``."""
    dealt = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (
    op1_secret_scan,
    op2_warc,
    op3_packing,
    op4_language_id,
    op5_benchmark_decontamination,
    op6_document_fingerprints,
    op7_minhash_near_dedup,
    op8_url_filters,
    op9_license_scan,
    op10_toxicity,
    op11_conversation_repair,
    op12_sharding,
    op13_spelling_variants,
)}
