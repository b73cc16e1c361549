"""URL filters by hashed host-suffix and path-prefix expressions (DataFrame
functions only).

A rule is (host, path, verdict).  It fits a URL whose host is the rule's or a
subdomain of it and whose path starts with the rule's.

1. Each distinct (host, path) is expanded into the expressions that a rule can
   have: host suffixes of as many labels, and path prefixes of as many
   characters, as some rule has.  The work per URL is thus bounded by the
   shapes of the rules, not by the length of the URL.
2. Expressions meet rules in an equi-join on the first 32 bits of their
   SHA-256; the whole digest confirms the hit.
3. The longest expression wins; of equal lengths the longer host, then block.
   A URL that no rule fits takes the default verdict.

Edge cases: a null URL, or one without ``://``, has an empty host and path,
which no rule with a host fits.  Empty labels are labels.  Rules with a null
host or path are ignored; repeated rules are one.  Repeated rows and null ids
are judged each.  Of a very long URL only as much is hashed as a rule is long.
Empty tables give empty results; without rules every URL
takes the default.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
BROADCAST_CHARS = 8_000_000  # a rule table of at most that many characters may be broadcast

# The rules of the registered query.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _rest(url: str) -> Column:
    at = F.locate("://", F.col(url))
    return F.when(at > 0, F.col(url).substr(at + 3, F.length(F.col(url)))).otherwise("")


def host_of(url: str) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _labels(host: str) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def _digest(host: Column, path: Column) -> Column:
    # A rule path starts with "/" or is told apart by the separator.
    return F.sha2(F.concat_ws("\n", host, path), 256)


def expressions(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """(host, path, digest, key) of each expression of a shape (labels of the
    host suffix, characters of the path prefix) of each row of (host, path).

    The shapes are one array of the plan, however many there are."""
    known = F.from_json(F.lit(json.dumps([{"n": n, "m": m} for n, m in shapes])), "array<struct<n: int, m: int>>")
    fits = F.filter(known, lambda s: (s["n"] <= F.col("labels")) & (s["m"] <= F.col("size")))
    made = F.transform(fits, lambda s: _digest(F.call_function("substring_index", F.col("host"), F.lit("."), -s["n"]),
                                               F.substring(F.col("path"), F.lit(1), s["m"])))
    return (urls.select("host", "path", _labels("host").alias("labels"), F.length("path").alias("size"))
            .select("host", "path", F.explode(made).alias("digest"))
            .withColumn("key", F.substring("digest", 1, 8)))


def judge(pages: DataFrame, rules: DataFrame, *, page_id: str = "page_id", url: str = "url",
          default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row."""
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = (rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"),
                          (F.col("verdict") == BLOCK).alias("blocks"))
             .where("rule_host is not null and rule_path is not null and blocks is not null")
             .groupBy("rule_host", "rule_path").agg(F.max("blocks").alias("blocks"))
             .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
             .withColumn("key", F.substring("digest", 1, 8)))
    # Bounded by the most labels times the longest path of the rules.
    shapes = [tuple(r) for r in known.select(_labels("rule_host"), F.length("rule_path")).distinct().collect()]
    if not shapes:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    chars = known.agg(F.sum(F.length("rule_host") + F.length("rule_path"))).head()[0]
    side = F.broadcast(known) if chars <= BROADCAST_CHARS else known
    asked = expressions(rows.select("host", "path").distinct(), sorted(shapes))
    best = F.max(F.struct((F.length("rule_host") + F.length("rule_path")).alias("size"),
                          F.length("rule_host").alias("host_size"), "blocks", "rule_host", "rule_path"))
    found = (asked.join(side.withColumnRenamed("digest", "rule_digest"), "key")
             .where(F.col("digest") == F.col("rule_digest"))
             .groupBy("host", "path").agg(best.alias("best")))
    return (rows.join(found, ["host", "path"], "left")
            .select("page_id", "host", "path",
                    F.concat("best.rule_host", "best.rule_path").alias("rule"),
                    F.when(F.col("best").isNull(), default).when(F.col("best.blocks"), BLOCK)
                    .otherwise(ALLOW).alias("verdict")))
