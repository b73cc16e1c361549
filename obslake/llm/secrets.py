"""Secret scans over an incremental blob ledger (DataFrame functions only).

Every text version is addressed by its content (SHA-256).  The ledger, a
Parquet table in a shared folder, holds one row per scanned blob and run: the
rule versions that were applied and the spans they found.  A scan

1. collapses the versions to distinct blobs (each text is moved once),
2. joins them with the ledger and applies only the rule versions that a blob
   has not seen,
3. appends blobs, versions and spans in one commit, and
4. joins the ledger back to every path.

Spans come without a UDF: the text is split by a rule's pattern, and a running
sum over the lengths of gaps and matches gives each match's code points.

Edge cases: null text is an empty text without spans.  Equal texts share a
blob; repeated rows and null ids get their spans each.  A blob without a
finding is in the ledger with no span, so it is not scanned again.  A blob that
two runs scanned has its spans once.  A text of any length is scanned whole, by
expressions that pass over it once for each rule; masking is one more pass,
however many spans there are.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import written
from obslake.session import path_exists


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at
    least ``least`` characters.  A changed rule needs a new ``version``.

    ``hints``: lower-case strings of which every match holds one in either
    case; texts without them skip the pattern (a plain substring search)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = ("(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
          + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")

# The base kinds in their order, then further credential formats.
# A run of hex digits shorter than 24, or of an access key shorter than 20,
# would be dropped; stating the length in the pattern finds the same runs.
BASE_RULES = (
    Rule("assign", ASSIGN, group=2, least=6, hints=("passw", "secret", "token", "api")),
    Rule("access", "AKIA[A-Z0-9]{16,}", hints=("akia",)),
    Rule("hex", "[0-9a-f]{24,}"),
)
# A private key from BEGIN to its END marker (no other marker between), or
# without one over encryption headers and the lines of its base64 body, whose
# last may be short.  Breaks may be escaped, quoted or marked as comments.
_BREAK = r"""(?:\\[nrt]|[\s"',>#*|+])"""
PEM = (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:"
       r"[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]{0,40}PRIVATE KEY-----|"
       rf"(?:{_BREAK}*+(?:Proc-Type|DEK-Info|Content-Domain|Key-Info|Comment|Version)\x20*:(?:[^\r\n\\]|\\(?![nr]))*+)*+"
       rf"(?:{_BREAK}*+[A-Za-z0-9+/]{{16,}}+={{0,2}})*+"
       rf"(?:(?<=[A-Za-z0-9+/]{{16}}){_BREAK}++[A-Za-z0-9+/]{{1,15}}+(?:={{1,2}}|(?=[\x20\t]*(?:[\r\n\\\"']|\Z))))?)")
MORE_RULES = (
    Rule("pem", PEM, hints=("private key",), version=2),
    Rule("hub", "gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+", hints=("eyj",)),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob string, versions array<string>, spans array<struct<start:long,rank:int,end:long,kind:string>>"


def blob_of(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _matches(rule: Rule, rank: int, wanted: Column) -> Column:
    """Array of (rank, kind, i, gap, size, keep) of a rule's matches; ``gap``
    is the number of code points between the match before and this one."""
    hits = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    gaps = F.transform(F.split("text", rule.pattern, -1), F.length)
    rows = F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit")),
        lambda x, i: F.struct(
            F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), i.alias("i"),
            x["gap"].cast("long").alias("gap"), F.length(x["hit"]).cast("long").alias("size"),
            (F.length(F.regexp_extract(x["hit"], rule.pattern, rule.group)) >= rule.least).alias("keep")))
    if rule.hints:
        wanted = wanted & reduce(or_, [F.lower("text").contains(h) for h in rule.hints])
    return F.when(wanted & F.col("text").rlike(rule.pattern), rows)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of (blob, text, seen); one per blob, with or without spans."""
    versions = F.array(*[F.lit(r.key) for r in rules])
    found = [_matches(r, i, ~F.array_contains("seen", r.key)) for i, r in enumerate(rules)]
    none = F.expr("array()").cast("array<struct<rank:int,kind:string,i:int,gap:bigint,size:bigint,keep:boolean>>")
    rows = (blobs.select("blob", F.array_except(versions, "seen").alias("versions"),
                         F.flatten(F.array(*[F.coalesce(f, none) for f in found])).alias("found"))
            .select("blob", "versions", F.explode_outer("found").alias("m")))
    run = Window.partitionBy("blob", "m.rank").orderBy("m.i").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(run))
    span = F.struct((F.col("end") - F.col("m.size")).alias("start"), F.col("m.rank").alias("rank"),
                    F.col("end"), F.col("m.kind").alias("kind"))
    return placed.groupBy("blob").agg(
        F.first("versions").alias("versions"),
        F.sort_array(F.collect_list(F.when(F.col("m.keep"), span))).alias("spans"))


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger, empty where none was written yet."""
    if path_exists(spark, path):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def scan(versions: DataFrame, ledger: str, *, text: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at path ``ledger`` has not seen; append to it.

    Returns (blob, spans) of every blob in the ledger under these rules'
    versions, spans by start, then rule order.  The version of a span is that
    of its kind among the versions of its row."""
    spark = versions.sparkSession
    ranks = {r.kind: i for i, r in enumerate(rules)}
    blobs = (versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
             .groupBy("blob").agg(F.first("text").alias("text")))
    if path_exists(spark, ledger):
        known = (read_ledger(spark, ledger).select("blob", F.explode("versions").alias("version"))
                 .groupBy("blob").agg(F.collect_set("version").alias("seen")))
        unseen = (blobs.join(known, "blob", "left")
                  .withColumn("seen", F.coalesce("seen", F.expr("array()").cast("array<string>")))
                  .where(F.size(F.array_except(F.array(*[F.lit(r.key) for r in rules]), "seen")) > 0))
    else:
        unseen = blobs.withColumn("seen", F.expr("array()").cast("array<string>"))
    scan_blobs(unseen, rules).write.mode("append").parquet(ledger)
    rows = read_ledger(spark, ledger)
    kinds = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])
    keys = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.key)])
    current = F.filter("spans", lambda s: F.coalesce(F.array_contains("versions", keys[s["kind"]]), F.lit(False)))
    # One row per blob and run: nearly always one row per blob.  Runs that scanned the
    # same blob (at the same time, or again after a lost commit) found the same spans.
    return (rows.select("blob", current.alias("spans"))
            .groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
            .select("blob", F.sort_array(F.transform(
                "spans",
                lambda s: F.struct(s["start"].alias("start"), kinds[s["kind"]].alias("rank"),
                                   s["end"].alias("end"), s["kind"].alias("kind")))).alias("spans"))
            # Equal spans are neighbours now (array_distinct compares each struct with each).
            .select("blob", F.filter("spans", lambda s, i: (i == 0) | (s != F.get("spans", i - 1))).alias("spans")))


def findings(versions: DataFrame, ledger: str, *, doc_id: str = "doc_id", text: str = "text",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans) of every row, joined back to all its paths."""
    spans = written(scan(versions, ledger, text=text, rules=rules), "secrets-spans")
    paths = versions.select(F.col(doc_id).alias("doc_id"), blob_of(text).alias("blob"))
    return paths.join(spans, "blob").select("doc_id", "blob", "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def merged(spans: DataFrame) -> DataFrame:
    """(blob, cuts) of (blob, spans): ``cuts`` are the stretches (start, end)
    that touching or overlapping spans cover, in order."""
    each = spans.select("blob", F.inline("spans"))
    order = Window.partitionBy("blob").orderBy("start", "end")
    ahead = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = each.withColumn("apart", F.coalesce(F.col("start") > ahead, F.lit(True)).cast("int"))
    return (apart.withColumn("cut", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("blob", "cut").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")))


CHUNK = 1024   # code points; a substring is found by counting from the start of its chunk


def masked(rows: DataFrame, text: str, cuts: str, out: str, mask: str = "[SECRET]") -> DataFrame:
    """``rows`` with ``out``: ``text`` with each of ``cuts`` replaced by
    ``mask`` (null where there are none).  The text is chunked once, so the work
    is the length of the text plus a chunk for each cut."""
    some = F.col(cuts).isNotNull()
    chunks, gaps = "_obslake_chunks", "_obslake_gaps"
    body = F.col(text)
    rows = (rows.withColumn(chunks, F.when(some, F.regexp_extract_all(body, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))))
            .withColumn(gaps, F.when(some, F.arrays_zip(
                F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"])).alias("a"),
                F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length(body).cast("long"))).alias("b")))))

    def gap(g: Column) -> Column:
        a, b = g["a"], g["b"]
        first, last = F.floor(a / CHUNK).cast("int"), F.floor(b / CHUNK).cast("int")
        at = (a % CHUNK + 1).cast("int")
        head = F.get(F.col(chunks), first)
        return F.when(first == last, F.coalesce(head.substr(at, (b - a).cast("int")), F.lit(""))).otherwise(F.concat(
            head.substr(at, F.lit(CHUNK)), F.array_join(F.slice(F.col(chunks), first + 2, last - first - 1), ""),
            F.coalesce(F.get(F.col(chunks), last).substr(F.lit(1), (b % CHUNK).cast("int")), F.lit(""))))

    return rows.withColumn(out, F.array_join(F.transform(gaps, gap), mask)).drop(chunks, gaps)


def redact(docs: DataFrame, ledger: str, *, text: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``docs``, secrets in the text masked (null stays
    null); ``n_chars``, if there, follows the text."""
    # Written before it is filtered: a filter pushed into the scan's array expressions would repeat them for each span.
    found = written(scan(docs, ledger, text=text, rules=rules), "secrets-spans")
    spans = written(merged(found.where(F.size("spans") > 0))
                    .select(F.col("blob").alias("_obslake_blob"), F.col("cuts").alias("_obslake_cuts")),
                    "secrets-cuts")
    keyed = docs.withColumn("_obslake_blob", blob_of(text))
    found = masked(keyed.join(spans, "_obslake_blob", "left"), text, "_obslake_cuts", "_obslake_clean")
    out = found.withColumn(text, F.coalesce("_obslake_clean", F.col(text)))
    if "n_chars" in docs.columns:
        changed = F.col("_obslake_cuts").isNotNull()
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length(text).cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
