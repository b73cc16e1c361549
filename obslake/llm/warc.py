"""WARC archives: written as text, read back by boundary-chain verification.

Write: payloads are addressed by their SHA-1.  Of the rows with equal payloads
the one with the smallest id becomes a ``response``, the others ``revisit``
records without a payload.  A record is one string, so Spark's text writer
writes the archives through its commit protocol.

Read: the archives are read in splits, cut at every occurrence of the magic
line, whether it starts a record or lies in a payload.

1. Each task emits its candidates with their place in the split and the bytes
   from there to the successor that their header claims; sizes of the splits
   before it turn places into offsets of the file.
2. Pointer jumping over (file, offset, successor) doubles the reach of the
   chain from offset 0 in each round.  Only reached candidates are records;
   magic lines inside payloads are never reached.  A round writes what it newly
   reaches and the jumps that still lead to a candidate.
3. Payloads that hold magic lines were cut: the files that have such records are
   read again into one table, whose own splits give the offsets anew, and the
   parts are put together per record.  So splits may differ between the reads.

The chain of a file must end at its length: ``read_archives`` raises an error
that names files for which it does not (``broken="keep"`` returns what was
reached; ``broken_files`` lists them).  It also raises one if a record can't be
put together.

Edge cases: a text of any length is one record, held once by the task that reads
it; null html is an empty payload; a null id is written as such, and
its row is a response only if no row with an id has its payload (all such
rows then are).  Rows with equal id and payload have the type of their id.
Control characters and spaces in URLs are percent-encoded, null URLs have no
target line.  An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake.llm.common import written

MAGIC = "WARC/1.0\r\n"
BASE32_OF_HEX = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")  # fixed values


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of the UTF-8 bytes of a string."""
    digest = F.sha1(text.cast("binary"))
    part = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*part), *BASE32_OF_HEX)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(record): the text of one WARC record per row, without its last line feed."""
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html")))
    # Ids and digests alone find the leaders; as a written table their size is known, so
    # that few of them are broadcast and the payloads stay where they are.
    leaders = written(rows.groupBy("digest").agg(F.min("id").alias("leader"), F.count("*").alias("n"))
                      .where("n > 1").select("digest", "leader"), "warc-leaders")
    keyed = rows.join(leaders, "digest", "left")
    revisit = F.col("leader").isNotNull() & ~F.col("id").eqNullSafe(F.col("leader"))

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))

    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size, F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    safe = F.col("url")
    for c in [*map(chr, range(33)), "\x7f"]:
        safe = F.replace(safe, F.lit(c), F.lit(f"%{ord(c):02X}"))
    target = F.when(F.col("url").rlike("[\\x00-\\x20\\x7f]"), safe).otherwise(F.col("url"))
    line = F.lit("\r\n")
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), line,
        F.lit("WARC-Record-ID: "), urn("id"), line,
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), target, line)).otherwise(""),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), line,
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("leader"), F.lit(
            "\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return keyed.select(F.concat(head, block, F.lit("\r\n\r")).alias("record"))


def write_archives(pages: DataFrame, path: str, **columns: str) -> None:
    """Archives below ``path``, one per task."""
    records(pages, **columns).write.option("lineSep", "\n").text(path)


# --- reading ---------------------------------------------------------------

CANDIDATE = ("file string, block long, place long, size long, total long, claim long, type string, id string, "
             "refers string, payload_bytes long, digest string, stated string")


def parse(segment: bytes):
    """(bytes before the body, Content-Length, fields) of what follows a magic
    line, or None if it is not a record header."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for row in segment[:end].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    return (end + 4, int(length), fields) if length.isdigit() and b"warc-type" in fields else None


def payload_of(body: bytes) -> tuple[int, bytes | None]:
    """(stated bytes, payload) of an HTTP response block."""
    head, gap, payload = body.partition(b"\r\n\r\n")
    for row in head.split(b"\r\n"):
        name, _, value = row.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value), payload
    return len(payload), payload


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_size").alias("file_size"), F.col("value").cast("binary").alias("value")))


def _placed(batches):
    """Batches with the place of each segment in its split, in bytes from the
    split's first segment; a segment owns the magic line that ends it."""
    at, place = None, 0
    for pdf in batches:
        places = []
        for file, block, value in zip(pdf["file"], pdf["block"], pdf["value"]):
            if (file, block) != at:
                at, place = (file, block), 0
            places.append(place)
            place += len(value) + len(MAGIC)
        yield pdf.assign(place=places)


def _text(fields: dict, name: bytes) -> str | None:
    value = fields.get(name)
    return None if value is None else value.decode("utf-8", "replace")


def _described(segment: bytes):
    """(claim, type, id, refers, payload bytes, digest, stated digest): the
    claim is the size from the magic line to the successor; the digest is null
    if the segment does not hold the whole body."""
    found = parse(segment)
    if found is None:
        return (None,) * 7
    head, length, fields = found
    kind, stated = _text(fields, b"warc-type"), (_text(fields, b"warc-payload-digest") or "").removeprefix("sha1:")
    size = digest = None
    if head + length <= len(segment):
        size, payload = payload_of(segment[head:head + length])
        digest = stated if kind == "revisit" else digest_of(payload)
    return (len(MAGIC) + head + length + 4, kind, _text(fields, b"warc-record-id"),
            _text(fields, b"warc-refers-to"), size, digest, stated)


def _bases(sizes: DataFrame) -> DataFrame:
    """(file, block, base) of a table (file, block, size): the bytes of the
    splits before; one row per split, a few per file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.groupBy("file", "block").agg(F.sum("size").alias("n"))
            .select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))


# The first segment of a file is what stands before its first magic line: its end is offset 0.
OFFSET = f"base + place - {len(MAGIC)}"


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment: (file, offset of its magic line, successor, the
    record's fields); the successor is null where no header follows.  ``fid``
    is a number for the file."""

    def scan(batches):
        for pdf in _placed(batches):
            rows = [(f, b, p, len(v) + len(MAGIC), s, *_described(v))
                    for f, b, p, v, s in zip(pdf["file"], pdf["block"], pdf["place"], pdf["value"], pdf["file_size"])]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in CANDIDATE.split(", ")])
            for c in ("claim", "payload_bytes"):
                out[c] = out[c].astype("Int64")
            yield out

    table = written(_segments(spark, path).mapInPandas(scan, CANDIDATE), "warc-candidates")
    files = written(table.select("file").distinct(), "warc-files").withColumn("fid", F.monotonically_increasing_id())
    bases = written(_bases(table).join(files, "file"), "warc-bases")
    return (table.join(bases, ["file", "block"])
            .select("file", "fid", F.expr(OFFSET).alias("offset"), F.expr(f"{OFFSET} + claim").alias("next"),
                    F.col("total").alias("file_size"), "type", "id", "refers", "payload_bytes", "digest", "stated"))


def chain(found: DataFrame) -> DataFrame:
    """(fid, offset) of the candidates reached from the start of each file.

    ``jump`` leads 2^k records on.  Offsets only grow along a chain, so what a
    round reaches was not reached before."""
    known = written(found.where("offset >= 0 and next is not null").select("fid", "offset", "next"), "warc-links")
    at = known.select("fid", F.col("offset").alias("next"))
    jump = written(known.join(at, ["fid", "next"], "left_semi").select("fid", "offset", "next"), "warc-jumps")
    reached = known.where("offset = 0").select("fid", "offset")
    while True:
        ahead = written(reached.join(jump, ["fid", "offset"]).select("fid", F.col("next").alias("offset")),
                        "warc-reached")
        if ahead.isEmpty():
            return reached
        reached = reached.unionByName(ahead)
        up = jump.select("fid", F.col("offset").alias("next"), F.col("next").alias("up"))
        jump = written(jump.join(up, ["fid", "next"]).select("fid", "offset", F.col("up").alias("next")), "warc-jumps")


def broken_files(found: DataFrame, reached: DataFrame) -> DataFrame:
    """(file): archives whose chain does not end at their length."""
    ends = (found.where("next = file_size").join(reached, ["fid", "offset"], "left_semi").select("fid").distinct())
    return found.where("file_size > 0").select("file", "fid").distinct().join(ends, "fid", "left_anti").select("file")


def _whole(spark: SparkSession, path: str, kept: DataFrame, cut: DataFrame) -> DataFrame:
    """(fid, offset, whole_bytes, whole_digest) of the ``cut`` records."""
    files = cut.select("file", "fid").distinct()

    def place(batches):
        for pdf in _placed(batches):
            yield pdf.assign(size=pdf["value"].map(len) + len(MAGIC))[["file", "block", "place", "size", "value"]]

    # One table of one read: places, sizes and bytes belong to the same splits.
    parts = written(_segments(spark, path).mapInPandas(
        place, "file string, block long, place long, size long, value binary")
        .join(written(files, "warc-cut-files"), "file"), "warc-parts")
    mark = kept.select("fid", "offset", F.col("offset").alias("owner"))
    before = Window.partitionBy("fid").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    places = (parts.select("file", "fid", "block", "place").join(_bases(parts), ["file", "block"])
              .withColumn("offset", F.expr(OFFSET)).where("offset >= 0"))
    owned = (places.join(mark, ["fid", "offset"], "left")
             .withColumn("owner", F.last("owner", ignorenulls=True).over(before))
             .join(cut.select("fid", F.col("offset").alias("owner")), ["fid", "owner"], "left_semi")
             .select("file", "block", "place", "offset", "owner"))

    def join_up(pdf):
        pdf = pdf.sort_values("offset")
        _, _, _, _, size, digest, _ = _described(MAGIC.encode().join(pdf["value"]))
        return pd.DataFrame({"fid": [pdf["fid"].iloc[0]], "offset": [pdf["owner"].iloc[0]],
                             "whole_bytes": pd.array([size], dtype="Int64"), "whole_digest": [digest]})

    # A group is the parts of one record.
    return (parts.join(owned, ["file", "block", "place"]).groupBy("fid", "owner")
            .applyInPandas(join_up, "fid long, offset long, whole_bytes long, whole_digest string"))


def read_archives(spark: SparkSession, path: str, *, broken: str = "raise") -> DataFrame:
    """(file, offset, page_id, payload_bytes, payload_digest, record_type,
    refers_to, intact) of every record on the chains; ids are strings,
    ``intact`` says that the payload has the stated digest.

    ``broken="raise"``: a chain that doesn't reach the end of its file is an
    error; ``"keep"``: its records up to the break are returned."""
    found = candidates(spark, path)
    reached = chain(found)
    if broken == "raise":
        names = [r["file"] for r in broken_files(found, reached).limit(5).collect()]
        if names:
            raise ValueError("the chain of records does not reach the end of " + ", ".join(names))
    kept = written(found.join(reached, ["fid", "offset"], "left_semi"), "warc-records")
    cut = kept.where("digest is null")
    if not cut.isEmpty():
        whole = written(_whole(spark, path, kept, cut), "warc-whole")
        kept = (kept.join(whole, ["fid", "offset"], "left")
                .withColumn("payload_bytes", F.coalesce("payload_bytes", "whole_bytes"))
                .withColumn("digest", F.coalesce("digest", "whole_digest")))
        if broken == "raise":
            lost = cut.join(whole.where("whole_digest is not null"), ["fid", "offset"], "left_anti").count()
            if lost:
                raise ValueError(f"{lost} records whose payloads hold magic lines could not be put together")

    def plain(c):
        value = F.regexp_extract(c, "^<urn:page:(.*)>$", 1)
        return F.when((value != "") & (value != "null"), value)

    return kept.select("file", "offset", plain("id").alias("page_id"), "payload_bytes",
                       F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                       plain("refers").alias("refers_to"), F.col("digest").eqNullSafe(F.col("stated")).alias("intact"))
