"""WARC splits, long texts, packing, masking, the ledger, toxicity and the whole pipeline."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from obslake.llm import packing, secrets, toxicity, warc

SF = "/root/testdata/sf0.001"
INNER = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"


# --- op2 -----------------------------------------------------------------------

@pytest.fixture()
def archive(spark, tmpdir_path):
    """40 pages in one file, some with whole records in their payloads."""
    pages = [(i, f"http://h/{i}", ("x" * 50 * i + INNER * (i % 3 == 0) + "é" * i + INNER * (i % 6 == 0)) or None) for i in range(40)]
    pages += [(100, "u", pages[7][2]), (100, "u", pages[7][2])]          # equal payloads, repeated rows
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archives(df.coalesce(1), tmpdir_path + "/w")
    return tmpdir_path + "/w", pages


def digests(pages):
    return sorted((str(i), len((h or "").encode()), warc.digest_of((h or "").encode())) for i, _, h in pages)


def read_back(rows):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in rows)


@pytest.mark.parametrize("size", ["3000", "100m"])
def test_warc_splits_anywhere(spark, archive, size):
    path, pages = archive
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert read_back(rows) == digests(pages) and all(r.intact for r in rows)
    assert sorted((r.page_id, r.refers_to) for r in rows if r.record_type == "revisit") == [("100", "7")] * 2


def test_warc_splits_may_move_between_the_reads(spark, archive, monkeypatch):
    path, pages = archive
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = warc._whole

    def moved(*args):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        return whole(*args)

    monkeypatch.setattr(warc, "_whole", moved)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
        rows = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert read_back(rows) == digests(pages) and all(r.intact for r in rows)


def test_warc_broken_chain_is_an_error(spark, tmpdir_path):
    good = "WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    with open(tmpdir_path + "/x.warc", "w", newline="") as f:
        f.write(good + good.replace("Content-Length: 2", "Content-Length: 3") + good)
    with pytest.raises(ValueError, match="x.warc"):
        warc.read_archives(spark, tmpdir_path)
    assert [r.offset for r in warc.read_archives(spark, tmpdir_path, broken="keep").collect()] == [0, len(good)]


# --- op3 -----------------------------------------------------------------------

@pytest.mark.parametrize("text", ["a" + "\n" * 1_000_000 + "b", " " * 2_000_000, "ab" * 1_000_000, "!?" * 100_000],
                         ids=["newlines", "blanks", "letters", "marks"])
def test_packing_of_very_long_runs(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = packing.pack_documents(df).orderBy("start").collect()
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    assert ids.tolist() == [*packing.json_encoder()(text), packing.END_ID]
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in rows)


def shortest_pack_first(lengths, size):
    """Padding-free rule, a piece at a time: the open pack with the fewest tokens, or a new one."""
    packs = []
    for n in sorted(lengths, reverse=True):
        at = min(range(len(packs)), key=packs.__getitem__, default=None)
        if at is None or packs[at] + n > size:
            packs.append(n)
        else:
            packs[at] += n
    return packs


@pytest.mark.parametrize("seed", range(6))
def test_place_puts_every_piece_once_and_packs_as_well_as_brute_force(seed):
    rng = random.Random(seed)
    size = 64
    histogram = {n: rng.randrange(1, 30) for n in rng.sample(range(1, size + 1), rng.randrange(1, 40))}
    placements, packs = packing.place(histogram, size)
    filled = {}
    for n, count in histogram.items():
        runs = [*placements[n], (count, None, None)]
        for (rank, first, offset), (until, _, _) in zip(runs, runs[1:]):
            for k in range(until - rank):
                filled.setdefault(first + k, []).append((offset, n))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= size
    assert sorted(filled) == list(range(len(filled)))
    of_pack = {first + k: tokens for first, count, tokens in packs for k in range(count)}
    assert of_pack == {p: sum(n for _, n in parts) for p, parts in filled.items()}
    brute = shortest_pack_first([n for n, c in histogram.items() for _ in range(c)], size)
    assert sorted(of_pack.values()) == sorted(brute)


def test_packing_fills_sequences(spark):
    rows = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"), with_ids=False)
    r = rows.agg(F.sum("length").alias("n"), (F.max("sequence_id") + 1).alias("k")).head()
    assert r.n / (r.k * packing.SIZE) >= 0.98


def test_packing_edges(spark):
    kind = "doc_id long, text string, length long, rank long"
    assert packing.pack_documents(spark.createDataFrame([], kind)).collect() == []
    rows = packing.pack_documents(spark.createDataFrame([(None, None, 1, 1), (1, "", 1, 1), (1, "", 1, 1)], kind)).collect()
    assert [(r.length, r.doc_tokens, r.padded_tokens) for r in rows] == [(1, 1, 2048)] * 3
    assert sorted(r.offset for r in rows) == [0, 1, 2]


# --- op1 -----------------------------------------------------------------------



def test_masking_equals_brute_force(spark, tmpdir_path):
    rng = random.Random(4)
    bits = ["secret=abcdef1", "é🙂", "AKIA" + "Z" * 20, "f" * 30, " token: x9x9x9x9 ", "x" * 500, "\n", "api_key='" + "0a" * 20 + "'"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(60)] + [None, "", "clean"]
    df = spark.createDataFrame([(i, t, -1, "b") for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, blob string")
    rules = secrets.BASE_RULES
    out = secrets.redact(df, tmpdir_path + "/l", rules=rules).orderBy("doc_id").collect()
    for r, t in zip(out, texts):
        spans = [] if t is None else sorted((m.start(), m.end()) for x in rules for m in re.finditer(x.pattern, t)
                                            if len(m.group(x.group)) >= x.least)
        want, at, first = "", 0, True
        for a, b in spans:
            if first or a > at:
                want, first = want + t[at:a] + "[SECRET]", False
            at = max(at, b)
        want = t if t is None else want + t[at:]
        assert r.text == want and r.n_chars == (len(want) if spans else -1) and r.blob == "b"


def test_many_secrets_in_one_text_are_masked_in_one_pass(spark, tmpdir_path):
    text = "secret=abcdef1 word\n" * 60_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert secrets.redact(df, tmpdir_path + "/l").head().text == "[SECRET] word\n" * 60_000


def test_a_blob_scanned_twice_has_its_spans_once(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "secret=abcdef1"), (2, "secret=abcdef1"), (3, None)], "doc_id long, text string")
    rows = secrets.scan_blobs(df.select(secrets.blob_of("text").alias("blob"), F.coalesce("text", F.lit("")).alias("text"),
                                        F.expr("array()").cast("array<string>").alias("seen")).distinct(), secrets.RULES)
    for _ in range(2):                                  # two runs that did not see each other
        rows.write.mode("append").parquet(tmpdir_path + "/l")
    found = secrets.findings(df, tmpdir_path + "/l")
    assert [r.n for r in found.orderBy("doc_id").select(F.size("spans").alias("n")).collect()] == [1, 1, 0]
    assert spark.read.parquet(tmpdir_path + "/l").count() == 4


def test_second_run_scans_only_new_blobs(spark, tmpdir_path):
    df = spark.createDataFrame([(i, f"token: value{i % 7}") for i in range(50)], "doc_id long, text string")
    secrets.scan(df.where("doc_id < 3"), tmpdir_path + "/l")
    assert spark.read.parquet(tmpdir_path + "/l").count() == 3
    found = secrets.findings(df, tmpdir_path + "/l")
    assert spark.read.parquet(tmpdir_path + "/l").count() == 7
    assert found.where(F.size("spans") == 1).count() == 50
    assert secrets.findings(df.limit(0), tmpdir_path + "/l").collect() == []


# --- op10 ----------------------------------------------------------------------

def test_fit_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"copy {i}", "t") for i in range(3000)] + [(i, "x", "t") for i in range(2, 40)],
                                 "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1)] * 5 + [(None, 1), (3, None), (4, 7)],
                                   "doc_id long, toxic int")
    rows = toxicity.fit_sample(docs, labels, "doc_id", "text", "toxic", 5).collect()
    assert len(rows) <= 10 and len({(r.label, r.text) for r in rows if r.text.startswith("copy")}) <= 1


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 30).astype(float)
    row, col = np.nonzero(rng.random((30, 8)) < 0.4)
    s = rng.integers(-1, 2, (12, 3)).astype(float)
    rest = (np.array([1, 4, 6]), s.T @ s, 12, 1e-3, 0.7)
    w, b, h = rng.normal(size=8), 0.3, 1e-6
    _, grad, by_b = toxicity.loss(w, b, y, row, col, *rest)
    for i in range(8):
        up, down = w.copy(), w.copy()
        up[i] += h
        down[i] -= h
        slope = (toxicity.loss(up, b, y, row, col, *rest)[0] - toxicity.loss(down, b, y, row, col, *rest)[0]) / (2 * h)
        assert abs(slope - grad[i]) < 1e-6
    slope = (toxicity.loss(w, b + h, y, row, col, *rest)[0] - toxicity.loss(w, b - h, y, row, col, *rest)[0]) / (2 * h)
    assert abs(slope - by_b) < 1e-6


def test_counterfactual_penalty_closes_the_gap(spark):
    """Toxic rows name one group, clean rows another: only the penalty keeps the name neutral."""
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 2
        group = "women" if rng.random() < (0.9 if toxic else 0.1) else "men"
        insult = "awful vile" if toxic and rng.random() < 0.8 else "calm"
        rows.append((i, f"These {group} are {insult}. filler{rng.randrange(50)} text."))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    y = spark.createDataFrame(labels, "doc_id long, toxic int")

    def gap(strength):
        model = toxicity.fit(docs, y, counterfactual=strength)
        a, b = model.logits(["These women are calm.", "These men are calm."])
        return abs(a - b)

    assert gap(0.0) > 1.0 and gap(10.0) < 0.2 * gap(0.0)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = (docs.join(labels, "doc_id").where(toxicity.is_held_out("doc_id"))
            .select("toxic", (toxicity.score(model) >= toxicity.THRESHOLD).alias("said")).collect())
    clean = [r.said for r in rows if r.toxic == 0]
    toxic = [r.said for r in rows if r.toxic == 1]
    assert np.mean(clean) <= 0.02 and np.mean(toxic) >= 0.6


def test_toxicity_of_empty_and_long_texts(spark):
    model = toxicity.ToxicityModel()
    kind = "doc_id long, text string, score string"
    df = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "w " * 1_000_000, "s"), (2, "", "s")], kind)
    assert [r.p for r in df.select(toxicity.score(model).alias("p")).collect()] == [0.5] * 4
    assert df.limit(0).select(toxicity.score(model)).collect() == []


# --- the pipeline ----------------------------------------------------------------

KIND = "doc_id long, text string, lang string, source string, n_chars long, label string, blob string, start string"


def run_on(spark, folder, rows, bench, labels):
    spark.createDataFrame(rows, KIND).write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    return corpus_pipeline.run(spark, folder)


def test_pipeline_end_to_end(spark, tmpdir_path):
    def prose(n, seed):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(5000)}" for _ in range(n))

    item = "the quick brown fox jumps over the lazy dog while seven wizards brew potions"
    texts = {1: prose(200, 1), 2: prose(200, 1), 3: prose(150, 3) + " password=hunter2hunter2 end", 4: None, 5: "",
             6: prose(50, 6) + f" {item} " + prose(50, 7), 7: prose(400_000, 8), 8: "a " + "\n" * 200_000 + "b"}
    rows = [(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in texts.items()]
    rows += [rows[2], (None, prose(60, 11), None, None, None, None, None, None)]     # repeated row, null id
    out = run_on(spark, tmpdir_path, rows, [(1, item), (2, None)], [(1, 1, 0), (3, 1, 0)]).collect()
    encode = packing.json_encoder()
    whole = {}
    for r in sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start)):
        whole.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    want = {i: t for i, t in texts.items() if i not in (2, 6)}
    want[3] = want[3].replace("password=hunter2hunter2", "[SECRET]")
    want[None] = rows[-1][1]
    empties = {4, 5} & set(whole)
    assert len(empties) == 1                              # null and empty texts are copies of each other
    for i in {4, 5} - empties:
        want.pop(i)
    assert set(whole) == set(want)
    for i, t in want.items():
        assert whole[i] == [*encode(t or ""), packing.END_ID], i


def test_pipeline_of_empty_tables(spark, tmpdir_path):
    out = run_on(spark, tmpdir_path, [], [], [])
    assert out.collect() == [] and {"doc_id", "ids", "sequence_id", "offset"} <= set(out.columns)
