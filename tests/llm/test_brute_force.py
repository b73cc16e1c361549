"""Operators against plain Python versions of their definitions."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from obslake.llm import decontaminate, langid, licenses, urls


# --- licences --------------------------------------------------------------

def brute_sequence(text):
    """The identifiers of a text, by recursion over the ways to cut it."""
    names = {s: name for name, said in licenses.SENTENCES.items() for s in said}
    least = min(map(len, names))

    def cut(s, ends):
        if len(s) < least:
            return [] if regex.fullmatch(r"[^\p{L}\p{N}]*[0-9]{1,2}[^\p{L}\p{N}]*", s) else ["?"]
        if licenses.normal(s) in names:
            return [names[licenses.normal(s)]]
        if not ends:
            return ["?"]
        return [x for part in regex.sub(ends[0], "\\1\x01", s).split("\x01") for x in cut(part, ends[1:])]

    body = text or ""
    for pattern, by in ((licenses.COMMENT_WORD, ""), (licenses.SPDX_TAG, r"\1 "), (licenses.LICENSE_AT, r"\1 "),
                        (licenses.VERSION_AT, r"\1 ")):
        body = regex.sub(pattern, by, body)
    ends = (licenses.SENTENCE_END, licenses.BLOCK_END, licenses.COLON, licenses.LINE_END)
    out = []
    for x in [x for part in regex.sub(ends[0], "\\1\x01", body).split("\x01") for x in cut(part, ends[1:])]:
        if x != "?" or not out or out[-1] != "?":
            out.append(x)
    return out


def brute_licenses(text):
    """(licenses, sequence, unmatched) of a text."""
    seq = brute_sequence(text)
    if set(seq) <= {"?"}:
        return "", "", ""
    left, names = list(seq), []
    for name, rule in licenses.RULES:
        at, hit = 0, False
        while at + len(rule) <= len(left):
            if tuple(left[at:at + len(rule)]) == rule:
                left[at:at + len(rule)], hit = ["/"], True
            at += 1
        if hit and name not in names:
            names.append(name)
    return ",".join(names), ",".join(seq), ",".join(x for x in left if x not in "?/")


def license_texts(n, seed):
    rng = random.Random(seed)
    said = [s for all_ in licenses.SENTENCES.values() for s in all_]
    junk = ["the cat sat", "Copyright (c) 2020 X", "1", "2.", "*", "", "a license for v. 2 of it", "rem", "import os",
            "this software is good", "SPDX-License-Identifier: MIT"]
    for _ in range(n):
        out = []
        for _ in range(rng.randrange(1, 9)):
            s = rng.choice(said) if rng.random() < 0.6 else rng.choice(junk)
            if rng.random() < 0.5:
                s = " ".join(w.upper() if rng.random() < 0.3 else w for w in s.split(" "))
            if rng.random() < 0.3:
                s = s.replace(" ", rng.choice(["\n", "  ", " - "]), rng.randrange(1, 5)).replace("license", "licence")
            out += [s, rng.choice([". ", ".\n", "\n\n", ": ", "\n", "; ", ".\n\n1. ", "! "])]
        yield "".join(out)


def test_license_scan_equals_brute_force(spark):
    texts = [*license_texts(400, 3), None, "", "x", "plain words. " * 60_000, "\n" * 100_000 + "MIT License\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = licenses.find_licenses(df).orderBy("doc_id").collect()
    assert [(r.licenses, r.sequence, r.unmatched) for r in got] == [brute_licenses(t) for t in texts]


def test_every_known_sentence_holds_an_anchor():
    words = licenses.anchor_words()
    assert all(any(w in s for w in words) for said in licenses.SENTENCES.values() for s in said)
    assert len(words) < 20
    known = {s for _, rule in licenses.RULES for s in rule}
    # These only confirm a licence that another sentence names.
    assert set(licenses.SENTENCES) - known == set()


BSD = """Copyright (c) 2020, X
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
AGPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""


@pytest.mark.parametrize("text, expected", [
    (BSD, "BSD-2-Clause,Proprietary"), (BSD + NAMES, "BSD-3-Clause,Proprietary"), (MPL, "MPL-2.0"),
    (AGPL, "AGPL-3.0-or-later"), (AGPL.replace("Affero", "Lesser"), "LGPL-3.0-or-later"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("SPDX-License-Identifier: CC0-1.0", "CC0-1.0"), ("// SPDX-License-Identifier: LGPL-2.1-only", "LGPL-2.1-only")])
def test_license_families(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert licenses.find_licenses(df).head().licenses == expected


# --- language --------------------------------------------------------------

def bucket_of(gram):
    """The cell of an n-gram, in Python integers."""
    full, x = (1 << 64) - 1, 0
    for ch in gram:
        x = (x * 0x100000001B3 + ord(ch) + 1) & full
    x = (x + len(gram)) & full
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & full
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & full
    return (x ^ (x >> 31)) >> (64 - langid.BITS)


def grams(text):
    kept = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    body = f" {' '.join(kept)} " if kept else ""
    return [bucket_of(body[i:i + n]) for n in range(1, langid.ORDERS + 1) for i in range(len(body) - n + 1)]


def test_language_equals_naive_bayes_by_dictionary(spark):
    rng = random.Random(4)
    words = {"en": "the cat sat on that mat with hats", "fr": "le chat était sur cette table où", "de": "die katze saß über"}
    rows = []
    for i in range(60):
        lang = rng.choice([*words])
        text = " ".join(rng.choice(words[lang].split()) for _ in range(rng.randrange(1, 12)))
        rows.append((i, rng.choice([text, text.upper(), text + " 12, 3"]), None if i % 11 == 0 else lang))
    rows += [(60, None, "en"), (61, "", "fr"), (62, "12 3!", "de"), (63, rows[0][1], "en"), (63, rows[0][1], "en"),
             (None, "die katze", "de"), (64, "the le die " * 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    n_texts, counts = Counter(), defaultdict(Counter)
    for i, text, lang in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 5 and text is not None and lang and grams(text):
            n_texts[lang] += 1
            counts[lang].update(grams(text))
    total = {k: sum(c.values()) + 0.5 * 2 ** langid.BITS for k, c in counts.items()}

    def brute(text):
        found = grams(text or "")
        if not found:
            return "und", 0.0
        log_p = {k: math.log((n_texts[k] + 1) / (sum(n_texts.values()) + len(n_texts)))
                 + sum(math.log((counts[k][g] + 0.5) / total[k]) for g in found) for k in sorted(n_texts)}
        best = max(log_p, key=log_p.get)
        return best, 1 / sum(math.exp(v - log_p[best]) for v in log_p.values())

    got = Counter((r.doc_id, r.lang_pred, round(r.score, 3))
                  for r in langid.predict(df, langid.fit(df)).collect())
    assert got == Counter((i, brute(t)[0], round(brute(t)[1], 3)) for i, t, _ in rows)


def test_equal_likelihoods_go_to_the_smallest_language(spark):
    rows = [(i, "same words here", lang) for i, lang in ((1, "b"), (2, "a"), (3, "b"), (4, "a"))]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5] + [(9, "same words", None)]
    n = Counter(r[2] for r in rows if r[2])
    assert n["a"] == n["b"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.predict(df, langid.fit(df)).collect()} == {"a"}


# --- benchmark items ---------------------------------------------------------

def substring_distance(item, body):
    """Smallest edit distance of ``item`` to any substring of ``body``."""
    row = [0] * (len(body) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i] * (len(body) + 1)
        for j, b in enumerate(body, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a != b))
    return min(row)


def damaged(text, n, rng):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1:], text[:at] + "x" + text[at:], text[:at] + "y" + text[at + 1:]])
    return text


def leaks_case(seed, n_docs=40):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]

    def passage(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(i, passage(rng.choice([2, 6, 12, 20]))) for i in range(8)] + [(8, None), (9, "!!"), (1, "alpha beta")]
    docs = []
    for i in range(n_docs):
        _, item = items[rng.randrange(8)]
        docs.append((i, f"{passage(8)}, {damaged(item, rng.randrange(0, 9), rng)} {passage(5)}.".upper()))
    return docs + [(90, None), (91, ""), (92, docs[0][1]), (92, docs[0][1]), (None, docs[1][1])], items


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 60])
def test_decontamination_equals_brute_force(spark, monkeypatch, block_chars):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block_chars)
    docs, items = leaks_case(7)
    df = spark.createDataFrame([(i, t, "e", 1) for i, t in docs], "doc_id long, text string, end string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = Counter()
    for i, text in docs:
        for key, item in items:
            body, said = decontaminate.normal(text or ""), decontaminate.normal(item or "")
            if said and body:
                k, d = decontaminate.budget(said, decontaminate.RATE), substring_distance(said, body)
                if d <= k and (k or f" {said} " in f" {body} "):
                    expected[i, key, d] += 1
    got = decontaminate.matches(df, bench).collect()
    assert Counter((r.doc_id, r.item_id, r.distance) for r in got) == expected
    text_of, item_of = dict(docs), defaultdict(list)
    for key, item in items:
        item_of[key].append(decontaminate.normal(item or ""))
    for r in got:
        passage = decontaminate.normal(text_of[r.doc_id].lower()[r.start:r.end])
        assert any(substring_distance(said, passage) == r.distance for said in item_of[r.item_id] if said)
    kept = Counter((r.doc_id, r.text) for r in decontaminate.without_leaks(df, bench).collect())
    assert kept == Counter(d for d in docs if not any(d[0] == i for i, _, _ in expected))


def test_decontamination_of_empty_tables(spark):
    df = spark.createDataFrame([(1, "alpha beta")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    assert decontaminate.matches(df.limit(0), bench).collect() == []
    assert decontaminate.matches(df, bench.limit(0)).collect() == []
    assert decontaminate.without_leaks(df, bench.limit(0)).count() == 1
    assert decontaminate.without_leaks(df.limit(0), bench).count() == 0
    long_text = "gamma " * 200_000 + "alpha beta"
    one = df.withColumn("text", F.lit(long_text))
    assert decontaminate.matches(one, bench).head().distance == 0


# --- URL rules ---------------------------------------------------------------

def brute_verdict(host, path, rules):
    hits = [(len(h) + len(p), len(h), v == urls.BLOCK, h + p) for h, p, v in rules
            if h is not None and p is not None and v is not None
            and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    if not hits:
        return None, urls.ALLOW
    size, host_size, blocks, rule = max(hits)
    return rule, urls.BLOCK if blocks else urls.ALLOW


def test_url_rules_of_many_shapes_equal_brute_force(spark):
    rng = random.Random(9)

    def word(n):
        return "".join(rng.choice("abc") for _ in range(n))

    hosts = [".".join(word(rng.randrange(1, 3)) for _ in range(rng.randrange(1, 6))) for _ in range(40)]
    rules = list({(rng.choice(hosts), "/" + word(rng.randrange(0, 60))): rng.choice(["allow", "block"])
                  for _ in range(400)}.items())
    rules = [(h, p, v) for (h, p), v in rules] + [("a", "/", "block"), ("a", "/", "block"), (None, "/", "allow"),
                                                  ("b", None, "allow"), ("b", "/", None)]
    pages = [(i, f"http://{rng.choice(hosts)}{rng.choice(rules)[1] or ''}{word(3)}?q#f") for i in range(300)]
    pages += [(300, None), (301, ""), (302, "no scheme"), (303, pages[0][1]), (303, pages[0][1]), (None, pages[1][1]),
              (304, "http://a/" + "b" * 1_000_000)]
    df = spark.createDataFrame([(i, u, "x") for i, u in pages], "page_id long, url string, digest string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    assert len({(h.count("."), len(p)) for h, p, _ in rules if h and p}) > 100
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, table).collect())
    expected = Counter()
    for i, u in pages:
        rest = (u or "").partition("://")[2]
        host, path = regex.match("[^/?#]*", rest)[0].lower(), regex.match("[^/?#]*([^?#]*)", rest)[1]
        expected[(i, host, path, *brute_verdict(host, path, rules))] += 1
    assert got == expected
    assert urls.judge(df.limit(0), table).collect() == []
    assert {r.verdict for r in urls.judge(df, table.limit(0)).collect()} == {urls.ALLOW}
