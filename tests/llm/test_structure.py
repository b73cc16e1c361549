"""Conversation repair, sharding and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from obslake.llm import conversations, sharding, spelling
from obslake.llm.oracle import ORACLE_SQL
from obslake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL) & set(QUERIES)))
def test_query_equals_sql(spark, name):
    out = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == sorted(out.columns)
    at = [rel.columns.index(c) for c in out.columns]
    want = sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())
    assert sorted(repr(tuple(r)) for r in out.collect()) == want


# --- conversations -----------------------------------------------------------

NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def best_repair(rows):
    """(cost, audit, lines) of (role, text, must go, truncated), whole strings a state."""
    def put(into, state, offer):
        if state not in into or offer[:2] < into[state][:2]:
            into[state] = offer

    def inserts(best):
        for _ in range(3):
            for state, (c, e, o) in list(best.items()):
                for role in ("user", "assistant"):
                    if after := NEXT[state].get(role[0]):
                        put(best, after, (c + 3, e + "I", (*o, f"{role}:")))
        return best

    best = inserts({"": (0, "", ())})
    for role, text, go, cut in rows:
        new = {}
        for state, (c, e, o) in best.items():
            put(new, state, (c + 4, e + "D", o))
            if go:
                continue
            if after := NEXT[state].get(role[:1]):
                put(new, after, (c + 3 * cut, e + "K", (*o, f"{role}:{text}")))
            for r in ("user", "assistant"):
                if after := NEXT[state].get(r[0]):
                    put(new, after, (c + 3 + 3 * cut, e + "R", (*o, f"{r}:{text}")))
        best = inserts(new)
    return min((best[k] for k in ("", "a") if k in best), key=lambda v: v[:2])


def brute_conversations(rows):
    all_of = {}
    for conv, turn, role, text in rows:
        own = all_of.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        own += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = set()
    for conv, own in all_of.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, n = set(), [], [0, 0, 0]
        for _, role, text in own:
            body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            faults = [not body, (role, text) in seen, bool(body) and body[-1] not in ".!?"]
            seen.add((role, text))
            if any(faults):
                n[faults.index(True)] += 1
            marked.append((role, text, faults[0] or faults[1], faults[2]))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(own, own[1:]))
        cost, audit, lines = best_repair(marked)
        out.add((conv, gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def random_rows(seed, n_conv, n_turns):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Hi.", "Hi", " \t", "", None, "yes!", "why?\n", "é\x85", "a. b", "x"]
    rows = []
    for c in [None, *range(n_conv)]:
        for _ in range(rng.randrange(n_turns)):
            rows.append((c, rng.choice([None, *range(n_turns)]), rng.choice(roles), rng.choice(texts)))
    return rows


def test_repair_equals_brute_force(spark):
    rows = random_rows(1, 300, 12)
    rows += rows[:40]                     # repeated rows
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, seen string, copies int")
    got = {tuple(r) for r in conversations.repair(conversations.damage(df)).collect()}
    assert got == brute_conversations(rows)


def test_repaired_turns_match_the_hashes(spark):
    df = spark.createDataFrame(random_rows(2, 60, 10), "conv_id long, turn long, role string, text string")
    hurt = conversations.damage(df)
    lines = {}
    for r in conversations.repaired_turns(hurt).orderBy("conv_id", "position").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in conversations.repair(hurt).collect():
        assert hashlib.sha256("\n".join(lines.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_repair_edges(spark):
    kind = "conv_id string, turn int, role string, text string"
    assert conversations.repair(conversations.undamaged(spark.createDataFrame([], kind))).collect() == []
    one = conversations.undamaged(spark.createDataFrame([("c", None, None, None)] * 1000, kind))
    r = conversations.repair(one).head()
    assert (r.gaps, r.blank, r.duplicate, r.cost, r.audit) == (0, 1000, 0, 4000, "D" * 1000)
    long = "word " * 400_000 + "end."
    pair = spark.createDataFrame([("c", 1, "user", long), ("c", 2, "assistant", "ok.")], kind)
    r = conversations.repair(conversations.undamaged(pair)).head()
    assert (r.cost, r.audit) == (0, "KK")
    assert r.repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:ok.".encode()).hexdigest()


def test_survivors_coalesce():
    """Edits leave as soon as they are certain: few nodes stay, whatever the length."""
    rng = random.Random(3)

    def nodes(n):
        return 1 + sum(map(nodes, n.kids))

    for roles in ("ua", "u", "a", "uuaa", "suax"):
        edits = []
        search = conversations.Repair(lambda *e: edits.append(e))
        for _ in range(5000):
            search.row(rng.choice(roles), "t", 1, rng.random() < 0.1, rng.random() < 0.2)
            assert nodes(search.root) < 200
        for _ in range(5000):          # a run of deletions is one node
            search.row("u", "", 1, True, False)
        assert nodes(search.root) < 200
        assert sum(n for e, n, _, _ in edits if e != "I") > 4000


# --- sharding ----------------------------------------------------------------

@pytest.mark.parametrize("rows", [1, 2, 3, 7, 40, 41, 1000, 4099])
def test_feistel_is_a_permutation(spark, rows):
    df = spark.range(rows).select("id", sharding.permuted(F.col("id"), rows, seed=3).alias("v"))
    df = df.select("id", "v", sharding.permuted(F.col("v"), rows, seed=3, inverse=True).alias("back"))
    got = df.collect()
    assert sorted(r.v for r in got) == list(range(rows)) and all(r.back == r.id for r in got)


def test_shards_are_reproducible_and_even(spark):
    texts = [None, "", "é" * 3, "x" * 3_000_000, "same", "same"]
    rows = [(i if i % 7 else None, texts[i % len(texts)], "clash", i) for i in range(500)] + [(5, "hot", "c", 1)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, size int")
    got = [sorted(map(tuple, sharding.shard_documents(d, shards=40).collect()), key=repr)
           for d in (df.repartition(1), df.repartition(13))]
    assert got[0] == got[1] and len(got[0]) == 800
    slots = {}
    for doc_id, size, crc, number, shard, slot in got[0]:
        slots.setdefault(shard, []).append(slot)
    assert len(slots) == 40 and {len(s) for s in slots.values()} == {20}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(r[3] for r in got[0]) == list(range(800))
    sizes = {(t, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in [*texts, "hot"]}
    assert {(r[1], r[2]) for r in got[0]} == {(n, c) for _, n, c in sizes}
    assert sharding.shard_documents(df.limit(0)).collect() == []


def test_row_at_a_place_and_written_shards(spark, tmpdir_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    placed = sharding.placed(df, ["doc_id"], 7)
    back = placed.withColumn("n", sharding.number_at(F.col("shard"), F.col("slot"), 100, 7))
    assert all(r.n == r.row_number == r.doc_id for r in back.collect())
    assert spark.range(1).select(sharding.number_at(F.lit(6), F.lit(99), 100, 7).alias("n")).head().n is None
    sharding.write_shards(df, tmpdir_path + "/s", ["doc_id"], 7)
    read = {(r.doc_id, r.text, r.shard, r.slot) for r in spark.read.parquet(tmpdir_path + "/s").collect()}
    assert read == {(r.doc_id, r.text, r.shard, r.slot) for r in placed.collect()}


# --- spelling ----------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.mark.parametrize("letters, lengths", [("ab", range(1, 9)), ("abcé", range(7, 10)), ("a", range(1, 12))])
def test_near_pairs_equal_brute_force(spark, letters, lengths):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices(letters, k=rng.choice(lengths))) for _ in range(400)})
    want = sorted((a, b) for a in words for b in words if one_edit(a, b) and (len(a), a) < (len(b), b))
    df = spark.createDataFrame([(w,) for w in words], "word string").cache()
    for spread in (spelling.SPREAD, 0, 10 ** 6):      # both ways of joining a key, and either alone
        assert sorted(map(tuple, spelling.near_pairs(df, spread=spread).collect())) == want


def test_spelling_edges(spark):
    def damaged(i, w):
        h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
        return w if h % 31 else w[:h % len(w)] + w[h % len(w) + 1:]

    texts = [(1, "Colour-colouring, COLOURING"), (None, "colouring"), (2, None), (3, ""), (4, "École ÉCOLEXY ÷×÷×÷×÷ short"),
             (4, "École ÉCOLEXY ÷×÷×÷×÷ short"), (5, "colourin g " * 3), (6, "kolouring kolouring " + "colouring " * 40_000)]
    df = spark.createDataFrame([(*t, "x", "w") for t in texts], "doc_id long, text string, word string, run string")
    counts = {}
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = damaged(i, "".join(c.lower() if c.isascii() else c for c in run))
            counts[w] = counts.get(w, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = {r.word: r for r in spelling.group_variants(df).collect()}
    assert {w: r.n for w, r in got.items()} == counts
    for w, r in got.items():
        near = sorted((-counts[o], o) for o in counts if o != w and one_edit(o, w))
        form = near[0][1] if near and -near[0][0] >= 10 * counts[w] else None
        assert (r.n_near, r.form, r.form_n) == (len(near), form, form and counts[form])
    assert got["kolouring"].root == "colouring"
    assert spelling.group_variants(df.limit(0)).collect() == []


def test_roots_follow_chains_and_ties_go_to_the_smallest(spark):
    n = {"aaaaaaa": 1000, "aaaaaab": 100, "aaaaabb": 10, "aaaabbb": 1, "zaaaabb": 100}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(df).collect()}
    assert got == {"aaaaaaa": (None, "aaaaaaa", 1), "aaaaaab": ("aaaaaaa", "aaaaaaa", 2),
                   "aaaaabb": ("aaaaaab", "aaaaaaa", 3), "aaaabbb": ("aaaaabb", "aaaaaaa", 1),
                   "zaaaabb": (None, "zaaaabb", 1)}
