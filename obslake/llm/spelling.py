"""Spelling variants: words one edit apart, by asymmetric q-chunks (DataFrame functions only).

A word of L letters contributes two disjoint chunks of q = L div 2 letters, at
0 and q.  A word of L or L + 1 letters contributes its positional q-grams.  One
edit touches one chunk at most, so of any two words one edit apart the shorter
(or equally long) one has a chunk that is a gram of the other, shifted by at
most one place.  Grams whose place is no chunk's, nor one after it, can join
nothing and are not made.

1. Join chunks and grams on (L, chunk, letters).
2. A key of many words is not joined as it stands.  If its pairs outnumber
   ``SPREAD`` times its words, both sides meet on the rest of the word as well,
   with one letter left out: equally long rests on (place, rest without it),
   a rest and a longer one on the shorter.  All of its near pairs are found in
   work proportional to its words, not to their square.
3. A pair is taken at the first chunk and shift that it shares, and verified
   with the Levenshtein distance.

Words come from whole texts: maximal runs of letters (``LETTERS``), A-Z in
lower case; equal occurrences are counted map-side before they are shuffled.

Edge cases: null and empty texts have no words; a null id is the text ``null``
in the damage rule.  Repeated rows count each.  A text of any length is cut
into its runs by one expression.  Ties between forms go to the word that is
smallest in code-point order.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import written

LETTERS = r"[a-zÀ-ÿ]"         # after lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_COUNT = 7, 2
DAMAGE_MOD = 31
RATIO = 10
SPREAD = 8


def occurrences(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                least: int = LEAST_LETTERS) -> DataFrame:
    """(doc_id, run) of every run of at least ``least`` letters."""
    lower = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    # A run of fewer letters cannot match, and a longer one matches whole.
    runs = F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    return docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("doc_id"),
                       F.explode(runs).alias("run"))


def damaged(run: Column, doc_id: Column, mod: int = DAMAGE_MOD) -> Column:
    """``run`` without the letter at h mod its length, where h, the unsigned
    CRC-32 of ``doc_id:run``, is a multiple of ``mod``."""
    h = F.crc32(F.concat_ws(":", doc_id, run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % mod == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)


def word_counts(found: DataFrame, *, least: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the column ``word``: words of ``least`` letters and ``count`` occurrences."""
    return (found.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= count))


# --- the join --------------------------------------------------------------

def _cut(word: Column, at: Column, q: Column) -> Column:
    return word.substr(at + 1, q)


def _without(word: Column, at: Column, q: Column) -> Column:
    return F.concat(word.substr(F.lit(1), at), word.substr(at + q + 1, F.length(word)))


def _key(length: Column, chunk: int, letters: Column) -> Column:
    return F.xxhash64(length, F.lit(chunk), letters)


def _chunks(words: DataFrame) -> DataFrame:
    """(word, key, at, q): two chunks a word, with their place and length."""
    size, q = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    rows = [F.struct(_key(size, c, _cut(F.col("word"), q * c, q)).alias("key"), (q * c).alias("at"), q.alias("q"))
            for c in (0, 1)]
    return words.select("word", F.inline(F.array(*rows)))


def _grams(words: DataFrame) -> DataFrame:
    """(word, key, at, q, k, longer): grams where a chunk of a word of the same
    length, or of one letter less (``longer``), may be; ``k`` is 2 * chunk +
    shift.  A shifted gram of the same letters as the unshifted one is left out."""
    word, size = F.col("word"), F.length("word")

    def gram(longer: bool, c: int, shift: int) -> Column:
        length = size - 1 if longer else size
        q = F.floor(length / 2).cast("int")
        at = q * c + shift
        key = _key(length, c, _cut(word, at, q))
        if shift:
            key = F.when(_cut(word, at, q) != _cut(word, at - 1, q), key)
        return F.struct(key.alias("key"), at.alias("at"), q.alias("q"), F.lit(2 * c + shift).alias("k"),
                        F.lit(longer).alias("longer"))

    rows = F.array(gram(False, 0, 0), gram(False, 1, 0), *[gram(True, c, shift) for c in (0, 1) for shift in (0, 1)])
    return words.select("word", F.inline(rows)).where("key is not null")


def _first_shared(u: Column, v: Column) -> Column:
    """The smallest ``k`` at which ``v`` has a chunk of ``u``."""
    q, longer = F.floor(F.length(u) / 2).cast("int"), F.length(v) > F.length(u)

    def shared(c: int, shift: int) -> Column:
        same = _cut(u, q * c, q) == _cut(v, q * c + shift, q)
        return same & longer if shift else same

    return reduce(lambda rest, k: F.when(shared(k // 2, k % 2), k).otherwise(rest), (2, 1, 0), F.lit(3))


def _verified(met: DataFrame) -> DataFrame:
    u, v = F.col("u"), F.col("v")
    ordered = (F.length(v) > F.length(u)) & (F.length(v) - F.length(u) == 1) | (F.length(v) == F.length(u)) & (u < v)
    return (met.where(ordered & (F.levenshtein(u, v, 1) == 1) & (_first_shared(u, v) == F.col("k")))
            .select("u", "v"))


def near_pairs(words: DataFrame, *, spread: int = SPREAD) -> DataFrame:
    """(u, v): each pair of distinct ``word`` values one edit apart, once, the
    shorter (or, of equal length, the smaller) first.  ``words`` is a table of
    distinct words; it is read several times."""
    chunks, grams = _chunks(words), _grams(words)
    busy = (chunks.groupBy("key").agg(F.count("*").alias("a"))
            .join(grams.groupBy("key").agg(F.count("*").alias("b")), "key")
            .where(F.col("a") * F.col("b") > spread * (F.col("a") + F.col("b"))).select("key"))
    busy = written(busy.withColumn("busy", F.lit(True)), "spelling-busy")
    chunks, grams = chunks.join(busy, "key", "left"), grams.join(busy, "key", "left")

    few = (chunks.where("busy is null").select("key", F.col("word").alias("u"))
           .join(grams.where("busy is null").select("key", "k", F.col("word").alias("v")), "key"))

    # The rest of the word with one letter left out: (place, letters) where both are
    # equally long; -1 and the letters where one has a letter more (once for a run of equal letters).
    def placed(rows: DataFrame, first: int) -> DataFrame:
        rest = _without(F.col("word"), F.col("at"), F.col("q"))
        return (rows.withColumn("rest", rest)
                .withColumn("i", F.explode(F.sequence(F.lit(first), F.length("rest") - 1))))

    def without(i: Column) -> Column:
        return F.concat(F.col("rest").substr(F.lit(1), i), F.col("rest").substr(i + 2, F.length("rest")))

    i, last = F.col("i"), F.lit(-1)
    many_u = placed(chunks.where("busy"), -1).select("key", F.col("word").alias("u"), F.when(
        i < 0, F.xxhash64(last, "rest")).otherwise(F.xxhash64(i, without(i))).alias("variant"))
    fresh = ~F.col("longer") | (i == 0) | (F.col("rest").substr(i, F.lit(1)) != F.col("rest").substr(i + 1, F.lit(1)))
    many_v = placed(grams.where("busy"), 0).where(fresh).select("key", "k", F.col("word").alias("v"), F.xxhash64(
        F.when(F.col("longer"), last).otherwise(i), without(i)).alias("variant"))
    many = many_u.join(many_v, ["key", "variant"]).select("u", "v", "k")
    return _verified(few.select("u", "v", "k").unionByName(many))


def variants(words: DataFrame, *, ratio: int = RATIO, spread: int = SPREAD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n).

    ``form`` is the near word of largest n (ties: the smallest), if that n is
    at least ``ratio`` times the word's; ``root`` follows the forms to the last."""
    # A word becomes up to forty rows below: spread the words over the tasks first.
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = written(words.select("word", "n").repartition(parts, "word"), "spelling-words")
    pairs = written(near_pairs(words.select("word"), spread=spread), "spelling-pairs")
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    both = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("other")),
                                          F.struct(F.col("v").alias("word"), F.col("u").alias("other")))).alias("p"))
    near = (both.select("p.*").join(counts, "other").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best")))
    fits = -F.col("best.m") >= ratio * F.col("n")
    found = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")), "spelling-forms")
    return (found.join(roots(found), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling.  Counts
    grow by the ratio along a chain, so it has few links."""
    jump = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        up = jump.select(F.col("word").alias("root"), F.col("root").alias("up"))
        jump = written(jump.join(up, "root", "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "spelling-roots")
        if jump.where("moved").isEmpty():
            return jump.select("word", "root")
        jump = jump.select("word", "root")


def group_variants(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   damage_mod: int | None = DAMAGE_MOD) -> DataFrame:
    """``variants`` of the words of whole texts; without ``damage_mod`` the
    runs are taken as they are."""
    found = occurrences(docs, doc_id=doc_id, text=text)
    word = F.col("run") if damage_mod is None else damaged(F.col("run"), F.col("doc_id"), damage_mod)
    return variants(word_counts(found.select(word.alias("word"))))
