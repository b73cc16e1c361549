"""Toxicity: a counterfactual-regularised linear classifier.

The model is a logistic regression over the presence of words.  While it is
fitted, every labelled sentence that names a group is paired with a copy in
which the identity terms are swapped, and the squared change of the score
(logit) between the two is added to the loss.  A group's name alone then
carries no weight that another group's name does not, which keeps neutral
mentions from being flagged.

Fit: word statistics and features come from Spark over a sample of labelled
rows bounded by ``max_fit_rows`` per class; the optimiser then works on at most
``2 * max_fit_rows`` rows of at most ``max_features`` features.
Score: every whole text, in Arrow batches, one lookup per word.

Edge cases: null text is an empty text and scores the intercept.  A text of any
length is scored whole; its sentences add to one matrix of fixed size.  With no
usable labels, or labels of one class, the score is the smoothed label rate
(0.5 without labels).  Labels other than 0 and 1, null labels and null ids
are not learned from.  Repeated rows are scored each and learned from once.  A
score of exactly the threshold counts as toxic.  An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import blocks, word_hashes, written

# Groups of identity terms; a term is swapped with the next of
# its own group (the last with the first).
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees"),
    ("old", "young"),
    ("disabled", "deaf", "blind"),
)

HOLD_OUT_MOD, HOLD_OUT_REST = 3, 1
THRESHOLD = 0.7
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")


@dataclass
class ToxicityModel:
    """Sorted word hashes with a weight each, and the intercept."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = 0.0

    def logits(self, texts: list[str]) -> np.ndarray:
        """Intercept plus the weight of each distinct known word of each text."""
        out = np.full(len(texts), self.intercept)
        for a, b in blocks(texts):
            text, feature = known_words(texts[a:b], self.words)
            out[a:b] += np.bincount(text, self.weights[feature], minlength=b - a)
        return out


def known_words(texts: list[str], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, index into the sorted ``vocabulary``) pairs."""
    hashes, offsets = word_hashes(texts)
    if len(vocabulary) == 0 or len(hashes) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    hit = np.flatnonzero(vocabulary[at] == hashes)
    text = np.searchsorted(offsets, hit, side="right") - 1
    pair = np.unique(text * len(vocabulary) + at[hit])
    return pair // len(vocabulary), pair % len(vocabulary)


def is_held_out(doc_id: str, mod: int = HOLD_OUT_MOD, rest: int = HOLD_OUT_REST) -> Column:
    """crc32 of the id as text, mod ``mod``, is ``rest`` (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % mod == rest, F.lit(False))


def swaps(groups=IDENTITY_GROUPS) -> dict[str, str]:
    return {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}


def fit_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
               max_fit_rows: int) -> DataFrame:
    """(label, text) of at most ``max_fit_rows`` training rows of each class,
    those with the smallest hash of their id; one row per id and label (of
    rows with equal ids, the smallest text)."""
    usable = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out("id"))
              .distinct())
    picked = [usable.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(max_fit_rows)
              for y in (0, 1)]
    # At most 2 * max_fit_rows rows of 12 bytes: a proven bound for a broadcast.
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.select(F.col(doc_id).alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.join(ids, "id").groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text")


def word_stats(sample: DataFrame) -> DataFrame:
    """(word, n0, n1): sample texts of either class that hold the word."""

    def count(batches):
        for pdf in batches:
            texts, y = pdf["text"].tolist(), pdf["label"].to_numpy()
            for a, b in blocks(texts):
                hashes, offsets = word_hashes(texts[a:b])
                doc = np.repeat(np.arange(b - a), np.diff(offsets))
                order = np.lexsort((hashes, doc))
                hashes, doc = hashes[order], doc[order]
                first = np.ones(len(hashes), bool)
                first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
                hashes, toxic = hashes[first], y[a:b][doc[first]] == 1
                words, at = np.unique(hashes, return_inverse=True)
                n = np.bincount(at, minlength=len(words))
                n1 = np.bincount(at[toxic], minlength=len(words))
                yield pd.DataFrame({"word": words.view(np.int64), "n0": n - n1, "n1": n1})

    return (sample.mapInPandas(count, "word long, n0 long, n1 long")
            .groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


def sample_features(sample: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(label, features) of each sample row."""

    def extract(batches):
        for pdf in batches:
            texts, feats = pdf["text"].tolist(), []
            for a, b in blocks(texts):
                doc, feature = known_words(texts[a:b], vocabulary)
                feats += [x.tolist() for x in np.split(feature, np.searchsorted(doc, np.arange(1, b - a)))]
            yield pd.DataFrame({"label": pdf["label"], "features": feats})

    return sample.mapInPandas(extract, "label int, features array<int>")


def swap_matrix(sample: DataFrame, groups=IDENTITY_GROUPS) -> tuple[list[str], np.ndarray, int]:
    """(terms, M, sentences): each sentence of the sample that names a group
    changes term features by a vector s (-1: gone, +1: new) when its terms are
    swapped; M is the sum of s s' over these sentences, so that w' M w is the
    sum of the squared logit changes.  M is as large as the terms, however many
    sentences a text has."""
    swap = swaps(groups)
    terms = sorted(swap)
    if not terms:
        return [], np.zeros((0, 0)), 0
    at = {t: i for i, t in enumerate(terms)}
    pattern = re.compile(r"\b(" + "|".join(sorted(terms, key=len, reverse=True)) + r")\b")
    size = len(terms)

    def add_up(batches):
        m, n = np.zeros((size, size)), 0
        for pdf in batches:
            for text in pdf["text"]:
                for sentence in SENTENCE_END.split(text.lower()):
                    if found := set(pattern.findall(sentence)):
                        s = np.zeros(size)
                        for t in found:
                            s[at[t]] -= 1
                            s[at[swap[t]]] += 1
                        m += np.outer(s, s)
                        n += 1
        i, j = np.nonzero(m)
        yield pd.DataFrame({"i": [*i, -1], "j": [*j, -1], "x": [*m[i, j], n]})

    parts = (sample.select("text").mapInPandas(add_up, "i int, j int, x double")
             .groupBy("i", "j").agg(F.sum("x").alias("x")).collect())
    m, n = np.zeros((size, size)), 0
    for r in parts:
        if r["i"] < 0:
            n = int(r["x"])
        else:
            m[r["i"], r["j"]] = r["x"]
    return terms, m, n


def loss(w: np.ndarray, b: float, y: np.ndarray, row: np.ndarray, col: np.ndarray, named: np.ndarray,
         swapped: np.ndarray, n_swapped: int, l2: float, counterfactual: float) -> tuple[float, np.ndarray, float]:
    """Mean log loss + l2 |w|^2 + counterfactual * mean squared logit change of
    the swapped sentences, and its gradient by ``w`` and ``b``.

    (row, col) are the set features; ``swapped`` is the matrix of
    ``swap_matrix`` over the features ``named``."""
    z = b + np.bincount(row, w[col], minlength=len(y))
    n = max(1, len(y))
    error = (1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y) / n
    grad = np.bincount(col, error[row], minlength=len(w)) + 2 * l2 * w
    value = float(np.sum(np.logaddexp(0, z) - y * z)) / n + l2 * float(w @ w)
    if n_swapped:
        pull = swapped @ w[named] * (counterfactual / n_swapped)
        value += float(w[named] @ pull)
        np.add.at(grad, named, 2 * pull)
    return value, grad, float(error.sum())


def fit_weights(y: np.ndarray, row: np.ndarray, col: np.ndarray, n_features: int, named: np.ndarray,
                swapped: np.ndarray, n_swapped: int, *, l2: float, counterfactual: float,
                steps: int) -> tuple[np.ndarray, float]:
    """Full-batch Adam on ``loss``."""
    w, b = np.zeros(n_features), 0.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        _, grad, by_b = loss(w, b, y, row, col, named, swapped, n_swapped, l2, counterfactual)
        g = np.append(grad, by_b)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", max_fit_rows: int = 10_000, max_features: int = 4096,
        min_docs: int = 5, min_chi2: float = 15.0, l2: float = 1e-6,
        counterfactual: float = 1.0, steps: int = 300,
        groups=IDENTITY_GROUPS) -> ToxicityModel:
    """Fit on at most ``max_fit_rows`` labelled rows of each class (held-out
    ids excluded), over the ``max_features`` words with the largest chi-square
    statistic (at least ``min_chi2``, in at least ``min_docs`` rows) plus the
    identity terms."""
    sample = written(fit_sample(docs, labels, doc_id, text, label, max_fit_rows), "toxicity-sample")
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    if not (n0 and n1):
        rate = (n1 + 0.5) / (n0 + n1 + 1)
        return ToxicityModel(intercept=float(np.log(rate / (1 - rate))))
    a, c = F.col("n1").cast("double"), F.col("n0").cast("double")
    total = F.lit(float(n0 + n1))
    chi2 = (total * F.pow(a * (n0 - c) - c * (n1 - a), F.lit(2.0))
            / (F.lit(float(n0)) * n1 * (a + c) * F.greatest(total - a - c, F.lit(1.0))))
    chosen = (word_stats(sample).where(F.col("n0") + F.col("n1") >= min_docs)
              .withColumn("chi2", chi2).where(F.col("chi2") >= min_chi2)
              .orderBy(F.desc("chi2"), "word").limit(max_features).select("word").collect())
    terms, swapped, n_swapped = swap_matrix(sample, groups)
    hashes = np.array([int(word_hashes([t])[0][0]) for t in terms], dtype=np.uint64)
    words = np.array([r["word"] & (1 << 64) - 1 for r in chosen], dtype=np.uint64)
    vocabulary = np.unique(np.concatenate([words, hashes]))
    rows = sample_features(sample, vocabulary).toPandas()
    y = rows["label"].to_numpy(float)
    row = np.repeat(np.arange(len(rows)), rows["features"].map(len).to_numpy())
    col = np.concatenate([np.asarray(f, np.int64) for f in rows["features"]] or [np.zeros(0, np.int64)])
    w, b = fit_weights(y, row, col, len(vocabulary), np.searchsorted(vocabulary, hashes), swapped, n_swapped,
                       l2=l2, counterfactual=counterfactual, steps=steps)
    return ToxicityModel(vocabulary, w, b)


def score(model: ToxicityModel, text: str = "text") -> Column:
    """Probability of label 1 for a text column (null: empty text).

    The model (at most ``max_features`` words plus the identity terms, 16
    bytes each) travels with the function."""

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        z = model.logits(texts.fillna("").tolist())
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))

    return probability(F.col(text))
