"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Texts are lower-cased; every run of characters other than letters is one
space.  The n-grams of one to ``orders`` characters are hashed into
``2 ** bits`` buckets.

Fit: each task adds the n-grams of its training rows into one table of counts
per language (its size does not depend on the rows), and the tables are summed
in Spark.  All training rows count.  The matrix of log-probabilities
(languages x buckets, float32) is broadcast: its size is bounded by the number
of languages.
Score: per batch, sparse (text, bucket) counts times the matrix.

Edge cases: texts that are null or have no letter are ``und`` with score 0.
With nothing to learn from, every text is ``und``.  Equal likelihoods go to
the smallest language name.  Null languages, texts and ids are not learned
from; repeated rows count each.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import blocks, mix64

ORDERS, BITS = 4, 17
HOLD_OUT_MOD = 5
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-cased letters with one space around each run; empty if none."""
    body = _OTHER.sub(" ", text.lower()).strip()
    return f" {body} " if any(map(str.isalpha, body)) else ""


def gram_buckets(texts: list[str], orders: int = ORDERS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every n-gram of the normalised ``texts``."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    doc = np.repeat(np.arange(len(texts)), size)
    found, owner = [], []
    acc = np.zeros(len(code), dtype=np.uint64)
    for n in range(1, orders + 1):
        if len(code) < n:
            break
        m = len(code) - n + 1
        acc = acc[:m] * np.uint64(0x100000001B3) + code[n - 1:] + np.uint64(1)
        inside = np.flatnonzero(doc[:m] == doc[n - 1:])
        found.append((mix64(acc[inside] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int64))
        owner.append(doc[inside])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owner)


def is_held_out(doc_id: str, mod: int = HOLD_OUT_MOD) -> Column:
    """crc32 of the id as text is a multiple of ``mod`` (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % mod == 0, F.lit(False))


@dataclass
class LanguageModel:
    """Languages in order, their log priors, and one row of log-probabilities
    per bucket."""

    langs: list[str] = field(default_factory=list)
    prior: np.ndarray = field(default_factory=lambda: np.zeros(0))
    matrix: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    orders: int = ORDERS
    bits: int = BITS

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Most likely language and its posterior probability of each text."""
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return lang, score
        for a, b in blocks(texts):
            body = [letters(t) for t in texts[a:b]]
            bucket, doc = gram_buckets(body, self.orders, self.bits)
            log_p = np.stack([np.bincount(doc, self.matrix[:, k][bucket], minlength=b - a) + self.prior[k]
                              for k in range(len(self.langs))], axis=1)
            best = log_p.argmax(axis=1)
            top = 1.0 / np.exp(log_p - log_p.max(axis=1, keepdims=True)).sum(axis=1)
            for i, t in enumerate(body):
                if t:
                    lang[a + i], score[a + i] = self.langs[best[i]], top[i]
        return lang, score


def gram_counts(rows: DataFrame, orders: int = ORDERS, bits: int = BITS) -> DataFrame:
    """(lang, bucket, n) over rows (lang, text); bucket -1 counts the texts."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, group in pdf.groupby("lang", sort=False):
                table = total.setdefault(lang, np.zeros((1 << bits) + 1, dtype=np.int64))
                body = [t for t in map(letters, group["text"]) if t]
                table[-1] += len(body)
                for a, b in blocks(body):
                    bucket, _ = gram_buckets(body[a:b], orders, bits)
                    table[:-1] += np.bincount(bucket, minlength=1 << bits)
        for lang, table in total.items():
            hit = np.flatnonzero(table)
            yield pd.DataFrame({"lang": lang, "bucket": np.where(hit == 1 << bits, -1, hit), "n": table[hit]})

    return (rows.mapInPandas(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        orders: int = ORDERS, bits: int = BITS, alpha: float = 0.5) -> LanguageModel:
    """Learn from every row with an id that is not held out, a text and a
    language.  ``alpha`` is the additive smoothing of the counts."""
    rows = (docs.where(F.col(doc_id).isNotNull() & ~is_held_out(doc_id))
            .select(F.col(lang).alias("lang"), F.col(text).alias("text"))
            .where("lang is not null and text is not null"))
    counts = gram_counts(rows, orders, bits).toPandas()   # at most languages * (2 ** bits + 1) rows
    n_texts = counts[counts["bucket"] < 0].set_index("lang")["n"]
    langs = sorted(n_texts.index)
    if not langs:
        return LanguageModel(orders=orders, bits=bits)
    seen = np.full((1 << bits, len(langs)), alpha)
    grams = counts[counts["bucket"] >= 0]
    at = grams["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(np.int64)
    seen[grams["bucket"].to_numpy(np.int64), at] += grams["n"].to_numpy(float)
    prior = np.log((n_texts[langs].to_numpy(float) + 1) / (n_texts.sum() + len(langs)))
    return LanguageModel(langs, prior, np.log(seen / seen.sum(axis=0)).astype(np.float32), orders, bits)


def predict(docs: DataFrame, model: LanguageModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def best(texts: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.predict(texts.fillna("").tolist())
        return pd.DataFrame({"lang": lang, "score": score})

    return (docs.select(F.col(doc_id).alias("doc_id"), is_held_out(doc_id).alias("held_out"),
                        best(F.col(text)).alias("best"))
            .select("doc_id", "held_out", F.col("best.lang").alias("lang_pred"), F.col("best.score").alias("score")))
