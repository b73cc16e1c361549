"""Weights of near-dedup's shingles against counts by dictionary."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from obslake.llm import neardup
from obslake.llm.common import shingle_hashes


def _texts(n, seed):
    rng = random.Random(seed)
    common = "this line stands in very many of the texts here"
    return [" ".join(rng.choices([f"w{i}" for i in range(400)], k=30)) + (". " + common if i % 4 == 0 else "")
            for i in range(n)]


def _idf(spark, texts):
    nodes = spark.createDataFrame(list(enumerate(texts)), "node int, text string").repartition(5)
    return neardup.idf_of(nodes, len(texts))


def test_frequent_shingles_have_exact_frequencies(spark, monkeypatch):
    # So few shingles are held that tasks hand on several parts.
    monkeypatch.setattr(neardup, "HELD", 64)
    texts = _texts(600, 1)
    df = Counter(h for t in texts for h in set(shingle_hashes([t], neardup.WIDTH)[0].tolist()))
    expected = {h: 1 + math.log(n / 600) / math.log(neardup.HEAVY) for h, n in df.items() if n >= neardup.HEAVY * 600}
    idf = _idf(spark, texts)
    assert len(expected) >= 6
    assert dict(zip(idf.heavy.tolist(), np.round(idf.value, 5).tolist())).keys() == expected.keys()
    every = np.array(list(df), np.uint64)
    got = neardup.weights(every, np.full(len(every), 3), idf)
    wanted = [3 * expected.get(h, neardup.RARE) for h in df]
    assert np.allclose(got, wanted, atol=1e-5)


def test_similarity_does_not_depend_on_the_size_of_the_corpus(spark):
    texts = _texts(400, 2)
    pair = [texts[0], texts[0].replace("w1", "v1")], [texts[4], texts[0]]
    small = neardup.weighted_jaccard(*pair, _idf(spark, texts), neardup.WIDTH)
    # Other words of the same kind, five times as many texts, the same shares.
    large = neardup.weighted_jaccard(*pair, _idf(spark, texts + _texts(1600, 3)), neardup.WIDTH)
    assert np.allclose(small, large, atol=1e-6)


def test_no_text_and_no_frequent_shingle(spark):
    none = neardup.idf_of(spark.createDataFrame([], "node int, text string"), 0)
    assert len(none.heavy) == 0
    texts = [f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(300)]
    rare = _idf(spark, texts)
    assert len(rare.heavy) == 0
    hashes, _ = shingle_hashes(texts, neardup.WIDTH)
    assert (neardup.weights(hashes, np.ones(len(hashes)), rare) == neardup.RARE).all()
