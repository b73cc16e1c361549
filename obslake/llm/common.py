"""Shared helpers of the operators: scratch tables and vectorised word hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from obslake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below the shared ``spark.checkpoint.dir``.

    Cuts the lineage: a lost executor costs a reread, not a recomputation,
    and Catalyst knows the measured size of what it joins next.
    """
    path = scratch_path(df.sparkSession, "llm", name, unique=True)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


# --- words of a batch of texts as 64-bit hashes, in numpy -----------------

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse (mod 2^64), at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _powers[:] = []
        for base in (_BASE, _BASE_INV):
            out = np.ones(size, dtype=np.uint64)
            done, step = 1, base
            while done < size:
                out[done:2 * done] = out[:done] * np.uint64(step)
                step = step * step & _MASK
                done *= 2
            _powers.append(out)
    return _powers[0], _powers[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text, and the offsets of the texts.

    A word is a maximal run of ASCII letters and digits and non-ASCII
    characters, lower-cased.  Text ``i`` owns
    ``hashes[offsets[i]:offsets[i + 1]]``.  The hash is a polynomial over the
    UTF-8 bytes taken from one prefix sum over the whole batch.
    """
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
    lens = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    text_end = np.cumsum(lens + 1)
    word = _IS_WORD[buf]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0)))
    starts, ends = edge[0::2], edge[1::2]      # the buffer ends in a space
    power, inverse = _power_tables(len(buf) + 1)
    terms = _BYTE[buf] * power[:len(buf)]
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    hashes = mix64((prefix[ends] - prefix[starts]) * inverse[starts])
    offsets = np.concatenate([[0], np.searchsorted(starts, text_end)])
    return hashes, offsets


def shingle_hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words of each text, and the text of each.

    A text of fewer words (but at least one) has one shingle of all its words;
    a text without words has none.  Returns (hashes, index of the text).
    """
    words, offsets = word_hashes(texts)
    n_words = np.diff(offsets)
    doc = np.repeat(np.arange(len(texts)), n_words)
    if len(words) == 0:
        return words, doc
    position = np.arange(len(words)) - offsets[doc]
    size = np.minimum(n_words, width)[doc]
    first = position <= n_words[doc] - size
    acc = np.zeros(len(words), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            shifted = np.zeros_like(words)
            shifted[:len(words) - j] = words[j:] if j else words
            acc = acc * np.uint64(_BASE_INV) + np.where(j < size, shifted, np.uint64(0))
    keep = np.flatnonzero(first)
    return mix64(acc[keep]), doc[keep]


def blocks(items: list[str], max_chars: int = 1 << 18):
    """Index ranges of about ``max_chars`` characters (a longer text is alone)."""
    start, size = 0, 0
    for i, t in enumerate(items):
        if size and size + len(t) > max_chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(items):
        yield start, len(items)
