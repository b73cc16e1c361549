"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from a passage by ``k = floor(rate * m)``
edits.  Cut into k + 1 pieces, at least one piece must then occur unchanged,
so an Aho-Corasick automaton over all pieces finds every candidate place.
Each candidate window is verified with Myers' bit-parallel edit distance.

Texts are compared as lower-cased words joined by one space.  Documents are
only scanned (no shuffle); the benchmark is read in blocks of bounded size, one
scan of the documents per block.  With several blocks each scan's hits are
written before the next block is read, so that the driver and the executors
hold one block at a time.

Edge cases: null or wordless items match nothing; null or empty texts hold no
item.  Repeated items and repeated documents each give their own rows.  Of
equal distances the first exact place, else the first end, is reported.  A very
long text is searched whole by its row's task.  An empty benchmark or document
table gives no matches.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import written

RATE = 0.06
BLOCK_CHARS = 4_000_000  # benchmark text that one pass over the documents holds

_GAP = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")


def normal(text: str) -> str:
    return _GAP.sub(" ", text.lower()).strip()


def budget(item: str, rate: float) -> int:
    return math.floor(rate * len(item))


def split_pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k + 1 non-empty pieces of near-equal length."""
    edges = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(pattern: str, text: str) -> Iterator[int]:
    """Smallest edit distance of ``pattern`` to any substring of ``text``
    ending at each position (bit-parallel, one step per character)."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(pattern):
        masks[ch] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    for ch in text:
        eq = masks.get(ch, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        grow = minus | (full & ~(horizontal | plus))
        shrink = plus & horizontal
        if grow & top:
            score += 1
        elif shrink & top:
            score -= 1
        grow, shrink = (grow << 1) & full, (shrink << 1) & full
        plus = shrink | (full & ~(vertical | grow))
        minus = grow & vertical
        yield score


def best_match(pattern: str, text: str, k: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best substring within ``k`` edits: the
    smallest distance, then the first end, then the longest."""
    best, end = k + 1, -1
    for i, d in enumerate(myers(pattern, text)):
        if d < best:
            best, end = d, i + 1
    if end < 0:
        return None
    low = max(0, end - len(pattern) - best)
    start = end
    for i, d in enumerate(myers(pattern[::-1], text[low:end][::-1])):
        if d == best:
            start = end - i - 1
    return best, start, end


class Matcher:
    """Finds a block of benchmark items in texts."""

    def __init__(self, items: list[tuple[object, str]], rate: float = RATE):
        import ahocorasick

        self.items = [(key, item, budget(item, rate)) for key, text in items if (item := normal(text))]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, item, k) in enumerate(self.items):
            for offset, piece in split_pieces(item, k):
                places[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, value in places.items():
            self.automaton.add_word(piece, (len(piece), value))
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item key, distance, start, end) of the best match of each item
        found, in characters of ``normal(text)``."""
        body = normal(text)
        if not self.items or not body:
            return []
        diagonals: dict[int, set[int]] = defaultdict(set)
        for last, (size, value) in self.automaton.iter(body):
            for n, offset in value:
                diagonals[n].add(last + 1 - size - offset)
        out = []
        for n, starts in sorted(diagonals.items()):
            key, item, k = self.items[n]
            exact = next((s for s in sorted(starts) if s >= 0 and body.startswith(item, s)
                          and self._bounded(body, s, s + len(item))), None)
            if exact is not None:
                out.append((key, 0, exact, exact + len(item)))
                continue
            best = None
            for low, high in self._windows(sorted(starts), len(item), k, len(body)):
                found = best_match(item, body[low:high], k)
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], low + found[1], low + found[2])
            if best and (k or self._bounded(body, best[1], best[2])):
                out.append((key, *best))
        return out

    @staticmethod
    def _bounded(body: str, start: int, end: int) -> bool:
        """Whether a match starts and ends at word ends."""
        return (start == 0 or body[start - 1] == " ") and (end == len(body) or body[end] == " ")

    @staticmethod
    def _windows(starts: list[int], m: int, k: int, n: int) -> Iterator[tuple[int, int]]:
        """Merged windows around the diagonals on which a piece was found."""
        low = high = None
        for s in starts:
            a, b = max(0, s - k), min(n, s + m + k)
            if high is not None and a <= high - m:
                high = max(high, b)
                continue
            if high is not None:
                yield low, high
            low, high = a, b
        if high is not None:
            yield low, high


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Code points of ``text`` behind ``normal(text)[start:end]``."""
    at, first, last = 0, None, 0
    for word in _WORD.finditer(text.lower()):
        a, b = at, at + len(word.group())
        if b > start and first is None:
            first = word.start()
        if a < end:
            last = word.end()
        at = b + 1
    return (first or 0), last


def block_count(benchmark: DataFrame, text: str) -> int:
    """Blocks of about ``BLOCK_CHARS`` characters that hold the benchmark."""
    return max(1, math.ceil((benchmark.agg(F.sum(F.length(text)).alias("n")).head()["n"] or 0) / BLOCK_CHARS))


def block_of(benchmark: DataFrame, item_id: str, text: str, i: int, n: int) -> list[tuple[object, str]]:
    """Block ``i`` of ``n`` of the benchmark, by a hash of the item."""
    items = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).where("text is not null")
    return [(r["id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).collect()]


def _by_block(docs: DataFrame, benchmark: DataFrame, item_id: str, text: str, n: int,
              scan: Callable[[Broadcast], DataFrame]) -> DataFrame:
    """The union of ``scan`` over the blocks; with several, each is written and
    its block given up before the next is read."""
    out = None
    for i in range(n):
        shared = docs.sparkSession.sparkContext.broadcast(block_of(benchmark, item_id, text, i, n))
        part = scan(shared)
        if n > 1:
            part = written(part, "benchmark-hits")
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def matches(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, start, end): the best match of each item in
    each document, as code points of the lower-cased document text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    doc_type = rows.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema[item_id].dataType.simpleString()

    def scan(shared):
        def search(batches):
            match = Matcher(shared.value, rate)
            for pdf in batches:
                found = []
                for one, body in zip(pdf["doc_id"].array, pdf["text"]):
                    for key, distance, start, end in match(body):
                        found.append((None if pd.isna(one) else one, key, distance, *original_span(body, start, end)))
                frame = pd.DataFrame(found, columns=["doc_id", "item_id", "distance", "start", "end"])
                for c, kind in (("doc_id", doc_type), ("item_id", item_type)):
                    if kind in ("bigint", "int"):
                        frame[c] = frame[c].astype("Int64")
                yield frame

        return rows.mapInPandas(search, f"doc_id {doc_type}, item_id {item_type}, distance int, start int, end int")

    return _by_block(docs, benchmark, item_id, item_text, block_count(benchmark, item_text), scan)


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """The documents (all columns) that hold no benchmark item.

    One block is a filter of the scan.  With several, each scan writes the
    SHA-256 of the texts it finds, and these texts go in an anti join."""
    n = block_count(benchmark, item_text)

    def found(shared):
        return docs.where(_leaks(shared, rate)(F.col(text))).select(F.sha2(F.col(text), 256).alias("digest"))

    if n == 1:
        shared = docs.sparkSession.sparkContext.broadcast(block_of(benchmark, item_id, item_text, 0, 1))
        return docs.where(~_leaks(shared, rate)(F.col(text)))
    leaky = _by_block(docs, benchmark, item_id, item_text, n, found).distinct()
    return docs.join(leaky, F.sha2(docs[text], 256) == leaky["digest"], "left_anti")


def _leaks(shared, rate: float):
    @F.pandas_udf("boolean")
    def leaks(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        match = Matcher(shared.value, rate)
        for texts in parts:
            yield texts.map(lambda t: bool(t) and bool(match(t))).astype(bool)

    return leaks
