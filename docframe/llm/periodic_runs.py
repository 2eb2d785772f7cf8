"""Periodic runs of words, found while the words of a text arrive: online dyadic square catching.

Every completed aligned block of B = 1, 2, 4, ... words gets a catcher. It watches the words that come between B
and 2 B words later, so each appended word is compared once per power of two: the suffix of B words that it ends
against the block before last. An equal suffix at distance p is a square of period p in the making; it is caught
where the last 3 p words have period p, which every stretch of 4 p words brings about once in every p words. Caught
stretches merge: one inside a known run says nothing new (shorter periods come first, so a multiple of a run's
period is dropped), any other is extended in both directions, word by word, and stays open while the appended
words carry it on.

Suffixes are compared by 64-bit hashes of prefixes; each run is checked on the words themselves, so an equal hash
of different words costs time, not correctness. Words are appended in portions, and the comparisons of a portion
are arrays. Short texts are caught as one stream with a mark of its own between two of them; a long one arrives in
several portions, so what a portion needs beside the text's words is bounded. Nothing is shuffled.

A run is a stretch of words with smallest period q that no neighbouring word extends, of at least ``max(least,
4 q)`` words; it has at least four whole periods, so that its smallest period is the one found first. A null or
empty text has no words and no runs; repeated rows are judged each for itself; an empty table gives no rows.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docframe.llm import words as W

#: Shortest run, in words, and words that are appended at once.
LEAST, PORTION = 6, 1 << 18


class Numbers(dict):
    """A number for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def equal_until(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements agree."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differs = a[at : min(n, at + step)] != b[at : min(n, at + step)]
        if differs.any():
            return at + int(differs.argmax())
        at, step = at + step, step * 2
    return n


class Catchers:
    """The runs of a stream of at most ``capacity`` words, complete for what has been appended."""

    def __init__(self, capacity: int, longest: int | None = None) -> None:
        self.words = np.empty(capacity, np.int64)
        self.sums = np.zeros(capacity + 1, np.uint64)  # sum of hash * power over the words before
        self.powers = np.full(capacity + 1, W.MIX, np.uint64)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.n = 0
        self.longest = min(capacity, longest or capacity) // 4  # no longer period can occur four times
        self.runs: list[list[int]] = []  # start, end, period
        self.open: list[list[int]] = []

    def append(self, new: np.ndarray) -> None:
        a, b = self.n, self.n + len(new)
        self.words[a:b] = new
        hashes = W.mixed(new.astype(np.uint64) + W.MIX) * self.powers[a:b]
        self.sums[a + 1 : b + 1] = self.sums[a] + np.cumsum(hashes, dtype=np.uint64)
        self.n = b
        for run in self.open:
            run[1] += equal_until(self.words[a:b], self.words[a - run[2] : b - run[2]])
        self.open = [r for r in self.open if r[1] == b]
        block = 1
        while block <= self.longest:
            self._catch(block, a, b)
            block *= 2

    def _catch(self, block: int, a: int, b: int) -> None:
        """Squares of periods from ``block`` to twice as much that the words from a to b complete."""
        sums, powers = self.sums, self.powers
        first = max(block, a + 1 - block)
        last = b - block  # starts of the suffixes
        if last < first:
            return
        row = first // block
        starts = np.arange((row - 1) * block, last - block + 1, block)
        suffix = sums[first + block : last + block + 1] - sums[first : last + 1]
        catcher = np.repeat(sums[starts + block] - sums[starts], block)[first - row * block :][: len(suffix)]
        apart = np.tile(powers[block : 2 * block], len(starts))[first - row * block :][: len(suffix)]
        hits = np.flatnonzero(suffix == catcher * apart)
        if not len(hits):
            return
        at = hits + first
        period = at - (at // block - 1) * block
        end = at + block
        fits = end >= 3 * period
        end, period = end[fits], period[fits]
        news = self._unknown(end, period, 2 * block)
        end, period = end[news], period[news]
        begin = end - 3 * period
        cubes = (sums[end - period] - sums[begin]) * powers[period] == sums[end] - sums[begin + period]
        order = np.lexsort((end[cubes], period[cubes]))
        known, until = 0, 0
        for e, p in zip(end[cubes][order].tolist(), period[cubes][order].tolist(), strict=True):
            if p == known and e <= until:
                continue
            if run := self._merged(e, p):
                known, until = p, run[1]

    def _unknown(self, end: np.ndarray, period: np.ndarray, below: int) -> np.ndarray:
        """Which stretches of three periods lie in no known run of a period ``below`` that given."""
        known = np.array(self.runs, np.int64).reshape(-1, 3)
        known = known[known[:, 2] < below]
        known = known[np.argsort(known[:, 0], kind="stable")]
        reach = np.concatenate([[-1], np.maximum.accumulate(known[:, 1])])
        return reach[np.searchsorted(known[:, 0], end - 3 * period, "right")] < end

    def _merged(self, end: int, period: int) -> list[int] | None:
        """The run that holds the last three periods before ``end``, if the words bear it out."""
        words, n = self.words, self.n
        begin = end - 3 * period
        if not np.array_equal(words[begin : end - period], words[begin + period : end]):
            return None
        end += equal_until(words[end:n], words[end - period : n - period])
        begin -= equal_until(words[:begin][::-1], words[period : begin + period][::-1])
        run = [begin, end, period]
        if any(r[0] <= begin and end <= r[1] and r[2] < period for r in self.open):  # a multiple of its period
            return run
        self.runs.append(run)
        if end == n:
            self.open.append(run)
        return run

    def found(self, least: int = LEAST) -> np.ndarray:
        """(start, length, period) of the runs, by start and period."""
        rows = sorted((a, b - a, p) for a, b, p in self.runs if b - a >= max(least, 4 * p))
        return np.array(rows, np.int64).reshape(-1, 3)


def caught(lists: list[list[bytes]], least: int = LEAST, portion: int = PORTION) -> list[np.ndarray]:
    """(start, length, period) rows of each text's runs."""
    numbers = Numbers()
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    stream = np.empty(int(starts[-1]), np.int64)
    for k, (text, at) in enumerate(zip(lists, starts.tolist(), strict=False)):
        stream[at : at + len(text)] = np.fromiter(map(numbers.__getitem__, text), np.int64, len(text))
        stream[at + len(text)] = -1 - k  # a mark that occurs once
    catchers = Catchers(len(stream), int(sizes.max(initial=0)))
    for at in range(0, len(stream), portion):
        catchers.append(stream[at : at + portion])
    rows = catchers.found(least)
    cuts = np.searchsorted(rows[:, 0], starts)
    return [rows[a:b] - (start, 0, 0) for a, b, start in zip(cuts[:-1], cuts[1:], starts, strict=False)]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that repeat a run's first period."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w for w, c in zip(words, np.cumsum(step).tolist(), strict=False) if not c])


def _found(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch, texts in W.portions(batches):
            lists = [W.spaced(t or "") for t in texts]
            runs = caught(lists, least)
            flat = np.concatenate([*runs, np.empty((0, 3), np.int64)])
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
            values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(spans.value_type))
            columns = {
                "doc_id": batch["doc_id"],
                "n_words": pa.array([len(x) for x in lists], pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
                "collapsed": pa.array([collapsed(x, r).decode("utf-8", "surrogatepass") for x, r in zip(lists, runs, strict=True)], pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the text without their repeats."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_found(least), f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
