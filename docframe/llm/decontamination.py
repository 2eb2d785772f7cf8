"""Benchmark decontamination by winnowing.

Words are runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased. Of every ``slide``
neighbouring ``gram``-word hashes the smallest is a fingerprint, so two texts that share ``gram + slide - 1``
words share a fingerprint (10 words with the defaults). Fingerprints of the documents are joined with those
of the benchmark, hits are extended to every window of ``length`` words that holds one, and a window counts
if the benchmark has the same words. An item of fewer words is one window of its own length and is sought
as such.

The benchmark side of the join is measured first: up to ``most_bytes`` it goes to every task as arrays;
a larger benchmark is dealt into that many more blocks, each within the bound, and the documents pass the
blocks one after another, the hits of a document being united. No document is shuffled.

Null texts have no words; null items are never found. Repeated items count once by item_id. Repeated
documents are judged alike. Without benchmark rows nothing is contaminated. Columns other than those named
are not read by ``inspect`` and are returned unchanged by ``clean``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm import words as W

GRAM, SLIDE, LENGTH = 5, 6, 10


def winnowed(grams: np.ndarray, slide: int = SLIDE) -> np.ndarray:
    """Where a gram is the smallest of some ``slide`` neighbours (the rightmost of equals)."""
    n = len(grams) - slide + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least, at = grams[:n].copy(), np.arange(n)
    for k in range(1, slide):
        closer = grams[k : k + n] <= least
        least[closer] = grams[k : k + n][closer]
        at[closer] = np.flatnonzero(closer) + k
    return np.unique(at)


class Fingerprints:
    """What tasks need of a bounded benchmark: fingerprints, and windows with their items."""

    def __init__(self, items: list[tuple[str, str]]) -> None:
        memory = W.Hashes()
        self.prints, windows = [], {}
        self.items = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.items)}
        for item, text in items:
            words = W.folded(text)
            hashes, _ = W.hashed([words], memory)
            length = min(LENGTH, len(words))
            if not length:
                continue
            if length == LENGTH:
                grams = W.mixed(W.windows(hashes, GRAM))
                self.prints.append(grams[winnowed(grams)])
            for key in set(W.mixed(W.windows(hashes, length)).tolist()):
                windows.setdefault(length, []).append((key, number[item]))
        self.prints = np.unique(np.concatenate(self.prints)) if self.prints else np.empty(0, np.uint64)
        self.windows = {}
        for length, pairs in windows.items():
            pairs = sorted(set(pairs))
            self.windows[length] = (np.array([k for k, _ in pairs], np.uint64), np.array([i for _, i in pairs], np.int64))

    def found(self, hashes: np.ndarray, offsets: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, length, items) of the places where a window occurs."""
        for length, (keys, items) in self.windows.items():
            if len(hashes) < length:
                continue
            if length == LENGTH:
                grams = W.mixed(W.windows(hashes, GRAM))
                table = np.zeros(1 << 16, bool)
                table[(self.prints >> np.uint64(48)).astype(np.int64)] = True
                likely = np.flatnonzero(table[(grams >> np.uint64(48)).astype(np.int64)])
                likely = likely[np.isin(grams[likely], self.prints)]
                # A window of ten words that an item has holds a fingerprint of the item at one of its six grams.
                starts = np.unique((likely[:, None] - np.arange(SLIDE)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts <= len(hashes) - length)]
            else:
                starts = np.arange(len(hashes) - length + 1)
            starts = starts[owner[starts] == owner[starts + length - 1]]
            own = W.mixed(W.windows(hashes, length))[starts]
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            for k in np.flatnonzero(high > low).tolist():
                yield int(starts[k]), length, items[low[k] : high[k]]


SPANS = "n_words long, starts array<int>, ends array<int>, items array<string>"


def _scan(prints: Fingerprints):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = W.Hashes()
        for batch, texts in W.portions(batches):
            hashes, offsets = W.hashed([W.folded(t or "") for t in texts], memory)
            owner = W.owners(offsets)
            spans: list[list[tuple[int, int]]] = [[] for _ in texts]
            items: list[set[int]] = [set() for _ in texts]
            for start, length, which in prints.found(hashes, offsets, owner):
                doc = int(owner[start])
                spans[doc].append((start - int(offsets[doc]), length))
                items[doc].update(which.tolist())
            starts, ends = [], []
            for found in spans:
                merged: list[list[int]] = []
                for a, n in sorted(found):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], a + n)
                    else:
                        merged.append([a, a + n])
                starts.append([a for a, _ in merged])
                ends.append([b for _, b in merged])
            names = [prints.items[i] for i in range(len(prints.items))]
            keep = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(np.diff(offsets), pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array([[names[i] for i in sorted(x)] for x in items], pa.list_(pa.string()))],
                [*(n for n in batch.schema.names if n != "text"), "n_words", "starts", "ends", "items"],
            )

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits and items of a document from the spans of all blocks."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            hit, end = 0, 0
            spans = []
            for a, b in sorted(x for one in r["spans"] for x in zip(one["starts"], one["ends"], strict=True)):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
            hit = sum(b - a for a, b in spans)
            items = sorted({i for one in r["spans"] for i in one["items"]})
            rows.append({k: v for k, v in r.items() if k != "spans"} | {"n_hit": hit, "n_items": len(items), "items": items, "hit_starts": [a for a, _ in spans], "hit_ends": [b for _, b in spans]})
        schema = [f for f in batch.schema if f.name != "spans"]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([*schema, ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items", pa.list_(pa.string())), ("hit_starts", pa.list_(pa.int32())), ("hit_ends", pa.list_(pa.int32()))]))


def inspect(docs: DataFrame, benchmark: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """For each row: words, words hit, spans hit (word numbers) and the items found."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    items = benchmark.filter("text is not null and item_id is not null").select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("item_text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("item_text") + F.octet_length("item") + 16), F.lit(0))).first()[0]
    blocks = -(-size // most_bytes) or 1
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    parts = []
    for k in range(blocks):
        # At most most_bytes of items on average; one block of them is on the driver at a time.
        block = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "item_text"), F.lit(blocks)) == k)
        prints = Fingerprints([(r[0], r[1]) for r in block.collect()])
        parts.append(slim.mapInArrow(_scan(prints), f"doc_id {kind}, text_key long, {SPANS}"))
    span = F.struct("starts", "ends", "items")
    if blocks == 1:
        found = parts[0].select("doc_id", "text_key", "n_words", F.array(span).alias("spans"))
    else:
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        hits = every.filter(F.size("starts") > 0).distinct().groupBy("doc_id", "text_key").agg(F.collect_list(span).alias("spans"))
        rows = parts[0].select("doc_id", "text_key", "n_words").alias("r")
        found = rows.join(hits.alias("h"), F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & F.col("r.text_key").eqNullSafe(F.col("h.text_key")), "left").select("r.doc_id", "r.text_key", "r.n_words", F.coalesce("spans", F.array()).alias("spans"))
    return found.mapInArrow(_digest, f"doc_id {kind}, text_key long, n_words long, n_hit long, n_items long, items array<string>, hit_starts array<int>, hit_ends array<int>")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, all their columns unchanged."""
    gone = inspect(docs, benchmark).filter("n_hit > 0").select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_gone_id")) & (F.xxhash64(docs["text"]) == F.col("_gone_key")), "left_anti")
