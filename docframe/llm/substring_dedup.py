"""Substring dedup with fixed-block anchors: repeated passages stay once.

A word goes if it lies in a window of ``length`` words that also starts in a document with a smaller doc_id.
Every such window holds a whole block of ``length // 2`` words that is aligned in the earlier document, so:

1. All documents' aligned, non-overlapping blocks are indexed, and every rolling window of that size probes the
   index. A hit is a block that another document holds at any place.
2. Hits are extended: every window of ``length`` words around one is compared, as a 64-bit hash, with those of
   all other documents, and the smallest doc_id that has it is found. The windows that an earlier document has,
   taken together, are the maximal exact repeats, and their words go.

Documents are dealt into chunks of bounded size. A chunk sends the sorted hashes it holds, once each and packed
as differences, to slices of the hash range; a slice sees each hash once per chunk, however often a passage
occurs, and answers with one bit per hash. So the text is shuffled once, no list of pairs arises, and neither a
frequent passage nor a large group of copies meets in one task.

Words stand between ASCII white space and are compared as they are. Null texts have no words. Rows without a
doc_id neither lose words nor cost others theirs; rows with the same doc_id don't cost each other words.
doc_id is an integer. An empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm import words as W

LENGTH = 50
#: Bytes of text in a chunk, and hashes in a slice, about.
CHUNK, SLICE = 4 << 20, 2 << 20
#: Bits of a block's hash that are sent; equal ones only let more windows through to the second step.
BITS = 48
PACKED = "slice long, chunk long, n long, data binary"
ANSWER = "chunk long, step int, slice long, bits binary"


def packed(values: np.ndarray, *others: np.ndarray) -> bytes:
    """Sorted unsigned numbers as differences, byte by byte, with arrays of the same length beside them."""
    steps = np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    planes = [np.ascontiguousarray(steps).tobytes()] + [np.ascontiguousarray(o).tobytes() for o in others]
    raw = b"".join(planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    steps = np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T
    out, at = [np.cumsum(np.ascontiguousarray(steps).reshape(-1).view(np.uint64), dtype=np.uint64)], 8 * n
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


class Chunk:
    """The windows of a chunk's documents, the same in each pass over it."""

    def __init__(self, table: pa.Table, length: int) -> None:
        order = pa.compute.sort_indices(table, [("doc_id", "ascending")])
        self.table = table.take(order)
        ids = self.table["doc_id"]
        self.texts = [W.spaced(t or "") for t in self.table["text"].to_pylist()]
        hashes, self.offsets = W.hashed(self.texts, W.Hashes())
        self.owner = W.owners(self.offsets)
        known = ids.is_valid().to_numpy()
        self.ids = ids.fill_null(0).to_numpy().astype(np.int64)
        block = length // 2
        self.block, self.length = block, length
        self.starts = np.flatnonzero(W.inside(self.owner, block))
        self.starts = self.starts[known[self.owner[self.starts]]]
        self.hashes = hashes
        self.fine = W.mixed(W.windows(hashes, block))[self.starts] >> np.uint64(64 - BITS) if len(self.starts) else np.empty(0, np.uint64)
        self.keys, self.where = np.unique(self.fine, return_inverse=True)

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of a block's size; 1: an aligned block is among them, 2: several documents hold it."""
        doc = self.ids[self.owner[self.starts]]
        aligned = (self.starts - self.offsets[self.owner[self.starts]]) % self.block == 0
        flags = np.zeros(len(self.keys), np.uint8)
        flags[self.where[aligned]] = 1
        low, high = np.full(len(self.keys), np.iinfo(np.int64).max), np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.where, doc)
        np.maximum.at(high, self.where, doc)
        return self.keys, flags | ((low != high).astype(np.uint8) << 1)

    def extended(self, hit: np.ndarray) -> None:
        """Keep the windows of full length that hold a hit."""
        n = len(self.owner) - self.length + 1
        around = np.zeros(max(0, n) + 1, np.int64)
        at = self.starts[hit[self.where]] if len(self.starts) else self.starts
        if n > 0 and len(at):
            np.add.at(around, np.clip(at - (self.length - self.block), 0, n), 1)
            np.add.at(around, np.clip(at + 1, 0, n), -1)
            whole = (np.cumsum(around[:n]) > 0) & W.inside(self.owner, self.length)
            self.long = np.flatnonzero(whole)
            long = W.mixed(W.windows(self.hashes, self.length)[self.long])
        else:
            self.long, long = np.empty(0, np.int64), np.empty(0, np.uint64)
        self.long_keys, self.long_where = np.unique(long, return_inverse=True)
        self.first = np.full(len(self.long_keys), np.iinfo(np.int64).max)
        np.minimum.at(self.first, self.long_where, self.ids[self.owner[self.long]])


def _sent(chunk: int, keys: np.ndarray, width: int, bits: int, *others: np.ndarray) -> pa.Table:
    """One row for each slice of the hash range that the sorted ``keys`` reach."""
    rows: dict[str, list] = {"slice": [], "chunk": [], "n": [], "data": []}
    if len(keys):
        slices = (keys >> np.uint64(width - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        edges = np.flatnonzero(np.diff(slices, prepend=-1, append=-2))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            for k, v in zip(rows, (int(slices[a]), chunk, b - a, packed(keys[a:b], *(o[a:b] for o in others))), strict=True):
                rows[k].append(v)
    return pa.table(rows, pa.schema([("slice", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64()), ("data", pa.binary())]))


def _answered(rows: list[dict], step: int, truth: list[np.ndarray]) -> pa.Table:
    out = [{"chunk": r["chunk"], "step": step, "slice": r["slice"], "bits": pa.compress(np.packbits(t).tobytes(), codec="zstd", asbytes=True)} for r, t in zip(rows, truth, strict=True) if t.any()]
    return pa.Table.from_pylist(out, pa.schema([("chunk", pa.int64()), ("step", pa.int32()), ("slice", pa.int64()), ("bits", pa.binary())]))


def _matched(table: pa.Table) -> pa.Table:
    """Step 1 in a slice: which hashes are an aligned block somewhere and stand in two documents."""
    rows = table.sort_by("chunk").to_pylist()
    parts = [unpacked(r["data"], r["n"], np.uint8) for r in rows]
    keys = np.concatenate([p[0] for p in parts])
    flags = np.concatenate([p[1] for p in parts])
    _, where, count = np.unique(keys, return_inverse=True, return_counts=True)
    block, several = np.zeros(len(count), bool), count > 1
    block[where[flags & 1 > 0]] = True
    several[where[flags & 2 > 0]] = True
    truth = (block & several)[where]
    return _answered(rows, 1, np.split(truth, np.cumsum([r["n"] for r in rows])[:-1]))


def _earlier(table: pa.Table) -> pa.Table:
    """Step 2 in a slice: which windows a document of another chunk has that comes before all of this chunk's."""
    rows = table.sort_by("chunk").to_pylist()
    parts = [unpacked(r["data"], r["n"], np.int64) for r in rows]
    keys, first = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    found, where = np.unique(keys, return_inverse=True)
    low = np.full(len(found), np.iinfo(np.int64).max)
    np.minimum.at(low, where, first)
    truth = low[where] < first
    return _answered(rows, 2, np.split(truth, np.cumsum([r["n"] for r in rows])[:-1]))


def _told(answers: pa.Table, step: int, keys: np.ndarray, width: int, bits: int) -> np.ndarray:
    """The bits for the sorted ``keys``, put together from the slices' answers."""
    out = np.zeros(len(keys), bool)
    slices = (keys >> np.uint64(width - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    for r in answers.to_pylist():
        if r["step"] == step:
            a, b = np.searchsorted(slices, [r["slice"], r["slice"] + 1])
            size = (b - a + 7) // 8
            out[a:b] = np.unpackbits(np.frombuffer(pa.decompress(r["bits"], decompressed_size=int(size), codec="zstd", asbytes=True), np.uint8), count=int(b - a)).astype(bool)
    return out


def dedup(docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK, slice_hashes: int = SLICE) -> DataFrame:
    """(doc_id, n_words, n_removed, text): each row's words without the repeats, joined by single spaces."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = total // chunk_bytes + 1
    bits = max(0, (total // 6 // slice_hashes).bit_length())
    # Placed by doc_id and text, so equal rows lie together and each pass meets the same chunks.
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"))
    grouped = dealt.groupBy("chunk")

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        keys, flags = Chunk(table, length).probes()
        W.released()
        return _sent(key[0].as_py(), keys, BITS, bits, flags)

    def extend(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _sent(0, np.empty(0, np.uint64), 64, bits)
        chunk = Chunk(table, length)
        chunk.extended(_told(answers, 1, chunk.keys, BITS, bits))
        return _sent(key[0].as_py(), chunk.long_keys, 64, bits, chunk.first)

    schema = pa.schema([("doc_id", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])

    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({f.name: pa.array([], table["doc_id"].type if f.name == "doc_id" else f.type) for f in schema})
        chunk = Chunk(table, length)
        chunk.extended(_told(answers, 1, chunk.keys, BITS, bits))
        later = _told(answers, 2, chunk.long_keys, 64, bits)
        gone = (chunk.ids[chunk.owner[chunk.long]] > chunk.first[chunk.long_where]) | later[chunk.long_where] if len(chunk.long) else np.empty(0, bool)
        words = W.covered(chunk.long[gone], length, len(chunk.owner))
        texts, removed = [], []
        for text, a, b in zip(chunk.texts, chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), strict=True):
            lost = words[a:b]
            removed.append(int(lost.sum()))
            kept = [w for w, x in zip(text, lost.tolist(), strict=True) if not x] if removed[-1] else text
            texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
        return pa.table({"doc_id": chunk.table["doc_id"], "n_words": pa.array(np.diff(chunk.offsets), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "text": pa.array(texts, pa.string())})

    hits = grouped.applyInArrow(probe, PACKED).groupBy("slice").applyInArrow(_matched, ANSWER)
    firsts = grouped.cogroup(hits.groupBy("chunk")).applyInArrow(extend, PACKED).groupBy("slice").applyInArrow(_earlier, ANSWER)
    answers = hits.unionByName(firsts)
    return grouped.cogroup(answers.groupBy("chunk")).applyInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, text string")
