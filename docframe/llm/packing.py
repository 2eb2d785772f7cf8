"""Packing: token sequences of at most ``length`` ids, cut where it costs least.

The documents of a partition, in their order, form one stream of ids, each document followed by id 0. A
dynamic program chooses the cuts: a sequence costs its padding (none if its length is a power of two) and
what its last cut breaks (nothing at a document's end, little at a sentence's, more inside one). The best
predecessor within reach comes from a monotone queue, those at a power of two from a look-up. The stream is
worked off in blocks, and only cuts that later text can no longer change are settled, so memory is bounded
whatever a partition or a document holds. Nothing is shuffled.

A null text is an empty one: its document is id 0 alone. Repeated rows are packed as often as they occur.
A document longer than a sequence continues in the next ones. An empty table gives no pieces. Columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
import struct
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from docframe.llm import words as W

#: White space with the word behind it, a run of letters that ends there or all up to the next white space: no
#: token reaches from one such part into another, since the tokenizer cuts at the same places.
PART = re.compile(r"\s*+[A-Za-zÀ-ÖØ-öø-ÿ]++(?![^\W\d_])|\s*+\S++|\s++")
#: Cost of a cut, in ids of padding: after a sentence, and inside one.
SENTENCE, INSIDE = 2, 24
#: Inside a long sentence cuts are allowed at so many ids from each other.
STRIDE = 64
#: Ids that are worked on at once.
BLOCK = 1 << 18


# Fixed value: where a byte-level vocabulary of this kind cuts a text.
CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PROBES = (" the", "The", "don't we'll I'VE", "x1²½ 12345", "a\u0301é日本語 Ωmega", "\n\n  \t z ", "!?...--==", "🙂🙂 ok", " unbelievableness,", "\u00a0nbsp\u2003")


def quick(tokenizer, vocabulary: dict[str, int]):
    """The tokenizer's own vocabulary for a faster encoder, or None where the two don't agree.

    A byte-level vocabulary writes each byte as a character: printable ones as themselves, the others from 256 on.
    """
    import tiktoken

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(rest)}
    added = set(tokenizer.get_added_tokens_decoder())
    if not set(byte) <= set(vocabulary):
        return None
    try:
        ranks = {bytes(byte[c] for c in token): n for token, n in vocabulary.items() if n not in added}
        encoder = tiktoken.Encoding("own", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
        same = all(encoder.encode_ordinary(p) == tokenizer.encode(p, add_special_tokens=False).ids for p in PROBES)
    except (KeyError, ValueError):
        return None
    return encoder if same else None


class Encoder:
    """Ids of texts; those of frequent parts are remembered, in two generations of at most ``most`` parts.

    They are the tokenizer's. Where its vocabulary allows it, parts that are not remembered go through a faster
    encoder made of the same vocabulary; parts that hold an added token always go through the tokenizer itself.
    """

    def __init__(self, path: str, most: int = 120_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.quick = quick(self.tokenizer, vocabulary)
        self.added = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith((".", "!", "?", "。")) or "Ċ" in token

    def _learn(self, parts: list[str]) -> None:
        known, slow = self.known, parts
        if self.quick is not None:
            encode, added, slow = self.quick.encode_ordinary, self.added.search, []
            for part in parts:
                if added(part):
                    slow.append(part)
                else:
                    ids = encode(part)
                    known[part] = struct.pack(f"<{len(ids)}I", *ids)
        for part, code in zip(slow, self.tokenizer.encode_batch_fast(slow, add_special_tokens=False), strict=True):
            known[part] = struct.pack(f"<{len(code.ids)}I", *code.ids)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        found = [PART.findall(t) for t in texts]
        if len(self.known) > self.most:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = set().union(*found).difference(known)
        for part in [p for p in new if p in older]:
            known[part] = older[part]
            new.discard(part)
        unknown = list(new)
        for k in range(0, len(unknown), 10_000):
            self._learn(unknown[k : k + 10_000])
        return [np.frombuffer(b"".join(map(known.__getitem__, parts)), "<u4") for parts in found]


def cuts(positions: list[int], costs: list[int], length: int, smallest: int) -> list[int]:
    """The cheapest cuts, the first at ``positions[0]`` and the last at ``positions[-1]``.

    Neighbouring positions lie at most ``length`` apart. A sequence of a power of two ids, ``smallest`` at
    least, is not padded.
    """
    best, before = [0], [-1]
    index = {positions[0]: 0}
    queue: deque[tuple[int, int, int]] = deque([(positions[0], positions[0], 0)])  # best + position, position, number
    powers = []
    power = length
    while power >= smallest:
        powers.append(power)
        power //= 2
    get = index.get
    for j in range(1, len(positions)):
        at = positions[j]
        while queue[0][1] < at - length:
            queue.popleft()
        first = queue[0]
        cost, source = first[0] + length - at, first[2]
        for power in powers:
            i = get(at - power)
            if i is not None and best[i] < cost:
                cost, source = best[i], i
        cost += costs[j]
        best.append(cost)
        before.append(source)
        index[at] = j
        key = cost + at
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, at, j))
    out, j = [], len(positions) - 1
    while j >= 0:
        out.append(positions[j])
        j = before[j]
    return out[::-1]


def _places(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, last: bool, length: int) -> tuple[list[int], list[int]]:
    """Where cuts are allowed, and what each costs."""
    n = len(ids)
    cost = np.full(n + 1, -1, np.int64)
    cost[np.flatnonzero(ends[ids]) + 1] = SENTENCE
    cost[doc_ends] = 0
    cost[0] = cost[n] = 0
    places = np.flatnonzero(cost >= 0)
    gaps = np.diff(places)
    for at, gap in zip(places[:-1][gaps > STRIDE].tolist(), gaps[gaps > STRIDE].tolist(), strict=True):
        cost[at + STRIDE : at + gap : STRIDE] = INSIDE
    if last:  # the end of the stream is cut as finely as need be
        tail = cost[max(0, n - 2 * length) :]
        tail[tail < 0] = INSIDE
    places = np.flatnonzero(cost >= 0)
    return places.tolist(), cost[places].tolist()


def _packed(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        sequence = TaskContext.get().partitionId() << 33
        schema = None
        stream: list[list] = []  # doc_id, ids left, ids before them, ids in all
        held = 0

        def settle(last: bool) -> pa.RecordBatch | None:
            nonlocal stream, held, sequence
            ids = np.concatenate([s[1] for s in stream])
            sizes = np.array([len(s[1]) for s in stream])
            doc_ends = np.cumsum(sizes)
            places, costs = _places(ids, doc_ends, encoder.ends, last, length)
            chosen = cuts(places, costs, length, 1 if last else STRIDE)
            if not last:
                chosen = [c for c in chosen if c <= len(ids) - 8 * length]
            if len(chosen) < 2:
                return None
            edges = np.unique(np.concatenate([chosen, doc_ends[doc_ends < chosen[-1]]])).tolist()
            rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            starts = doc_ends - sizes
            doc, at = 0, 0
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                while doc_ends[doc] <= a:
                    doc += 1
                if a >= chosen[at + 1]:
                    at += 1
                for k, v in zip(rows, (stream[doc][0], stream[doc][2] + a - int(starts[doc]), b - a, ids[a:b].tobytes(), stream[doc][3], sequence + at, a - chosen[at]), strict=True):
                    rows[k].append(v)
            sequence += len(chosen) - 1
            done = chosen[-1]
            rest = []
            for s, start, end in zip(stream, starts.tolist(), doc_ends.tolist(), strict=True):
                if end > done:
                    skip = max(0, done - start)
                    rest.append([s[0], s[1][skip:].copy(), s[2] + skip, s[3]])
            stream, held = rest, len(ids) - done
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows.values(), schema, strict=True)], schema=schema)

        for batch, texts in W.portions(batches):
            kind = batch.schema.field("doc_id").type
            schema = pa.schema([("doc_id", kind), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
            for doc, ids in zip(batch["doc_id"].to_pylist(), encoder.ids([t or "" for t in texts]), strict=True):
                ids = np.append(ids, np.uint32(0))
                done = 0
                while done < len(ids):  # a very long document goes through in blocks
                    part = ids[done : done + BLOCK]
                    stream.append([doc, part, done, len(ids)])
                    held += len(part)
                    done += len(part)
                    if held >= BLOCK and (out := settle(False)) is not None:
                        yield out
        if stream and (out := settle(True)) is not None:
            yield out
        del encoder, stream
        W.released()

    return run


def pack(docs: DataFrame, tokenizer: str, length: int = 1024) -> DataFrame:
    """Pieces: a document's ids (little-endian, 32 bits), where they start in it, and their place in a sequence."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_packed(tokenizer, length), f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
