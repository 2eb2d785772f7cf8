"""Words of whole texts as numpy arrays: the shared ground of the text operators.

A batch of texts becomes one array of 64-bit word hashes and the offsets of the
texts in it, so windows of every length are computed without a Python loop over
words. Equal words have equal hashes in every process.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

#: Letters, digits and all bytes of non-ASCII characters stay, A-Z become a-z, the rest separates.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Only A-Z become a-z.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Words a process remembers the hash of; beyond it the memory is emptied.
REMEMBERED = 100_000
#: Characters of text worked on at once.
CHARS = 2_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """Hash of each word, remembered."""

    def __init__(self, seed: int = 0) -> None:
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value


def spaced(text: str) -> list[bytes]:
    """Words between ASCII white space (space and U+0009 to U+000D)."""
    return text.encode("utf-8", "surrogatepass").split()


def spaced_lower(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def folded(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def hashed(lists: list[list[bytes]], memory: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text starts (one more entry: the end)."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    look = memory.__getitem__
    out = np.empty(int(offsets[-1]), np.uint64)
    for words, at in zip(lists, offsets.tolist(), strict=False):
        out[at : at + len(words)] = np.fromiter(map(look, words), np.uint64, len(words))
    return out, offsets


def mixed(h: np.ndarray) -> np.ndarray:
    """Well spread hash of a hash."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A polynomial hash of each run of ``length`` hashes, by doubling; text borders are not heeded."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    done, have, rest, power, span = None, 0, length, hashes, 1
    while True:
        if rest & 1:
            if done is None:
                done, have = power, span
            else:
                n = len(hashes) - have - span + 1
                factor = np.uint64(pow(int(MIX), span, 1 << 64))
                done, have = done[:n] * factor + power[have : have + n], have + span
        rest >>= 1
        if not rest:
            return done
        n = len(hashes) - 2 * span + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        power = power[:n] * np.uint64(pow(int(MIX), span, 1 << 64)) + power[span : span + n]
        span *= 2


def released() -> None:
    """Give freed memory back to the machine: workers are kept for later tasks, and executors share its memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def owners(offsets: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def inside(owner: np.ndarray, length: int) -> np.ndarray:
    """Which windows of ``length`` words lie within one text."""
    n = max(0, len(owner) - length + 1)
    return owner[:n] == owner[length - 1 : length - 1 + n]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``length`` words at one of ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:n]) > 0


def portions(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The batches, cut so that each holds a bounded number of characters or one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch[text].cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False)
        total, start = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and total + size > CHARS:
                part = batch.slice(start, i - start)
                yield part, part[text].to_pylist()
                total, start = 0, i
            total += size
        if start < len(sizes):
            part = batch.slice(start)
            yield part, part[text].to_pylist()
    released()
