"""Token ids in files of length-delimited binary records, with an index of offsets beside each.

A record frames one document's ids: eight bytes of length, its masked checksum, the payload, its masked checksum;
checksums are CRC-32C, rotated right by 15 bits plus a constant, all numbers little-endian. This is the framing that
common training loaders read. A payload is the key's length (-1 for null), the number of ids and the bytes of each in
32 bits, the key's text and the ids, both filled up to four bytes; ids take two bytes where the whole vocabulary fits
in them, else four. The index ``<file>.idx`` holds per record its offset and the number of ids before it
in the file, 64 bits each, and at last the file's size and all ids: a reader finds any record with one small read,
in any order, and knows where its ids stand in the corpus without reading those before.

Documents are written in ascending order of their key, nulls first: one range shuffle of the texts, sorted within
the tasks; rows of one key are told apart by their place in the input, so a key that a third of all rows share is
spread like any other. Each task encodes its range and writes its own files, named after the attempt; only
those of finished tasks are listed in the manifest, so a lost executor leaves at most files that nobody reads.

Checksums of a batch are computed together: the code is linear, so neighbouring words are joined pairwise, with the
left one carried over the right one's length by four look-ups, and lanes by the bits of their distance to the end.

A null text is an empty one: its record holds the end id alone. A text's ids are written whole whatever their
number. Repeated rows give a record each. An empty table gives no files and an empty result. Columns other than the
key and the text are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm import words as W
from docframe.llm.packing import Encoder
from docframe.operators.ordered import running_totals
from docframe.session import work_folder, written
from docframe.sources.store import Store, store

#: Bytes after which a new file is begun, records one task reads, bytes read at once, and most tasks of a read.
MOST, RECORDS, RANGE, TASKS = 256 << 20, 10_000, 4 << 20, 10_000
LANE = 64
ENTRY = 16
# Fixed values of the framing: the reflected CRC-32C polynomial and the constant that masks a checksum.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8


def _tables(columns: np.ndarray) -> np.ndarray:
    """Images of all bytes at each of the four places, from the images of the 32 bits."""
    out = np.zeros((4, 256), np.uint32)
    for place in range(4):
        for bit in range(8):
            out[place, 1 << bit : 2 << bit] = out[place, : 1 << bit] ^ columns[8 * place + bit]
    return out


def _carried(tables: np.ndarray, v: np.ndarray) -> np.ndarray:
    return tables[0][v & 255] ^ tables[1][(v >> 8) & 255] ^ tables[2][(v >> 16) & 255] ^ tables[3][v >> 24]


@cache
def over(power: int) -> np.ndarray:
    """Tables that carry a checksum over 2 ** ``power`` words of four bytes."""
    if power:
        half = over(power - 1)
        return _tables(_carried(half, _carried(half, np.uint32(1) << np.arange(32, dtype=np.uint32))))
    state = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(32):
        state = (state >> 1) ^ np.where(state & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return _tables(state)


def checksums(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Masked CRC-32C of each stretch ``offsets[k]:offsets[k + 1]`` of 32-bit words, none of them empty."""
    sizes = np.diff(offsets)
    lanes = -(-sizes // LANE)
    ends = np.cumsum(lanes)
    value = np.zeros(int(ends[-1]) * LANE, np.uint32)  # zeros before a stretch change nothing
    value[np.arange(int(offsets[-1])) + np.repeat(ends * LANE - offsets[1:], sizes)] = words
    value[ends * LANE - sizes] ^= np.uint32(0xFFFFFFFF)
    for power in range(LANE.bit_length() - 1):
        value = _carried(over(power), value[0::2]) ^ value[1::2]
    apart = np.repeat(ends, lanes) - 1 - np.arange(int(ends[-1]))  # lanes behind, in the same stretch
    for bit in range(int(apart.max()).bit_length()):
        far = np.flatnonzero((apart >> bit) & 1)
        value[far] = _carried(over(bit + LANE.bit_length() - 1), value[far])
    state = ~_carried(over(0), np.bitwise_xor.reduceat(value, ends - lanes))
    return ((state >> 15) | (state << 17)) + np.uint32(MASK)


def framed(payloads: list[bytes]) -> list[bytes]:
    """A record for each payload of whole 32-bit words."""
    if not payloads:
        return []
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    lengths = sizes.astype("<u8")
    heads = checksums(lengths.view("<u4"), np.arange(len(payloads) + 1) * 2)
    sums = checksums(np.frombuffer(b"".join(payloads), "<u4"), np.concatenate([[0], np.cumsum(sizes // 4)]))
    pack = struct.Struct("<QI").pack
    tail = sums.astype("<u4").tobytes()
    return [pack(n, h) + p + tail[4 * k : 4 * k + 4] for k, (n, h, p) in enumerate(zip(lengths.tolist(), heads.tolist(), payloads, strict=True))]


def unframed(raw: bytes, offsets: np.ndarray) -> list[bytes]:
    """Payloads of the records between ``offsets``; a record that was damaged is an error."""
    out = [raw[a + 12 : b - 4] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    if out and framed(out) != [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]:
        raise ValueError("length or checksum of a record is wrong")
    return out


HEAD = struct.Struct("<iII")


def payload(key: str | None, ids: np.ndarray) -> bytes:
    """A document's key and ids, which come in the width they are written in."""
    name, raw = (key or "").encode("utf-8", "surrogatepass"), ids.tobytes()
    return HEAD.pack(-1 if key is None else len(name), len(ids), ids.itemsize) + name + bytes(-len(name) % 4) + raw + bytes(-len(raw) % 4)


def parsed(raw: bytes) -> tuple[str | None, np.ndarray]:
    """Key and ids of a payload."""
    size, n, width = HEAD.unpack_from(raw)
    end = HEAD.size + max(0, size)
    ids = np.frombuffer(raw, f"<u{width}", n, end + -end % 4)
    return None if size < 0 else raw[HEAD.size : end].decode("utf-8", "surrogatepass"), ids


MANIFEST = pa.schema([("part", pa.int64()), ("file", pa.string()), ("records", pa.int64()), ("ids", pa.int64()), ("ids_before", pa.int64())])


def encoded(encoder: Encoder, texts: list[str], width: str) -> list[np.ndarray]:
    """Ids of whole texts; those that hold an added token, or all where there is no faster encoder, by the tokenizer."""
    if encoder.quick is None:
        return [ids.astype(width) for ids in encoder.ids(texts)]
    quick, added, out = encoder.quick.encode_ordinary, encoder.added.search, []
    for text in texts:
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids if added(text) else quick(text)
        out.append(np.array(ids, width))
    return out


def _writer(place: Store, tokenizer: str, end_id: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = place.opened()
        system.create_dir(base, recursive=True)
        encoder = Encoder(tokenizer)
        width = "<u2" if max(len(encoder.ends) - 1, end_id) < 1 << 16 else "<u4"
        out, name, files, size, counted, before, index = None, "", 0, 0, 0, 0, []

        def close() -> pa.RecordBatch:
            nonlocal out, before
            out.close()
            with system.open_output_stream(f"{base}/{name}.idx") as beside:
                beside.write(np.concatenate([*index, [[size, counted]]]).astype("<u8").tobytes())
            row = [task.partitionId(), name, sum(map(len, index)), counted, before]
            out, before = None, before + counted
            return pa.RecordBatch.from_pydict({f.name: [v] for f, v in zip(MANIFEST, row, strict=True)}, MANIFEST)

        for batch, texts in W.portions(batches):
            ids = encoded(encoder, [t or "" for t in texts], width)
            records = framed([payload(k, np.append(i, np.array(end_id, width))) for k, i in zip(batch["key"].to_pylist(), ids, strict=True)])
            if out is None:
                name = f"ids-{task.partitionId():06d}-{files:04d}-{task.taskAttemptId()}.bin"
                out, files, size, counted, index = system.open_output_stream(f"{base}/{name}"), files + 1, 0, 0, []
            sizes = np.cumsum([0, *map(len, records)])
            numbers = np.cumsum([0, *[len(i) + 1 for i in ids]])
            index.append(np.column_stack([sizes[:-1] + size, numbers[:-1] + counted]))
            out.write(b"".join(records))
            size, counted = size + int(sizes[-1]), counted + int(numbers[-1])
            if size >= most:
                yield close()
        if out is not None:
            yield close()
        del encoder
        W.released()

    return run


def write(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2, folder: str | None = None, most: int = MOST) -> DataFrame:
    """Write a record per row, in the order of ``key``; the manifest of the files, itself stored so that they are written once.

    Columns: part, file (relative to ``folder``), records, ids, and ``start``, the ids of all files before it.
    """
    spark = docs.sparkSession
    place = store(spark, folder or work_folder(spark, "records"))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("tie"))
    ordered = rows.repartitionByRange(F.col("k").asc_nulls_first(), "tie").sortWithinPartitions(F.col("k").asc_nulls_first(), "tie")
    files = ordered.select(F.col("k").cast("string").alias("key"), "text").mapInArrow(_writer(place, tokenizer, end_id, most), "part long, file string, records long, ids long, ids_before long")
    manifest = written(files, "manifest")
    parts = manifest.groupBy(F.lit(0).alias("all"), "part").agg(F.sum("ids").alias("sum_ids"))
    starts = running_totals(parts, ["all"], "part", ["sum_ids"])
    return manifest.join(starts, "part").select("part", "file", "records", "ids", (F.col("sum_ids_before") + F.col("ids_before")).alias("start"))


ROWS = pa.schema([("key", pa.string()), ("start", pa.int64()), ("ids", pa.binary())])


def _reader(place: Store):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = place.opened()
        for batch in batches:
            for work in batch.to_pylist():
                path, count = f"{base}/{work['file']}", work["last"] - work["first"]
                with system.open_input_file(f"{path}.idx") as beside:
                    beside.seek(work["first"] * ENTRY)
                    index = np.frombuffer(beside.read((count + 1) * ENTRY), "<u8").reshape(-1, 2).astype(np.int64)
                with system.open_input_file(path) as handle:
                    at = 0
                    while at < count:
                        end = max(at + 1, int(np.searchsorted(index[:, 0], index[at, 0] + RANGE, "right")) - 1)
                        handle.seek(int(index[at, 0]))
                        raw = handle.read(int(index[end, 0] - index[at, 0]))
                        found = [parsed(p) for p in unframed(raw, index[at : end + 1, 0] - index[at, 0])]
                        starts = index[at:end, 1] + work["start"]
                        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array(starts), pa.array([i.astype("<u4").tobytes() for _, i in found], pa.binary())], schema=ROWS)
                        at = end

    return run


def read(manifest: DataFrame, folder: str, seed: int | None = None) -> DataFrame:
    """key (as text), start (ids of all records before) and ids (32 bits each) of each record, with checked checksums.

    Without ``seed`` tasks read ranges of neighbouring records. With it each record is read by its own offset, in an
    order that the seed alone decides.
    """
    first = F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(RECORDS if seed is None else 1).cast("long"))
    work = manifest.select("file", "start", "records", F.explode(first).alias("first"))
    work = work.select("file", "start", "first", F.least(F.col("first") + (RECORDS if seed is None else 1), "records").alias("last"))
    ranges = manifest.agg(F.sum(F.ceil(F.col("records") / RECORDS))).first()[0] or 1
    if seed is None:
        work = work.repartition(max(1, min(TASKS, ranges)))
    else:
        draw = F.xxhash64("start", "first", F.lit(seed))
        work = work.withColumn("draw", draw).repartitionByRange(max(1, min(TASKS, ranges)), "draw").sortWithinPartitions("draw")
    return work.select("file", "start", "first", "last").mapInArrow(_reader(store(manifest.sparkSession, folder)), "key string, start long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """Write the ids of ``docs`` and read them back: key, start, ids."""
    folder = work_folder(docs.sparkSession, "records")
    records = read(write(docs, tokenizer, key, folder=folder), folder)
    return records.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "start", "ids")
