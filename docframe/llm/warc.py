"""WARC archives packed in ZIP files: written by tasks, read by ranges.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``, each record its own gzip member, and
``indexes/index.cdxj`` with the offset and length of each record in it. The reader takes a file's end, finds the
central directory (ZIP64 as well), locates the stored members, reads the index, and then only the ranges of the
records it is to return; nothing is unpacked to disk.

Of rows with equal payloads of at least ``least`` bytes, that with the smallest key is written in full, the
others as revisits of it. Equal payloads are found by SHA-256; only key and digest are shuffled for that, the rows
of one digest in parts, and then each row meets its verdict by key, so a payload that a third of all rows share
burdens no task.

Null payloads are empty. Null URLs have no target header. A null key comes after all others. Rows with the
same key and payload are all written in full or all as revisits. An empty table gives no records. Files carry
the task attempt in their names and only those of finished tasks are listed, so a lost executor leaves at most
files that nobody reads.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docframe.llm import words as W
from docframe.session import work_folder, written
from docframe.sources.store import Store, store

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Parts that the rows of one payload are dealt out to.
SALTS = 16
#: Bytes of data after which a new archive is begun, records that one task reads, and bytes read at once.
MOST, RECORDS, RANGE = 256 << 20, 4000, 4 << 20


def record(key: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record; a revisit (``refers_to``) holds the response's head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if key is not None:
        lines.append(f"WARC-Record-ID: <urn:key:{json.dumps(key)}>")
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:key:{json.dumps(refers_to)}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Key, type, digest, payload and length of a record; a response's digest is counted anew and compared."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")

    def key(name: str) -> str | None:
        return json.loads(fields[name].removeprefix("<urn:key:").removesuffix(">")) if name in fields else None

    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {key('WARC-Record-ID')}: payload and header differ")
    return {"key": key("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "payload_bytes": size, "payload_digest": digest, "refers_to": key("WARC-Refers-To"), "payload": payload if fields["WARC-Type"] == "response" else None}


class Archive:
    """Members of a ZIP file that any store with range reads holds."""

    def __init__(self, handle, size: int) -> None:
        self.handle = handle
        tail_at = max(0, size - 65_557 - 20)
        tail = self._read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
        locator = tail[end - 20 : end] if end >= 20 else b""
        if locator[:4] == b"PK\x06\x07":
            at = struct.unpack("<Q", locator[8:16])[0]
            wide = self._read(at, 56)
            if wide[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end of central directory")
            count, length, start = struct.unpack("<QQQ", wide[32:56])
        self.members = self._directory(self._read(start, length), count)

    def _read(self, at: int, size: int) -> bytes:
        self.handle.seek(at)
        return self.handle.read(size)

    @staticmethod
    def _directory(raw: bytes, count: int) -> dict[str, tuple[int, int, int]]:
        """Name to method, stored size and place of the local header."""
        members, at = {}, 0
        for _ in range(count):
            if raw[at : at + 4] != b"PK\x01\x02":
                raise ValueError("broken central directory")
            method, = struct.unpack("<H", raw[at + 10 : at + 12])
            stored, size, names, extras, comment = struct.unpack("<IIHHH", raw[at + 20 : at + 34])
            header, = struct.unpack("<I", raw[at + 42 : at + 46])
            name = raw[at + 46 : at + 46 + names].decode()
            extra, k = raw[at + 46 + names : at + 46 + names + extras], 0
            while k + 4 <= len(extra):
                tag, n = struct.unpack("<HH", extra[k : k + 4])
                if tag == 1:  # in this order, each only where the short field is full
                    values = list(struct.unpack(f"<{n // 8}Q", extra[k + 4 : k + 4 + n // 8 * 8]))
                    if size == 0xFFFFFFFF:
                        size = values.pop(0)
                    if stored == 0xFFFFFFFF:
                        stored = values.pop(0)
                    if header == 0xFFFFFFFF:
                        header = values.pop(0)
                k += 4 + n
            members[name] = method, stored, header
            at += 46 + names + extras + comment
        return members

    def place(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes start, and how many there are."""
        method, stored, header = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is not stored")
        local = self._read(header, 30)
        names, extras = struct.unpack("<HH", local[26:30])
        return header + 30 + names + extras, stored

    def member(self, name: str) -> bytes:
        return self._read(*self.place(name))


def _writer(place: Store, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = place.opened()
        system.create_dir(base, recursive=True)
        state: dict = {}

        def begin() -> None:
            name = f"{base}/pages-{task.partitionId():06d}-{task.taskAttemptId()}-{state.get('files', 0)}.wacz"
            out = system.open_output_stream(name)
            archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
            state.update(name=name, out=out, zip=archive, data=archive.open(DATA, "w", force_zip64=True), at=0, index=[], files=state.get("files", 0) + 1)

        def end() -> pa.RecordBatch:
            state["data"].close()
            state["zip"].writestr(INDEX, "".join(state["index"]))
            state["zip"].close()
            state["out"].close()
            row = {"archive": [state["name"]], "records": [len(state["index"])]}
            state["zip"] = None
            return pa.RecordBatch.from_pydict(row, pa.schema([("archive", pa.string()), ("records", pa.int64())]))

        for batch, texts in W.portions(batches, "payload"):
            for text, key, url, digest, refers in zip(texts, *(batch[c].to_pylist() for c in ("key", "url", "digest", "refers_to")), strict=True):
                if state.get("zip") is None:
                    begin()
                payload = (text or "").encode("utf-8", "surrogatepass")
                raw = gzip.compress(record(key, url, payload, digest, refers, date), 3, mtime=0)
                state["data"].write(raw)
                state["index"].append(json.dumps({"key": key, "offset": state["at"], "length": len(raw)}) + "\n")
                state["at"] += len(raw)
                if state["at"] >= MOST:
                    yield end()
        if state.get("zip") is not None:
            yield end()

    return run


def write(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 100, date: str = "2000-01-01T00:00:00Z", folder: str | None = None) -> DataFrame:
    """Write one record per row; (archive, records) of each file written, itself stored so that files are written once."""
    folder = folder or work_folder(pages.sparkSession, "archives")
    text = F.coalesce(payload, F.lit(""))
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("url"), text.alias("payload"), F.sha2(text, 256).alias("digest"))
    slim = rows.filter(F.octet_length("payload") >= least).select("k", "digest")
    firsts = slim.groupBy("digest").agg(F.min("k").alias("first"), F.count("*").alias("n")).filter((F.col("n") > 1) & F.col("first").isNotNull())
    # A payload that very many rows share is dealt out: its first row is told to each of SALTS parts of them.
    told = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("n")
    salted = slim.withColumn("salt", F.pmod(F.xxhash64("k"), F.lit(SALTS)).cast("int"))
    revisits = salted.join(told, ["digest", "salt"]).filter(F.col("k").isNull() | (F.col("k") > F.col("first"))).select(F.col("k").alias("rk"), F.col("digest").alias("rd"), "first").distinct()
    both = rows.join(revisits, rows["k"].eqNullSafe(F.col("rk")) & (F.col("digest") == F.col("rd")), "left")
    ready = both.select(F.col("k").cast("string").alias("key"), "url", "payload", "digest", F.col("first").cast("string").alias("refers_to"))
    return written(ready.mapInArrow(_writer(store(pages.sparkSession, folder), date), "archive string, records long"), "manifest")


RECORD = pa.schema([("key", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])


def _reader(place: Store, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = place.opened()
        for batch in batches:
            for work in batch.to_pylist():
                size = system.get_file_info(work["archive"]).size
                with system.open_input_file(work["archive"]) as handle:
                    archive = Archive(handle, size)
                    index = [json.loads(x) for x in archive.member(INDEX).decode().splitlines()[work["first"] : work["first"] + RECORDS]]
                    start, _ = archive.place(DATA)
                    k = 0
                    while k < len(index):
                        last = k
                        while last + 1 < len(index) and index[last + 1]["offset"] + index[last + 1]["length"] - index[k]["offset"] <= RANGE:
                            last += 1
                        at = index[k]["offset"]
                        raw = archive._read(start + at, index[last]["offset"] + index[last]["length"] - at)
                        rows = [parsed(zlib.decompress(raw[x["offset"] - at : x["offset"] - at + x["length"]], 31)) for x in index[k : last + 1]]
                        if not payloads:
                            rows = [r | {"payload": None} for r in rows]
                        yield pa.RecordBatch.from_pylist(rows, RECORD)
                        k = last + 1

    return run


def read(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives that ``manifest`` lists, in parallel by ranges of records."""
    work = manifest.select("archive", F.explode(F.sequence(F.lit(0), F.col("records") - 1, F.lit(RECORDS))).alias("first"))
    spread = max(1, min(10_000, work.count()))
    return work.repartition(spread).mapInArrow(_reader(store(manifest.sparkSession, folder), payloads), "key string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary")


def round_trip(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Write ``pages`` and read their records back: key, payload_bytes, payload_digest, record_type, refers_to."""
    folder = work_folder(pages.sparkSession, "archives")
    kind = pages.schema[key].dataType
    records = read(write(pages, key, folder=folder), folder, payloads=False)
    return records.select(F.col("key").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def oracle(least: int = 100) -> str:
    """The round trip's result in DuckDB's SQL."""
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {least} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {least} AND page_id > first THEN first END AS refers_to
FROM f
"""
