"""Runs of words, binary records and conversations against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from docframe.llm import binary_records, conversation_repair, periodic_runs, queries

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


# Periodic runs


def brute_runs(words, least=6):
    """(start, length, period) of all runs, by comparing the words at every distance."""
    n, found = len(words), {}
    for period in range(1, n // 4 + 1):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            if length >= max(least, 4 * period):
                found.setdefault((start, length), period)
            i += 1
    return sorted((a, n, p) for (a, n), p in found.items())


def periodic(rng, n, letters):
    out = []
    while len(out) < n:
        unit = [rng.choice(letters) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33]))]
        out += (unit * rng.randint(1, 9))[: rng.randint(1, 9 * len(unit))]
        if rng.random() < 0.3:
            out += out[-rng.randint(1, len(out)) :] * rng.randint(1, 4)
    return out[:n]


@pytest.mark.parametrize("portion", [1 << 18, 1, 7, 64])
def test_runs_equal_those_of_all_distances(portion):
    rng = random.Random(portion)
    for _ in range(30):
        lists = [[w.encode() for w in periodic(rng, rng.randint(0, 160), "abcd"[: rng.randint(1, 4)])] for _ in range(8)]
        for words, runs in zip(lists, periodic_runs.caught(lists, portion=portion), strict=True):
            assert [tuple(r) for r in runs.tolist()] == brute_runs(words)


def test_hashes_that_agree_by_accident_change_nothing():
    """Of the sequence of parities of set bits, long halves have equal hashes but different words."""
    parity = [b"ab"[bin(k).count("1") & 1 :][:1] for k in range(1 << 13)]
    assert brute_runs(parity) == [] and len(periodic_runs.caught([parity])[0]) == 0


def test_long_texts_of_one_word_and_of_one_long_period():
    rng = random.Random(3)
    unit = [b"%d" % rng.randrange(10**6) for _ in range(30_011)]
    same, long = periodic_runs.caught([[b"a"] * 200_000, unit * 5], portion=1 << 14)
    assert same.tolist() == [[0, 200_000, 1]] and long.tolist() == [[0, 150_055, 30_011]]


def brute_op11(doc, text):
    words = SPACE.findall(text or "")
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    gone = {i for a, length, p in runs for i in range(a + p, a + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{a},{length},{p}\n" for a, length, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_periodic_runs_on_the_table(spark, sf, texts):
    got = sorted(tuple(r) for r in queries.op11_periodic_runs(spark, sf).collect())
    assert got == sorted(brute_op11(d, t) for d, t in texts.items())


def test_periodic_runs_of_awkward_rows(spark, awkward, empty):
    out = periodic_runs.runs(awkward)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"] and out.count() == awkward.count()
    for row, source in zip(out.collect(), awkward.collect(), strict=True):
        words = SPACE.findall(source["text"] or "")
        assert row["doc_id"] == source["doc_id"] and row["n_words"] == len(words)
        if len(words) < 2000:
            assert [tuple(r) for r in row["runs"]] == brute_runs(words)
    assert periodic_runs.runs(empty).count() == 0
    assert queries.planted(awkward).filter("doc_id is null").count() == 1


# Binary records


def slow_checksum(raw):
    state = 0xFFFFFFFF
    for byte in raw:
        state ^= byte
        for _ in range(8):
            state = (state >> 1) ^ (0x82F63B78 if state & 1 else 0)
    state ^= 0xFFFFFFFF
    return (((state >> 15) | (state << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums_equal_those_of_single_bits():
    assert slow_checksum(b"123456789") == (((0xE3069283 >> 15) | (0xE3069283 << 17)) + 0xA282EAD8) & 0xFFFFFFFF
    rng = np.random.default_rng(1)
    payloads = [rng.bytes(4 * int(n)) for n in [1, 2, 63, 64, 65, 128, 129, *rng.integers(1, 600, 30)]]
    for p, record in zip(payloads, binary_records.framed(payloads), strict=True):
        head = struct.pack("<Q", len(p))
        assert record == head + struct.pack("<I", slow_checksum(head)) + p + struct.pack("<I", slow_checksum(p))


def test_damaged_records_are_errors():
    raw = bytearray(b"".join(binary_records.framed([b"abcd" * 9, b"wxyz"])))
    offsets = np.array([0, 52, 72])
    assert binary_records.unframed(bytes(raw), offsets) == [b"abcd" * 9, b"wxyz"]
    for at in (3, 9, 20, 50, 60):
        raw[at] ^= 4
        with pytest.raises(ValueError, match="checksum"):
            binary_records.unframed(bytes(raw), offsets)
        raw[at] ^= 4


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def encoded(text):
    ids = tokenizer().encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 2], "<u4").tobytes()


def test_binary_records_on_the_table(spark, sf, texts):
    at, want = 0, []
    for doc, text in sorted(texts.items()):
        raw = encoded(text)
        want.append((doc, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    assert sorted(tuple(r) for r in queries.op12_binary_records(spark, sf).collect()) == want


def test_binary_records_of_awkward_rows_in_small_files(spark, awkward, empty, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = binary_records.write(awkward.repartition(5), queries.vocabulary(), folder=str(tmp_path), most=2000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = manifest.collect()
    assert len(files) > 3 and sum(f["records"] for f in files) == awkward.count()
    rows = binary_records.read(manifest, str(tmp_path)).orderBy("start").collect()
    keys = [None if r["key"] is None else int(r["key"]) for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    starts = np.cumsum([0, *[len(r["ids"]) // 4 for r in rows]])
    assert [r["start"] for r in rows] == starts[:-1].tolist() and sum(f["ids"] for f in files) == starts[-1]
    want = sorted(((r["doc_id"], encoded(r["text"])) for r in awkward.collect()), key=str)
    assert sorted(zip(keys, (bytes(r["ids"]) for r in rows), strict=True), key=str) == want
    assert binary_records.round_trip(empty, queries.vocabulary()).count() == 0


def test_shuffled_reads_follow_the_seed_alone(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    manifest = binary_records.write(docs, queries.vocabulary(), folder=str(tmp_path), most=100_000)
    plain = [r["key"] for r in binary_records.read(manifest, str(tmp_path)).orderBy("start").collect()]
    one, again, other = ([r["key"] for r in binary_records.read(manifest, str(tmp_path), seed=s).collect()] for s in (1, 1, 2))
    assert one == again and one != other and one != plain and sorted(one) == sorted(other) == sorted(plain)


# Conversations


def brute_edits(kinds):
    """Cost and letters of the best edits, with all letters kept at every row."""
    best = {conversation_repair.START: (0, "")}
    legal = {(0, 1), (0, 2), (1, 2), (3, 2), (2, 3)}
    for kind in kinds:
        new = {}
        for state, (cost, letters) in best.items():
            at = state
            for inserts in range(4):
                ways = [(4, "D", at)]
                if kind != 8:
                    extra, role = 3 if kind >= 4 else 0, (1, 2, 3, None)[kind % 4]
                    ways += [(extra, "K", role)] if (at, role) in legal else []
                    ways.append((3 + extra, "R", 3 if at == 2 else 2))
                for spent, letter, to in ways:
                    way = (cost + 3 * inserts + spent, letters + "I" * inserts + letter)
                    new[to] = min(new.get(to, way), way)
                at = 3 if at == 2 else 2
        best = new
    return min((cost + 3 * (0, 2, 1, 0)[s], letters + "I" * (0, 2, 1, 0)[s]) for s, (cost, letters) in best.items())


def test_edits_equal_those_of_all_letters_at_every_scale():
    rng = random.Random(2)
    for _ in range(1500):
        kinds = bytes(rng.choice([0, 1, 1, 1, 2, 2, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randint(0, 30)))
        cost, letters = brute_edits(kinds)
        after = conversation_repair.crossings(kinds, 0, conversation_repair.CLOSING)
        end = after[-1] if kinds else 0
        assert conversation_repair.edits(kinds, 0, conversation_repair.CLOSING) + conversation_repair.closing(end) == letters
        cuts = sorted({rng.randint(0, len(kinds)) for _ in range(4)} | {0, len(kinds)})
        blocks = [kinds[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        steps = [conversation_repair.summed(b) for b in blocks]
        state, out = 0, ""
        for block, to in zip(blocks, conversation_repair.crossings(steps, 0, conversation_repair.CLOSING), strict=True):
            out, state = out + conversation_repair.edits(block, state, conversation_repair.ended(to)), to
        assert out + conversation_repair.closing(state) == letters
        whole = conversation_repair.summed([conversation_repair.summed(steps[:2]), conversation_repair.summed(steps[2:])])
        assert whole.costs[0][state] + conversation_repair.CLOSING[state] == cost


def faulty(rng, conversations, longest):
    rows = []
    for c in conversations:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["a.", "b!", "c", " ", "", None, f"t{rng.randrange(4)}.", "x?\n"])
            rows += [(c, rng.choice([turn, turn, turn, None]), role, text)] * rng.choice([1, 1, 1, 2])
    return rows


def brute_report(rows):
    """Report and repaired rows of one conversation."""
    rows = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows]
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()
    rows.sort(key=lambda r: (r[0] is not None, r[0], digest(r)))
    seen, kinds, faults = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        kind = "sua".find(role[:1]) if role[:1] else 3
        kind = 3 if kind < 0 else kind
        if not bare:
            kind, fault = 8, 0
        elif (role, text) in seen:
            kind, fault = 8, 1
        elif bare[-1] not in ".!?":
            kind, fault = kind + 4, 2
        else:
            fault = None
        seen.add((role, text))
        kinds.append(kind)
        if fault is not None:
            faults[fault] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows[:-1], rows[1:], strict=True))
    cost, letters = brute_edits(kinds)
    out, state, left = [], 0, iter(rows)
    for letter in letters:
        row = ("", "") if letter == "I" else next(left)[1:]
        if letter == "D":
            continue
        state = {"s": 1, "u": 2, "a": 3}[row[0][0]] if letter == "K" else 3 if state == 2 else 2
        out.append((row[0] if letter == "K" else ("user", "assistant")[state - 2], row[1]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *faults, illegal, cost, letters, digest), out


@pytest.mark.parametrize("sizes", [{}, {"rows_most": 3, "chars_most": 10}])
def test_conversations_with_every_fault(spark, sizes):
    rng = random.Random(4)
    rows = faulty(rng, [None, *range(60)], 14) + faulty(rng, [1000], 900)
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, piece int, block string").repartition(6)
    repaired = conversation_repair.repair(df, **sizes)
    reports = repaired.reports(df.unionByName(df.limit(1).withColumn("conv_id", F.lit(5000).cast("long")))).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r[1:])
    want = {c: brute_report(r) for c, r in by.items()}
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {r["conv_id"]: tuple(r)[1:] for r in reports} == {c: w[0] for c, w in want.items()} | {5000: none}
    turns = {}
    for r in repaired.turns().orderBy("conv_id", "piece", "block", "row").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert turns == {c: w[1] for c, w in want.items() if w[1]}


def test_conversations_spread_over_ranges(spark):
    """One conversation of many rows and one row repeated many times go over several tasks."""
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"text {rng.randrange(2000)}.") for t in range(6000)] + [(2, 5, "user", "again.")] * 5000
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        repaired = conversation_repair.repair(df, rows_most=100)
        assert repaired.states.filter("conv_id = 1").count() >= 4
        got = {r["conv_id"]: tuple(r)[1:] for r in repaired.reports(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {c: brute_report([r[1:] for r in rows if r[0] == c])[0] for c in (1, 2)}


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    repaired = conversation_repair.repair(conversation_repair.damaged(empty))
    assert repaired.reports(empty).count() == 0 and repaired.turns().count() == 0


def test_damage_by_checksum(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (0, 1, 2, 3, None) for r, x in [("user", "A? b."), (None, None)]]
    got = conversation_repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        deal = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if deal:
            row = (c, t, "user" if deal == 4 else r, "" if deal == 1 else re.sub("[.!?]", "", x) if deal == 2 else x)
            want += [row] * (2 if deal == 3 else 1)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
