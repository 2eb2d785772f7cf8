"""Joins and repeats against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest

from docframe.llm import jaccard_join, line_dedup, substring_dedup
from docframe.llm import words as W

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, gram):
    words = SPACE.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + gram]) for i in range(max(1, len(words) - gram + 1)))


def brute_components(rows, gram, percent):
    """(doc_id, size, smallest doc_id reachable) of each row, by comparing all pairs."""
    sets = [shingles(t, gram) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(k)] = min(doc, least.get(root(k), doc))
    return sorted(((doc, len(s), least.get(root(k)) if s else doc) for k, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def joined(df, **how):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df, **how).collect()), key=str)


def near_copies(rng, groups=40, words=60):
    """Texts of all sizes with copies that differ by a few words, so that many pairs lie about the threshold."""
    vocabulary = [f"w{k}" for k in range(200)]
    out = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, words))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(copy))
                kind = rng.random()
                if kind < 0.4:
                    copy[k] = rng.choice(vocabulary)
                elif kind < 0.7:
                    copy.insert(k, rng.choice(vocabulary))
                elif len(copy) > 1:
                    del copy[k]
            out.append(" ".join(copy))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize(("gram", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (1, 80, 3)])
def test_components_equal_those_of_all_pairs(spark, gram, percent, seed):
    rng = random.Random(seed)
    rows = near_copies(rng) + [(5000 + i, t) for i, t in near_copies(rng, 6, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df, gram=gram, percent=percent) == brute_components(rows, gram, percent)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for k in range(250):
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(df) == brute_components(rows, 3, 90)


def test_components_on_the_table(spark, sf, texts):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert joined(df) == brute_components(sorted(texts.items()), 3, 90)


def test_components_of_awkward_rows(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert joined(awkward) == brute_components(rows, 3, 90)
    assert jaccard_join.join(empty).count() == 0
    kept = jaccard_join.keep_first(awkward)
    assert kept.columns == awkward.columns
    assert {2, 3, 4, 8} <= {r["doc_id"] for r in kept.collect()} and 5 not in {r["doc_id"] for r in kept.collect()}


@pytest.mark.parametrize("percent", [80, 90])
def test_light_subsets_cover_exactly_the_links(percent):
    for n in range(1, 25):
        for m in range(n, 30):
            links = [o for o in range(n + 1) if 100 * o >= percent * (n + m - o)]
            if n != m or (links and links[0] < n):
                assert (m in jaccard_join.partners(n, percent)) == bool(links)
            if links:
                assert links[0] == jaccard_join.least_overlap(n, m, percent)


def brute_repeats(rows, length):
    """Rows of (doc_id, words, removed, kept text), with every window compared."""
    words = [SPACE.findall(t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words, strict=True):
        if doc is not None:
            for i in range(len(w) - length + 1):
                key = tuple(w[i : i + length])
                first[key] = min(doc, first.get(key, doc))
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = np.zeros(len(w), bool)
        if doc is not None:
            for i in range(len(w) - length + 1):
                if first[tuple(w[i : i + length])] < doc:
                    gone[i : i + length] = True
        out.append((doc, len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def repeated(df, **how):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in substring_dedup.dedup(df, **how).collect()), key=str)


@pytest.mark.parametrize(("length", "chunk", "slice_"), [(6, 3000, 200), (7, 500, 50), (10, 1 << 20, 1 << 20)])
def test_repeats_equal_those_of_all_windows(spark, length, chunk, slice_):
    rng = random.Random(length)
    passages = [[f"p{rng.randrange(30)}" for _ in range(rng.randint(length - 2, 4 * length))] for _ in range(12)]
    rows = []
    for k in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            text += rng.choice(passages) if rng.random() < 0.6 else [f"q{rng.randrange(5)}" for _ in range(rng.randint(1, 15))]
        rows.append((rng.randrange(100), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert repeated(df, length=length, chunk_bytes=chunk, slice_hashes=slice_) == brute_repeats(rows, length)


def test_repeats_on_the_table_and_awkward_rows(spark, sf, texts, awkward, empty):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert repeated(df, chunk_bytes=50_000, slice_hashes=10_000) == brute_repeats(sorted(texts.items()), 50)
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert repeated(awkward, chunk_bytes=20_000, slice_hashes=5000) == brute_repeats(rows, 50)
    assert substring_dedup.dedup(empty).count() == 0


def test_packed_hashes_come_back():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    flags = rng.integers(0, 4, len(keys)).astype(np.uint8)
    back = substring_dedup.unpacked(substring_dedup.packed(keys, flags), len(keys), np.uint8)
    assert np.array_equal(back[0], keys) and np.array_equal(back[1], flags)


def test_window_hashes_depend_on_the_words_alone():
    words = [b"a", b"b", b"c"] * 20
    hashes, _ = W.hashed([words], W.Hashes())
    for length in (1, 2, 3, 5, 8, 25, 50):
        found = W.windows(hashes, length)
        assert len(found) == 61 - length
        assert len(set(found.tolist())) == min(3, len(found))


def brute_lines(rows, min_docs, share=line_dedup.SHARE):
    """Texts after the dedup, with templates as tuples."""
    depth, segments = line_dedup.DEPTH, line_dedup.SEGMENTS
    docs = {(d, t) for d, t in rows if t is not None}
    held, of = {}, {}

    def key(doc):
        return (doc[0] is not None, doc[0] or 0)

    for doc in docs:
        for k, line in enumerate(doc[1].split("\n")):
            words = SPACE.findall(line)
            if not words:
                continue
            if any(not re.search("[0-9]", w) for w in words):
                words = ["0" if re.search("[0-9]", w) else w for w in words]
            rest = max(len(words) - depth, 0)
            edges = [depth + rest * s // segments for s in range(segments + 1)]
            runs = [tuple(words[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            path = (len(words), tuple(words[:depth]))
            forms = [(path, -1, tuple(runs))] + [(path, s, tuple(r for i, r in enumerate(runs) if i != s)) for s in range(segments) if rest - max(map(len, runs)) >= line_dedup.FIXED]
            of[doc, k] = forms
            for f in forms:
                held.setdefault(f, []).append((doc, k))
    gone = set()
    most = math.ceil(len({d for d, _ in of}) * share)
    for form, places in held.items():
        if len({d for d, _ in places}) >= (min_docs if form[1] < 0 else max(min_docs, most)):
            first = min(places, key=lambda p: (key(p[0]), p[1]))
            gone |= {p for p in places if (key(p[0]), p[1]) != (key(first[0]), first[1])}
    return sorted(((d, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if ((d, t), k) not in gone)) for d, t in rows), key=str)


def test_lines_equal_brute_force(spark, sf, texts, empty):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        lines = [f"user {rng.randrange(99)} logged in from host h{rng.randrange(9)} today", f"the page was last seen by {rng.choice(['ann', 'bob', 'eve', 'joe'])} in town", "", "same line in every text here"]
        lines += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(4)]
        rng.shuffle(lines)
        rows.append((k, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "\n\n"), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.dedup(df, min_docs=5)
    assert sorted(((r[0], r[1]) for r in out.collect()), key=str) == brute_lines(rows, 5)
    table = spark.read.parquet(f"{sf}/documents.parquet")
    out = line_dedup.dedup(table, min_docs=3)
    assert out.columns == table.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == brute_lines(sorted(texts.items()), 3)
    assert line_dedup.dedup(empty).count() == 0
    out = line_dedup.dedup(df, min_docs=5, share=1.1)
    want = brute_lines(rows, 5, 1.1)
    assert sorted(((r[0], r[1]) for r in out.collect()), key=str) == want != brute_lines(rows, 5)


def test_short_lines_that_recur_go_and_numbers_alone_stay(spark):
    rows = [(k, f"Read more\n{k}\nPage {k}\nCookies\ntext of its own {'abcdefghijklmnopqrst'[k]}") for k in range(20)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {k: t if k == 0 else "\n".join(t.split("\n")[i] for i in (1, 4)) for k, t in rows}


def test_like_lines_of_prose_stay(spark):
    towns = "Rome Paris Turin Milan Genoa Pisa Siena Lucca Parma Udine Bari Como".split()
    rows = [(k, f"He went to {a} yesterday") for k, a in enumerate(towns)]
    rows += [(100 + k, f"She took the early train to {a}" if k < 12 else f"words {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}") for k, a in enumerate(towns + [""] * 28)]
    out = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), share=0.5)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == dict(rows)


def test_a_document_of_very_many_lines_takes_linear_time(spark):
    text = "\n".join(["a line that many texts hold", *(f"own {'xyz'[k % 3]} {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}{chr(97 + k // 17576)} end" for k in range(60_000)), *["a line that many texts hold"] * 40_000])
    df = spark.createDataFrame([(k, text if k in (5, 6) else "a line that many texts hold") for k in range(12)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"].count("\n") + 1 for r in line_dedup.dedup(df).collect() if r["doc_id"] in (5, 6)}
    assert out == {5: 60_000, 6: 60_000}


def test_distinct_lines_of_four_words_stay(spark):
    rows = [(k, f"He went to {a}\nHe went to sleep\nhe was number {k} there") for k, a in enumerate("Rome bed Paris town work school church court sea war market dinner".split())]
    out = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {k: rows[0][1] if k == 0 else t.split("\n")[0] for k, t in rows}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want


def test_lines_of_awkward_rows(awkward):
    out = line_dedup.dedup(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    kept = {r["doc_id"]: r["text"] for r in out.collect() if (r["doc_id"] or 0) >= 10}
    assert kept[10].startswith(awkward.filter("doc_id = 7").first()["text"]) and "line 0 of" in kept[10]
    assert kept[10].endswith("end") and kept[11] == "" and kept[24] == ""


def test_a_removed_text_keeps_its_digest(spark):
    df = spark.createDataFrame([(1, "a  b\nc"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in substring_dedup.dedup(df).collect()}
    assert hashlib.sha256(rows[1].encode()).hexdigest() == hashlib.sha256(b"a b c").hexdigest() and rows[2] == ""
