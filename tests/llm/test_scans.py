"""Scans of single documents against brute force: quality counts, benchmark windows, licenses, secrets."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest

from docframe.llm import decontamination, license_scan, quality_rules, queries, secret_scan

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return FOLD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_quality(text):
    text = text or ""
    words = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def counts(df):
    return sorted(((r["doc_id"], *(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))) for r in df.collect()), key=str)


def test_quality_counts_equal_brute_force(spark, sf, texts, awkward):
    got = counts(quality_rules.judge(spark.read.parquet(f"{sf}/documents.parquet")))
    assert got == sorted(((d, *brute_quality(t)) for d, t in texts.items()), key=str)
    got = counts(quality_rules.judge(awkward))
    assert got == sorted(((r["doc_id"], *brute_quality(r["text"])) for r in awkward.collect()), key=str)


def test_base_failures_are_never_kept(awkward, empty):
    rows = quality_rules.judge(awkward).collect()
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.judge(empty).count() == 0
    kept = quality_rules.keep(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r["kept"] for r in rows)


def test_concentration_finds_the_bulk_despite_outliers():
    rng = np.random.default_rng(2)
    bulk = rng.normal(0, 1, (800, 5)) @ np.diag([2, 1, 1, 1, 1])
    off = rng.normal(30, 1, (150, 5))
    mean, scatter = quality_rules.concentrated(np.vstack([bulk, off]), 1)
    assert np.abs(mean).max() < 0.5 and 1 < scatter[0, 0] < 8
    inverse = np.linalg.inv(scatter)
    far = np.einsum("ni,ij,nj->n", off - mean, inverse, off - mean)
    near = np.einsum("ni,ij,nj->n", bulk - mean, inverse, bulk - mean)
    assert far.min() > quality_rules.quantile(1 - 1e-9) > near.max()
    assert np.allclose(quality_rules.concentrated(np.ones((60, 5)), 1)[0], 1)


def test_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "very", "longer", "and"]
    rows = [(k, " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(int(rng.lognormvariate(5, 0.8)) + 25)), "en", "s") for k in range(400)]
    rows += [(1000 + k, " ".join(rng.choice(words) + "$#*%"[: rng.randrange(5)] * 3 for _ in range(200)), "en", "s") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    gone = {r["doc_id"] for r in quality_rules.judge(df).filter("not kept").collect()}
    assert gone == set(range(1000, 1020))


@pytest.mark.parametrize("share", [0.2, 0.3, 0.4, 0.45])
@pytest.mark.parametrize("n", [60, 400, 2000])
def test_outliers_of_up_to_nearly_half_do_not_mask_themselves(share, n):
    rng = np.random.default_rng(int(100 * share) + n)
    bulk = rng.normal([5.5, 1.6, 0, 0, 0], [0.8, 0.05, 0, 0, 0], (n - int(share * n), 5))
    off = rng.normal([5.5, 2.08, 0.6, 0, 0], [0.8, 0.02, 0.01, 0, 0], (int(share * n), 5))
    mean, scatter = quality_rules.concentrated(np.vstack([bulk, off]), 1)
    inverse = np.linalg.inv(scatter)
    assert np.einsum("ni,ij,nj->n", off - mean, inverse, off - mean).min() > quality_rules.quantile(1 - 1e-9)
    assert np.einsum("ni,ij,nj->n", bulk - mean, inverse, bulk - mean).max() < quality_rules.quantile(1 - 1e-9)


def judged_sources(spark, sources):
    """Rejected numbers of documents: per (lang, source) how many are normal and how many are junk, these from 1000 on."""
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "very", "longer", "and"]
    rows = []
    for lang, source, clean, junk in sources:
        name = lang + source
        rows += [(f"{name}{k}", " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(rng.randrange(60, 300))), lang, source) for k in range(clean)]
        rows += [(f"{name}{1000 + k}", " ".join(rng.choice(words) + str(rng.randrange(99)) + "#$%*" for _ in range(200)), lang, source) for k in range(junk)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    return {r["doc_id"] for r in quality_rules.judge(df).filter("not kept").collect()}


def test_a_hot_source_with_much_junk_and_small_ones_beside_it(spark):
    gone = judged_sources(spark, [("en", "hot", 220, 180), ("en", "small", 20, 5), ("fr", "few", 10, 3)])
    assert gone == {f"enhot{1000 + k}" for k in range(180)} | {f"ensmall{1000 + k}" for k in range(5)} | {f"frfew{1000 + k}" for k in range(3)}
    assert judged_sources(spark, [("en", "only", 20, 5)]) == set()


def odd_text(kind, rng):
    """A hundred words in twenty lines, odd in one statistic."""
    words = [f"w{rng.randrange(10**5):05d}" for _ in range(1000 if kind == "words" else 100)]
    if kind == "length":
        words = [w + "a" * 6 for w in words]
    elif kind == "symbols":
        words = ["#" + w[1:] for w in words]
    elif kind == "repeated words":
        words[:24] = words[:12] * 2
    lines = [" ".join(words[k : k + 5]) for k in range(0, len(words), 5)]
    if kind == "repeated lines":
        lines[::2] = lines[:1] * 10
    return " ".join(words) if kind == "repeated words" else "\n".join(lines)


def test_each_statistic_can_reject_alone(spark):
    rng = random.Random(9)
    kinds = ["words", "length", "symbols", "repeated lines", "repeated words"]
    rows = [(str(k), odd_text("", rng), "en", "s") for k in range(100)] + [(kind, odd_text(kind, rng), "en", "s") for kind in kinds]
    found = quality_rules.judge(spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")).collect()
    assert not any(r["base_failed"] for r in found)
    assert {r["doc_id"] for r in found if not r["kept"]} == set(kinds)


def brute_windows(docs, items):
    """(doc_id, words, words hit, items found) with every window of every item sought everywhere."""
    windows = {}
    for item, text in items:
        words = folded(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = folded(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                which = windows.get(tuple(words[i : i + n]))
                if which:
                    hit |= set(range(i, i + n))
                    found |= which
        out.append((doc, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


def inspected(docs, benchmark, **how):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontamination.inspect(docs, benchmark, **how).collect()), key=str)


@pytest.mark.parametrize("most", [1 << 20, 700])
def test_benchmark_windows_equal_brute_force(spark, most):
    rng = random.Random(8)
    items = [(f"i{k}", " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 40)))) for k in range(12)] + [("short", "Zz, yy"), ("i1", "again another text of the same item")]
    docs = []
    for k in range(80):
        text = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            words = rng.choice(items)[1].split()
            a = rng.randint(0, len(words))
            text[len(text) // 2 : len(text) // 2] = words[a : a + rng.randint(5, 25)]
        docs.append((k % 70, " ".join(text)))
    frame = spark.createDataFrame([*docs, (99, None), (None, "zz yy")], "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, ("null", None)], "item_id string, text string")
    assert inspected(frame, benchmark, most_bytes=most) == brute_windows([*docs, (99, None), (None, "zz yy")], items)


def test_benchmark_on_the_table(spark, sf, texts, awkward, empty):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(str(r["item_id"]), r["text"]) for r in benchmark.collect()]
    expected = brute_windows(sorted(texts.items()), items)
    assert inspected(spark.read.parquet(f"{sf}/documents.parquet"), benchmark) == expected
    got = sorted(map(tuple, queries.op8_benchmark_decontamination(spark, sf).collect()))
    assert got == sorted((d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in expected)
    nothing = spark.createDataFrame([], "item_id string, text string")
    assert all(not r["n_hit"] for r in decontamination.inspect(awkward, nothing).collect())
    assert decontamination.inspect(empty, benchmark).count() == 0
    kept = decontamination.clean(awkward, benchmark)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_every_long_shared_span_shares_a_fingerprint():
    rng = np.random.default_rng(3)
    for _ in range(300):
        grams = rng.integers(0, 4, 6).astype(np.uint64)  # many equal ones
        around = np.concatenate([rng.integers(0, 4, 7).astype(np.uint64), grams, rng.integers(0, 4, 9).astype(np.uint64)])
        there = set(around[decontamination.winnowed(around)].tolist())
        assert set(grams[decontamination.winnowed(grams)].tolist()) <= there


def brute_license(text):
    words = folded(text)
    places, base, labels, score = [], set(), set(), 0.0
    for phrase, label in license_scan.PHRASES:
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    for line in (text or "").split("\n"):
        block = set(folded(line))
        for label, template in license_scan.TEMPLATES:
            whole = set(template.split())
            if len(whole & block) >= math.ceil(license_scan.THRESHOLD * len(whole) - 1e-9):
                labels.add(label)
                score = max(score, len(whole & block) / len(whole))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else score)


def scanned(df):
    return sorted((tuple(r) for r in license_scan.scan(df).collect()), key=str)


def test_licenses_equal_brute_force(spark, sf, texts, awkward, empty):
    rng = random.Random(6)
    rows = [(1, "CC-BY cc by, CC  by\nAll rights\nreserved; all RIGHTS reserved"), (2, None), (3, ""), (4, "general public general public license")]
    for k in range(40):
        words = rng.choice(license_scan.TEMPLATES)[1].split()
        rng.shuffle(words)
        rows.append((10 + k, "some words\n" + " ".join(words[: rng.randint(len(words) // 2, len(words))] + ["more"] * rng.randrange(3)) + "\nend"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert scanned(df) == sorted(((d, *brute_license(t)) for d, t in rows), key=str)
    assert scanned(spark.read.parquet(f"{sf}/documents.parquet")) == sorted(((d, *brute_license(t)) for d, t in texts.items()), key=str)
    assert scanned(awkward) == sorted(((r["doc_id"], *brute_license(r["text"])) for r in awkward.collect()), key=str)
    assert license_scan.scan(empty).count() == 0
    assert license_scan.scan(df, templates=(), phrases=()).filter("labels != '' or score != 0").count() == 0


def test_wrapped_notices_are_found(spark):
    notices = [
        ("apache", 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.'),
        ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files"),
        ("bsd", "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:"),
        ("mpl", "This Source Code Form\nis subject to the terms\nof the Mozilla\nPublic License, v. 2.0."),
    ]
    rows = [(k, "one line before\n" + t + "\nand one behind", label) for k, (label, t) in enumerate(notices)]
    far = "\n".join(w + " other" * 40 for w in license_scan.TEMPLATES[0][1].split())
    rows += [(100, "\n".join("word" + str(k) for k in range(3000)) + "\n" + notices[1][1].replace(" ", "\n"), "mit"), (101, far, ""), (102, notices[0][1].split("\n")[0], "")]
    found = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for d, t, label in rows:
        assert brute_license(t)[-2:] == ("", 0.0)
        assert (found[d]["labels"], found[d]["score"]) == (label, 1.0 if label else 0.0)
        assert found[d]["n_words"] == len(folded(t))


def secret_documents(seed=1, n=400):
    rng = random.Random(seed)
    hexes = "0123456789abcdef"
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def run(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    rows = []
    for k in range(n):
        words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.choice([3, 5, 8, 18, 22]))) for _ in range(40)]
        kind = k % 5
        if kind == 0:
            words[20:20] = [f"Password = {run(mixed, 24)}"]
        elif kind == 1:
            words[20:20] = ["AKIA" + run("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)]
        elif kind == 2:
            words[20:20] = [run(hexes, 40)]
        elif kind == 3:
            words[20:20] = [f"build-{rng.randrange(10)}-report-of-the-day-{rng.randrange(10)}"]
        rows.append((k, " ".join(words)))
    return rows


def brute_secrets(text):
    """Base spans with the patterns as the contract words them."""
    patterns = [("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]
    found = [(m.start(), k, name, m.end()) for k, (name, p, g, least) in enumerate(patterns) for m in re.finditer(p, text or "") if len(m.group(g)) >= least]
    return [(name, a, b) for a, _, name, b in sorted(found)]


def test_base_secrets_equal_the_patterns(spark, sf, texts, awkward, empty):
    tricky = ["PASSWORD:'ab'  token=abcdef", "Api_Key == x", "tokenſ=abcdefgh", "AKIA" + "A" * 15 + " AKIA" + "B" * 16, "a" * 23 + " " + "f" * 24, "secret = \"a.b/c=d-e\"; apikey:123456", "password=password=abcdef1", None, ""]
    for t in tricky:
        assert secret_scan.base_spans(t or "") == brute_secrets(t)
    got = {r["doc_id"]: r for r in queries.op3_secret_scans(spark, sf).collect()}
    for d, t in texts.items():
        base = brute_secrets(t)
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = got[d]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(digest.encode()).hexdigest()
        assert set(filter(None, digest.split(","))) <= set(filter(None, r["spans"].split(",")))
    assert secret_scan.scan(awkward).count() == awkward.count()
    assert secret_scan.scan(empty).count() == 0


def test_the_network_learns_and_keeps_its_recall():
    seen = [(c[2], c[3]) for _, t in secret_documents(1, 800) for c in secret_scan.candidates(t, secret_scan.base_spans(t))]
    network = secret_scan.train(seen, recall=0.95)
    fresh = [(c[2], c[3]) for _, t in secret_documents(2, 400) for c in secret_scan.candidates(t, secret_scan.base_spans(t))]
    p = network.probability([c for c, _ in fresh])
    y = np.array([s for _, s in fresh])
    assert (p[y] >= network.threshold).mean() >= 0.9
    assert (p[~y] >= network.threshold).mean() <= 0.05
    assert secret_scan.train([]).threshold > 1 and secret_scan.train(seen[:3]).threshold > 1


def test_few_secrets_among_many_others_keep_their_recall():
    rng = np.random.default_rng(5)
    z = np.concatenate([rng.normal(1, 1, 100), rng.normal(-1, 1, 3000)])
    y = np.repeat([1.0, 0.0], [100, 3000])
    network = secret_scan.Network()
    network.calibrate(z, y, 0.95)
    p = 1 / (1 + np.exp(-(network.scale * z + network.offset)))
    found = p >= network.threshold
    assert found[y > 0].mean() >= 0.95 and network.threshold < 0.5
    assert network.precision == found[y > 0].sum() / found.sum()


def test_runs_without_a_digit_are_scored():
    text = "the key QwErTyUiOpAsDfGhJkLzXcVb here, 1234567890123456 there"
    assert [c[:2] for c in secret_scan.candidates(text, []) if c[4]] == [(8, 32)]


def test_the_network_adds_spans_and_keeps_base_ones(spark):
    rows = secret_documents(3, 600) + [(9000, "see ghs" + "X9fK2mQ7vB4tR8wZ1cL6" * 2 + " there"), (9001, "x" * 5000 + " 1" + "ab" * 300)]
    found = {r["doc_id"]: r for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows:
        base = [(s["kind"], s["start"], s["end"]) for s in found[d]["base"]]
        every = [(s["kind"], s["start"], s["end"]) for s in found[d]["spans"]]
        assert base == brute_secrets(t) and [s for s in every if s[0] != "model"] == base
    assert [s["kind"] for s in found[9000]["spans"]] == ["model"]
