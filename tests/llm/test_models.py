"""URL filters, archives, packing and the pipeline."""

from __future__ import annotations

import io
import random
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docframe.llm import packing, queries, url_filters, warc


def brute_location(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:k])
    path = rest[k:].split("#")[0].split("?")[0]
    return host, path


def brute_rule(host, path):
    fits = []
    for verdict, rule in url_filters.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG", "http://example.org?x=/es/", "https://m.Example.org/es/1#a", "http://example.org/en/12?b", "http://xexample.org/en/12", "ftp://u.com/fr/é", "x://com/de/://y", "http://org/", "http://a.b/c?d#e", "http://É.com/fr/"]


def test_urls_and_rules_equal_brute_force(spark, sf):
    df = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate([*URLS, URLS[4]])], "page_id long, url string, host string, verdict string")
    for r in url_filters.judge(df).collect():
        host, path = brute_location(r["url"])
        assert (r["host"], r["path"]) == (host, path), r["url"]
        rule, verdict = brute_rule(host, path)
        assert r["rule"] == rule and r["verdict"] in ("allow", "block")
        assert verdict is None or r["verdict"] == verdict
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op1_url_filters(spark, sf).collect():
        host, path = brute_location(pages[r["page_id"]])
        rule, verdict = brute_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict
    assert url_filters.judge(df.limit(0)).count() == 0


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(1)

    def url(bad):
        path = "/".join("".join(rng.choice("abcdef") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(1, 3)))
        tail = "?" + "&".join(f"k{i}={rng.randrange(10**8)}" for i in range(rng.randint(3, 6))) if bad else ""
        return f"http://h{rng.randrange(50)}.example.{rng.choice(['net', 'info'])}/{path}{tail}"

    rows = [(url(k % 2), k % 2) for k in range(1200)]
    fresh = [(k, url(k % 2)) for k in range(400)]
    labelled = spark.createDataFrame([*rows, (None, None), ("http://a.net/x", None)], "url string, blocked int")
    got = url_filters.judge(spark.createDataFrame(fresh, "page_id long, url string"), rules=(), labelled=labelled)
    right = sum((r["verdict"] == "block") == bool(r["page_id"] % 2) for r in got.collect())
    assert right >= 390
    figures = url_filters.held_out(labelled.filter("blocked is not null"))
    assert figures["precision"] > 0.95 and figures["recall"] > 0.95 and figures["urls"] > 200
    # One labelled URL that fills the table is one URL, and labels that disagree make a share.
    hot = labelled.union(spark.range(20_000).selectExpr("'http://hot.example.net/a/b'", "0")).union(spark.createDataFrame([("http://hot.example.net/a/b", 1)] * 5, "url string, blocked int"))
    got = url_filters.judge(spark.createDataFrame(fresh, "page_id long, url string"), rules=(), labelled=hot, most=500)
    assert sum((r["verdict"] == "block") == bool(r["page_id"] % 2) for r in got.collect()) >= 380
    again = url_filters.distinct(hot.filter("url like '%hot%'")).collect()
    assert len(again) == 1 and again[0]["blocked"] == 5 / 20_005


def test_a_label_is_no_part_of_its_own_share(spark):
    rows = [(f"http://a.s{k}/x", k % 2) for k in range(50)]
    x, y, _ = url_filters.sampled(url_filters.distinct(spark.createDataFrame(rows, "url string, blocked int")), 50)
    buckets = [url_filters.bucket(f"a.s{k}") for k in range(50)]
    alone = sum(buckets.count(b) == 1 for b in buckets)
    assert len(y) == 50 and alone > 30 and (np.abs(x[:, -1] - 0.5) < 1e-9).sum() >= alone


def test_trees_without_two_kinds_give_the_only_one():
    x = np.ones((5, 3))
    assert url_filters.Trees().fit(x, np.ones(5)).probability(x).min() > 0.9
    assert url_filters.Trees().fit(np.empty((0, 3)), np.empty(0)).probability(x).max() < 0.1


def test_archives_come_back(spark, sf):
    big = "é" * 80
    rows = [(5, "http://a/", big), (3, None, big), (9, "http://b/\r\nX: y", big), (7, "u", "short"), (8, "u", "short"), (1, "v", None), (2, "v", ""), (None, "w", big), (3, None, big), (4, "", "x\r\n\r\n" * 50)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    got = sorted(map(tuple, warc.round_trip(df).collect()), key=str)
    import hashlib

    expected = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = 3 if html == big else page
        revisit = html == big and page != 3
        expected.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(expected, key=str)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_archives_hold_payloads_and_urls(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    manifest = warc.write(pages, folder=str(tmp_path / "a"))
    back = {int(r["key"]): r for r in warc.read(manifest, str(tmp_path / "a")).collect()}
    for r in pages.collect():
        b = back[r["page_id"]]
        assert b["url"] == r["url"]
        assert b["record_type"] == "revisit" or b["payload"].decode() == r["html"]


class Wide(io.BytesIO):
    """A stream that claims to lie beyond 4 GB, so that the writer must use ZIP64."""

    shift = 5 << 30

    def tell(self):
        return super().tell() + self.shift

    def seek(self, at, whence=0):
        return super().seek(at - self.shift if whence == 0 else at, whence) + self.shift


@pytest.mark.parametrize("comment", [b"", b"a comment of some length"])
def test_zip_members_are_found(comment):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"first")
        with z.open(warc.DATA, "w", force_zip64=True) as f:
            f.write(b"data" * 100)
        z.comment = comment
    archive = warc.Archive(raw, len(raw.getvalue()))
    assert archive.member("a") == b"first" and archive.member(warc.DATA) == b"data" * 100


def test_zip64_directories_are_read():
    """A directory whose short fields are all full, as files beyond 4 GB have it."""
    data, name = b"payload", b"big"
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, zlib.crc32(data), len(data), len(data), len(name), 0) + name + data
    extra = struct.pack("<HH3Q", 1, 24, len(data), len(data), 0)
    central = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    wide_at = len(local) + len(central)
    wide = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, wide_at, 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    whole = local + central + wide + locator + end
    assert warc.Archive(io.BytesIO(whole), len(whole)).member("big") == data
    with pytest.raises(ValueError, match="no end"):
        warc.Archive(io.BytesIO(b"nothing"), 7)


def brute_cuts(places, costs, length, smallest):
    best = {places[0]: 0}
    for j, c in zip(places[1:], costs[1:], strict=True):
        options = []
        for i in best:
            n = j - i
            if n <= length:
                exact = n & (n - 1) == 0 and n >= smallest
                options.append(best[i] + (0 if exact else length - n) + c)
        best[j] = min(options)
    return best[places[-1]]


def test_cuts_cost_least():
    rng = random.Random(2)
    for _ in range(200):
        length = rng.choice([8, 16, 32])
        places = [0]
        while places[-1] < 200:
            places.append(places[-1] + rng.randint(1, length // 2))
        costs = [rng.choice([0, 2, 24]) for _ in places]
        for smallest in (1, 4):
            chosen = packing.cuts(places, costs, length, smallest)
            assert chosen[0] == 0 and chosen[-1] == places[-1]
            total = 0
            for a, b in zip(chosen[:-1], chosen[1:], strict=True):
                n = b - a
                assert n <= length
                total += (0 if n & (n - 1) == 0 and n >= smallest else length - n) + costs[places.index(b)]
            assert total == brute_cuts(places, costs, length, smallest)


def check_pieces(rows, pieces, least_full=0.97):
    """Every id lies in one piece, sequences are gapless and little padded."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    expected = sorted((d, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])) for d, t in rows)
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    assert sum(p["length"] for p in pieces) == sum(len(i) for _, i in expected)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    held = padded = 0
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= 1024
        held += at
        padded += at if at & (at - 1) == 0 else 1024
    assert held >= least_full * padded
    return {d: i for d, i in expected}, by_doc


def test_pieces_hold_every_id_once(spark, sf, texts):
    df = spark.read.parquet(f"{sf}/documents.parquet").coalesce(1)
    rows = [(d, t) for d, t in texts.items()]
    pieces = packing.pack(df, queries.vocabulary()).collect()
    ids, by_doc = check_pieces(rows, pieces)
    for (doc, n), parts in by_doc.items():
        at, found = 0, []
        for p in sorted(parts, key=lambda p: p["start"]):
            assert p["start"] == at
            found += np.frombuffer(p["ids"], "<u4").tolist()
            at += p["length"]
        assert at == n and tuple(found) == ids[doc]
    for p in queries.op10_packing(spark, sf).collect():
        part = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4")
        assert p["ids_crc32"] == zlib.crc32(part.tobytes())


def test_pieces_of_awkward_rows(spark, awkward, empty):
    extra = [(900, "  two  spaces\n\nand lines \t tabs\n"), (901, "ends <|endoftext|> here<|endoftext|>"), (902, "naïve 日本語 text\u00a0with\u2003spaces  "), (903, "x" * 5000), (904, "don't we'll  I'm 123abc !!?")]
    df = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string")).filter(F.col("doc_id").isNotNull()).coalesce(1)
    rows = [(r[0], r[1]) for r in df.collect()]
    check_pieces(rows, packing.pack(df, queries.vocabulary()).collect())
    assert packing.pack(empty, queries.vocabulary()).count() == 0
    assert packing.pack(awkward, queries.vocabulary()).filter("doc_id is null").count() >= 1


def test_ids_equal_those_of_whole_texts(texts):
    encoder = packing.Encoder(queries.vocabulary())
    odd = ["", " ", "\n", " \n ", "a\n", "\n\na", "a  b", "a\t\tb ", "<|endoftext|>", "a<|endoftext|> b", "é\u0301 \u2028x", "it's  'll"]
    sample = [*odd, *list(texts.values())[:40]]
    whole = [tuple(e.ids) for e in encoder.tokenizer.encode_batch(sample, add_special_tokens=False)]
    assert [tuple(i.tolist()) for i in encoder.ids(sample)] == whole
