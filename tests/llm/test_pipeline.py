"""The corpus pipeline, stage by stage against brute force, and its guard."""

from __future__ import annotations

import inspect
import re

import corpus_pipeline
from tests.llm.test_models import check_pieces
from tests.llm.test_pairs import brute_components, brute_lines
from tests.llm.test_scans import brute_quality, brute_windows

from docframe.llm import line_dedup, quality_rules


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_stages_equal_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows(docs)
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            check_pieces(before, after.collect(), 0.9)
            break
        assert after.columns == docs.columns
        if name == "quality_rules":
            kept = {d for d, _ in rows(after)}
            for d, t in before:
                words, *_, repeats = brute_quality(t)
                assert d not in kept or not (words < 20 or 100 * repeats > 30 * words)
            assert rows(after) == [r for r in before if r[0] in kept]
            assert kept == {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
        elif name == "line_dedup":
            assert rows(after) == brute_lines(before, line_dedup.MIN_DOCS)
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
        elif name == "ngram_jaccard_join":
            first = {(d, c) for d, _, c in brute_components(before, 5, 80) if d == c}
            assert rows(after) == [r for r in before if (r[0], r[0]) in first]
        else:
            dirty = {d for d, _, hit, _ in brute_windows(before, items) if hit}
            assert rows(after) == [r for r in before if r[0] not in dirty]
        docs = after
        assert k < 4


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_awkward_rows(spark, sf, awkward, empty, tmp_path):
    for start in (awkward, empty):
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{start.count()}-{name}")
            stage(spark, docs, sf).write.parquet(path)
            after = spark.read.parquet(path)
            assert k == 4 or after.columns == docs.columns
            docs = after


def test_each_stage_calls_its_operator():
    source = inspect.getsource(corpus_pipeline)
    for operator in ("quality_rules.keep", "line_dedup.dedup", "jaccard_join.keep_first", "decontamination.clean", "queries.packed"):
        assert operator in source
    assert not re.search(r"\btry:|\bexcept\b", source)
