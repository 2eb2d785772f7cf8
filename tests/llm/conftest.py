from __future__ import annotations

import random

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the smallest documents table."""
    return {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and very long texts, ties and repeated rows, and columns with clashing names."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(40)] + ["the", "of", "é", "日本", "x-y", "A1"]
    long = " ".join(rng.choice(vocabulary) for _ in range(30_000))
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, " \n\t ", None, "a"),
        (4, long, "en", "a"),
        (5, long, "en", "a"),
        (6, shared + "\n" + long[:500], "en", "a"),
        (6, shared + "\n" + long[:500], "en", "a"),
        (7, shared, "en", "a"),
        (7, "another text under the same number", "en", "a"),
        (None, shared, "en", "a"),
        (8, "one", "en", "a"),
        (9, "one", "en", "a"),
    ] + [(10 + k, f"{shared} word{k % 3}\nline {k} of many recurring ones\nend", "de", "b") for k in range(15)]
    clash = [(*r, "n", 1, 2, 3) for r in rows]
    return spark.createDataFrame(clash, "doc_id long, text string, lang string, source string, n_words string, sig int, text_key int, component_id int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
