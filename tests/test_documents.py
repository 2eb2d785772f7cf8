from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from docframe.operators import assemble, ordered, prompts
from docframe.plans import corpora

SCHEMA = "doc_id long, source_file string, page_number int, page_md string"


def files(df):
    """Concatenate the parts of each document."""
    out = {}
    for r in df.orderBy("doc_id", "part_no").collect():
        out[r.doc_id] = out.get(r.doc_id, "") + r.md
    return out


def make(spark, *documents):
    rows = [
        (d, f"file{d}.pdf", p, page)
        for d, pages in enumerate(documents)
        for p, page in enumerate(pages, 1)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_assemble_fills_front_matter(spark):
    df = make(
        spark,
        ["---\ntitolo: T\ncomune:\n---\n\n\n# T\n\nbody", "---\nstray: 1\n---\nsecond", "  "],
        ["no front matter, 2021 and 2022", "2022, L.R. 12/2019"],
        ["", " "],
        ["---\nanno: '2015'\ntitolo: \"a: b\"\n---\n# x"],
    )
    got = files(assemble.assemble_documents(df))
    assert got[0] == "---\nanno: UNKNOWN\ncomune: null\ntipo: UNKNOWN\ntitolo: T\n---\n\n# T\n\nbody\n\nsecond\n"
    assert got[1] == (
        "---\nanno: 2022\ncomune: UNKNOWN\ntipo: UNKNOWN\ntitolo: file1\n---\n\n"
        "# file1\n\nno front matter, 2021 and 2022\n\n2022, L.R. 12/2019\n"
    )
    assert got[2] == "---\nanno: UNKNOWN\ncomune: UNKNOWN\ntipo: UNKNOWN\ntitolo: file2\n---\n\n# file2\n\n\n"
    assert "titolo: 'a: b'" in got[3] and "anno: 2015" in got[3]


def test_year_ties_go_to_the_first_seen(spark):
    df = make(spark, ["2025 2011", "2011 2025"], ["2011 2025 2025"])
    got = {r.doc_id: r.anno for r in assemble.document_metadata(df).collect()}
    assert got == {0: "2025", 1: "2025"}


def test_validation_warnings_and_repair(spark):
    df = make(spark, ["---\ntitolo: T\ncomune:\ntipo: NTA\nanno: 2020\n---\n# T", "### A", "#### B\n\n# C\n#### D"])
    got = [r.warning for r in assemble.validation_warnings(df).orderBy("warning_no").collect()]
    assert got == [
        "Missing required front matter field: 'comune'",
        "Line 3: heading level skips from 1 to 3 — '### A'",
        "Line 8: heading level skips from 1 to 4 — '#### D'",
    ]
    assert files(assemble.md_documents(df))[0].endswith(
        "# T\n\n## (continued)\n### A\n\n#### B\n\n# C\n#### D\n"
    )


@pytest.mark.parametrize("per_part", [1, 2, 3])
def test_parts_give_the_same_documents(spark, per_part):
    """Cutting documents into parts changes neither their text nor their warnings."""
    df = assemble.clean_fragments(corpora.fragments(spark, "/root/testdata/sf0.001"))
    for fn in (assemble.assemble_documents, assemble.md_documents):
        assert files(fn(df, per_part)) == files(fn(df))
    warnings = lambda n: sorted(
        (r.doc_id, r.warning_no, r.warning) for r in assemble.validation_warnings(df, n).collect()
    )
    assert warnings(per_part) == warnings(1000)


def test_full_text_parts(spark):
    pages = corpora.page_texts(spark, "/root/testdata/sf0.001")
    joined = lambda n: files(
        assemble.full_text(pages, n).withColumnRenamed("text", "md")
    )
    assert joined(2) == joined(1000)


def test_documents_without_text(spark):
    pages = spark.createDataFrame([(1, 1, " \n"), (1, 2, " "), (2, 1, "a")], "doc_id int, page_number int, text string")
    assert [r.doc_id for r in assemble.documents_without_text(pages).collect()] == [1]


# ------------------------------------------------------------ skewed keys

def test_running_totals_across_blocks(spark):
    rows = [(1, p, p % 7) for p in range(1, 400)] + [(2, 5, 3)]
    df = spark.createDataFrame(rows, "k int, pos int, n int")
    got = {(r.k, r.pos): r.n_before for r in ordered.running_totals(df, ["k"], "pos", ["n"], block=16).collect()}
    total = 0
    for k, pos, n in rows[:-1]:
        assert got[k, pos] == total
        total += n
    assert got[2, 5] == 0


def test_rows_are_numbered_across_blocks(spark):
    rows = [(1, i % 13, i % 5) for i in range(300)] + [(2, 4, 4), (2, 4, 4), (3, 1, 0)]
    df = spark.createDataFrame(rows, "k int, a int, b int").repartition(7)
    got = sorted(tuple(r) for r in ordered.number_rows(df, ["k"], {"a": df.a}, ["a", "b"]).collect())
    want = sorted((k, *rest, n) for k in (1, 2, 3) for n, (_, *rest) in enumerate(sorted(r for r in rows if r[0] == k), 1))
    assert sorted((k, a, b, n) for k, a, b, n in got) == sorted(want)


def test_front_matter_may_be_folded(spark):
    block = "titolo: piano delle regole e del piano\n  dei servizi: parte\ntags:\n  - a: b\ncomune: 'X'"
    df = spark.createDataFrame([(block,)], "b string").select(assemble.front_matter_entries(F.col("b")).alias("e"))
    got = {e.key: e.value for e in df.first().e}
    assert got["titolo"] == "piano delle regole e del piano dei servizi: parte" and got["comune"] == "X"


def test_document_text_is_whole(spark):
    pages = spark.createDataFrame([(1, p, f"p{p} " * 2000) for p in range(1, 8)] + [(1, 9, " ")], "doc_id int, page_number int, text string")
    rows = [[str(i), "x"] for i in range(80)]
    tables = spark.createDataFrame([(1, 3, 1, ["n", "v"], rows)], "doc_id int, page_number int, table_idx int, columns array<string>, rows array<array<string>>")
    text = prompts.document_text(pages, tables).first().text
    assert all(f"p{p} " * 2000 in text for p in range(1, 8)) and text.count("\n| ") == 82 and len(text) > 40_000
    asked = prompts.requests(prompts.document_text(pages, tables), 1000).orderBy("request_no").collect()
    assert "".join(r.text for r in asked) == text
    parts = prompts.document_text(pages, tables, 2)
    assert sorted(r.part_no for r in parts.collect()) == [0, 1, 2, 3]
    for cut in (1, 7, 12_500, 10**6):
        got = "\n\n".join(r.text for r in prompts.cut_text(parts, cut).orderBy("part_no").collect())
        whole = "\n\n".join(r.text for r in parts.orderBy("part_no").collect())
        assert whole.startswith(got) and len(got) >= min(cut, len(whole)) - 4
