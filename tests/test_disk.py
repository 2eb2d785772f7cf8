"""What keeps bytes on disk from growing faster than they have to: rows that lie together are not shuffled again."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docframe.operators import batch, prompts
from docframe.operators import tables as tb
from docframe.plans import corpora, invoices
from docframe.session import written
from docframe.sources.files import unique_files, write_files
from tests.test_growth import plan

TABLE = "| a | b |\n|---|---|\n| 1 | 2 |\n| 3 | {} |"
# documents of 5, 3 and 1 pages: some with two tables, some blank, one with a gap between its pages
PAGES = [(1, p, f"k: {p}\n\n" + "\n\n".join(TABLE.format(t) for t in range(p % 3))) for p in range(1, 5)] + [(1, 9, " \n")] + [
    (2, 1, TABLE.format("x")), (2, 2, None), (2, 3000, TABLE.format("y")), (3, 1, " ")]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(d, f"{d}.pdf", p, md) for d, p, md in PAGES]
    return written(spark.createDataFrame(rows, "doc_id long, source_file string, page_number int, md string"), "pages", ["doc_id"])


def numbered(pages, together):
    return tb.numbered_tables(tb.detect_header(tb.import_markdown_tables(pages, keep=("source_file",)), stripped=True), 2, together)


def texts(pages):
    return pages.select("doc_id", "page_number", F.col("md").alias("text"))


def same(found, want):
    assert found.columns == want.columns and sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_buckets_leave_no_table_behind(spark, pages):
    before = {t.name for t in spark.catalog.listTables("default")}
    found = written(pages.select("doc_id", "page_number"), "some", ["doc_id"])
    assert {t.name for t in spark.catalog.listTables("default")} == before
    assert found.count() == len(PAGES) and "Exchange" not in plan(found.groupBy("doc_id").agg(F.max("page_number")))


def test_tables_that_lie_together_are_numbered_in_place(pages):
    found = numbered(pages, True)
    same(found, numbered(pages, False))
    assert "Exchange" not in plan(found)
    assert sorted((r.doc_id, r.table_idx, r.page_number) for r in found.collect()) == [(1, 1, 1), (1, 2, 2), (1, 3, 2), (1, 4, 4), (2, 1, 1), (2, 2, 3000)]


@pytest.mark.parametrize("per_part", [1, 2, 1000])
def test_text_that_lies_together_is_not_shuffled(pages, per_part):
    found = prompts.document_text(texts(pages), numbered(pages, True), per_part, together=True)
    same(found, prompts.document_text(texts(pages), numbered(pages, False), per_part))
    asked = prompts.requests(found, 7)
    assert "Exchange" not in plan(asked)
    cut = prompts.cut_text(found, 60, together=True)
    same(cut, prompts.cut_text(found, 60))
    assert "Exchange" not in plan(cut)


@pytest.mark.parametrize("per_part", [1, 1000])
def test_artifacts_of_pages_that_lie_together_meet_documents_in_place(spark, pages, per_part):
    documents = spark.createDataFrame([(1, "1.pdf", 5), (2, "2.pdf", 3), (3, "3.pdf", 1)], "doc_id long, source_file string, page_count int")
    found = batch.document_artifacts(documents, texts(pages), numbered(pages, True), per_part, together=True)
    same(found, batch.document_artifacts(documents, texts(pages), numbered(pages, False), per_part))
    assert plan(found.hint("merge")).count("Exchange hashpartitioning") <= 1  # the slim documents


def test_sheets_of_pages_that_lie_together_are_not_shuffled(pages):
    """The values of the rows are compared without those of the tables left out, as the query does."""
    books = {kept: invoices._sheets(pages, kept) for kept in (True, False)}
    same(books[True], books[False])
    assert "Exchange hashpartitioning" not in plan(books[True]) and {r.sheet for r in books[True].collect()} >= {"Summary", "Table_002"}


def test_names_in_question_meet_contents_in_place(spark, tmp_path):
    rows = [(k, f"f{k % 9}.csv" if k < 11 else f"g{k}.csv", f"{k}\n") for k in range(40)]
    found = unique_files(spark.createDataFrame(rows, "doc_id long, file string, content string"))
    assert "SortMergeJoin" not in plan(found) and "Exchange hashpartitioning" not in plan(found)
    assert write_files(found, str(tmp_path / "out")).count() == 40
    assert {r.content for r in found.filter("file RLIKE '^f[01]-'").collect()} == {"0\n", "1\n", "9\n", "10\n"}


def test_orders_of_any_size_are_in_one_set(spark, tmp_path):
    at, day = str(tmp_path), datetime(2020, 1, 1)
    spark.createDataFrame([(p, f"part {p}", 1.0) for p in range(9)], "p_partkey long, p_name string, p_retailprice double").write.parquet(f"{at}/part.parquet")
    lines = [(o, p, 1, 1 + p, float(p), 2.0, 0.0, 0.0, "N", "O", day) for o, n in ((1, 3), (2, 7), (3, 8), (5, 2)) for p in range(n)]
    spark.createDataFrame(
        [*lines, (None, *lines[0][1:])],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(1, "a", 1)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{at}/nation.parquet")
    spark.createDataFrame([(o, 1, "O", 9.0, day, "1-URGENT") for o in (1, 2, 3, 3)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    want = sorted(map(str, corpora.invoice_pages(spark, at).collect()))
    for most, sets in ((0, [True, False]), (7, [True, False]), (4096, [True])):
        found = corpora.pages_by_size(spark, at, most)
        assert [kept for _, kept in found] == sets
        assert sorted(str(r) for pages, _ in found for r in pages.collect()) == want
    results = {}
    for most in (7, 4096):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(invoices, "pages_by_size", lambda s, d, most=most: corpora.pages_by_size(s, d, most))
            names = ("document_text", "document_text_cut", "document_artifacts", "document_workbook", "table_csv_files", "table_csv_rows")
            results[most] = [sorted(map(str, invoices.QUERIES[n](spark, at).collect())) for n in names]
    assert results[7] == results[4096] and all(results[7])
