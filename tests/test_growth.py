"""What keeps memory, tasks and calls from growing with the input."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime

from pyspark.sql import functions as F

from docframe.operators import records
from docframe.operators.batch import with_records
from docframe.operators.fields import key_value_lines, schema_guided_fields
from docframe.operators.ordered import number_rows
from docframe.operators.prompts import cut_text
from docframe.operators.tables import detect_header, import_markdown_tables
from docframe.plans import corpora
from docframe.sources.files import read_files, scan_markdown, write_files
from docframe.sources.schemas import load_schemas
from docframe.streaming.ingest import incremental_ingest
from docframe.streaming.parts import completed_documents, completed_parts

SCHEMA = "doc_id long, document_type string, fields map<string,string>, line_items array<map<string,string>>, confidence double, warnings array<string>"


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_records_meet_files_without_a_broadcast(spark):
    rows = [(k, "invoice", {"invoice_number": f"I{k}"}, [{"description": "a"}, {"amount": "1"}], 0.9, []) for k in (1, 2, 2)]
    found = spark.createDataFrame(rows, SCHEMA)
    files = spark.createDataFrame([(1, "a.pdf"), (2, "b.pdf"), (3, "c.pdf")], "doc_id long, source_file string")
    schema = load_schemas(spark)["invoice"]
    wide = records.summary_wide(found, files, schema)
    items = records.line_items_wide(found, files, schema, "invoice_number")
    assert "Broadcast" not in plan(wide) and "Broadcast" not in plan(items)
    assert sorted((r.file_name, r.invoice_number, r.review_status) for r in wide.collect()) == [("a.pdf", "I1", "ok"), ("b.pdf", "I2", "ok"), ("b.pdf", "I2", "ok")]
    assert items.count() == 6 and items.filter(F.col("file_name") == "b.pdf").count() == 4


def test_parts_are_called_for_by_the_bucket(spark, tmp_path):
    rows = [(f"d{d}", p, 3, 1.0) for d in range(200) for p in (1, 2, 3) if (d, p) != (7, 2)]
    pages = spark.createDataFrame(rows, "doc_id string, page_no int, page_count int, q double")
    pages.write.parquet(str(tmp_path / "in"))
    places = [str(tmp_path / n) for n in ("in", "out", "marks")]
    incremental_ingest(spark, places[0], pages.schema, *places[1:], lambda df: completed_parts(df, ["q"], buckets=2))
    found = completed_documents(spark.read.parquet(places[1]), ["q"]).collect()
    assert {tuple(r) for r in found} == {(f"d{d}", 3, 3.0) for d in range(200) if d != 7} and len(found) == 199
    state = spark.read.format("statestore").load(places[2])
    assert 0 < state.count() <= 2
    pages.filter("doc_id = 'd1'").union(spark.createDataFrame([("d7", 2, 3, 1.0)], pages.schema)).write.mode("append").parquet(places[0])
    incremental_ingest(spark, places[0], pages.schema, *places[1:], lambda df: completed_parts(df, ["q"], buckets=2))
    assert completed_documents(spark.read.parquet(places[1]), ["q"]).count() == 200


def test_files_are_read_by_their_names(spark, tmp_path):
    rows = [("a b.csv", "x\n1\n"), ("c.csv", "é\n"), ("e.csv", "")]
    made = write_files(spark.createDataFrame(rows, "file string, content string"), str(tmp_path / "out"))
    (tmp_path / "out" / "other.csv").write_text("not named")
    back = read_files(made, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert back.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_small_files_are_read_together(spark, tmp_path):
    for k in range(900):
        (tmp_path / f"{k}.md").write_bytes(b"# x\r\n\xc3\xa9" * (k % 2))
    found = scan_markdown(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert {tuple(r) for r in found.select("source_file", "md").collect()} == {(f"{k}.md", "# x\r\né") for k in range(1, 900, 2)}


def test_parts_are_made_once_for_a_cut(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    parts = spark.createDataFrame([(1, p, "x" * 10) for p in range(3)], "doc_id long, part_no int, text string").mapInArrow(seen, "doc_id long, part_no int, text string")
    assert sorted((r.part_no, len(r.text)) for r in cut_text(parts, 15).collect()) == [(0, 10), (1, 3)]
    assert calls.value == 3


def test_keys_are_normalised_once(spark):
    pairs = spark.createDataFrame([(1, 1, 1, "Invoice Numberr", "7"), (1, 1, 2, "invoice number", "8"), (2, 1, 1, "Invoyce Number", "9")], "doc_id long, page_number int, line_no int, key string, value string")
    for misread, want in ((True, {(1, "8"), (2, "9")}), (False, {(1, "8")})):
        found = schema_guided_fields(pairs, load_schemas(spark)["invoice"].aliases, misread=misread)
        assert plan(found).count("regexp_replace(lower(key") == 1
        assert {(r.doc_id, r.value) for r in found.collect()} == want


def test_counts_meet_records_without_a_broadcast(spark):
    counts = spark.createDataFrame([(1, 2), (2, 0)], "doc_id long, warnings_count long")
    told = spark.createDataFrame([(1, "llm", ["a"])], "doc_id long, extraction_method string, warnings array<string>")
    out = with_records(counts, told)
    assert "Broadcast" not in plan(out) and {(r.doc_id, r.warnings_count) for r in out.collect()} == {(1, 3), (2, 0)}


def test_an_order_meets_its_lines_values_and_pages_once(spark, tmp_path):
    at = str(tmp_path)
    part = spark.createDataFrame([(p, f"part {p}", 1.0) for p in range(40)], "p_partkey long, p_name string, p_retailprice double")
    lines = [(o, p, 1, 1 + p % 7, float(p), 2.0, 0.0, 0.0, "N", "O", datetime(2020, 1, 1)) for o, n in ((1, 3), (2, 23), (4, 6)) for p in range(n)]
    part.union(part.filter("p_partkey = 3")).write.parquet(f"{at}/part.parquet")
    spark.createDataFrame(
        [*lines, (None, 1, 1, 1, 1.0, 2.0, 0.0, 0.0, "N", "O", None), (1, 1, 1, None, 1.0, 2.0, 0.0, 0.0, "N", "O", None)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{at}/nation.parquet")
    orders = [(o, 1, "O", 9.0, datetime(2020, 1, 2), "1-URGENT") for o in (1, 2, 2)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    assert {r.doc_id for r in corpora.large_orders(spark, at, 6).collect()} == {2, 4}  # order 4 has 6 lines, one of a part that comes twice
    pages = {most: sorted(map(str, corpora.invoice_pages(spark, at, most).collect())) for most in (0, 6, 4096)}
    items = {most: sorted(map(str, corpora.invoice_items(spark, at, most).collect())) for most in (0, 6, 4096)}
    assert pages[0] == pages[6] == pages[4096] and items[0] == items[6] == items[4096]
    assert [r.rn for r in corpora.invoice_items(spark, at).filter("doc_id = 1").sort("rn").collect()] == [2, 3, 4]  # a line without a number counts
    # pages: 1 of order 1, 5 of order 2 and its first again, 2 of order 4
    assert len(pages[0]) == 9 and len(items[0]) == 3 + 24 + 7
    assert sum("INV-2\\n" in p for p in pages[0]) == 2
    assert plan(corpora.invoice_pages(spark, at)).count("Window [row_number") == 2


def test_only_the_orders_asked_for_are_rendered(spark, tmp_path):
    at, day = str(tmp_path), datetime(2020, 1, 1)
    spark.createDataFrame([(p, f"part {p}", 1.0) for p in range(9)], "p_partkey long, p_name string, p_retailprice double").write.parquet(f"{at}/part.parquet")
    lines = [(o, p, 1, 1 + p, float(p), 2.0, 0.0, 0.0, "N", "O", day) for o, n in ((1, 3), (2, 7), (3, 8), (4, 2)) for p in range(n)]
    spark.createDataFrame(
        [*lines, (None, *lines[0][1:])],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(1, "a", 1)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{at}/nation.parquet")
    spark.createDataFrame([(o, 1, "O", 9.0, day, "1-URGENT") for o in (1, 2, 3, 3)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    asked = spark.createDataFrame([(2,), (2,), (3,), (4,), (8,), (None,)], "doc_id long")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with ids that are too many to be broadcast
    try:
        for most in (0, 4096):
            some = corpora.invoice_pages(spark, at, most, only=asked)
            want = corpora.invoice_pages(spark, at, most).join(asked, "doc_id", "left_semi")
            assert sorted(map(str, some.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_pages_are_searched_without_patterns_over_whole_texts(spark):
    rows = [(1, 1, "x\r\n | a | b |\n||c\n|\n---\nk: v\n# h: 1\n| p: q |\u2028key = w"), (1, 2, "---\nt: x\n---\nName - y\n\t|z|"), (2, 1, None)]
    pages = spark.createDataFrame(rows, "doc_id long, page_number int, md string")
    raw = import_markdown_tables(pages)
    found = {(r.doc_id, r.page_number, r.page_table): r.raw_rows for r in raw.collect()}
    assert found == {(1, 1, 1): [["a", "b"], ["", "c"], [""]], (1, 1, 2): [["p: q"]], (1, 2, 1): [["z"]]}
    pairs = key_value_lines(pages, "md", markdown=True)
    assert sorted((r.page_number, r.line_no, r.key, r.value) for r in pairs.collect()) == [(1, 9, "key", "w"), (2, 1, "Name", "y")]
    # one pattern each, for other line ends and front matter, and only on texts that hold some
    assert plan(raw).count("regexp_replace(") == 1 and plan(pairs).count("regexp_replace(") == 2
    assert plan(pairs).count("RLIKE") == 0
    numbered = detect_header(raw)
    assert sorted(map(str, numbered.collect())) == sorted(map(str, detect_header(raw, stripped=True).collect()))


def test_rows_are_sorted_once_for_their_numbers(spark):
    rows = spark.createDataFrame([(k % 3, k % 5, k) for k in range(40)], "k int, a int, b int")
    numbered = number_rows(rows.repartition(4), ["k"], {"a": F.col("a")}, ["a", "b"])
    of = plan(numbered.hint("merge"))
    assert of.index("Join") < of.index("Window [row_number")
    assert sorted((r.k, r.rn) for r in numbered.collect()) == sorted((k, n + 1) for k in range(3) for n in range(len(range(k, 40, 3))))
