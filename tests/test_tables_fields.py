from __future__ import annotations

from pyspark.sql import functions as F

from docframe.operators import fields, tables as tb

PAGE = "doc_id long, page_number int, md string"


def imported(spark, *pages):
    return tb.import_markdown_tables(spark.createDataFrame(list(pages), PAGE))


def test_import_without_header_and_separator(spark):
    md = "# x\n|Zona A|u1|€|7,46|\n|Zona A||€|26,42|\n\ntext\n| a | b |\n|---|:-:|\n|  | 2 |\n|---|---|\n|"
    rows = imported(spark, (1, 1, md)).orderBy("page_table").collect()
    assert [(r.page_table, r.has_separator, r.raw_rows) for r in rows] == [
        (1, False, [["Zona A", "u1", "€", "7,46"], ["Zona A", "", "€", "26,42"]]),
        (2, True, [["a", "b"], ["", "2"], [""]]),
    ]


def raw(spark, *tables):
    rows = [(1, 1, i, t) for i, t in enumerate(tables, 1)]
    return spark.createDataFrame(
        rows, "doc_id long, page_number int, page_table int, raw_rows array<array<string>>"
    )


def test_header_detection(spark):
    df = raw(
        spark,
        [["Name", "Qty"], ["a", "1"]],
        [["a", "1"], ["b", "2"]],
        [["Name", "Qty"]],
        [["1", "2"], ["3", "4"]],
        [[None, " "], ["A", "B"], ["", ""], ["1", "x"]],
        [["€7", "-"], ["1", "2"]],
        [["", None]],
        [["1.5", "2,0", "-3", "x"], ["a", "b", "c", "d"]],
    )
    got = {r.page_table: (r.columns, r.rows) for r in tb.detect_header(df).collect()}
    assert got[1] == (["Name", "Qty"], [["a", "1"]])
    assert got[2] == (None, [["a", "1"], ["b", "2"]])
    assert got[3] == (None, [["Name", "Qty"]])
    assert got[4] == (None, [["1", "2"], ["3", "4"]])
    assert got[5] == (["A", "B"], [["1", "x"]])
    assert got[6] == (["€7", "-"], [["1", "2"]])
    assert 7 not in got
    assert got[8][0] is None


def test_rows_to_dicts(spark):
    df = raw(spark, [["A", "A", "B"], ["1", "2", "3"], ["x"]], [["1", "2"], ["3", "4", "5"]])
    rows = tb.rows_to_dicts(tb.detect_header(df)).collect()
    got = {(r.page_table, r.row_index, r.key): r.value for r in rows}
    assert got == {
        (1, 0, "A"): "2", (1, 0, "B"): "3", (1, 1, "A"): "x",
        (2, 0, "col_0"): "1", (2, 0, "col_1"): "2", (2, 1, "col_0"): "3", (2, 1, "col_1"): "4",
    }


def test_numbers_run_through_long_documents(spark):
    table = "| a | b |\n|---|---|\n| 1 | 2 |"
    pages = [(1, p, (table + "\n\n") * (p % 3)) for p in range(1, 30)] + [(2, 1, table)]
    tables = tb.detect_header(imported(spark, *pages))
    want = sorted(
        (d, p, t) for d, p, md in pages for t in range(1, md.count("---|---") + 1)
    )
    for block in (2, 4096):
        rows = tb.numbered_tables(tables, block).collect()
        by_doc = sorted((r.doc_id, r.table_idx, r.page_number, r.page_table) for r in rows)
        first = [(d, p, t) for d, _, p, t in by_doc]
        assert first == want
        assert [i for d, i, _, _ in by_doc if d == 1] == list(range(1, len(want)))


def test_numbers_mind_page_gaps(spark):
    table = "| a | b |\n|---|---|\n| 1 | 2 |"
    df = spark.createDataFrame([(1, 1, table, 2), (1, 5000, table, 2)], "doc_id long, page_number int, md string, page_count int")
    tables = tb.detect_header(tb.import_markdown_tables(df, keep=("page_count",)))
    rows = tb.numbered_tables(tables).orderBy("page_number").collect()
    assert [r.table_idx for r in rows] == [1, 2] and rows[0].table_id != rows[1].table_id


def test_csv_files_quote_cells(spark):
    md = '| a,b | c |\n|---|---|\n| 1 | say "x" |'
    df = spark.createDataFrame([(1, 2, "f.pdf", md)], "doc_id long, page_number int, source_file string, md string")
    numbered = tb.numbered_tables(tb.detect_header(tb.import_markdown_tables(df, keep=("source_file",))))
    assert tb.table_csv_files(numbered).first().content == 'page,"a,b",c\n2,1,"say ""x"""\n'


def test_amounts(spark):
    texts = {
        "1,200.00": 1200.0, "1.395,00": 1395.0, "€ 7,46": 7.46, "(100.00)": -100.0, "-5": -5.0, "1.395.000": 1395000.0,
        "1 200,50 EUR": 1200.5, "USD 10": 10.0, "1,395": 1395.0, "12.5": 12.5, "10 USD / 2 pcs": None, "INV 12": None,
        "ca. 5": None, "": None, "1,2,3": None, "12.34.56": None, "$1,000": 1000.0, "- € 3.20": -3.2,
    }
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.t: r.v for r in df.select("t", fields.amount(F.col("t"), "double").alias("v")).collect()}
    assert got == texts


def test_totals_lose_no_amount_silently(spark):
    items = spark.createDataFrame([(1, "1,200.00"), (1, "3"), (2, "x"), (2, "5")], "doc_id long, value string")
    totals = spark.createDataFrame([(1, "1.203,00"), (2, "5")], "doc_id long, value string")
    rows = {r.doc_id: (float(r.items_total), r.difference, r.unread) for r in fields.reconcile_totals(items, totals).collect()}
    assert float(rows[1][1]) == 0 and rows[1][2] == 0 and rows[2] == (5.0, None, 1)


def test_aliases_are_looked_up_in_the_row(spark):
    pairs = spark.createDataFrame([(1, 1, 1, "Seller", "a"), (1, 1, 2, "vendor name", "b"), (1, 1, 3, "Odd", "c")], "doc_id long, page_number int, line_no int, key string, value string")
    aliases = {"seller": "vendor_name", "vendor_name": "vendor_name"}
    assert [tuple(r) for r in fields.schema_guided_fields(pairs, aliases).collect()] == [(1, "vendor_name", "b")]
    assert [r.key for r in fields.unexpected_keys(pairs, aliases).collect()] == ["Odd"]
    plan = fields.schema_guided_fields(pairs, aliases)._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_header_only_table_gets_no_csv(spark):
    pages = spark.createDataFrame(
        [(1, 1, "dir/a.b.pdf", "| a |\n|---|\n\nx\n\n| c |\n|---|\n| 1 |")],
        "doc_id long, page_number int, source_file string, md string",
    )
    tables = tb.detect_header(tb.import_markdown_tables(pages, keep=("source_file",)))
    rows = tb.table_csv_rows(tb.numbered_tables(tables)).collect()
    assert [(r.file, r.header, r.cells) for r in rows] == [("a.b__table_002.csv", ["c"], ["1"])]


def test_table_markdown_and_consistency(spark):
    df = raw(spark, [["A", None], ["1 ", "2"], ["x"]]).withColumn("has_separator", F.lit(False))
    assert tb.table_to_markdown(df).first().md == "| A |  |\n| --- | --- |\n| 1 | 2 |\n| x |"
    row = tb.table_consistency(df).first()
    assert (row.min_width, row.max_width, row.consistent) == (1, 2, False)


def test_key_values(spark):
    text = "\n".join(
        [
            "Ref-No: 12", "a-b = c", "http://x", "Nota — bene", "k: v", "x" * 60 + ": in",
            "y" * 61 + ": out", "Empty:", "Name: a: b", "Range – 3", "Ref-No: 13", "AB - 1",
        ]
    )
    df = spark.createDataFrame([(1, 1, text), (1, 2, "Ref-No: 14\r\nZZ = 1")], "doc_id long, page_number int, text string")
    rows = fields.key_values(df).orderBy("first_page", "first_line").collect()
    assert [(r.key, r.value) for r in rows] == [
        ("Ref-No", "14"), ("a-b", "c"), ("http", "//x"), ("Nota", "bene"),
        ("x" * 60, "in"), ("Name", "a: b"), ("AB", "1"), ("ZZ", "1"),
    ]


def test_document_warnings(spark):
    pages = spark.createDataFrame([(1, 1, " "), (2, 1, " "), (3, 1, "x")], "doc_id long, page_number int, text string")
    tables = spark.createDataFrame([(2,)], "doc_id long")
    errors = spark.createDataFrame([(3, 1, "bad")], "doc_id long, page_number int, message string")
    got = {(r.doc_id, r.code, r.page_number) for r in tb.document_warnings(pages, tables, errors).collect()}
    assert got == {(1, "EMPTY_DOCUMENT", None), (3, "TABLE_EXTRACTION_ERROR", 1)}


def test_typed_values(spark):
    df = spark.createDataFrame(
        [(1, "d", "2024-02-30"), (1, "c", "€ 1,234.50"), (1, "n", "1,000.5"), (2, "d", "2024-02-29")],
        "doc_id long, name string, value string",
    )
    rows = fields.typed_record(df, {"d": "date", "c": "currency", "n": "number"}).orderBy("doc_id").collect()
    assert rows[0].d is None and float(rows[0].c) == 1234.5 and rows[0].n == 1000.5
    assert rows[0].warnings == ["Value of 'd' is no date"]
    assert str(rows[1].d) == "2024-02-29" and rows[1].warnings == []
