"""Queries over invoice pages rendered from orders, checked against the orders themselves.

The SQL never parses the rendered text: it states what must come back from the
relational columns the text was made of.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import functions as F

from docframe.functions.text import money
from docframe.operators import batch, fields, prompts, rules
from docframe.operators import tables as tb
from docframe.operators.rules import Holds, InOrder, SumsTo, UniqueOver
from docframe.plans.corpora import ROWS_PER_PAGE, document_type, invoice_headers, invoice_pages, item_pages, pages_by_size, spread, table
from docframe.session import work_folder, written
from docframe.sources.files import read_files, unique_files, write_files
from docframe.sources.schemas import load_schemas

EXTRACTED_AT = "2025-01-01T00:00:00+00:00"
TYPES = {"invoice_number": "string", "invoice_date": "date", "vendor_name": "string",
         "client_name": "string", "total_amount": "currency", "payment_terms": "date"}


def _stored(spark, sf):
    """The pages, stored like a corpus that several operators read, in sets (pages, together): a document is in one."""
    sets = pages_by_size(spark, sf)
    return [(written(pages, "pages", ["doc_id"] if together else ()), together) for pages, together in sets]


def _together(found):
    return reduce(lambda a, b: a.unionByName(b), found)


def _documents(spark, sf):
    """Documents as the batch sees them, without reading their pages."""
    return invoice_headers(spark, sf).select(
        "doc_id", "source_file", "page_count",
        F.lit("unknown").alias("document_type"), F.lit("markdown_import").alias("extraction_method"),
    )


def _raw(pages):
    return tb.import_markdown_tables(pages, keep=("source_file",))


def _raw_tables(spark, sf):
    return _raw(invoice_pages(spark, sf)).drop("source_file")


def _tables(spark, sf):
    return tb.detect_header(_raw_tables(spark, sf), stripped=True)


def _number(pages, together):
    return tb.numbered_tables(tb.detect_header(_raw(pages), stripped=True), together=together)


def _numbered(spark, sf):
    return _together(_number(pages, together) for pages, together in pages_by_size(spark, sf))


def _pairs(spark, sf):
    return fields.key_value_lines(invoice_pages(spark, sf), "md", markdown=True)


def _fields(spark, sf):
    return fields.last_per_key(_pairs(spark, sf))


def _schema_fields(spark, sf):
    return fields.schema_guided_fields(_pairs(spark, sf), load_schemas(spark)["invoice"].aliases)


def ragged_tables(raw, keep=()):
    """Tables with rows of unequal width, as extraction warnings."""
    return (
        tb.table_consistency(raw, keep=keep)
        .filter(~F.col("consistent"))
        .select("doc_id", *keep, F.lit("RAGGED_TABLE").alias("code"), F.lit("rows differ in width").alias("message"), "page_number")
    )


def ragged(pages):
    return ragged_tables(_raw(pages), keep=("source_file",))


def _counts(spark, sf):
    return batch.document_counts(invoice_pages(spark, sf))


def batch_summary(spark, sf):
    return batch.batch_summary(_counts(spark, sf), EXTRACTED_AT, "markdown_import")


def _import(spark, sf):
    raw = _raw_tables(spark, sf).withColumnRenamed("raw_rows", "rows")
    return tb.table_rows(raw).withColumn("cells", F.array_join("cells", "|"))


def _detect(spark, sf):
    return _tables(spark, sf).select(
        *tb.KEY,
        F.coalesce(F.array_join("columns", "|"), F.lit("")).alias("columns"),
        F.size("rows").alias("n_rows"),
        F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), ";").alias("rows"),
        "confidence",
    )


def _csv_rows(spark, sf):
    rows = tb.table_csv_rows(_numbered(spark, sf))
    return rows.withColumn("header", F.array_join("header", "|")).withColumn(
        "cells", F.array_join("cells", "|")
    )


def _line_items(spark, sf):
    rows = batch.batch_line_items(_numbered(spark, sf))
    return rows.withColumn("cells", F.array_join("cells", "|"))


def _heuristic(spark, sf):
    return fields.heuristic_record(invoice_pages(spark, sf), ragged_tables)


def _typed(spark, sf):
    wide = fields.typed_record(_schema_fields(spark, sf), TYPES)
    return wide.select(
        "doc_id", "invoice_number", F.col("invoice_date").cast("string").alias("invoice_date"),
        "vendor_name", "client_name", F.col("total_amount").cast("double").alias("total_amount"),
        F.coalesce(F.col("payment_terms").cast("string"), F.lit("")).alias("payment_terms"),
        F.array_join("warnings", ";").alias("warnings"),
    )


def _reconcile(spark, sf):
    items = tb.rows_to_dicts(_tables(spark, sf)).filter(F.col("key").isin("Amount", "col_3"))
    # Some amounts are written the European way, some are no amounts.
    k, v = F.col("doc_id"), F.col("value")
    european = F.concat(F.translate(F.format_number(v.cast("decimal(18,2)"), 2), ",.", ".,"), F.lit(" EUR"))
    shown = F.when(k % 13 == 5, european).when(k % 29 == 7, F.concat(F.lit("ca. "), v)).otherwise(v)
    totals = _schema_fields(spark, sf).filter(F.col("name") == "total_amount")
    out = fields.reconcile_totals(items.select("doc_id", shown.alias("value")), totals.select("doc_id", "value"))
    return out.select(
        "doc_id", *[F.coalesce(F.col(c).cast("double"), F.lit(-1e18)).alias(c) for c in ("items_total", "total", "difference")], "unread"
    )


def _spanning(spark, sf):
    """Item lists over pages: with the header on every page, on the first alone, or broken by a foot on every second page."""
    k, p = F.col("doc_id"), F.col("page_number")
    line = F.concat(F.lit("| "), "description", F.lit(" | "), "quantity", F.lit(" |"))
    body = item_pages(spark, sf, line)
    head = F.when((p == 1) | (k % 3 == 0), F.lit("| Description | Quantity |\n|---|---|\n")).otherwise("")
    foot = F.when((k % 3 == 2) & (p % 2 == 0), F.concat(F.lit("\n\npag. "), p.cast("string"))).otherwise(F.lit("\n"))
    intro = F.when(p == 1, F.lit("Order\n\n")).otherwise("")
    md = F.concat(intro, head, F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), foot)
    found = tb.spanning_tables(body.select("doc_id", "page_number", md.alias("md")))
    return found.select(
        "doc_id", "table_no", "page_number", "page_table", "first_row", F.coalesce(F.array_join("header", "|"), F.lit("")).alias("header"),
        F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), ";").alias("rows"),
    )


def _misread(spark, sf):
    """Keys of the lines of an order, of which one letter is wrong, missing or too many, beside some exact ones."""
    k = F.col("o_orderkey")
    spelled = F.array(*[F.lit(x) for x in ("Invoice Number", "Vendor Name", "Invoice Date", "Total Amount", "Reference")])
    rows = spread(table(spark, sf, "orders").select("o_orderkey")).select(k.alias("doc_id"), F.posexplode(spelled).alias("i", "right"))
    d, i, right = F.col("doc_id"), F.col("i"), F.col("right")
    at = (d % 7 + 2).cast("int")
    head, tail = F.substr(right, F.lit(1), at - 1), F.substr(right, at + 1)
    letter = F.substr(right, at, F.lit(1))
    wrong = (
        F.when((d + i) % 4 == 0, F.concat(head, F.lit("q"), tail)).when((d + i) % 4 == 1, F.concat(head, tail))
        .when((d + i) % 4 == 2, F.concat(head, letter, F.lit("q"), tail)).otherwise(F.concat(F.lit("qz"), right))
    )
    shown = F.explode(F.when((d % 5 == 0) & (i == 1), F.array(right, wrong)).otherwise(F.array(wrong)))
    pairs = rows.select("doc_id", "i", shown.alias("key")).select(
        "doc_id", F.lit(1).alias("page_number"), (F.col("i") * 2 + F.when(F.col("key").contains("q"), 1).otherwise(0)).alias("line_no"), "key", F.col("key").alias("value")
    )
    return fields.schema_guided_fields(pairs, load_schemas(spark)["invoice"].aliases, misread=True)


RULES = (
    SumsTo("total", "amount", Decimal("5000.00")),
    SumsTo("net", "amount"),
    InOrder(("ordered", "shipped", "received")),
    UniqueOver(("customer", "ordered")),
    Holds("priority is stated", lambda c: c("priority") != "4-NOT SPECIFIED", "a priority"),
)


def _rules(spark, sf):
    """Orders as typed records, their lines as items; the stated net total is off for some."""
    lines = table(spark, sf, "lineitem")
    dates = lines.groupBy("l_orderkey").agg(
        F.min("l_shipdate").cast("date").alias("shipped"), F.max("l_shipdate").cast("date").alias("received"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("sum"),
    )
    k = F.col("o_orderkey")
    records = table(spark, sf, "orders").join(dates, k == F.col("l_orderkey"), "left").select(
        k.alias("doc_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.when(k % 9 != 0, F.coalesce("sum", F.lit(0)) + F.when(k % 10 == 3, Decimal("0.01")).otherwise(Decimal("0.00"))).alias("net"),
        F.col("o_orderdate").cast("date").alias("ordered"), "shipped", "received",
        F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"),
    )
    shown = F.when(F.col("l_orderkey") % 31 == 4, F.concat(F.lit("ca. "), money(F.col("l_extendedprice")))).otherwise(money(F.col("l_extendedprice")))
    items = lines.select(F.col("l_orderkey").alias("doc_id"), F.lit("amount").alias("name"), shown.alias("value"))
    return rules.rule_violations(records, RULES, items)


def _combined(spark, sf):
    return (
        tb.combined_table(_tables(spark, sf))
        .groupBy("signature")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.size("cells") < 4).alias("short_rows"),
            F.sum(F.get("cells", F.lit(1)).try_cast("decimal(18,2)")).cast("double").alias("quantity"),
        )
    )


def _texts(pages):
    return pages.select("doc_id", "page_number", F.col("md").alias("text"))


def _doc_text(spark, sf):
    return _together(prompts.document_text(_texts(pages), _number(pages, together), together=together) for pages, together in _stored(spark, sf))


def _parts_by_size(spark, sf):
    """Parts of one page: their pages and tables in order."""
    return [(prompts.document_text(_texts(pages), _number(pages, together), 1, together), together) for pages, together in _stored(spark, sf)]


def _text_parts(spark, sf):
    return _together(parts for parts, _ in _parts_by_size(spark, sf))


def _cut(spark, sf):
    cut = _together(prompts.cut_text(parts, 900, together=together) for parts, together in _parts_by_size(spark, sf))
    return cut.groupBy("doc_id").agg(F.sum(F.length("text")).alias("n_chars"), F.max("part_no").alias("last_part"))


def _prompts(spark, sf):
    texts = prompts.requests(_doc_text(spark, sf), 400).withColumn("document_type", document_type())
    return prompts.schema_prompts(texts, load_schemas(spark))


def _workbook(spark, sf):
    """All sheets; the tables of every fifth document are left out, so that its pages are listed."""
    return _together(_sheets(pages, together) for pages, together in _stored(spark, sf))


def _sheets(pages, together):
    summary = batch.document_counts(pages).select(
        "doc_id", "source_file", F.lit("unknown").alias("document_type"), "pages", "tables_found", "fields_found",
        F.col("warnings_count").alias("warnings"), F.lit(EXTRACTED_AT).alias("extracted_at"),
        F.lit("markdown_import").alias("extraction_method"),
    )
    texts = pages.select(
        "doc_id", "page_number", F.col("md").alias("text"), F.lit("markdown_import").alias("extraction_method")
    )
    found = fields.key_values(pages, "md", markdown=True)
    numbered = _number(pages, together).filter(F.col("doc_id") % 5 != 0)
    book = batch.document_workbook(summary, found, numbered, texts, ragged(pages), together)
    return book.withColumn("values", F.array_join("values", "|"))


def _csv_files(spark, sf):
    """Write a CSV file per table and read them back."""
    folder = work_folder(spark, "tables")
    # The names are told from the contents before those are dealt out, so they are made once.
    contents = written(tb.table_csv_files(_numbered(spark, sf)), "contents")
    made = write_files(unique_files(contents), folder)
    return read_files(made, folder)


def _json_artifacts(spark, sf):
    docs = _documents(spark, sf)
    written = batch.json_artifacts(docs, "doc_id", "source_file", "page_count", "document_type")
    back = F.from_json("json", "doc_id long, source_file string, page_count int, document_type string")
    return written.select("doc_id", "json", back["page_count"].alias("page_count"),
                          (back["doc_id"] == F.col("doc_id")).alias("round_trip"))


def _document_artifacts(spark, sf):
    """Documents with pages and tables as JSON and back."""
    made = _together(
        batch.document_artifacts(_documents(spark, sf), _texts(pages), _number(pages, together), together=together)
        for pages, together in _stored(spark, sf)
    )
    back = batch.read_document_artifacts(made)
    return back.select(
        "doc_id", "source_file", "page_count", F.array_join(F.transform("pages", lambda p: p["text"]), "\n").alias("text"),
        F.array_join(F.transform("tables", lambda t: F.concat_ws(":", t["table_idx"], t["page_number"], F.coalesce(F.array_join(t["columns"], "|"), F.lit("")), F.size(t["rows"]))), ";").alias("tables"),
    )


def _with_records(spark, sf):
    """Counts of fresh and resumed documents, the model's warnings added to the fresh ones."""
    from docframe.operators import records as rec
    from docframe.plans.corpora import responses

    found = rec.validated_records(responses(spark, sf), load_schemas(spark))
    resumed = invoice_headers(spark, sf).select("doc_id").filter(F.col("doc_id") % 4 == 1)
    return batch.with_records(_counts(spark, sf), found, resumed).withColumn(
        "extraction_methods", F.array_join("extraction_methods", "+")
    )


def _pairing(spark, sf):
    record = _fields(spark, sf).groupBy("doc_id").agg(F.count(F.lit(1)).alias("fields_found"))
    return batch.doc_record_join(_documents(spark, sf), record).select(
        "doc_id", "source_file", "page_count", "fields_found"
    )


QUERIES = {
    "batch_summary": batch_summary,
    "rule_violations": _rules,
    "misread_fields": _misread,
    "spanning_tables": _spanning,
    "import_markdown_tables": _import,
    "detect_header": _detect,
    "rows_to_dicts": lambda s, d: tb.rows_to_dicts(_tables(s, d)),
    "table_to_markdown": lambda s, d: tb.table_to_markdown(_raw_tables(s, d)),
    "table_consistency": lambda s, d: tb.table_consistency(_raw_tables(s, d)),
    "table_numbering": lambda s, d: tb.table_numbering(_tables(s, d)),
    "combined_table": _combined,
    "table_csv_rows": _csv_rows,
    "batch_line_items": _line_items,
    "key_values": lambda s, d: _fields(s, d),
    "fields_csv": lambda s, d: batch.fields_csv(_fields(s, d), "heuristic"),
    "heuristic_record": _heuristic,
    "schema_guided_fields": _schema_fields,
    "unmatched_keys": lambda s, d: fields.unexpected_keys(_pairs(s, d), load_schemas(s)["invoice"].aliases),
    "typed_record": _typed,
    "reconcile_totals": _reconcile,
    "document_counts": _counts,
    "batch_warnings": lambda s, d: batch.batch_warnings(ragged(invoice_pages(s, d))),
    "document_text": _doc_text,
    "document_text_parts": _text_parts,
    "document_text_cut": _cut,
    "table_csv_files": _csv_files,
    "document_artifacts": _document_artifacts,
    "counts_with_records": _with_records,
    "schema_prompts": _prompts,
    "document_workbook": _workbook,
    "json_artifacts": _json_artifacts,
    "doc_record_join": _pairing,
}

R = ROWS_PER_PAGE

ITEMS = f"""
items AS (
  SELECT *, (rn - 1) // {R} + 1 AS page_number, (rn - 1) % {R} AS on_page FROM (
    SELECT l_orderkey AS doc_id, p_name AS description,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
        l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS rn,
      CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS quantity,
      CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
      CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_value, CAST(l_quantity AS DECIMAL(18,2)) AS quantity_value
    FROM lineitem JOIN part ON l_partkey = p_partkey)
),
cells AS (
  SELECT *, CASE WHEN doc_id % 9 = 0 AND rn = 1 THEN [description, quantity, unit_price]
    ELSE [description, quantity, unit_price, amount] END AS cells FROM items
),
heads AS (
  SELECT doc_id, n_items, CAST(ceil(n_items / {R}.0) AS INTEGER) AS page_count,
    concat('invoice_', doc_id, '.pdf') AS source_file,
    strftime(o_orderdate, '%Y-%m-%d') AS invoice_date,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount,
    CAST(o_totalprice AS DECIMAL(18,2)) AS total_value,
    o_orderstatus, o_orderpriority, c_name, c_nationkey, n_name
  FROM orders JOIN (SELECT l_orderkey AS doc_id, count(*) AS n_items FROM lineitem GROUP BY 1) ON o_orderkey = doc_id
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
pairs AS (
  SELECT doc_id, unnest([
    {{'k': 'Invoice Number', 'v': CASE WHEN doc_id % 7 = 0 THEN concat('INV-', doc_id, '-R') ELSE concat('INV-', doc_id) END, 'l': 3}},
    {{'k': 'Invoice Date', 'v': invoice_date, 'l': 4}},
    {{'k': 'Vendor Name', 'v': concat('Vendor-', c_nationkey), 'l': 5}},
    {{'k': 'Client Name', 'v': c_name, 'l': 6}},
    {{'k': 'Payment Terms', 'v': o_orderpriority, 'l': 7}},
    {{'k': 'Status', 'v': o_orderstatus, 'l': 8}},
    {{'k': 'Reference', 'v': concat('R', doc_id), 'l': 9}},
    {{'k': CASE WHEN doc_id % 10 <> 0 THEN 'Total Amount' END, 'v': total_amount,
      'l': 12 + least(n_items, {R}) + CASE WHEN doc_id % 4 = 0 THEN 0 ELSE 2 END}}]) AS kv
  FROM heads
),
found AS (
  SELECT doc_id, kv.k AS key, kv.v AS value, 1 AS first_page, kv.l AS first_line FROM pairs WHERE kv.k IS NOT NULL
),
names AS (
  SELECT *, CASE WHEN doc_id % 4 = 0
    THEN list_transform(generate_series(0, len(first_value(cells) OVER (PARTITION BY doc_id, page_number ORDER BY rn)) - 1), lambda i: concat('col_', i))
    ELSE ['Description', 'Quantity', 'Unit Price', 'Amount'] END AS names FROM cells
),
dicts AS (
  SELECT doc_id, page_number, 1 AS page_table, on_page AS row_index, j - 1 AS pos, names[j] AS key, cells[j] AS value
  FROM names, generate_series(1, 4) AS g(j) WHERE j <= least(len(names), len(cells))
),
ragged AS (
  SELECT doc_id FROM heads WHERE doc_id % 9 = 0 AND (doc_id % 4 <> 0 OR n_items > 1)
),
header_rows AS (
  SELECT doc_id, page_number, -1 AS on_page, ['Description', 'Quantity', 'Unit Price', 'Amount'] AS cells
  FROM (SELECT DISTINCT doc_id, page_number FROM items) WHERE doc_id % 4 <> 0
)"""

TABLE_MD = """
raw_rows AS (
  SELECT doc_id, page_number, on_page, cells FROM cells UNION ALL SELECT * FROM header_rows
),
table_md AS (
  SELECT doc_id, page_number, string_agg(CASE WHEN first THEN concat(line, chr(10), rule) ELSE line END, chr(10) ORDER BY on_page) AS md
  FROM (SELECT doc_id, page_number, on_page, concat('| ', array_to_string(cells, ' | '), ' |') AS line,
      concat('| ', array_to_string(list_transform(cells, lambda c: '---'), ' | '), ' |') AS rule,
      row_number() OVER (PARTITION BY doc_id, page_number ORDER BY on_page) = 1 AS first FROM raw_rows)
  GROUP BY doc_id, page_number
)"""

TABLE_ID = "substring(md5(concat(doc_id, '#', page_number)), 1, 8)"

DOC_TEXT = """
page_md AS (
  SELECT h.doc_id, p.page_number, CASE WHEN p.page_number = 1 THEN concat(
      '---', chr(10), 'titolo: Invoice INV-', h.doc_id, chr(10), 'comune: ', n_name, chr(10), 'tipo: Invoice', chr(10),
      'anno: ', substring(invoice_date, 1, 4), chr(10), '---', chr(10), '# INVOICE', chr(10), chr(10),
      'Invoice Number: INV-', h.doc_id, chr(10), 'Invoice Date: ', invoice_date, chr(10),
      'Vendor Name: Vendor-', c_nationkey, chr(10), 'Client Name: ', c_name, chr(10),
      'Payment Terms: ', o_orderpriority, chr(10), 'Status = ', o_orderstatus, chr(10), 'Reference - R', h.doc_id, chr(10), chr(10),
      body,
      CASE WHEN h.doc_id % 10 = 0 THEN '' ELSE concat(chr(10), chr(10), 'Total Amount: ', total_amount) END,
      CASE WHEN h.doc_id % 7 = 0 THEN concat(chr(10), chr(10), 'Invoice Number: INV-', h.doc_id, '-R') ELSE '' END)
    ELSE concat('Continued', chr(10), chr(10), body) END AS md
  FROM heads h JOIN (
    SELECT doc_id, page_number, concat(
      CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('| Description | Quantity | Unit Price | Amount |', chr(10), '| --- | --- | --- | --- |', chr(10)) END,
      string_agg(concat('| ', array_to_string(cells, ' | '), ' |'), chr(10) ORDER BY rn)) AS body
    FROM cells GROUP BY doc_id, page_number) p ON h.doc_id = p.doc_id
),
table_text AS (
  SELECT doc_id, page_number, concat(chr(10), '[Table ', page_number, ']', chr(10),
      '| ', array_to_string(any_value(names), ' | '), ' |', chr(10),
      '| ', array_to_string(list_transform(any_value(names), lambda c: '---'), ' | '), ' |', chr(10),
      string_agg(concat('| ', array_to_string(cells, ' | '), ' |'), chr(10) ORDER BY rn)) AS md
  FROM names GROUP BY doc_id, page_number
),
texts AS (
  SELECT doc_id, string_agg(md, concat(chr(10), chr(10)) ORDER BY part, page_number) AS text
  FROM (SELECT *, 0 AS part FROM page_md UNION ALL SELECT *, 1 AS part FROM table_text) GROUP BY doc_id
)"""

CSV = """CASE WHEN regexp_matches(c, '[",\\r\\n]') THEN concat('"', replace(c, '"', '""'), '"') ELSE c END"""
WITH = f"WITH {ITEMS}"
COUNTS = f"""{ITEMS},
counts AS (
  SELECT doc_id, source_file, page_count AS pages, page_count AS tables_found,
    7 + CASE WHEN doc_id % 10 <> 0 THEN 1 ELSE 0 END AS fields_found,
    CASE WHEN doc_id IN (SELECT doc_id FROM ragged) THEN 1 ELSE 0 END AS warnings_count FROM heads
)"""
SCHEMA_FOUND = f"""{ITEMS},
schema_found AS (
  SELECT doc_id, replace(lower(key), ' ', '_') AS name, value FROM found WHERE key NOT IN ('Status', 'Reference')
)"""

ORACLES = {
    "batch_summary": f"""WITH {COUNTS} SELECT source_file, 'unknown' AS document_type, pages, tables_found, fields_found,
        warnings_count AS warnings, 'markdown_import' AS extraction_method, '{EXTRACTED_AT}' AS extracted_at FROM counts""",
    "import_markdown_tables": f"""{WITH}, {TABLE_MD} SELECT doc_id, page_number, 1 AS page_table, doc_id % 4 <> 0 AS has_separator,
        on_page + CASE WHEN doc_id % 4 <> 0 THEN 1 ELSE 0 END AS row_index, array_to_string(cells, '|') AS cells FROM raw_rows""",
    "detect_header": f"""{WITH} SELECT doc_id, page_number, 1 AS page_table,
        CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'Description|Quantity|Unit Price|Amount' END AS columns, count(*) AS n_rows,
        string_agg(array_to_string(cells, '|'), ';' ORDER BY rn) AS rows, 0.9 AS confidence
        FROM cells GROUP BY doc_id, page_number""",
    "rows_to_dicts": f"{WITH} SELECT * FROM dicts",
    "table_to_markdown": f"{WITH}, {TABLE_MD} SELECT doc_id, page_number, 1 AS page_table, md FROM table_md",
    "table_consistency": f"""{WITH}, {TABLE_MD} SELECT doc_id, page_number, 1 AS page_table, count(*) AS n_rows,
        min(len(cells)) AS min_width, max(len(cells)) AS max_width, min(len(cells)) = max(len(cells)) AS consistent,
        doc_id % 4 <> 0 AS has_separator FROM raw_rows GROUP BY doc_id, page_number""",
    "table_numbering": f"""{WITH} SELECT DISTINCT doc_id, page_number, 1 AS page_table, page_number AS table_idx,
        {TABLE_ID} AS table_id FROM items""",
    "combined_table": f"""{WITH} SELECT array_to_string(names, '|') AS signature, count(*) AS n_rows,
        count(*) FILTER (len(cells) < 4) AS short_rows, CAST(sum(quantity_value) AS DOUBLE) AS quantity FROM names GROUP BY 1""",
    "table_csv_rows": f"""{WITH} SELECT doc_id, page_number AS table_idx,
        concat('invoice_', doc_id, '__table_', lpad(CAST(page_number AS VARCHAR), 3, '0'), '.csv') AS file,
        on_page AS row_index, page_number AS page, array_to_string(names, '|') AS header, array_to_string(cells, '|') AS cells FROM names""",
    "batch_line_items": f"""{WITH} SELECT concat('invoice_', doc_id, '.pdf') AS source_file, doc_id AS document_id,
        {TABLE_ID} AS table_id, on_page AS row_index, array_to_string(cells, '|') AS cells FROM cells""",
    "key_values": f"{WITH} SELECT * FROM found",
    "fields_csv": f"""{WITH} SELECT doc_id, first_page, first_line, key AS field_name, value,
        'heuristic' AS extraction_method FROM found""",
    "heuristic_record": f"""{WITH} SELECT doc_id, 'field' AS kind, first_page AS page_number, first_line AS a, 0 AS b, key, value FROM found
        UNION ALL SELECT doc_id, 'item', page_number, 1, row_index, key, value FROM dicts
        UNION ALL SELECT doc_id, 'warning', 1, 0, 0, 'RAGGED_TABLE', 'rows differ in width' FROM ragged""",
    "schema_guided_fields": f"WITH {SCHEMA_FOUND} SELECT * FROM schema_found",
    "unmatched_keys": f"{WITH} SELECT doc_id, key FROM found WHERE key IN ('Status', 'Reference')",
    "typed_record": f"""{WITH} SELECT doc_id,
        CASE WHEN doc_id % 7 = 0 THEN concat('INV-', doc_id, '-R') ELSE concat('INV-', doc_id) END AS invoice_number,
        invoice_date, concat('Vendor-', c_nationkey) AS vendor_name, c_name AS client_name,
        CASE WHEN doc_id % 10 <> 0 THEN CAST(total_value AS DOUBLE) END AS total_amount, '' AS payment_terms,
        'Value of ''payment_terms'' is no date' AS warnings FROM heads""",
    "spanning_tables": f"""{WITH}, f AS (
          SELECT doc_id, page_number, count(*) AS n, string_agg(concat(description, '|', quantity), ';' ORDER BY rn) AS rows,
            CASE WHEN doc_id % 3 = 2 THEN (page_number + 1) // 2 ELSE 1 END AS table_no FROM items GROUP BY doc_id, page_number)
        SELECT doc_id, CAST(table_no AS INTEGER) AS table_no, page_number, 1 AS page_table,
          CAST(coalesce(sum(n) OVER (PARTITION BY doc_id, table_no ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_row,
          CASE WHEN table_no = 1 THEN 'Description|Quantity' ELSE '' END AS header, rows FROM f""",
    "misread_fields": """WITH s(i, name, w) AS (VALUES (0, 'invoice_number', 'Invoice Number'), (1, 'vendor_name', 'Vendor Name'), (2, 'invoice_date', 'Invoice Date'), (3, 'total_amount', 'Total Amount')),
        k AS (SELECT o_orderkey AS d, s.*, o_orderkey % 7 + 2 AS a FROM orders, s)
        SELECT d AS doc_id, name, CASE WHEN d % 5 = 0 AND i = 1 THEN w WHEN (d + i) % 4 = 0 THEN concat(left(w, a - 1), 'q', substring(w, a + 1))
          WHEN (d + i) % 4 = 1 THEN concat(left(w, a - 1), substring(w, a + 1)) ELSE concat(left(w, a), 'q', substring(w, a + 1)) END AS value
        FROM k WHERE (d + i) % 4 <> 3 OR (d % 5 = 0 AND i = 1)""",
    "rule_violations": """WITH s AS (SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s, count(*) AS n,
            CAST(min(l_shipdate) AS DATE) AS shipped, CAST(max(l_shipdate) AS DATE) AS received FROM lineitem GROUP BY 1),
        r AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(coalesce(s, 0) AS DECIMAL(20,2)) AS s, n, k % 31 = 4 AND n > 0 AS bad,
            CAST(o_orderdate AS DATE) AS ordered, shipped, o_custkey AS c, o_orderpriority AS p FROM orders LEFT JOIN s ON k = o_orderkey),
        u AS (SELECT c, ordered, count(*) AS m, min(k) AS f FROM r GROUP BY c, ordered HAVING count(*) > 1)
        SELECT k AS doc_id, 'sum' AS rule, 'amount to total' AS about, CAST(total AS VARCHAR) AS expected,
          CASE WHEN bad THEN concat(n, ' values are no amounts') ELSE CAST(s AS VARCHAR) END AS found FROM r WHERE coalesce(bad, false) OR abs(total - s) > 5000
        UNION ALL SELECT k, 'sum', 'amount to net', CAST(CAST(s + CASE WHEN k % 10 = 3 THEN 0.01 ELSE 0 END AS DECIMAL(20,2)) AS VARCHAR),
          CASE WHEN bad THEN concat(n, ' values are no amounts') ELSE CAST(s AS VARCHAR) END FROM r WHERE k % 9 <> 0 AND (coalesce(bad, false) OR k % 10 = 3)
        UNION ALL SELECT k, 'order', 'ordered to shipped', concat('at least ', ordered), CAST(shipped AS VARCHAR) FROM r WHERE ordered > shipped
        UNION ALL SELECT k, 'holds', 'priority is stated', 'a priority', '' FROM r WHERE p = '4-NOT SPECIFIED'
        UNION ALL SELECT k, 'unique', 'customer, ordered', concat('in one document, first in ', f), concat(r.c, ' | ', r.ordered, ' in ', m)
          FROM r JOIN u ON r.c = u.c AND r.ordered = u.ordered""",
    "reconcile_totals": f"""{WITH} SELECT h.doc_id, CASE WHEN h.doc_id % 13 <> 5 AND h.doc_id % 29 = 7 THEN -1e18 ELSE CAST(s AS DOUBLE) END AS items_total,
        CAST(total_value AS DOUBLE) AS total,
        CASE WHEN h.doc_id % 13 <> 5 AND h.doc_id % 29 = 7 THEN -1e18 ELSE CAST(total_value - s AS DOUBLE) END AS difference,
        CASE WHEN h.doc_id % 13 <> 5 AND h.doc_id % 29 = 7 THEN c ELSE 0 END AS unread FROM heads h JOIN (
          SELECT n.doc_id, sum(CASE WHEN len(cells) = 4 AND len(names) = 4 THEN amount_value END) AS s,
            count(*) FILTER (len(cells) = 4 AND len(names) = 4) AS c FROM names n GROUP BY n.doc_id
          HAVING count(*) FILTER (len(cells) = 4 AND len(names) = 4) > 0) i
        ON h.doc_id = i.doc_id WHERE h.doc_id % 10 <> 0""",
    "document_counts": f"WITH {COUNTS} SELECT * FROM counts",
    "batch_warnings": f"""{WITH} SELECT concat('invoice_', doc_id, '.pdf') AS source_file, 'RAGGED_TABLE' AS code,
        'rows differ in width' AS message, '1' AS page_number FROM ragged""",
    "document_text": f"{WITH}, {DOC_TEXT} SELECT doc_id, 0 AS part_no, text FROM texts",
    "document_text_parts": f"""{WITH}, {DOC_TEXT} SELECT p.doc_id, CAST(p.page_number - 1 AS INTEGER) AS part_no,
        concat(p.md, chr(10), chr(10), t.md) AS text FROM page_md p JOIN table_text t ON p.doc_id = t.doc_id AND p.page_number = t.page_number""",
    "document_text_cut": f"""{WITH}, {DOC_TEXT}, cut AS (
          SELECT p.doc_id, p.page_number - 1 AS part_no, length(p.md) + 2 + length(t.md) AS n,
            900 - coalesce(sum(length(p.md) + 4 + length(t.md)) OVER (PARTITION BY p.doc_id ORDER BY p.page_number
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
          FROM page_md p JOIN table_text t ON p.doc_id = t.doc_id AND p.page_number = t.page_number)
        SELECT doc_id, CAST(sum(least(n, room)) AS BIGINT) AS n_chars, CAST(max(part_no) AS INTEGER) AS last_part FROM cut WHERE room > 0 GROUP BY doc_id""",
    "schema_prompts": "",
    "table_csv_files": f"""{WITH} SELECT concat('invoice_', doc_id, '__table_', lpad(CAST(page_number AS VARCHAR), 3, '0'), '.csv') AS file,
        concat('page,', array_to_string(list_transform(any_value(names), lambda c: {CSV}), ','), chr(10),
          string_agg(concat(page_number, ',', array_to_string(list_transform(cells, lambda c: {CSV}), ',')), chr(10) ORDER BY rn), chr(10)) AS content
        FROM names GROUP BY doc_id, page_number""",
    "document_artifacts": f"""{WITH}, {DOC_TEXT}, t AS (
          SELECT doc_id, string_agg(concat(page_number, ':', page_number, ':', CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'Description|Quantity|Unit Price|Amount' END, ':', n), ';' ORDER BY page_number) AS tables
          FROM (SELECT doc_id, page_number, count(*) AS n FROM items GROUP BY 1, 2) GROUP BY doc_id)
        SELECT h.doc_id, source_file, page_count, p.text, tables FROM heads h
        JOIN (SELECT doc_id, string_agg(md, chr(10) ORDER BY page_number) AS text FROM page_md GROUP BY doc_id) p ON h.doc_id = p.doc_id
        JOIN t ON h.doc_id = t.doc_id""",
    "counts_with_records": f"""WITH {COUNTS},
        told AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 3 THEN 1 WHEN o_orderkey % 10 = 6 THEN 2 ELSE 0 END
            + CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END
            + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 8 = 0 THEN 1 ELSE 0 END AS w
          FROM orders WHERE o_orderkey % 11 <> 0)
        SELECT doc_id, source_file, pages, tables_found, fields_found, doc_id % 4 = 1 AS resumed,
          warnings_count + CASE WHEN doc_id % 4 = 1 THEN 0 ELSE coalesce(w, 0) END AS warnings_count,
          CASE WHEN w IS NULL THEN 'markdown_import' ELSE 'markdown_import+llm' END AS extraction_methods
        FROM counts LEFT JOIN told ON doc_id = k""",
    "document_workbook": f"""WITH {COUNTS}, {DOC_TEXT}
        SELECT doc_id, 'Summary' AS sheet, -1 AS a, 0 AS b, concat_ws('|', source_file, doc_id, 'unknown', pages, tables_found, fields_found,
          warnings_count, '{EXTRACTED_AT}', 'markdown_import') AS values FROM counts
        UNION ALL SELECT doc_id, 'Summary', first_page, first_line, concat(key, '|', value) FROM found
        UNION ALL SELECT doc_id, concat('Table_', lpad(CAST(page_number AS VARCHAR), 3, '0')), on_page, 0,
          concat(page_number, '|', array_to_string(cells, '|')) FROM cells WHERE doc_id % 5 <> 0
        UNION ALL SELECT doc_id, 'Pages', page_number, 0, concat(page_number, '|', md, '|markdown_import') FROM page_md WHERE doc_id % 5 = 0
        UNION ALL SELECT doc_id, 'Warnings', 1, 0, 'RAGGED_TABLE|rows differ in width|1' FROM ragged""",
    "json_artifacts": f"""{WITH} SELECT doc_id, concat('{{"doc_id":', doc_id, ',"source_file":"', source_file,
        '","page_count":', page_count, ',"document_type":"unknown"}}') AS json, page_count, true AS round_trip FROM heads""",
    "doc_record_join": f"WITH {COUNTS} SELECT doc_id, source_file, pages AS page_count, fields_found FROM counts",
}


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _prompts_sql() -> str:
    """The requests, with the instructions of the bundled schemas as texts."""
    from docframe.sources.schemas import local_schemas

    told = {k: _sql_text(prompts.instructions(v)) for k, v in local_schemas().items()}
    return f"""{WITH}, {DOC_TEXT}, cut AS (SELECT doc_id, text, unnest(generate_series(0, greatest(1, CAST(ceil(length(text) / 400.0) AS INTEGER)) - 1)) AS n FROM texts)
        SELECT doc_id, 0 AS part_no, CAST(n AS INTEGER) AS request_no, concat(CASE WHEN doc_id % 3 = 2 THEN {told['shipment']} ELSE {told['invoice']} END,
          chr(10), substring(text, n * 400 + 1, 400)) AS prompt FROM cut"""


ORACLES["schema_prompts"] = _prompts_sql()
