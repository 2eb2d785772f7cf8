"""Queries over page layout and extraction candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from docframe.operators import batch, layout, tables
from docframe.plans.corpora import candidates, files, layout_blocks, layout_items, table_boxes


def _outside(spark, sf):
    return layout.blocks_outside_tables(layout_blocks(spark, sf), table_boxes(spark, sf)).select(
        "doc_id", "page_number", "block_no", "x0", "y0", "text"
    )


def _warnings(spark, sf):
    blocks = layout_blocks(spark, sf)
    # Some documents lose all their text, so that empty ones exist; one page in 50 fails.
    pages = blocks.withColumn(
        "text", F.when(F.col("doc_id") % 7 == 0, F.lit("  ")).otherwise(F.col("text"))
    )
    errors = (
        blocks.filter((F.col("doc_id") + F.col("page_number")) % 50 == 0)
        .select("doc_id", "page_number", F.lit("no table grid").alias("message"))
        .distinct()
    )
    return tables.document_warnings(pages, table_boxes(spark, sf), errors)


def _candidates(spark, sf):
    return candidates(spark, sf), files(spark, sf)


def _page_text(spark, sf):
    """Pages from layout: a small table per box, then the blocks outside the boxes."""
    boxes = table_boxes(spark, sf)
    raw = boxes.select(
        "doc_id", "page_number", F.when(F.col("x0") < 100, 1).otherwise(2).alias("page_table"),
        F.array(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("1"), F.col("doc_id").cast("string"))).alias("raw_rows"),
    )
    return layout.layout_page_text(layout_blocks(spark, sf), boxes, tables.table_to_markdown(raw))


QUERIES = {
    "blocks_outside_tables": _outside,
    "layout_page_text": _page_text,
    "page_provenance": lambda s, d: layout.page_provenance(layout_items(s, d)),
    "extraction_density": lambda s, d: layout.extraction_density(*_candidates(s, d)),
    "best_extraction": lambda s, d: layout.best_extraction(*_candidates(s, d)),
    "failed_extractions": lambda s, d: layout.failed_extractions(*_candidates(s, d)),
    "empty_document_warning": lambda s, d: batch.warnings_csv(_warnings(s, d)),
    "warnings_csv": lambda s, d: batch.warnings_csv(_warnings(s, d)).groupBy("code", "page_number").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("documents")
    ),
}

BLOCKS = """
blocks AS (
  SELECT l_orderkey AS doc_id, CAST(1 + l_linenumber % 2 AS INTEGER) AS page_number,
    l_linenumber * 1000000 + l_partkey AS block_no, CAST(l_partkey % 500 AS DOUBLE) AS x0,
    CAST(l_suppkey * 7 % 700 AS DOUBLE) AS y0, l_partkey % 500 + l_quantity AS x1, l_suppkey * 7 % 700 + 10.0 AS y1,
    CASE WHEN (l_partkey + l_linenumber) % 6 = 5 THEN '' ELSE concat('part: ', l_partkey) END AS text
  FROM lineitem
),
boxes AS (
  SELECT o_orderkey AS doc_id, page_number, b.x0, b.y0, b.x1, b.y1
  FROM orders, (VALUES (1), (2)) AS p(page_number),
    (VALUES (1, 50, 50, 350, 500), (2, 400, 600, 480, 680)) AS b(n, x0, y0, x1, y1)
  WHERE o_orderkey % 3 <> 0 AND (n = 1 OR o_orderkey % 5 = 0)
)"""

WARNINGS = f"""{BLOCKS},
warned AS (
  SELECT DISTINCT doc_id, 'TABLE_EXTRACTION_ERROR' AS code, 'no table grid' AS message, CAST(page_number AS VARCHAR) AS page_number
  FROM blocks WHERE (doc_id + page_number) % 50 = 0
  UNION ALL
  SELECT doc_id, 'EMPTY_DOCUMENT', 'No tables or text found — document may be image-only or encrypted', '' FROM blocks
  WHERE doc_id % 3 = 0 GROUP BY doc_id HAVING doc_id % 7 = 0 OR bool_and(text = '')
)"""

CANDIDATES = r"""
article AS (
  SELECT page_id, strlen(html) AS n_bytes,
    regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g') AS body,
    regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages
),
cand AS (
  SELECT page_id AS doc_id, n_bytes, 'primary' AS method, CASE WHEN page_id % 3 = 0 THEN title ELSE body END AS text FROM article WHERE page_id % 7 <> 0
  UNION ALL SELECT page_id, n_bytes, 'secondary', CASE WHEN page_id % 5 = 0 THEN '  ' ELSE body END FROM article
  UNION ALL SELECT page_id, n_bytes, 'ocr', CASE WHEN page_id % 10 = 0 THEN '' ELSE title END FROM article
),
density AS (
  SELECT doc_id, method, text, n_bytes, length(text) AS n_chars,
    length(text) < greatest(200.0, n_bytes / 1024.0 * 50.0) AS sparse FROM cand WHERE trim(text, ' ' || chr(10) || chr(9)) <> ''
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN method = 'primary' AND NOT sparse THEN 1
    WHEN method = 'secondary' THEN 2 WHEN method = 'ocr' THEN 3 ELSE 4 END) AS r FROM density
)"""

ORACLES = {
    "blocks_outside_tables": f"""WITH {BLOCKS} SELECT doc_id, page_number, block_no, x0, y0, text FROM blocks b
        WHERE text <> '' AND NOT EXISTS (SELECT 1 FROM boxes t WHERE t.doc_id = b.doc_id AND t.page_number = b.page_number
          AND b.x0 >= t.x0 - 2 AND b.y0 >= t.y0 - 2 AND b.x1 <= t.x1 + 2 AND b.y1 <= t.y1 + 2)""",
    "layout_page_text": f"""WITH {BLOCKS}, outside AS (SELECT doc_id, page_number, 1 AS kind, block_no AS no, text FROM blocks b
          WHERE text <> '' AND NOT EXISTS (SELECT 1 FROM boxes t WHERE t.doc_id = b.doc_id AND t.page_number = b.page_number
            AND b.x0 >= t.x0 - 2 AND b.y0 >= t.y0 - 2 AND b.x1 <= t.x1 + 2 AND b.y1 <= t.y1 + 2)),
        md AS (SELECT doc_id, page_number, 0 AS kind, CASE WHEN x0 < 100 THEN 1 ELSE 2 END AS no,
          concat('| a | b |', chr(10), '| --- | --- |', chr(10), '| 1 | ', doc_id, ' |') AS text FROM boxes)
        SELECT doc_id, CAST(page_number AS INTEGER) AS page_number, string_agg(text, concat(chr(10), chr(10)) ORDER BY kind, no, text) AS text
        FROM (SELECT * FROM md UNION ALL SELECT * FROM outside) GROUP BY 1, 2""",
    "page_provenance": """WITH items AS (
          SELECT l_orderkey AS doc_id, p_name AS text, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
            l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
          FROM lineitem JOIN part ON l_partkey = p_partkey),
        cited AS (SELECT doc_id, rn, text, CASE WHEN rn % 4 = 0 THEN unnest([1, 2]) ELSE unnest([1 + rn % 2, NULL]) END AS page_number
          FROM items WHERE rn % 5 <> 0)
        SELECT doc_id, CAST(page_number AS INTEGER) AS page_number, 0 AS part_no,
          string_agg(text, concat(chr(10), chr(10)) ORDER BY rn) AS text FROM cited WHERE page_number IS NOT NULL GROUP BY 1, 2""",
    "extraction_density": f"WITH {CANDIDATES} SELECT doc_id, method, n_chars, n_bytes, sparse FROM density",
    "best_extraction": f"WITH {CANDIDATES} SELECT doc_id, method, 1 AS page_number, text FROM ranked WHERE r = 1",
    "failed_extractions": f"""WITH {CANDIDATES} SELECT page_id AS doc_id, 'all extractors failed' AS error FROM article
        WHERE page_id NOT IN (SELECT doc_id FROM ranked)""",
    "empty_document_warning": f"WITH {WARNINGS} SELECT * FROM warned",
    "warnings_csv": f"""WITH {WARNINGS} SELECT code, page_number, count(*) AS n, count(DISTINCT doc_id) AS documents
        FROM warned GROUP BY code, page_number""",
}
