"""Queries over page fragments and page texts, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from docframe.operators import assemble, batch, cleanup, prompts
from docframe.plans.corpora import fragments, page_texts, table, table_boxes

NL = "chr(10)"


def _clean(spark, sf):
    return assemble.clean_fragments(fragments(spark, sf))


def _metadata(spark, sf):
    return assemble.document_metadata(_clean(spark, sf))


def _nested(spark, sf):
    """A page per customer whose front matter has a map, lists, a literal text and folded lines."""
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    block = F.concat(
        F.lit("titolo: Cliente\n  "), name, F.lit("\nsede:\n    nazione: "), F.col("n_name"), F.lit("  # dove\n    recapiti: ["), key,
        F.lit(", \"tel: "), key, F.lit("\",\n      {giorni: [lun, mar]}]\ntags:\n  - segmento: "), F.col("c_mktsegment"),
        F.lit("\n    vuoto:\n  - '0"), key, F.lit("'\nnote: |\n   riga "), key, F.lit("\n   fine: si\nanno: 2019\n"),
    )
    return rows.select(
        F.col("c_custkey").alias("doc_id"), F.lit("cliente.pdf").alias("source_file"), F.lit(1).alias("page_number"),
        F.concat(F.lit("---\n"), block, F.lit("---\n\n# "), name, F.lit("\n")).alias("page_md"),
    )


def _checks(spark, sf):
    """Front matter and heading checks of the assembled documents."""
    parts = assemble.validated_parts(_clean(spark, sf), 2).select(
        "doc_id",
        F.col("meta")["tipo"].alias("tipo"),
        (~F.exists("warnings", lambda w: w.startswith("Missing"))).alias("front_matter_ok"),
        (~F.exists("warnings", lambda w: w.startswith("Line"))).alias("no_skips"),
    )
    return parts.groupBy("doc_id", "tipo").agg(*[F.min(c).alias(c) for c in ("front_matter_ok", "no_skips")])


def _document_quality(spark, sf):
    flags = _checks(spark, sf)
    share = lambda c: F.round(F.avg(F.col(c).cast("int")), 6).alias(c)
    return flags.groupBy("tipo").agg(
        F.count(F.lit(1)).alias("documents"), share("front_matter_ok"), share("no_skips")
    )


def _unreadable(spark, sf):
    return cleanup.mark_unreadable(page_texts(spark, sf)).select(
        "doc_id", "page_number", "text", "unreadable", F.coalesce("marker", F.lit("")).alias("marker")
    )


def _unreadable_lists(spark, sf):
    """Every document with the numbers of its unreadable pages."""
    pages = cleanup.mark_unreadable(page_texts(spark, sf))
    marked = F.sort_array(F.collect_list(F.when(F.col("unreadable"), F.col("page_number"))))
    return pages.groupBy("doc_id").agg(
        F.count_if("unreadable").alias("n_unreadable"),
        F.array_join(marked.cast("array<string>"), ",").alias("pages"),
    )


def _pages_csv(spark, sf):
    # Orders and conversations share ids, so part of the documents have tables.
    return batch.pages_csv(page_texts(spark, sf), table_boxes(spark, sf))


QUERIES = {
    "strip_code_fences": lambda s, d: _clean(s, d).select("doc_id", "page_number", "page_md"),
    "assemble_documents": lambda s, d: assemble.assemble_documents(_clean(s, d)),
    "md_documents": lambda s, d: assemble.md_documents(_clean(s, d)),
    "front_matter_defaults": lambda s, d: _metadata(s, d).select(
        "doc_id", "titolo", F.coalesce("comune", F.lit("<null>")).alias("comune"), "tipo"
    ),
    "front_matter_values": lambda s, d: assemble.front_matter_values(assemble.md_documents(_nested(s, d))).withColumn(
        "value", F.coalesce("value", F.lit("<null>"))
    ),
    "year_backfill": lambda s, d: _metadata(s, d).select("doc_id", "anno"),
    "validate_documents": lambda s, d: assemble.validation_warnings(_clean(s, d), 2),
    "document_quality": _document_quality,
    "nonblank_pages": lambda s, d: assemble.nonblank_pages(page_texts(s, d)),
    "documents_without_text": lambda s, d: assemble.documents_without_text(
        page_texts(s, d).withColumn(
            "text", F.when(F.col("doc_id") % 9 == 0, F.lit("  ")).otherwise(F.col("text"))
        )
    ),
    "full_text": lambda s, d: assemble.full_text(page_texts(s, d)),
    "page_prompts": lambda s, d: prompts.page_prompts(page_texts(s, d)),
    "mark_unreadable": _unreadable,
    "unreadable_pages": _unreadable_lists,
    "pages_csv": _pages_csv,
}

FRAGMENTS = f"""
pages0 AS (
  SELECT conv_id AS c, CAST(turn + 1 AS INTEGER) AS p, text,
    false AS blank, turn = 0 AND conv_id % 3 <> 0 AS front FROM conversations
),
parts0 AS (
  SELECT *, concat(
      CASE WHEN c % 5 = 1 THEN '' ELSE concat('titolo: Conversation ', c, {NL}) END,
      CASE WHEN c % 6 = 2 THEN concat('comune:', {NL}) ELSE concat('comune: CITTA-', c % 4, {NL}) END,
      'tipo: Chat', {NL},
      CASE WHEN c % 2 = 0 THEN concat('anno: ', 2010 + c % 10, {NL}) ELSE '' END) AS entries,
    concat(CASE WHEN p = 1 AND c % 7 <> 0 THEN concat('# Doc ', c, {NL}, {NL}) ELSE '' END,
      CASE WHEN p % 3 = 2 THEN concat('#### Sezione ', p, {NL}, {NL})
        WHEN p % 3 = 0 THEN concat('## Capitolo ', p, {NL}, {NL}) ELSE '' END,
      text,
      CASE WHEN c % 2 = 1 THEN concat(' Anno ', 2010 + (c + p) % 5, '. L.R. 12/', 2005 + p, '.') ELSE '' END) AS body
  FROM pages0
)"""

META = """
facts AS (
  SELECT c, bool_or(front AND NOT blank) AS has_front,
    bool_or(p = 1 AND c % 7 <> 0 AND NOT blank) AS has_title, bool_or(NOT blank) AS filled
  FROM parts0 GROUP BY c
),
years AS (
  SELECT c, y FROM (
    SELECT c, y, row_number() OVER (PARTITION BY c ORDER BY n DESC, first_p) AS r FROM (
      SELECT c, 2010 + (c + p) % 5 AS y, count(*) AS n, min(p) AS first_p
      FROM parts0 WHERE NOT blank AND c % 2 = 1 GROUP BY 1, 2)) WHERE r = 1
),
meta AS (
  SELECT f.c, has_title, filled, has_front,
    CASE WHEN has_front AND f.c % 5 <> 1 THEN concat('Conversation ', f.c) ELSE concat('chat_', f.c) END AS titolo,
    CASE WHEN NOT has_front THEN 'UNKNOWN' WHEN f.c % 6 = 2 THEN NULL ELSE concat('CITTA-', f.c % 4) END AS comune,
    CASE WHEN has_front THEN 'Chat' ELSE 'UNKNOWN' END AS tipo,
    CASE WHEN has_front AND f.c % 2 = 0 THEN CAST(2010 + f.c % 10 AS VARCHAR) ELSE coalesce(CAST(y AS VARCHAR), 'UNKNOWN') END AS anno
  FROM facts f LEFT JOIN years y ON f.c = y.c
),
bodies AS (
  SELECT m.c, concat(CASE WHEN has_title THEN '' ELSE concat('# ', titolo, chr(10), chr(10)) END, coalesce(t, '')) AS body,
    concat('---', chr(10), 'anno: ', anno, chr(10), 'comune: ', coalesce(comune, 'null'), chr(10), 'tipo: ', tipo, chr(10),
      'titolo: ', titolo, chr(10), '---', chr(10), chr(10)) AS head
  FROM meta m LEFT JOIN (SELECT c, string_agg(body, concat(chr(10), chr(10)) ORDER BY p) AS t FROM parts0 WHERE NOT blank GROUP BY c) b
    ON m.c = b.c
),
lines AS (
  SELECT c, head, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT c, head, string_split(body, chr(10)) AS ls FROM bodies)
),
heads AS (
  SELECT *, lag(level) OVER (PARTITION BY c ORDER BY pos) AS previous FROM (
    SELECT c, pos, line, length(regexp_extract(line, '^(#{1,4})\\s', 1)) AS level FROM lines) WHERE level > 0
),
warned AS (
  SELECT c, 0 AS part, 1 AS k, 'Missing required front matter field: ''comune''' AS warning FROM meta WHERE comune IS NULL
  UNION ALL
  SELECT c, 1, pos, concat('Line ', pos, ': heading level skips from ', previous, ' to ', level, ' — ''', trim(line), '''')
  FROM heads WHERE level > previous + 1
),
fixed AS (
  SELECT c, string_agg(line, chr(10) ORDER BY pos, sub) AS body FROM (
    SELECT c, pos, 1 AS sub, line FROM lines
    UNION ALL SELECT c, pos, 0, concat(repeat('#', previous + 1), ' (continued)') FROM heads WHERE level = previous + 2)
  GROUP BY c
)"""

PAGE_TEXTS = """
turns AS (SELECT *, CAST(2 * turn + 1 AS INTEGER) AS p FROM conversations),
page_texts AS (
  SELECT doc_id, page_number, text, CASE WHEN doc_id % 2 = 0 THEN 'pymupdf' ELSE 'docling' END AS extraction_method, blank FROM (
    SELECT conv_id AS doc_id, p AS page_number, text, false AS blank FROM turns
    UNION ALL SELECT conv_id, p + 1, CASE WHEN (conv_id + p) % 8 = 0 THEN concat(' ', chr(10), chr(9), ' ') ELSE concat(' - ', p + 1, ' - ') END,
      (conv_id + p) % 8 = 0 FROM turns WHERE (conv_id + p) % 8 IN (0, 3))
)"""

WITH = f"WITH {FRAGMENTS}, {META}"
PAGES = f"WITH {PAGE_TEXTS}"
SMALL = r"length(regexp_replace(text, '\s', '', 'g')) < 20"

ORACLES = {
    "strip_code_fences": f"""WITH {FRAGMENTS} SELECT c AS doc_id, p AS page_number, concat(
        CASE WHEN front THEN concat('---', {NL}, entries, '---', {NL}, {NL})
          WHEN p = 2 AND c % 5 = 0 THEN concat('---', {NL}, 'stray: yes', {NL}, '---', {NL}) ELSE '' END, body) AS page_md
        FROM parts0 UNION ALL SELECT DISTINCT c, 5000, '' FROM parts0 WHERE p = 1 AND c % 8 = 0""",
    "assemble_documents": f"{WITH} SELECT c AS doc_id, 0 AS part_no, concat(head, body, {NL}) AS md FROM bodies",
    "md_documents": f"""{WITH} SELECT f.c AS doc_id, concat('chat_', f.c, '.pdf') AS source_file, 0 AS part_no,
        concat(head, f.body, {NL}) AS md FROM fixed f JOIN bodies b ON f.c = b.c""",
    "front_matter_values": """SELECT c_custkey AS doc_id, unnest(['titolo', 'comune', 'tipo', 'anno', 'sede.nazione', 'sede.recapiti[0]', 'sede.recapiti[1]',
          'sede.recapiti[2].giorni[0]', 'sede.recapiti[2].giorni[1]', 'tags[0].segmento', 'tags[0].vuoto', 'tags[1]', 'note']) AS path,
        unnest([concat('Cliente ', c_name), 'UNKNOWN', 'UNKNOWN', '2019', n_name, CAST(c_custkey AS VARCHAR), concat('tel: ', c_custkey), 'lun', 'mar',
          c_mktsegment, '<null>', concat('0', c_custkey), concat('riga ', c_custkey, chr(10), 'fine: si', chr(10))]) AS value
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "front_matter_defaults": f"{WITH} SELECT c AS doc_id, titolo, coalesce(comune, '<null>') AS comune, tipo FROM meta",
    "year_backfill": f"{WITH} SELECT c AS doc_id, anno FROM meta",
    "validate_documents": f"""{WITH} SELECT c AS doc_id,
        row_number() OVER (PARTITION BY c ORDER BY part, k) - 1 AS warning_no, warning FROM warned""",
    "document_quality": f"""{WITH} SELECT tipo, count(*) AS documents,
        round(avg(CASE WHEN comune IS NULL THEN 0 ELSE 1 END), 6) AS front_matter_ok,
        round(avg(CASE WHEN c IN (SELECT c FROM warned WHERE part = 1) THEN 0 ELSE 1 END), 6) AS no_skips
        FROM meta GROUP BY tipo""",
    "nonblank_pages": f"{PAGES} SELECT doc_id, page_number, text, extraction_method FROM page_texts WHERE NOT blank",
    "documents_without_text": f"""{PAGES} SELECT doc_id, 'no text extracted' AS error FROM page_texts
        GROUP BY doc_id HAVING doc_id % 9 = 0""",
    "full_text": f"""{PAGES} SELECT doc_id, 0 AS part_no, string_agg(text, concat({NL}, {NL}) ORDER BY page_number) AS text
        FROM page_texts WHERE NOT blank GROUP BY doc_id""",
    "page_prompts": f"""{PAGES} SELECT doc_id, page_number, concat('Page ', page_number, ' of ', count(*) OVER (PARTITION BY doc_id),
        '. Turn the page text between the marks into Markdown by the given rules. ',
        CASE WHEN page_number = 1 THEN 'Begin with YAML front matter: titolo, comune, tipo, anno.'
          ELSE 'Write no front matter, this is a later page.' END,
        {NL}, {NL}, '<<<PAGE', {NL}, text, {NL}, 'PAGE>>>') AS prompt FROM page_texts""",
    "mark_unreadable": f"""{PAGES} SELECT doc_id, page_number, text, {SMALL} AS unreadable,
        CASE WHEN {SMALL} THEN concat('<!-- UNREADABLE: page ', page_number, ' -->') ELSE '' END AS marker FROM page_texts""",
    "unreadable_pages": f"""{PAGES} SELECT doc_id, count(*) FILTER ({SMALL}) AS n_unreadable,
        coalesce(string_agg(page_number, ',' ORDER BY page_number) FILTER ({SMALL}), '') AS pages FROM page_texts GROUP BY doc_id""",
    "pages_csv": f"""{PAGES} SELECT doc_id, page_number, text, extraction_method FROM page_texts
        WHERE NOT blank AND doc_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)""",
}
