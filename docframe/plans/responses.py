"""Queries over model responses; the SQL is arithmetic on order keys, no JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from docframe.functions.text import money, strip_json_fences
from docframe.operators import fields, records
from docframe.plans.corpora import document_type, invoice_headers, invoice_pages, responses, spread, table
from docframe.plans.invoices import ITEMS, ragged_tables
from docframe.sources.schemas import bundled, load_schemas, schema_columns

SCHEMA = "invoice"
# Columns of a summary template by letter.
TEMPLATE = {"A": "file_name", "B": "document_type", "C": "invoice_number", "F": "total_amount", "H": "review_status"}


def _records(spark, sf):
    return records.validated_records(responses(spark, sf), load_schemas(spark))


def _invoices(spark, sf):
    return _records(spark, sf).filter(F.col("document_type") == SCHEMA)


def _files(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("doc_id"), F.concat(F.lit("invoice_"), k.cast("string"), F.lit(".pdf")).alias("source_file")
    )


def _confidence_text():
    return F.coalesce(F.round("confidence", 6).cast("string"), F.lit(""))


def _validated(spark, sf):
    return _records(spark, sf).select(
        "doc_id", "document_type", "extraction_method",
        _confidence_text().alias("confidence"),
        F.size("fields").alias("n_fields"),
        F.size("line_items").alias("n_items"),
        F.array_join("warnings", ";").alias("warnings"),
    )


def _documents(spark, sf):
    return invoice_headers(spark, sf).select("doc_id").withColumn("document_type", document_type())


def _heuristic(spark, sf):
    """Heuristic rows of the documents that fall back, and of no others."""
    def of(docs):
        return fields.heuristic_record(invoice_pages(spark, sf, only=docs), ragged_tables)

    return of


def _fallback(spark, sf):
    """One answer in 17 is missing."""
    answers = responses(spark, sf).filter(F.col("doc_id") % 17 != 0)
    rows = records.record_with_fallback(_documents(spark, sf), answers, _heuristic(spark, sf), load_schemas(spark))
    return rows.select(
        "doc_id", "kind", "page_number", "a", "b", "key",
        F.coalesce(F.when((F.col("kind") == "record") & (F.col("key") == "confidence"), F.round(F.col("value").cast("double"), 6).cast("string")).otherwise(F.col("value")), F.lit("<null>")).alias("value"),
    )


def split_responses(spark, sf):
    """Up to three answers per order, each for a request of its own: fields, items and faults are dealt out over them."""
    orders = spread(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"))
    k, r, n = F.col("o_orderkey"), F.col("r"), F.col("n")
    rows = orders.withColumn("n", (1 + k % 3).cast("int")).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    entry = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    text = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    key = k.cast("string")
    given = F.array_compact(F.array(
        F.when(r == 0, entry("invoice_number", text(F.lit("INV-"), key))),
        entry("invoice_date", F.when(r == n - 1, text(F.date_format("o_orderdate", "yyyy-MM-dd"))).otherwise(F.lit('" "'))),
        F.when(r == k % n, entry("vendor_name", text(F.lit("Vendor-"), (k % 25).cast("string")))),
        F.when((k % 5 == 0) & (r > 0), entry("total_amount", text(r.cast("string"), F.lit(".00")))).when(
            k % 4 != 0, entry("total_amount", text(money(F.col("o_totalprice"))))
        ),
        F.when((k % 7 == 0) & (r < 2), entry("bogus", F.lit("1"))),
    ))
    items = F.expr(
        """transform(filter(sequence(0, 2), i -> i <= (o_orderkey + r) % 3), i ->
             CASE WHEN i = 1 AND o_orderkey % 8 = 0 THEN '7' ELSE concat('{"description": "Item ', r, '.', i, '", "quantity": ', i, '}') END)"""
    )
    own = F.array_compact(F.array(F.when(k % 10 == 3, F.lit('"low contrast"')), F.when(k % 6 == 0, text(F.lit("page "), r.cast("string"), F.lit(" torn")))))
    body = F.concat(
        F.lit('{"fields": {'), F.array_join(given, ", "), F.lit('}, "line_items": ['), F.array_join(items, ", "), F.lit("]"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.concat(F.lit(', "confidence": 0.'), (9 - r).cast("string"))),
        F.lit(', "warnings": ['), F.array_join(own, ", "), F.lit("]}"),
    )
    return rows.select(
        k.alias("doc_id"), F.lit(SCHEMA).alias("document_type"), F.lit(0).alias("part_no"), r.alias("request_no"),
        F.when((k % 11 == 0) & (r == n - 1), "Sorry").otherwise(body).alias("raw"),
    )


def _merged(spark, sf):
    rows = records.merged_records(split_responses(spark, sf), load_schemas(spark))
    return rows.withColumn("value", F.coalesce("value", F.lit("<null>")))


def _coverage(spark, sf):
    """How many records fill each field of the schemas."""
    filled = (
        explode_fields(_records(spark, sf))
        .filter(F.trim("value") != "")
        .groupBy("document_type", "name")
        .agg(F.count(F.lit(1)).alias("n_filled"))
    )
    columns = schema_columns(bundled(spark)).filter("part = 'field'")
    return columns.join(filled, ["document_type", "name"], "left").select(
        "document_type", "ord", "name", "type", "required",
        F.coalesce("n_filled", F.lit(0)).alias("n_filled"),
    )


def explode_fields(found):
    return found.select("document_type", F.explode("fields").alias("name", "value"))


def _wide(spark, sf):
    schema = load_schemas(spark)[SCHEMA]
    out = records.summary_wide(_invoices(spark, sf), _files(spark, sf), schema)
    return out.select(
        "file_name", "document_type", *[F.coalesce(c, F.lit("")).alias(c) for c in schema.names],
        _confidence_text().alias("confidence"), "review_status",
    )


def _items_wide(spark, sf):
    out = records.line_items_wide(_invoices(spark, sf), _files(spark, sf), load_schemas(spark)[SCHEMA], "invoice_number")
    return out.select(
        "file_name", "document_id", "invoice_number", "item_no",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("description", "quantity", "unit_price", "amount")],
    )


def _confidence(spark, sf):
    """Confidences as text: numbers, a word, a truth value and a number with a suffix."""
    e = F.col("event_id")
    number = (F.col("value") / 100).cast("string")
    text = (
        F.when(e % 10 == 0, F.lit("n/a")).when(e % 10 == 1, F.lit("true")).when(e % 10 == 2, F.concat(number, F.lit("d")))
        .when(e % 10 == 3, F.concat(F.lit(" "), number, F.lit(" "))).otherwise(number)
    )
    return table(spark, sf, "events").select(
        "event_id", F.coalesce(F.round(records.clamp_confidence(text), 9), F.lit(-1.0)).alias("confidence")
    )


def _artifacts(spark, sf):
    """Records as JSON and back."""
    found = _records(spark, sf)
    back = records.read_record_artifacts(records.record_artifacts(found))
    return back.select(
        "doc_id", "document_type", F.size("fields").alias("n_fields"), F.size("line_items").alias("n_items"),
        F.array_join("warnings", ";").alias("warnings"), _confidence_text().alias("confidence"), "extraction_method",
    )


QUERIES = {
    "strip_json_fences": lambda s, d: responses(s, d).select("doc_id", strip_json_fences(F.col("raw")).alias("text")),
    "parse_responses": lambda s, d: records.parse_responses(responses(s, d)).select("doc_id", "valid"),
    "raw_responses": lambda s, d: records.raw_responses(responses(s, d)).select(
        "doc_id", "valid", (F.get_json_object("raw_json", "$.raw") == F.col("raw")).alias("round_trip")
    ),
    "clamp_confidence": _confidence,
    "validated_records": _validated,
    "record_fields": lambda s, d: records.record_fields(_records(s, d)).withColumn(
        "value", F.coalesce("value", F.lit("<null>"))
    ),
    "clean_line_items": lambda s, d: records.record_items(_records(s, d)),
    "missing_required": lambda s, d: records.missing_required(_records(s, d)),
    "unexpected_fields": lambda s, d: records.unexpected_fields(_records(s, d)),
    "skipped_line_items": lambda s, d: records.skipped_line_items(_records(s, d)),
    "record_warnings_long": lambda s, d: records.record_warnings(_records(s, d)),
    "merged_records": _merged,
    "record_with_fallback": _fallback,
    "summary_wide": _wide,
    "line_items_wide": _items_wide,
    "summary_by_letter": lambda s, d: records.by_letter(_wide(s, d), TEMPLATE),
    "record_artifacts": _artifacts,
    "load_schema": _coverage,
}

RESP = """
base AS (
  SELECT *, kind = 'shipment' AS ship, CASE WHEN k % 6 = 0 THEN '  ' ELSE concat('Vendor-', k % 25) END AS party FROM (
    SELECT o_orderkey AS k, o_orderkey % 11 <> 0 AS valid, strftime(o_orderdate, '%Y-%m-%d') AS d,
      CASE WHEN o_orderkey % 3 = 2 THEN 'shipment' ELSE 'invoice' END AS kind,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total
    FROM orders)
),
rec AS (SELECT * FROM base WHERE valid),
filled AS (
  SELECT k, kind, unnest([
    {'n': CASE WHEN ship THEN 'load_number' ELSE 'invoice_number' END, 'v': concat('INV-', k)},
    {'n': CASE WHEN NOT ship THEN 'invoice_date' END, 'v': d},
    {'n': CASE WHEN ship THEN 'carrier' ELSE 'vendor_name' END, 'v': party},
    {'n': CASE WHEN k % 5 <> 0 THEN 'total_amount' END,
     'v': CASE WHEN ends_with(total, '.00') THEN replace(total, '.00', '') ELSE CASE WHEN ends_with(total, '0') THEN left(total, length(total) - 1) ELSE total END END},
    {'n': CASE WHEN ship THEN 'pickup_date' ELSE 'client_name' END, 'v': NULL}]) AS f FROM rec
),
flds AS (SELECT k, kind, f.n AS name, f.v AS value FROM filled WHERE f.n IS NOT NULL),
items AS (
  SELECT k, ship, i, concat(CASE WHEN ship THEN 'Pallet ' ELSE 'Item ' END, i) AS description, CAST((k + i) % 50 AS VARCHAR) AS quantity,
    CASE WHEN NOT ship THEN concat(k % 1000, '.', 10 + i) END AS amount
  FROM rec, generate_series(0, 3) AS g(i) WHERE i <= k % 4
),
warned AS (
  SELECT k, 1 AS o, 'low contrast' AS w, '' AS about FROM rec WHERE k % 10 = 3
  UNION ALL SELECT k, 1, 'Line item 3 has no readable price', '' FROM rec WHERE k % 10 = 6
  UNION ALL SELECT k, 2, 'Required field missing on page 2', '' FROM rec WHERE k % 10 = 6
  UNION ALL SELECT k, 3, concat('Required field missing or empty: ''', p, ''''), p
    FROM (SELECT *, CASE WHEN ship THEN 'carrier' ELSE 'vendor_name' END AS p FROM rec) WHERE k % 6 = 0
  UNION ALL SELECT k, 4, 'Required field missing or empty: ''total_amount''', 'total_amount' FROM rec WHERE k % 5 = 0
  UNION ALL SELECT k, 5, 'Unexpected field ignored: ''bogus_field''', 'bogus_field' FROM rec WHERE k % 7 = 0
  UNION ALL SELECT k, 6, 'Line item 0 is not a dict — skipped', '0' FROM rec WHERE k % 8 = 0
),
conf AS (
  SELECT k, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 14 = 0 THEN 1.0 WHEN k % 15 = 0 THEN 1.0 WHEN k % 16 = 0 THEN NULL
    WHEN k % 18 = 0 THEN NULL WHEN k % 19 = 0 THEN 0.75 ELSE (k % 100) / 100.0 END AS c FROM rec
),
notes AS (
  SELECT r.k, count(w.k) AS n, coalesce(string_agg(w.w, ';' ORDER BY w.o), '') AS t FROM rec r LEFT JOIN warned w ON r.k = w.k GROUP BY r.k
)"""
CONF_TEXT = "CASE WHEN c IS NULL THEN '' ELSE CAST(CAST(c AS DOUBLE) AS VARCHAR) END"
WITH = f"WITH {RESP}"
N_FIELDS = "CAST(4 - CASE WHEN ship THEN 1 ELSE 0 END + CASE WHEN r.k % 5 <> 0 THEN 1 ELSE 0 END AS INTEGER)"
CATEGORY = """CASE WHEN o <= 2 THEN 'model' WHEN o <= 4 THEN 'missing_required' WHEN o = 5 THEN 'unexpected_field'
  ELSE 'bad_line_item' END"""
RECORDS = f"""SELECT r.k AS doc_id, kind AS document_type, 'llm' AS extraction_method, {CONF_TEXT} AS confidence,
    {N_FIELDS} AS n_fields, CAST(r.k % 4 + 1 AS INTEGER) AS n_items, t AS warnings FROM rec r JOIN conf USING (k) JOIN notes USING (k)"""
# The keys of a record in JSON stand in the order of their names.
FIELD_ORDER = "row_number() OVER (PARTITION BY k ORDER BY name) - 1"

ORACLES = {
    "strip_json_fences": f"""{WITH} SELECT k AS doc_id, CASE WHEN NOT valid THEN 'Sorry, no data' ELSE
        concat('{{"document_type": "whatever", "fields": {{',
          CASE WHEN k % 23 = 0 THEN concat('"', number, '": "OLD", ') ELSE '' END, '"', number, '": "INV-', k, '", ',
          CASE WHEN ship THEN '' ELSE concat('"invoice_date": "', d, '", ') END,
          CASE WHEN ship THEN '"carrier": "' ELSE '"vendor_name": "' END, party, '"',
          CASE WHEN k % 5 = 0 THEN '' ELSE concat(', "total_amount": ', total) END,
          CASE WHEN k % 7 = 0 THEN ', "bogus_field": "b"' ELSE '' END,
          CASE WHEN ship THEN ', "pickup_date": null' ELSE ', "client_name": null' END, '}}, "line_items": [',
          CASE WHEN k % 8 = 0 THEN '"not_a_dict", ' ELSE '' END,
          array_to_string(list_transform(generate_series(0, k % 4), lambda i: concat(
            CASE WHEN ship THEN concat('{{"goods": "Pallet ', i, '", "pallets": ', (k + i) % 50)
              ELSE concat('{{"description": "Item ', i, '", "quantity": ', (k + i) % 50, ', "amount": "', k % 1000, '.', 10 + i, '"') END,
            CASE WHEN k % 9 = 0 THEN ', "junk": 1}}' ELSE '}}' END)), ', '),
          '], "confidence": ', CASE WHEN k % 13 = 0 THEN '"high"' WHEN k % 14 = 0 THEN '1.7' WHEN k % 15 = 0 THEN 'true'
            WHEN k % 16 = 0 THEN '"true"' WHEN k % 18 = 0 THEN '"0.9d"' WHEN k % 19 = 0 THEN '"0.75"'
            ELSE concat('0.', lpad(CAST(k % 100 AS VARCHAR), 2, '0')) END,
          ', "warnings": [', CASE WHEN k % 10 = 3 THEN '"low contrast"'
            WHEN k % 10 = 6 THEN '"Line item 3 has no readable price", "Required field missing on page 2"' ELSE '' END, ']}}') END AS text
        FROM (SELECT *, CASE WHEN ship THEN 'load_number' ELSE 'invoice_number' END AS number FROM base)""",
    "parse_responses": f"{WITH} SELECT k AS doc_id, valid FROM base",
    "raw_responses": f"{WITH} SELECT k AS doc_id, valid, true AS round_trip FROM base",
    "clamp_confidence": """SELECT event_id, CASE WHEN event_id % 10 < 3 THEN -1.0
        ELSE round(greatest(0.0, least(1.0, value / 100)), 9) END AS confidence FROM events""",
    "validated_records": f"{WITH} {RECORDS}",
    "record_artifacts": f"{WITH} {RECORDS}",
    "record_fields": f"""{WITH} SELECT k AS doc_id, name, coalesce(value, '<null>') AS value, 'llm' AS extraction_method FROM flds""",
    "clean_line_items": f"""{WITH} SELECT * FROM (SELECT k AS doc_id, i AS item_no,
          unnest(CASE WHEN ship THEN ['goods', 'pallets'] ELSE ['description', 'quantity', 'amount'] END) AS name,
          unnest(CASE WHEN ship THEN [description, quantity] ELSE [description, quantity, amount] END) AS value FROM items)""",
    "missing_required": f"{WITH} SELECT k AS doc_id, about AS name, w AS warning FROM warned WHERE o IN (3, 4)",
    "unexpected_fields": f"{WITH} SELECT k AS doc_id, about AS name, w AS warning FROM warned WHERE o = 5",
    "skipped_line_items": f"{WITH} SELECT k AS doc_id, 0 AS item_no, w AS warning FROM warned WHERE o = 6",
    "record_warnings_long": f"""{WITH} SELECT k AS doc_id, row_number() OVER (PARTITION BY k ORDER BY o) - 1 AS warning_no,
        {CATEGORY} AS category, w AS warning FROM warned""",
    "record_with_fallback": f"""{WITH}, {ITEMS},
        docs AS (SELECT doc_id AS k, doc_id % 17 <> 0 AND doc_id % 11 <> 0 AS told FROM heads),
        method AS (SELECT k, told, kind, c FROM docs JOIN base USING (k) LEFT JOIN conf USING (k)),
        ordered AS (SELECT f.*, {FIELD_ORDER} AS o FROM flds f),
        cols AS (SELECT k, i, unnest(CASE WHEN ship THEN ['goods', 'pallets'] ELSE ['amount', 'description', 'quantity'] END) AS name,
            unnest(CASE WHEN ship THEN [description, quantity] ELSE [amount, description, quantity] END) AS value,
            generate_subscripts(CASE WHEN ship THEN [1, 2] ELSE [1, 2, 3] END, 1) - 1 AS j FROM items_of),
        said AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY o) - 1 AS a, {CATEGORY} AS category, w FROM warned)
        SELECT k AS doc_id, 'record' AS kind, 0 AS page_number, 0 AS a, 0 AS b, 'extraction_method' AS key, CASE WHEN told THEN 'llm' ELSE 'heuristic' END AS value FROM method
        UNION ALL SELECT k, 'record', 0, 1, 0, 'document_type', CASE WHEN told THEN kind ELSE 'unknown' END FROM method
        UNION ALL SELECT k, 'record', 0, 2, 0, 'confidence', CASE WHEN told AND c IS NOT NULL THEN CAST(CAST(c AS DOUBLE) AS VARCHAR) ELSE '<null>' END FROM method
        UNION ALL SELECT k, 'field', 0, o, 0, name, coalesce(value, '<null>') FROM ordered JOIN docs USING (k) WHERE told
        UNION ALL SELECT k, 'item', 0, i, j, name, value FROM cols JOIN docs USING (k) WHERE told
        UNION ALL SELECT k, 'warning', 0, a, 0, category, w FROM said JOIN docs USING (k) WHERE told
        UNION ALL SELECT k, 'warning', 0, 1000000, 0, 'model_failure',
          CASE WHEN k % 17 = 0 THEN 'LLM call failed: no response' ELSE 'LLM returned invalid JSON' END FROM docs WHERE NOT told
        UNION ALL SELECT doc_id, 'field', first_page, first_line, 0, key, value FROM found JOIN docs ON doc_id = k WHERE NOT told
        UNION ALL SELECT doc_id, 'item', page_number, 1, row_index, key, value FROM dicts JOIN docs ON doc_id = k WHERE NOT told
        UNION ALL SELECT doc_id, 'warning', 1, 0, 0, 'RAGGED_TABLE', 'rows differ in width' FROM ragged JOIN docs ON doc_id = k WHERE NOT told
        """.replace("items AS (\n  SELECT k, ship", "items_of AS (\n  SELECT k, ship"),
    "merged_records": """WITH asked AS (
          SELECT o_orderkey AS k, o_orderkey % 3 + 1 AS n, r, strftime(o_orderdate, '%Y-%m-%d') AS d, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total,
            NOT (o_orderkey % 11 = 0 AND r = o_orderkey % 3) AS valid
          FROM orders, (VALUES (0), (1), (2)) AS g(r) WHERE r <= o_orderkey % 3),
        v AS (SELECT * FROM asked WHERE valid),
        told AS (
          SELECT k, r, 'invoice_number' AS name, concat('INV-', k) AS value FROM v WHERE r = 0
          UNION ALL SELECT k, r, 'invoice_date', CASE WHEN r = n - 1 THEN d ELSE ' ' END FROM v
          UNION ALL SELECT k, r, 'vendor_name', concat('Vendor-', k % 25) FROM v WHERE r = k % n
          UNION ALL SELECT k, r, 'total_amount', CASE WHEN k % 5 = 0 AND r > 0 THEN concat(r, '.00') ELSE total END FROM v WHERE k % 4 <> 0 OR (k % 5 = 0 AND r > 0)),
        single AS (SELECT k, name, value, min(r) AS r, trim(value) = '' AS blank FROM told GROUP BY k, name, value),
        best AS (SELECT k, name, min({'b': blank, 'r': r, 'v': value}) AS w FROM single GROUP BY k, name),
        line AS (SELECT k, r, i, i = 1 AND k % 8 = 0 AS bad FROM v, (VALUES (0), (1), (2)) AS g(i) WHERE i <= (k + r) % 3),
        good AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY r, i) - 1 AS a FROM line WHERE NOT bad),
        whole AS (SELECT DISTINCT k FROM v),
        warned AS (
          SELECT k, 0 AS o, min(r) AS r, 0 AS p, 'model' AS c, 'low contrast' AS t FROM v WHERE k % 10 = 3 GROUP BY k
          UNION ALL SELECT k, 0, r, 1, 'model', concat('page ', r, ' torn') FROM v WHERE k % 6 = 0
          UNION ALL SELECT k, 1, 0, p, 'missing_required', concat('Required field missing or empty: ''', name, '''')
            FROM whole, (VALUES ('invoice_number', 0), ('vendor_name', 1), ('invoice_date', 2), ('total_amount', 3)) AS need(name, p)
            WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.k = whole.k AND b.name = need.name AND NOT b.w.b)
          UNION ALL SELECT k, 2, min(r), 0, 'unexpected_field', 'Unexpected field ignored: ''bogus''' FROM v WHERE k % 7 = 0 AND r < 2 GROUP BY k
          UNION ALL SELECT k, 3, r, 0, 'bad_line_item', 'Line item 1 is not a dict — skipped' FROM line WHERE bad
          UNION ALL SELECT s.k, 4, s.r, 0, 'conflict', concat('Field ''', s.name, ''' differs between answers: ''', b.w.v, ''' kept, ''', s.value, ''' dropped')
            FROM single s JOIN best b ON s.k = b.k AND s.name = b.name WHERE NOT s.blank AND s.r <> b.w.r
          UNION ALL SELECT k, 5, r, 0, 'model_failure', 'LLM returned invalid JSON' FROM asked WHERE NOT valid AND k IN (SELECT k FROM whole))
        SELECT k AS doc_id, 'record' AS kind, 0 AS part_no, 0 AS request_no, a, 0 AS b, key, value FROM (
          SELECT k, unnest([0, 1, 2]) AS a, unnest(['extraction_method', 'document_type', 'confidence']) AS key,
            unnest(['llm', 'invoice', CASE WHEN k % 13 = 0 THEN '<null>' ELSE concat('0.', 9 - m) END]) AS value FROM (SELECT k, max(r) AS m FROM v GROUP BY k))
        UNION ALL SELECT k, 'field', 0, w.r, row_number() OVER (PARTITION BY k ORDER BY name) - 1, 0, name, w.v FROM best
        UNION ALL SELECT k, 'item', 0, r, a, 0, 'description', concat('Item ', r, '.', i) FROM good
        UNION ALL SELECT k, 'item', 0, r, a, 1, 'quantity', CAST(i AS VARCHAR) FROM good
        UNION ALL SELECT k, 'warning', 0, r, row_number() OVER (PARTITION BY k ORDER BY o, r, p, t) - 1, 0, c, t FROM warned""",
    "summary_wide": "",
    "summary_by_letter": "",
    "line_items_wide": f"""{WITH} SELECT concat('invoice_', k, '.pdf') AS file_name, k AS document_id, concat('INV-', k) AS invoice_number,
        i AS item_no, description, quantity, '' AS unit_price, amount FROM items WHERE NOT ship""",
    "load_schema": f"""{WITH}, s(document_type, ord, name, type, required) AS (VALUES
        ('invoice', 0, 'invoice_number', 'string', true), ('invoice', 1, 'vendor_name', 'string', true),
        ('invoice', 2, 'client_name', 'string', false), ('invoice', 3, 'invoice_date', 'date', true),
        ('invoice', 4, 'payment_terms', 'string', false), ('invoice', 5, 'total_amount', 'currency', true),
        ('shipment', 0, 'load_number', 'string', true), ('shipment', 1, 'carrier', 'string', true),
        ('shipment', 2, 'pickup_date', 'date', false), ('shipment', 3, 'weight_kg', 'number', false),
        ('shipment', 4, 'total_amount', 'currency', true))
        SELECT document_type, ord, s.name, type, required,
          (SELECT count(*) FROM flds f WHERE f.name = s.name AND f.kind = s.document_type AND trim(f.value) <> '') AS n_filled FROM s""",
}
WIDE = f"""SELECT concat('invoice_', w.k, '.pdf') AS file_name, 'invoice' AS document_type, invoice_number, vendor_name, '' AS client_name,
    invoice_date, '' AS payment_terms, coalesce(total_amount, '') AS total_amount, {CONF_TEXT} AS confidence,
    CASE WHEN n > 0 OR c IS NULL OR c < 0.8 THEN 'needs_review' ELSE 'ok' END AS review_status
  FROM (SELECT k, max(value) FILTER (name = 'invoice_number') AS invoice_number,
      max(value) FILTER (name = 'invoice_date') AS invoice_date, max(value) FILTER (name = 'vendor_name') AS vendor_name,
      max(value) FILTER (name = 'total_amount') AS total_amount FROM flds WHERE kind = 'invoice' GROUP BY k) w
  JOIN conf USING (k) JOIN notes USING (k)"""
ORACLES["summary_wide"] = f"{WITH} {WIDE}"
ORACLES["summary_by_letter"] = f"""{WITH} SELECT file_name AS "A", document_type AS "B", invoice_number AS "C", '' AS "D", '' AS "E",
    total_amount AS "F", '' AS "G", review_status AS "H" FROM ({WIDE})"""
