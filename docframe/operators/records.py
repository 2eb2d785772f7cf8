"""Records from model responses: parsing, validation, fallback, output shapes.

A response is one JSON text per document and is validated inside its row,
against the schema of the document's type; only the fallback joins documents
with responses. What the validation finds is kept as notes with a kind, apart
from the sentences a model adds itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions.rows import computed, explode
from docframe.functions.text import is_blank, strip_json_fences
from docframe.operators.ordered import number_rows
from docframe.session import written
from docframe.sources.schemas import Schema

REVIEW_BELOW = 0.8
#: Where an answer's request stood in its document, and the number of a fallen document's last warning.
PLACE = ("part_no", "request_no")
LATE = 1_000_000
STRINGS = "array<string>"
ITEMS = "array<map<string,string>>"
NOTES = "array<struct<kind:string,about:string,text:string>>"
# How a number may be written in a confidence given as text.
NUMBER = r"(?i)\A\s*[+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?|inf|infinity|nan)\s*\z"

Schemas = Schema | dict[str, Schema]


def _kind(v: Column, path: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID"))


def parse_responses(responses: DataFrame) -> DataFrame:
    """Responses with ``parsed`` (variant) and ``valid``: a JSON object with object fields.

    Of a repeated key the last value counts, which is a setting of the session.
    """
    return _parsed(responses).drop("_fields")


def _parsed(responses: DataFrame) -> DataFrame:
    """``parse_responses`` with ``_fields``, the fields as a map.

    What begins with a brace is an object, and a value becomes a map if and only if it is one; so no schema of a
    value is written out to be told.
    """
    responses.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text, v = computed(responses, _text=strip_json_fences(F.col("raw"))), F.col("parsed")
    parsed = computed(text, parsed=F.try_parse_json("_text"))
    found = computed(parsed, _fields=F.try_variant_get(v, "$.fields", "map<string,string>"))
    fields = F.try_variant_get(v, "$.fields", "variant")
    valid = v.isNotNull() & F.col("_text").startswith("{") & (F.col("_fields").isNotNull() | fields.isNull() | F.is_variant_null(fields))
    return found.withColumn("valid", valid).drop("_text")


def clamp_confidence(text: Column) -> Column:
    """A confidence given as text, clamped to [0, 1]; null if it is no number."""
    number = F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))
    return F.when(number.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def _confidence(v: Column) -> Column:
    """The confidence of a response: a number, a truth value, or a text that is a number."""
    kind, text = _kind(v, "$.confidence"), F.try_variant_get(v, "$.confidence", "string")
    return (
        F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
        .when(kind.isin("VOID") | kind.startswith("OBJECT") | kind.startswith("ARRAY"), None)
        .otherwise(clamp_confidence(text))
    )


def _by_type(schemas: Schemas, of: Callable[[Schema], list[str]]) -> Column:
    """An array of names for the row's ``_type``, as a literal."""
    names = lambda s: F.array(*[F.lit(n) for n in of(s)]).cast(STRINGS)
    if isinstance(schemas, Schema):
        return names(schemas)
    entries = [x for k, s in schemas.items() for x in (F.lit(k), names(s))]
    return F.coalesce(F.try_element_at(F.create_map(*entries), F.col("_type")), F.array().cast(STRINGS))


def _typed(rows: DataFrame, schemas: Schemas) -> DataFrame:
    """Rows with ``_type``, the schema that holds for them."""
    kind = F.lit(schemas.document_type) if isinstance(schemas, Schema) else F.col("document_type")
    return rows.withColumn("_type", kind)


def validated_records(responses: DataFrame, schemas: Schemas) -> DataFrame:
    """Records of the valid responses.

    With one schema per document type, responses carry their ``document_type``.
    Columns: doc_id, document_type, fields (map of the schema's fields that are
    present), line_items (array of maps), confidence, warnings, notes,
    extraction_method. ``warnings`` are the texts: the model's own, then those of
    ``notes`` (missing required fields, unexpected fields by name, items that are
    no objects).
    """
    found = _judged(_parsed(_typed(responses, schemas)).filter("valid"), schemas)
    noted = computed(found, notes=F.concat("missing", "others"))
    return noted.select(
        "doc_id",
        "document_type",
        "fields",
        "line_items",
        "confidence",
        F.concat("own", F.transform("notes", lambda n: n["text"])).alias("warnings"),
        "notes",
        F.lit("llm").alias("extraction_method"),
    )


def _lacks(name: Column) -> Column:
    return F.concat(F.lit("Required field missing or empty: '"), name, F.lit("'"))


def _judged(parsed: DataFrame, schemas: Schemas, keep: tuple[str, ...] = ()) -> DataFrame:
    """What each answer says: its fields, items, confidence and ``own`` warnings, and the notes on it, ``missing`` fields
    and ``others``."""
    v = F.col("parsed")
    got = computed(
        parsed,
        given=F.coalesce("_fields", F.create_map().cast("map<string,string>")),
        # An item that is no object becomes null.
        items=F.coalesce(F.try_variant_get(v, "$.line_items", ITEMS), F.array().cast(ITEMS)),
        own=F.coalesce(F.try_variant_get(v, "$.warnings", STRINGS), F.array().cast(STRINGS)),
        known=_by_type(schemas, lambda s: s.names),
        needed=_by_type(schemas, lambda s: s.required),
        columns=_by_type(schemas, lambda s: s.item_names),
    )
    # The wordings of the three findings.
    note = lambda kind, about, text: F.struct(F.lit(kind).alias("kind"), about.alias("about"), text.alias("text"))
    missing = F.transform(
        F.filter("needed", lambda n: F.coalesce(is_blank(F.try_element_at("given", n)), F.lit(True))),
        lambda n: note("missing_required", n, _lacks(n)),
    )
    unexpected = F.transform(
        F.sort_array(F.array_except(F.map_keys("given"), F.col("known"))),
        lambda k: note("unexpected_field", k, F.concat(F.lit("Unexpected field ignored: '"), k, F.lit("'"))),
    )
    places = F.filter(
        F.transform("items", lambda x, i: F.when(x.isNull(), i.cast("string"))), lambda i: i.isNotNull()
    )
    bad = F.transform(
        places, lambda i: note("bad_line_item", i, F.concat(F.lit("Line item "), i, F.lit(" is not a dict — skipped")))
    )
    good = F.transform(
        F.filter("items", lambda x: x.isNotNull()),
        lambda x: F.map_filter(x, lambda k, _: F.array_contains("columns", k)),
    )
    return got.select(
        "doc_id",
        "valid",
        *keep,
        F.col("_type").alias("document_type"),
        F.map_filter("given", lambda k, _: F.array_contains("known", k)).alias("fields"),
        good.alias("line_items"),
        _confidence(v).alias("confidence"),
        "own",
        missing.alias("missing"),
        F.concat(unexpected, bad).alias("others"),
    )


def missing_required(records: DataFrame) -> DataFrame:
    """(doc_id, name, warning) of required fields a record lacks."""
    return _noted(records, "missing_required", "name")


def unexpected_fields(records: DataFrame) -> DataFrame:
    """(doc_id, name, warning) of fields the schema does not have."""
    return _noted(records, "unexpected_field", "name")


def skipped_line_items(records: DataFrame) -> DataFrame:
    """(doc_id, item_no, warning) of line items that are no objects."""
    return _noted(records, "bad_line_item", "item_no").withColumn("item_no", F.col("item_no").cast("int"))


def _noted(records: DataFrame, kind: str, name: str) -> DataFrame:
    found = explode(records, ["doc_id"], F.filter("notes", lambda n: n["kind"] == kind), "n")
    return found.select("doc_id", F.col("n.about").alias(name), F.col("n.text").alias("warning"))


def record_fields(records: DataFrame) -> DataFrame:
    """(doc_id, name, value, extraction_method): fields in long form, nulls kept."""
    return explode(
        records, ["doc_id", "extraction_method"], F.map_entries("fields"), "f"
    ).select("doc_id", F.col("f.key").alias("name"), "f.value", "extraction_method")


def record_items(records: DataFrame) -> DataFrame:
    """(doc_id, item_no, name, value): line items in long form."""
    items = explode(records, ["doc_id"], "line_items", "item", pos="item_no")
    return explode(items, ["doc_id", "item_no"], F.map_entries("item"), "f").select(
        "doc_id", "item_no", F.col("f.key").alias("name"), "f.value"
    )


def _sentences() -> Column:
    """All warnings of a record with their kind; those of the model itself are of kind 'model'."""
    own = F.slice("warnings", F.lit(1), F.size("warnings") - F.size("notes"))
    return F.concat(
        F.transform(own, lambda w: F.struct(F.lit("model").alias("category"), w.alias("warning"))),
        F.transform("notes", lambda n: F.struct(n["kind"].alias("category"), n["text"].alias("warning"))),
    )


def record_warnings(records: DataFrame) -> DataFrame:
    """(doc_id, warning_no, category, warning) for review."""
    return explode(records, ["doc_id"], _sentences(), "w", pos="warning_no").select(
        "doc_id", "warning_no", "w.category", "w.warning"
    )


def read_answers(responses: DataFrame, schemas: Schemas, documents: DataFrame | None = None) -> DataFrame:
    """The record each answer gives by itself, with its place, ``valid`` and ``silent`` (no text); written once.

    A document asked for in several requests has several answers; they carry the ``part_no`` and ``request_no`` of
    their request, others are at 0, 0. An invalid answer has no fields, items or warnings. With ``documents`` only
    their answers count, and tell how many ``answers`` their document has; parsing comes first, in the pieces the
    answers were read in.
    """
    places = [c if c in responses.columns else F.lit(0).alias(c) for c in PLACE]
    kind = [] if isinstance(schemas, Schema) else ["document_type"]
    placed = responses.select("doc_id", *kind, "raw", *places).withColumns({c: F.col(c).cast("int") for c in PLACE})
    parsed = _parsed(_typed(placed, schemas)).withColumn("silent", F.col("raw").isNull())
    found = _judged(parsed, schemas, keep=(*PLACE, "silent")).drop("missing")
    if documents is not None:
        counts = responses.groupBy("doc_id").agg(F.count(F.lit(1)).alias("answers"))
        # Parsed answers are far larger than the optimizer's guess, which would broadcast them.
        found = found.join(documents.select("doc_id").distinct().join(counts, "doc_id").hint("merge"), "doc_id")
    return written(found, "answers")


def _values(valid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The value that counts per document and field, and the others: (doc_id, name, value, place, blank).

    A value counts if it is not blank, and of those the one that was answered first. Equal values are one.
    """
    rows = explode(valid, ["doc_id", F.struct(*PLACE).alias("place")], F.map_entries("fields"), "f")
    told = rows.select("doc_id", F.col("f.key").alias("name"), F.col("f.value").alias("value"), "place")
    values = told.groupBy("doc_id", "name", "value").agg(F.min("place").alias("place"))
    values = written(values.withColumn("blank", F.coalesce(is_blank(F.col("value")), F.lit(True))), "values")
    best = values.groupBy("doc_id", "name").agg(F.min(F.struct("blank", "place", "value")).alias("best"))
    others = values.filter("NOT blank").join(best, ["doc_id", "name"]).filter(F.col("place") != F.col("best.place"))
    return best.select("doc_id", "name", "best.*"), others.select("doc_id", "name", "value", "place", F.col("best.value").alias("kept"))


def _findings(told: DataFrame, best: DataFrame, others: DataFrame, schemas: Schemas) -> DataFrame:
    """Warnings of merged records: doc_id, rank (its kind's turn), place, pos, category, text.

    A sentence or an unexpected field that several answers have is told once, where it stood first. Every further
    value of a field is a conflict, every answer of a record's document that is none a failure.
    """
    place, valid = F.struct(*PLACE).alias("place"), told.filter("valid")

    def rows(df: DataFrame, rank: int, at: Column | str, pos: Column, category: Column | str, text: Column) -> DataFrame:
        at = F.col(at) if isinstance(at, str) else at
        return df.select("doc_id", F.lit(rank).alias("rank"), at.alias("place"), pos.cast("int").alias("pos"), (F.lit(category) if isinstance(category, str) else category).alias("category"), text.alias("text"))

    own = explode(valid, ["doc_id", place], "own", "text", pos="pos").groupBy("doc_id", "text").agg(F.min(F.struct("place", "pos")).alias("first"))
    notes = explode(valid, ["doc_id", place], "others", "n", pos="pos").select("doc_id", "place", "pos", "n.*")
    once = F.when(F.col("kind") == "bad_line_item", F.col("place"))  # each skipped item is told
    notes = notes.groupBy("doc_id", "kind", "about", "text", once.alias("once")).agg(F.min(F.struct("place", "pos")).alias("first"))
    filled = best.filter("NOT blank").groupBy("doc_id").agg(F.collect_set("name").alias("filled"))  # names of the schema
    kinds = valid.groupBy("doc_id").agg(F.first("document_type").alias("_type")).join(filled, "doc_id", "left")
    lacking = kinds.withColumn("needed", _by_type(schemas, lambda s: s.required))
    lacking = explode(lacking, ["doc_id"], F.array_except("needed", F.coalesce("filled", F.array().cast(STRINGS))), "name", pos="pos")
    start = F.struct(*[F.lit(0).alias(c) for c in PLACE])
    failed = told.filter("NOT valid").join(valid.select("doc_id").distinct(), "doc_id", "left_semi")
    quoted = lambda c: F.concat(F.lit("'"), F.col(c), F.lit("'"))
    differs = F.concat(F.lit("Field "), quoted("name"), F.lit(" differs between answers: "), quoted("kept"), F.lit(" kept, "), quoted("value"), F.lit(" dropped"))
    return (
        rows(own, 0, "first.place", F.col("first.pos"), "model", F.col("text"))
        .unionByName(rows(lacking, 1, start, F.col("pos"), "missing_required", _lacks(F.col("name"))))
        .unionByName(rows(notes.filter("kind = 'unexpected_field'"), 2, "first.place", F.col("first.pos"), "unexpected_field", F.col("text")))
        .unionByName(rows(notes.filter("kind = 'bad_line_item'"), 3, "first.place", F.col("first.pos"), "bad_line_item", F.col("text")))
        .unionByName(rows(others, 4, "place", F.lit(0), "conflict", differs))
        .unionByName(rows(failed, 5, place, F.lit(0), "model_failure", _failure("silent")))
    )


def _failure(silent: str) -> Column:
    # The two wordings.
    return F.when(F.col(silent), "LLM call failed: no response").otherwise("LLM returned invalid JSON")


HEAD = "array<struct<a:int,key:string,value:string>>"
ROW = "doc_id", "kind", *PLACE, "a", "b", "key", "value"


def _shared(told: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """The answers that are their document's only ones, and those of documents with several.

    Where answers were not counted, all are taken as one of several.
    """
    if "answers" not in told.columns:
        return None, told
    return told.filter("answers = 1"), told.filter("answers > 1")


def _merged(told: DataFrame, schemas: Schemas) -> DataFrame:
    """The rows of all records without their heads. A document's only answer is its record, nothing has to be brought
    together for it."""
    alone, several = _shared(told)
    rows = _merged_rows(several, schemas)
    return rows if alone is None else _rows_of(alone.filter("valid"), schemas).unionByName(rows)


def _rows_of(alone: DataFrame, schemas: Schemas) -> DataFrame:
    """What ``_merged_rows`` says of documents with one answer, from that answer's row."""
    kind, zero = lambda name: F.lit(name).alias("kind"), F.lit(0)
    filled = F.map_keys(F.map_filter("fields", lambda _, x: ~F.coalesce(is_blank(x), F.lit(True))))
    lacking = F.array_except(_by_type(schemas, lambda s: s.required), filled)
    said = lambda category, text, at: F.struct(category.alias("key"), text.alias("value"), *[p.alias(c) for c, p in zip(PLACE, at)])
    place = [F.col(c) for c in PLACE]
    findings = F.concat(
        F.transform(F.array_distinct("own"), lambda w: said(F.lit("model"), w, place)),
        F.transform(lacking, lambda n: said(F.lit("missing_required"), _lacks(n), [zero for _ in PLACE])),
        F.transform("others", lambda n: said(n["kind"], n["text"], place)),
    )
    fields = explode(alone, ["doc_id", *PLACE], F.sort_array(F.map_entries("fields")), "e", pos="a")
    items = explode(explode(alone, ["doc_id", *PLACE], "line_items", "item", pos="a"), ["doc_id", *PLACE, "a"], F.map_entries("item"), "e", pos="b")
    warnings = explode(alone.withColumn("_type", F.col("document_type")), ["doc_id"], findings, "w", pos="a")
    return (
        fields.select("doc_id", kind("field"), *PLACE, "a", zero.alias("b"), "e.key", "e.value")
        .unionByName(items.select("doc_id", kind("item"), *PLACE, "a", "b", "e.key", "e.value"))
        .unionByName(warnings.select("doc_id", kind("warning"), *[f"w.{c}" for c in PLACE], "a", zero.alias("b"), "w.key", "w.value"))
    )


def _merged_rows(told: DataFrame, schemas: Schemas) -> DataFrame:
    best, others = _values(told.filter("valid"))
    place = F.struct(*PLACE).alias("place")
    rank = Window.partitionBy("doc_id").orderBy("name")  # at most the fields of the schema
    fields = best.select("doc_id", F.lit("field").alias("kind"), "place.*", (F.row_number().over(rank) - 1).alias("a"), F.lit(0).alias("b"), F.col("name").alias("key"), "value")
    no_item, no_text = F.lit(None).cast("map<string,string>"), F.lit(None).cast("string")
    items = explode(told.filter("valid"), ["doc_id", place], "line_items", "item", pos="pos")
    found = _findings(told, best, others, schemas)
    long = items.select("doc_id", F.lit("item").alias("kind"), F.lit(0).alias("rank"), "place.*", "pos", no_text.alias("category"), no_text.alias("text"), "item").unionByName(
        found.select("doc_id", F.lit("warning").alias("kind"), "rank", "place.*", "pos", "category", "text", no_item.alias("item"))
    )
    # Of a block there are the answers to one part's requests.
    numbered = number_rows(written(long, "findings"), ["doc_id", "kind"], {"rank": F.col("rank"), "part": F.col("part_no")}, ["rank", *PLACE, "pos", "text"])
    cell = F.struct(F.col("category").alias("key"), F.col("text").alias("value"))
    cells = F.when(F.col("kind") == "warning", F.array(cell)).otherwise(F.transform(F.map_entries("item"), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))
    rows = explode(numbered, ["doc_id", "kind", *PLACE, (F.col("rn") - 1).cast("int").alias("a")], cells, "c", pos="b")
    return fields.select(*ROW).unionByName(rows.select("doc_id", "kind", *PLACE, "a", "b", "c.*").select(*ROW))


def _heads(told: DataFrame) -> DataFrame:
    """(doc_id, valid, document_type, confidence, silent) per answered document; the least confidence counts."""
    alone, several = _shared(told)
    rated = F.when(F.col("valid"), F.col("confidence"))
    heads = several.groupBy("doc_id").agg(
        F.max("valid").alias("valid"),
        F.first("document_type").alias("document_type"),
        F.min(rated).alias("confidence"),
        F.min("silent").alias("silent"),
    )
    return heads if alone is None else alone.select("doc_id", "valid", "document_type", rated.alias("confidence"), "silent").unionByName(heads)


def _head_rows(heads: DataFrame) -> DataFrame:
    valid, row = F.col("valid"), lambda a, key, value: F.struct(F.lit(a).alias("a"), F.lit(key).alias("key"), value.alias("value"))
    told = F.array(
        row(0, "extraction_method", F.when(valid, "llm").otherwise("heuristic")),
        row(1, "document_type", F.when(valid, F.col("document_type")).otherwise("unknown")),
        row(2, "confidence", F.when(valid, F.col("confidence").cast("string"))),
    )
    failure = F.struct(F.lit(LATE).alias("a"), F.lit("model_failure").alias("key"), _failure("silent").alias("value"))
    rows = explode(heads, ["doc_id"], F.concat(told, F.when(valid, F.array().cast(HEAD)).otherwise(F.array(failure))), "r")
    kind = F.when(F.col("r.a") == LATE, "warning").otherwise("record")
    return rows.select("doc_id", kind.alias("kind"), *[F.lit(0).alias(c) for c in PLACE], "r.a", F.lit(0).alias("b"), "r.key", "r.value")


def merged_records(responses: DataFrame, schemas: Schemas) -> DataFrame:
    """One record per document from the answers to all its requests, in long form.

    Columns: doc_id, kind, part_no, request_no (whose answer it is from), a, b, key, value. Per kind: 'record' tells
    method, type and confidence (the least of the answers'), 'field' the first value that is not blank, 'item' the
    items of all answers in order (a numbers them, b their columns), 'warning' what ``_findings`` says, in order of
    kind, place and position. The result does not hang on the order of rows. Documents without a valid answer
    have no record.
    """
    told = read_answers(responses, schemas)
    return _merged(told, schemas).unionByName(_head_rows(_heads(told).filter("valid")))


def record_with_fallback(
    documents: DataFrame,
    responses: DataFrame,
    heuristic: Callable[[DataFrame], DataFrame],
    schemas: Schemas,
) -> DataFrame:
    """Whole records of all documents in long form: the model's if an answer is valid, else the heuristic one.

    If there are several schemas, the answers carry their ``document_type``, or else the documents. Answers of one
    document are merged (``merged_records``). ``heuristic`` gets the (doc_id) of the documents that fall back and returns their rows
    (doc_id, kind, page_number, a, b, key, value), kind being 'field', 'item' or 'warning'; no other document is
    parsed. Result rows have the same columns, with kind 'record' for three rows per document that hold its method,
    type and confidence, and the failure as its last warning.
    """
    keep = ["doc_id"] if isinstance(schemas, Schema) else ["doc_id", "document_type"]
    # Read for the answers that count and for the heads.
    known = written(documents.select(*keep), "documents")
    if "document_type" in keep and "document_type" not in responses.columns:
        responses = responses.join(known, "doc_id")
    told = read_answers(responses, schemas, known)
    heads = known.select("doc_id").join(_heads(told), "doc_id", "left")
    # Read by the rows of the record and by those of the heuristic.
    heads = written(heads.withColumns({"valid": F.coalesce("valid", F.lit(False)), "silent": F.coalesce("silent", F.lit(True))}), "heads")
    page = F.lit(0).alias("page_number")
    out = _merged(told, schemas).unionByName(_head_rows(heads)).select("doc_id", "kind", page, "a", "b", "key", "value")
    fallen = heuristic(heads.filter("NOT valid").select("doc_id"))
    return out.unionByName(fallen.select(*out.columns))


def raw_responses(responses: DataFrame) -> DataFrame:
    """(doc_id, raw, raw_json, valid): the raw text kept next to its parse flag."""
    return parse_responses(responses).select(
        "doc_id",
        "raw",
        F.to_json(F.struct("raw")).alias("raw_json"),
        "valid",
    )


RECORD = "document_type string, fields map<string,string>, line_items array<map<string,string>>, confidence double, warnings array<string>, extraction_method string"


def record_artifacts(records: DataFrame) -> DataFrame:
    """(doc_id, json): each record as one JSON text."""
    columns = [c.split()[0] for c in RECORD.split(", ")]
    return records.select("doc_id", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("json"))


def read_record_artifacts(artifacts: DataFrame) -> DataFrame:
    """The records of (doc_id, json) rows."""
    return artifacts.select("doc_id", F.from_json("json", RECORD).alias("r")).select("doc_id", "r.*")


def _with_files(records: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows of records with the ``source_file`` of their document, joined by shuffle.

    How large parsed rows are is unknown before they are parsed, and the optimizer's guess is far too low: it would
    broadcast all of them.
    """
    return records.join(documents.select("doc_id", "source_file").hint("merge"), "doc_id")


def review_status(records: DataFrame) -> Column:
    low = F.col("confidence").isNull() | (F.col("confidence") < REVIEW_BELOW)
    return F.when((F.size("warnings") > 0) | low, "needs_review").otherwise("ok")


def summary_wide(records: DataFrame, documents: DataFrame, schema: Schema) -> DataFrame:
    """One row per record: file name, type, a column per schema field, confidence, review status."""
    return _with_files(records, documents).select(
        F.col("source_file").alias("file_name"),
        "document_type",
        *[F.try_element_at("fields", F.lit(n)).alias(n) for n in schema.names],
        "confidence",
        review_status(records).alias("review_status"),
    )


def line_items_wide(
    records: DataFrame, documents: DataFrame, schema: Schema, parent: str
) -> DataFrame:
    """One row per line item: file, document, the parent field, a column per item field."""
    items = explode(
        records,
        ["doc_id", F.try_element_at("fields", F.lit(parent)).alias(parent)],
        "line_items",
        "item",
        pos="item_no",
    )
    return _with_files(items, documents).select(
        F.col("source_file").alias("file_name"),
        F.col("doc_id").alias("document_id"),
        parent,
        "item_no",
        *[F.try_element_at("item", F.lit(n)).alias(n) for n in schema.item_names],
    )


def by_letter(wide: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """A sheet laid out by a template: columns A, B, ... up to the last letter that ``mapping`` names.

    ``mapping`` gives the column of ``wide`` for a letter (AA follows Z);
    letters without one, and columns ``wide`` lacks, are empty texts.
    """
    def number(letters: str) -> int:
        n = 0
        for c in letters.upper():
            n = n * 26 + ord(c) - 64
        return n

    def letters(n: int) -> str:
        out = ""
        while n:
            n, rest = divmod(n - 1, 26)
            out = chr(65 + rest) + out
        return out

    placed = {number(k): v for k, v in mapping.items()}
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in wide.columns else F.lit("")
    return wide.select(*[cell(placed.get(n, "")).alias(letters(n)) for n in range(1, max(placed, default=0) + 1)])
