"""Requests for an external model: per page, and per document for a record of its type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions.rows import explode
from docframe.functions.text import is_blank
from docframe.operators.parts import gathered
from docframe.operators.tables import column_names
from docframe.session import written
from docframe.sources.schemas import Schema

PAGES_PER_PART = 1000
CHARS_PER_REQUEST = 32_000

FRONT_MATTER_WANTED = "Begin with YAML front matter: titolo, comune, tipo, anno."
FRONT_MATTER_UNWANTED = "Write no front matter, this is a later page."


def page_prompts(pages: DataFrame) -> DataFrame:
    """(doc_id, page_number, prompt): the request for each page.

    Pages that carry their document's ``page_count`` are not shuffled.
    """
    if "page_count" in pages.columns:
        counted = pages.withColumn("total", F.col("page_count"))
    else:
        counted = pages.join(pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total")), "doc_id")
    wish = F.when(F.col("page_number") == 1, FRONT_MATTER_WANTED).otherwise(FRONT_MATTER_UNWANTED)
    return counted.select(
        "doc_id",
        "page_number",
        F.concat(
            F.lit("Page "), F.col("page_number").cast("string"),
            F.lit(" of "), F.col("total").cast("string"),
            F.lit(". Turn the page text between the marks into Markdown by the given rules. "),
            wish,
            F.lit("\n\n<<<PAGE\n"), "text", F.lit("\nPAGE>>>"),
        ).alias("prompt"),
    )


def _table_text() -> Column:
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    rule = line(F.transform("names", lambda c: F.lit("---")))
    lines = F.concat(F.array(line(F.col("names")), rule), F.transform("rows", line))
    return F.concat(
        F.lit("\n[Table "), F.col("table_idx").cast("string"), F.lit("]\n"), F.array_join(lines, "\n")
    )


def document_text(
    pages: DataFrame, tables: DataFrame, pages_per_part: int = PAGES_PER_PART, together: bool = False
) -> DataFrame:
    """(doc_id, part_no, text): non-blank page texts, then the numbered tables, all of both.

    A document of up to ``pages_per_part`` pages is one part. A longer one comes
    in parts of so many pages, each followed by its own tables, so text is
    shuffled once and no group grows with a document. Documents of bounded size
    whose pages lie ``together``, their tables with them, are not shuffled.
    """
    part = F.floor((F.col("page_number") - 1) / pages_per_part).cast("int").alias("part_no")
    piece = lambda at, text: F.struct(F.col(at).cast("long").alias("at"), text.alias("piece"))
    texts = pages.select("doc_id", part, F.when(~is_blank(F.col("text")), piece("page_number", F.col("text"))).alias("item"))
    named = tables.filter(F.size("rows") > 0).withColumn("names", column_names())
    found = named.select("doc_id", part, piece("table_idx", _table_text()).alias("item"))
    pieces = F.concat(F.sort_array("first"), F.sort_array("second"))
    return gathered(texts, found, together).select(
        "doc_id", "part_no", F.array_join(F.transform(pieces, lambda p: p["piece"]), "\n\n").alias("text")
    )


def cut_text(parts: DataFrame, max_chars: int, separator: str = "\n\n", together: bool = False) -> DataFrame:
    """(doc_id, part_no, text): the first ``max_chars`` characters of each document, for callers who ask for a cut.

    The parts are written once; only their lengths are brought into order, and
    what lies beyond the cut is not shuffled. Of documents of bounded size whose
    parts lie ``together`` they are cut where they are, unwritten.
    """
    before = Window.partitionBy("doc_id").orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.col("n") + len(separator)).over(before), F.lit(0))
    room = (F.lit(max_chars) - used).cast("int").alias("room")
    n, head = F.length("text").alias("n"), F.substring("text", 1, max_chars).alias("text")
    if together:
        placed = parts.filter("doc_id IS NOT NULL AND part_no IS NOT NULL")
        cut = placed.select("doc_id", "part_no", head, n).select("doc_id", "part_no", "text", room)
    else:
        parts = written(parts, "parts")
        starts = parts.select("doc_id", "part_no", n).select("doc_id", "part_no", room).filter("room > 0")
        cut = parts.select("doc_id", "part_no", head).join(starts, ["doc_id", "part_no"])
    return cut.filter("room > 0").select("doc_id", "part_no", F.substring("text", F.lit(1), F.col("room")).alias("text"))


def requests(parts: DataFrame, chars: int = CHARS_PER_REQUEST, lines: bool = False) -> DataFrame:
    """The parts with ``request_no`` and ``text`` cut into pieces of at most ``chars`` characters, none left out.

    With ``lines`` a piece ends behind the last line end it has room for, so no word or table row is cut; where it
    has none it ends behind the last white space, and only a longer word is cut. Pieces joined are the text.
    """
    others = [c for c in parts.columns if c != "text"]
    if lines:
        n = max(1, chars)
        piece = rf"(?s).{{1,{n}}}\z|.{{0,{n - 1}}}\n|.{{0,{n - 1}}}\s|.{{1,{n}}}"
        pieces = F.when(F.length("text") > 0, F.regexp_extract_all("text", F.lit(piece), F.lit(0))).otherwise(F.array(F.lit("")))
        return explode(parts, others, pieces, "text", pos="request_no").select(*others, "request_no", "text")
    n = F.greatest(F.lit(1), F.ceil(F.length("text") / chars)).cast("int")
    cut = parts.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("request_no"))
    return cut.select(*others, "request_no", F.substring("text", F.col("request_no") * chars + 1, F.lit(chars)).alias("text"))


def _columns_table(heading: str, columns: Iterable) -> list[str]:
    rows = [f"| {c.name} | {c.type} | {'required' if c.required else ''} | {c.note} |" for c in columns]
    return [heading, "| key | type | must | meaning |", "| --- | --- | --- | --- |", *rows, ""] if rows else []


def instructions(schema: Schema) -> str:
    """What a model is told to make of a document of this type: the columns as tables, then the keys to answer with."""
    keys = "{" + ", ".join(f'"{n}": null' for n in schema.names) + "}"
    items = "[{" + ", ".join(f'"{n}": null' for n in schema.item_names) + "}]" if schema.items else "[]"
    return "\n".join([
        f"Make a record of type {schema.document_type} from the text after the last line of this request."
        + (f" Such a document is: {schema.about}." if schema.about else ""),
        "",
        *_columns_table("Fields, each once:", schema.fields),
        *_columns_table("Line items, as many as there are:", schema.items),
        "Answer with nothing but one JSON object that has these keys; a value the text does not state stays null,",
        "confidence lies between 0 and 1, and warnings are short sentences:",
        f'{{"document_type": "{schema.document_type}", "fields": {keys}, "line_items": {items}, "confidence": null, "warnings": []}}',
        "----",
    ])


def schema_prompts(texts: DataFrame, schemas: dict[str, Schema], document_type: Column | str = "document_type") -> DataFrame:
    """(doc_id, part_no, request_no, prompt): the request of each piece of text for a record of the document's type.

    The instructions of all types are literals, so nothing is joined; pieces of
    an unknown type get no request.
    """
    kind = F.col(document_type) if isinstance(document_type, str) else document_type
    told = F.create_map(*[F.lit(x) for name, s in schemas.items() for x in (name, instructions(s))])
    asked = texts.select("*", F.try_element_at(told, kind).alias("_told")).filter(F.col("_told").isNotNull())
    return asked.select("doc_id", "part_no", "request_no", F.concat("_told", F.lit("\n"), "text").alias("prompt"))


def is_retryable(message: Column) -> Column:
    """Quota errors are final, everything else may be tried again."""
    return ~(message.contains("429") | message.contains("RESOURCE_EXHAUSTED"))
