"""Tables found in pages: import, header detection, numbering, row forms.

A table belongs to one page, so (doc_id, page_number, page_table) identifies it
without looking at other pages. A table's raw rows travel as one array, bounded
by the page they stand on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions.rows import computed, explode
from docframe.functions.text import (
    BLANKS,
    PIECE,
    TABLE_SEPARATOR,
    WS_CLASS,
    file_stem,
    is_blank,
    table_cells,
    unix_lines,
    ustrip,
    without_outer_pipes,
)
from docframe.operators.ordered import BLOCK, running_totals
from docframe.session import written

KEY = ("doc_id", "page_number", "page_table")
CONFIDENCE = 0.9


# A separator line before stripping.
LOOSE_SEPARATOR = rf"\A[{WS_CLASS}]*+\|[{WS_CLASS}\-:|]+\|[{WS_CLASS}\-:|]*\z"
CONTENT = rf"[^|{WS_CLASS}]"


def _is_content(line: Column) -> Column:
    return line.rlike(CONTENT) & ~line.rlike(LOOSE_SEPARATOR)


def _is_pipe_line(line: Column) -> Column:
    return line.startswith("|") | F.ltrim(line, F.lit(BLANKS)).startswith("|")


def table_runs(text: Column) -> Column:
    """Maximal runs of pipe lines, each one text.

    All other lines become piece marks. Runs of separator and empty lines only
    are no tables.
    """
    marked = F.transform(F.split(unix_lines(text), "\n"), lambda s: F.when(_is_pipe_line(s), s).otherwise(PIECE))
    return F.filter(
        F.split(F.array_join(marked, "\n"), PIECE),
        lambda r: r.contains("|") & F.exists(F.split(r, "\n"), _is_content),
    )


def run_lines(run: Column) -> Column:
    return F.filter(F.transform(F.split(run, "\n"), ustrip), lambda s: s != "")


def is_ragged(run: Column) -> Column:
    """Whether the rows of a run of pipe lines differ in width."""
    content = F.filter(run_lines(run), lambda s: ~s.rlike(TABLE_SEPARATOR))
    widths = F.transform(
        content, lambda s: F.size(F.split(without_outer_pipes(s), r"\|"))
    )
    return F.size(F.array_distinct(widths)) > 1


def import_markdown_tables(
    pages: DataFrame, text: str = "md", keep: Sequence[str] = ()
) -> DataFrame:
    """Pipe tables of Markdown pages.

    Columns: KEY, the page columns in ``keep``, has_separator (a separator
    follows the first row), raw_rows.
    """
    place = ["doc_id", "page_number", *keep]
    found = explode(pages, place, table_runs(F.col(text)), "run", pos="_pos")
    return tables_of(found.select(*place, (F.col("_pos") + 1).alias("page_table"), "run"), keep)


def tables_of(runs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Tables of (KEY, run) rows, a run of pipe lines each."""
    run = computed(runs, lines=run_lines(F.col("run")))
    first, second = F.get("lines", F.lit(0)), F.get("lines", F.lit(1))
    content = F.filter("lines", lambda s: ~s.rlike(TABLE_SEPARATOR))
    return run.select(
        *KEY,
        *keep,
        (F.coalesce(second.rlike(TABLE_SEPARATOR), F.lit(False)) & ~first.rlike(TABLE_SEPARATOR)).alias(
            "has_separator"
        ),
        F.transform(content, table_cells).alias("raw_rows"),
    )


def _numeric(cell: Column) -> Column:
    return F.translate(cell, ".,-", "").rlike(r"\A\p{Nd}+\z")


def is_header_row(row: Column) -> Column:
    """Fewer than half of the non-empty cells are numbers, and there are some."""
    filled = F.filter(row, lambda c: ustrip(c) != "")
    return (F.size(filled) > 0) & (F.size(F.filter(filled, _numeric)) * 2 < F.size(filled))


def detect_header(tables: DataFrame, stripped: bool = False) -> DataFrame:
    """Turn raw rows into ``columns`` (null without header) and data ``rows``.

    Cells that ``tables_of`` found are ``stripped`` and never null.
    """
    text = F.col("raw_rows") if stripped else F.transform(
        "raw_rows", lambda r: F.transform(r, lambda c: ustrip(F.coalesce(c, F.lit(""))))
    )
    kept = computed(tables, _kept=F.filter(text, lambda r: F.exists(r, lambda c: c != "")))
    kept = kept.filter(F.size("_kept") > 0)
    first = F.get("_kept", F.lit(0))
    given = F.col("has_separator") if "has_separator" in tables.columns else F.lit(False)
    kept = computed(kept, _header=given | ((F.size("_kept") > 1) & is_header_row(first)))
    others = [c for c in tables.columns if c not in (*KEY, "has_separator", "raw_rows")]
    return kept.select(
        *KEY,
        *others,
        F.when(F.col("_header"), first).alias("columns"),
        F.when(F.col("_header"), F.slice("_kept", F.lit(2), F.size("_kept")))
        .otherwise(F.col("_kept"))
        .alias("rows"),
        F.lit(CONFIDENCE).alias("confidence"),
    )


def column_names() -> Column:
    """Header cells, or col_0.. after the width of the first row; empty without rows."""
    width = F.size(F.get("rows", F.lit(0)))
    positional = F.transform(
        F.sequence(F.lit(1), F.greatest(width, F.lit(1))), lambda i: F.concat(F.lit("col_"), i - 1)
    )
    return (
        F.when(F.size("rows") == 0, F.array().cast("array<string>"))
        .when(F.size("columns") > 0, F.col("columns"))
        .when(width > 0, positional)
        .otherwise(F.array().cast("array<string>"))
    )


def numbered_tables(tables: DataFrame, block: int = BLOCK, together: bool = False) -> DataFrame:
    """Tables with ``table_idx``, 1-based per document in page order, and ``table_id``.

    The parsed tables are written once; only (document, page, number of tables)
    rows are brought into order, in blocks of pages, and the tables meet their
    page's start by (doc_id, page_number). Of documents of bounded size whose
    pages lie ``together`` the tables are numbered where they are, unwritten.
    """
    if together:
        in_document = Window.partitionBy("doc_id").orderBy("page_number", "page_table")
        placed = tables.filter("doc_id IS NOT NULL AND page_number IS NOT NULL")
        return _identified(placed.withColumn("table_idx", F.row_number().over(in_document)))
    tables = written(tables, "tables")
    slim = tables.groupBy("doc_id", "page_number").agg(F.count(F.lit(1)).alias("n"))
    starts = running_totals(slim, ["doc_id"], "page_number", ["n"], block)
    on_page = Window.partitionBy("doc_id", "page_number").orderBy("page_table")
    joined = tables.join(starts, ["doc_id", "page_number"]).withColumn(
        "table_idx", (F.row_number().over(on_page) + F.col("n_before")).cast("int")
    )
    return _identified(joined.drop("n_before"))


def _identified(numbered: DataFrame) -> DataFrame:
    text = F.concat_ws("#", F.col("doc_id").cast("string"), F.col("table_idx").cast("string"))
    return numbered.withColumn("table_id", F.substring(F.md5(text), 1, 8))


def spanning_tables(pages: DataFrame, text: str = "md", block: int = BLOCK) -> DataFrame:
    """Tables that run over pages: (doc_id, table_no, page_number, page_table, first_row, header, rows).

    A table goes on where a page ends with pipe lines, the next page begins with some, their rows are equally wide,
    and the next page repeats the header or has none. One row per fragment; those of a table share ``table_no``
    (from 1 per document) and the header of the first, a repeated header is no row, and ``first_row`` counts the
    table's rows on earlier pages. Pages are read once and only borders, counts and headers are brought together;
    the number of a table is how many began so far, so chains of any length are found without following them.
    """
    place = lambda at: F.regexp_replace(F.col(text), r"\A\s+|\s+\z", "").rlike(at)
    marked = pages.withColumns({"_top": place(r"\A\|"), "_bottom": place(r"(?:\A|\n)[^\S\n]*\|[^\n]*\z")})
    raw = written(import_markdown_tables(marked, text, keep=("_top", "_bottom")), "fragments")
    first = F.coalesce(F.get("raw_rows", F.lit(0)), F.array().cast("array<string>"))
    on_page = Window.partitionBy("doc_id", "page_number").orderBy("page_table")
    whole_page = Window.partitionBy("doc_id", "page_number")
    slim = raw.select(
        *KEY, "_top", "_bottom", "has_separator", F.transform(first, ustrip).alias("first"), F.size("raw_rows").alias("n"),
        (F.row_number().over(on_page) == 1).alias("is_first"), (F.col("page_table") == F.max("page_table").over(whole_page)).alias("is_last"),
    )
    ends = slim.filter("is_last AND _bottom").select(
        "doc_id", (F.col("page_number") + 1).alias("page_number"), F.col("first").alias("above"), F.col("has_separator").alias("titled")
    )
    met = slim.join(ends, ["doc_id", "page_number"], "left")
    repeated = F.col("has_separator") & F.col("titled") & (F.col("above") == F.col("first"))
    goes_on = F.coalesce(F.col("is_first") & F.col("_top") & (F.size("above") == F.size("first")) & (~F.col("has_separator") | repeated), F.lit(False))
    named = F.col("has_separator") | ((F.col("n") > 1) & is_header_row(F.col("first")))
    judged = met.select(*KEY, goes_on.alias("goes_on"), F.when(~goes_on & named, F.col("first")).alias("own"), (~goes_on).cast("int").alias("starts"),
                        (F.col("n") - F.when(F.when(goes_on, F.col("has_separator")).otherwise(named), 1).otherwise(0)).cast("long").alias("n"))
    judged = written(judged, "borders")
    totals = judged.groupBy("doc_id", "page_number").agg(F.sum("starts").alias("starts"), F.sum("n").alias("n"))
    before = running_totals(totals, ["doc_id"], "page_number", ["starts", "n"], block)
    earlier = on_page.rowsBetween(Window.unboundedPreceding, -1)
    numbered = judged.join(before, ["doc_id", "page_number"]).select(
        *KEY, "goes_on", "own",
        (F.col("starts_before") + F.sum("starts").over(on_page)).cast("int").alias("table_no"),
        (F.col("n_before") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("at"),
    )
    begun = numbered.filter("NOT goes_on").select("doc_id", "table_no", F.col("own").alias("header"), F.col("at").alias("begun_at"))
    found = numbered.join(begun, ["doc_id", "table_no"]).select(*KEY, "table_no", "header", (F.col("at") - F.col("begun_at")).alias("first_row"), "goes_on")
    skipped = F.when(F.col("goes_on"), F.col("has_separator")).otherwise(F.col("header").isNotNull())
    rows = F.transform("raw_rows", lambda r: F.transform(r, lambda c: ustrip(F.coalesce(c, F.lit("")))))
    return raw.join(found, list(KEY)).select(
        "doc_id", "table_no", "page_number", "page_table", "first_row", "header",
        F.when(skipped, F.slice(rows, F.lit(2), F.size("raw_rows"))).otherwise(rows).alias("rows"),
    )


def table_numbering(tables: DataFrame) -> DataFrame:
    """KEY, table_idx, table_id."""
    return numbered_tables(tables).select(*KEY, "table_idx", "table_id")


def table_rows(tables: DataFrame) -> DataFrame:
    """One line per data row, row_index counted from 0 per table."""
    others = [c for c in tables.columns if c != "rows"]
    return explode(tables, others, "rows", "cells", pos="row_index")


def _pairs(names: Column, cells: Column) -> Column:
    n = F.least(F.size(names), F.size(cells))
    return F.zip_with(
        F.slice(names, F.lit(1), n),
        F.slice(cells, F.lit(1), n),
        lambda k, v: F.struct(k.alias("key"), v.alias("value")),
    )


def rows_to_dicts(tables: DataFrame) -> DataFrame:
    """(KEY, row_index, pos, key, value): rows as key-value pairs, the last of equal names counts."""
    named = tables.select(*KEY, column_names().alias("names"), "rows")
    unique = F.size(F.array_distinct("names")) == F.size("names")
    cells = table_rows(named.select(*KEY, "names", unique.alias("unique"), "rows"))
    cells = computed(cells, pairs=_pairs(F.col("names"), F.col("cells")))
    last = F.filter(
        "pairs",
        lambda p, i: F.col("unique")
        | ~F.exists(F.slice("pairs", i + 2, F.size("pairs")), lambda q: q["key"] == p["key"]),
    )
    return explode(cells, [*KEY, "row_index"], last, "p", pos="pos").select(
        *KEY, "row_index", "pos", "p.key", "p.value"
    )


def table_to_markdown(tables: DataFrame) -> DataFrame:
    """(KEY, md): the raw rows as a pipe table, first row as header."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    text = F.transform(
        "raw_rows", lambda r: F.transform(r, lambda c: ustrip(F.coalesce(c, F.lit(""))))
    )
    lines = F.transform(
        text,
        lambda r, i: F.when(
            i == 0, F.concat(line(r), F.lit("\n"), line(F.transform(r, lambda c: F.lit("---"))))
        ).otherwise(line(r)),
    )
    return tables.select(*KEY, F.array_join(lines, "\n").alias("md"))


def table_consistency(tables: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(KEY, n_rows, min_width, max_width, consistent, has_separator)."""
    widths = F.transform("raw_rows", lambda r: F.size(r))
    return tables.select(
        *KEY,
        *keep,
        F.size("raw_rows").alias("n_rows"),
        F.array_min(widths).alias("min_width"),
        F.array_max(widths).alias("max_width"),
        (F.array_min(widths) == F.array_max(widths)).alias("consistent"),
        "has_separator",
    )


def combined_table(tables: DataFrame) -> DataFrame:
    """All rows of all tables in one table; ``signature`` names the columns they share."""
    named = tables.select(*KEY, F.array_join(column_names(), "|").alias("signature"), "rows")
    return table_rows(named)


def padded(number: Column) -> Column:
    """At least three digits."""
    text = number.cast("string")
    return F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)


def table_csv_rows(numbered: DataFrame) -> DataFrame:
    """Rows of the per-table CSV files: file, row_index, page, header, cells.

    ``numbered`` tables carry ``source_file``. Tables without rows keep their
    number but get no file.
    """
    file = F.concat(
        file_stem(F.col("source_file")), F.lit("__table_"), padded(F.col("table_idx")), F.lit(".csv")
    )
    named = numbered.withColumn("header", column_names()).filter(F.size("header") > 0)
    return table_rows(named.withColumn("file", file)).select(
        "doc_id", "table_idx", "file", "row_index", F.col("page_number").alias("page"), "header", "cells"
    )


def csv_line(cells: Column) -> Column:
    """One line of a CSV file: cells with a comma, quote or line end are quoted."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    text = F.transform(cells, lambda c: F.coalesce(c, F.lit("")))
    return F.array_join(F.transform(text, lambda c: F.when(c.rlike('[",\\r\\n]'), quoted(c)).otherwise(c)), ",")


def table_csv_files(numbered: DataFrame) -> DataFrame:
    """(doc_id, table_idx, file, content): each table as a CSV text with its own header, the page before the cells.

    A table stands on one page, so its text is bounded by the page.
    """
    file = F.concat(
        file_stem(F.col("source_file")), F.lit("__table_"), padded(F.col("table_idx")), F.lit(".csv")
    )
    named = numbered.withColumn("header", column_names()).filter(F.size("header") > 0)
    page = F.col("page_number").cast("string")
    head = csv_line(F.concat(F.array(F.lit("page")), "header"))
    rows = F.transform("rows", lambda r: csv_line(F.concat(F.array(page), r)))
    return named.select(
        "doc_id", "table_idx", file.alias("file"),
        F.concat(F.array_join(F.concat(F.array(head), rows), "\n"), F.lit("\n")).alias("content"),
    )


def document_warnings(
    pages: DataFrame, tables: DataFrame, errors: DataFrame | None = None
) -> DataFrame:
    """(doc_id, code, message, page_number): empty documents and failed table searches."""
    with_text = pages.groupBy("doc_id").agg(F.max(~is_blank(F.col("text"))).alias("filled"))
    empty = (
        with_text.filter(~F.col("filled"))
        .join(tables.select("doc_id"), "doc_id", "left_anti")
        .select(
            "doc_id",
            # Code and message.
            F.lit("EMPTY_DOCUMENT").alias("code"),
            F.lit("No tables or text found — document may be image-only or encrypted").alias("message"),
            F.lit(None).cast("int").alias("page_number"),
        )
    )
    if errors is None:
        return empty
    return errors.select(
        "doc_id",
        F.lit("TABLE_EXTRACTION_ERROR").alias("code"),
        "message",
        F.col("page_number").cast("int").alias("page_number"),
    ).unionByName(empty)
