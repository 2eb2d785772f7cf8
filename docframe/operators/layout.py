"""Page layout: blocks outside tables, page text of layout items, extraction choice."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions.text import is_blank, ustrip
from docframe.session import written

TOLERANCE = 2.0
# The finest grid, the ratio of a level's cells to those below, and coordinates that no page reaches.
CELL = 256.0
STEP = 4
FARTHEST = 1e15
METHODS = ("primary", "secondary", "ocr")
ITEMS_PER_PART = 1000


def blocks_outside_tables(blocks: DataFrame, boxes: DataFrame) -> DataFrame:
    """Non-blank blocks that lie in no table box of their page, grown by TOLERANCE.

    Boxes are sorted into levels by their size, each with a grid of its own, whose
    cells are at least as wide and high as the boxes: a box covers four of them at
    most, however large it is. A block asks every level that occurs (two or three
    for boxes of usual pages; their number is bounded by the exponents of a double)
    for the cell its corner lies in, so the blocks of a crowded page spread over
    many tasks. Corners are ordered (x0 <= x1, y0 <= y1); a box with a corner that
    is null, infinite or no number holds no block, and a block with such a one stays.
    """
    corners = ("x0", "y0", "x1", "y1")
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) + 2 * TOLERANCE
    grown = (
        boxes.filter(_finite(corners) & size.between(0, FARTHEST))
        .select(
            "doc_id",
            "page_number",
            F.greatest(F.lit(0), F.ceil(F.log(float(STEP), size / CELL))).cast("int").alias("level"),
            (F.col("x0") - TOLERANCE).alias("bx0"),
            (F.col("y0") - TOLERANCE).alias("by0"),
            (F.col("x1") + TOLERANCE).alias("bx1"),
            (F.col("y1") + TOLERANCE).alias("by1"),
        )
        .distinct()
    )
    out = blocks.withColumn("text", ustrip(F.col("text"))).filter(F.col("text") != "")
    for row in grown.select("level").distinct().orderBy("level").collect():
        out = _outside(out, grown.filter(F.col("level") == row.level), CELL * float(STEP) ** row.level)
    return out


def _finite(corners: tuple[str, ...]) -> Column:
    usual = [F.coalesce(F.abs(F.col(c)) < FARTHEST, F.lit(False)) for c in corners]
    return functools.reduce(lambda a, b: a & b, usual)


def _outside(blocks: DataFrame, grown: DataFrame, cell: float) -> DataFrame:
    """Blocks in none of the boxes, which are no larger than a cell."""
    at = lambda c: F.floor(c / cell)
    over = lambda a, b: F.explode(F.sequence(at(F.col(a)), at(F.col(b))))
    covered = grown.withColumn("cx", over("bx0", "bx1")).withColumn("cy", over("by0", "by1"))
    b, t = blocks.withColumns({"cx": at(F.col("x0")), "cy": at(F.col("y0"))}).alias("b"), covered.alias("t")
    same = [F.col(f"b.{k}") == F.col(f"t.{k}") for k in ("doc_id", "page_number", "cx", "cy")]
    inside = [
        F.col("b.x0") >= F.col("t.bx0"),
        F.col("b.y0") >= F.col("t.by0"),
        F.col("b.x1") <= F.col("t.bx1"),
        F.col("b.y1") <= F.col("t.by1"),
    ]
    return b.join(t, same + inside, "left_anti").drop("cx", "cy")


def page_provenance(items: DataFrame, items_per_part: int = ITEMS_PER_PART) -> DataFrame:
    """(doc_id, page_number, part_no, text): page text of items, on every page they cite.

    Items of a page are joined by a blank line in reading order. A page with very
    many items comes in parts; parts after the first begin with the separator.
    """
    cited = (
        items.filter(F.coalesce(F.col("text"), F.lit("")) != "")
        .select("doc_id", "item_no", "text", F.explode_outer(F.array_distinct("prov")).alias("page_number"))
        .filter(F.col("page_number").isNotNull())
        .withColumn("part_no", F.floor((F.col("item_no") - 1) / items_per_part).cast("int"))
    )
    parts = (
        cited.groupBy("doc_id", "page_number", "part_no")
        .agg(F.sort_array(F.collect_list(F.struct("item_no", "text"))).alias("rows"), F.max(~is_blank(F.col("text"))).alias("filled"))
        .select(
            "doc_id",
            "page_number",
            "part_no",
            "filled",
            F.array_join(F.transform("rows", lambda r: r["text"]), "\n\n").alias("text"),
        )
    )
    # Read for the texts, and for which part of a page is the first and whether the page has text.
    parts = written(parts, "parts")
    page = Window.partitionBy("doc_id", "page_number")
    places = parts.select(
        "doc_id", "page_number", "part_no",
        (F.col("part_no") == F.min("part_no").over(page)).alias("first"),
        F.max("filled").over(page).alias("filled"),
    ).filter("filled")
    return parts.drop("filled").join(places, ["doc_id", "page_number", "part_no"]).select(
        "doc_id",
        "page_number",
        "part_no",
        F.when(F.col("first"), F.col("text")).otherwise(F.concat(F.lit("\n\n"), "text")).alias("text"),
    )


def layout_page_text(blocks: DataFrame, boxes: DataFrame, tables_md: DataFrame) -> DataFrame:
    """(doc_id, page_number, text): the tables of a page as Markdown, then its blocks outside them, blank lines between.

    ``tables_md`` is (doc_id, page_number, page_table, md); ``blocks`` carry
    ``block_no``, their reading order. A page's pieces are bounded by the page.
    """
    place = lambda kind, no: F.struct(F.lit(kind).alias("kind"), no.cast("long").alias("no"))
    outside = blocks_outside_tables(blocks, boxes)
    pieces = tables_md.select("doc_id", "page_number", place(0, F.col("page_table")).alias("at"), F.col("md").alias("piece")).unionByName(
        outside.select("doc_id", "page_number", place(1, F.col("block_no")).alias("at"), F.col("text").alias("piece"))
    )
    return (
        pieces.groupBy("doc_id", "page_number")
        .agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
        .select("doc_id", "page_number", F.array_join(F.transform("pieces", lambda p: p["piece"]), "\n\n").alias("text"))
    )


def extraction_density(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, method, n_chars, n_bytes, sparse): text found against file size."""
    chars = (
        candidates.filter(~is_blank(F.col("text")))
        .groupBy("doc_id", "method")
        .agg(F.sum(F.length("text")).alias("n_chars"))
    )
    return chars.join(files, "doc_id").withColumn(
        "sparse",
        F.col("n_chars") < F.greatest(F.lit(200.0), F.col("n_bytes") / 1024.0 * 50.0),
    )


def chosen_methods(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, method): the extraction to use, null where every one failed.

    Dense primary, else second, else OCR, else the sparse primary.
    """
    first, second, third = METHODS
    sums = (
        candidates.groupBy("doc_id")
        .agg(
            *[
                F.sum(
                    F.when((F.col("method") == m) & ~is_blank(F.col("text")), F.length("text"))
                ).alias(m)
                for m in METHODS
            ]
        )
        .join(files, "doc_id")
    )
    dense = F.col(first) >= F.greatest(F.lit(200.0), F.col("n_bytes") / 1024.0 * 50.0)
    return sums.select(
        "doc_id",
        F.when(dense, first)
        .when(F.col(second).isNotNull(), second)
        .when(F.col(third).isNotNull(), third)
        .when(F.col(first).isNotNull(), first)
        .alias("method"),
    )


def best_extraction(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """Non-blank pages of each document's chosen extraction."""
    chosen = chosen_methods(candidates, files).filter(F.col("method").isNotNull())
    return candidates.filter(~is_blank(F.col("text"))).join(chosen, ["doc_id", "method"]).select(
        "doc_id", "method", "page_number", "text"
    )


def failed_extractions(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, error) of files no method got text from, those without candidates included."""
    chosen = chosen_methods(candidates, files).filter(F.col("method").isNotNull())
    return files.join(chosen, "doc_id", "left_anti").select(
        "doc_id", F.lit("all extractors failed").alias("error")
    )
