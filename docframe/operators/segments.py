"""Translation units from Markdown documents.

A document becomes its segments inside the row: lines are tagged, joined and
cut again at piece marks, so consecutive text lines melt into one paragraph
without a window or a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.rows import computed, explode
from docframe.functions.text import (
    FRONT_MATTER_LOOSE,
    HTML_COMMENT,
    PIECE,
    SEGMENT_HEADING,
    TABLE_SEPARATOR,
    inline_plain_text,
    split_lines,
    ustrip,
    xml_escape,
)
from docframe.operators.parts import in_parts, line_ends, numbered, with_earlier

# Marks a piece whose text is final. Line splitting consumes the character.
FINAL = "\x1d"


def table_row_segment(line: Column) -> Column:
    """Text of one table row: non-blank cells in plain text, joined by pipes."""
    cells = F.filter(F.split(line, r"\|"), lambda c: ustrip(c) != "")
    plain = F.filter(F.transform(cells, inline_plain_text), lambda c: c != "")
    return F.array_join(plain, " | ")


def _tag(line: Column) -> Column:
    mark = F.lit(PIECE)
    return (
        F.when(line.rlike(SEGMENT_HEADING), F.concat(mark, F.regexp_replace(line, SEGMENT_HEADING, ""), mark))
        .when(
            line.startswith("|"),
            F.when(line.rlike(TABLE_SEPARATOR), mark).otherwise(
                F.concat(mark, F.lit(FINAL), table_row_segment(line), mark)
            ),
        )
        .when(line == "", mark)
        .otherwise(line)
    )


def segment_array(md: Column, first: Column | None = None) -> Column:
    """Segments of a text; front matter is left out where ``first`` holds (everywhere by default)."""
    bare = F.regexp_replace(md, FRONT_MATTER_LOOSE, "")
    body = bare if first is None else F.when(first, bare).otherwise(md)
    body = F.regexp_replace(body, HTML_COMMENT, "")
    tagged = F.transform(F.transform(split_lines(body), ustrip), _tag)
    pieces = F.filter(F.split(F.array_join(tagged, " "), PIECE), lambda p: ~p.isin("", " "))
    texts = F.transform(
        pieces,
        lambda p: F.when(p.startswith(FINAL), F.substr(p, F.lit(2))).otherwise(inline_plain_text(p)),
    )
    return F.filter(texts, lambda s: s != "")


def _cut(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, part_no, segments, n_before): segments of each row, and how many stand in earlier parts.

    Parts begin with a blank line, so no paragraph reaches from one into the next.
    """
    source = numbered(docs).select("doc_id", "part_no", F.col(text).alias("_md"))
    first = None if not in_parts(docs) else F.col("part_no") == 0
    cut = computed(source, segments=segment_array(F.col("_md"), first)).drop("_md")
    return with_earlier(cut, not in_parts(docs), {"n": F.size("segments")})


def segments(docs: DataFrame, text: str = "md") -> DataFrame:
    """(doc_id, tuid, segment): segments numbered from 1 in document order, through all parts."""
    rows = explode(_cut(docs, text), ["doc_id", "n_before"], "segments", "segment", pos="_pos")
    return rows.select("doc_id", (F.col("n_before") + F.col("_pos") + 1).alias("tuid"), "segment")


def table_row_segments(docs: DataFrame, text: str = "md") -> DataFrame:
    """(doc_id, line_no, segment) of the table rows only; lines are counted through all parts."""
    source = numbered(docs).select("doc_id", "part_no", F.col(text).alias("_md"))
    lined = computed(source, lines=F.transform(split_lines(F.col("_md")), ustrip), ends=line_ends(F.col("_md"))).drop("_md")
    counted = with_earlier(lined, not in_parts(docs), {"ends": F.col("ends")})
    rows = F.filter(
        F.transform(
            "lines",
            lambda line, i: F.struct(
                (F.col("ends_before") + i + 1).alias("line_no"),
                F.when(
                    line.startswith("|") & ~line.rlike(TABLE_SEPARATOR), table_row_segment(line)
                ).alias("segment"),
            ),
        ),
        lambda r: F.coalesce(r["segment"], F.lit("")) != "",
    )
    return explode(counted, ["doc_id"], rows, "r").select("doc_id", "r.*")


def _unit(tuid: Column, segment: Column, source: str, target: str) -> Column:
    # The form of a TMX unit.
    return F.concat(
        F.lit('    <tu tuid="'),
        tuid.cast("string"),
        F.lit(f'">\n      <tuv xml:lang="{source}"><seg>'),
        xml_escape(segment),
        F.lit(f'</seg></tuv>\n      <tuv xml:lang="{target}"><seg></seg></tuv>\n    </tu>\n'),
    )


def tmx_units(docs: DataFrame, source: str, target: str, text: str = "md") -> DataFrame:
    """(doc_id, tuid, unit): one TMX unit per segment."""
    return segments(docs, text).select(
        "doc_id", "tuid", _unit(F.col("tuid"), F.col("segment"), source, target).alias("unit")
    )


def tmx_documents(
    docs: DataFrame,
    source: str,
    target: str,
    created: str,
    text: str = "md",
    tool: str = "docframe",
) -> DataFrame:
    """(doc_id, tmx): a TMX 1.4 file per document; documents without segments are left out.

    Of documents in parts it gives (doc_id, part_no, tmx), parts of the file: the
    first with the head, the last with the end. ``created`` is the UTC creation
    date as ``yyyyMMdd'T'HHmmss'Z'``.
    """
    # The frame of a TMX 1.4 file.
    head = (
        '<?xml version="1.0" encoding="utf-8"?>\n'
        '<!DOCTYPE tmx SYSTEM "tmx14.dtd">\n'
        '<tmx version="1.4">\n'
        f'  <header creationtool="{tool}" creationtoolversion="1.0"\n'
        '          datatype="plaintext" segtype="paragraph"\n'
        f'          adminlang="en-US" srclang="{source}"\n'
        f'          creationdate="{created}"/>\n'
        "  <body>\n"
    )
    cut = _cut(docs, text).filter(F.size("segments") > 0)
    units = F.array_join(F.transform("segments", lambda s, i: _unit(F.col("n_before") + i + 1, s, source, target)), "")
    end = F.lit("  </body>\n</tmx>\n")
    if not in_parts(docs):
        return cut.select("doc_id", F.concat(F.lit(head), units, end).alias("tmx"))
    last = cut.groupBy("doc_id").agg(F.max("part_no").alias("last"))
    return cut.join(last, "doc_id").select(
        "doc_id",
        "part_no",
        F.concat(
            F.when(F.col("n_before") == 0, head).otherwise(""), units,
            F.when(F.col("part_no") == F.col("last"), end).otherwise(""),
        ).alias("tmx"),
    )


def translation_csv(docs: DataFrame, source: str, target: str, text: str = "md") -> DataFrame:
    """(doc_id, id, <source>, <target>): rows of the translation CSV, target empty."""
    return segments(docs, text).select(
        "doc_id",
        F.col("tuid").alias("id"),
        F.col("segment").alias(source),
        F.lit("").alias(target),
    )
