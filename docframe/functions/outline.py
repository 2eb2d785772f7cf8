"""In-row expressions over the heading outline of a text.

Each function takes array or string columns and returns an expression; callers
keep arrays that are read more than once as columns of their own, so that a
lambda never re-evaluates them per element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docframe.functions.text import OUTLINE_HEADING, ustrip


def headings(lines: Column) -> Column:
    """[{line_no, level, text}] for the H1-H4 lines; line_no is 1-based."""
    levels = F.transform(
        lines,
        lambda line, i: F.struct(
            (i + 1).alias("line_no"),
            F.length(F.regexp_extract(line, OUTLINE_HEADING, 1)).alias("level"),
            line.alias("text"),
        ),
    )
    return F.filter(levels, lambda h: h["level"] > 0)


def with_previous(heads: Column, before: Column) -> Column:
    """Pair each heading with the level of the one before it (0: none)."""
    shifted = F.concat(F.array(before.cast("int")), F.transform(heads, lambda h: h["level"]))
    pairs = F.zip_with(
        heads,
        shifted,
        lambda h, p: F.struct(
            h["line_no"].alias("line_no"),
            h["level"].alias("level"),
            h["text"].alias("text"),
            p.alias("previous"),
        ),
    )
    return F.filter(pairs, lambda h: h["line_no"].isNotNull())


def with_end(heads: Column, n_lines: Column) -> Column:
    """Pair each heading with the last line of its section."""
    ends = F.concat(
        F.transform(F.slice(heads, F.lit(2), F.size(heads)), lambda h: h["line_no"] - 1),
        F.array(n_lines.cast("int")),
    )
    pairs = F.zip_with(
        heads,
        ends,
        lambda h, e: F.struct(
            h["line_no"].alias("line_no"),
            h["level"].alias("level"),
            h["text"].alias("text"),
            e.alias("end"),
        ),
    )
    return F.filter(pairs, lambda h: h["line_no"].isNotNull())


def skipped(h: Column) -> Column:
    return (h["previous"] > 0) & (h["level"] > h["previous"] + 1)


def skip_message(h: Column, offset: Column) -> Column:
    return F.concat(
        F.lit("Line "),
        (h["line_no"] + offset).cast("string"),
        F.lit(": heading level skips from "),
        h["previous"].cast("string"),
        F.lit(" to "),
        h["level"].cast("string"),
        F.lit(" — '"),
        ustrip(h["text"]),
        F.lit("'"),
    )


def repaired_lines(lines: Column, heads: Column, paired: Column) -> Column:
    """Lines with a filler heading before each skip of exactly one level.

    ``paired`` is ``with_previous(heads)``. The line array is cut at the
    headings and each piece is copied once.
    """
    ends = F.concat(
        F.transform(F.slice(heads, F.lit(2), F.size(heads)), lambda h: h["line_no"]),
        F.array(F.size(lines) + 1),
    )
    empty = F.array().cast("array<string>")
    pieces = F.zip_with(
        paired,
        ends,
        lambda h, end: F.when(
            h["line_no"].isNotNull(),
            F.concat(
                F.when(
                    (h["previous"] > 0) & (h["level"] == h["previous"] + 2),
                    F.array(F.concat(F.repeat(F.lit("#"), h["previous"] + 1), F.lit(" (continued)"))),
                ).otherwise(empty),
                F.slice(lines, h["line_no"], end - h["line_no"]),
            ),
        ).otherwise(empty),
    )
    lead = F.when(F.size(heads) > 0, F.get(heads, F.lit(0))["line_no"] - 1).otherwise(F.size(lines))
    return F.concat(F.slice(lines, F.lit(1), lead), F.flatten(pieces))
