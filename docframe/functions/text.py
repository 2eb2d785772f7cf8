"""Column helpers for text: trimming, line splitting and the fixed patterns.

All helpers return JVM-side expressions. Line work happens inside the row, on
arrays, so splitting a document into lines never shuffles its text.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space, as a regex class body
# and as a plain string for btrim.
WS_CLASS = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = f"[{WS_CLASS}]"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Line boundaries other than "\n", and blanks within a line.
OTHER_NEWLINE = r"[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029](?:(?<=\r)\n)?"
OTHER_NEWLINES = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
BLANKS = "\t\x1f \xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u202f\u205f\u3000"

# Document grammar. (?d) makes "." stop at "\n" only, (?s) lets
# it cross lines.
FRONT_MATTER = rf"(?ds)\A---{WS}*\n(.*?)\n---{WS}*\n"
FRONT_MATTER_LOOSE = rf"(?ds)\A{WS}*---\n.*?\n---\n"
HTML_COMMENT = r"(?s)<!--.*?-->"
SEGMENT_HEADING = rf"^#{{1,6}}{WS}+"
OUTLINE_HEADING = rf"\A(#{{1,4}}){WS}"
TABLE_SEPARATOR = rf"^\|[{WS_CLASS}\-:|]+\|[{WS_CLASS}\-:|]*$"
INLINE = (
    r"(?d)\*\*(.+?)\*\*|__(.+?)__|\*(.+?)\*|_(.+?)_|`([^`]+)`|\[([^\]]+)\]\([^\)]+\)"
)
YEAR = r"(?U)(?<!/)\b(20[12]\d)\b(?!/)"
H1_LINE = r"(?md)^# "
CODE_FENCES = (
    (rf"\A```(?:markdown)?{WS}*\n", ""),
    (rf"\n```{WS}*\z", ""),
    (rf"(?ds)\A```yaml{WS}*\n(.*?)\n```", "---\n$1\n---"),
)
JSON_FENCES = (
    (rf"\A```(?:json)?{WS}*\n?", ""),
    (rf"\n?```{WS}*\z", ""),
)

# Separates pieces inside a row. Line splitting consumes it, so no line
# can contain it.
PIECE = "\x1e"


def ustrip(c: Column) -> Column:
    """Strip Unicode white space on both sides (``trim`` only strips blanks)."""
    return F.btrim(c, F.lit(WS_CHARS))


def is_blank(c: Column) -> Column:
    return ustrip(c) == F.lit("")


def unix_lines(c: Column) -> Column:
    """The text with every universal line end written as a line feed; most texts have no other and are left alone."""
    def read(text: Column) -> Column:
        others = reduce(or_, [text.contains(mark) for mark in OTHER_NEWLINES])
        return F.when(others, F.regexp_replace(text, OTHER_NEWLINE, "\n")).otherwise(text)

    # the one-element array binds the text to a name, so it is made once
    return F.get(F.transform(F.array(c), read), F.lit(0))


def split_lines(c: Column) -> Column:
    """Lines of a text at universal line ends, without a trailing empty one."""
    parts = F.array(F.split(unix_lines(c), "\n"))
    # the one-element array binds the lines to a name, so they are split once
    kept = F.transform(
        parts,
        lambda a: F.when(F.element_at(a, -1) == "", F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a),
    )
    return F.get(kept, F.lit(0))


def chain(c: Column, rules) -> Column:
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def strip_code_fences(c: Column) -> Column:
    return ustrip(chain(ustrip(c), CODE_FENCES))


def strip_json_fences(c: Column) -> Column:
    return ustrip(F.when(c.contains("```"), chain(ustrip(c), JSON_FENCES)).otherwise(c))


def inline_plain_text(c: Column) -> Column:
    """Unwrap inline Markdown once, collapse white space, strip."""
    unwrapped = F.regexp_replace(c, INLINE, "$1$2$3$4$5$6")
    return ustrip(F.regexp_replace(unwrapped, f"{WS}+", " "))


def strip_front_matter(c: Column) -> Column:
    return F.when(c.startswith("---"), F.regexp_replace(c, FRONT_MATTER, "")).otherwise(c)


def file_stem(c: Column) -> Column:
    """File name without folders and without its last suffix; dot-files keep their name."""
    name = F.regexp_replace(c, r"^.*/", "")
    return F.regexp_replace(name, r"(?<=[^/])\.[^./]+$", "")


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def xml_escape(c: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def without_outer_pipes(line: Column) -> Column:
    """A stripped line without one pipe at each end."""
    first = F.when(line.startswith("|"), 1).otherwise(0)
    last = F.when(line.endswith("|") & (line != "|"), 1).otherwise(0)
    return F.substr(line, first + 1, F.length(line) - first - last)


def table_cells(line: Column) -> Column:
    """Cells of one stripped pipe-table line: outer pipes removed, cells stripped, blanks kept."""
    return F.transform(F.split(without_outer_pipes(line), r"\|"), ustrip)
