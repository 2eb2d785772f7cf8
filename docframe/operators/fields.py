"""Key-value fields from text, their mapping to a schema, and typed values."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.rows import computed, inline
from docframe.functions.text import WS, WS_CHARS, split_lines, strip_front_matter, ustrip
from docframe.operators import tables as tb
from docframe.session import written

# Separators in the order they are tried, and the key length.
SEPARATORS = (":", "=", "—", "-")
MAX_KEY = 60


def pair(line: Column) -> Column:
    """{key, value} at the first separator, by priority, that the line contains."""
    found = None
    for sep in SEPARATORS:
        split = F.struct(
            ustrip(F.substring_index(line, sep, 1)).alias("key"),
            ustrip(F.substr(line, F.instr(line, sep) + 1)).alias("value"),
        )
        hit = line.contains(sep)
        found = F.when(hit, split) if found is None else found.when(hit, split)
    return found


def accepted(key: Column, value: Column, max_key: int = MAX_KEY) -> Column:
    """Whether a pair counts: a key of 2 to ``max_key`` characters with a value."""
    return (F.length(key) > 1) & (F.length(key) <= max_key) & (value != "")


def candidate_lines(text: Column, markdown: bool = False) -> Column:
    """[{line_no, line}] of the lines that contain a separator.

    With ``markdown`` the front matter, headings and pipe lines are left out.
    """
    lines = split_lines(strip_front_matter(text) if markdown else text)
    numbered = F.transform(
        lines, lambda s, i: F.struct((i + 1).alias("line_no"), s.alias("line"))
    )

    def wanted(line: Column) -> Column:
        found = reduce(or_, [line.contains(s) for s in SEPARATORS])
        if not markdown:
            return found
        text = F.ltrim(line, F.lit(WS_CHARS))
        return found & ~(text.startswith("|") | text.startswith("#"))

    return F.filter(numbered, lambda r: wanted(r["line"]))


def key_value_lines(
    pages: DataFrame, text: str = "text", markdown: bool = False, max_key: int = MAX_KEY
) -> DataFrame:
    """(doc_id, page_number, line_no, key, value): every line that holds a pair."""
    return _paired(inline(pages, ["doc_id", "page_number"], candidate_lines(F.col(text), markdown)), max_key)


def _paired(lines: DataFrame, max_key: int = MAX_KEY) -> DataFrame:
    found = computed(lines, p=pair(F.col("line")))
    return found.filter(accepted(F.col("p.key"), F.col("p.value"), max_key)).select(
        "doc_id", "page_number", "line_no", "p.key", "p.value"
    )


def last_per_key(pairs: DataFrame) -> DataFrame:
    """(doc_id, key, value, first_page, first_line): the last value of each key.

    The order of fields is that of first appearance, given by the two position
    columns. Aggregates partially, so a key on a third of all lines is no hot spot.
    """
    at = F.struct("page_number", "line_no")
    return (
        pairs.groupBy("doc_id", "key")
        .agg(F.max(F.struct(at.alias("at"), F.col("value"))).alias("last"), F.min(at).alias("first"))
        .select(
            "doc_id",
            "key",
            F.col("last.value").alias("value"),
            F.col("first.page_number").alias("first_page"),
            F.col("first.line_no").alias("first_line"),
        )
    )


def key_values(pages: DataFrame, text: str = "text", markdown: bool = False) -> DataFrame:
    return last_per_key(key_value_lines(pages, text, markdown))


def heuristic_record(
    pages: DataFrame, warnings: DataFrame | Callable[[DataFrame], DataFrame] | None = None, text: str = "md"
) -> DataFrame:
    """Fields, line items and warnings of each document in one long table.

    Columns: doc_id, kind ('field', 'item' or 'warning'), page_number, a, b
    (position on the page: line and 0, or table and row), key, value.
    ``warnings`` are the document's (doc_id, code, message, page_number), or made
    from its raw tables by a function; their key is the code.

    Pages are read once: the lines that may hold a pair and the runs of pipe lines
    are written, and all that follows starts from those.
    """
    row = lambda df, kind, page, a, b, key, value: df.select(
        "doc_id", F.lit(kind).alias("kind"), page.cast("int").alias("page_number"), a.cast("int").alias("a"),
        b.cast("int").alias("b"), key.alias("key"), value.alias("value"),
    )
    c, zero = F.col, F.lit(0)
    piece = lambda kind, at, piece: F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("at"), piece.alias("piece"))
    pieces = F.concat(
        F.transform(candidate_lines(F.col(text), markdown=True), lambda r: piece("line", r["line_no"], r["line"])),
        F.transform(tb.table_runs(F.col(text)), lambda run, i: piece("run", i + 1, run)),
    )
    facts = written(inline(pages, ["doc_id", "page_number"], pieces), "facts")
    lines = facts.filter("kind = 'line'").select("doc_id", "page_number", c("at").alias("line_no"), c("piece").alias("line"))
    raw = tb.tables_of(facts.filter("kind = 'run'").select("doc_id", "page_number", c("at").alias("page_table"), c("piece").alias("run")))
    found = last_per_key(_paired(lines))
    items = tb.rows_to_dicts(tb.detect_header(raw, stripped=True))
    out = row(found, "field", c("first_page"), c("first_line"), zero, c("key"), c("value")).unionByName(
        row(items, "item", c("page_number"), c("page_table"), c("row_index"), c("key"), c("value"))
    )
    if callable(warnings):
        warnings = warnings(raw)
    if warnings is None:
        return out
    return out.unionByName(
        row(warnings, "warning", F.coalesce("page_number", zero), zero, zero, c("code"), c("message"))
    )


def normalised_key(key: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(key), "[^a-z0-9]+", "_"), F.lit("_"))


#: Spellings of fewer letters are only met exactly.
LEAST_MISREAD = 6


def _literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def _claimed(spelled: Column, aliases: dict[str, str], misread: bool = False) -> Column:
    """Name of the schema field that claims a normalised key, by a literal table of spellings; null if none does.

    With ``misread`` a key that is one letter off a spelling (wrong, missing or too many) is claimed as well, unless
    spellings of two fields are that near. A schema has a few dozen spellings; each is compared in a band of one
    letter, and only with keys the table does not have.
    """
    if not aliases:
        return F.lit(None).cast("string")
    exact = F.try_element_at(_literal_map(aliases), spelled)
    long = {a: f for a, f in aliases.items() if len(a) >= LEAST_MISREAD}
    if not misread or not long:
        return exact
    near = [F.when(F.length(spelled).between(len(a) - 1, len(a) + 1) & (F.levenshtein(spelled, F.lit(a), 1) >= 0), F.lit(f)) for a, f in long.items()]
    names = F.array_distinct(F.array_compact(F.array(*near)))
    return F.coalesce(exact, F.when(F.size(names) == 1, F.get(names, F.lit(0))))


def schema_guided_fields(pairs: DataFrame, aliases: dict[str, str], misread: bool = False) -> DataFrame:
    """(doc_id, name, value): pairs whose key names a schema field or one of its aliases.

    ``pairs`` are key-value lines, ``aliases`` gives the field of each spelling
    (``Schema.aliases``). Keys are few and hot, so they are looked up in the row.
    With ``misread`` keys that are one letter off count where a document has no
    exact one for the field.
    """
    # Normalised once; the comparisons with all spellings read the result.
    spelled = computed(pairs, _key=normalised_key(F.col("key")))
    exact = computed(spelled, exact=_claimed(F.col("_key"), aliases))
    claims = computed(exact, name=F.coalesce("exact", _claimed(F.col("_key"), aliases, misread)) if misread else F.col("exact"))
    matched = claims.filter(F.col("name").isNotNull())
    at = F.struct("page_number", "line_no")
    return (
        matched.groupBy("doc_id", "name")
        .agg(F.max(F.struct(F.col("exact").isNotNull().alias("exact"), at.alias("at"), F.col("value"))).alias("last"))
        .select("doc_id", "name", F.col("last.value").alias("value"))
    )


def unexpected_keys(pairs: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """(doc_id, key) of pairs that no schema field claims."""
    return pairs.filter(_claimed(normalised_key(F.col("key")), aliases).isNull()).select("doc_id", "key").distinct()


# Whole amounts by the mark before their decimals: groups of three digits, the first
# of which does not begin with 0, and decimals. Spaces and apostrophes always group.
GROUPS = r"[1-9]\d{0,2}(?:%s\d{3})+"
SPACED = GROUPS % "[  \u202f']"


def _written(mark: str, other: str) -> str:
    m, o = re.escape(mark), re.escape(other)
    return rf"\A(?:\d+|{GROUPS % o}|{SPACED})(?:{m}\d+)?\z"


#: A point and three digits behind up to three: decimals in one language, a group in the other.
EITHER = r"\A[1-9]\d{0,2}\.\d{3}\z"
# Currency codes and signs.
UNIT = r"(?:EUR|USD|GBP|CHF|JPY|CNY|CAD|AUD|NZD|SEK|NOK|DKK|PLN|CZK|HUF|RON|INR|BRL|MXN|ZAR|[€$£¥])?"


def amount(value: Column, kind: str = "decimal(18,2)", decimal: str | None = None) -> Column:
    """A text that is one amount, with a currency sign or code, grouping, and a sign or parentheses; else null.

    ``decimal`` is the mark before the decimals, a point or a comma. Without it
    the text must tell: ``1.395`` may be either and is null; a single comma before
    three digits groups, as amounts with three decimals are rare.
    """
    bare = F.regexp_replace(ustrip(value), rf"\A{UNIT}{WS}*|{WS}*{UNIT}\z", "")
    inside = F.regexp_extract(bare, r"\A\((.*)\)\z", 1)
    sign = F.when((inside != "") | bare.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(F.when(inside != "", inside).otherwise(bare), rf"\A[+-]?{WS}*{UNIT}{WS}*", "")
    point = F.when(digits.rlike(_written(".", ",")), F.regexp_replace(digits, "[,  \u202f']", ""))
    comma = F.when(digits.rlike(_written(",", ".")), F.replace(F.regexp_replace(digits, "[.  \u202f']", ""), F.lit(","), F.lit(".")))
    known = {".": point, ",": comma}
    number = known[decimal] if decimal else F.when(~digits.rlike(EITHER), F.coalesce(point, comma))
    return F.concat(sign, number).try_cast(kind)


def typed_value(value: Column, kind: str, decimal: str | None = None) -> Column:
    """A value by its declared type: date, currency, number or string; null if it does not fit."""
    if kind == "date":
        return F.try_to_date(ustrip(value), "yyyy-MM-dd")
    if kind == "currency":
        return amount(value, decimal=decimal)
    if kind == "number":
        return amount(value, "double", decimal)
    return value


def typed_record(fields: DataFrame, types: dict[str, str], decimal: str | None = None) -> DataFrame:
    """One row per document with a typed column per schema field, and cast warnings.

    ``fields`` is (doc_id, name, value). A value that does not fit its type
    becomes null and is named in ``warnings``. ``decimal`` is the mark before the
    decimals of its amounts; without it those that may be read in two ways do not fit.
    """
    wide = fields.groupBy("doc_id").agg(
        *[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in types]
    )
    typed = {n: typed_value(F.col(n), kind, decimal) for n, kind in types.items()}
    bad = F.filter(
        F.array(
            *[
                F.when(
                    F.col(n).isNotNull() & typed[n].isNull(), F.lit(f"Value of '{n}' is no {kind}")
                )
                for n, kind in types.items()
            ]
        ),
        lambda w: w.isNotNull(),
    )
    return wide.select("doc_id", *[typed[n].alias(n) for n in types], bad.alias("warnings"))


def reconcile_totals(items: DataFrame, totals: DataFrame, decimal: str | None = None) -> DataFrame:
    """(doc_id, items_total, total, difference, unread): line amounts summed against the stated total.

    ``items`` is (doc_id, value) and ``totals`` (doc_id, value), both as written.
    ``unread`` counts the amounts that are none, the total among them; where
    there are any, the difference is null rather than that of a partial sum.
    """
    read = items.select("doc_id", "value", amount(F.col("value"), decimal=decimal).alias("n"))
    summed = read.groupBy("doc_id").agg(
        F.sum("n").alias("items_total"), F.count_if(F.col("n").isNull() & F.col("value").isNotNull()).alias("bad")
    )
    stated = totals.select("doc_id", amount(F.col("value"), decimal=decimal).alias("total"))
    unread = F.col("bad") + F.when(F.col("total").isNull(), 1).otherwise(0)
    return summed.join(stated, "doc_id").select(
        "doc_id",
        "items_total",
        "total",
        F.when(unread == 0, F.col("total") - F.col("items_total")).alias("difference"),
        unread.cast("long").alias("unread"),
    )
