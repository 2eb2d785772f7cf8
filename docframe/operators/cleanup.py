"""Line rules for raw page text: notices, TOC lines, headings, unreadable pages, repeated lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.rows import explode
from docframe.functions.text import WS, split_lines, ustrip

# A line is a notice if it opens with a copyright mark, or the word with a year
# or no more than a holder behind it, if it names authors before a colon, or if it forbids the copying of the
# document itself. Legal text that merely uses such words stays.
COPIES = r"(?:riproduzion[ei]|riprodurre|copiare|copia|duplicazione|diffusione|divulgazione)"
ITSELF = r"(?:(?:quest[oa]|presente|present[ei])\b|document[oi]\b|elaborat[oi]\b|pubblicazion[ei]\b|contenut[oi]\b|test[oi]\b|tavol[ae]\b|disegn[oi]\b|oper[ae]\b|materiale\b|pagin[ae]\b)"
NOTICES = (
    r"\A\W*(?:©|\(c\)|copyright\s*(?:©|\(c\)|:|\d|by\b|\z))",
    r"\A\W*copyright\s+(?!(?:law|laws|act|rules?|protection|protects?|applies|is|are|in|of|and|holders?|owners?|infringements?)\b)(?:\S+\s*){1,4}\z",
    r"\A\W*copyright\s(?=.*\b(?:19|20)\d{2}\b).*\ball\s+rights\s+reserved",
    r"\A\W*(?:gli\s+)?(?:autori|estensori)\s*(?::|\z)",
    rf"\bvietat[aeio]\b[^.;]*\b{COPIES}\s*(?:,|anche\b|e\b|o\b|(?:anche\s+)?(?:totale|parziale|integrale)\b|senza\b|non\b|\W*\z)",
    rf"\bvietat[aeio]\b[^.;]*\b{COPIES}\b(?:\s+\S+){{0,3}}?\s+{ITSELF}",
)
TOC_LINE = rf"(?d)\A{WS}*#{{0,6}}{WS}*(.*?){WS}*\.{{3,}}{WS}*\d+{WS}*\z"
READABLE_CHARS = 20
PAGES_PER_BUCKET = 1000


def _edit(text: Column, keep=None, change=None) -> Column:
    lines = split_lines(text)
    if keep is not None:
        lines = F.filter(lines, keep)
    if change is not None:
        lines = F.transform(lines, change)
    return F.array_join(lines, "\n")


def is_notice(line: Column) -> Column:
    return line.rlike("(?iU)" + "|".join(NOTICES))


def drop_boilerplate_lines(text: Column) -> Column:
    """Text without lone page numbers and without notice lines."""
    return _edit(text, keep=lambda s: ~ustrip(s).rlike(r"\A\d+\z") & ~is_notice(s))


def normalize_toc(text: Column) -> Column:
    """``ART. 1 ....... 2`` becomes ``- ART. 1``."""
    return _edit(text, change=lambda s: F.regexp_replace(s, TOC_LINE, r"- $1"))


def heading_level(line: Column) -> Column:
    """Level a raw line gets by its wording: TITOLO 2, ART. or CAPO 3, N.N 4, else 0."""
    return (
        F.when(line.rlike(rf"\ATITOLO{WS}"), 2)
        .when(line.rlike(rf"\A(?:ART\.|CAPO{WS})"), 3)
        .when(line.rlike(rf"\A\d+\.\d+{WS}"), 4)
        .otherwise(0)
    )


def classify_headings(text: Column) -> Column:
    """Text whose structural lines carry heading marks; the first line is the title."""

    def mark(line: Column, i: Column) -> Column:
        level = heading_level(ustrip(line))
        return (
            F.when((i == 0) & (ustrip(line) != ""), F.concat(F.lit("# "), ustrip(line)))
            .when(level == 2, F.concat(F.lit("## "), ustrip(line)))
            .when(level == 3, F.concat(F.lit("### "), ustrip(line)))
            .when(level == 4, F.concat(F.lit("#### "), ustrip(line)))
            .otherwise(line)
        )

    return _edit(text, change=mark)


def is_unreadable(text: Column) -> Column:
    """Fewer than READABLE_CHARS characters that are no white space."""
    return F.length(F.regexp_replace(text, WS, "")) < READABLE_CHARS


def mark_unreadable(pages: DataFrame) -> DataFrame:
    """Pages with ``unreadable`` and ``marker``, the comment for pages with next to no text, null among them; the text stays."""
    marker = F.concat(F.lit("<!-- UNREADABLE: page "), F.col("page_number").cast("string"), F.lit(" -->"))
    flagged = pages.withColumn("unreadable", is_unreadable(F.coalesce("text", F.lit(""))))
    return flagged.withColumn("marker", F.when(F.col("unreadable"), marker))


def repeated_lines(pages: DataFrame, share: float = 0.5, min_pages: int = 3) -> DataFrame:
    """(doc_id, line, n_pages, first_page): lines on at least ``share`` of a document's pages.

    Each page sends each of its lines once, and counts combine before the
    shuffle. Blank lines are left out.
    """
    distinct = F.array_distinct(F.transform(split_lines(F.col("text")), ustrip))
    lines = explode(pages, ["doc_id", "page_number"], F.filter(distinct, lambda s: s != ""), "line")
    seen = lines.groupBy("doc_id", "line").agg(
        F.count(F.lit(1)).alias("n_pages"), F.min("page_number").alias("first_page")
    ).filter(F.col("n_pages") >= min_pages)
    totals = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total"))
    return seen.join(totals, "doc_id").filter(
        F.col("n_pages") >= F.col("total") * share
    ).drop("total")


def drop_repeated_lines(pages: DataFrame, share: float = 0.5, min_pages: int = 3) -> DataFrame:
    """Pages without repeated headers and footers; the first occurrence stays.

    A line on ``share`` of the pages leaves room for at most 1/share times the
    lines of an average page, which bounds the list a document carries. Lists
    meet pages by document and bucket of pages, so a document with a large part
    of all pages is spread over many tasks.
    """
    lists = (
        repeated_lines(pages, share, min_pages)
        .groupBy("doc_id")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("line", "first_page"))).alias("repeated")
        )
    )
    bucket = F.floor(F.col("page_number") / PAGES_PER_BUCKET).alias("_bucket")
    dealt = pages.select("doc_id", bucket).distinct().join(lists, "doc_id")
    joined = pages.select("*", bucket).join(dealt, ["doc_id", "_bucket"], "left").drop("_bucket")
    joined = joined.withColumn("lines", split_lines(F.col("text")))
    stripped = joined.withColumn("stripped", F.transform("lines", ustrip))
    tagged = F.zip_with("lines", "stripped", lambda s, t: F.struct(s.alias("line"), t.alias("key")))
    kept = F.filter(
        tagged,
        lambda r, i: F.when(
            F.try_element_at("repeated", r["key"]) == F.col("page_number"),
            F.array_position("stripped", r["key"]) == i + 1,
        ).otherwise(F.try_element_at("repeated", r["key"]).isNull()),
    )
    edited = F.array_join(F.transform(kept, lambda r: r["line"]), "\n")
    text = F.when(F.col("repeated").isNull(), F.col("text")).otherwise(edited)
    return stripped.select(*[c for c in pages.columns if c != "text"], text.alias("text"))
