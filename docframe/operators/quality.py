"""Corpus quality: checklists, shares, line comparison, glued words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions import outline
from docframe.functions.rows import computed, explode
from docframe.functions.text import FRONT_MATTER, TABLE_SEPARATOR, split_lines, ustrip
from docframe.operators.assemble import REQUIRED_KEYS, front_matter_entries
from docframe.operators.parts import in_parts, numbered, with_earlier

WORD = r"\p{L}+"
MIN_HALF = 2


UNREADABLE = r"<!-- UNREADABLE: page (\d+) -->"


def quality_checklist(docs: DataFrame, text: str = "md") -> DataFrame:
    """Per-document checks of the Markdown form, computed inside the row; parts are folded on slim rows.

    Columns: doc_id, front_matter, one_title, no_skips, tables_consistent,
    images_relative, unreadable_pages (the numbers of the marked pages).
    """
    whole = not in_parts(docs)
    source = numbered(docs).select("doc_id", "part_no", F.col(text).alias("md"))
    lined = computed(source, lines=split_lines(F.col("md")))
    headed = computed(lined, heads=outline.headings(F.col("lines")))
    last = F.when(F.size("heads") > 0, F.element_at("heads", -1)["level"])
    headed = with_earlier(headed, whole, None, {"level": last})
    paired = outline.with_previous(F.col("heads"), F.coalesce("level_before", F.lit(0)))
    # Width of each pipe line (0: none), then neighbours of the same table compared.
    widths = F.transform(
        F.transform("lines", ustrip),
        lambda s: F.when(~s.startswith("|"), 0)
        .when(s.rlike(TABLE_SEPARATOR), -1)
        .otherwise(F.size(F.split(F.regexp_replace(s, r"\A\||\|\z", ""), r"\|"))),
    )
    given = front_matter_entries(F.regexp_extract("md", FRONT_MATTER, 1))
    measured = computed(headed, widths=F.filter(widths, lambda w: w >= 0), given=given)
    shifted = F.concat(F.array(F.lit(0)), F.col("widths"))
    uneven = F.exists(
        F.zip_with("widths", shifted, lambda w, p: (w > 0) & (p > 0) & (w != p)),
        lambda bad: F.coalesce(bad, F.lit(False)),
    )
    filled = lambda k: F.exists("given", lambda e: (e["key"] == k) & (F.coalesce(e["value"], F.lit("")) != ""))
    complete = filled(REQUIRED_KEYS[0])
    for k in REQUIRED_KEYS[1:]:
        complete &= filled(k)
    image = r"!\[[^\]]*\]\((?:[a-zA-Z][a-zA-Z0-9+.\-]*:|/)"
    checked = measured.select(
        "doc_id",
        "part_no",
        (complete & (F.col("part_no") == 0)).alias("front_matter"),
        F.size(F.filter("heads", lambda h: h["level"] == 1)).alias("titles"),
        (F.size(F.filter(paired, outline.skipped)) == 0).alias("no_skips"),
        (~uneven).alias("tables_consistent"),
        (~F.col("md").rlike(image)).alias("images_relative"),
        F.transform(F.regexp_extract_all("md", F.lit(UNREADABLE), F.lit(1)), lambda n: n.cast("int")).alias("unreadable_pages"),
    )
    if not whole:
        # A document has one slim row per part; the page lists hold a number per marked page.
        checked = checked.groupBy("doc_id").agg(
            F.max("front_matter").alias("front_matter"),
            F.sum("titles").alias("titles"),
            *[F.min(c).alias(c) for c in ("no_skips", "tables_consistent", "images_relative")],
            F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part_no", "unreadable_pages"))), lambda p: p["unreadable_pages"])).alias("unreadable_pages"),
        )
    return checked.select(
        "doc_id", "front_matter", (F.col("titles") == 1).alias("one_title"), "no_skips", "tables_consistent",
        "images_relative", "unreadable_pages",
    )


def corpus_quality(checks: DataFrame, kinds: DataFrame) -> DataFrame:
    """Shares of documents that pass each check, per kind and in all ('all').

    ``kinds`` is (doc_id, kind), the kind being the document's ``tipo``.
    """
    share = lambda c: F.round(F.avg(F.col(c).cast("int")), 6).alias(c)
    rolled = (
        checks.join(kinds, "doc_id")
        .rollup("kind")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            share("front_matter"),
            share("one_title"),
            share("no_skips"),
            share("tables_consistent"),
            F.round(F.avg((F.size("unreadable_pages") == 0).cast("int")), 6).alias("all_readable"),
            F.grouping("kind").alias("_g"),
        )
    )
    return rolled.select(
        F.when(F.col("_g") == 1, "all").otherwise(F.col("kind")).alias("kind"),
        "documents", "front_matter", "one_title", "no_skips", "tables_consistent", "all_readable",
        (F.col("no_skips") >= 0.9).alias("accepted"),
    )


def line_diff(left: DataFrame, right: DataFrame, text: str = "md") -> DataFrame:
    """(doc_id, line, n_left, n_right): lines whose counts differ between two versions.

    Lines are counted before they meet, so no pairs are formed. The first line
    of a later part is the rest of the line before and is not counted.
    """
    def side(df: DataFrame, n_left: int, n_right: int) -> DataFrame:
        lines = split_lines(F.col(text))
        if in_parts(df):
            lines = F.when(F.col("part_no") == 0, lines).otherwise(F.slice(lines, F.lit(2), F.size(lines)))
        return explode(df, ["doc_id", F.lit(n_left).alias("l"), F.lit(n_right).alias("r")], lines, "line")

    both = side(left, 1, 0).unionByName(side(right, 0, 1))
    return (
        both.groupBy("doc_id", "line")
        .agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
        .filter(F.col("n_left") != F.col("n_right"))
    )


def word_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, df): in how many documents each lower-case word occurs."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))
    return (
        explode(docs, [], words, "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def split_glued_words(
    docs: DataFrame, text: str = "text", min_df: int = 5
) -> DataFrame:
    """(word, first, second, score): rare words that are two frequent words glued together.

    A word below ``min_df`` documents is cut where both halves are frequent: at
    the highest of the lower halves' frequencies, leftmost on ties. Cuts are
    explored per distinct word, not per occurrence, and the two look-ups are
    equi joins on the halves.
    """
    df = word_frequencies(docs, text)
    frequent = df.filter(F.col("df") >= min_df)
    rare = df.filter((F.col("df") < min_df) & (F.length("word") >= 2 * MIN_HALF))
    # No half can be longer than the longest frequent word, which bounds the cuts of a long one.
    longest = frequent.select(F.max(F.length("word"))).scalar()
    n = F.length("word")
    cuts = (
        rare.select("word", F.explode(F.sequence(F.lit(MIN_HALF), n - MIN_HALF)).alias("at"))
        .filter((F.col("at") <= longest) & (n - F.col("at") <= longest))
        .select(
            "word",
            "at",
            F.substring("word", F.lit(1), F.col("at")).alias("first"),
            F.substr("word", F.col("at") + 1).alias("second"),
        )
    )
    first = frequent.select(F.col("word").alias("first"), F.col("df").alias("df1"))
    second = frequent.select(F.col("word").alias("second"), F.col("df").alias("df2"))
    found = cuts.join(first, "first").join(second, "second")
    return (
        found.groupBy("word")
        .agg(
            F.max(
                F.struct(
                    F.least("df1", "df2").alias("score"), (-F.col("at")).alias("p"), "first", "second"
                )
            ).alias("best")
        )
        .select("word", "best.first", "best.second", "best.score")
    )


def repair_glued_words(
    docs: DataFrame, cuts: DataFrame, text: str = "text"
) -> DataFrame:
    """(doc_id, line_no, line): the lines that contain a glued word, with it split.

    Each document sends its distinct words that are long enough; those found come
    back as one slim map per document, and its lines are edited in the row.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))
    sent = explode(docs, ["doc_id"], F.filter(words, lambda w: F.length(w) >= 2 * MIN_HALF), "word")
    found = (
        sent.join(cuts.select("word", F.length("first").alias("n_first")), "word")
        .groupBy("doc_id")
        .agg(F.map_from_entries(F.collect_set(F.struct("word", "n_first"))).alias("at"))
    )
    hit = docs.select("doc_id", F.col(text).alias("_text")).join(found, "doc_id")

    def mended(piece: Column) -> Column:
        n = F.try_element_at("at", F.lower(piece))
        split = F.concat(F.substr(piece, F.lit(1), n), F.lit(" "), F.substr(piece, n + 1))
        return F.when(n.isNull(), piece).otherwise(split)

    lines = explode(hit, ["doc_id", "at"], split_lines(F.col("_text")), "line", pos="line_no")
    pieces = F.regexp_extract_all("line", F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    edited = computed(lines, mended=F.array_join(F.transform(pieces, mended), ""))
    return edited.filter(F.col("mended") != F.col("line")).select("doc_id", "line_no", F.col("mended").alias("line"))
