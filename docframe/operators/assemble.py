"""Documents from page fragments: front matter, body, validation, final text.

A document leaves here as numbered parts of at most ``pages_per_part`` pages;
the parts of a document, concatenated in order, are its file. Almost every
document is a single part. Facts that belong to the whole document (front
matter, year, heading state) are computed on slim rows and joined to the parts,
so page text is shuffled once and no task ever holds an unbounded document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions import frontmatter, outline
from docframe.functions.rows import explode
from docframe.functions.text import (
    FRONT_MATTER,
    H1_LINE,
    YEAR,
    file_stem,
    is_blank,
    split_lines,
    strip_code_fences,
    strip_front_matter,
    ustrip,
)

PAGES_PER_PART = 1000

# Front matter keys every document has.
REQUIRED_KEYS = ("titolo", "comune", "tipo", "anno")
UNKNOWN = "UNKNOWN"


def clean_fragments(fragments: DataFrame) -> DataFrame:
    """Fragments without the code fences a model puts around its answer."""
    return fragments.withColumn("page_md", strip_code_fences(F.col("page_md")))


# ------------------------------------------------------------ front matter

def front_matter_entries(block: Column) -> Column:
    """[{key, value}] of the flat ``key: value`` lines of a front matter block, for checks of its scalars.

    An indented line that is no list item goes on with the value above it.
    """
    unfolded = F.regexp_replace(block, r"\n[ \t]+(?!-(?:[ \t]|\n|\z))(?=\S)", " ")
    lines = F.filter(
        F.split(unfolded, "\n"), lambda s: s.contains(":") & ~ustrip(s).startswith("#")
    )
    return F.transform(
        lines,
        lambda s: F.struct(
            ustrip(F.substring_index(s, ":", 1)).alias("key"),
            _scalar(ustrip(F.substr(s, F.instr(s, ":") + 1))).alias("value"),
        ),
    )


def _scalar(raw: Column) -> Column:
    quoted = F.regexp_extract(raw, r"""\A(["'])(.*)\1\z""", 2)
    is_quoted = raw.rlike(r"""\A(["']).*\1\z""")
    return F.when(is_quoted, quoted).when(raw.isin("", "~", "null", "Null", "NULL"), None).otherwise(raw)


def yaml_value(value: Column) -> Column:
    """A flat YAML scalar; strings that would read as something else are quoted."""
    plain = r"\A[\p{L}\p{Nd}/(][^:#\"'{}\[\],&*!|>%@`]*(?:\([^:#\"']*\))?\z"
    ambiguous = r"(?i)\A(?:true|false|yes|no|on|off|null|~)\z"
    quote = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    return (
        F.when(value.isNull(), F.lit("null"))
        .when(value.rlike(plain) & ~value.rlike(ambiguous), value)
        .otherwise(quote)
    )


def front_matter_text(meta: Column, shown: Column) -> Column:
    """``key: value`` lines of a map, keys in alphabetical order; ``shown`` has what follows the colon of lists, maps and long texts."""
    key = lambda k: F.when(k.rlike(r"\A[\p{L}\p{Nd}_][^:#\n]*\z"), k).otherwise(F.concat(F.lit("'"), F.replace(k, F.lit("'"), F.lit("''")), F.lit("'")))
    ordered = F.array_sort(F.map_entries(meta))
    behind = lambda e: F.coalesce(F.try_element_at(shown, e["key"]), F.concat(F.lit(" "), yaml_value(e["value"])))
    return F.array_join(F.transform(ordered, lambda e: F.concat(key(e["key"]), F.lit(":"), behind(e))), "\n")


def front_matter_values(documents: DataFrame) -> DataFrame:
    """(doc_id, path, value): every scalar of the front matter that documents open with, ``a.b[0]`` being its path."""
    opening = documents.filter("part_no = 0") if "part_no" in documents.columns else documents
    blocks = opening.select("doc_id", F.regexp_extract("md", FRONT_MATTER, 1).alias("block")).filter("block <> ''")
    read = blocks.select("doc_id", frontmatter.values("block").alias("values"))
    return explode(read, ["doc_id"], "values", "v").select("doc_id", "v.*")


# ------------------------------------------------------------ slim facts

def _pages(fragments: DataFrame, pages_per_part: int) -> DataFrame:
    return fragments.select(
        "doc_id",
        "source_file",
        "page_number",
        F.floor((F.col("page_number") - 1) / pages_per_part).cast("int").alias("part"),
        F.regexp_extract("page_md", FRONT_MATTER, 1).alias("block"),
        ustrip(strip_front_matter(F.col("page_md"))).alias("body"),
    )


def _facts(pages: DataFrame) -> DataFrame:
    """One slim row per (doc_id, part): page facts folded, whole-document facts attached."""
    lines = pages.select("*", split_lines(F.col("body")).alias("lines"))
    heads = lines.select("*", outline.headings(F.col("lines")).alias("heads"))
    page = heads.select(
        "doc_id",
        "part",
        "source_file",
        "page_number",
        "block",
        (F.col("body") != "").alias("filled"),
        F.col("body").rlike(H1_LINE).alias("has_h1"),
        F.size("lines").alias("n_lines"),
        F.when(F.size("heads") > 0, F.element_at("heads", -1)["level"]).alias("last_level"),
        F.posexplode_outer(F.regexp_extract_all("body", F.lit(YEAR), F.lit(1))).alias("at", "year"),
    )
    once = F.coalesce(F.col("at"), F.lit(0)) == 0
    by_year = page.groupBy("doc_id", "part", "year").agg(
        F.count("at").alias("n"),
        F.min(F.struct("page_number", "at")).alias("seen"),
        F.min(F.struct("page_number", "block", "source_file")).alias("lead"),
        F.max("has_h1").alias("has_h1"),
        F.sum(F.when(once & F.col("filled"), F.col("n_lines") + 1)).alias("lines_out"),
        F.max(F.when(F.col("last_level").isNotNull(), F.struct("page_number", "last_level"))).alias("tail"),
        F.max("filled").alias("filled"),
    )
    year = Window.partitionBy("doc_id", "year")
    counted = by_year.withColumns(
        {"n_all": F.sum("n").over(year), "seen_all": F.min("seen").over(year)}
    )
    by_part = counted.groupBy("doc_id", "part").agg(
        F.max(
            F.when(
                F.col("year").isNotNull(),
                F.struct(
                    "n_all",
                    (-F.col("seen_all.page_number")).alias("p"),
                    (-F.col("seen_all.at")).alias("a"),
                    "year",
                ),
            )
        ).alias("mode"),
        F.min("lead").alias("lead"),
        F.max("has_h1").alias("has_h1"),
        F.sum("lines_out").alias("lines_out"),
        F.max("tail").alias("tail"),
        F.max("filled").alias("filled"),
    )
    doc = Window.partitionBy("doc_id")
    before = doc.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    any_filled = F.max("filled").over(doc)
    filled_part = F.when(F.col("filled") | ~any_filled, F.col("part"))
    return by_part.select(
        "doc_id",
        "part",
        "filled",
        F.max("mode").over(doc)["year"].alias("mode_year"),
        F.min("lead").over(doc).alias("lead"),
        F.max("has_h1").over(doc).alias("has_h1"),
        F.coalesce(F.sum("lines_out").over(before), F.lit(0)).cast("int").alias("lines_before"),
        F.coalesce(
            F.last(F.col("tail.last_level"), ignorenulls=True).over(before), F.lit(0)
        ).alias("previous_level"),
        F.min(filled_part).over(doc).alias("first_part"),
        F.max(F.when(F.col("filled"), F.col("part"))).over(doc).alias("last_part"),
    )


def _with_metadata(facts: DataFrame) -> DataFrame:
    """Facts with ``meta``, the document's completed front matter, and ``shown``, the text of its lists and maps."""
    parsed = facts.withColumn("entries", frontmatter.entries("lead.block"))
    pairs = lambda of: F.map_from_entries(F.transform("entries", lambda e: F.struct(e["key"], e[of])))
    parsed = parsed.withColumn("given", pairs("value")).withColumn("forms", F.map_filter(pairs("shown"), lambda k, v: v.isNotNull()))
    has = lambda k: F.map_contains_key("given", F.lit(k))
    missing = lambda k, v: F.when(~has(k), F.struct(F.lit(k).alias("key"), v.alias("value")))
    anno = F.when(has("anno"), F.col("given")["anno"]).otherwise(F.lit(UNKNOWN))
    year = F.when(
        anno.isNull() | anno.isin("", "0", UNKNOWN), F.coalesce("mode_year", anno)
    ).otherwise(anno)
    added = F.filter(
        F.array(
            missing("titolo", file_stem(F.col("lead.source_file"))),
            missing("comune", F.lit(UNKNOWN)),
            missing("tipo", F.lit(UNKNOWN)),
        ),
        lambda e: e.isNotNull(),
    )
    kept = F.map_filter("given", lambda k, v: k != "anno")
    meta = F.map_concat(
        kept, F.map_from_entries(added), F.create_map(F.lit("anno"), year)
    )
    same = F.map_filter("forms", lambda k, v: k != "anno")  # a year is written bare
    return parsed.select(*facts.columns, "given", meta.alias("meta"), same.alias("shown"))


def document_metadata(fragments: DataFrame) -> DataFrame:
    """(doc_id, titolo, comune, tipo, anno, given): completed front matter per document."""
    facts = _with_metadata(_facts(_pages(fragments, PAGES_PER_PART)))
    one = facts.filter(F.col("part") == F.col("first_part"))
    return one.select("doc_id", *[F.col("meta")[k].alias(k) for k in REQUIRED_KEYS], "given", "mode_year")


# ------------------------------------------------------------ parts

def assembled_parts(fragments: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """Document parts with their front matter and the heading state they start in.

    Columns: doc_id, source_file, part_no, is_first, is_last, meta, front_matter,
    body, lines_before, previous_level.
    """
    pages = _pages(fragments, pages_per_part)
    # at most pages_per_part pages meet in one group
    texts = (
        pages.select("doc_id", "part", F.struct("page_number", "body").alias("p"))
        .groupBy("doc_id", "part")
        .agg(F.sort_array(F.collect_list("p")).alias("pages"))
        .select(
            "doc_id",
            "part",
            F.array_join(
                F.filter(F.transform("pages", lambda p: p["body"]), lambda b: b != ""), "\n\n"
            ).alias("text"),
        )
    )
    facts = _with_metadata(_facts(pages)).withColumn(
        "heading",
        F.when(
            ~F.col("has_h1"),
            F.concat(F.lit("# "), F.coalesce(F.col("meta")["titolo"], F.lit("None")), F.lit("\n\n")),
        ).otherwise(F.lit("")),
    )
    first = F.col("part") == F.col("first_part")
    extra = F.when(F.col("has_h1"), 0).otherwise(2)
    return (
        texts.join(facts, ["doc_id", "part"])
        .filter(F.col("filled") | first)
        .select(
            "doc_id",
            F.col("lead.source_file").alias("source_file"),
            F.col("part").alias("part_no"),
            first.alias("is_first"),
            (F.col("part") == F.coalesce("last_part", "first_part")).alias("is_last"),
            "meta",
            front_matter_text(F.col("meta"), F.col("shown")).alias("front_matter"),
            F.when(first, F.concat("heading", "text")).otherwise(F.col("text")).alias("body"),
            F.when(first, 0).otherwise(F.col("lines_before") + extra).alias("lines_before"),
            F.when(first, 0)
            .when((F.col("previous_level") == 0) & ~F.col("has_h1"), 1)
            .otherwise(F.col("previous_level"))
            .alias("previous_level"),
        )
    )


def _file_text(body: Column) -> Column:
    return F.concat(
        F.when(
            F.col("is_first"), F.concat(F.lit("---\n"), "front_matter", F.lit("\n---\n\n"))
        ).otherwise(F.lit("\n\n")),
        body,
        F.when(F.col("is_last"), F.lit("\n")).otherwise(F.lit("")),
    )


def assemble_documents(fragments: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """(doc_id, part_no, md): assembled documents before validation."""
    return assembled_parts(fragments, pages_per_part).select(
        "doc_id", "part_no", _file_text(F.col("body")).alias("md")
    )


def validated_parts(fragments: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """Document parts with repaired bodies and the warnings of the unrepaired ones."""
    parts = assembled_parts(fragments, pages_per_part)
    lined = parts.select("*", split_lines(F.concat("body", F.lit("\n"))).alias("lines"))
    headed = lined.select("*", outline.headings(F.col("lines")).alias("heads"))
    paired = headed.select(
        "*", outline.with_previous(F.col("heads"), F.col("previous_level")).alias("paired")
    )
    missing = F.filter(
        F.array(
            *[
                F.when(
                    F.coalesce(F.col("meta")[k], F.lit("")) == "",
                    F.lit(f"Missing required front matter field: '{k}'"),
                )
                for k in REQUIRED_KEYS
            ]
        ),
        lambda w: w.isNotNull(),
    )
    missing = F.when(F.col("is_first"), missing).otherwise(F.array().cast("array<string>"))
    skips = F.transform(
        F.filter("paired", outline.skipped),
        lambda h: outline.skip_message(h, F.col("lines_before")),
    )
    fixed = outline.repaired_lines(F.col("lines"), F.col("heads"), F.col("paired"))
    return paired.select(
        "doc_id", "source_file", "part_no", "is_first", "is_last", "meta", "front_matter",
        F.array_join(fixed, "\n").alias("body"),
        F.concat(missing, skips).alias("warnings"),
    )


def validation_warnings(fragments: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """(doc_id, warning_no, warning) in document order, numbered through all parts."""
    parts = validated_parts(fragments, pages_per_part).select("doc_id", "part_no", "warnings")
    earlier = Window.partitionBy("doc_id").orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    counted = parts.withColumn("before", F.coalesce(F.sum(F.size("warnings")).over(earlier), F.lit(0)).cast("int"))
    rows = explode(counted, ["doc_id", "before"], "warnings", "warning", pos="_pos")
    return rows.select("doc_id", (F.col("before") + F.col("_pos")).alias("warning_no"), "warning")


def md_documents(fragments: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """(doc_id, source_file, part_no, md): the final Markdown files."""
    return validated_parts(fragments, pages_per_part).select(
        "doc_id", "source_file", "part_no", _file_text(F.col("body")).alias("md")
    )


# ------------------------------------------------------------ page text

def nonblank_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(~is_blank(F.col("text")))


def documents_without_text(pages: DataFrame) -> DataFrame:
    """(doc_id, error) for the documents none of whose pages has text."""
    return (
        pages.groupBy("doc_id")
        .agg(F.max(~is_blank(F.col("text"))).alias("filled"))
        .filter(~F.col("filled"))
        .select("doc_id", F.lit("no text extracted").alias("error"))
    )


def full_text(pages: DataFrame, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """(doc_id, part_no, text): non-blank page texts, a blank line between them.

    Parts after the first begin with their separator, so that concatenating the
    parts of a document gives its whole text. Which part is the first comes from
    a window over slim rows, joined back by part.
    """
    parts = (
        nonblank_pages(pages)
        .withColumn("part", F.floor((F.col("page_number") - 1) / pages_per_part).cast("int"))
        .groupBy("doc_id", "part")
        .agg(F.sort_array(F.collect_list(F.struct("page_number", "text"))).alias("pages"))
        .select(
            "doc_id",
            "part",
            F.array_join(F.transform("pages", lambda p: p["text"]), "\n\n").alias("text"),
        )
    )
    part_of = F.floor((F.col("page_number") - 1) / pages_per_part).cast("int").alias("part")
    filled = nonblank_pages(pages).select("doc_id", part_of).distinct()
    starts = filled.select("doc_id", "part", (F.min("part").over(Window.partitionBy("doc_id")) == F.col("part")).alias("first"))
    return parts.join(starts, ["doc_id", "part"]).select(
        "doc_id",
        F.col("part").alias("part_no"),
        F.when(F.col("first"), F.col("text")).otherwise(F.concat(F.lit("\n\n"), "text")).alias("text"),
    )
