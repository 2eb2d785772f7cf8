"""Heading checks, repair, sections and chunks of Markdown documents.

A document is one text cell, or one per part; outline work stays in the row and
only slim results leave it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions import outline
from docframe.functions.rows import computed, explode
from docframe.functions.text import WS, split_lines, ustrip
from docframe.operators.parts import in_parts, line_ends, numbered, with_earlier
from docframe.session import written

LINES_PER_CHUNK = 60
LEVELS = 4


def _outlined(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, part_no, lines, heads, ends_before, level_before): outlines with what earlier parts leave open."""
    whole = not in_parts(docs)
    source = numbered(docs).select("doc_id", "part_no", F.col(text).alias("_md"))
    lined = computed(source, lines=split_lines(F.col("_md")), ends=line_ends(F.col("_md"))).drop("_md")
    headed = computed(lined, heads=outline.headings(F.col("lines")))
    last = F.when(F.size("heads") > 0, F.element_at("heads", -1)["level"])
    carried = with_earlier(headed, whole, {"ends": F.col("ends")}, {"level": last})
    return carried.withColumn("level_before", F.coalesce("level_before", F.lit(0)))


def _key(docs: DataFrame) -> list[str]:
    return ["doc_id", "part_no"] if in_parts(docs) else ["doc_id"]


def heading_skips(docs: DataFrame, text: str = "md") -> DataFrame:
    """One row per heading that skips a level; lines are counted through all parts."""
    paired = outline.with_previous(F.col("heads"), F.col("level_before"))
    skips = F.filter(paired, outline.skipped)
    return explode(_outlined(docs, text), ["doc_id", "ends_before"], skips, "h").select(
        "doc_id",
        (F.col("h.line_no") + F.col("ends_before")).alias("line_no"),
        F.col("h.previous").alias("previous_level"),
        F.col("h.level").alias("level"),
        outline.skip_message(F.col("h"), F.col("ends_before")).alias("message"),
    )


def fix_heading_skips(docs: DataFrame, text: str = "md") -> DataFrame:
    """The documents, or their parts, with a filler heading before each one-level skip."""
    paired = computed(_outlined(docs, text), paired=outline.with_previous(F.col("heads"), F.col("level_before")))
    fixed = outline.repaired_lines(F.col("lines"), F.col("heads"), F.col("paired"))
    return paired.select(*_key(docs), F.array_join(fixed, "\n").alias(text))


def _title(line: Column) -> Column:
    return ustrip(F.regexp_replace(line, rf"^#{{1,4}}{WS}+", ""))


def _opened(stack: Column, head: Column) -> Column:
    """The titles of the open headings, by level, after one more heading."""
    return F.transform(
        stack, lambda t, k: F.when(k + 1 < head["level"], t).when(k + 1 == head["level"], _title(head["text"]))
    )


def sections(docs: DataFrame, text: str = "md") -> DataFrame:
    """Section index: heading, path of enclosing headings, line range, body.

    Of documents in parts, a section that goes on in a later part has a row
    there too, with ``piece_no`` counting up; its pieces' bodies, joined by line
    ends, are its body.
    """
    whole = not in_parts(docs)
    nothing = F.array(*[F.lit(None).cast("string")] * LEVELS)
    fold = lambda start: F.aggregate("heads", start, _opened)
    marked = _outlined(docs, text)
    touched = lambda k: F.exists("heads", lambda h: h["level"] <= k + 1)
    closing = fold(nothing)
    lasts = {f"t{k}": F.when(touched(k), F.struct(closing[k].alias("title"))) for k in range(LEVELS)}
    lasts["at"] = F.when(F.size("heads") > 0, F.struct("part_no", F.element_at("heads", -1)["level"].alias("level"), _title(F.element_at("heads", -1)["text"]).alias("title")))
    marked = with_earlier(marked, whole, {"n": F.size("heads")}, lasts)
    stack = F.array(*[F.col(f"t{k}_before")["title"] for k in range(LEVELS)])
    start = F.struct(stack.alias("stack"), F.array().cast("array<string>").alias("paths"))
    path = lambda s, level: F.array_join(F.filter(F.slice(s, F.lit(1), level), lambda t: t.isNotNull()), " > ")

    def step(state: Column, h: Column) -> Column:
        after = _opened(state["stack"], h)
        return F.struct(after.alias("stack"), F.concat(state["paths"], F.array(path(after, h["level"]))).alias("paths"))

    marked = computed(
        marked,
        cuts=outline.with_end(F.col("heads"), F.size("lines")),
        paths=F.aggregate("heads", start, step, lambda s: s["paths"]),
        stack=stack,
    )
    row = lambda no, piece, level, title, where, first, last, body: F.struct(
        no.cast("int").alias("section_no"), piece.cast("int").alias("piece_no"), level.cast("int").alias("level"),
        title.alias("title"), where.alias("path"), first.alias("first_line"), last.alias("last_line"), body.alias("body"),
    )
    cut = lambda a, n: F.array_join(F.slice(F.col("lines"), a, F.greatest(n, F.lit(0))), "\n")
    here = F.transform(
        "cuts",
        lambda h, i: row(
            F.col("n_before") + i + 1, F.lit(0), h["level"], _title(h["text"]), F.get("paths", i),
            h["line_no"] + F.col("ends_before"), h["end"] + F.col("ends_before"),
            cut(h["line_no"] + 1, h["end"] - h["line_no"]),
        ),
    )
    if not whole:
        # The first line of a later part is the rest of the line before; what follows up to a heading goes on.
        until = F.when(F.size("heads") > 0, F.get("heads", F.lit(0))["line_no"] - 1).otherwise(F.size("lines"))
        on = row(
            F.col("n_before"), F.col("part_no") - F.col("at_before.part_no"), F.col("at_before.level"),
            F.col("at_before.title"), path(F.col("stack"), F.col("at_before.level")), F.col("ends_before") + 2,
            F.col("ends_before") + until, cut(F.lit(2), until - 1),
        )
        goes_on = F.col("at_before").isNotNull() & (until > 1)
        here = F.concat(F.when(goes_on, F.array(on)).otherwise(F.array().cast(marked.select(F.array(on).alias("x")).schema["x"].dataType)), here)
    rows = explode(marked, ["doc_id"], here, "s").select("doc_id", "s.*")
    return rows.drop("piece_no") if whole else rows


def chunks(docs: DataFrame, text: str = "md", lines_per_chunk: int = LINES_PER_CHUNK) -> DataFrame:
    """Chunks of about ``lines_per_chunk`` lines that start at headings only.

    Of documents in parts, a chunk that goes on in a later part has a row there
    too, with ``piece_no`` counting up; pieces are joined by line ends.
    """
    whole = not in_parts(docs)
    bucket = lambda line: F.floor((line - 1) / lines_per_chunk)
    marked = _outlined(docs, text)
    last = F.when(F.size("heads") > 0, F.element_at("heads", -1)["line_no"] + F.col("ends_before"))
    marked = with_earlier(marked, whole, None, {"start": last}).filter(F.size("lines") > 0)
    own = F.transform("heads", lambda h: h["line_no"] + F.col("ends_before"))
    begins = F.col("ends_before") == 0 if whole else F.col("part_no") == 0
    starts = F.when(begins & (F.coalesce(F.get(own, F.lit(0)), F.lit(0)) != 1), F.concat(F.array(F.lit(1)), own)).otherwise(own)
    marked = computed(marked, starts=starts)
    # The start before the first one of a part: the last heading so far, or the document's first line.
    before = F.when(~begins, F.coalesce("start_before", F.lit(1))).cast("int")
    previous = F.concat(F.array(before), F.col("starts"))
    opened = F.filter(
        F.zip_with("starts", previous, lambda s, p: F.when(p.isNull() | (bucket(s) != bucket(p)), s)),
        lambda s: s.isNotNull(),
    )
    return _chunk_rows(computed(marked, opened=opened), whole)


def _chunk_rows(marked: DataFrame, whole: bool) -> DataFrame:
    """The chunks that start at the lines ``opened`` names."""
    marked = with_earlier(marked, whole, {"n": F.size("opened")}, {"at": F.when(F.size("opened") > 0, F.col("part_no"))})
    end = F.size("lines") + F.col("ends_before")
    ends = F.concat(F.transform(F.slice("opened", F.lit(2), F.size("opened")), lambda s: s - 1), F.array(end))
    piece = lambda no, p, s, e: F.struct(
        no.cast("int").alias("chunk_no"), p.cast("int").alias("piece_no"), s.cast("int").alias("first_line"), e.cast("int").alias("last_line"),
        F.array_join(F.slice(F.col("lines"), s - F.col("ends_before"), e - s + 1), "\n").alias("text"),
    )
    marked = computed(marked, closes=ends)
    spans = F.filter(
        F.transform(F.arrays_zip(F.col("opened").alias("s"), F.col("closes").alias("e")), lambda z, i: F.when(z["s"].isNotNull(), piece(F.col("n_before") + i, F.lit(0), z["s"], z["e"]))),
        lambda p: p.isNotNull(),
    )
    if not whole:
        until = F.when(F.size("opened") > 0, F.get("opened", F.lit(0)) - 1).otherwise(end)
        on = piece(F.col("n_before") - 1, F.col("part_no") - F.col("at_before"), F.col("ends_before") + 2, until)
        goes_on = F.col("at_before").isNotNull() & (until >= F.col("ends_before") + 2)
        spans = F.concat(F.filter(F.array(F.when(goes_on, on)), lambda p: p.isNotNull()), spans)
    rows = explode(marked, ["doc_id"], spans, "c").select("doc_id", "c.*")
    return rows.drop("piece_no") if whole else rows


def _cut_table(own: Column, lines: int) -> Column:
    """[{until, to}]: where the open chunk starts behind a part, by where it started before it.

    A chunk that started at ``until`` at the latest, and after the entry before, is closed in the part, and the last
    one that is opened there starts at ``to``; one that started later goes on. Entries that lead to the same start
    are one, so few are left: cuts soon fall together wherever they began.
    """
    entry = lambda until, to: F.struct(until.cast("int").alias("until"), to.cast("int").alias("to"))
    none = F.array().cast("array<struct<until:int,to:int>>")
    onward = lambda h, done: F.get(F.filter(done, lambda e: e["until"] >= h), F.lit(0))["to"]
    # From the last heading to the first: a chunk cut at a heading goes on as the table behind it says.
    table = F.aggregate(
        F.reverse(own), none,
        lambda done, h: F.concat(F.array(entry(h - lines, F.coalesce(onward(h, done), h))), done),
    )
    return _joined_entries(table)


def _joined_entries(table: Column) -> Column:
    none = F.array().cast("array<struct<until:int,to:int>>")
    first = lambda done: F.get(done, F.lit(0))["to"]
    return F.aggregate(F.reverse(table), none, lambda done, e: F.when(F.coalesce(first(done) == e["to"], F.lit(False)), done).otherwise(F.concat(F.array(e), done)))


def _composed(earlier: Column, later: Column) -> Column:
    """The table of two neighbouring stretches of a document."""
    through = F.transform(
        earlier,
        lambda e: F.struct(e["until"].alias("until"), F.coalesce(F.get(F.filter(later, lambda x: x["until"] >= e["to"]), F.lit(0))["to"], e["to"]).alias("to")),
    )
    reach = F.coalesce(F.get(earlier, F.size(earlier) - 1)["until"], F.lit(-(2**31) + 1))
    return _joined_entries(F.concat(through, F.filter(later, lambda x: x["until"] > reach)))


def _open_before(marked: DataFrame, lines: int) -> DataFrame:
    """(doc_id, part_no, start_before): where the chunk starts that is open before each part.

    Every part is a step function of that start, and functions compose: in each round a part takes in the stretch
    of the parts before its own, twice as long as the last round's, so the rounds grow with the logarithm of the
    longest document's parts. Only tables are joined, no text.
    """
    tables = marked.select("doc_id", "part_no", _cut_table(F.col("own"), lines).alias("table"))
    parts = tables.groupBy("doc_id").agg((F.max("part_no") + 1).alias("n")).agg(F.max("n")).first()[0] or 1
    reach = 1
    tables = written(tables, "cuts") if parts > 1 else tables
    while reach < parts:
        before = tables.select("doc_id", (F.col("part_no") + reach).alias("part_no"), F.col("table").alias("earlier"))
        both = tables.join(before, ["doc_id", "part_no"], "left")
        tables = written(both.select("doc_id", "part_no", F.when(F.col("earlier").isNull(), F.col("table")).otherwise(_composed(F.col("earlier"), F.col("table"))).alias("table")), "cuts")
        reach *= 2
    begun = F.coalesce(F.get(F.filter("table", lambda e: e["until"] >= 1), F.lit(0))["to"], F.lit(1))
    return tables.select("doc_id", (F.col("part_no") + 1).alias("part_no"), begun.alias("start_before"))


def greedy_chunks(docs: DataFrame, text: str = "md", lines_per_chunk: int = LINES_PER_CHUNK) -> DataFrame:
    """Chunks that close at the first heading once they have ``lines_per_chunk`` lines.

    The first begins at the first line. Rows are those of ``chunks``. Part numbers of documents in parts run from 0.
    """
    whole = not in_parts(docs)
    marked = _outlined(docs, text).filter(F.size("lines") > 0)
    marked = computed(marked, own=F.transform("heads", lambda h: (h["line_no"] + F.col("ends_before")).cast("int")))
    begins = F.lit(True) if whole else F.col("part_no") == 0
    if whole:
        marked = marked.withColumn("start_before", F.lit(1))
    else:
        marked = marked.join(_open_before(marked, lines_per_chunk), ["doc_id", "part_no"], "left")
    none = F.array().cast("array<int>")
    cut = F.aggregate(
        "own",
        F.struct(F.coalesce("start_before", F.lit(1)).cast("int").alias("start"), none.alias("cuts")),
        lambda at, h: F.when(h - at["start"] >= lines_per_chunk, F.struct(h.alias("start"), F.concat(at["cuts"], F.array(h)).alias("cuts"))).otherwise(at),
        lambda at: at["cuts"],
    )
    opened = F.when(begins, F.concat(F.array(F.lit(1)), cut)).otherwise(cut)
    return _chunk_rows(computed(marked, opened=opened), whole)
