"""Documents that come in parts.

A very long document is several rows (doc_id, part_no, text) whose texts, one
after the other, are its file. Operators on documents read parts like whole
documents: what a part needs of the earlier ones (numbers of lines, open
headings) is summed on slim rows, one per part, and joined to it. Frames without
``part_no`` are whole documents and are neither shuffled nor joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docframe.functions.rows import inline
from docframe.functions.text import unix_lines

KEY = ("doc_id", "part_no")


def in_parts(docs: DataFrame) -> bool:
    return "part_no" in docs.columns


def line_ends(text: Column) -> Column:
    """Lines that a text ends: where the next part's first line continues."""
    return F.size(F.split(unix_lines(text), "\n")) - 1


def gathered(first: DataFrame, second: DataFrame, together: bool = False) -> DataFrame:
    """(doc_id, part_no, first, second): the items of two (doc_id, part_no, item) frames by part; null items are left out.

    Parts without any item have no row. Both frames are shuffled by part, so no group grows with a document. Documents
    of bounded size whose rows lie ``together`` in both frames meet where they are, and are dealt to their parts in the
    row; there ``first`` has a row of each document that ``second`` has.
    """
    if not together:
        none_a, none_b = (F.lit(None).cast(df.schema["item"].dataType) for df in (first, second))
        rows = lambda df, a, b: df.filter("item IS NOT NULL").select(*KEY, a.alias("a"), b.alias("b"))
        both = rows(first, F.col("item"), none_b).unionByName(rows(second, none_a, F.col("item")))
        return both.groupBy(*KEY).agg(F.collect_list("a").alias("first"), F.collect_list("b").alias("second"))
    items = F.collect_list(F.when(F.col("item").isNotNull(), F.struct("part_no", "item")))
    of = lambda df, name: df.groupBy("doc_id").agg(items.alias(name))
    # The size of what was parsed is a guess that is far too low; it is never broadcast on it.
    both = of(first, "a").join(of(second, "b").hint("merge"), "doc_id", "left").select("doc_id", "a", F.coalesce("b", F.array()).alias("b"))
    found = F.array_distinct(F.concat(F.transform("a", lambda x: x["part_no"]), F.transform("b", lambda x: x["part_no"])))
    own = lambda name, p: F.transform(F.filter(name, lambda x: x["part_no"].eqNullSafe(p)), lambda x: x["item"])
    return inline(both, ["doc_id"], F.transform(found, lambda p: F.struct(p.alias("part_no"), own("a", p).alias("first"), own("b", p).alias("second"))))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``part_no``, 0 for whole documents."""
    return docs if in_parts(docs) else docs.withColumn("part_no", F.lit(0))


def with_earlier(
    docs: DataFrame, whole: bool, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None
) -> DataFrame:
    """``docs`` with ``<name>_before``: the sum, or the last value that is not null, over a document's earlier parts."""
    sums, lasts = sums or {}, lasts or {}
    if whole:
        values = {f"{n}_before": F.lit(0).cast("int") for n in sums}
        nothing = docs.select(*[e.alias(n) for n, e in lasts.items()]).schema
        return docs.withColumns(values | {f"{n}_before": F.lit(None).cast(nothing[n].dataType) for n in lasts})
    slim = docs.select(*KEY, *[e.alias(n) for n, e in (sums | lasts).items()])
    earlier = Window.partitionBy("doc_id").orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    found = slim.select(
        *KEY,
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).cast("int").alias(f"{n}_before") for n in sums],
        *[F.last(n, ignorenulls=True).over(earlier).alias(f"{n}_before") for n in lasts],
    )
    return docs.join(found, list(KEY))
