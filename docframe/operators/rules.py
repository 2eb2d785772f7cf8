"""Rules over the fields of a record, its line items, and all documents.

Rules are declared, then compiled: those on one record become expressions of a single projection, the sums they
need one aggregation of the items, and values that may occur once one aggregation over all documents, whatever the
number of rules. A rule with a missing field says nothing; that is the business of required fields.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.rows import explode
from docframe.operators.fields import amount

BROKEN = "array<struct<rule:string,about:string,expected:string,found:string>>"


@dataclass(frozen=True)
class SumsTo:
    """The amounts of an item column add up to a field, up to ``tolerance``."""

    total: str
    item: str
    tolerance: Decimal = Decimal("0.00")


@dataclass(frozen=True)
class InOrder:
    """Fields that do not decrease from one to the next, dates or numbers."""

    names: tuple[str, ...]


@dataclass(frozen=True)
class UniqueOver:
    """Fields whose values together stand in one document only."""

    names: tuple[str, ...]


@dataclass(frozen=True)
class Holds:
    """A condition of one's own on a record: ``test`` gets a function from names to columns."""

    name: str
    test: Callable[[Callable[[str], Column]], Column] = field(compare=False)
    expected: str = ""


Rule = SumsTo | InOrder | UniqueOver | Holds


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _broken(when: Column, rule: str, about: str, expected: Column, found: Column) -> Column:
    return F.when(
        F.coalesce(when, F.lit(False)),
        F.struct(F.lit(rule).alias("rule"), F.lit(about).alias("about"), _text(expected).alias("expected"), _text(found).alias("found")),
    )


def _sum_column(rule: SumsTo, what: str) -> str:
    return f"_{what}_{rule.item}"


def _with_sums(records: DataFrame, items: DataFrame | None, rules: Sequence[SumsTo], decimal: str | None) -> DataFrame:
    """Records with the sum of each item column that a rule names, and how many of its values are no amounts."""
    if not rules or items is None:
        return records
    one = {r.item: r for r in rules}
    read = items.filter(F.col("name").isin(*one)).select("doc_id", "name", "value", amount(F.col("value").cast("string"), decimal=decimal).alias("n"))
    summed = read.groupBy("doc_id").agg(
        *[F.sum(F.when(F.col("name") == n, F.col("n"))).alias(_sum_column(r, "sum")) for n, r in one.items()],
        *[F.count_if((F.col("name") == n) & F.col("value").isNotNull() & F.col("n").isNull()).alias(_sum_column(r, "bad")) for n, r in one.items()],
    )
    return records.join(summed, "doc_id", "left")


def _shared(records: DataFrame, rules: Sequence[UniqueOver]) -> DataFrame | None:
    """Violations by values that several documents have: one aggregation for all rules."""
    if not rules:
        return None
    entry = lambda r: F.when(
        F.greatest(*[F.col(n).isNull() for n in r.names], F.lit(False)) == F.lit(False),
        F.struct(F.lit(", ".join(r.names)).alias("about"), F.concat_ws(" | ", *[F.col(n).cast("string") for n in r.names]).alias("value")),
    )
    values = explode(records, ["doc_id"], F.array_compact(F.array(*[entry(r) for r in rules])), "v").select("doc_id", "v.*").distinct()
    several = values.groupBy("about", "value").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).filter("n > 1")
    met = values.join(several, ["about", "value"])
    return met.select(
        "doc_id", F.lit("unique").alias("rule"), "about", F.concat(F.lit("in one document, first in "), F.col("first").cast("string")).alias("expected"),
        F.concat(F.col("value"), F.lit(" in "), F.col("n").cast("string")).alias("found"),
    )


def rule_violations(records: DataFrame, rules: Sequence[Rule], items: DataFrame | None = None, decimal: str | None = None) -> DataFrame:
    """(doc_id, rule, about, expected, found): every rule that a record breaks.

    ``records`` has one row per document with a typed column per field, ``items`` (doc_id, name, value) are amounts as
    written. A sum with values that are no amounts breaks its rule, since it cannot be told.
    """
    of = lambda kind: [r for r in rules if isinstance(r, kind)]
    checks = []
    for r in of(SumsTo) if items is not None else []:
        total, got, bad = F.col(r.total), F.col(_sum_column(r, "sum")), F.coalesce(F.col(_sum_column(r, "bad")), F.lit(0))
        differs = F.abs(total.cast("decimal(20,2)") - F.coalesce(got, F.lit(0))) > F.lit(r.tolerance)
        said = F.when(bad > 0, F.concat(bad.cast("string"), F.lit(" values are no amounts"))).otherwise(F.coalesce(got, F.lit(0)).cast("decimal(20,2)").cast("string"))
        checks.append(_broken(total.isNotNull() & ((bad > 0) | differs), "sum", f"{r.item} to {r.total}", total.cast("decimal(20,2)"), said))
    for r in of(InOrder):
        for a, b in zip(r.names[:-1], r.names[1:], strict=True):
            checks.append(_broken(F.col(a) > F.col(b), "order", f"{a} to {b}", F.concat(F.lit("at least "), _text(F.col(a))), F.col(b)))
    for r in of(Holds):
        checks.append(_broken(~r.test(F.col), "holds", r.name, F.lit(r.expected), F.lit("")))
    whole = _with_sums(records, items, of(SumsTo), decimal)
    found = F.array_compact(F.array(*checks)) if checks else F.array()
    out = explode(whole, ["doc_id"], found.cast(BROKEN), "r").select("doc_id", "r.*")
    shared = _shared(records, of(UniqueOver))
    return out if shared is None else out.unionByName(shared)
