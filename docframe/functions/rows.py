"""Turning arrays into rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode(
    df: DataFrame,
    keep: Sequence[str | Column],
    array: str | Column,
    name: str,
    pos: str | None = None,
) -> DataFrame:
    """One row per array element, with its position if ``pos`` names a column.

    Uses the outer generator and drops the rows of empty arrays afterwards. The
    inner generator makes the optimizer test the size of the array in a filter
    of its own, which evaluates the expression behind it a second time.
    """
    at = pos or "_at"
    rows = df.select(*keep, F.posexplode_outer(array).alias(at, name)).filter(F.col(at).isNotNull())
    return rows if pos else rows.drop(at)


def inline(df: DataFrame, keep: Sequence[str | Column], array: str | Column) -> DataFrame:
    """One row per array element, the fields of the element as columns."""
    rows = explode(df, keep, array, "_element")
    return rows.select(*[c for c in rows.columns if c != "_element"], "_element.*")


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are evaluated once per row, however often they are read.

    A projection may be merged into those above it, and a filter on its result
    is moved below it; either repeats the work. A generator is a boundary both
    stop at.
    """
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(values)))
