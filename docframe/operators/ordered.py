"""Ordered work over groups of any size.

A plain window over a key sends the whole key to one task. The helpers here cut
every key into blocks that keep the order; the window over the key only sees one
slim total per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def _up_to_previous(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _whole(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def running_totals(
    slim: DataFrame,
    key: Sequence[str],
    pos: str,
    values: Sequence[str],
    block: int = BLOCK,
) -> DataFrame:
    """Exclusive running sums of ``values`` per key, in the order of ``pos``.

    ``slim`` has one narrow row per (key, pos), pos being an integer dense
    enough for ``pos div block`` to bound the rows of a block. Returns key, pos
    and ``<value>_before``.
    """
    key = list(key)
    blocks = slim.select(*key, pos, *values).withColumn("_block", F.floor(F.col(pos) / block))
    inside = Window.partitionBy(*key, "_block").orderBy(pos)
    local = blocks.select(
        *key,
        pos,
        "_block",
        F.row_number().over(inside).alias("_rn"),
        *[F.coalesce(F.sum(v).over(_up_to_previous(inside)), F.lit(0)).alias(f"_in_{v}") for v in values],
        *[F.sum(v).over(_whole(inside)).alias(f"_all_{v}") for v in values],
    )
    across = _up_to_previous(Window.partitionBy(*key).orderBy("_block"))
    carried = local.filter("_rn = 1").select(
        *key,
        "_block",
        *[F.coalesce(F.sum(f"_all_{v}").over(across), F.lit(0)).alias(f"_to_{v}") for v in values],
    )
    return local.join(carried, [*key, "_block"]).select(
        *key,
        pos,
        *[(F.col(f"_in_{v}") + F.col(f"_to_{v}")).alias(f"{v}_before") for v in values],
    )


def number_rows(
    rows: DataFrame,
    key: Sequence[str],
    blocks: dict[str, Column],
    order: Sequence[str],
    out: str = "rn",
) -> DataFrame:
    """Rows with their 1-based number per key, in ``order``.

    ``blocks`` are expressions that never decrease along ``order``; rows are
    numbered within a key's blocks, and what comes before a block is summed on
    one slim row per block, so no key needs to fit in a task.
    """
    key, names = list(key), [f"_b_{n}" for n in blocks]
    cut = rows.withColumns({f"_b_{n}": e for n, e in blocks.items()})
    sizes = cut.groupBy(*key, *names).agg(F.count(F.lit(1)).alias("_n"))
    across = _up_to_previous(Window.partitionBy(*key).orderBy(*names))
    starts = sizes.select(*key, *names, F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_to"))
    inside = Window.partitionBy(*key, *names).orderBy(*order)
    # Numbered before the join, which takes the rows in the order the numbering left them; so they are sorted once.
    numbered = cut.withColumn("_in", F.row_number().over(inside)).join(starts, [*key, *names])
    return numbered.withColumn(out, (F.col("_in") + F.col("_to")).cast("long")).drop(*names, "_in", "_to")
