"""Documents whose pages arrive in different deliveries: each is reported once all its pages are there."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Pages of a part; the state of a part is a bit for each of them and one sum for each counted column.
PART = 1000
#: Groups the parts are dealt out to by their hash. Calling Python for a group costs a thousand times what one more part
#: in it costs; a stream keeps the number it began with.
BUCKETS = 8192


def completed_parts(pages: DataFrame, sums: Sequence[str] = (), doc: str = "doc_id", part: int = PART, buckets: int = BUCKETS) -> DataFrame:
    """(doc, part_no, page_count, pages, *sums): a row for each part of a document, once its last page has come.

    ``pages`` is a stream of ``doc``, ``page_no`` (from 1), ``page_count`` and the numeric columns ``sums``,
    in any order and any deliveries. A page that comes again, in the same delivery or a later one, counts once, as it came first.
    Rows without document, page number or count, or with a number beyond the count, are no pages; a null sum counts as 0. If rows
    of a part differ in ``page_count``, the greatest so far holds; a part that was reported stays so.

    State is kept by part, a bucket of parts at a time, so a document of any length spreads over tasks, and the texts
    themselves stay in their files.
    """
    kind = pages.schema[doc].dataType.simpleString()
    number = F.col("page_no").cast("long")
    slim = (
        pages.filter(F.col(doc).isNotNull() & (number >= 1) & (number <= F.col("page_count").cast("long")))
        .select(
            F.col(doc).alias("doc"),
            F.floor((number - 1) / part).alias("part_no"),
            F.pmod(number - 1, F.lit(part)).cast("int").alias("place"),
            F.col("page_count").cast("long").alias("page_count"),
            *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"s{i}") for i, c in enumerate(sums)),
        )
    )
    columns = [f"s{i}" for i in range(len(sums))]
    shape = ["doc", "part_no", "page_count", "pages", *columns]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # (doc, part_no) -> [bits of the pages seen, page_count, sums]; of a part that was reported only the mark remains.
        known = pickle.loads(state.get[0]) if state.exists else {}
        touched = {}
        for batch in batches:
            # Plain lists: a bucket's rows are few, on which a frame's own operations cost more than the work.
            for doc_key, part_no, place, count, *counted in zip(*(batch[c].tolist() for c in ("doc", "part_no", "place", "page_count", *columns)), strict=True):
                at = (doc_key, part_no)
                if at not in known:
                    known[at] = [0, 0, [0.0] * len(columns)]
                held = known[at]
                if held is None:
                    continue
                touched[at] = True
                held[1] = max(held[1], count)
                if not held[0] >> place & 1:
                    held[0] |= 1 << place
                    held[2] = [t + c for t, c in zip(held[2], counted, strict=True)]
        done = []
        for at in touched:
            bits, count, totals = known[at]
            expected = min(part, count - at[1] * part)
            if bits.bit_count() == expected:
                done.append((*at, count, expected, *totals))
                known[at] = None
        state.update((pickle.dumps(known),))
        if done:
            yield pd.DataFrame(done, columns=shape)

    fields = "".join(f", {c} double" for c in columns)
    found = slim.withColumn("bucket", F.pmod(F.xxhash64("doc", "part_no"), F.lit(buckets))).groupBy("bucket").applyInPandasWithState(
        update,
        f"doc {kind}, part_no long, page_count long, pages long{fields}",
        "parts binary",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return found.select(F.col("doc").alias(doc), "part_no", "page_count", "pages", *(F.col(c).alias(n) for c, n in zip(columns, sums, strict=True)))


def completed_documents(parts: DataFrame, sums: Sequence[str] = (), doc: str = "doc_id") -> DataFrame:
    """(doc, pages, *sums): the documents all of whose parts were reported."""
    folded = parts.groupBy(doc).agg(F.sum("pages").alias("pages"), F.max("page_count").alias("_count"), *(F.sum(c).alias(c) for c in sums))
    return folded.filter(F.col("pages") == F.col("_count")).drop("_count")
