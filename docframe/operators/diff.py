"""Two versions of a document compared line by line, in order.

Lines that both versions have once are anchors; the longest run of anchors that keep their order stays in place, and
the lines between two of them are compared the same way, after those that agree at either end. Where no line stands
once on both sides, the n-th of a repeated line meets the n-th; where none is common, left lines are removed and right
ones added. A removed line that is added elsewhere has moved.

Only numbers and hashes of lines are compared, sixteen bytes a line; one task holds those of one document at a time.
Texts meet the lines that differ by document and number.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docframe.functions.rows import computed, explode
from docframe.functions.text import split_lines
from docframe.operators.parts import in_parts, line_ends, with_earlier


def longest_run(values: Sequence[int]) -> list[int]:
    """Places of the longest increasing run of different numbers, the one that ends lowest."""
    tops: list[int] = []
    places: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        before.append(places[k - 1] if k else -1)
        tops[k : k + 1] = [v]
        places[k : k + 1] = [i]
    out, i = [], places[-1] if places else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _anchors(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal lines, in the order of the left ones, each place once."""
    n, m = Counter(a), Counter(b)
    place = {v: j for j, v in enumerate(b) if m[v] == 1 and n[v] == 1}
    if place:
        return [(i, place[v]) for i, v in enumerate(a) if v in place]
    spots: dict[int, list[int]] = {}
    for j, v in enumerate(b):
        if v in n:
            spots.setdefault(v, []).append(j)
    seen: Counter = Counter()
    out = []
    for i, v in enumerate(a):
        if v in spots and seen[v] < len(spots[v]):
            out.append((i, spots[v][seen[v]]))
            seen[v] += 1
    return out


def kept_pairs(left: Sequence[int], right: Sequence[int]) -> list[tuple[int, int]]:
    """Places (left, right) of the lines that stay in place, in order."""
    out: list[tuple[int, int]] = []
    open_blocks = [(0, len(left), 0, len(right))]
    while open_blocks:
        a0, a1, b0, b1 = open_blocks.pop()
        while a0 < a1 and b0 < b1 and left[a0] == right[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and left[a1 - 1] == right[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        found = _anchors(left[a0:a1], right[b0:b1])
        run = [found[k] for k in longest_run([j for _, j in found])]
        out += [(a0 + i, b0 + j) for i, j in run]
        edges = [(-1, -1), *run, (a1 - a0, b1 - b0)]
        if run:
            open_blocks += [(a0 + i + 1, a0 + k, b0 + j + 1, b0 + n) for (i, j), (k, n) in zip(edges[:-1], edges[1:], strict=True) if k > i + 1 and n > j + 1]
    return sorted(out)


def differences(left: Sequence[int], right: Sequence[int]) -> list[tuple[str, int | None, int | None]]:
    """(change, left place, right place): removed, added and moved lines."""
    kept = kept_pairs(left, right)
    stay, came = {i for i, _ in kept}, {j for _, j in kept}
    added: dict[int, list[int]] = {}
    for j, v in enumerate(right):
        if j not in came:
            added.setdefault(v, []).append(j)
    for spots in added.values():
        spots.reverse()
    out: list[tuple[str, int | None, int | None]] = []
    for i, v in enumerate(left):
        if i not in stay:
            out.append(("moved", i, added[v].pop()) if added.get(v) else ("removed", i, None))
    return out + [("added", None, j) for spots in added.values() for j in spots]


def _lines(docs: DataFrame, text: str, side: int) -> DataFrame:
    """(doc_id, side, line_no, line); of a later part the first line goes on with the line before and is not one."""
    whole = not in_parts(docs)
    part = [F.lit(0).alias("part_no")] if whole else ["part_no"]
    cut = computed(docs.select("doc_id", *part, F.col(text).alias("_t")), lines=split_lines(F.col("_t")), ends=line_ends(F.col("_t"))).drop("_t")
    cut = with_earlier(cut, whole, {"ends": F.col("ends")})
    rows = explode(cut, ["doc_id", "part_no", "ends_before"], "lines", "line", pos="pos").filter("part_no = 0 OR pos > 0")
    return rows.select("doc_id", F.lit(side).alias("side"), (F.col("ends_before") + F.col("pos") + 1).cast("int").alias("line_no"), "line")


def _compared(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple = ()
        sides: tuple[list, list] = ([], [])

        def end() -> Iterator[pa.RecordBatch]:
            if now:
                left, right = (np.concatenate([np.empty((2, 0), np.int64), *s], axis=1) for s in sides)
                rows = differences(left[1].tolist(), right[1].tolist())
                if rows:
                    number = lambda of, place: None if place is None else int(of[0][place])
                    columns = [[now[0]] * len(rows), [r[0] for r in rows], [number(left, r[1]) for r in rows], [number(right, r[2]) for r in rows]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            keys, side = batch["doc_id"].to_pylist(), batch["side"].to_pylist()
            values = np.stack([batch["line_no"].to_numpy(), batch["hash"].to_numpy()]).astype(np.int64)
            at = 0
            while at < len(keys):
                to = at
                while to < len(keys) and keys[to] == keys[at] and side[to] == side[at]:
                    to += 1
                if now != (keys[at],):
                    yield from end()
                    now, sides = (keys[at],), ([], [])
                sides[side[at]].append(values[:, at:to])
                at = to
        yield from end()

    return run


def ordered_diff(left: DataFrame, right: DataFrame, text: str = "md") -> DataFrame:
    """(doc_id, change, left_line, right_line, line): lines removed, added or moved between two versions, numbered from 1.

    A document that only one side has is all removed or all added. Documents may come in parts.
    """
    key = left.schema["doc_id"].dataType
    schema = pa.schema([("doc_id", to_arrow_type(key)), ("change", pa.string()), ("left_line", pa.int32()), ("right_line", pa.int32())])
    both = _lines(left, text, 0).unionByName(_lines(right, text, 1))
    slim = both.select("doc_id", "side", "line_no", F.xxhash64("line").alias("hash"))
    found = slim.repartition("doc_id").sortWithinPartitions("doc_id", "side", "line_no").mapInArrow(
        _compared(schema), f"doc_id {key.simpleString()}, change string, left_line int, right_line int"
    )
    where = found.withColumns({"side": F.when(F.col("left_line").isNull(), 1).otherwise(0), "line_no": F.coalesce("left_line", "right_line")})
    return where.join(both, ["doc_id", "side", "line_no"]).select("doc_id", "change", "left_line", "right_line", "line")
