"""Two versions compared in order."""

from __future__ import annotations

import random
from itertools import combinations

from docframe.operators import diff


def rebuilt(left, right, rows):
    """The right side made of the left one and what is said to differ."""
    gone = {i for change, i, _ in rows if change in ("removed", "moved")}
    new = {j: right[j] for change, _, j in rows if change in ("added", "moved")}
    stay = iter([v for i, v in enumerate(left) if i not in gone])
    return [new[j] if j in new else next(stay) for j in range(len(right))]


def test_differences_make_the_right_side():
    rng = random.Random(1)
    for _ in range(2000):
        left = [rng.randrange(rng.choice([3, 12, 40])) for _ in range(rng.randint(0, 25))]
        right = list(left)
        for _ in range(rng.randint(0, 6)):
            k = rng.randint(0, len(right))
            if rng.random() < 0.4:
                right.insert(k, rng.randrange(40))
            elif right:
                v = right.pop(k % len(right))
                if rng.random() < 0.5:
                    right.insert(rng.randint(0, len(right)), v)
        rows = diff.differences(left, right)
        assert rebuilt(left, right, rows) == right
        assert all(left[i] == right[j] for change, i, j in rows if change == "moved")
        removed, added = {left[i] for c, i, _ in rows if c == "removed"}, {right[j] for c, _, j in rows if c == "added"}
        assert not removed & added and (left != right or not rows)


def test_of_lines_that_occur_once_the_longest_run_stays():
    rng = random.Random(2)
    for _ in range(300):
        left = list(range(rng.randint(0, 8)))
        right = rng.sample(left, len(left))
        most = max(n for n in range(len(left) + 1) if any(list(c) == sorted(c) for c in combinations(right, n)))
        rows = diff.differences(left, right)
        assert len(rows) == len(left) - most and all(change == "moved" for change, _, _ in rows)


def test_moved_lines_are_told_from_changed_ones(spark):
    left = [(1, "a\nb\nb2\nc\nd\ne"), (2, "x\n\ny\n\nz"), (3, "gone"), (5, None)]
    right = [(1, "a\nd\nb\nb2\nC\ne"), (2, "x\n\nY\n\nz"), (4, "new\n"), (5, "")]
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, md string")
    got = sorted((tuple(r) for r in diff.ordered_diff(make(left), make(right)).collect()), key=str)
    want = [(1, "moved", 5, 2, "d"), (1, "removed", 4, None, "c"), (1, "added", None, 5, "C"), (2, "removed", 3, None, "y"), (2, "added", None, 3, "Y"), (3, "removed", 1, None, "gone"), (4, "added", None, 1, "new")]
    assert [r for r in got if r[0] < 5 and r[4] != ""] == sorted(want, key=str)


def test_parts_are_compared_like_whole_documents(spark):
    lines = [f"l{k % 17} {k}" for k in range(300)]
    other = lines[:100] + ["new"] + lines[150:] + lines[100:120]
    whole = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, md string")
    cut = spark.createDataFrame([(1, p, ("\n" if p else "") + "\n".join(other[at : at + 37])) for p, at in enumerate(range(0, len(other), 37))], "doc_id long, part_no int, md string")
    again = spark.createDataFrame([(1, "\n".join(other))], "doc_id long, md string")
    got = sorted(map(str, diff.ordered_diff(whole, cut).collect()))
    assert got == sorted(map(str, diff.ordered_diff(whole, again).collect()))
    kinds = [r.change for r in diff.ordered_diff(whole, cut).collect()]
    assert (kinds.count("moved"), kinds.count("removed"), kinds.count("added")) == (20, 30, 1)
