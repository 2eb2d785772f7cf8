"""Pages of a document that arrive in different deliveries."""

from __future__ import annotations

import random

import pytest

from docframe.streaming.ingest import incremental_ingest
from docframe.streaming.parts import completed_documents, completed_parts

SCHEMA = "doc_id string, page_no int, page_count int, n_chars int, part_no string"


@pytest.mark.parametrize("part", [1000, 4])
def test_deliveries_split_inside_documents_equal_one(spark, tmp_path, part):
    rng = random.Random(part)
    rows = [(f"d{d}", p, 1 + d, rng.randrange(100), "clash") for d in range(12) for p in range(1, 2 + d)]
    want = {f"d{d}": (1 + d, float(sum(r[3] for r in rows if r[0] == f"d{d}"))) for d in range(12)}
    rng.shuffle(rows)
    odd = [(None, 1, 1, 5, ""), ("e", None, 1, 5, ""), ("e", 2, 1, 5, ""), ("e", 0, 1, 5, ""), ("f", 1, None, 5, ""), ("g", 2, 3, None, "")]

    def run(name, deliveries):
        places = [str(tmp_path / f"{name}-{k}") for k in ("inbox", "sink", "marks")]
        known = []
        for batch in deliveries:
            spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(places[0])
            incremental_ingest(spark, places[0], spark.createDataFrame([], SCHEMA).schema, *places[1:], lambda df: completed_parts(df, ["n_chars"], part=part))
            found = completed_documents(spark.read.parquet(places[1]), ["n_chars"]).collect()
            known.append({r["doc_id"]: (r["pages"], r["n_chars"]) for r in found})
            assert len(known[-1]) == len(found)
        return known

    assert run("one", [rows + odd])[-1] == want
    # Pages that come again count once, as they came first, also after the document was reported.
    again = [(d, p, n, 999, "again") for d, p, n, _, _ in rows[:20]]
    first, second, third = run("split", [rows[:40] + rows[:3], rows[40:] + again + odd, again])
    assert second == third == want
    there = {(r[0], r[1]) for r in rows[:40]}
    assert first == {d: want[d] for d in want if all((d, p) in there for p in range(1, want[d][0] + 1))} != want
    # What was missing comes last.
    assert "g" in run("late", [odd, [("g", 1, 3, 1, ""), ("g", 3, 3, 2, "")]])[-1]
