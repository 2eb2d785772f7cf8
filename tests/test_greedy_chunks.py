"""Chunks whose every cut hangs on the last, over documents and parts of any size."""

from __future__ import annotations

import random

import pytest

from docframe.operators import headings


def brute(text, lines_per_chunk):
    """(first line, last line, text) of each chunk."""
    lines = text.split("\n")
    starts = [0]
    for i, line in enumerate(lines):
        if line.startswith("# ") and i - starts[-1] >= lines_per_chunk:
            starts.append(i)
    ends = [*starts[1:], len(lines)]
    return [(a + 1, b, "\n".join(lines[a:b])) for a, b in zip(starts, ends, strict=True)]


def document(rng, n):
    return "\n".join("# h" if rng.random() < 0.2 else f"line {k}" for k in range(n))


@pytest.mark.parametrize("per", [1, 7, 25])
def test_whole_documents(spark, per):
    rng = random.Random(per)
    texts = {d: document(rng, rng.randint(1, 200)) for d in range(25)}
    rows = headings.greedy_chunks(spark.createDataFrame(list(texts.items()), "doc_id long, md string"), lines_per_chunk=per).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.chunk_no)):
        got.setdefault(r.doc_id, []).append((r.first_line, r.last_line, r.text))
    assert got == {d: brute(t, per) for d, t in texts.items()}


@pytest.mark.parametrize(("per", "most"), [(7, 12), (25, 9), (10, 60)])
def test_documents_in_parts(spark, per, most):
    rng = random.Random(per * most)
    texts, rows = {}, []
    for d in range(8):
        text = texts[d] = document(rng, rng.randint(1, 260))
        lines, at, part = text.split("\n"), 0, 0
        while at < len(lines):  # a part ends behind a line's text, the next begins with the line end
            n = rng.randint(1, most)
            rows.append((d, part, ("\n" if part else "") + "\n".join(lines[at : at + n])))
            at, part = at + n, part + 1
    rng.shuffle(rows)
    out = headings.greedy_chunks(spark.createDataFrame(rows, "doc_id long, part_no int, md string"), lines_per_chunk=per).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.doc_id, r.chunk_no, r.piece_no)):
        chunks = got.setdefault(r.doc_id, {})
        first, _, text = chunks.get(r.chunk_no, (r.first_line, None, None))
        chunks[r.chunk_no] = (first, r.last_line, r.text if text is None else f"{text}\n{r.text}")
    assert {d: list(c.values()) for d, c in got.items()} == {d: brute(t, per) for d, t in texts.items()}
