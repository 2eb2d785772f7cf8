"""Keys with a wrong letter; requests that end at lines."""

from __future__ import annotations

import random

import pytest

from docframe.operators import fields, prompts

ALIASES = {"invoice_number": "number", "invoice_no": "number", "total_amount": "total", "total_amounts": "totals", "due": "due", "seller": "seller"}


@pytest.mark.parametrize(
    ("key", "name"),
    [
        ("Invoice Number", "number"), ("Invoise Number", "number"), ("Invoice Nmber", "number"), ("Invoice Numberr", "number"), ("nvoice number", "number"),
        ("Invoise Nomber", None), ("Duo", None), ("due", "due"), ("Sellerr", "seller"), ("Seler", "seller"), ("Sele", None), ("", None), ("—", None),
        ("Total Amount", "total"), ("Total Amounts", "totals"), ("Total Amounty", None), ("Totl Amount", "total"), ("x" * 500, None),
    ],
)
def test_one_wrong_letter(spark, key, name):
    got = fields.schema_guided_fields(spark.createDataFrame([(1, 1, 1, key, "v")], "doc_id int, page_number int, line_no int, key string, value string"), ALIASES, misread=True).collect()
    assert [r.name for r in got] == ([name] if name else [])


def test_exact_keys_come_first_and_nothing_changes_without_the_option(spark):
    rows = [(1, 1, 1, "Invoice Number", "right"), (1, 2, 9, "Invoise Number", "wrong"), (2, 1, 1, "Invoise Number", "near"), (2, 1, 2, None, "x")]
    pairs = spark.createDataFrame(rows, "doc_id int, page_number int, line_no int, key string, value string")
    assert {(r.doc_id, r.value) for r in fields.schema_guided_fields(pairs, ALIASES, misread=True).collect()} == {(1, "right"), (2, "near")}
    assert {(r.doc_id, r.value) for r in fields.schema_guided_fields(pairs, ALIASES).collect()} == {(1, "right")}
    assert fields.schema_guided_fields(pairs, {}, misread=True).count() == 0


def pieces(text, n):
    out = []
    while len(text) > n:
        head = text[:n]
        at = head.rfind("\n") + 1 or max((i + 1 for i, c in enumerate(head) if c in " \t\n\x0b\x0c\r"), default=0) or n
        out.append(text[:at])
        text = text[at:]
    return [*out, text] if text or not out else out


@pytest.mark.parametrize("n", [1, 7, 40])
def test_requests_end_at_lines(spark, n):
    rng = random.Random(n)
    texts = ["".join(rng.choice("ab \n|é") if rng.random() < 0.3 else "x" for _ in range(rng.randint(0, 300))) for _ in range(40)]
    parts = spark.createDataFrame([(d, 0, t) for d, t in enumerate(texts)], "doc_id int, part_no int, text string")
    got = {}
    for r in prompts.requests(parts, n, lines=True).orderBy("doc_id", "request_no").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got == {d: pieces(t, n) for d, t in enumerate(texts)}
