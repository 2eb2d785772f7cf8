"""Answers to several requests of one document."""

from __future__ import annotations

import contextlib
import io
import json
import random

import pytest

from docframe.operators import records
from docframe.sources.schemas import Column, Schema

BILL = Schema("bill", (Column("number", required=True), Column("total", required=True), Column("city")), (Column("n"), Column("what")))
SHAPE = "doc_id long, part_no int, request_no int, raw string"


def answer(fields=None, items=(), warnings=(), confidence=None):
    return json.dumps({"fields": fields or {}, "line_items": list(items), "warnings": list(warnings), "confidence": confidence})


def merged(spark, rows):
    out = records.merged_records(spark.createDataFrame(rows, SHAPE), BILL).collect()
    return sorted(((r.doc_id, r.kind, r.a, r.b, r.part_no, r.request_no, r.key, r.value) for r in out), key=lambda r: r[:4])


ROWS = [
    (1, 0, 0, answer({"number": " ", "total": "10", "odd": "x"}, [{"n": 1, "what": "a"}, 7], ["torn"], 0.9)),
    (1, 0, 1, answer({"number": "N1", "total": "11"}, [{"n": 2}], ["torn", "faint"], 0.4)),
    (1, 1, 0, "no answer"),
    (1, 2, 0, answer({"number": "N1", "total": "10", "odd": "y"}, [{"what": "c"}], [], None)),
    (2, 0, 0, None),
    (3, 0, 0, answer({"number": None, "city": "Roma"})),
]


def test_parts_of_a_record_are_merged(spark):
    assert merged(spark, ROWS) == sorted((
        (1, "record", 0, 0, 0, 0, "extraction_method", "llm"), (1, "record", 1, 0, 0, 0, "document_type", "bill"), (1, "record", 2, 0, 0, 0, "confidence", "0.4"),
        (1, "field", 0, 0, 0, 1, "number", "N1"), (1, "field", 1, 0, 0, 0, "total", "10"),
        (1, "item", 0, 0, 0, 0, "n", "1"), (1, "item", 0, 1, 0, 0, "what", "a"), (1, "item", 1, 0, 0, 1, "n", "2"), (1, "item", 2, 0, 2, 0, "what", "c"),
        (1, "warning", 0, 0, 0, 0, "model", "torn"), (1, "warning", 1, 0, 0, 1, "model", "faint"),
        (1, "warning", 2, 0, 0, 0, "unexpected_field", "Unexpected field ignored: 'odd'"),
        (1, "warning", 3, 0, 0, 0, "bad_line_item", "Line item 1 is not a dict — skipped"),
        (1, "warning", 4, 0, 0, 1, "conflict", "Field 'total' differs between answers: '10' kept, '11' dropped"),
        (1, "warning", 5, 0, 1, 0, "model_failure", "LLM returned invalid JSON"),
        (3, "record", 0, 0, 0, 0, "extraction_method", "llm"), (3, "record", 1, 0, 0, 0, "document_type", "bill"), (3, "record", 2, 0, 0, 0, "confidence", None),
        (3, "field", 0, 0, 0, 0, "city", "Roma"), (3, "field", 1, 0, 0, 0, "number", None),
        (3, "warning", 0, 0, 0, 0, "missing_required", "Required field missing or empty: 'number'"),
        (3, "warning", 1, 0, 0, 0, "missing_required", "Required field missing or empty: 'total'"),
    ), key=lambda r: r[:4])


@pytest.mark.parametrize("seed", [1, 2])
def test_the_order_of_answers_does_not_matter(spark, seed):
    rows = list(ROWS)
    random.Random(seed).shuffle(rows)
    assert merged(spark, rows) == merged(spark, ROWS)


def test_many_answers_and_parts_of_one_document(spark):
    rows = [(5, p, r, answer({"number": "N", "total": str(p // 20)}, [{"n": 100 * p + r}], [f"w{p % 3}"])) for p in range(40) for r in range(5)]
    random.Random(3).shuffle(rows)
    got = merged(spark, rows)
    items = [(r[2], r[7]) for r in got if r[1] == "item"]
    assert items == [(i, str(100 * (i // 5) + i % 5)) for i in range(200)]
    warnings = [(r[2], r[6], r[7]) for r in got if r[1] == "warning"]
    assert warnings == [(k, "model", f"w{k}") for k in range(3)] + [(3, "conflict", "Field 'total' differs between answers: '0' kept, '1' dropped")]


def test_fallback_takes_one_record_per_document(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "doc_id long")
    nothing = spark.createDataFrame([], "doc_id long, kind string, page_number int, a int, b int, key string, value string")
    rows = records.record_with_fallback(docs, spark.createDataFrame([*ROWS, (9, 0, 0, answer({"number": "9"}))], SHAPE), lambda fallen: nothing, BILL).collect()
    heads = sorted((r.doc_id, r.value) for r in rows if r.kind == "record" and r.key == "extraction_method")
    assert heads == [(1, "llm"), (2, "heuristic"), (3, "llm"), (4, "heuristic")]
    failures = sorted((r.doc_id, r.value) for r in rows if r.key == "model_failure")
    assert failures == [(1, "LLM returned invalid JSON"), (2, "LLM call failed: no response"), (4, "LLM call failed: no response")]
    assert {r.doc_id for r in rows} == {1, 2, 3, 4}


def test_no_answers(spark):
    assert merged(spark, []) == []


def test_a_document_with_one_answer_needs_no_others(spark):
    """Its rows are those that bringing answers together gives, without a shuffle."""
    single = [
        (1, 0, 2, answer({"number": " ", "total": 10, "odd": 1, "also": None}, [{"n": 1, "what": "a", "x": 2}, 7, None, {}, {"n": [2]}], ["torn", "torn", None, "faint"], 0.9)),
        (2, 0, 0, answer({"total": "t", "number": "N", "city": None}, [], [], "x")), (3, 0, 0, "[]"), (4, 0, 0, answer()), (5, 1, 0, "```json\n{\"fields\": {\"city\": \"```\"}}\n```"),
        (6, 0, 0, '{"fields": [1], "line_items": [{"n": 1}]}'), (None, 0, 0, answer({"number": "0"})),
    ]
    rows = [*single, (7, 0, 0, answer({"number": "7"})), (7, 0, 0, answer({"number": "7"})), (8, 0, 0, answer({"number": "8"}))]
    docs = spark.createDataFrame([(k,) for k in (1, 2, 2, 3, 4, 5, 6, 7, None)], "doc_id long")
    told = records.read_answers(spark.createDataFrame(rows, SHAPE), BILL, docs)
    assert sorted((r.doc_id, r.answers) for r in told.collect()) == [(k, 1) for k in (1, 2, 3, 4, 5, 6)] + [(7, 2), (7, 2)]
    shown = lambda df: sorted(map(str, df.select(*records.ROW).collect()))
    together = shown(records._merged(told.drop("answers"), BILL))
    assert shown(records._merged(told, BILL)) == together and len(together) > 20
    with contextlib.redirect_stdout(io.StringIO()) as out:
        records._rows_of(told.filter("answers = 1 AND valid"), BILL).explain()
    assert "Exchange" not in out.getvalue()


def test_what_is_an_object_is_told_without_a_schema(spark):
    raws = ['{"fields": {}}', '  {"fields": null}', "{}", "[{}]", "1", '{"fields": "x"}', '{"fields": [{}]}', "{", None, "```\n{\"line_items\": 3}\n```"]
    rows = spark.createDataFrame(list(enumerate(raws)), "doc_id long, raw string")
    found = records.parse_responses(rows)
    assert [bool(r.valid) for r in found.sort("doc_id").collect()] == [True, True, True, False, False, False, False, False, False, True]
    with contextlib.redirect_stdout(io.StringIO()) as out:
        found.explain()
    assert "schema_of_variant" not in out.getvalue()
