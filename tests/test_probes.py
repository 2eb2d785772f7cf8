"""Inputs that were once read wrongly."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docframe.operators import cleanup, fields, layout
from docframe.sources import schemas

CORNERS = "x0 double, y0 double, x1 double, y1 double"


def outside(spark, blocks, boxes):
    b = spark.createDataFrame([(1, 1, i, *c, "t") for i, c in enumerate(blocks)], f"doc_id int, page_number int, block_no int, {CORNERS}, text string")
    t = spark.createDataFrame([(1, 1, *c) for c in boxes], f"doc_id int, page_number int, {CORNERS}")
    return sorted(r.block_no for r in layout.blocks_outside_tables(b, t).collect())


def test_a_box_of_any_size_is_constant_work(spark):
    far = 5e6
    boxes = [(-far, -far, far, far - 100), (0.0, far + 10, 10.0, far + 20), (-1e14, far + 50, 1e14, 2e14)]
    blocks = [(0.0, 0.0, 10.0, 10.0), (0.0, far - 90, 1.0, far - 80), (1.0, far + 11, 9.0, far + 19), (far + 9, 0.0, far + 10, 1.0), (0.0, 1e8, 5.0, 1e9)]
    assert outside(spark, blocks, boxes) == [1, 3]


def test_boxes_and_blocks_without_usual_corners(spark):
    nan, inf = float("nan"), float("inf")
    blocks = [(0.0, 0.0, 1.0, 1.0), (None, 0.0, 1.0, 1.0), (nan, 0.0, 1.0, 1.0), (0.0, 0.0, inf, 1.0)]
    assert outside(spark, blocks, [(None, 0.0, 9.0, 9.0), (0.0, nan, 9.0, 9.0), (-inf, -inf, inf, inf)]) == [0, 1, 2, 3]
    assert outside(spark, blocks, []) == [0, 1, 2, 3]


def test_boxes_of_many_levels(spark):
    import random

    rng = random.Random(3)
    boxes = []
    for _ in range(60):
        x, y, w = rng.uniform(-3000, 3000), rng.uniform(-3000, 3000), 2 ** rng.uniform(0, 14)
        boxes.append((x, y, x + w, y + w * rng.random()))
    blocks = [(x, y, x + rng.uniform(0, 20), y + rng.uniform(0, 20)) for x, y in ((rng.uniform(-4000, 4000), rng.uniform(-4000, 4000)) for _ in range(500))]
    want = [i for i, b in enumerate(blocks) if not any(b[0] >= t[0] - 2 and b[1] >= t[1] - 2 and b[2] <= t[2] + 2 and b[3] <= t[3] + 2 for t in boxes)]
    assert outside(spark, blocks, boxes) == want and 0 < len(want) < 500


STAY = ["È vietata la riproduzione degli animali selvatici", "Copyright law applies to works", "È vietato il deposito", "i diritti degli autori", "autoriparazioni: no", "vietata la copiatura",
        "È vietato l'accesso; la riproduzione assistita è ammessa", "Copyright is held by the region under the act of 1941"]
GO = ["COPYRIGHT Ente", "Copyright 2019 Comune di Roma", "© Ente", "(c) 2020 X", "Copyright © Y", "Vietata la riproduzione", "vietato copiare", "Vietata la riproduzione anche parziale",
      "È vietata la riproduzione del presente documento", "È vietata la copia e la diffusione degli elaborati", "Gli autori: A, B", "Estensori", "Copyright Acme Corp, 2019. All rights reserved."]


def test_notices_go_and_legal_text_stays(spark):
    lines = spark.createDataFrame([(x,) for x in STAY + GO], "line string").select("line", cleanup.is_notice(F.col("line")).alias("n"))
    assert {r.line for r in lines.collect() if r.n} == set(GO)


@pytest.mark.parametrize(
    ("text", "point", "comma", "unknown"),
    [
        ("1.395 EUR", "1.40", "1395.00", None), ("1,395", "1395.00", "1.40", "1395.00"), ("0,125", None, "0.13", "0.13"), ("0,500 EUR", None, "0.50", "0.50"),
        ("0.125", "0.13", None, "0.13"), ("12,5", None, "12.50", "12.50"), ("12.5", "12.50", None, "12.50"), ("1.395,00", None, "1395.00", "1395.00"),
        ("1,395.00", "1395.00", None, "1395.00"), ("1.234.567", None, "1234567.00", "1234567.00"), ("1,234,567", "1234567.00", None, "1234567.00"),
        ("1395", "1395.00", "1395.00", "1395.00"), ("1 395,5", None, "1395.50", "1395.50"), ("01.395", "1.40", None, "1.40"), ("1395.125", "1395.13", None, "1395.13"),
        ("(12,50)", None, "-12.50", "-12.50"), ("-€ 7", "-7.00", "-7.00", "-7.00"), ("1.39.500", None, None, None), ("x", None, None, None),
    ],
)
def test_amounts_by_decimal_mark(spark, text, point, comma, unknown):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(*[fields.amount(F.col("t"), decimal=d).cast("string").alias(n) for n, d in (("p", "."), ("c", ","), ("u", None))]).first()
    assert tuple(row) == (point, comma, unknown)


def test_amounts_of_a_language_or_of_none(spark):
    df = spark.createDataFrame([(1, "total", "1.395 EUR"), (2, "total", "1.395,10 EUR")], "doc_id int, name string, value string")
    types = {"total": "currency"}
    unsure = {r.doc_id: (r.total, r.warnings) for r in fields.typed_record(df, types).collect()}
    assert unsure[1] == (None, ["Value of 'total' is no currency"]) and str(unsure[2][0]) == "1395.10"
    sure = {r.doc_id: str(r.total) for r in fields.typed_record(df, types, decimal=",").collect()}
    assert sure == {1: "1395.00", 2: "1395.10"}


def test_a_page_without_text_is_unreadable(spark):
    pages = spark.createDataFrame([(1, 1, None), (1, 2, "x" * 30)], "doc_id int, page_number int, text string")
    assert [(r.unreadable, r.marker) for r in cleanup.mark_unreadable(pages).orderBy("page_number").collect()] == [(True, "<!-- UNREADABLE: page 1 -->"), (False, None)]


def test_a_type_in_two_schema_files_is_an_error(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text('{"document_type": "t", "fields": [{"name": "%s"}]}' % name)
    with pytest.raises(schemas.SchemaError, match="several files"):
        schemas.load_schemas(spark, str(tmp_path))
