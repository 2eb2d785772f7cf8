"""Tables that run over pages."""

from __future__ import annotations

from docframe.operators import tables as tb

HEAD = "| A | B |\n|---|---|\n"


def found(spark, pages, block=4096):
    df = spark.createDataFrame(pages, "doc_id long, page_number int, md string")
    out = tb.spanning_tables(df, block=block).collect()
    return sorted((r.doc_id, r.page_number, r.page_table, r.table_no, r.first_row, tuple(r.header or ()), len(r.rows)) for r in out)


def test_where_a_table_goes_on(spark):
    pages = [
        (1, 1, "text\n\n" + HEAD + "| 1 | 2 |\n| 3 | 4 |\n\n"), (1, 2, "\n| 5 | 6 |\n\nmiddle\n\n| 1 |\n"), (1, 3, "| 7 |\n"), (1, 4, "after\n\n| 9 |"),
        (2, 1, HEAD + "| 1 | 2 |"), (2, 2, HEAD + "| 3 | 4 |"), (2, 3, "| C | D |\n|---|---|\n| 5 | 6 |"), (2, 4, "| 7 | 8 | 9 |"), (2, 6, "| 7 | 8 | 9 |"),
        (3, 1, HEAD + "| 1 | 2 |\n\nfoot"), (3, 2, "| 3 | 4 |"), (4, 1, None), (4, 2, ""), (5, 1, "no table"),
    ]
    ab, cd = ("A", "B"), ("C", "D")
    assert found(spark, pages) == [
        (1, 1, 1, 1, 0, ab, 2), (1, 2, 1, 1, 2, ab, 1), (1, 2, 2, 2, 0, (), 1), (1, 3, 1, 2, 1, (), 1), (1, 4, 1, 3, 0, (), 1),
        (2, 1, 1, 1, 0, ab, 1), (2, 2, 1, 1, 1, ab, 1), (2, 3, 1, 2, 0, cd, 1), (2, 4, 1, 3, 0, (), 1), (2, 6, 1, 4, 0, (), 1),
        (3, 1, 1, 1, 0, ab, 1), (3, 2, 1, 2, 0, (), 1),
    ]


def test_a_table_over_very_many_pages(spark):
    pages = [(1, p, (HEAD if p == 1 else "") + "".join(f"| {p} | {k} |\n" for k in range(p % 3 + 1))) for p in range(1, 400)]
    got = found(spark, pages, block=16)
    assert {(g[3], g[5]) for g in got} == {(1, ("A", "B"))}
    at = 0
    for g in got:
        assert g[4] == at
        at += g[6]


def test_no_pages(spark):
    assert found(spark, []) == []
