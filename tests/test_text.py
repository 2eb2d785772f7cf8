from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docframe.functions import text as tx
from docframe.operators import cleanup


def run(spark, fn, *values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.o for r in df.select("i", fn(F.col("t")).alias("o")).orderBy("i").collect()]


TEXTS = ["", "a", "a\n", "a\nb\n", "a\r\nb\rc", "\n", "a b\x85c\x0bd\x0ce\x1cf", "a\n\nb", " x "]


def test_lines_match_universal_line_ends(spark):
    assert run(spark, tx.split_lines, *TEXTS) == [t.splitlines() for t in TEXTS]


def test_strip_handles_unicode_space(spark):
    values = ["  a　", " \n\t", "\x1fb\x1c", "no", ""]
    assert run(spark, tx.ustrip, *values) == [v.strip() for v in values]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("**b** __c__ *d* _e_ `f` [g](u)", "b c d e f g"),
        ("snake_case_name", "snakecasename"),
        ("![a](p)", "!a"),
        ("**a *b* c**", "a *b* c"),
        ("  x \n\t y ", "x y"),
        ("plain text", "plain text"),
        ("a * b", "a * b"),
    ],
)
def test_inline_markup(spark, raw, want):
    assert run(spark, tx.inline_plain_text, raw) == [want]


def test_code_fences(spark):
    values = [
        "```markdown\n# A\n```",
        "```\n# A\n```  ",
        "```yaml\nanno: 1\n```\n\n# A",
        "```yaml\nanno: 1\n```",
        "no fence",
    ]
    want = [
        "# A",
        "# A",
        "---\nanno: 1\n---\n\n# A",
        "```yaml\nanno: 1",
        "no fence",
    ]
    assert run(spark, tx.strip_code_fences, *values) == want


def test_json_fences(spark):
    values = ['```json\n{"a": 1}\n```', '```{"a": 1}```', '{"a": 1}']
    assert run(spark, tx.strip_json_fences, *values) == ['{"a": 1}'] * 3


def test_file_stem(spark):
    values = ["a.pdf", "x/y/b.c.pdf", "noext", ".hidden"]
    assert run(spark, tx.file_stem, *values) == ["a", "b.c", "noext", ".hidden"]


def test_years(spark):
    fn = lambda c: F.array_join(F.regexp_extract_all(c, F.lit(tx.YEAR), F.lit(1)), ",")
    values = ["2022-2023", "L.R. 12/2015", "2016/1", "(2019)", "x2020", "2030 2009 2010"]
    assert run(spark, fn, *values) == ["2022,2023", "", "", "2019", "", "2010"]


def test_boilerplate_and_toc(spark):
    legal = "Rilascio della autorizzazione\nL'autorità competente\nÈ vietato il deposito\ni diritti degli autori\nautoriparazioni: no"
    text = "27\nTesto\nCOPYRIGHT Ente\nART. 1 ......... 2\n12 a\nVietata\nvietato copiare\n© Ente\nGli autori: A, B\nEstensori\nVietata la riproduzione\n"
    assert run(spark, cleanup.drop_boilerplate_lines, text + legal) == ["Testo\nART. 1 ......... 2\n12 a\nVietata\n" + legal]
    assert run(spark, cleanup.normalize_toc, "### ART. 1 ......... 2\nART. 2 fine.") == [
        "- ART. 1\nART. 2 fine."
    ]


def test_classify_headings(spark):
    text = "Norme\nTITOLO I\nCAPO II oggetto\nART. 3 Zone\n2.1 Aree\nTITOLONE\n2.1"
    assert run(spark, cleanup.classify_headings, text) == [
        "# Norme\n## TITOLO I\n### CAPO II oggetto\n### ART. 3 Zone\n#### 2.1 Aree\nTITOLONE\n2.1"
    ]


def test_unreadable_pages(spark):
    pages = spark.createDataFrame(
        [(1, 1, "   - 1 -  "), (1, 2, "x" * 20)], "doc_id int, page_number int, text string"
    )
    got = {r.page_number: (r.text, r.marker) for r in cleanup.mark_unreadable(pages).collect()}
    assert got == {1: ("   - 1 -  ", "<!-- UNREADABLE: page 1 -->"), 2: ("x" * 20, None)}


def test_repeated_lines_meet_pages_by_bucket(spark, monkeypatch):
    monkeypatch.setattr(cleanup, "PAGES_PER_BUCKET", 2)
    pages = spark.createDataFrame([(1, p, f"Comune di X\nTesto {p}") for p in range(1, 9)], "doc_id int, page_number int, text string")
    got = [r.text for r in cleanup.drop_repeated_lines(pages).orderBy("page_number").collect()]
    assert got == ["Comune di X\nTesto 1"] + [f"Testo {p}" for p in range(2, 9)]


def test_repeated_lines_keep_the_first(spark):
    rows = [(1, p, f"Comune di X\nTesto {p}\nComune di X") for p in range(1, 5)]
    rows.append((2, 1, "Comune di X"))
    pages = spark.createDataFrame(rows, "doc_id int, page_number int, text string")
    got = {(r.doc_id, r.page_number): r.text for r in cleanup.drop_repeated_lines(pages).collect()}
    assert got[1, 1] == "Comune di X\nTesto 1"
    assert got[1, 2] == "Testo 2"
    assert got[2, 1] == "Comune di X"
