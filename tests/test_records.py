from __future__ import annotations

import json
import random

import pytest

from docframe.operators import batch, layout, prompts, records, segments
from docframe.sources import files, schemas
from docframe.streaming.ingest import incremental_ingest

C = schemas.Column
SMALL = schemas.Schema(
    "bill",
    (C("number", required=True, note="its number"), C("total", "currency", True), C("paid")),
    (C("what", note="thing"), C("n", "number")),
    "A bill",
)
NOTE = schemas.Schema("note", (C("from", required=True),))


def responses(spark, *raws):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in raws]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, raw string")


def validated(spark, *raws):
    rows = records.validated_records(responses(spark, *raws), SMALL).collect()
    return {r.doc_id: r for r in rows}


def test_happy_path(spark):
    r = validated(spark, {"fields": {"number": "7", "total": 0}, "line_items": [{"what": "a", "n": 1}], "confidence": 0.5})[0]
    assert (r.document_type, r.fields, r.line_items) == ("bill", {"number": "7", "total": "0"}, [{"what": "a", "n": "1"}])
    assert (r.confidence, r.warnings, r.extraction_method) == (0.5, [], "llm")


def test_warnings_keep_their_order(spark):
    r = validated(
        spark,
        {
            "fields": {"number": " ", "zz": 1, "aa": 2, "paid": False},
            "line_items": ["x", {"what": "a", "junk": 1}, 3, None],
            "warnings": ["own"],
            "confidence": "high",
        },
    )[0]
    assert r.warnings == [
        "own",
        "Required field missing or empty: 'number'",
        "Required field missing or empty: 'total'",
        "Unexpected field ignored: 'aa'",
        "Unexpected field ignored: 'zz'",
        "Line item 0 is not a dict — skipped",
        "Line item 2 is not a dict — skipped",
        "Line item 3 is not a dict — skipped",
    ]
    assert r.fields == {"number": " ", "paid": "false"}
    assert r.line_items == [{"what": "a"}]
    assert r.confidence is None


def test_nulls_and_absent_parts(spark):
    got = validated(spark, {}, {"fields": None, "line_items": None, "warnings": None}, {"fields": {"number": None}})
    assert all(len(r.warnings) == 2 and r.line_items == [] for r in got.values())
    assert got[2].fields == {"number": None}


def test_what_is_no_record(spark):
    raws = ["no json", "[1]", '{"fields": [1]}', '"text"', "", '```json\n{"fields": {}}\n```']
    got = {r.doc_id: r.valid for r in records.parse_responses(responses(spark, *raws)).collect()}
    assert got == {0: False, 1: False, 2: False, 3: False, 4: False, 5: True}


@pytest.mark.parametrize(
    "value, want",
    [(1.7, 1.0), (-2, 0.0), ("0.25", 0.25), (None, None), ("x", None), (True, 1.0), (False, 0.0), ("NaN", 1.0),
     ("true", None), ("0.9d", None), (" .5 ", 0.5), ("1e-1", 0.1), ([0.5], None)],
)
def test_confidence(spark, value, want):
    assert validated(spark, {"confidence": value})[0].confidence == want


def test_own_warnings_are_no_findings(spark):
    own = ["Line item 3 has no readable price", "Required field missing on page 2", "LLM is unsure"]
    df = responses(spark, {"fields": {"number": "7", "zz": 1}, "line_items": [1], "warnings": own})
    found = records.validated_records(df, SMALL)
    assert [(r.item_no, r.warning[:11]) for r in records.skipped_line_items(found).collect()] == [(0, "Line item 0")]
    assert [r.name for r in records.missing_required(found).collect()] == ["total"]
    assert [r.name for r in records.unexpected_fields(found).collect()] == ["zz"]
    rows = records.record_warnings(found).orderBy("warning_no").collect()
    assert [r.category for r in rows] == ["model"] * 3 + ["missing_required", "unexpected_field", "bad_line_item"]


def test_of_a_repeated_key_the_last_counts(spark):
    r = validated(spark, '{"fields": {"number": "old", "total": 1, "number": "new"}}')[0]
    assert r.fields == {"number": "new", "total": "1"}


def test_each_document_has_its_schema(spark):
    df = spark.createDataFrame(
        [(0, "bill", '{"fields": {"number": "1", "from": "x"}}'), (1, "note", '{"fields": {"from": "x", "number": "1"}}'), (2, "odd", '{"fields": {"a": 1}}')],
        "doc_id long, document_type string, raw string",
    )
    got = {r.doc_id: (r.document_type, r.fields, len(r.warnings)) for r in records.validated_records(df, {"bill": SMALL, "note": NOTE}).collect()}
    assert got == {0: ("bill", {"number": "1"}, 2), 1: ("note", {"from": "x"}, 1), 2: ("odd", {}, 1)}


def test_fallback(spark):
    docs = spark.createDataFrame([(0,), (1,), (2,), (3,)], "doc_id long")
    raws = responses(spark, {"fields": {"number": "7", "total": 1}, "line_items": [{"n": 2}], "confidence": 0.5}, "broken")
    seen = []

    def heuristic(fallen):
        seen.extend(r.doc_id for r in fallen.collect())
        rows = [(d, "field", 1, 3, 0, "K", f"v{d}") for d in (1, 2)] + [(1, "item", 1, 1, 0, "A", "x"), (1, "warning", 0, 0, 0, "EMPTY", "none")]
        found = spark.createDataFrame(rows, "doc_id long, kind string, page_number int, a int, b int, key string, value string")
        return found.join(fallen, "doc_id", "left_semi")

    rows = records.record_with_fallback(docs, raws, heuristic, SMALL).collect()
    assert sorted(seen) == [1, 2, 3]
    record = {(r.doc_id, r.key): r.value for r in rows if r.kind == "record"}
    assert record[0, "extraction_method"] == "llm" and record[0, "confidence"] == "0.5" and record[0, "document_type"] == "bill"
    assert all(record[d, "extraction_method"] == "heuristic" and record[d, "document_type"] == "unknown" for d in (1, 2, 3))
    rest = {(r.doc_id, r.kind, r.key, r.value) for r in rows if r.kind != "record"}
    assert rest == {
        (0, "field", "number", "7"), (0, "field", "total", "1"), (0, "item", "n", "2"),
        (1, "field", "K", "v1"), (1, "item", "A", "x"), (1, "warning", "EMPTY", "none"),
        (1, "warning", "model_failure", "LLM returned invalid JSON"),
        (2, "field", "K", "v2"), (2, "warning", "model_failure", "LLM call failed: no response"),
        (3, "warning", "model_failure", "LLM call failed: no response"),
    }


def test_record_artifacts_come_back(spark):
    found = records.validated_records(responses(spark, {"fields": {"number": None, "total": "1"}, "line_items": [{"n": 1}], "confidence": 1}), SMALL)
    back = records.read_record_artifacts(records.record_artifacts(found)).first()
    r = found.first()
    assert (back.fields, back.line_items, back.confidence, back.warnings) == (r.fields, r.line_items, r.confidence, r.warnings)


def test_sheets_by_letter(spark):
    wide = spark.createDataFrame([("f.pdf", 1, None)], "file string, n int, x string")
    sheet = records.by_letter(wide, {"B": "file", "AA": "n", "C": "x", "D": "gone"})
    assert sheet.columns == [*"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "AA"]
    assert [v for v in sheet.first() if v] == ["f.pdf", "1"]


def test_schema_files(spark, tmp_path):
    known = schemas.load_schemas(spark)
    assert known == schemas.local_schemas() and set(known) == {"invoice", "shipment"}
    assert known["invoice"].required == ["invoice_number", "vendor_name", "invoice_date", "total_amount"]
    assert known["invoice"].aliases["seller"] == "vendor_name"
    (tmp_path / "own.json").write_text(json.dumps({"document_type": "t", "fields": [{"name": "a"}, {"name": "b", "type": "date", "required": True}]}))
    mine = schemas.load_schemas(spark, str(tmp_path))["t"]
    assert (mine.names, mine.types, mine.required, mine.items) == (["a", "b"], {"a": "string", "b": "date"}, ["b"], ())
    with pytest.raises(schemas.SchemaError):
        schemas.load_schemas(spark, str(tmp_path / "none.json"))
    for k, text in enumerate(("{", '{"a": 1}', "[]")):
        bad = tmp_path / f"bad{k}"
        bad.mkdir()
        (bad / "x.json").write_text(text)
        with pytest.raises(schemas.SchemaError):
            schemas.load_schemas(spark, str(bad))


def test_schema_prompt(spark):
    texts = spark.createDataFrame(
        [(1, 0, "DOC BODY", "bill"), (2, 0, "other", "note"), (3, 0, "x", "odd")], "doc_id long, part_no int, text string, document_type string"
    )
    asked = prompts.schema_prompts(prompts.requests(texts, 5), {"bill": SMALL, "note": NOTE})
    got = {(r.doc_id, r.request_no): r.prompt for r in asked.collect()}
    assert set(got) == {(1, 0), (1, 1), (2, 0)}
    prompt = got[1, 0]
    assert "| number | string | required | its number |" in prompt and "| what | string |  | thing |" in prompt
    shape = json.loads(next(line for line in prompt.splitlines() if line.startswith("{")))
    assert list(shape["fields"]) == SMALL.names and list(shape["line_items"][0]) == SMALL.item_names
    assert got[1, 0].endswith("\nDOC B") and got[1, 1].endswith("\nODY")


# ------------------------------------------------------------ layout

def test_blocks_against_brute_force(spark):
    rnd = random.Random(5)
    box = lambda w: (lambda x, y: (x, y, x + rnd.uniform(1, w), y + rnd.uniform(1, w)))(
        rnd.uniform(-20, 900), rnd.uniform(-20, 900)
    )
    blocks = [(rnd.randrange(3), rnd.randrange(2), i, *map(float, box(80)), rnd.choice(["t", " u ", " "])) for i in range(600)]
    boxes = [(rnd.randrange(3), rnd.randrange(2), *map(float, box(700))) for _ in range(9)]
    cols = "x0 double, y0 double, x1 double, y1 double"
    got = layout.blocks_outside_tables(
        spark.createDataFrame(blocks, f"doc_id int, page_number int, block_no int, {cols}, text string"),
        spark.createDataFrame(boxes, f"doc_id int, page_number int, {cols}"),
    )
    want = {
        b[2] for b in blocks if b[7].strip() and not any(
            t[:2] == b[:2] and b[3] >= t[2] - 2 and b[4] >= t[3] - 2 and b[5] <= t[4] + 2 and b[6] <= t[5] + 2
            for t in boxes
        )
    }
    assert {r.block_no for r in got.collect()} == want and 0 < len(want) < 600


def test_page_provenance_parts(spark):
    items = spark.createDataFrame(
        [(1, i, [1, 2, 1] if i % 3 == 0 else [1], f"t{i}" if i != 4 else None) for i in range(1, 8)] + [(2, 1, [1], " ")],
        "doc_id int, item_no int, prov array<int>, text string",
    )
    got = {}
    for r in layout.page_provenance(items, 2).orderBy("doc_id", "page_number", "part_no").collect():
        got[r.doc_id, r.page_number] = got.get((r.doc_id, r.page_number), "") + r.text
    assert got == {(1, 1): "\n\n".join(f"t{i}" for i in (1, 2, 3, 5, 6, 7)), (1, 2): "t3\n\nt6"}


def test_extraction_choice(spark):
    long = "x" * 300
    rows = [
        (1, "primary", long), (1, "secondary", "s"),
        (2, "primary", "thin"), (2, "secondary", "s"),
        (3, "primary", "thin"), (3, "secondary", " "), (3, "ocr", "o"),
        (4, "primary", "thin"), (4, "ocr", "\n"),
        (5, "secondary", " "),
    ]
    cands = spark.createDataFrame([(d, m, 1, t) for d, m, t in rows], "doc_id int, method string, page_number int, text string")
    sizes = spark.createDataFrame([(d, 2048) for d in range(1, 7)], "doc_id int, n_bytes long")
    assert {r.doc_id: r.method for r in layout.best_extraction(cands, sizes).collect()} == {
        1: "primary", 2: "secondary", 3: "ocr", 4: "primary"
    }
    assert sorted(r.doc_id for r in layout.failed_extractions(cands, sizes).collect()) == [5, 6]


# ------------------------------------------------------------ batches, files, stream

def test_admission(spark):
    df = spark.createDataFrame(
        [("a.PDF", None), ("", 1), ("b.txt", 1), ("c.pdf", 20 * 1024 * 1024), ("d.pdf", 20 * 1024 * 1024 + 1)],
        "source_file string, n_bytes long",
    )
    got = {r.source_file: r.reject_reason for r in batch.admission_filter(df).collect()}
    assert got == {"a.PDF": None, "": "no file name", "b.txt": "not a PDF", "c.pdf": None, "d.pdf": "too large"}


def test_resume_twice_leaves_no_work(spark):
    inputs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    done = spark.createDataFrame([(1,)], "doc_id long")
    first = batch.resume_plan(inputs, done)
    assert {(r.doc_id, r.action) for r in first.collect()} == {(1, "skip"), (2, "work"), (3, "work")}
    after = done.union(first.filter("action = 'work'").select("doc_id"))
    assert batch.resume_plan(inputs, after).filter("action = 'work'").count() == 0
    assert batch.resume_plan(inputs, after, force=True).filter("action = 'work'").count() == 3


def test_error_classes(spark):
    df = spark.createDataFrame([("HTTP 429",), ("RESOURCE_EXHAUSTED",), ("timeout",), (None,)], "error_message string")
    got = {r.error_message: r.retryable for r in batch.classify_errors(df).collect()}
    assert got == {"HTTP 429": False, "RESOURCE_EXHAUSTED": False, "timeout": True}


def test_scan_folder_and_manifest(spark, tmp_path):
    for name in ("b.md", "a.md", "c.txt", "d.pdf", "e.PDF"):
        (tmp_path / name).write_text(f"# {name}\n\ntext\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "f.md").write_text("no")
    found = files.scan_markdown(spark, str(tmp_path)).union(files.scan_markdown(spark, str(tmp_path / "sub"))).collect()
    assert {r.source_file: r.md for r in found if r.source_file != "f.md"} == {n: f"# {n}\n\ntext\n" for n in ("a.md", "b.md")}
    assert len({r.doc_id for r in found}) == 3
    assert files.scan_markdown(spark, str(tmp_path / "a.md")).count() == 1
    names = [r.source_file.rsplit("/", 1)[1] for r in files.scan_folder(spark, str(tmp_path)).collect()]
    assert names == ["d.pdf"]
    manifest = tmp_path / "m.csv"
    manifest.write_text("file_path,profile,notes\nx.pdf,invoice,\ny.pdf,odd,note\n")
    rows = batch.manifest_scan(files.read_manifest(spark, str(manifest)), {"invoice": "bill"}).collect()
    assert {r.file_path: r.document_type for r in rows} == {"x.pdf": "bill", "y.pdf": "generic"}
    with pytest.raises(ValueError):
        batch.required_inputs(files.scan_folder(spark, str(tmp_path)), ".docx")


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'a "quoted", text', ""), (2, "plain", "")]
    df = spark.createDataFrame(rows, "id int, it string, en string")
    files.write_csv(df, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True, quote='"', escape='"')
    assert {(r.id, r.it) for r in back.collect()} == {("1", 'a "quoted", text'), ("2", "plain")}


def test_files_are_written_whole(spark, tmp_path):
    rows = [("a/x.md", p, f"part {p}\n" * (p + 1)) for p in range(6)] + [("b.md", 0, ""), ("c.md", 0, "é")]
    df = spark.createDataFrame(rows, "file string, part_no int, content string").repartition(5)
    made = {r.file: r.n_bytes for r in files.write_files(df, str(tmp_path / "out")).collect()}
    assert made == {"a_x.md": sum(7 * (p + 1) for p in range(6)), "b.md": 0, "c.md": 2}
    assert sorted(f.name for f in (tmp_path / "out").iterdir()) == ["a_x.md", "b.md", "c.md"]
    assert (tmp_path / "out" / "a_x.md").read_text() == "".join(r[2] for r in rows[:6])


def test_documents_and_units_are_written(spark, tmp_path):
    docs = spark.createDataFrame([(1, 0, "in/one.pdf", "# A\n\ntext"), (1, 1, "in/one.pdf", "\n\nmore\n"), (2, 0, "two.pdf", "x\n")], "doc_id long, part_no int, source_file string, md string")
    files.write_markdown(docs, str(tmp_path / "md")).count()
    assert (tmp_path / "md" / "one.md").read_text() == "# A\n\ntext\n\nmore\n" and (tmp_path / "md" / "two.md").read_text() == "x\n"
    tmx = segments.tmx_documents(docs, "it", "en", "20250101T000000Z")
    files.write_tmx(tmx, docs.select("doc_id", "source_file").distinct(), str(tmp_path / "tmx")).count()
    text = (tmp_path / "tmx" / "one.tmx").read_text()
    assert text.count("<tu ") == 3 and 'tuid="3"' in text and text.startswith("<?xml") and text.endswith("</tmx>\n")


def test_csv_takes_arrays(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", 'b"c'])], "id int, cells array<string>")
    files.write_csv(df, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True, quote='"', escape='"').first()
    assert json.loads(back.cells) == ["a", 'b"c']


def test_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": null}')], "doc_id long, json string")
    files.write_json(df, str(tmp_path / "out"))
    assert sorted(str(r.a) for r in files.read_json(spark, str(tmp_path / "out"), "a int").collect()) == ["1", "None"]


def test_stream_takes_each_file_once(spark, tmp_path):
    inbox, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    df = spark.range(30).selectExpr("id", "concat('t', id) as text")
    run = lambda: incremental_ingest(spark, inbox, df.schema, sink, marks)
    df.filter("id < 20").write.parquet(inbox)
    run()
    run()
    assert spark.read.parquet(sink).count() == 20
    df.filter("id >= 20").write.mode("append").parquet(inbox)
    run()
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(30))
