"""Batch control: inputs, resume, results, reports and the tables handed to writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.functions.rows import computed, inline
from docframe.functions.text import is_blank
from docframe.operators import fields
from docframe.operators import tables as tb
from docframe.operators.parts import gathered
from docframe.operators.prompts import is_retryable
from docframe.session import written

MAX_UPLOAD_BYTES = 20 * 1024 * 1024


# ------------------------------------------------------------ inputs

def scan_inputs(files: DataFrame, suffix: str = ".pdf", ignore_case: bool = False) -> DataFrame:
    """Files with the suffix. A folder scan minds case, an explicit list does not.

    Rows keep the order they come in; whoever shows them sorts them.
    """
    name = F.lower("source_file") if ignore_case else F.col("source_file")
    return files.filter(name.endswith(suffix))


def required_inputs(files: DataFrame, suffix: str = ".pdf", ignore_case: bool = False) -> DataFrame:
    """``scan_inputs``, or a ValueError if there is none; only the first row is looked for."""
    found = scan_inputs(files, suffix, ignore_case)
    if found.isEmpty():
        raise ValueError(f"no input ends in {suffix}")
    return found


def admission_filter(files: DataFrame, max_bytes: int = MAX_UPLOAD_BYTES) -> DataFrame:
    """Files with ``admitted`` and ``reject_reason``; an unknown size passes."""
    name = F.coalesce("source_file", F.lit(""))
    reason = (
        F.when(name == "", "no file name")
        .when(~F.lower(name).endswith(".pdf"), "not a PDF")
        .when(F.col("n_bytes") > max_bytes, "too large")
    )
    return files.withColumn("reject_reason", reason).withColumn(
        "admitted", F.col("reject_reason").isNull()
    )


def manifest_scan(manifest: DataFrame, profiles: dict[str, str], default: str = "generic") -> DataFrame:
    """Manifest rows with the document type of their profile; unknown profiles take the default.

    ``profiles`` gives the type of the known ones; they are few and hot, so they
    are looked up in the row.
    """
    known = F.create_map(*[F.lit(x) for pair in profiles.items() for x in pair])
    kind = F.try_element_at(known, F.col("profile")) if profiles else F.lit(None).cast("string")
    return manifest.withColumn("document_type", F.coalesce(kind, F.lit(default)))


def load_artifacts(documents: DataFrame, records: DataFrame, key: str = "doc_id") -> DataFrame:
    """Cached pairs: both artifacts of an input must exist."""
    return documents.join(records, key)


def resume_plan(inputs: DataFrame, cached: DataFrame, force: bool = False) -> DataFrame:
    """Inputs with ``action``: 'skip' (a cached pair exists, not forced) or 'work'."""
    if force:
        return inputs.withColumn("action", F.lit("work"))
    done = cached.select("doc_id").distinct().withColumn("_done", F.lit(True))
    return (
        inputs.join(done, "doc_id", "left")
        .withColumn("action", F.when(F.col("_done"), "skip").otherwise("work"))
        .drop("_done")
    )


def resumed_results(plan: DataFrame, cached: DataFrame) -> DataFrame:
    """Result rows of the inputs that are skipped: success in 0 seconds, with the counts of the cached pair.

    ``plan`` is a resume plan, ``cached`` has (doc_id, pages, tables_found,
    fields_found, warnings_count), the warnings being those of the document.
    """
    counts = ["pages", "tables_found", "fields_found", "warnings_count"]
    return plan.filter(F.col("action") == "skip").join(cached.select("doc_id", *counts), "doc_id").select(
        "doc_id", "source_file", F.lit("success").alias("status"), *counts,
        F.lit(0).cast("decimal(18,2)").alias("processing_seconds"), F.lit(True).alias("resumed"),
    )


def doc_record_join(documents: DataFrame, records: DataFrame) -> DataFrame:
    """Every document paired with its record."""
    return documents.join(records, "doc_id")


def classify_errors(results: DataFrame) -> DataFrame:
    """Failed results with ``retryable``."""
    return results.filter(F.col("error_message").isNotNull()).withColumn(
        "retryable", is_retryable(F.col("error_message"))
    )


def rejects(results: DataFrame) -> DataFrame:
    """(source_file, error_message, retryable): inputs for the retry set."""
    return results.filter(F.col("status") != "success").select(
        "source_file",
        F.coalesce("error_message", F.lit("")).alias("error_message"),
        is_retryable(F.coalesce("error_message", F.lit(""))).alias("retryable"),
    )


# ------------------------------------------------------------ reports

def batch_report(results: DataFrame) -> DataFrame:
    """Totals per status and extraction method, with subtotals ('all')."""
    method = F.array_join("extraction_methods", "+")
    rolled = (
        results.withColumn("method", method)
        .rollup("status", "method")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("status") == "success").alias("succeeded"),
            F.count_if(F.col("status") != "success").alias("failed"),
            F.sum("pages").alias("pages"),
            F.sum("warnings_count").alias("warnings"),
            F.sum("processing_seconds").cast("double").alias("seconds"),
            F.round(F.avg("processing_seconds"), 6).cast("double").alias("mean_seconds"),
            F.max("processing_seconds").cast("double").alias("max_seconds"),
            F.round(F.avg("confidence"), 6).alias("mean_confidence"),
            F.grouping("status").alias("_s"),
            F.grouping("method").alias("_m"),
        )
    )
    name = lambda flag, c: F.when(F.col(flag) == 1, "all").otherwise(F.col(c))
    return rolled.select(
        name("_s", "status").alias("status"), name("_m", "method").alias("method"),
        "total", "succeeded", "failed", "pages", "warnings", "seconds", "mean_seconds", "max_seconds", "mean_confidence",
    )


def warnings_by_code(results: DataFrame) -> DataFrame:
    """(code, n, documents): how often each warning code occurs; ``results`` carry ``warning_codes``."""
    rows = results.select("doc_id", F.explode("warning_codes").alias("code"))
    per_doc = rows.groupBy("code", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("code").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("documents"))


def outcomes(results: DataFrame) -> DataFrame:
    """(outcome, source_file): every input of a run as converted, skipped or failed; the lists of a run's report."""
    outcome = F.when(F.col("status") != "success", "failed").when(
        F.col("fields_found") == 0, "skipped"
    ).otherwise("converted")
    return results.select(outcome.alias("outcome"), "source_file")


def run_summary(results: DataFrame) -> DataFrame:
    """(outcome, n): converted, skipped and failed inputs."""
    return outcomes(results).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def document_counts(pages: DataFrame, text: str = "md") -> DataFrame:
    """(doc_id, source_file, pages, tables_found, fields_found, warnings_count) per document.

    These are the document's own warnings; ``with_records`` adds those of its record.

    One pass over the page texts: a page sends its slim counts and the lines
    that may hold a field; both combine before they are shuffled. A table whose
    rows differ in width counts as one warning.
    """
    runs = tb.table_runs(F.col(text))
    parsed = pages.select("doc_id", "source_file", F.col(text).alias("text"), runs.alias("runs"))
    count = lambda kind, n: F.struct(
        F.lit(kind).alias("kind"), F.lit("").alias("line"), n.cast("long").alias("n")
    )
    facts = F.concat(
        F.array(
            count("page", F.lit(1)),
            count("table", F.size("runs")),
            count("ragged", F.size(F.filter("runs", tb.is_ragged))),
        ),
        F.transform(
            fields.candidate_lines(F.col("text"), markdown=True),
            lambda r: F.struct(F.lit("field").alias("kind"), r["line"].alias("line"), F.lit(1).cast("long").alias("n")),
        ),
    )
    rows = inline(parsed, ["doc_id", "source_file"], facts)
    pair = fields.pair(F.col("line"))
    key = F.when(F.col("kind") == "field", F.when(fields.accepted(pair["key"], pair["value"]), pair["key"])).otherwise("")
    by_key = (
        computed(rows, key=key)
        .filter(F.col("key").isNotNull())
        .groupBy("doc_id", "source_file", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    return by_key.groupBy("doc_id", "source_file").agg(
        total("page").alias("pages"),
        total("table").alias("tables_found"),
        F.count_if(F.col("kind") == "field").alias("fields_found"),
        total("ragged").alias("warnings_count"),
    )


def with_records(counts: DataFrame, records: DataFrame, resumed: DataFrame | None = None) -> DataFrame:
    """Document counts with ``extraction_methods``, ``resumed``, and the warnings of the record added for fresh ones.

    ``records`` is (doc_id, extraction_method, warnings); ``resumed`` is (doc_id).
    """
    # Records are parsed, so their size is a guess that is far too low; they are never broadcast on it.
    told = records.select("doc_id", "extraction_method", F.size("warnings").alias("_w")).hint("merge")
    joined = counts.join(told, "doc_id", "left")
    if resumed is None:
        joined = joined.withColumn("resumed", F.lit(False))
    else:
        marks = resumed.select("doc_id", F.lit(True).alias("_r")).distinct()
        joined = joined.join(marks, "doc_id", "left").withColumn("resumed", F.coalesce("_r", F.lit(False))).drop("_r")
    added = F.when(F.col("resumed"), 0).otherwise(F.coalesce("_w", F.lit(0)))
    methods = F.array_distinct(F.array_compact(F.array(F.lit("markdown_import"), F.col("extraction_method"))))
    return joined.select(
        *[c for c in counts.columns if c != "warnings_count"],
        (F.col("warnings_count") + added).alias("warnings_count"),
        methods.alias("extraction_methods"),
        "resumed",
    )


def batch_summary(counts: DataFrame, extracted_at: str, method: str, document_type: str = "unknown") -> DataFrame:
    """Summary sheet of a batch from its document counts.

    The extraction time is a parameter, as an ISO string.
    """
    return counts.select(
        "source_file",
        F.lit(document_type).alias("document_type"),
        "pages", "tables_found", "fields_found",
        F.col("warnings_count").alias("warnings"),
        F.lit(method).alias("extraction_method"),
        F.lit(extracted_at).alias("extracted_at"),
    )


# ------------------------------------------------------------ sheets and files

def fields_csv(found: DataFrame, method: str) -> DataFrame:
    """Rows of the fields files; the position columns give their order."""
    return found.select(
        "doc_id", "first_page", "first_line",
        F.col("key").alias("field_name"), "value", F.lit(method).alias("extraction_method"),
    )


def pages_csv(pages: DataFrame, tables: DataFrame) -> DataFrame:
    """Page texts of the documents that have no table, blank pages left out."""
    return (
        pages.filter(~is_blank(F.col("text")))
        .join(tables.select("doc_id"), "doc_id", "left_anti")
        .select("doc_id", "page_number", "text", "extraction_method")
    )


def warnings_csv(warnings: DataFrame) -> DataFrame:
    """Warning rows as written: a missing page number becomes an empty text."""
    return warnings.select(
        "doc_id", "code", "message",
        F.coalesce(F.col("page_number").cast("string"), F.lit("")).alias("page_number"),
    )


def batch_warnings(warnings: DataFrame) -> DataFrame:
    """Warnings sheet of a batch; the warnings carry their ``source_file``."""
    return warnings.select(
        "source_file", "code", "message",
        F.coalesce(F.col("page_number").cast("string"), F.lit("")).alias("page_number"),
    )


def batch_line_items(numbered: DataFrame) -> DataFrame:
    """LineItems sheet of a batch: raw cells of every data row."""
    return tb.table_rows(numbered.select("source_file", "doc_id", "table_id", "rows")).select(
        "source_file", F.col("doc_id").alias("document_id"), "table_id", "row_index", "cells"
    )


# The metadata columns of a workbook's summary.
METADATA = (
    "source_file", "document_id", "document_type", "pages", "tables_found", "fields_found", "warnings",
    "extracted_at", "extraction_method",
)


def document_workbook(
    summary: DataFrame,
    found: DataFrame,
    numbered: DataFrame,
    pages: DataFrame,
    warnings: DataFrame,
    together: bool = False,
) -> DataFrame:
    """All sheets of all documents: (doc_id, sheet, a, b, values).

    ``a`` and ``b`` order the rows of a sheet. ``summary`` has doc_id and the
    columns of METADATA but document_id, which is the doc_id. The numbered tables,
    which two sheets read, are written once, by document if those are of bounded
    size and their pages lie ``together``.
    """
    numbered = written(numbered, "numbered", ["doc_id"] if together else ())
    row = lambda df, sheet, a, b, values: df.select(
        "doc_id",
        sheet.alias("sheet"),
        a.cast("long").alias("a"),
        b.cast("long").alias("b"),
        values.alias("values"),
    )
    zero = F.lit(0)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    about = summary.withColumn("document_id", F.col("doc_id"))
    parts: list[DataFrame] = [
        row(about, F.lit("Summary"), F.lit(-1), zero, F.array(*[text(c) for c in METADATA])),
        row(
            found, F.lit("Summary"), F.col("first_page"), F.col("first_line"),
            F.array("key", "value"),
        ),
        row(
            tb.table_rows(numbered),
            F.concat(F.lit("Table_"), tb.padded(F.col("table_idx"))),
            F.col("row_index"), zero,
            F.concat(F.array(text("page_number")), "cells"),
        ),
        row(
            pages_csv(pages, numbered), F.lit("Pages"), F.col("page_number"), zero,
            F.array(text("page_number"), F.col("text"), F.col("extraction_method")),
        ),
        row(
            warnings, F.lit("Warnings"), F.coalesce(F.col("page_number"), zero), zero,
            F.array(F.col("code"), F.col("message"), text("page_number")),
        ),
    ]
    book = parts[0]
    for part in parts[1:]:
        book = book.unionByName(part)
    return book


def json_artifacts(pairs: DataFrame, *columns: str | Column) -> DataFrame:
    """(doc_id, json): the given columns of each row as one JSON text."""
    return pairs.select("doc_id", F.to_json(F.struct(*columns)).alias("json"))


PAGE = "struct<page_number:int,text:string>"
TABLE = "struct<table_idx:int,page_number:int,columns:array<string>,rows:array<array<string>>>"
PART = f"doc_id long, part_no int, source_file string, page_count int, pages array<{PAGE}>, tables array<{TABLE}>"


def document_artifacts(
    documents: DataFrame, pages: DataFrame, numbered: DataFrame, pages_per_part: int = 1000, together: bool = False
) -> DataFrame:
    """(doc_id, part_no, json): each document with its pages and tables as JSON, in parts of so many pages.

    ``documents`` is (doc_id, source_file, page_count), ``pages`` (doc_id, page_number, text). Documents of bounded size
    whose pages lie ``together``, their tables with them, are not shuffled.
    """
    part = F.floor((F.col("page_number") - 1) / pages_per_part).cast("int").alias("part_no")
    texts = pages.select("doc_id", part, F.struct("page_number", "text").cast(PAGE).alias("item"))
    tables = numbered.select("doc_id", part, F.struct("table_idx", "page_number", "columns", "rows").cast(TABLE).alias("item"))
    found = gathered(texts, tables, together).select(
        "doc_id", "part_no", F.sort_array("first").alias("pages"), F.array_sort("second").alias("tables")
    )
    return found.join(documents.select("doc_id", "source_file", "page_count"), "doc_id").select(
        "doc_id", "part_no", F.to_json(F.struct("doc_id", "part_no", "source_file", "page_count", "pages", "tables")).alias("json")
    )


def read_document_artifacts(artifacts: DataFrame) -> DataFrame:
    """The parts of (doc_id, part_no, json) rows."""
    return artifacts.select(F.from_json("json", PART).alias("d")).select("d.*")
