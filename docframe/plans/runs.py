"""Queries over batch runs, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docframe.operators import batch
from docframe.plans.corpora import PROFILES, run_log, table
from docframe.session import work_folder
from docframe.streaming.ingest import incremental_ingest
from docframe.streaming.parts import completed_documents, completed_parts


def _cached(spark, sf):
    log = run_log(spark, sf)
    documents = log.filter("has_document").select("doc_id", "source_file", "pages")
    records = log.filter("has_record").select("doc_id", "fields_found")
    return batch.load_artifacts(documents, records)


def _inputs(spark, sf):
    return run_log(spark, sf).select("doc_id", "source_file")


def _manifest(spark, sf):
    manifest = run_log(spark, sf).select(F.col("source_file").alias("file_path"), "profile")
    return batch.manifest_scan(manifest, PROFILES).select("file_path", "document_type")


def _resumed(spark, sf):
    """Results of the inputs a second run skips."""
    log = run_log(spark, sf)
    pairs = log.filter(F.col("has_document") & F.col("has_record")).select(
        "doc_id", "pages", "tables_found", "fields_found", "warnings_count"
    )
    out = batch.resumed_results(batch.resume_plan(_inputs(spark, sf), pairs), pairs)
    return out.withColumn("processing_seconds", F.col("processing_seconds").cast("double"))


def _ingest(spark, sf):
    """Feed the conversations in two deliveries, run the ingest after each and once more."""
    turns = table(spark, sf, "conversations")
    inbox, sink, marks = (work_folder(spark, n) for n in ("inbox", "ingested", "marks"))
    runs = (turns.filter("conv_id % 2 = 0"), turns.filter("conv_id % 2 = 1"), None)
    for delivery in runs:
        if delivery is not None:
            delivery.write.mode("append").parquet(inbox)
        incremental_ingest(
            spark, inbox, turns.schema, sink, marks,
            lambda df: df.select("conv_id", "turn", F.length("text").alias("n_chars")),
        )
    return spark.read.parquet(sink)


def _deliveries(spark, sf):
    """Lines as pages of their orders: odd ones first, then even ones and the first again; every fifth order lacks its last."""
    order = Window.partitionBy("l_orderkey")
    pages = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.row_number().over(order.orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")).alias("page_no"),
        F.count(F.lit(1)).over(order).alias("page_count"),
        F.col("l_quantity").cast("double").alias("quantity"),
    )
    pages = pages.filter("doc_id % 5 <> 0 OR page_no < page_count")
    inbox, sink, marks = (work_folder(spark, n) for n in ("pages", "parts", "marks"))
    for wanted in ("(page_no + doc_id) % 2 = 1", "(page_no + doc_id) % 2 = 0 OR page_no = 1"):
        pages.filter(wanted).write.mode("append").parquet(inbox)
        # Parts of three pages, so that most orders take several.
        incremental_ingest(spark, inbox, pages.schema, sink, marks, lambda df: completed_parts(df, ["quantity"], part=3))
    return completed_documents(spark.read.parquet(sink), ["quantity"])


def _methods(spark, sf):
    log = run_log(spark, sf).filter("status = 'success'")
    return log.select(F.explode("extraction_methods").alias("method"), "pages", "processing_seconds").groupBy("method").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("pages").alias("pages"),
        F.sum("processing_seconds").cast("double").alias("seconds"),
    )


QUERIES = {
    "scan_inputs": lambda s, d: batch.scan_inputs(run_log(s, d)).select("source_file"),
    "scan_inputs_listed": lambda s, d: batch.scan_inputs(run_log(s, d), ignore_case=True).select("source_file"),
    "manifest_scan": _manifest,
    "admission_filter": lambda s, d: batch.admission_filter(run_log(s, d)).select(
        "source_file", "admitted", F.coalesce("reject_reason", F.lit("")).alias("reject_reason")
    ),
    "load_artifacts": _cached,
    "resume_plan": lambda s, d: batch.resume_plan(_inputs(s, d), _cached(s, d)),
    "resume_plan_forced": lambda s, d: batch.resume_plan(_inputs(s, d), _cached(s, d), force=True),
    "resumed_results": _resumed,
    "classify_errors": lambda s, d: batch.classify_errors(run_log(s, d)).select(
        "source_file", "error_message", "retryable"
    ),
    "rejects": lambda s, d: batch.rejects(run_log(s, d)),
    "batch_report": lambda s, d: batch.batch_report(run_log(s, d)),
    "method_report": _methods,
    "warnings_by_code": lambda s, d: batch.warnings_by_code(run_log(s, d)),
    "run_summary": lambda s, d: batch.run_summary(run_log(s, d)),
    "outcomes": lambda s, d: batch.outcomes(run_log(s, d)),
    "incremental_ingest": _ingest,
    "documents_in_deliveries": _deliveries,
}

LOG = """
log AS (
  SELECT event_id AS e, concat('doc_', lpad(CAST(event_id AS VARCHAR), 9, '0'),
      CASE event_id % 10 WHEN 8 THEN '.PDF' WHEN 9 THEN '.md' ELSE '.pdf' END) AS source_file,
    event_type = 'error' AS failed, CAST(value AS DECIMAL(18,2)) AS seconds, user_id AS u,
    CASE WHEN event_id % 97 <> 0 THEN event_id * 7919 % 41943040 END AS n_bytes,
    CASE WHEN user_id % 2 = 0 THEN 'pymupdf' ELSE 'pymupdf+llm' END AS method,
    CASE WHEN event_type <> 'error' THEN NULL WHEN event_id % 3 = 0 THEN '429 quota'
      WHEN event_id % 3 = 1 THEN 'RESOURCE_EXHAUSTED' ELSE 'timeout' END AS error_message
  FROM events
)"""
WITH = f"WITH {LOG}"
CACHED = "e % 3 <> 0 AND e % 4 <> 0"
REPORT = """count(*) AS total, count(*) FILTER (NOT failed) AS succeeded, count(*) FILTER (failed) AS failed,
    sum(CASE WHEN failed THEN 0 ELSE 1 + e % 9 END) AS pages, sum(CASE WHEN failed THEN 0 ELSE e % 3 END) AS warnings,
    CAST(sum(seconds) AS DOUBLE) AS seconds, round(CAST(avg(seconds) AS DOUBLE), 6) AS mean_seconds, CAST(max(seconds) AS DOUBLE) AS max_seconds,
    round(avg(CASE WHEN NOT failed THEN (e % 101) / 100.0 END), 6) AS mean_confidence"""

ORACLES = {
    "scan_inputs": f"{WITH} SELECT source_file FROM log WHERE source_file LIKE '%.pdf'",
    "scan_inputs_listed": f"{WITH} SELECT source_file FROM log WHERE lower(source_file) LIKE '%.pdf'",
    "manifest_scan": f"""{WITH} SELECT source_file AS file_path, CASE u % 3 WHEN 0 THEN 'invoice' WHEN 1 THEN 'shipment'
        ELSE 'generic' END AS document_type FROM log""",
    "admission_filter": f"""{WITH}, r AS (SELECT source_file, CASE WHEN lower(source_file) NOT LIKE '%.pdf' THEN 'not a PDF'
        WHEN n_bytes > 20971520 THEN 'too large' ELSE '' END AS reject_reason FROM log)
        SELECT source_file, reject_reason = '' AS admitted, reject_reason FROM r""",
    "load_artifacts": f"""{WITH} SELECT e AS doc_id, source_file, CASE WHEN failed THEN 0 ELSE 1 + e % 9 END AS pages,
        CASE WHEN failed THEN 0 ELSE e % 21 END AS fields_found FROM log WHERE {CACHED}""",
    "resume_plan": f"""{WITH} SELECT e AS doc_id, source_file, CASE WHEN {CACHED} THEN 'skip' ELSE 'work' END AS action FROM log""",
    "resume_plan_forced": f"{WITH} SELECT e AS doc_id, source_file, 'work' AS action FROM log",
    "resumed_results": f"""{WITH} SELECT e AS doc_id, source_file, 'success' AS status, CASE WHEN failed THEN 0 ELSE 1 + e % 9 END AS pages,
        CASE WHEN failed THEN 0 ELSE e % 4 END AS tables_found, CASE WHEN failed THEN 0 ELSE e % 21 END AS fields_found,
        CASE WHEN failed THEN 0 ELSE e % 3 END AS warnings_count, CAST(0 AS DOUBLE) AS processing_seconds, true AS resumed FROM log WHERE {CACHED}""",
    "warnings_by_code": f"""{WITH} SELECT code, count(*) AS n, count(*) AS documents FROM (
          SELECT 'EMPTY_DOCUMENT' AS code FROM log WHERE NOT failed AND e % 3 >= 1 UNION ALL SELECT 'RAGGED_TABLE' FROM log WHERE NOT failed AND e % 3 = 2)
        GROUP BY code""",
    "outcomes": f"""{WITH} SELECT CASE WHEN failed THEN 'failed' WHEN e % 21 = 0 THEN 'skipped' ELSE 'converted' END AS outcome, source_file FROM log""",
    "classify_errors": f"""{WITH} SELECT source_file, error_message, e % 3 = 2 AS retryable FROM log WHERE failed""",
    "rejects": f"{WITH} SELECT source_file, error_message, e % 3 = 2 AS retryable FROM log WHERE failed",
    "batch_report": f"""{WITH}, l AS (SELECT *, CASE WHEN failed THEN 'failed' ELSE 'success' END AS status FROM log)
        SELECT CASE WHEN grouping(status) = 1 THEN 'all' ELSE status END AS status,
          CASE WHEN grouping(method) = 1 THEN 'all' ELSE method END AS method, {REPORT} FROM l GROUP BY ROLLUP (status, method)""",
    "method_report": f"""{WITH} SELECT m AS method, count(*) AS documents, sum(1 + e % 9) AS pages, CAST(sum(seconds) AS DOUBLE) AS seconds
        FROM (SELECT *, unnest(string_split(method, '+')) AS m FROM log WHERE NOT failed) GROUP BY 1""",
    "run_summary": f"""{WITH} SELECT CASE WHEN failed THEN 'failed' WHEN e % 21 = 0 THEN 'skipped' ELSE 'converted' END AS outcome,
        count(*) AS n FROM log GROUP BY 1""",
    "documents_in_deliveries": """SELECT l_orderkey AS doc_id, CAST(count(*) AS BIGINT) AS pages, CAST(sum(l_quantity) AS DOUBLE) AS quantity
      FROM lineitem WHERE l_orderkey % 5 <> 0 GROUP BY l_orderkey""",
    "incremental_ingest": "SELECT conv_id, turn, length(text) AS n_chars FROM conversations",
}
