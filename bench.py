"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Each query runs BENCH_RUNS times (default 2) into the
noop sink, which computes every column of every row; the best time counts.
``rows_per_s`` counts the rows of the table a query grows with. BENCH_ALL=1
times all queries, BENCH_SCALING=1 adds the times of SCALED at one and at four
cores, each in a process of its own.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)  # for Python workers

from docframe.plans import catalog  # noqa: E402
from docframe.session import build_session  # noqa: E402

HEADLINE = (
    "segments",
    "tmx_documents",
    "fix_heading_skips",
    "sections",
    "chunks",
    "quality_checklist",
    "drop_repeated_lines",
    "split_glued_words",
    "md_documents",
    "validate_documents",
    "full_text",
    "import_markdown_tables",
    "rows_to_dicts",
    "table_csv_rows",
    "key_values",
    "schema_guided_fields",
    "batch_summary",
    "document_text",
    "validated_records",
    "record_with_fallback",
    "line_items_wide",
    "blocks_outside_tables",
    "page_provenance",
    "layout_page_text",
    "best_extraction",
    "batch_report",
    "resume_plan",
)


# The table whose rows a query's work grows with, by the first query that reads another one.
TABLE = {
    "md_documents": "conversations", "validate_documents": "conversations", "full_text": "conversations",
    "import_markdown_tables": "lineitem", "rows_to_dicts": "lineitem", "table_csv_rows": "lineitem", "key_values": "lineitem",
    "schema_guided_fields": "lineitem", "batch_summary": "lineitem", "document_text": "lineitem", "record_with_fallback": "lineitem",
    "blocks_outside_tables": "lineitem", "page_provenance": "lineitem", "layout_page_text": "lineitem",
    "validated_records": "orders", "line_items_wide": "orders", "best_extraction": "pages",
    "batch_report": "events", "resume_plan": "events",
}
SCALED = ("segments", "md_documents", "batch_summary", "validated_records", "split_glued_words")


def scaling() -> dict[str, dict[str, float]]:
    """Seconds of the SCALED queries at one and four cores."""
    out = {}
    for cpus in ("1", "4"):
        env = os.environ | {"BENCH_CPUS": cpus, "BENCH_ONLY": ",".join(SCALED), "BENCH_SCALING": "", "BENCH_ALL": ""}
        done = subprocess.run([sys.executable, __file__], env=env, capture_output=True, text=True, check=True)
        out[cpus] = json.loads(done.stdout.strip().splitlines()[-1])["queries"]
    return {name: {"1": out["1"][name], "4": out["4"][name], "speedup": round(out["1"][name] / out["4"][name], 2)} for name in SCALED}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus),
        **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = HEADLINE
    if os.environ.get("BENCH_ALL"):
        names = tuple(queries)
    if os.environ.get("BENCH_ONLY"):
        names = tuple(os.environ["BENCH_ONLY"].split(","))
    times: dict[str, float] = {}
    sizes: dict[str, int] = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
        table = TABLE.get(name, "documents")
        if table not in sizes:
            sizes[table] = spark.read.parquet(f"{sf}/{table}.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, best of runs, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "rows_per_s": {n: round(sizes[TABLE.get(n, "documents")] / t) for n, t in times.items()},
            }
            | ({"scaling": scaling()} if os.environ.get("BENCH_SCALING") else {})
        )
    )


if __name__ == "__main__":
    main()
