"""Queries of the text-preparation operators over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm import binary_records, conversation_repair, decontamination, jaccard_join, license_scan, line_dedup, packing, periodic_runs, quality_rules, secret_scan, substring_dedup, url_filters, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "blocked_probability")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def digest(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.inspect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def vocabulary() -> str:
    """Where the public vocabulary lies."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    pieces = packing.pack(docs, vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def planted(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten, by a checksum of its number, goes on periodically from some word on."""
    given = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("given", F.when(F.col("h") % 10 == 0, given)).withColumn("n", F.size("given").cast("long"))
    rows = rows.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rest = F.col("n") - F.col("a")
    rows = rows.withColumn("p", 1 + F.floor(rest / (3 + F.col("g") % 8)))
    unit = F.slice("given", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    again = F.flatten(F.array_repeat(unit, (F.floor(rest / F.col("p")) + 1).cast("int")))
    whole = F.concat(F.slice("given", 1, F.col("a").cast("int")), F.slice(again, 1, rest.cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.runs(planted(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = -F.col("longest.less"), F.col("longest.period")
    return out.select("doc_id", "n_runs", F.col("longest.start").alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = binary_records.round_trip(table(spark, sf_dir, "documents"), vocabulary())
    return records.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(original)).reports(original)


OPERATORS = (op1_url_filters, op2_line_dedup, op3_secret_scans, op4_quality_rules, op5_warc, op6_jaccard_join, op7_substring_dedup, op8_benchmark_decontamination, op9_license_scans, op10_packing, op11_periodic_runs, op12_binary_records, op13_conversation_repair)
QUERIES = {f.__name__: f for f in OPERATORS}
ORACLES = {"op2_line_dedup": line_dedup.oracle(), "op5_warc": warc.oracle(), "op9_license_scans": license_scan.oracle(), "op13_conversation_repair": conversation_repair.oracle()}
