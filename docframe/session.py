"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Text columns dominate the row size here, so scans are split finer than the
# 128 MB default and AQE coalesces what turns out to be small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "64m",
    # Of a repeated key in a model's JSON the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(
    app: str = "docframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Create a session; on a cluster leave ``master`` and the partition count unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one the cluster names.

    ``spark.checkpoint.dir`` is used as given. Only a local session that does
    not set it falls back to a temporary folder; on a cluster that would not be
    shared between machines, so it is refused there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="docframe-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def written(df: DataFrame, purpose: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` written to the shared working folder and read back.

    For results several branches of a query read; unlike a cache, the files
    outlive the executors that made them. With ``by`` they are in as many buckets
    of these columns as the session's shuffles have, and whatever groups, orders
    or joins by them does not shuffle the rows again; rows of one key are read by
    one task. A table of the session's catalog names the buckets while they are
    written; it is dropped at once, its files stay.
    """
    spark, folder = df.sparkSession, work_folder(df.sparkSession, purpose)
    if not by:
        df.write.parquet(folder)
        return spark.read.parquet(folder)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"spark_catalog.default.docframe_{uuid.uuid4().hex}"
    dealt = df.repartition(n, *by).write.format("parquet").option("compression", "zstd").option("path", folder)
    dealt.bucketBy(n, *by).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return found
