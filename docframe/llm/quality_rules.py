"""Quality rules: base rules, then robust multivariate outliers per language and source.

The statistics of each document (words, their characters, symbols, repeated lines and words) become a
vector of five transformed numbers. For each language and source a minimum-covariance-determinant
estimate of centre and scatter is made: rows are dealt into bounded blocks, each block runs concentration
steps to the half with the smallest determinant, the blocks' estimates are pooled, and one reweighting pass
over all rows of the group gives the final estimate. Documents whose squared Mahalanobis distance lies
beyond a far chi-square quantile are rejected.

Null texts have no words; they and all texts of under ``min_words`` words fail the base rules. A group with
fewer than ``min_group`` rows is judged by the estimate of all rows of its language, or, if these are too few,
of the corpus; rows are kept where even the corpus is too small. Null languages and sources are values like others. Repeated rows are judged alike. An empty
table gives an empty result. Columns other than those named are not read by ``judge`` and are returned
unchanged by ``keep``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.llm import words as W
from docframe.session import written

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: Least spread of each transformed statistic, a bound only: log words, log word length, and the square roots
#: of the shares of symbols, repeated lines and repeated words. So small that each can reject by itself.
FLOOR = (0.25, 0.08, 0.05, 0.08, 0.05)
P = len(FLOOR)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
#: Rows of a block: an estimate from so many is stable, and its concentration steps take milliseconds.
BLOCK = 2000
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeat_words(hashes: np.ndarray, offsets: np.ndarray, length: int = 8) -> np.ndarray:
    """Words of each text that lie in a window found at least twice in it."""
    texts = len(offsets) - 1
    owner = W.owners(offsets)
    starts = np.flatnonzero(W.inside(owner, length))
    if not len(starts):
        return np.zeros(texts, np.int64)
    keys = W.mixed(W.windows(hashes, length)[starts] + W.mixed(owner[starts].astype(np.uint64) + W.MIX))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = W.covered(starts[twice], length, len(hashes))
    return np.bincount(owner[hit], minlength=texts).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = W.Hashes()
    for batch, texts in W.portions(batches):
        texts = [t or "" for t in texts]
        hashes, offsets = W.hashed([W.spaced(t) for t in texts], memory)
        lines = [[x for x in t.split("\n") if x.strip(SPACES)] for t in texts]
        columns = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        numbers = {
            "n_words": np.diff(offsets),
            "word_chars": [len(t) - sum(map(t.count, SPACES)) for t in texts],
            "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
            "n_dup_lines": [len(x) - len(set(x)) for x in lines],
            "n_repeat_words": repeat_words(hashes, offsets),
            "n_lines": [len(x) for x in lines],
        }
        yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int64()) for x in numbers.values())], [*names, *numbers])


def statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text, with the row's identity, language and source."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.to_json(F.struct("lang", "source")).alias("grp"), F.to_json(F.struct("lang")).alias("pool"), "text")
    return slim.mapInArrow(_count, f"doc_id {kind}, text_key long, grp string, pool string, {COUNTS}")


def _vector() -> list[Column]:
    def share(part: str, whole: str) -> Column:
        return F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    return [
        F.log1p("n_words"),
        F.log((F.col("word_chars") + 1) / F.greatest(F.col("n_words"), F.lit(1))),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]


def quantile(share: float) -> float:
    """Chi-square quantile for the vector's dimension (Wilson and Hilferty)."""
    a = 2 / (9 * P)
    return P * (1 - a + NormalDist().inv_cdf(share) * a**0.5) ** 3


def consistency(share: float) -> float:
    """Factor that makes the scatter of the nearest ``share`` of normal rows that of all (Wilson and Hilferty)."""
    a = 2 / (9 * (P + 2))
    return share / NormalDist().cdf(((quantile(share) / (P + 2)) ** (1 / 3) - (1 - a)) / a**0.5)


def bounded(scatter: np.ndarray) -> np.ndarray:
    """The scatter, with the spread of every direction at least one in units of ``FLOOR``."""
    units = np.outer(FLOOR, FLOOR)
    values, vectors = np.linalg.eigh(scatter / units)
    return (vectors * np.maximum(values, 1)) @ vectors.T * units


def concentrated(x: np.ndarray, seed: int, starts: int = 6, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter of the half of rows whose scatter has the smallest determinant, the scatter made consistent."""
    n = len(x)
    h = min(n, (n + P + 1) // 2)
    rng = np.random.default_rng(seed)
    centre = np.median(x, axis=0)
    spread = np.maximum(1.4826 * np.median(np.abs(x - centre), axis=0), FLOOR)
    firsts = [np.square((x - centre) / spread).sum(axis=1)]
    for _ in range(starts):
        pick = x[rng.choice(n, min(n, P + 1), replace=False)]
        inverse = np.linalg.inv(bounded(np.cov(pick.T, bias=True).reshape(P, P)))
        firsts.append(np.einsum("ni,ij,nj->n", x - pick.mean(0), inverse, x - pick.mean(0)))
    best = None
    for d in firsts:
        for _ in range(steps):
            near = np.argsort(d, kind="stable")[:h]
            mean = x[near].mean(0)
            scatter = np.cov(x[near].T, bias=True).reshape(P, P)
            bound = bounded(scatter)
            new = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(bound), x - mean)
            if np.array_equal(near, np.argsort(new, kind="stable")[:h]):
                break
            d = new
        det = np.linalg.slogdet(bound)[1]
        if best is None or det < best[0] - 1e-12:
            best = det, mean, scatter
    _, mean, scatter = best
    return mean, bounded(scatter * (consistency(h / n) if h < n else 1.0))


def _block(key, frame):
    import pandas as pd

    x = np.stack(frame["v"].to_numpy()).astype(float)
    x = x[np.lexsort(x.T)]  # the same estimate whatever order rows arrive in
    mean, scatter = concentrated(x, zlib.crc32(f"{key[0]}/{key[1]}".encode()))
    return pd.DataFrame({"grp": [key[0]], "n": [len(x)], "mean": [mean.tolist()], "cov": [[scatter[i, j] for i, j in PAIRS]]})


def _inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre and inverse scatter of each group from its sums."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            c = np.zeros((P, P))
            for k, (i, j) in enumerate(PAIRS):
                c[i, j] = c[j, i] = r["cov"][k]
            rows.append({"grp": r["grp"], "m": r["mean"], "w": np.linalg.inv(bounded(c)).ravel().tolist()})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("grp", pa.string()), ("m", pa.list_(pa.float64())), ("w", pa.list_(pa.float64()))]))


def _distance() -> Column:
    x = [F.col("v")[i] - F.col("m")[i] for i in range(P)]
    return sum((x[i] * x[i] * F.col("w")[i * P + i] for i in range(P)), F.lit(0.0)) + sum((2 * x[i] * x[j] * F.col("w")[i * P + j] for i, j in PAIRS if i < j), F.lit(0.0))


def judge(docs: DataFrame, min_words: int = 20, repeat_percent: int = 30, min_group: int = 50, quantile_kept: float = 1 - 1e-9) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` (null where no group is large enough) and ``kept`` for each row."""
    spark = docs.sparkSession
    table = written(statistics(docs), "quality")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    table = table.withColumns({"base_failed": failed, "v": F.array(*_vector())})
    sizes = spark.read.schema("grp string, pool string, n long").parquet(_put(table.filter(~F.col("base_failed")).groupBy("grp", "pool").agg(F.count("*").alias("n"))))
    pools = sizes.groupBy("pool").agg(F.sum("n").alias("in_pool"), (F.min("n") < min_group).alias("lends"))
    corpus = pools.agg(F.sum("in_pool").alias("in_all"), (F.min("in_pool") < min_group).alias("all_lend"))

    def target(name: Column, n: str) -> Column:
        return F.when(F.col(n) >= min_group, F.struct(name.alias("grp"), F.ceil(F.col(n) / BLOCK).alias("blocks")))

    own, wide, widest = target(F.col("grp"), "n"), target(F.concat(F.lit("*"), "pool"), "in_pool"), target(F.lit("**"), "in_all")
    # The estimate that judges a group, and all that its rows take part in: wider ones only where a small group needs them.
    feeds = F.array_compact(F.array(own, F.when(F.col("lends"), wide), F.when(F.col("all_lend"), widest)))
    groups = sizes.join(pools, "pool").crossJoin(corpus).select(F.col("grp").alias("own"), F.coalesce(own, wide, widest)["grp"].alias("to"), feeds.alias("feeds")).filter("to is not null")
    groups = spark.read.schema("own string, to string, feeds array<struct<grp:string,blocks:long>>").parquet(_put(groups))
    named = groups.select("own", "to")
    fed = groups.select("own", F.explode("feeds").alias("feed")).select("own", "feed.grp", "feed.blocks")
    rows = table.filter(~F.col("base_failed")).select(F.col("grp").alias("own"), "doc_id", "text_key", "v")
    good = rows.join(fed, "own").select("grp", "v", F.pmod(F.xxhash64("doc_id", "text_key"), F.col("blocks")).alias("block"))
    estimates = good.groupBy("grp", "block").applyInPandas(_block, "grp string, n long, mean array<double>, cov array<double>")
    pooled = _weighted(estimates, [F.col("mean")[i] for i in range(P)], [F.col("cov")[k] for k in range(len(PAIRS))], F.col("n"))
    first = spark.read.schema("grp string, m array<double>, w array<double>").parquet(_put(pooled.mapInArrow(_inverted, "grp string, m array<double>, w array<double>")))
    # By block as well, so the rows of a large group spread over tasks.
    first = first.join(fed.select("grp", "blocks").distinct(), "grp").select("grp", "m", "w", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    near = good.join(first, ["grp", "block"]).filter(_distance() <= quantile(0.975)).select("grp", "v")
    v = [F.col("v")[i] for i in range(P)]
    sums = near.groupBy("grp").agg(F.count("*").alias("n"), *(F.avg(x).alias(f"m{i}") for i, x in enumerate(v)), *(F.covar_pop(v[i], v[j]).alias(f"c{i}{j}") for i, j in PAIRS))
    # The cut at the 0.975 quantile shortens the spread a little; the factor restores it for normal data.
    factor = consistency(0.975)
    final = sums.select("grp", F.array(*(f"m{i}" for i in range(P))).alias("mean"), F.array(*(F.col(f"c{i}{j}") * factor for i, j in PAIRS)).alias("cov"))
    final = spark.read.schema("grp string, m array<double>, w array<double>").parquet(_put(final.mapInArrow(_inverted, "grp string, m array<double>, w array<double>")))
    params = named.join(final.withColumnRenamed("grp", "to"), "to").select("own", "m", "w")
    judged = table.join(params, F.col("grp") == F.col("own"), "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= quantile(quantile_kept), F.lit(True))
    return judged.select("doc_id", "text_key", *(x.split()[0] for x in COUNTS.split(", ")), "base_failed", "distance", kept.alias("kept"))


def _put(df: DataFrame) -> str:
    """Write a table of one row per group; the path it lies at."""
    from docframe.session import work_folder

    folder = work_folder(df.sparkSession, "groups")
    df.write.parquet(folder)
    return folder


def _weighted(df: DataFrame, means: list[Column], covs: list[Column], n: Column) -> DataFrame:
    total = F.sum(n)
    sums = [F.sum(x * n) / total for x in (*means, *covs)]
    return df.groupBy("grp").agg(F.array(*sums[:P]).alias("mean"), F.array(*sums[P:]).alias("cov"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns unchanged."""
    gone = judge(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_gone_id")) & (F.xxhash64(docs["text"]) == F.col("_gone_key")), "left_anti")
