"""URL filters: rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs, by default those that a rule decides. Features are lengths, depth, shares
of digits and other characters, entropy, parameter counts, and statistics of the host's last label: the
smoothed share of blocked URLs, counted in Spark over all labelled URLs in ``BUCKETS`` hash buckets. The
trees themselves are fitted on at most ``most`` labelled URLs, those with the smallest hash, by histograms in
numpy; the fitted trees, a few kilobytes, go to every task.

The host lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
follows up to ``?``, ``#`` or the end. Null URLs and URLs without ``://`` have an empty host and path, and are
judged by the trees like others. A URL that is labelled more than once counts once, with the share of its
labels as its answer. Without labelled URLs of both kinds the verdict is that of the only kind, or
allow. Of two rules of equal length that fit, the one for the longer host holds. Repeated rows are judged
alike, an empty table gives an empty result, and other columns are returned unchanged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Hash buckets of the statistics per suffix.
BUCKETS = 1024
#: Labelled URLs that the trees are fitted on, at most.
MOST = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def located(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host`` and ``path``."""
    text = F.coalesce(url, F.lit(""))
    after = F.when(F.instr(text, "://") > 0, F.substr(text, F.instr(text, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*(/[^?#]*)", 1)
    return urls.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def ruled(rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct of rule and verdict; null if none does."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[0] == "allow")):
        host, path = rule[: rule.index("/")], rule[rule.index("/") :]
        at = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits.append(F.when(at & F.col("path").startswith(path), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def bucket(host: str) -> int:
    """Hash bucket of the host's last label."""
    return xxhash.xxh3_64_intdigest(host.rpartition(".")[2].encode()) % BUCKETS


def features(url: str | None, host: str, path: str, shares: np.ndarray) -> list[float]:
    """Lexical features of one URL; ``shares``: blocked share of each suffix bucket."""
    url = url or ""
    query = url.partition("#")[0].partition("?")[2]
    counts = Counter(url)
    n = max(1, len(url))
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    digits = sum(map(str.isdigit, url))
    last = path.rpartition("/")[2]
    first = path.split("/")[1] if path.count("/") else ""
    return [
        len(url),
        len(host),
        len(path),
        path.count("/"),
        host.count("."),
        digits / n,
        sum(map(str.isdigit, host)),
        sum(map(str.isdigit, path)),
        entropy,
        len(query),
        query.count("&") + bool(query),
        query.count("="),
        url.count("-") + url.count("_"),
        url.count("%"),
        "#" in url,
        "." in last,
        len(first),
        sum(map(ord, first[:2])),  # tells short path segments such as language codes apart
        url.startswith("https"),
        max(map(len, host.split("."))),
        shares[bucket(host)],
    ]


class Trees:
    """Boosted regression trees for a yes-or-no answer, split at histogram borders."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: int = 10) -> None:
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3))
        self.base = math.log(share / (1 - share))
        if not len(y) or y.min() == y.max():
            return self
        borders = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(b, c, "left") for b, c in zip(borders, x.T, strict=True)], axis=1)
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            feature = np.full(2**self.depth, -1)
            border = np.zeros(2**self.depth)
            node = np.ones(len(y), np.int64)
            for level in range(self.depth):
                width = 2**level
                best = np.full(width, 1e-6)
                chosen = [None] * width
                place = node - width
                for f in range(x.shape[1]):
                    key = place * self.bins + binned[:, f]
                    g = np.bincount(key, grad, width * self.bins).reshape(width, -1).cumsum(1)
                    h = np.bincount(key, hess, width * self.bins).reshape(width, -1).cumsum(1)
                    c = np.bincount(key, minlength=width * self.bins).reshape(width, -1).cumsum(1)
                    gl, hl, cl = g[:, :-1], h[:, :-1], c[:, :-1]
                    gr, hr, cr = g[:, -1:] - gl, h[:, -1:] - hl, c[:, -1:] - cl
                    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                    gain[(cl < self.least) | (cr < self.least)] = 0
                    gain = gain[:, : len(borders[f])]
                    if not gain.shape[1]:
                        continue
                    at = gain.argmax(1)
                    value = gain[np.arange(width), at]
                    for k in np.flatnonzero(value > best):
                        best[k], chosen[k] = value[k], (f, at[k])
                right = np.zeros(len(y), np.int64)
                for k, split in enumerate(chosen):
                    if split:
                        feature[width + k], border[width + k] = split[0], borders[split[0]][split[1]]
                        here = place == k
                        right[here] = binned[here, split[0]] > split[1]
                node = node * 2 + right
            leaf = node - 2**self.depth
            g = np.bincount(leaf, grad, 2**self.depth)
            h = np.bincount(leaf, hess, 2**self.depth)
            value = self.rate * g / (h + 1)
            self.trees.append((feature, border, value))
            score += value[leaf]
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, border, value in self.trees:
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = node * 2 + ((f >= 0) & (x[rows, np.maximum(f, 0)] > border[node]))
            score += value[node - 2**self.depth]
        return 1 / (1 + np.exp(-score))


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buckets = [bucket(h) for h in batch["host"].to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), batch["blocked"]], ["bucket", "blocked"])


def distinct(labelled: DataFrame) -> DataFrame:
    """One row for each labelled URL; ``blocked`` is the share of its rows that say so."""
    return located(labelled.groupBy("url").agg(F.avg("blocked").alias("blocked")))


def sampled(urls: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and answers of the URLs with the smallest hash, and the suffix shares over all of ``urls``."""
    counted = urls.select("host", "blocked").mapInArrow(_bucketed, "bucket int, blocked double").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("blocked").alias("b"))
    n, b = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.collect():  # at most BUCKETS rows
        n[r["bucket"]], b[r["bucket"]] = r["n"], r["b"]
    prior = b.sum() / n.sum() if n.sum() else 0.5
    sample = urls.select("url", "host", "path", "blocked").orderBy(F.xxhash64("url"), "url").limit(most).collect()
    y = np.array([r["blocked"] for r in sample], float)
    x = np.array([features(r["url"], r["host"], r["path"], n) for r in sample], float).reshape(len(sample), len(features("", "", "", n)))
    # A URL's own answer is no part of the share it learns from.
    at = np.array([bucket(r["host"]) for r in sample], int)
    x[:, -1] = (b[at] - y + 5 * prior) / (n[at] + 4)
    return x, y, (b + 5 * prior) / (n + 5)


def train(labelled: DataFrame, most: int = MOST) -> tuple[Trees, np.ndarray]:
    """Trees and suffix shares from rows of ``url`` and ``blocked`` (0 or 1)."""
    x, y, shares = sampled(distinct(labelled), most)
    return Trees().fit(x, y), shares


def held_out(labelled: DataFrame, most: int = MOST, part: int = 5) -> dict[str, float]:
    """Precision, recall and accuracy of block on every ``part``-th URL of the sample, by trees fitted on the others."""
    x, y, _ = sampled(distinct(labelled), most)
    test = np.arange(len(y)) % part == 0
    said, true = Trees().fit(x[~test], y[~test]).probability(x[test]) > 0.5, y[test] > 0.5
    hit = float((said & true).sum())
    return {"urls": float(test.sum()), "precision": hit / max(1, int(said.sum())), "recall": hit / max(1, int(true.sum())), "accuracy": float((said == true).mean()) if len(true) else 0.0}


def _scored(trees: Trees, shares: np.ndarray, schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(*r, shares) for r in zip(batch["url"].to_pylist(), batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)], float)
            p = trees.probability(x) if len(x) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*schema_names, "blocked_probability"])

    return run


def judge(urls: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, labelled: DataFrame | None = None, key: str = "page_id", most: int = MOST) -> DataFrame:
    """(key, url, host, path, rule, verdict, blocked_probability) for each row.

    ``labelled``: rows of ``url`` and ``blocked`` (0 or 1); without it the URLs that a rule decides are used.
    """
    table = located(urls.select(key, "url")).withColumn("by_rule", ruled(rules))
    if labelled is None:
        known = table.filter("by_rule is not null").select("url", (F.col("by_rule.verdict") == "block").cast("int").alias("blocked"))
    else:
        known = labelled.filter("blocked is not null").select("url", F.col("blocked").cast("int").alias("blocked"))
    trees, shares = train(known, most)
    slim = table.select(key, "url", "host", "path", F.col("by_rule.rule").alias("rule"), F.col("by_rule.verdict").alias("ruled"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema)
    scored = slim.mapInArrow(_scored(trees, shares, slim.columns), f"{kinds}, blocked_probability double")
    learned = F.when(F.col("blocked_probability") > 0.5, "block").otherwise("allow")
    return scored.select(key, "url", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "blocked_probability")
