"""N-gram Jaccard join, size-aware: small sets by enumerated subsets, large sets by inverted lists.

A document's set holds its distinct shingles of ``gram`` words (all its words as one, if it has fewer). Two
documents link when 100 * intersection >= percent * union; linked documents, and those linked through others,
form a component. Equal sets are one class from the start, and only classes are compared.

*Light* sets (up to the boundary) enumerate, for each partner size in reach, all their subsets of exactly the
overlap that a link of those sizes takes. Two sets of such sizes link if and only if they meet in a subset, so
the sets of a subset are joined to one of them and no pair need be formed.

*Heavy* sets scan inverted lists. First, all sets count the shingles of a fixed share of the hash range; a set
with so many shingles that no other has, that the rest can't reach the threshold, is done. The others order
all their shingles by how many of them hold each, rarest first, and put the first ones (prefix filter) into
lists with their positions. Each set is first compared with one set of each of its lists, the one with the
fewest shingles of its own, as originals have among their copies. Lists whose sets are in one component now are
done; in the others, pairs from different components that pass the length and positional filters are compared.
So the exact components arise without forming all pairs of a group of copies.

The boundary is where the cost of both ways, counted on the sizes that occur, is least. Sets just below it
stand in the lists too, for their links with larger ones.

Empty and null texts have an empty set, and each such row is its own component. Rows with the same doc_id are
compared like others and share nothing else; null doc_ids count as none in a component's smallest doc_id. An
empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are returned unchanged by
``keep_first`` and not read otherwise. Shingles are compared as 64-bit hashes, whole sets as 128-bit hashes.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docframe.llm import words as W
from docframe.session import written

#: Sets up to this size may be light.
SMALL = 32
#: Assumed rows of a list that a heavy set meets, in the cost that sets the boundary.
LIST_COST = 6


def shingled(hashes: np.ndarray, offsets: np.ndarray, gram: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    grams = W.mixed(W.windows(hashes, gram))
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= gram:
            out.append(np.unique(grams[a : b - gram + 1]))
        elif b > a:
            out.append(W.mixed(W.windows(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _sets(gram: int, share: int, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = W.Hashes()
        for batch, texts in W.portions(batches):
            hashes, offsets = W.hashed([W.spaced_lower(t or "") for t in texts], memory)
            sets = shingled(hashes, offsets, gram)
            sigs = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            kept = sets if full else [s if len(s) <= SMALL else s[s % np.uint64(share) == 0] for s in sets]
            edges = np.cumsum([0, *map(len, kept)])
            flat = np.concatenate(kept).view(np.int64) if kept else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary()), lists], ["doc_id", "n", "sig", "shingles"])

    return run


def overlap(n: Column, m: Column, percent: int) -> Column:
    """Shingles that sets of these sizes must share to link."""
    return F.ceil((F.lit(percent) * (n + m)) / F.lit(100 + percent)).cast("long")


def least_overlap(n: int, m: int, percent: int) -> int:
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> list[int]:
    """Sizes of sets that a set of ``n`` shingles may link with."""
    reach = range(max(1, -(-percent * n // 100)), 100 * n // percent + 1)
    return [m for m in reach if least_overlap(n, m, percent) <= min(n, m) and (m != n or least_overlap(n, n, percent) < n)]


def subsets(n: int, percent: int) -> int:
    """How many subsets a light set of ``n`` shingles enumerates."""
    return sum(math.comb(n, least_overlap(n, m, percent)) for m in partners(n, percent))


def boundary(sizes: dict[int, int], percent: int, share: int) -> int:
    """The size up to which sets are light, at least cost over the sizes that occur."""
    best = (math.inf, 0)
    for limit in range(SMALL + 1):
        light = sum(c * subsets(n, percent) for n, c in sizes.items() if n <= limit)
        zone = -(-percent * (limit + 1) // 100)
        heavy = sum(c * (n / share + (n - -(-percent * n // 100) + 1) * LIST_COST) for n, c in sizes.items() if n >= zone)
        best = min(best, (light + heavy, limit))
    return best[1]


def _enumerated(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sig, shingles in zip(batch["sig"].to_pylist(), batch["shingles"].to_pylist(), strict=True):
                n = len(shingles)
                if not partners(n, percent):
                    continue
                codes = np.array(shingles, np.int64).view(np.uint64)
                one, two = W.mixed(codes), W.mixed(codes ^ W.MIX)
                keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                out: list[list[np.ndarray]] = [[], [], []]
                for m in partners(n, percent):
                    missing = n - least_overlap(n, m, percent)
                    if missing not in keys:
                        picks = np.array(list(itertools.combinations(range(n), missing)), np.int64).reshape(math.comb(n, missing), missing)
                        keys[missing] = one.sum() - one[picks].sum(axis=1, dtype=np.uint64), two.sum() - two[picks].sum(axis=1, dtype=np.uint64)
                    sizes = np.uint64(min(n, m) * 65_536 + max(n, m)) * W.MIX
                    for k in (0, 1):
                        out[k].append(W.mixed(keys[missing][k] + sizes).view(np.int64))
                    out[2].append(np.full(len(keys[missing][0]), (m > n) - (m < n), np.int32))
                ones, twos, sides = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays([pa.array([sig] * len(ones), pa.binary()), pa.array(ones), pa.array(twos), pa.array(sides)], ["sig", "k1", "k2", "side"])

    return run


def light_links(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each light set joined to one set of every subset it shares with sets of the partner's size.

    Two sets of one size that both hold a subset meant for another size don't link by it, so those of the
    smaller size (side 1) are joined to one of the larger (side -1) and the other way round.
    """
    rows = classes.select("sig", "shingles").mapInArrow(_enumerated(percent), "sig binary, k1 long, k2 long, side int")
    least = [F.min(F.when(F.col("side") == k, F.col("sig"))).alias(name) for k, name in ((0, "same"), (1, "smaller"), (-1, "larger"))]
    hubs = rows.groupBy("k1", "k2").agg(*least, F.count("*").alias("m")).filter("m > 1").drop("m")
    other = F.when(F.col("side") == 0, F.col("same")).when(F.col("side") == 1, F.col("larger")).otherwise(F.col("smaller"))
    return rows.join(hubs, ["k1", "k2"]).select(F.col("sig").alias("a"), other.alias("b")).filter("a != b").distinct()


def _prefix(n: Column, percent: int) -> Column:
    """Shingles of a set of which a linked set must share one."""
    return n - F.ceil(n * percent / F.lit(100)).cast("long") + 1


def inverted(sets: DataFrame, percent: int) -> DataFrame:
    """(sig, n, alone, at, shingle): the inverted lists, one row for each shingle in a set's prefix that others hold.

    A set's shingles are ordered rarest first; ``alone`` of them no other set holds, ``at`` come before this one.
    """
    spread = sets.select("sig", "n", F.explode("shingles").alias("shingle"))
    common = spread.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    shared = spread.join(common, "shingle").groupBy("sig", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("ordered"))
    # Shingles that no other set holds come first; they are counted, not listed.
    alone = F.col("n") - F.size("ordered")
    room = F.greatest(F.lit(0), _prefix(F.col("n"), percent) - alone).cast("int")
    listed = shared.select("sig", "n", alone.alias("alone"), F.posexplode(F.slice("ordered", F.lit(1), room)).alias("k", "s"))
    return listed.select("sig", "n", "alone", (F.col("alone") + F.col("k")).alias("at"), F.col("s.shingle").alias("shingle"))


def _fits(percent: int, limit: int) -> Column:
    """Length and positional filters on a pair (na, pa), (nb, pb) of which one set at least is heavy."""
    need = overlap(F.col("na"), F.col("nb"), percent)
    fits = (F.greatest("na", "nb") > limit) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return fits & (F.col("na") - F.col("pa") >= need) & (F.col("nb") - F.col("pb") >= need)


def hub_pairs(lists: DataFrame, percent: int, limit: int) -> DataFrame:
    """(a, b, na, nb): each set with the set of each of its lists that has the fewest shingles alone."""
    hubs = lists.groupBy("shingle").agg(F.min(F.struct("alone", "sig", "n", "at")).alias("h"))
    pairs = lists.join(hubs, "shingle").select(
        F.col("sig").alias("a"), F.col("h.sig").alias("b"), F.col("n").alias("na"), F.col("h.n").alias("nb"), F.col("at").alias("pa"), F.col("h.at").alias("pb")
    )
    return pairs.filter((F.col("a") != F.col("b")) & _fits(percent, limit)).select("a", "b", "na", "nb").distinct()


def cross_pairs(lists: DataFrame, found: DataFrame, percent: int, limit: int) -> DataFrame:
    """(a, b, na, nb): pairs within a list of sets that are in no common component yet."""
    tagged = lists.join(found, "sig", "left").select("shingle", "sig", "n", "at", F.coalesce("root", "sig").alias("root"))
    mixed = tagged.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("shingle")
    tagged = tagged.join(mixed, "shingle", "left_semi")
    a = tagged.select("shingle", F.col("sig").alias("a"), F.col("n").alias("na"), F.col("at").alias("pa"), F.col("root").alias("ra"))
    b = tagged.select(F.col("shingle").alias("other"), F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("at").alias("pb"), F.col("root").alias("rb"))
    meet = (F.col("shingle") == F.col("other")) & (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))
    return a.join(b, meet & _fits(percent, limit)).select("a", "b", "na", "nb").distinct()


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the threshold."""
    left = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared >= overlap(F.col("na"), F.col("nb"), percent)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(sig, root): the smallest node of each node's component, by alternating large and small stars."""
    edges = written(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), F.least("a", "low").alias("low"))
        large = both.join(low, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "u")
        small = large.join(low, F.col("a") == F.col("u"))
        moved = small.select(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b"))
        edges = written(moved.unionByName(low.select(F.col("u").alias("a"), F.col("low").alias("b"))).filter("a != b").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("sig"), F.col("b").alias("root"))


def join(docs: DataFrame, gram: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_key) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    # A power of two, so that signed and unsigned remainders agree; 2.5 times as many shingles as a prefix has.
    share = 1 << max(0, int(math.log2(40 / max(1, 100 - percent))))
    slim = docs.select("doc_id", "text")
    columns = f"doc_id {kind}, n long, sig binary, shingles array<long>"
    table = written(slim.mapInArrow(_sets(gram, share, False), columns), "sets")
    filled = table.filter("n > 0")
    classes = written(filled.groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first(F.when(F.col("n") <= SMALL, F.col("shingles"))).alias("shingles")), "classes")
    sizes = {r[0]: r[1] for r in classes.filter(F.col("n") <= 2 * SMALL).groupBy("n").count().collect()}  # a row per size
    limit = boundary(sizes, percent, share)
    zone = -(-percent * (limit + 1) // 100)
    light = light_links(classes.filter(F.col("n") <= limit), percent)

    # Shingles of the counted share that one class alone holds. Two classes with the same first 64 bits of
    # their signature would have to share most shingles to matter here.
    mark = F.xxhash64("sig")
    counted = filled.filter(F.col("n") >= zone).select(mark.alias("mark"), F.explode("shingles").alias("shingle")).filter(F.pmod("shingle", F.lit(share)) == 0)
    single = counted.groupBy("shingle").agg(F.min("mark").alias("mark"), F.max("mark").alias("other")).filter("mark = other")
    alone = single.groupBy("mark").agg(F.count("*").alias("alone"))
    open_ = classes.filter(F.col("n") >= zone).withColumn("mark", mark).join(alone, "mark", "left").filter(F.coalesce("alone", F.lit(0)) < _prefix(F.col("n"), percent))
    chosen = written(open_.select(F.col("doc_id").alias("rep")).distinct(), "open")
    texts = slim.join(chosen, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    full = texts.mapInArrow(_sets(gram, share, True), columns)
    sets = written(full.filter("n > 0").dropDuplicates(["sig"]).select("sig", "n", "shingles"), "open-sets")

    lists = written(inverted(sets, percent), "lists")
    links = written(linked(hub_pairs(lists, percent, limit), sets, percent).unionByName(light), "links")
    found = components(links)
    more = written(linked(cross_pairs(lists, found, percent, limit), sets, percent), "more")
    found = components(more.unionByName(found.select(F.col("sig").alias("a"), F.col("root").alias("b"))))

    root = F.coalesce("root", "sig")
    rooted = classes.select("sig", "doc_id").join(found, "sig", "left").select("sig", "doc_id", root.alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least, "root").select("sig", "component_id")
    keyed = table.select("doc_id", "n", "sig")
    return keyed.join(named, "sig", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, gram: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that have the smallest doc_id of their component, all columns unchanged; of rows that
    repeat a doc_id, those all stay or go together."""
    gone = join(docs, gram, percent).filter("doc_id != component_id").select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("_gone_id"), "left_anti")
