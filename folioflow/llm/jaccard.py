"""Near-duplicates for the pipeline: SimHash links first, then all that Jaccard similarity asks for.

Texts link when their sets of word shingles reach a Jaccard similarity of four fifths; components of links are groups.

First, the SimHash operator: fingerprints of the same shingles, linked by pigeonring filtering within its bit budget, and
each link then held against the sets. That joins most copies cheaply, but a pair at four fifths differs in about ten of 64
bits, far beyond a budget that segments can index, so SimHash alone would lose pairs (README). The rest is found by prefix
filtering. All shingles have one order. A set of a shingles that reaches four fifths with another holds four fifths of its
own in common with it, so the two share one of their first a // 5 + 1 shingles, and only those are dealt out. The order is
by hash, with the shingles that are common in a sample of the texts last; which these are changes how many candidates there
are, never the result. A pair goes on only if what stands at or behind the shared shingle is enough on both sides. Where half of a set isn't common, the first ``FEW`` of the prefix are enough: two such sets agree in
six tenths or more of what isn't common, so all of the first FEW differ with a chance of 0.4 ** FEW, about 2e-13.

A candidate's bottom-k sketches (the ``SKETCH`` least shingles) are compared before its whole sets: where two sets at four
fifths would show under ``SHOWN`` common ones among the SKETCH least of both with a chance of 1e-11, it goes. Sets smaller
than a sketch are their own sketch, so nothing is left to chance there, and little is left to compare. What remains has its whole sets compared.

Texts with equal sets are one row throughout. Sets that share their least shingles are compared with one of them before all
others, and where sets that share shingles are many, with a few leaders; then only sets of different components are, so
a large group isn't compared pair by pair.

Defined results: texts without words have equal (empty) sets; a text of fewer words than a shingle is one shingle.
Shingles are compared by XXH64, sets of equal texts by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import stored
from .components import components

#: One of SAMPLED texts is looked at for common shingles; on how many of those such a shingle stands, and the most that are
#: put last (a broadcast of 8 bytes each). The rate is the same at every size, so runs of other shingles don't grow.
SHINGLE, SAMPLED, COMMON, MOST = 5, 8, 4, 2_000_000
#: Pairs a row from which sets are first compared with leaders, the share of pairs that may be left for another round, and
#: the random orders by which a run's leaders are chosen.
WIDE, SHRINKS, ORDERS = 40, 0.7, 8
FEW, SKETCH, SHOWN = 32, 160, 88
#: Words of 64 bits for the marks of a set, which are compared inside the join.
MARKS = 8
_MARKS = [f"m{i}" for i in range(MARKS)]
#: Rows up to which the names of texts to be compared are broadcast, so that the other texts aren't moved.
BROADCAST_ROWS = 300_000


def shingle_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    return np.unique(simhash.shingle_hashes(text, n))


def prefix(own: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles in the order of all, which is by hash, common ones last; and the common ones."""
    late = np.zeros(len(own), bool)
    if len(common):
        late = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
    size = len(own) // 5 + 1
    if 2 * int(late.sum()) <= len(own):
        size = min(size, FEW)
    return np.concatenate([own[~late], own[late]])[:size], own[late]


def common_shingles(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """Sorted shingles that stand on COMMON texts or more of the sample, the most frequent MOST of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [shingle_set(t, n) for t in b["_text"].tolist()]
            yield pd.DataFrame({"h": np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)})

    some = docs.select(F.col(text).alias("_text")).filter(F.pmod(F.xxhash64("_text"), F.lit(SAMPLED)) == 0)
    counts = stored(some.mapInPandas(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON))
    if counts.count() > MOST:
        sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).toLocalIterator()
        left, least = MOST, COMMON
        for r in sizes:
            left -= r["k"]
            if left < 0:
                least = r["n"] + 1
                break
        counts = counts.filter(F.col("n") >= least)
    return np.sort(np.array([r["h"] for r in counts.select("h").toLocalIterator()], np.int64).view(np.uint64))


def marks(own: np.ndarray) -> np.ndarray:
    """MARKS words of 64 bits, in which each shingle sets one of all bits by its hash."""
    bits = np.zeros(64 * MARKS, np.uint8)
    bits[(own % np.uint64(64 * MARKS)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _digest(a: np.ndarray) -> bytes:
    return hashlib.blake2b(a.tobytes(), digest_size=16).digest()


def coded(docs: DataFrame, columns: list[str], text: str, n: int) -> DataFrame:
    """columns, digest of the set, its size, its fingerprint, its sketch and its prefix."""
    sent = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, text, n))

    @F.pandas_udf("digest binary, size long, fp long, marks array<long>, sketch binary, common binary, prefix array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hashes = [simhash.shingle_hashes(t, n) for t in b.tolist()]
            sets = [np.unique(h) for h in hashes]
            first = [prefix(s, sent.value) for s in sets]
            yield pd.DataFrame({
                "digest": [_digest(s) for s in sets],
                "size": [len(s) for s in sets],
                "fp": np.array([simhash.majority(h) for h in hashes], np.uint64).view(np.int64),
                "marks": [marks(s) for s in sets],
                "sketch": [(s[:SKETCH] >> np.uint64(32)).astype("<u4").tobytes() for s in sets],
                "common": [_digest(c)[:12] if 2 * len(c) > len(s) else None for s, (_, c) in zip(sets, first, strict=True)],
                "prefix": [p.view(np.int64) for p, _ in first],
            })

    return docs.select(*columns, run(F.col(text)).alias("_x")).select(*columns, "_x.*")


def _may_reach(a: str, b: str, ahead: Column | None = None) -> Column:
    """Whether sets may reach four fifths by size and marks (columns s, m0 .. with a suffix), and by what stands ahead of both.

    A mark that one set has and the other lacks is a shingle, at least, that isn't common.
    """
    col = lambda x, of: F.col(f"{x}{of}")
    lacks = lambda m, x, y: F.bit_count(col(m, x).bitwiseAND(F.bitwise_not(col(m, y))))
    left = lambda x, y: col("s", x) - sum((lacks(m, x, y) for m in _MARKS), F.lit(0))
    most = F.least(left(a, b), left(b, a), *([] if ahead is None else [ahead]))
    return (9 * most >= 4 * (col("s", a) + col("s", b))) & (5 * F.least(col("s", a), col("s", b)) >= 4 * F.greatest(col("s", a), col("s", b)))


def sketches_allow(x: bytes, y: bytes) -> bool:
    """Whether two sets may reach four fifths, by the least shingles of each (upper halves of their hashes)."""
    a, b = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
    both = np.sort(np.concatenate([a, b]), kind="stable")
    if len(a) < SKETCH and len(b) < SKETCH:  # both are whole
        return 9 * int((both[1:] == both[:-1]).sum()) >= 4 * len(both)
    once = np.concatenate([[True], both[1:] != both[:-1]])
    twice = np.concatenate([both[1:] == both[:-1], [False]])
    return int(twice[np.flatnonzero(once)[:SKETCH]].sum()) >= SHOWN


class Sets:
    """What is known of the distinct sets: a stored table (row, size, sketch), and the texts behind it."""

    def __init__(self, distinct: DataFrame, docs: DataFrame, row: str, text: str, n: int):
        self.distinct, self.docs, self.row, self.text, self.n = distinct, docs, row, text, n

    def similar(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (u, v) of rows whose sets reach four fifths."""
        n, row = self.n, self.row

        @F.pandas_udf("boolean")
        def may(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series([sketches_allow(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)], dtype=bool)

        @F.pandas_udf("boolean")
        def reach(a: pd.Series, b: pd.Series) -> pd.Series:
            out, last, own = [], None, None
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                if x is not last:
                    last, own = x, shingle_set(x, n)
                both = np.concatenate([own, shingle_set(y, n)])
                total = len(both)
                both.sort(kind="stable")
                out.append(9 * int((both[1:] == both[:-1]).sum()) >= 4 * total)
            return pd.Series(out, dtype=bool)

        def with_both(pairs: DataFrame, of: DataFrame, column: str) -> DataFrame:
            one, two = (of.select(F.col(row).alias(k), F.col(column).alias(x)) for k, x in (("u", "a"), ("v", "b")))
            return pairs.join(one, "u").join(two, "v")

        left = stored(with_both(pairs, self.distinct, "sketch").filter(may("a", "b")).select("u", "v"))
        named = stored(left.select(F.explode(F.array("u", "v")).alias(row)).distinct())
        few = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
        texts = stored(self.docs.select(row, self.text).join(few, row, "left_semi"))
        return stored(with_both(left, texts, self.text).filter(reach("a", "b")).select("u", "v"))


def by_fingerprint(sets: Sets) -> DataFrame:
    """Links among sets whose SimHash fingerprints are equal or linked: each with the least row of its fingerprint's group."""
    prints = sets.distinct.select(F.col(sets.row).alias("id"), "fp")
    roots = simhash.groups(prints, "id")
    return sets.similar(roots.filter("id <> component_id").select(F.col("component_id").alias("u"), F.col("id").alias("v")))


def by_sketch(sets: Sets, found: DataFrame) -> DataFrame:
    """Links of sets that share some of their least shingles, or, where they are mostly of common ones, share these: each
    with the least row of those that do."""
    starts = F.array(*[F.struct(F.lit(i).alias("i"), F.substring("sketch", 4 * i + 1, 12).alias("k")) for i in range(4)])
    starts = F.concat(starts, F.array(F.struct(F.lit(9).alias("i"), F.col("common").alias("k"))))
    whole = F.filter(starts, lambda x: (x["i"] == 0) | (F.octet_length(x["k"]) == 12))
    rows = sets.distinct.select(F.col(sets.row).alias("id"), F.explode(whole).alias("x")).select("id", "x.*")
    leads = rows.groupBy("i", "k").agg(F.min_by("id", F.xxhash64("id")).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    new = sets.similar(rows.join(leads, ["i", "k"]).filter("id <> lead").select(F.col("lead").alias("u"), F.col("id").alias("v")).distinct())
    return found.unionByName(new)


def _in_runs(shared: DataFrame, found: DataFrame, marked: DataFrame) -> tuple[DataFrame, float, float]:
    """Rows of runs (equal h) that hold several components, each with its root and whether it is of the run's largest
    component; the rows' number, and that of the pairs to be met: all of the others with the whole run."""
    roots = components(found).withColumnRenamed("node", "id")
    named = shared.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    sizes = named.groupBy("h", "root").agg(F.count(F.lit(1)).alias("n"))
    runs = sizes.groupBy("h").agg(F.sum("n").alias("n"), F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.count(F.lit(1)).alias("roots"))
    runs = stored(runs.filter("roots > 1"))
    total = runs.agg(F.sum("n").alias("rows"), F.sum(F.col("n").cast("double") * (F.col("n") - F.col("most"))).alias("pairs")).first()
    mixed = named.join(runs.select("h", "main"), "h").withColumn("other", F.col("root") != F.col("main")).drop("main")
    return stored(mixed.join(marked.drop("s"), "id")), total["rows"] or 0, total["pairs"] or 0


def links(sets: Sets, found: DataFrame) -> DataFrame:
    """Links among the distinct sets, with those found, that connect whatever is similar.

    While there are many pairs to be met, and joining components still makes them fewer, each row is held against a
    few leaders only; then all that is left are met.
    """
    rows = sets.distinct.select(F.col(sets.row).alias("id"), F.col("size").alias("s"), F.posexplode("prefix").alias("pos", "h"))
    marked = sets.distinct.select(F.col(sets.row).alias("id"), F.col("size").alias("s"), *[F.get("marks", F.lit(i)).alias(m) for i, m in enumerate(_MARKS)])
    shared = stored(rows.join(rows.groupBy("h").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("h"), "h"))
    now, n_rows, n_pairs = _in_runs(shared, found, marked)
    tried, before = 0, float("inf")
    while n_pairs > WIDE * n_rows and n_pairs < SHRINKS * before:
        tried, before = tried + 1, n_pairs
        of_lead = [F.col(c).alias(f"{c}2") for c in ("id", "root", "s")]  # no marks: they would be in every partial result
        # each order is the same in every run, so that rows alike get one leader by it
        firsts = [F.min(F.struct(F.xxhash64(F.lit(tried * ORDERS + i), "id").alias("x"), F.lit(i).alias("i"), *of_lead)) for i in range(ORDERS)]
        lead = now.groupBy("h").agg(F.array(*firsts).alias("leads"))
        met = now.select("h", "id", "root", "s").join(lead, "h").select("id", "root", "s", F.explode("leads").alias("l")).select("*", "l.*")
        met = met.filter((F.col("root") != F.col("root2")) & (5 * F.least("s", "s2") >= 4 * F.greatest("s", "s2")))
        # of a row's leaders by one order, the one that it shares the most first shingles with
        often = met.groupBy("id", "i", "id2").agg(F.count(F.lit(1)).alias("k"))
        one = often.groupBy("id", "i").agg(F.max_by("id2", F.struct("k", "id2")).alias("lead"))
        pairs = one.select(F.least("id", "lead").alias("id1"), F.greatest("id", "lead").alias("id2")).distinct()
        of = lambda k: marked.select(*[F.col(c).alias(f"{c}{k}") for c in ("id", "s", *_MARKS)])
        likely = pairs.join(of(1), "id1").join(of(2), "id2").filter(_may_reach("1", "2"))
        found = found.unionByName(sets.similar(likely.select(F.col("id1").alias("u"), F.col("id2").alias("v"))))
        now, n_rows, n_pairs = _in_runs(shared, found, marked)
    side = lambda k: [F.col(c).alias(f"{c}{k}") for c in ("id", "root", "s", *_MARKS, "pos")]
    a, b = now.filter("other").select("h", *side(1)), now.select("h", *side(2), "other")
    once = (F.col("id1") < F.col("id2")) | ~F.col("other")
    # all that two sets have in common stands at or behind their first common shingle
    ahead = 1 + F.least(F.col("s1") - 1 - F.col("pos1"), F.col("s2") - 1 - F.col("pos2"))
    met = a.join(b, "h").filter((F.col("root1") != F.col("root2")) & once & _may_reach("1", "2", ahead))
    return found.unionByName(sets.similar(met.select(F.least("id1", "id2").alias("u"), F.greatest("id1", "id2").alias("v")).distinct()))


def groups(docs: DataFrame, row: str, name: str, text: str = "text", n: int = SHINGLE) -> DataFrame:
    """row (a distinct number), name and component_id, the smallest name of the row's group."""
    every = stored(coded(docs, [row, name], text, n))
    least = stored(every.groupBy("digest").agg(F.min(row).alias(row), F.min(name).alias("least")))
    distinct = stored(every.select(row, "size", "fp", "marks", "sketch", "common", "prefix").join(least.select(row), row, "left_semi"))
    sets = Sets(distinct, docs, row, text, n)
    roots = components(links(sets, by_sketch(sets, by_fingerprint(sets))))
    named = stored(least.select("digest", "least", F.col(row).alias("node")).join(roots, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root")))
    first = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.select("digest", "root").join(first, "root").select("digest", "component_id")
    return every.select(row, name, "digest").join(labels, "digest").select(row, name, "component_id")
