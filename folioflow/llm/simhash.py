"""SimHash near-duplicates with pigeonring filtering.

A text's fingerprint has a bit set where more than half of its shingles' XXH64 values (seed 42) have it set. Two
fingerprints link at ``MAX_BITS`` = 3 or fewer differing bits; components of links are the groups.

Search. A fingerprint has four segments of 16 bits on a ring. If two differ in at most 3 bits, then there is a segment
from which every chain of l consecutive segments has at most 3 l / 4 differences: 0 in the first, at most 1 in two, at
most 2 in three (pigeonring principle). So distinct fingerprints meet by an equal segment, the chain conditions
prune, and only what is left has its full Hamming distance taken. A bucket of more than ``BUCKET`` fingerprints is cut
further by the next condition (the following segment with one bit masked, 16 keys), and what is still larger is
compared in blocks, each pair of blocks a task of its own. No pair is lost, and no group meets in one task.

Each bucket gives only a spanning forest of its links. Equal texts and equal fingerprints are one row throughout.

Defined results: a null or wordless text has fingerprint zero and links like any other; a text of fewer words than a
shingle is one shingle; a null doc_id is a document of its own row that can't name a component; repeated rows stay rows;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .components import components

SHINGLE, SEED, MAX_BITS, BUCKET, BLOCK = 3, 42, 3, 4096, 512


def shingle_hashes(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of n words, repeats included; A-Z lower-cased, words parted by ASCII white space."""
    ws = text.encode().lower().split() if text else []
    if not ws:
        return np.zeros(0, np.uint64)
    joined, k = b" ".join(ws), max(1, len(ws) - n + 1)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = np.concatenate([[0], ends[: k - 1]]).tolist()
    stops = (ends[min(n, len(ws)) - 1 :] - 1).tolist()
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, k)


def majority(hashes: np.ndarray) -> int:
    """A bit is set where more than half of the hashes have it set."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, n))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """key and fp, the fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(np.array([fingerprint(t, n) for t in b.tolist()], np.uint64).view(np.int64))

    return docs.select(key, run(F.col(text)).alias("fp"))


def chain_pairs(fps: np.ndarray, start: np.ndarray | int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of fingerprints that pass the chain conditions from ``start`` and then the full check."""
    parts = np.stack([(fps >> np.uint64(16 * ((start + s) % 4))) & np.uint64(0xFFFF) for s in range(4)]).astype(np.uint16)
    for a in range(0, len(fps), BLOCK):
        sums = np.zeros((len(fps[a : a + BLOCK]), len(fps) - a), np.uint8)
        for s in range(4):  # cumulative differences stay within s, as 3 (s + 1) / 4 rounds down to s
            sums += np.bitwise_count(parts[s, a : a + BLOCK, None] ^ parts[s, None, a:])
            if s == 0:
                alive = sums == 0
            else:
                alive &= sums <= s
        i, j = np.nonzero(np.triu(alive, 1))
        yield i + a, j + a


def _forest(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    parent = list(range(len(fps)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in chain_pairs(fps, start):
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            a, b = find(x), find(y)
            if a != b:
                parent[b] = a
                out.append((x, y))
    return out


def _small(fps: list[int], start: int) -> list[tuple[int, int]]:
    shift, out = 16 * start, []
    for j in range(1, len(fps)):
        for i in range(j):
            d = fps[i] ^ fps[j]
            if d.bit_count() <= MAX_BITS:
                d = (d >> shift | d << (64 - shift)) & 0xFFFFFFFFFFFFFFFF  # the ring, turned to the start
                if not d & 0xFFFF and (d & 0xFFFFFFFF).bit_count() <= 1 and (d & 0xFFFFFFFFFFFF).bit_count() <= 2:
                    out.append((i, j))
    return out


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (start, k, fp), all of a k together: the links of each k."""

    def links(start: int, fps: np.ndarray) -> list[tuple[int, int]]:
        fps = np.unique(fps)
        if len(fps) < 2:
            return []
        signed = fps.view(np.int64)
        pairs = _small(fps.tolist(), start) if len(fps) <= 8 else _forest(fps, start)
        return [(int(signed[i]), int(signed[j])) for i, j in pairs]

    held: tuple | None = None
    parts: list[np.ndarray] = []
    for b in batches:
        if not len(b):
            continue
        ks = b[["k", "start", "lo", "hi"]].to_numpy()
        fps, out = b["fp"].to_numpy().view(np.uint64), []
        cuts = [0, *(np.flatnonzero((ks[1:] != ks[:-1]).any(axis=1)) + 1).tolist(), len(b)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            if held != (k := tuple(ks[x].tolist())):
                if held is not None and parts:
                    out += links(held[1], np.concatenate(parts))
                held, parts = k, []
            parts.append(fps[x:y])
        yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    if held is not None:
        yield pd.DataFrame(links(held[1], np.concatenate(parts)), columns=["u", "v"], dtype="int64")


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) among distinct fingerprints (column fp) that connect whatever lies within MAX_BITS."""
    seg = lambda i: F.shiftrightunsigned("fp", (16 * (i % 4))).bitwiseAND(0xFFFF)
    starts = F.array(*[F.struct(F.lit(i).alias("start"), (seg(i) + F.lit(i << 16)).alias("k"), seg(i + 1).alias("next")) for i in range(4)])
    rows = distinct.select("fp", F.explode(starts).alias("x")).select("fp", "x.*")
    sized = lambda r: r.join(r.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "k")
    none = [F.lit(0).alias("lo"), F.lit(0).alias("hi")]
    first = stored(sized(rows))
    cold = first.filter(F.col("n") <= bucket).select("start", "k", "fp", *none)
    hot = first.filter(F.col("n") > bucket)
    masked = hot.select("start", "fp", F.explode(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda b: F.struct(b.alias("b"), F.col("next").bitwiseAND(F.lit(0xFFFF) - F.call_function("shiftleft", F.lit(1), b)).alias("m")))).alias("y"), "k")
    masked = masked.select("start", "fp", (F.lit(1 << 60) + F.col("k") * F.lit(1 << 20) + F.col("y.b") * F.lit(1 << 16) + F.col("y.m")).alias("k"))
    if hot.limit(1).count():
        second = stored(sized(masked))
        cold = cold.unionByName(second.filter(F.col("n") <= bucket).select("start", "k", "fp", *none))
        parts = F.ceil(F.col("n") / bucket).cast("int")
        own = F.pmod(F.xxhash64("fp"), parts).cast("int")
        large = second.filter(F.col("n") > bucket).withColumn("own", own).select("start", "k", "fp", "own", F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
        cold = cold.unionByName(large.select("start", "k", "fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")))
    dealt = cold.repartition("k", "lo", "hi").sortWithinPartitions("k", "lo", "hi", "fp")
    return dealt.mapInPandas(_verify, "u long, v long")


def groups(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """prints (key, fp) with component_id, the smallest key reachable."""
    distinct = stored(prints.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(links(distinct))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stored(fingerprints(table(spark, sf_dir, "documents")))
    return groups(prints).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
