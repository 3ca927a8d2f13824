"""Benchmark decontamination by a distributed positional inverted index.

The index is sharded by documents: each task takes whole texts, numbers their words one after another, with a gap between
documents, and writes the postings of all its terms, that is, their positions in the order of term and place, coded as
differences. The shards are a stored table. No shuffle builds it, and it serves any test set.

A window of a test set is looked up in each shard. Windows with a term that the shard lacks end at once, all of them in
one pass over the test set's words. Of the others, the rarest term's postings, shifted by its offset, are intersected with
those of the next rarest terms until none is left or all agree (``phrases``); or, for proximity, those places of the rarest
term stay that have every other term nearby (``nearby``).

The test set is sent to the tasks in blocks of at most ``BLOCK_WORDS`` words or so, so its size has no bound; an item
isn't split between blocks.

Words: A-Z lower-cased, then runs of characters that are neither ASCII controls, blanks nor ASCII punctuation. Windows:
``n`` consecutive words of an item; a shorter item, if not empty, is one window. Defined results: a null text has no
words; a null item_id counts as an empty string, and rows with one item_id are one item; repeated documents stay rows;
keys come back as they were (they travel as text: any type that a cast to string and back keeps); an empty table gives
an empty result, an empty test set no hits; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blobs import pack, unpack
from .common import free, stored, table

WINDOW, BLOCK_WORDS, SHARD_CHARS = 13, 1_000_000, 8_000_000
_TO_BLANK = bytes(0x20 if i < 0x30 or 0x3A <= i <= 0x60 and not 0x41 <= i <= 0x5A or 0x7B <= i <= 0x7F else i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_BLANK).split() if text else []


class Queries:
    """Items over a numbered vocabulary, as one array of words, and their windows as places in it."""

    def __init__(self, items: Iterable[tuple[str, str | None]], n: int | None = WINDOW):
        """n: words of a window; None: an item is one window."""
        numbers: dict[bytes, int] = {}
        parts, starts, sizes, owners, at = [], [], [], [], 0
        self.names: list[str] = []
        for item, text in items:
            ids = [numbers.setdefault(w, len(numbers)) for w in words(text)]
            own = min(n or len(ids), len(ids))
            for i in range(len(ids) - own + 1 if ids else 0):
                starts.append(at + i)
                sizes.append(own)
                owners.append(len(self.names))
            self.names.append(item)
            parts.append(np.array(ids, np.int32))
            at += len(ids)
        self.vocab = list(numbers)
        self.terms = np.concatenate([np.zeros(0, np.int32), *parts])
        self.starts, self.sizes, self.owners = (np.array(x, np.int64) for x in (starts, sizes, owners))

    def possible(self, present: np.ndarray) -> np.ndarray:
        """The windows whose terms are all present."""
        lacks = np.concatenate([[0], np.cumsum(~present[self.terms])]) if len(self.terms) else np.zeros(1, np.int64)
        return np.flatnonzero(lacks[self.starts + self.sizes] == lacks[self.starts])

    def window(self, i: int) -> tuple[int, ...]:
        return tuple(self.terms[self.starts[i] : self.starts[i] + self.sizes[i]].tolist())


class Shard:
    """Postings of a shard for the terms of some queries: term -> sorted positions, and where each document starts."""

    def __init__(self, starts: np.ndarray, postings: dict[int, np.ndarray]):
        self.starts, self.postings = starts, postings

    @classmethod
    def read(cls, row: tuple, queries: Queries) -> tuple[Shard, np.ndarray, np.ndarray]:
        """The shard, lengths of its documents, and which terms of the queries it has."""
        lengths, vocab, counts, places = row
        lengths = np.asarray(lengths, np.int64)
        starts = np.cumsum(np.concatenate([[0], lengths[:-1] + 1]))
        number = {w: i for i, w in enumerate(zstandard.decompress(vocab).split())}
        own = [number.get(w, -1) for w in queries.vocab]
        ends = np.cumsum(unpack(counts).astype(np.int64))
        at = unpack(places).astype(np.int64)
        postings = {}
        for t, i in enumerate(own):
            if i >= 0:
                a = int(ends[i - 1]) if i else 0
                postings[t] = np.cumsum(at[a : ends[i]])
        return cls(starts, postings), lengths, np.array(own, np.int64) >= 0

    def phrase(self, terms: tuple[int, ...]) -> np.ndarray:
        """Start positions of the exact phrase."""
        lists = self.postings
        if any(t not in lists for t in terms):
            return np.zeros(0, np.int64)
        order = sorted(range(len(terms)), key=lambda i: len(lists[terms[i]]))
        at = lists[terms[order[0]]] - order[0]
        for i in order[1:]:
            if not len(at):
                break
            of = lists[terms[i]]
            j = np.searchsorted(of, at + i)
            at = at[(j < len(of)) & (of[np.minimum(j, len(of) - 1)] == at + i)]
        return at

    def near(self, terms: tuple[int, ...], slop: int) -> np.ndarray:
        """Positions of the rarest term with every other term at most ``slop`` words away, on either side, in the same document."""
        if any(t not in self.postings for t in terms):
            return np.zeros(0, np.int64)
        rare = min(dict.fromkeys(terms), key=lambda t: len(self.postings[t]))
        at = self.postings[rare]
        for t in set(terms) - {rare}:
            of = self.postings[t]
            j = np.searchsorted(of, at)
            left, right = of[np.maximum(j - 1, 0)], of[np.minimum(j, len(of) - 1)]
            home = np.searchsorted(self.starts, at, "right")
            ok = np.zeros(len(at), bool)
            for x in (left, right):
                ok |= (np.abs(x - at) <= slop) & (np.searchsorted(self.starts, x, "right") == home)
            at = at[ok]
        return at


COLUMNS = ["keys", "lengths", "vocab", "counts", "places"]


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all terms: one row per shard, with its documents' keys and lengths, its terms, and their postings."""

    def shard(keys: list, coded: list[np.ndarray], lengths: list[int], names: dict[bytes, int]) -> pd.DataFrame:
        terms = np.concatenate(coded)
        at = np.arange(len(terms)) + np.repeat(np.arange(len(lengths)), lengths)  # with a gap behind each document
        at = at[np.argsort(terms, kind="stable")]
        counts = np.bincount(terms, minlength=len(names)).astype(np.uint32)
        gaps = np.diff(at, prepend=0)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)[: len(names)]
        gaps[first] = at[first]  # each term's first position is whole
        return pd.DataFrame({"keys": [keys], "lengths": [lengths], "vocab": [zstandard.compress(b" ".join(names), 3)], "counts": [pack(counts)], "places": [pack(gaps.astype(np.uint32))]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: defaultdict = defaultdict(itertools.count().__next__)
        keys, coded, lengths, size = [], [], [], 0
        for b in batches:
            for k, t in zip(b["_key"].tolist(), b["_text"].tolist(), strict=True):
                ws = words(t)
                keys.append(k)
                coded.append(np.fromiter(map(names.__getitem__, ws), np.int32, len(ws)))
                lengths.append(len(ws))
                size += len(t or "") + 8
                if size >= SHARD_CHARS:
                    yield shard(keys, coded, lengths, names)
                    keys, coded, lengths, size, names = [], [], [], 0, defaultdict(itertools.count().__next__)
        if keys:
            yield shard(keys, coded, lengths, names)

    rows = docs.selectExpr(f"cast(`{key}` AS string) AS _key", f"`{text}` AS _text")
    return stored(rows.mapInPandas(run, "keys array<string>, lengths array<long>, vocab binary, counts binary, places binary"))


def _shards(b: pd.DataFrame) -> Iterator[tuple]:
    return zip(b["keys"], zip(b["lengths"], b["vocab"], b["counts"], b["places"], strict=True), strict=True)


def hits(index: DataFrame, queries: Queries, kind: str, key: str = "doc_id") -> DataFrame:
    """Per document: key, n_words, the positions of words inside any window's occurrence, and the items of those windows."""
    sent = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = sent.value
        for b in batches:
            for keys, row in _shards(b):
                s, lengths, present = Shard.read(row, q)
                starts = s.starts
                delta, items = np.zeros(int(starts[-1] + lengths[-1]) + 2, np.int32), defaultdict(set)
                found: dict[tuple[int, ...], np.ndarray] = {}
                for i in q.possible(present).tolist():
                    w = q.window(i)
                    at = found.get(w)
                    if at is None:
                        at = found[w] = s.phrase(w)
                        np.add.at(delta, at, 1)
                        np.add.at(delta, at + len(w), -1)
                    for d in np.unique(np.searchsorted(starts, at, "right") - 1).tolist():
                        items[d].add(q.names[q.owners[i]])
                covered = np.flatnonzero(np.cumsum(delta[:-1]) > 0)
                home = np.searchsorted(starts, covered, "right") - 1
                cuts = np.flatnonzero(np.diff(home, prepend=-1)).tolist()
                by = {int(home[a]): (covered[a:z] - starts[home[a]]).tolist() for a, z in itertools.pairwise([*cuts, len(home)])}
                n = range(len(lengths))
                yield pd.DataFrame({"_key": list(keys), "n_words": lengths, "hit": [by.get(i, []) for i in n], "items": [sorted(items[i]) if i in items else [] for i in n]})

    out = index.select(*COLUMNS).mapInPandas(run, "_key string, n_words long, hit array<int>, items array<string>")
    return out.withColumn("_key", F.col("_key").cast(kind)).withColumnRenamed("_key", key)


def matches(index: DataFrame, queries: Queries, kind: str, key: str = "doc_id", slop: int | None = None) -> DataFrame:
    """key, item, position (from 0, in words): each start of an item's exact phrase; with ``slop``, instead each place of
    the item's rarest term in the shard (of equally rare ones, the first in the item) that has all its other terms at most
    ``slop`` words away in the same document."""
    sent = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = sent.value
        for b in batches:
            for keys, row in _shards(b):
                s, _, present = Shard.read(row, q)
                for i in q.possible(present).tolist():
                    at = s.phrase(q.window(i)) if slop is None else s.near(q.window(i), slop)
                    if len(at):
                        home = np.searchsorted(s.starts, at, "right") - 1
                        yield pd.DataFrame({"_key": [keys[d] for d in home.tolist()], "item": q.names[q.owners[i]], "position": at - s.starts[home]})

    out = index.select(*COLUMNS).mapInPandas(run, "_key string, item string, position long")
    return out.withColumn("_key", F.col("_key").cast(kind)).withColumnRenamed("_key", key)


def blocks(items: DataFrame, item: str = "item_id", text: str = "text", n: int | None = WINDOW) -> Iterator[Queries]:
    """The test set in blocks, streamed through the driver a block at a time."""
    block, size = [], 0
    for i, t in items.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.col(text)).toLocalIterator():
        block.append((i, t))
        size += len(t or "") // 4 + 1
        if size >= BLOCK_WORDS:
            yield Queries(block, n)
            block, size = [], 0
    if block:
        yield Queries(block, n)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", slop: int | None = None) -> DataFrame:
    """key, item, position: where whole items stand in documents, as exact phrases or, with ``slop``, as words near each other."""
    index, kind = build_index(docs, key, text), dict(docs.dtypes)[key]
    found = [matches(index, q, kind, key, slop) for q in blocks(items, item, text, None)]
    return _union(found or [matches(index, Queries([], None), kind, key, slop)])


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", n: int = WINDOW) -> DataFrame:
    """key, n_words, n_hit, n_items, items (sorted), contaminated: one row per document.

    The index is built once, keyed by row numbers of the stored keys. Each block of the test set gives a table of hits;
    with several blocks, hits are merged by row number.
    """
    kind, number = dict(docs.dtypes)[key], free("_number", docs.columns)
    first = next(queries := blocks(benchmark, n=n), None) or Queries([], n)
    second = next(queries, None)
    if second is None:
        parts = hits(build_index(docs, key, text), first, kind, key)
    else:
        source = stored(docs.select(key, text).withColumn(number, F.monotonically_increasing_id()))
        index = build_index(source, number, text)
        both = _union([stored(hits(index, q, "long", number)) for q in itertools.chain([first, second], queries)])
        lists = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("hit", "items")]
        merged = both.groupBy(number).agg(F.max("n_words").alias("n_words"), *lists)
        parts = merged.join(source.select(number, key), number).drop(number)
    n_hit = F.size("hit").cast("long")
    contaminated = ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated")
    return parts.select(key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", contaminated)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
