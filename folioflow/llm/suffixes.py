"""Suffix-array dedup: bytes covered by a 50-byte string that also starts in a document with a smaller key.

Full suffix arrays of all texts would have to meet pairwise, so shards are cut by content. Every 50-byte window has a
minimizer: the leftmost of its 26-byte strings with the least hash. Equal windows have equal minimizers at equal places.

1. Texts are stored in chunks, bucketed by chunk number, with their minimizers. A chunk sends the sorted hashes of its
   minimizers; they are merged across chunks by binary search, and only those of two documents or more go on.
2. For each of these, a chunk sends the stretch of text that the windows owning it cover, each distinct stretch once
   with its smallest key. A shard is all stretches of some minimizers: its suffix array (Larsson and Sadakane's
   refinement by doubling, in numpy) and the common prefixes of neighbours (Kasai's, in the form that takes characters
   only where the preceding byte differs) give the groups of equal windows, and each group's smallest key goes back.
3. Chunks remove what is covered by windows whose smallest key is smaller than the document's.

A minimizer on more than ``HOT`` rows is dealt out by its single windows, so that no phrase fills a shard.

Matches are exact: hashes only choose where to look (and may look in vain), bytes decide. Defined results: a null text is
the empty text; a null key counts as the largest integer; documents with equal keys don't remove each other's bytes; texts
under 50 bytes stay; an empty table gives an empty result; other columns are not read. Keys are integers.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blobs import pack, pack_sorted, slices, unpack, unpack_sorted
from .common import gone_at_exit, stored, table, work_dir

LENGTH, GRAM, CHUNK_BYTES, ANCHORS_A_BUCKET, BYTES_A_SHARD, HOT = 50, 26, 2_500_000, 600_000, 3_000_000, 50_000
#: Bytes of a piece in which minimizers are sought: 1 << 24 at most. A text may be longer.
PIECE = 1 << 24
SEP, NONE = 0xFF, np.iinfo(np.int64).max  # no UTF-8 text holds this byte


# Suffix arrays


def words8(text: np.ndarray, order: str = "<") -> np.ndarray:
    """The eight bytes from each position on as a number, zeros behind the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray(len(text), f"{order}u8", padded, 0, (1,))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: sort by eight bytes, then double the sorted depth, touching only groups not yet settled."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    first = words8(text, ">").astype(np.uint64)
    sa = np.argsort(first)  # the order of ties doesn't matter: they are one group, to be refined
    head = np.flatnonzero(np.concatenate([[True], first[sa[1:]] != first[sa[:-1]]]))
    del first
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.repeat(head, np.diff(np.append(head, n)))
    depth = 8
    while True:
        sizes = np.diff(np.append(head, n))
        open_groups = np.repeat(sizes > 1, sizes)
        at = np.flatnonzero(open_groups)
        if not len(at):
            return sa
        s = sa[at]
        over = s + depth - n  # behind the end there is less than any byte, and a shorter suffix comes first
        nxt = np.where(over > 0, -over, rank[np.minimum(s + depth, n)]) + 2 * depth
        key = rank[s] * np.int64(n + 1 + 2 * depth) + nxt
        order = np.argsort(key)
        s, key = s[order], key[order]
        sa[at] = s
        new = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.zeros(n, bool)
        starts[head] = True
        starts[at[new]] = True
        head = np.flatnonzero(starts)
        rank[s] = at[np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))]
        depth *= 2


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """lcp[r]: how many bytes the suffixes sa[r - 1] and sa[r] share; lcp[0] is 0.

    By Kasai's inequality in text order: where the byte before a suffix equals the byte before its predecessor, the
    prefix is that of the position before less one; characters are compared at the other positions only.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    has = phi >= 0
    same = np.zeros(n, bool)
    same[1:] = has[1:] & (phi[1:] > 0) & (text[:-1] == text[np.maximum(phi[1:] - 1, 0)])
    ask = np.flatnonzero(has & ~same)
    value = np.zeros(n, np.int64)
    w, i, j, d = words8(text), ask, phi[ask], np.zeros(len(ask), np.int64)
    live = np.arange(len(ask))
    while len(live):
        a, b = i[live] + d[live], j[live] + d[live]
        room = n - np.maximum(a, b)
        inside = room > 0
        x = np.zeros(len(live), np.uint64)
        x[inside] = w[a[inside]] ^ w[b[inside]]
        # trailing zero bytes of the difference are equal bytes
        equal = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // 8)
        step = np.minimum(equal, np.maximum(room, 0))
        d[live] += step
        live = live[(step == 8)]
    value[ask] = d
    last = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    plcp = value[last] - (np.arange(n) - last)
    return np.maximum(plcp, 0)[sa]


def smallest_of_equal(stretches: list[bytes], keys: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each stretch and each window of ``length`` in it: the smallest key of any stretch that holds the window."""
    text = np.frombuffer(bytes([SEP]).join([*stretches, b""]), np.uint8)
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    sa = suffix_array(text)
    lcp = common_prefixes(text, sa)
    owner = np.repeat(keys, sizes + 1)
    inside = np.arange(len(text)) - np.repeat(begins, sizes + 1) <= np.repeat(sizes, sizes + 1) - length
    heads = np.flatnonzero(lcp < length)
    least = np.minimum.reduceat(np.where(inside, owner, NONE)[sa], heads)
    of = np.empty(len(text), np.int64)
    of[sa] = np.repeat(least, np.diff(np.append(heads, len(text))))
    return [of[b : b + s - length + 1] for b, s in zip(begins.tolist(), sizes.tolist(), strict=True)]


# Minimizers


def gram_hashes(w: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
    """Hashes of GRAM = 26 bytes from positions on, from the eight-byte words of a text padded by GRAM bytes."""
    def word(k: int) -> np.ndarray:
        return w[k : len(w) - GRAM + 8 + k] if isinstance(at, slice) else w[at + k]

    h = word(0) * np.uint64(0x9E3779B97F4A7C15)
    spare = np.empty_like(h)
    for k in (8, 16, GRAM - 8):
        h ^= np.right_shift(h, np.uint64(32), out=spare)
        h += word(k)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= np.right_shift(h, np.uint64(29), out=spare)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= np.right_shift(h, np.uint64(32), out=spare)
    return h


def minimizer_places(text: np.ndarray) -> np.ndarray:
    """The place of the minimizer of each window of the text, by pieces whose places fit in 24 bits."""
    found, step, total = [], PIECE - LENGTH + 1, len(text) - LENGTH + 1
    for a in range(0, total, step):
        count = min(step, total - a)
        v = gram_hashes(words8(text[a : a + count + LENGTH - 1]), slice(None))
        v &= ~np.uint64(0xFFFFFF)
        v |= np.arange(len(v), dtype=np.uint64)
        span, done = LENGTH - GRAM + 1, 1
        while done * 2 <= span:
            v = np.minimum(v[:-done], v[done:])
            done *= 2
        if span > done:
            v = np.minimum(v[: len(v) - (span - done)], v[span - done :])
        v = v[:count]
        v &= np.uint64(0xFFFFFF)
        v += np.uint64(a)
        found.append(v)
    return found[0] if len(found) == 1 else np.concatenate(found)


def minimizers(text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors in order: place of the minimizer, first window that owns it, number of such windows (one run)."""
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    windows = np.maximum(lengths - LENGTH + 1, 0)
    empty = np.zeros(0, np.int64)
    if not windows.sum():
        return empty, empty, empty
    v = minimizer_places(text)
    inside = np.zeros(len(v), bool)
    for b, n in zip(begins.tolist(), windows.tolist(), strict=True):
        inside[b : b + n] = True
    head = inside.copy()
    head[1:] &= (v[1:] != v[:-1]) | ~inside[:-1]
    first = np.flatnonzero(head)
    stop = np.flatnonzero(inside & np.concatenate([head[1:] | ~inside[1:], [True]])) + 1
    return v[first].astype(np.int64), first, stop - first


def _bucketed(df: DataFrame, n: int) -> DataFrame:
    """df stored in n buckets by chunk, so that grouping it by chunk moves nothing."""
    spark, name, path = df.sparkSession, f"folioflow_{uuid.uuid4().hex}", work_dir(df.sparkSession)
    df.write.option("path", path).option("compression", "uncompressed").bucketBy(n, "chunk").saveAsTable(name)
    gone_at_exit(spark, path)
    bucketed = spark.table(name)
    bucketed.schema  # resolved: its files and buckets are known, and the catalog can forget the name
    spark.sql(f"DROP TABLE {name}")
    return bucketed


def chunks(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), itertools.count()
        keys, nulls, texts, size = [], [], [], 0

        def chunk() -> pd.DataFrame:
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            data = bytes([SEP]).join([*texts, b""])
            place, first, count = minimizers(np.frombuffer(data, np.uint8), lengths)
            return pd.DataFrame({"chunk": [part << 32 | next(number)], "keys": [pack(np.array(keys, np.int64))], "nulls": [pack(np.array(nulls, np.bool_).view(np.uint8))], "lengths": [pack(lengths)], "data": [zstandard.compress(data, 5)], "place": [pack_sorted(place)], "first": [pack((place - first).astype(np.uint8))], "windows": [pack(count.astype(np.uint8))], "n_bytes": [len(data)], "n_anchors": [len(place)]})

        for b in batches:
            for k, null, t in zip(b["_key"].tolist(), b["_null"].tolist(), b["_text"].tolist(), strict=True):
                data = t.encode() if t else b""
                if texts and size + len(data) >= 1 << 24:
                    yield chunk()
                    keys, nulls, texts, size = [], [], [], 0
                keys.append(NONE if null else k)
                nulls.append(null)
                texts.append(data)
                size += len(data) + 1
                if size >= CHUNK_BYTES:
                    yield chunk()
                    keys, nulls, texts, size = [], [], [], 0
        if texts:
            yield chunk()

    rows = docs.selectExpr(f"coalesce(cast(`{key}` AS long), 0L) AS _key", f"`{key}` IS NULL AS _null", f"`{text}` AS _text")
    return _bucketed(rows.mapInPandas(run, "chunk long, keys binary, nulls binary, lengths binary, data binary, place binary, first binary, windows binary, n_bytes long, n_anchors long"), n)


class Chunk:
    def __init__(self, row: pd.Series):
        self.keys, self.lengths, self.nulls = unpack(row["keys"]), unpack(row["lengths"]), unpack(row["nulls"])
        self.data = zstandard.decompress(row["data"])
        self.place = unpack_sorted(row["place"])
        self.first = self.place - unpack(row["first"])
        self.windows = unpack(row["windows"]).astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]]).astype(np.int64)
        self.doc = np.searchsorted(self.begins, self.first, "right") - 1
        padded = np.concatenate([np.frombuffer(self.data, np.uint8), np.zeros(GRAM, np.uint8)])
        # mixed once more, as the least of several hashes isn't evenly spread, and buckets go by its upper bits
        h = gram_hashes(words8(padded), self.place) if len(self.place) else np.zeros(0, np.uint64)
        self.hashes = ((h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(12)
        self.uniq, self.inverse = np.unique(self.hashes, return_inverse=True)

    def buckets(self, n: int) -> np.ndarray:
        """The bucket of each distinct hash, rising with it: by its upper 32 of 52 bits, so that no product overflows for n under 2^32."""
        return ((self.uniq >> np.uint64(20)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)

    def documents(self) -> np.ndarray:
        """On how many documents each distinct hash stands."""
        pairs = np.unique(self.inverse * np.int64(len(self.keys)) + self.doc)
        return np.bincount(pairs // max(len(self.keys), 1), minlength=len(self.uniq)).astype(np.uint32)

    def stretches(self, flags: np.ndarray, n: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct stretches with smallest key and shard, in the order of shards; and of each piece: its stretch, first window, document."""
        flag = flags[self.inverse]
        go, hot = np.flatnonzero(flag == 1), np.flatnonzero(flag == 2)
        reps = self.windows[hot]
        one = np.repeat(self.first[hot] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum()) if len(hot) else np.zeros(0, np.int64)
        first = np.concatenate([self.first[go], one])
        count = np.concatenate([self.windows[go], np.ones(len(one), np.int64)])
        doc = np.concatenate([self.doc[go], np.repeat(self.doc[hot], reps)])
        # a single window is dealt by its own bytes: the hash of its start and end, spread by the first
        shard = np.concatenate([self.hashes[go], np.zeros(len(one), np.uint64)])
        if len(one):
            w = words8(np.frombuffer(self.data, np.uint8))
            mixed = np.zeros(len(one), np.uint64)
            for k in (0, 8, 16, 24, 32, 40, 42):
                mixed = (mixed ^ (mixed >> np.uint64(31)) ^ w[one + k]) * np.uint64(0xBF58476D1CE4E5B9)
            shard[len(go) :] = mixed >> np.uint64(12)
        data, seen = self.data, {}
        ids = np.fromiter((seen.setdefault(data[a:b], len(seen)) for a, b in zip(first.tolist(), (first + count + LENGTH - 1).tolist(), strict=True)), np.int64, len(first))
        least = np.full(len(seen), NONE, np.int64)
        np.minimum.at(least, ids, self.keys[doc])
        of = np.zeros(len(seen), np.int64)
        of[ids] = (((shard * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(n)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        texts = list(seen)
        return [texts[i] for i in order.tolist()], least[order], of[order], back[ids], np.stack([first, count, doc])


def shared_minimizers(coded: DataFrame, n: int) -> DataFrame:
    """The stored table of minimizers: per bucket, flags (0: of one document, 1: shared, 2: hot) for each chunk, and how many rows go on."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(len(b)):
                c = Chunk(b.iloc[i])
                docs = c.documents()
                yield pd.DataFrame([(k, int(b["chunk"].iloc[i]), pack_sorted(c.uniq[s]), pack(docs[s])) for k, s in slices(c.buckets(n))], columns=["bucket", "chunk", "hashes", "docs"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack_sorted(x) for x in pdf["hashes"]]
        uniq = np.unique(np.concatenate(lists))
        total, places = np.zeros(len(uniq), np.int64), []
        for own, docs in zip(lists, pdf["docs"], strict=True):
            places.append(np.searchsorted(uniq, own))
            total[places[-1]] += unpack(docs)
        flags = np.where(total > HOT, 2, total > 1).astype(np.uint8)
        going = [int(unpack(d)[flags[p] > 0].sum()) for p, d in zip(places, pdf["docs"], strict=True)]
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "flags": [pack(flags[p]) for p in places], "going": going})

    sends = coded.select(*COLUMNS).mapInPandas(send, "bucket int, chunk long, hashes binary, docs binary")
    return stored(sends.groupBy("bucket").applyInPandas(merge, "chunk long, bucket int, flags binary, going long"))


def _flags(chunk: Chunk, answers: pd.DataFrame, n: int) -> np.ndarray:
    got, flags = dict(zip(answers["bucket"], answers["flags"], strict=True)), np.zeros(len(chunk.uniq), np.uint8)
    for k, s in slices(chunk.buckets(n)):
        flags[s] = unpack(got[k])
    return flags


COLUMNS = ["chunk", "keys", "nulls", "lengths", "data", "place", "first", "windows"]


def shard_answers(coded: DataFrame, flags: DataFrame, n1: int, n2: int) -> DataFrame:
    """(chunk, shard, least): for each stretch a chunk sent to a shard, the smallest keys of its windows."""

    def send(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(left.iloc[0])
        texts, least, shard, _, _ = c.stretches(_flags(c, right, n1), n2)
        rows = []
        for k, s in slices(shard):
            part = texts[s]
            rows.append((k, int(left["chunk"].iloc[0]), pack(np.fromiter(map(len, part), np.uint8, len(part))), zstandard.compress(b"".join(part), 3), pack(least[s])))
        return pd.DataFrame(rows, columns=["shard", "chunk", "sizes", "texts", "keys"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        seen: dict[bytes, int] = {}
        ids, keys = [], []
        for sizes, texts in zip(pdf["sizes"], pdf["texts"], strict=True):
            ends = np.cumsum(unpack(sizes).astype(np.int64)).tolist()
            data = zstandard.decompress(texts)
            ids.append(np.fromiter((seen.setdefault(data[a:b], len(seen)) for a, b in zip([0, *ends[:-1]], ends, strict=True)), np.int64, len(ends)))
        least = np.full(len(seen), NONE, np.int64)
        for i, k in zip(ids, pdf["keys"], strict=True):
            np.minimum.at(least, i, unpack(k))
        keys = smallest_of_equal(list(seen), least)
        return pd.DataFrame({"chunk": pdf["chunk"], "shard": pdf["shard"], "least": [pack(np.concatenate([keys[i] for i in x.tolist()])) for x in ids]})

    sends = coded.select(*COLUMNS).groupBy("chunk").cogroup(flags.select("chunk", "bucket", "flags").groupBy("chunk")).applyInPandas(send, "shard int, chunk long, sizes binary, texts binary, keys binary")
    return stored(sends.groupBy("shard").applyInPandas(merge, "chunk long, shard int, least binary"))


def remove(coded: DataFrame, flags: DataFrame, found: DataFrame, n1: int, n2: int, key: str, kind: str, kept: bool) -> DataFrame:
    columns = ["_key", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if kept else [])]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(left.iloc[0])
        flags = _flags(c, right[right["level"] == 0], n1)
        texts, _, shard, ids, (first, count, doc) = c.stretches(flags, n2)
        delta = np.zeros(len(c.data) + 1, np.int32)
        if len(texts):
            sizes = np.fromiter(map(len, texts), np.int64, len(texts)) - LENGTH + 1
            starts, least = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.empty(int(sizes.sum()), np.int64)
            answers = right[right["level"] == 1]
            got = dict(zip(answers["bucket"], answers["flags"], strict=True))
            for k, s in slices(shard):
                least[starts[s.start] : starts[s.stop - 1] + sizes[s.stop - 1]] = unpack(got[k])
            inner = np.arange(int(count.sum())) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
            covered = least[np.repeat(starts[ids], count) + inner] < np.repeat(c.keys[doc], count)
            at = (np.repeat(first, count) + inner)[covered]
            delta += np.bincount(at, minlength=len(delta)).astype(np.int32) - np.bincount(at + LENGTH, minlength=len(delta)).astype(np.int32)
        gone = np.cumsum(delta[:-1]) > 0
        data, rows = np.frombuffer(c.data, np.uint8), []
        for k, null, b, n in zip(c.keys.tolist(), c.nulls.tolist(), c.begins.tolist(), c.lengths.tolist(), strict=True):
            g = gone[b : b + n]
            removed = int(g.sum())
            rest = data[b : b + n][~g].tobytes() if removed else c.data[b : b + n]
            spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()) if removed else 0
            rows.append((None if null else str(k), n, removed, spans, hashlib.sha256(rest).hexdigest(), *([rest] if kept else [])))
        return pd.DataFrame(rows, columns=columns)

    answers = flags.select("chunk", F.lit(0).alias("level"), "bucket", "flags").unionByName(found.select("chunk", F.lit(1).alias("level"), F.col("shard").alias("bucket"), F.col("least").alias("flags")))
    schema = "_key string, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept
    return coded.select(*COLUMNS).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, schema).withColumn("_key", F.col("_key").cast(kind)).withColumnRenamed("_key", key)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", kept: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 and, on request, the bytes that stay."""
    kind = dict(docs.dtypes)[key]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"keys are ordered as integers, and {key} is {kind}")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = chunks(docs, key, text, max(12, partitions))
    total = coded.agg(F.sum("n_anchors")).first()[0] or 0
    n1 = max(12, -(-int(total) // ANCHORS_A_BUCKET))
    flags = shared_minimizers(coded, n1)
    going = flags.agg(F.sum("going")).first()[0] or 0
    n2 = max(12, -(-int(going) * (LENGTH + GRAM // 2) // BYTES_A_SHARD))
    return remove(coded, flags, shard_answers(coded, flags, n1, n2), n1, n2, key, kind, kept)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))
