"""Katz backoff language model: Good-Turing discounted counts with exactly normalised backoff weights.

P(w | h) = d(r) r / c(h) for a bigram seen r > 0 times, else alpha(h) P(w); P(w) = d(c) c / N for a known word, and the
mass that discounting leaves is the unknown word's. alpha(h) = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w) over
seen w), so each history's probabilities sum to one. Where counts above the discounting limit leave nothing over, the
history's total grows by one. A token's probability is evaluated from its bigram down to its word.

How the data move. Texts are read once, in chunks of some MB: a chunk's tokens are numbered by a dictionary of its own
and stored. A chunk sends its distinct words (hashes, training counts), dealt by hash into buckets; a bucket adds up what
all chunks sent (the stored table of unigrams) and answers with word numbers. Words are numbered by falling count, so a
count follows from a number by the list of distinct counts, of which there are at most sqrt(2 N); that list is what is
broadcast. Then chunks send their distinct bigrams, packed to about three bytes each, dealt by history; a history with
over 1/512 of all tokens is dealt by the whole bigram and its sums are added up on the driver (at most 512 of them).
Buckets answer with counts and weights, and chunks add up their tokens. No row is sent for a single token.

Words are told apart by XXH64; two of 10^7 different words share a value with a chance of about 10^-5.

Defined results: a null text is the empty text and scores its end token; a null doc_id counts as an empty string for the
split; keys come back as they were (they travel as text: any type that a cast to string and back keeps); without training texts each token is the unknown word with probability one; repeated rows count and stay; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blobs import pack, pack_sorted, slices, unpack, unpack_sorted
from .common import stored, table

CHUNK_BYTES, WORDS_A_BUCKET, BIGRAMS_A_BUCKET, HOT_SHARE = 8_000_000, 1_000_000, 1_500_000, 512
#: Counts up to this are discounted.
LIMIT = 5
END = b"\n"  # no word holds white space


def _mix(a: np.ndarray) -> np.ndarray:
    a = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a ^= a >> np.uint64(31)
    return a * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def code(docs: DataFrame, key: str, text: str, fold: int, folds: int) -> DataFrame:
    """The stored chunks: keys, held_out flags, lengths in tokens, words' hashes and training counts, token codes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n = TaskContext.get().partitionId(), itertools.count()
        names: defaultdict = defaultdict()
        keys, held, codes, lengths, size = [], [], [], [], 0

        def start() -> None:
            nonlocal names, keys, held, codes, lengths, size
            names = defaultdict(itertools.count().__next__)
            keys, held, codes, lengths, size = [], [], [], [], 0

        def chunk() -> pd.DataFrame:
            tokens = np.concatenate(codes)
            of_training = np.repeat(~np.array(held), lengths)
            order = np.argsort(-np.bincount(tokens, minlength=len(names)), kind="stable")  # frequent words get small codes
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))[order]
            tokens = place[tokens]
            tf = np.bincount(tokens[of_training], minlength=len(names)).astype(np.uint32)
            return pd.DataFrame({"chunk": [part << 32 | next(n)], "keys": [keys], "held": [held], "lengths": [lengths], "n_words": [len(names)], "hashes": [pack(hashes)], "tf": [pack(tf)], "codes": [pack(tokens)]})

        start()
        for b in batches:
            for name, t in zip(b["_key"], b["_text"], strict=True):
                words = t.encode().lower().split() if t else []
                words.append(END)
                codes.append(np.fromiter(map(names.__getitem__, words), np.uint32, len(words)))
                keys.append(name)
                held.append(zlib.crc32((name or "").encode()) % folds == fold)
                lengths.append(len(words))
                size += len(t or "") + 8
                if size >= CHUNK_BYTES:
                    yield chunk()
                    start()
        if keys:
            yield chunk()

    rows = docs.selectExpr(f"cast(`{key}` AS string) AS _key", f"`{text}` AS _text")
    return stored(rows.mapInPandas(run, "chunk long, keys array<string>, held array<boolean>, lengths array<long>, n_words long, hashes binary, tf binary, codes binary"))


def _word_order(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes)
    return order, ((hashes[order] >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _merge(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Distinct keys, their summed counts, and for each row the (sorted) places of its keys."""
    keys = [unpack_sorted(b) for b in pdf["keys"]]
    uniq = np.unique(np.concatenate(keys))
    counts, places = np.zeros(len(uniq), np.int64), []
    for k, c in zip(keys, pdf["counts"], strict=True):
        at = np.searchsorted(uniq, k)
        counts[at] += unpack(c)
        places.append(pack_sorted(at.astype(np.int64)))
    return uniq, counts, places


MERGED = "bucket int, keys binary, counts binary, chunks array<long>, places array<binary>"


def _bucket_table(sent: DataFrame) -> DataFrame:
    """The stored table of one level: a row per bucket, with what to answer to which chunk."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        uniq, counts, places = _merge(pdf)
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "keys": [pack_sorted(uniq)], "counts": [pack(counts)], "chunks": [pdf["chunk"].tolist()], "places": [places]})

    return stored(sent.groupBy("bucket").applyInPandas(run, MERGED))


def unigrams(coded: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for chunk, h, tf in zip(b["chunk"], b["hashes"], b["tf"], strict=True):
                hashes, tf = unpack(h), unpack(tf)
                order, buckets = _word_order(hashes, n)
                yield pd.DataFrame([(k, chunk, pack_sorted(hashes[order[s]]), pack(tf[order[s]])) for k, s in slices(buckets)], columns=["bucket", "chunk", "keys", "counts"])

    return _bucket_table(coded.select("chunk", "hashes", "tf").mapInPandas(run, "bucket int, chunk long, keys binary, counts binary"))


def histogram(level: DataFrame) -> DataFrame:
    """bucket, c, n: how many keys of a bucket have the count c > 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for bucket, counts in zip(b["bucket"], b["counts"], strict=True):
                c, n = np.unique(unpack(counts), return_counts=True)
                yield pd.DataFrame({"bucket": np.full(len(c), bucket, np.int32), "c": c, "n": n})[c > 0]

    return level.select("bucket", "counts").mapInPandas(run, "bucket int, c long, n long")


def discounts(n: dict[int, int]) -> np.ndarray:
    """d(r) for r = 0 .. LIMIT + 1 (d(0) unused, the last is 1).

    Good-Turing with Katz's correction; where the counts of counts don't give 0 < d <= 1, absolute discounting of that r.
    """
    d, n1 = np.ones(LIMIT + 2), n.get(1, 0)
    absolute = n1 / (n1 + 2 * n.get(2, 0)) if n1 else 0.5
    a = (LIMIT + 1) * n.get(LIMIT + 1, 0) / n1 if n1 else 1.0
    for r in range(1, LIMIT + 1):
        turing = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - a) / (1 - a) if n.get(r) and a < 1 else 0.0
        d[r] = turing if 0 < turing <= 1 else (r - min(absolute, 0.999)) / r
    return d


@dataclass
class Model:
    """What every task knows: the counts of words by number, and the discounts."""

    counts: np.ndarray  # distinct counts, falling
    firsts: np.ndarray  # the first word number of each
    texts: int
    d1: np.ndarray
    d2: np.ndarray = field(default_factory=lambda: np.ones(LIMIT + 2))
    scale: float = 1.0
    p_unknown: float = 1.0

    words: int = 0
    tokens: int = 0

    @classmethod
    def of(cls, hist: list[tuple[int, int]], texts: int) -> Model:
        hist = sorted(hist, reverse=True)
        c, n = np.array([x[0] for x in hist], np.int64), np.array([x[1] for x in hist], np.int64)
        m = cls(c, np.concatenate([[0], np.cumsum(n)])[:-1].astype(np.int64), texts, discounts(dict(hist)))
        m.words, m.tokens = int(n.sum()), int((c * n).sum())
        if m.tokens:
            left = 1 - float((n * m.d1[np.minimum(c, LIMIT + 1)] * c).sum()) / m.tokens
            if left < 1e-12:
                m.scale = m.tokens / (m.tokens + 1)
            m.p_unknown = 1 - float((n * m.p_of_count(c)).sum())
        return m

    @property
    def unknown(self) -> int:
        return self.words

    @property
    def begin(self) -> int:
        return self.words + 1

    def count(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        real = ids < self.words
        out[real] = self.counts[np.searchsorted(self.firsts, ids[real], "right") - 1]
        out[ids == self.begin] = self.texts
        return out

    def p_of_count(self, c: np.ndarray) -> np.ndarray:
        return self.scale * self.d1[np.minimum(c, LIMIT + 1)] * c / max(self.tokens, 1)

    def p(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids == self.unknown, self.p_unknown, self.p_of_count(self.count(ids)))

    @property
    def hot(self) -> int:
        """A history of more tokens than this is dealt out by its bigrams."""
        return max(1 << 17, self.tokens // HOT_SHARE)


def number_words(level: DataFrame, hist: DataFrame, m: Model) -> DataFrame:
    """Answers (chunk, bucket, ids): numbers by falling count, then bucket, then hash; unknown words get m.unknown."""
    from pyspark.sql import Window

    run_before = F.sum("n").over(Window.partitionBy("c").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = hist.withColumn("before", F.coalesce(run_before, F.lit(0))).groupBy("bucket").agg(F.collect_list(F.struct("c", "before")).alias("offsets"))
    sent = level.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for b in batches:
            for bucket, counts, chunks, places, offs in zip(b["bucket"], b["counts"], b["chunks"], b["places"], b["offsets"], strict=True):
                c = unpack(counts)
                ids = np.full(len(c), m.unknown, np.int64)
                before = {int(x["c"]): int(x["before"]) for x in (offs if offs is not None else [])}
                order = np.argsort(c, kind="stable")
                for k, s in slices(c[order]):
                    if k:
                        first = m.firsts[len(m.counts) - 1 - np.searchsorted(m.counts[::-1], k)] + before[k]
                        ids[order[s]] = first + np.arange(s.stop - s.start)
                yield pd.DataFrame([(x, bucket, pack(ids[unpack_sorted(p)])) for x, p in zip(chunks, places, strict=True)], columns=["chunk", "bucket", "ids"])

    return level.select("bucket", "counts", "chunks", "places").join(offsets, "bucket", "left").mapInPandas(run, "chunk long, bucket int, ids binary")


def _ids_of_words(hashes: np.ndarray, answers: pd.DataFrame, n: int) -> np.ndarray:
    order, buckets = _word_order(hashes, n)
    ids = np.empty(len(hashes), np.int64)
    got = dict(zip(answers["bucket"], answers["a"], strict=True))
    for k, s in slices(buckets):
        ids[order[s]] = unpack(got[k])
    return ids


def _bigrams(ids: np.ndarray, lengths: np.ndarray, m: Model, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bigrams of a chunk in the order they are sent, their buckets, each token's place among them, the tokens."""
    before = np.concatenate([[m.begin], ids[:-1]])
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = m.begin
    pairs, place = np.unique(before << 32 | ids, return_inverse=True)
    h, w = pairs >> 32, pairs & 0xFFFFFFFF
    spread = m.count(h) > m.hot
    bucket = (_mix(np.where(spread, h * 1_000_003 + w + 1, h)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    at = np.empty(len(order), np.int64)
    at[order] = np.arange(len(order))
    return pairs[order], bucket[order], at[place], before


def _joined(coded: DataFrame, *answers: tuple[int, DataFrame]) -> DataFrame:
    """Chunks and the answers to them in one table, to be grouped by chunk."""
    cols = ["keys", "held", "lengths", "hashes", "codes"]
    out = coded.select("chunk", F.lit(0).alias("level"), F.lit(-1).alias("bucket"), *cols, F.lit(None).cast("binary").alias("a"), F.lit(None).cast("binary").alias("b"))
    for level, x in answers:
        b = F.col("weights") if "weights" in x.columns else F.lit(None).cast("binary")
        out = out.unionByName(x.select("chunk", F.lit(level).alias("level"), "bucket", F.col("ids" if level == 1 else "counts").alias("a"), b.alias("b")), allowMissingColumns=True)
    return out


def bigrams(coded: DataFrame, words: DataFrame, m: Model, n1: int, n2: int) -> DataFrame:
    sent = coded.sparkSession.sparkContext.broadcast(m)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m, own = sent.value, pdf[pdf["level"] == 0].iloc[0]
        ids = _ids_of_words(unpack(own["hashes"]), pdf[pdf["level"] == 1], n1)[unpack(own["codes"])]
        lengths = np.asarray(own["lengths"], np.int64)
        pairs, bucket, place, _ = _bigrams(ids, lengths, m, n2)
        counts = np.bincount(place[np.repeat(~np.asarray(own["held"], bool), lengths)], minlength=len(pairs)).astype(np.uint32)
        wanted = pairs >> 32 != m.unknown  # after an unknown word, the word's own probability holds
        pairs, bucket, counts = pairs[wanted], bucket[wanted], counts[wanted]
        return pd.DataFrame([(k, own["chunk"], pack_sorted(pairs[s]), pack(counts[s])) for k, s in slices(bucket)], columns=["bucket", "chunk", "keys", "counts"])

    sends = _joined(coded, (1, words)).groupBy("chunk").applyInPandas(run, "bucket int, chunk long, keys binary, counts binary")
    return _bucket_table(sends)


def _sums(pairs: np.ndarray, r: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Histories and, over what was seen after each, the sums of discounted counts and of the words' own probabilities."""
    seen = r > 0
    h, w, r = pairs[seen] >> 32, pairs[seen] & 0xFFFFFFFF, r[seen]
    if not len(h):
        return h, np.zeros(0), np.zeros(0)
    first = np.flatnonzero(np.diff(h, prepend=-1))
    return h[first], np.add.reduceat(m.d2[np.minimum(r, LIMIT + 1)] * r, first), np.add.reduceat(m.p(w), first)


def _weights(mass: np.ndarray, lower: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the history's total, log10 alpha)."""
    full = total - mass < 1e-9 * total
    total = np.where(full, total + 1, total)
    return total, np.log10((total - mass) / total) - np.log10(np.maximum(1 - lower, 1e-300))


def hot_sums(level: DataFrame, m: Model) -> dict[int, tuple[float, float]]:
    """Sums of the histories that lie in several buckets: at most HOT_SHARE of them."""
    sent = level.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for b in batches:
            for keys, counts in zip(b["keys"], b["counts"], strict=True):
                h, mass, lower = _sums(unpack_sorted(keys), unpack(counts), m)
                hot = m.count(h) > m.hot
                yield pd.DataFrame({"h": h[hot], "mass": mass[hot], "lower": lower[hot]})

    rows = level.select("keys", "counts").mapInPandas(run, "h long, mass double, lower double")
    return {r["h"]: (r["mass"], r["lower"]) for r in rows.groupBy("h").agg(F.sum("mass").alias("mass"), F.sum("lower").alias("lower")).collect()}


def answers(level: DataFrame, m: Model, hot: dict[int, tuple[float, float]]) -> DataFrame:
    """(chunk, bucket, counts, weights): the counts of the bigrams a chunk asked for; log10 alpha and the total of each history."""
    sent = level.sparkSession.sparkContext.broadcast((m, hot))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, hot = sent.value
        hot_h = np.array(sorted(hot), np.int64)
        hot_mass, hot_lower = (np.array([hot[int(h)][i] for h in hot_h]) for i in (0, 1))
        for b in batches:
            for bucket, keys, counts, chunks, places in zip(b["bucket"], b["keys"], b["counts"], b["chunks"], b["places"], strict=True):
                pairs, r = unpack_sorted(keys), unpack(counts)
                h, mass, lower = _sums(pairs, r, m)
                split = np.isin(h, hot_h)
                if split.any():
                    at = np.searchsorted(hot_h, h[split])
                    mass[split], lower[split] = hot_mass[at], hot_lower[at]
                extra, alpha = _weights(mass, lower, m.count(h).astype(float))
                extra -= m.count(h)  # 1 where the total had to grow
                of = pairs >> 32
                if len(hot_h):  # a bucket may hold only unseen bigrams of a hot history
                    lost = np.setdiff1d(hot_h, h)
                    e2, a2 = _weights(*(np.array([hot[int(x)][i] for x in lost]) for i in (0, 1)), m.count(lost).astype(float))
                    h, extra, alpha = np.concatenate([h, lost]), np.concatenate([extra, e2 - m.count(lost)]), np.concatenate([alpha, a2])
                    o = np.argsort(h)
                    h, extra, alpha = h[o], extra[o], alpha[o]
                for chunk, p in zip(chunks, places, strict=True):
                    at = unpack_sorted(p)
                    mine, of_mine = r[at], of[at]
                    asked = of_mine[np.flatnonzero(np.diff(of_mine, prepend=-1))]  # once for each history
                    j = np.searchsorted(h, asked)
                    known = (j < len(h)) & (h[np.minimum(j, max(len(h) - 1, 0))] == asked) if len(h) else np.zeros(len(asked), bool)
                    j = j[known]
                    weights = np.zeros((2, len(asked)))
                    weights[0, known], weights[1, known] = alpha[j], extra[j]
                    yield pd.DataFrame({"chunk": [chunk], "bucket": [bucket], "counts": [pack(mine.astype(np.uint32))], "weights": [pack(weights.reshape(-1).astype("<f8"))]})

    return level.mapInPandas(run, "chunk long, bucket int, counts binary, weights binary")


def score_chunks(coded: DataFrame, words: DataFrame, seen: DataFrame, m: Model, n1: int, n2: int, key: str, kind: str) -> DataFrame:
    sent = coded.sparkSession.sparkContext.broadcast(m)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m, own = sent.value, pdf[pdf["level"] == 0].iloc[0]
        ids = _ids_of_words(unpack(own["hashes"]), pdf[pdf["level"] == 1], n1)[unpack(own["codes"])]
        lengths = np.asarray(own["lengths"], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        pairs, bucket, place, _ = _bigrams(ids, lengths, m, n2)
        h, w = pairs >> 32, pairs & 0xFFFFFFFF
        lower = np.log10(m.p(w))
        logp = lower.copy()  # what follows an unknown word
        replies = pdf[pdf["level"] == 2]
        got = {int(k): (unpack(a), unpack(x).reshape(2, -1)) for k, a, x in zip(replies["bucket"], replies["a"], replies["b"], strict=True)}
        asked = np.flatnonzero(h != m.unknown)
        for k, s in slices(bucket[asked]):
            at = asked[s]
            r, (alpha, extra) = got[k]
            first = np.flatnonzero(np.diff(h[at], prepend=-1))
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
            total = m.count(h[at]) + extra[of]
            with np.errstate(divide="ignore"):
                logp[at] = np.where(r > 0, np.log10(np.maximum(m.d2[np.minimum(r, LIMIT + 1)] * r, 1e-300) / np.maximum(total, 1)), alpha[of] + lower[at])
        c = m.count(ids)
        base = np.log10((c + 0.5) / (m.tokens + 0.5 * (m.words + 1)))
        add = lambda x: np.add.reduceat(x, starts)
        return pd.DataFrame({"_key": list(own["keys"]), "held_out": np.asarray(own["held"], bool), "n_tokens": lengths, "n_known": add((c > 0).astype(np.int64)), "train_tokens": m.tokens, "base_score": add(base), "score": add(logp[place])})

    out = "_key string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _joined(coded, (1, words), (2, seen)).groupBy("chunk").applyInPandas(run, out).withColumn("_key", F.col("_key").cast(kind)).withColumnRenamed("_key", key)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", fold: int = 1, folds: int = 5) -> DataFrame:
    """Scores every text by the model of those whose crc32(key as text) mod folds isn't fold."""
    coded = code(docs, key, text, fold, folds)
    training = F.size(F.filter("held", lambda x: ~x))
    total = coded.agg(F.sum("n_words"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.sum(training)).first()
    n1, n2 = (max(12, -(-int(x or 0) // size)) for x, size in ((total[0], WORDS_A_BUCKET), (total[1], BIGRAMS_A_BUCKET)))
    one = unigrams(coded, n1)
    hist = histogram(one)
    m = Model.of([(r["c"], r["n"]) for r in hist.groupBy("c").agg(F.sum("n").alias("n")).collect()], int(total[2] or 0))  # at most sqrt(2 N) rows
    words = stored(number_words(one, hist, m))
    two = bigrams(coded, words, m, n1, n2)
    m.d2 = discounts({r["c"]: r["n"] for r in histogram(two).filter(f"c <= {LIMIT + 1}").groupBy("c").agg(F.sum("n").alias("n")).collect()})
    return score_chunks(coded, words, answers(two, m, hot_sums(two, m)), m, n1, n2, key, dict(docs.dtypes)[key])


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
