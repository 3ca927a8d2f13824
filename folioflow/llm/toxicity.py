"""Toxicity by cumulative-link ordinal regression.

Severity has three grades: 0 for documents labelled clean, and 1 or 2 for those labelled toxic, of which the labels say
no more: 2 from the sample's median number of different telling words on. A document's features are the telling words it
holds. One weight vector serves both thresholds: P(grade <= k) = sigmoid(threshold_k - w.x). The result is the expected
severity, 0 to 2; a document is toxic from ``CUT`` on.

Telling words are those of the labelled sample that stand in at least ``MIN_DOCS`` of its documents, lean to the toxic
ones by ``MIN_LIFT`` or more, and whose 2 x 2 table has a chi-square of ``MIN_CHI2`` or more; the ``MAX_WORDS`` with
the highest chi-square are used. The fit sees at most ``SAMPLE`` labelled documents, those with the lowest hashes of
doc_id; scoring sees all documents and whole texts.

Defined results: a null text has no words; a label without a document, a null label or null doc_id among the labels is
left out; of several labels of a document the highest counts, and of several texts under one id the first in order; without
toxic labels every score is 0; repeated rows stay rows; an empty table gives an empty result; other columns pass through
``score`` unchanged, and its own are named with underscores before a taken name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, stored, table, text_of

SAMPLE, MIN_DOCS, MIN_LIFT, MIN_CHI2, MAX_WORDS, CUT = 10_000, 5, 3.0, 20.0, 2_000, 0.5
#: Separators of words: what is neither a letter nor a digit of ASCII nor beyond ASCII.
_BLANK = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
_TO_BLANK = {ord(c): " " for c in _BLANK} | {i: chr(i + 32) for i in range(65, 91)}


@dataclass
class Model:
    words: dict[str, float]
    thresholds: tuple[float, float]


def word_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(text, ascii_uppercase, ascii_lowercase), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1)))


def sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """doc_id, toxic and the word set of at most ``limit`` labelled documents; the chosen ids alone are broadcast."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # the join comes first, and the result is stored: words are taken of the sample only, and once
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "toxic").agg(F.min(text_of()).alias("text"))  # rows that share an id count once
    return stored(one.select("doc_id", "toxic", word_set(F.col("text")).alias("words")))


def telling_words(rows: DataFrame) -> list[str]:
    n = rows.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = float(n["t"] or 0), float((n["n"] or 0) - (n["t"] or 0))
    if not toxic or not clean:
        return []
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    c, d = toxic - a, clean - b
    chi2 = (toxic + clean) * (a * d - b * c) ** 2 / (F.greatest(a + b, F.lit(1.0)) * F.greatest(c + d, F.lit(1.0)) * toxic * clean)
    lift = (a + 0.5) / (toxic + 1) / ((b + 0.5) / (clean + 1))
    best = counts.filter(a + b >= MIN_DOCS).filter(lift >= MIN_LIFT).withColumn("chi2", chi2).filter(F.col("chi2") >= MIN_CHI2)
    return [r["word"] for r in best.orderBy(F.desc("chi2"), "word").limit(MAX_WORDS).collect()]


def fit_ordinal(features: list[tuple[int, ...]], grade: np.ndarray, k: int, rounds: int = 3000, rate: float = 0.05, ridge: float = 1e-5) -> tuple[np.ndarray, tuple[float, float]]:
    """Full-batch Adam on the cumulative logits; thresholds are t and t + exp(g), so they stay ordered.

    features: of each document the numbers of its words, of k. Documents alike in words and grade are one row.
    """
    alike = Counter(zip(features, grade.tolist(), strict=True))
    share = np.array(list(alike.values()), float) / max(1, len(grade))
    grade = np.array([g for _, g in alike])
    cols = np.array([c for f, _ in alike for c in f], np.int64)
    row = np.repeat(np.arange(len(alike)), [len(f) for f, _ in alike])
    p = np.concatenate([np.zeros(k), [1.0, 0.0]])
    m, v = np.zeros(k + 2), np.zeros(k + 2)
    y1, y2 = grade > 0, grade > 1
    for i in range(1, rounds + 1):
        z = np.bincount(row, p[cols], len(alike))
        t1, t2 = p[k], p[k] + np.exp(p[k + 1])
        s1, s2 = (1 / (1 + np.exp(np.clip(t - z, -50, 50))) for t in (t1, t2))  # P(grade > 0), P(grade > 1)
        lower, upper = np.where(y2, s2, np.where(y1, s1, 1.0)), np.where(y2, 0.0, np.where(y1, s2, s1))
        prob = np.maximum(lower - upper, 1e-12)
        dl, du = np.where(y1, lower * (1 - lower), 0.0) / prob * share, upper * (1 - upper) / prob * share
        d1 = np.where(~y1, -du, np.where(~y2, dl, 0.0)).sum()
        d2 = np.where(y2, dl, np.where(y1, -du, 0.0)).sum()
        g = np.concatenate([np.bincount(cols, (du - dl)[row], k) + ridge * p[:k], [d1 + d2, d2 * (t2 - t1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-9)
    return p[:k], (float(p[k]), float(p[k] + np.exp(p[k + 1])))


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    rows = sample(docs, labels, limit)
    words = telling_words(rows)
    if not words:
        return Model({}, (50.0, 51.0))
    place = {w: i for i, w in enumerate(words)}
    got = rows.select("doc_id", "toxic", F.array_intersect("words", F.lit(words)).alias("w")).orderBy("doc_id").collect()  # at most SAMPLE rows of MAX_WORDS words
    features = [tuple(sorted(place[w] for w in r["w"])) for r in got]
    toxic, hits = np.array([r["toxic"] for r in got]), np.array([len(f) for f in features])
    severe = max(2.0, float(np.median(hits[toxic == 1]))) if (toxic == 1).any() else 2.0
    w, thresholds = fit_ordinal(features, np.where(toxic == 1, np.where(hits >= severe, 2, 1), 0), len(words))
    return Model(dict(zip(words, map(float, w), strict=True)), thresholds)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with severity (expected), severity_grade (the likeliest) and toxic; one pass, no shuffle.

    Only the text goes to Python, and only three numbers come back.
    """
    weights, known, (t1, t2) = model.words, set(model.words), model.thresholds

    @F.pandas_udf("severity double, severity_grade int, toxic boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sums = np.array([sum(weights[w] for w in sorted(known.intersection(t.translate(_TO_BLANK).split(" ")))) if t else 0.0 for t in b.tolist()], float)
            s1, s2 = (1 / (1 + np.exp(np.clip(t - sums, -50, 50))) for t in (t1, t2))
            yield pd.DataFrame({"severity": s1 + s2, "severity_grade": np.argmax(np.stack([1 - s1, s1 - s2, s2]), axis=0).astype("int32"), "toxic": s1 + s2 >= CUT})

    scored, names = free("_scored", docs.columns), ("severity", "severity_grade", "toxic")
    got = docs.withColumn(scored, run(F.col(text)))
    return got.select(*docs.columns, *[F.col(f"{scored}.{c}").alias(free(c, docs.columns)) for c in names])


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).select("doc_id", "severity", "severity_grade", "toxic")
