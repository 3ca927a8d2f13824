"""Token tagging: words, BIO tags, spans, strict scores, packing."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sections import islands

#: Words or single other marks.
TOKEN = re.compile(r"\w+|[^\w\s]")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
def tokenize(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: [{"pos": i, "word": m[0], "start": m.start(), "end": m.end()} for i, m in enumerate(TOKEN.finditer(t or ""))])


def word_tokens(text: Column) -> Column:
    """The words alone, JVM-side."""
    return F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"), F.lit(1))


def bio_tags(tokens: DataFrame, spans: DataFrame, seq: Sequence[str]) -> DataFrame:
    """tokens (seq, pos, word, start) with tag: of the first span (by span_idx) that holds the word's start."""
    t, s = tokens.alias("t"), spans.alias("s")
    on = (F.col("s.start") <= F.col("t.start")) & (F.col("t.start") < F.col("s.end"))
    for k in seq:
        on &= F.col(f"t.{k}") == F.col(f"s.{k}")
    met = t.join(s, on, "left").select("t.*", F.col("s.span_idx").alias("_s"), F.col("s.label").alias("_l"))
    first = met.withColumn("_k", F.row_number().over(Window.partitionBy(*seq, "pos").orderBy("_s"))).filter("_k = 1")
    w = Window.partitionBy(*seq).orderBy("pos")
    tag = F.when(F.col("_s").isNull(), "O").otherwise(F.concat(F.when(F.col("_s").eqNullSafe(F.lag("_s").over(w)), "I-").otherwise("B-"), F.col("_l")))
    return first.withColumn("tag", tag).drop("_s", "_l", "_k")


def spans_of(tokens: DataFrame, seq: Sequence[str], tag: str = "tag") -> DataFrame:
    """seq, start, end (exclusive), type: maximal runs; a stray I- opens one."""
    w = Window.partitionBy(*seq).orderBy("pos")
    rows = tokens.withColumn("type", F.substring(tag, 3, 1000)).withColumn("_p", F.lag(tag).over(w))
    starts = F.col("_p").isNull() | (F.col("_p") == "O") | F.col(tag).startswith("B-") | (F.substring("_p", 3, 1000) != F.col("type"))
    rows = rows.withColumn("_new", F.when((F.col(tag) != "O") & starts, 1).otherwise(0))
    runs = rows.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col(tag) != "O")
    return runs.groupBy(*seq, "_run", "type").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end")).drop("_run")


def entity_scores(gold: DataFrame, pred: DataFrame, seq: Sequence[str]) -> DataFrame:
    """type (or micro), precision, recall, f1, support: a span counts if both ends and the type agree."""
    key = [*seq, "start", "end", "type"]
    both = gold.select(*key, F.lit(1).alias("g")).join(pred.select(*key, F.lit(1).alias("p")), key, "full").na.fill(0, ["g", "p"])
    sums = both.groupingSets([["type"], []], "type").agg(F.sum(F.col("g") * F.col("p")).alias("hit"), F.sum("g").alias("support"), F.sum("p").alias("predicted"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = ratio(F.col("hit"), F.col("predicted")), ratio(F.col("hit"), F.col("support"))
    return sums.select(F.coalesce("type", F.lit("micro")).alias("type"), p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"), F.coalesce("support", F.lit(0)).alias("support"))


def label_list(spans: DataFrame) -> DataFrame:
    """label_id, label: O, then B- and I- of each type in order. Types are few: a dimension, not data."""
    types = spans.select("type").distinct()
    tags = types.select(F.explode(F.array(F.concat(F.lit("B-"), "type"), F.concat(F.lit("I-"), "type"))).alias("label"), "type")
    both = tags.unionByName(spans.sparkSession.createDataFrame([("O", "")], "label string, type string"))
    return both.select((F.row_number().over(Window.orderBy("type", "label")) - 1).alias("label_id"), "label")


def chunk_starts(pieces: Column, budget: int, prefix: int | Column) -> Column:
    """The first word (from 0) of each chunk, by an array of the words' numbers of pieces.

    Words fill a chunk of ``budget`` pieces, of which ``prefix`` are taken at its start; a word too long has its own chunk.
    """
    pre = F.lit(prefix) if isinstance(prefix, int) else prefix
    none = F.struct(F.lit(0).alias("at"), F.lit(budget + 1).alias("used"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, n: Column) -> Column:
        opens = acc["used"] + n > budget
        used = F.when(opens, pre + n).otherwise(acc["used"] + n).cast("int")
        return F.struct((acc["at"] + 1).alias("at"), used.alias("used"), F.when(opens, F.concat(acc["out"], F.array(acc["at"]))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(pieces, none, step, lambda acc: acc["out"])


def pad(ids: Column, length: Column, value: int = 0) -> Column:
    return F.slice(F.concat(ids, F.array_repeat(F.lit(value), F.greatest(length - F.size(ids), F.lit(0)))), F.lit(1), length)


def attention(ids: Column, length: Column) -> Column:
    return F.concat(F.array_repeat(F.lit(1), F.least(F.size(ids), length)), F.array_repeat(F.lit(0), F.greatest(length - F.size(ids), F.lit(0))))


def encode_chunk(pieces: Column, tags: Column, first: int, last: int, longest: int) -> Column:
    """input_ids, word_index, tags of a chunk: its words' piece ids (an array for each word) between two marks, cut to
    ``longest`` ids; words whose first piece is cut off lose their tag."""
    ids = F.concat(F.slice(F.concat(F.array(F.lit(first)), F.flatten(pieces)), 1, longest - 1), F.array(F.lit(last)))
    sizes = F.transform(pieces, F.size)
    starts = F.aggregate(sizes, F.array(F.lit(1)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    starts = F.filter(F.slice(starts, F.lit(1), F.size(pieces)), lambda i: i < longest - 1)
    return F.struct(ids.alias("input_ids"), starts.alias("word_index"), F.slice(tags, F.lit(1), F.size(starts)).alias("tags"))


__all__ = ["attention", "bio_tags", "chunk_starts", "encode_chunk", "entity_scores", "islands", "label_list", "pad", "spans_of", "tokenize", "word_tokens"]
