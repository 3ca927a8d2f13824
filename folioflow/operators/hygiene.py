"""Corpus hygiene: duplicates, names, splits, class statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T


def exact_duplicates(files: DataFrame) -> DataFrame:
    """hash, paths (natural order, the first is the keeper) of equal contents; only sizes that occur twice are hashed."""
    sizes = files.groupBy("length").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("length")
    hashed = files.join(sizes, "length", "left_semi").select("path", F.sha2("content", 256).alias("hash"))
    return _groups(hashed)


def _groups(hashed: DataFrame) -> DataFrame:
    keyed = hashed.groupBy("hash").agg(F.array_sort(F.collect_list(F.struct(T.natural_key(F.col("path")).alias("k"), "path"))).alias("p"), F.count(F.lit(1)).alias("n"))
    return keyed.filter("n > 1").select("hash", F.transform("p", lambda x: x["path"]).alias("paths"), "n")


def content_duplicates(texts: DataFrame, skip: DataFrame | None = None) -> DataFrame:
    """Groups of texts (path, text) equal but for case and white space; ``skip`` holds paths known as exact copies."""
    rows = texts if skip is None else texts.join(skip.select("path"), "path", "left_anti")
    return _groups(rows.select("path", T.content_hash(F.col("text")).alias("hash")).filter("hash IS NOT NULL"))


def empty_texts(texts: DataFrame) -> DataFrame:
    """Paths of texts of which nothing is left to compare."""
    return texts.filter(T.content_hash(F.col("text")).isNull()).select("path")


def number_rows(df: DataFrame, order: Sequence[Column], into: str = "n", buckets: int | None = None) -> DataFrame:
    """Numbers rows from 1 in a global order without one task: range-partitioned, with each partition's count added up.

    The number of ranges is given, so that both uses of the ranged rows are dealt alike whatever is coalesced at run time.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(buckets, *order).withColumn("_p", F.spark_partition_id())
    counts = ordered.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.withColumn("_b", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    return ordered.join(F.broadcast(before), "_p").withColumn(into, F.row_number().over(Window.partitionBy("_p").orderBy(*order)) + F.col("_b")).drop("_p", "_b")


def first_pages_of(pages: DataFrame, most: int) -> DataFrame:
    """Pages (doc, page from 0) before the limit of a document; the limit is the feature."""
    return pages.filter(F.col("page") < most)


def sample_rows(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows by the order of a seeded hash of the key, the same ones on every run; the number is the feature."""
    return rows.orderBy(hash_order(F.col(key).cast("string"), seed), key).limit(n)


def plan_renames(names: DataFrame, prefix: str, renumber: bool = False) -> DataFrame:
    """name and new_name: names not yet of the form <prefix>_<n> follow the highest n in natural order."""
    n = F.regexp_extract("name", rf"(?i)^{prefix}_(\d{{1,9}})$", 1)
    rows = names.withColumn("_n", F.when(n != "", n.cast("int")) if not renumber else F.lit(None).cast("int"))
    top = rows.agg(F.coalesce(F.max("_n"), F.lit(0)).alias("_top"))  # one row
    new = number_rows(rows.filter("_n IS NULL").withColumn("_k", T.natural_key(F.col("name"))), [F.col("_k"), F.col("name")], "_i")
    return new.crossJoin(F.broadcast(top)).select("name", F.format_string(f"{prefix}_%d", (F.col("_top") + F.col("_i")).cast("long")).alias("new_name"))


def hash_order(key: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)


def group_split(keys: DataFrame, key: str, seed: int, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """key, split: whole groups in hash order; train by rounding, at least one val from three groups on, rest test.

    An empty val borrows the last train group, so key may then stand twice. The rounding is half-even.
    """
    distinct = keys.select(key).distinct()
    n = distinct.agg(F.count(F.lit(1)).alias("_n"))  # one row
    ranked = number_rows(distinct.withColumn("_h", hash_order(F.col(key).cast("string"), seed)), [F.col("_h"), F.col(key)], "_i").crossJoin(F.broadcast(n))
    n_train = F.bround(F.col("_n") * train)
    n_val = F.when(F.col("_n") >= 3, F.greatest(F.lit(1), F.bround(F.col("_n") * val))).otherwise(0)
    split = F.when(F.col("_i") <= n_train, "train").when(F.col("_i") <= n_train + n_val, "val").otherwise("test")
    borrowed = ranked.filter((n_val == 0) & (F.col("_i") == F.least(n_train, F.col("_n")))).select(key, F.lit("val").alias("split"))
    return ranked.select(key, split.alias("split")).unionByName(borrowed)


def split_by_key(keys: DataFrame, key: str, seed: int, dev: float = 0.1, test: float = 0.1) -> DataFrame:
    """key, split: test first, then dev, both by half-even rounding; rest train."""
    distinct = keys.select(key).distinct()
    n = distinct.agg(F.count(F.lit(1)).alias("_n"))
    ranked = number_rows(distinct.withColumn("_h", hash_order(F.col(key).cast("string"), seed)), [F.col("_h"), F.col(key)], "_i").crossJoin(F.broadcast(n))
    n_test, n_dev = F.bround(F.col("_n") * test), F.bround(F.col("_n") * dev)
    return ranked.select(key, F.when(F.col("_i") <= n_test, "test").when(F.col("_i") <= n_test + n_dev, "dev").otherwise("train").alias("split"))


def leaks(assigned: DataFrame, key: str) -> DataFrame:
    """Keys in several splits; must be empty (a val group borrowed from train apart)."""
    return assigned.groupBy(key).agg(F.array_sort(F.collect_set("split")).alias("splits")).filter((F.size("splits") > 1) & (F.array_join("splits", ",") != "train,val"))


def class_stats(boxes: DataFrame, splits: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """class, a column of counts for each split, total; one row per class, also without boxes, and a TOTAL row."""
    spark = boxes.sparkSession
    classes = spark.createDataFrame([(i, c) for i, c in enumerate(K.CLASSES)], "class_id int, class string")
    counts = boxes.groupBy("class_id").agg(*[F.count_if(F.col("split") == s).alias(s) for s in splits], F.count(F.lit(1)).alias("total"))
    rows = F.broadcast(classes).join(counts, "class_id", "left").na.fill(0)
    sums = [F.sum(c).alias(c) for c in (*splits, "total")]
    return rows.rollup("class").agg(*sums).withColumn("class", F.coalesce("class", F.lit("TOTAL")))


def read_labels(lines: DataFrame) -> DataFrame:
    """class_id, cx, cy, w, h from lines of exactly five parts."""
    t = T.tokens(F.col("value"))
    ok = lines.withColumn("_t", t).filter(F.size("_t") == 5)
    return ok.select(*[c for c in lines.columns if c != "value"], F.get("_t", F.lit(0)).cast("int").alias("class_id"), *[F.get("_t", F.lit(i)).cast("double").alias(n) for i, n in enumerate(("cx", "cy", "w", "h"), 1)])
