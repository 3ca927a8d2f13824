"""Document fingerprints: a canonical exact digest.

The canonical form of a text is NFKC, case folded, with every white-space run folded to one blank and the ends
trimmed. Its digest is four XXH64 lanes with different seeds (256 bits, 64 hex digits). Documents with equal
digests form a bucket; the canonical bytes are compared inside a bucket, so that a group never rests on the hash alone.

Everything here is a DataFrame expression. Defined results: a null text is the empty text; texts that differ only in
case, composition or white space have one digest; repeated rows stay rows; keys are of any type that has an order, a null
key comes after all others; an empty table gives an empty result; columns beyond those named are carried by ``with_digest``
and ``with_next``, whose own columns have underscores before a taken name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free, stored, table, text_of

#: Seeds of the four lanes.
LANES = ("lane 0", "lane 1", "lane 2", "lane 3")
#: Rows a range of doc_ids is to hold, the most ranges (the driver keeps three values for each), and sampled keys for each.
RANGE_ROWS, MAX_RANGES, SAMPLED = 2_000, 20_000, 16
#: Keys of shared digests are broadcast up to this many rows, and joined by shuffling beyond.
BROADCAST_ROWS = 300_000


def _icu(klass: str, method: str, text: Column) -> Column:
    return F.call_function("java_method", F.lit(klass), F.lit(method), text, F.lit(True))


def canonical(text: Column) -> Column:
    """NFKC, full case folding, NFKC again, white-space runs to one blank, trimmed.

    A text of ASCII bytes only is its own NFKC and folds by lower(), so the Unicode tables are left out for it.
    """
    nfkc = lambda c: _icu("com.ibm.icu.text.Normalizer", "compose", c)
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        nfkc(_icu("com.ibm.icu.lang.UCharacter", "foldCase", nfkc(text)))
    )
    return F.trim(F.regexp_replace(folded, r"(?U)\s+", " "))


def wide_hash(text: Column) -> Column:
    """256 bits of XXH64 as 64 lowercase hex digits."""
    return F.concat(*[F.lpad(F.lower(F.hex(F.xxhash64(F.lit(lane), text))), 16, "0") for lane in LANES])


def with_digest(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    return docs.withColumn(free(into, docs.columns), wide_hash(canonical(text_of(F.col(text)))))


def duplicate_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", prints: DataFrame | None = None) -> DataFrame:
    """One row per document: key, fingerprint, group_id (the smallest key with the same canonical text), group_size.

    Digests are counted first. Only texts of a digest that two documents or more share are looked at again, and their
    canonical bytes compared: each distinct one is a group of its own, so even a hash collision would not join two texts.
    Copies collapse before the shuffle (partial aggregation), so a text that a third of all rows repeat moves once per
    input task. prints: key and fingerprint of the same documents, where they are already known.
    """
    if prints is None:
        prints = stored(docs.select(F.col(key).alias("k"), wide_hash(canonical(text_of(F.col(text)))).alias("h")))
    else:
        prints = prints.select(F.col(key).alias("k"), F.col("fingerprint").alias("h"))
    buckets = prints.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first"))
    shared = stored(buckets.filter("n > 1"))
    if shared.count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    asked = stored(prints.join(shared.select("h"), "h", "left_semi").select(F.col("k").alias("_k")).distinct())
    few = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    rows = docs.select(F.col(key).alias("k"), text_of(F.col(text)).alias("t")).join(few, F.col("k").eqNullSafe(F.col("_k")), "left_semi")
    rows = rows.select("k", canonical(F.col("t")).alias("c")).withColumn("h", wide_hash(F.col("c")))
    exact = stored(rows.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first")))
    collided = exact.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h")
    plain = prints.join(collided, "h", "left_anti").join(shared, "h", "left")
    plain = plain.select("k", "h", F.when(F.col("n").isNull(), F.col("k")).otherwise(F.col("first")).alias("first"), F.coalesce("n", F.lit(1)).alias("n"))
    split = rows.join(collided, "h", "left_semi").join(exact, ["h", "c"]).select("k", "h", "first", "n")
    return plain.unionByName(split).select(F.col("k").alias(key), F.col("h").alias("fingerprint"), F.col("first").alias("group_id"), F.col("n").alias("group_size"))


def _range(key: Column, cuts: list) -> Column:
    """How many of the rising cuts aren't above the key, by two searches of about sqrt(len(cuts)) steps."""
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    at = F.greatest(F.size(F.filter(F.lit(cuts[::step]), lambda x: x <= key)) - 1, F.lit(0)) * step
    return at + F.size(F.filter(F.slice(F.lit(cuts), at + 1, F.lit(step)), lambda x: x <= key))


def with_next(docs: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """docs with next_<c> for each c of carried: the value in the row that follows by descending key; the first follows the last.

    A global order without a global sort: the keys are cut at quantiles of a bounded sample into ranges, each row goes to
    its range, and the first row of a range also goes, as a guest, behind the last row of the range above. Rows with
    equal keys follow each other by their carried values; rows without a key come last.
    """
    names = docs.columns
    n = docs.count()
    ranges = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    some = docs.select(F.col(key).alias("k")).filter("k IS NOT NULL").orderBy(F.xxhash64("k"), "k").limit(SAMPLED * ranges) if ranges > 1 else None
    sample = sorted(r["k"] for r in some.collect()) if some is not None else []  # SAMPLED * MAX_RANGES keys at most
    cuts = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    own, to, guest, top = (free(x, names) for x in ("_range", "_to", "_guest", "_top"))
    rows = docs.withColumn(own, F.when(F.col(key).isNull(), F.lit(-1)).otherwise(_range(F.col(key), cuts)))
    heads = sorted((tuple(r) for r in rows.groupBy(own).agg(F.max(key).alias(top)).collect()), key=lambda r: -r[0])  # one row per range
    above = [(r[0], up[0], r[1]) for r, up in zip(heads, heads[-1:] + heads[:-1], strict=True)]
    kind = docs.schema[key].dataType.simpleString()
    tops = F.broadcast(docs.sparkSession.createDataFrame(above, f"{own} int, {to} int, {top} {kind}"))
    as_guest = F.array(F.lit(None).cast("int"), F.when(F.col(key).eqNullSafe(F.col(top)), F.col(to)))
    dealt = rows.join(tops, own).withColumn(guest, F.explode(F.array_distinct(as_guest)))
    order = Window.partitionBy(F.coalesce(guest, own)).orderBy(F.col(guest).isNotNull(), F.col(key).desc_nulls_last(), *[F.col(c) for c in carried])
    into = {c: free(f"next_{c}", names) for c in carried}
    out = dealt.select("*", *[F.lead(c).over(order).alias(x) for c, x in into.items()])
    return out.filter(F.col(guest).isNull()).select(*[F.col(f"`{c}`") for c in names], *into.values())


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and its edited text by the contract.

    Likeness is 1 where two digests are equal and the canonical bytes behind them too, else 0; group_id and group_size
    are those of ``duplicate_groups``.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    rows = with_next(with_digest(docs), "doc_id", ["text", "fingerprint"]).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumn("edited_fingerprint", wide_hash(canonical(F.col("edited"))))
    like = lambda other, text: F.when(F.col("fingerprint") == F.col(other), canonical(F.col("text")) == canonical(F.col(text))).otherwise(False).cast("double")
    rows = stored(rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        like("edited_fingerprint", "edited").alias("near_edited"), like("next_fingerprint", "next_text").alias("near_next"),
    ))
    groups = duplicate_groups(docs, prints=rows).filter("group_size > 1").select("fingerprint", "doc_id", "group_id", "group_size").distinct()
    joined = rows.alias("r").join(groups.alias("g"), (F.col("r.fingerprint") == F.col("g.fingerprint")) & F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")), "left")
    group = F.when(F.col("g.group_size").isNull(), F.col("r.doc_id")).otherwise(F.col("g.group_id"))
    return joined.select("r.*", group.alias("group_id"), F.coalesce("g.group_size", F.lit(1)).alias("group_size"))
