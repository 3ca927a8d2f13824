"""Line dedup by site-relative frequency.

Of each host, a line's ratio is the number of its pages that hold the line over the number of all its pages. Lines
whose ratio exceeds ``max_ratio`` are boilerplate of that host and go. A line must stand on two pages to be a repeated one;
no other count matters, so hosts of all sizes are judged alike.

Lines are compared without blanks around them, by two XXH64 values with different seeds (128 bits). Defined results:
a null text has no lines and stays null; blank lines always stay; a null host is a host of its own; a page counts once
for a line it repeats; repeated rows count as pages of their own; an empty table gives an empty result; other columns
pass through unchanged, whatever their names: counts are named n_lines and n_dropped, with underscores before a taken name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free, stored, table

MAX_RATIO, MIN_PAGES = 0.1, 2
#: Boilerplate is broadcast up to this many rows of three numbers; beyond, pages and boilerplate meet by host and one of SALTS.
BROADCAST_ROWS, SALTS = 100_000, 64


def _key(host: Column, line: Column) -> Column:
    h = F.coalesce(F.concat(F.lit("h"), host), F.lit(""))
    return F.struct(F.xxhash64(h, F.trim(line)).alias("a"), F.xxhash64(F.lit("b"), h, F.trim(line)).alias("b"))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO) -> DataFrame:
    """host and, for each host that has any, the keys of its boilerplate lines.

    Counts are summed before they are shuffled, so a line on every page of the largest host costs one row per task.
    A host has at most (mean lines of a page) / max_ratio such lines, which bounds each array.
    """
    h = F.col(host)
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: F.trim(x) != "")
    keys = docs.select(h.alias("host"), F.explode(F.array_distinct(F.transform(lines, lambda x: _key(h, x)))).alias("key"))
    counts = keys.groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= MIN_PAGES)
    totals = docs.groupBy(h.alias("host")).agg(F.count(F.lit(1)).alias("total"))
    high = counts.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    return high.filter(F.col("pages") > F.lit(max_ratio) * F.col("total")).groupBy("c.host").agg(F.collect_list("key").alias("keys"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, counts: bool = False) -> DataFrame:
    """docs with boilerplate lines cut from the text; with counts, also n_lines and n_dropped."""
    names = docs.columns
    of, keys, salt = (free(n, names) for n in ("_host", "_keys", "_salt"))
    found = stored(boilerplate(docs, host, text, max_ratio)).select(F.col("host").alias(of), F.col("keys").alias(keys))
    rows = found.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(keys)).alias("k")).first()
    same = F.col(host).eqNullSafe(F.col(of))
    if rows["n"] + (rows["k"] or 0) <= BROADCAST_ROWS:
        joined = docs.join(F.broadcast(found), same, "left")
    else:
        hashed = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
        salted = docs.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(SALTS)))
        number = free("_number", names)
        spread = found.withColumn(number, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(spread, same & (F.col(salt) == F.col(number)), "left").drop(number)
    split = F.split(F.col(text), "\n")
    bad = lambda x: F.coalesce(F.array_contains(F.col(keys), _key(F.col(host), x)), F.lit(False)) & (F.trim(x) != "")
    kept = F.filter(split, lambda x: ~bad(x))
    new = F.when(F.col(keys).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    if counts:
        dropped = F.when(F.col(keys).isNull() | F.col(text).isNull(), 0).otherwise(F.size(split) - F.size(kept)).cast("long")
        lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(split)).cast("long")
        joined = joined.withColumns({free("n_lines", names): lines, free("n_dropped", names): dropped})
    return joined.withColumn(text, new).drop(of, keys, salt)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, counts=True).select("doc_id", "n_lines", "n_dropped", "text")


OP3_SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
lines AS (SELECT r, source, u.i, u.line
  FROM docs, LATERAL (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i) u),
counts AS (SELECT source, trim(line) AS line, count(DISTINCT r) AS pages FROM lines WHERE trim(line) <> '' GROUP BY 1, 2),
totals AS (SELECT source, count(*) AS total FROM docs GROUP BY 1),
bad AS (SELECT c.source, c.line FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE pages >= {MIN_PAGES} AND pages > {MAX_RATIO}::DOUBLE * total),
marked AS (SELECT l.*, b.line IS NOT NULL AS dropped
  FROM lines l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line) = b.line),
kept AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '') AS text FROM marked GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, k.text
FROM docs d LEFT JOIN kept k USING (r)
"""  # noqa: S608
