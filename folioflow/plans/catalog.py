"""Queries over the test tables, one for each operator, and the same in DuckDB's SQL.

Domain relations (lines, boxes, tags, tasks) are derived from the tables by plain arithmetic that both engines share.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import fields as R
from ..functions import geometry as G
from ..functions import text as T
from ..operators import annotation as A
from ..operators import hygiene as H
from ..operators import layout as L
from ..operators import ner as N
from ..operators import sections as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Derived relations


def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, line_idx, page of ten lines, text; boxes a line high on a page of 1000."""
    rows = t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_idx", "text"))
    rows = rows.withColumn("page", (F.col("line_idx") / 10).cast("int")).withColumn("_y", F.col("line_idx") % 10 * 104)
    return rows.withColumn("bbox", G.box(F.lit(0), F.col("_y"), F.length("text"), F.col("_y") + 50)).drop("_y")


LINES = """lines AS (SELECT doc_id, i AS line_idx, i // 10 AS page, text, (i % 10 * 104)::DOUBLE AS y0, (i % 10 * 104 + 50)::DOUBLE AS y1
  FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, unnest(string_split(text, chr(10))) AS text FROM documents))"""
BOX_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """page (an order), idx, label, bbox, score, size, bold, width, height: words or regions of a page of 100 x 30."""
    li = t(spark, d, "lineitem")
    rows = li.withColumn("idx", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*BOX_ORDER)) - 1)
    x0, y0 = F.col("l_quantity"), F.round(F.col("l_discount") * 100)
    return rows.select(
        F.col("l_orderkey").alias("page"), F.col("idx").cast("long").alias("idx"), F.col("l_returnflag").alias("label"), F.col("l_linestatus").alias("source"),
        G.box(x0, y0, x0 + 5 + F.col("l_partkey") % 20, y0 + 3 + F.col("l_suppkey") % 7).alias("bbox"), (F.col("l_linenumber") / 8).alias("score"),
        (8 + F.col("l_partkey") % 5).cast("double").alias("size"), (F.col("l_suppkey") % 3 == 0).alias("bold"), F.lit(80).alias("width"), F.lit(24).alias("height"),
    )


BOXES = f"""boxes AS (SELECT l_orderkey AS page, idx, l_returnflag AS label, l_linestatus AS source, l_quantity AS x0, y AS y0, l_quantity + 5 + l_partkey % 20 AS x1, y + 3 + l_suppkey % 7 AS y1,
  l_linenumber / 8 AS score, (8 + l_partkey % 5)::DOUBLE AS size, l_suppkey % 3 = 0 AS bold
  FROM (SELECT *, round(l_discount * 100) AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(BOX_ORDER)}) - 1 AS idx FROM lineitem))"""


def regions_words(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The first three boxes of a page, grown, are its regions; the others are its words."""
    b = boxes(spark, d)
    grown = G.box(F.col("bbox.x0") - 6, F.col("bbox.y0") - 4, F.col("bbox.x1") + 6, F.col("bbox.y1") + 4)
    return b.filter("idx < 3").withColumn("bbox", grown), b.filter("idx >= 3").withColumnRenamed("idx", "word_idx")


REGIONS = """regions AS (SELECT page, idx, label, x0 - 6 AS x0, y0 - 4 AS y0, x1 + 6 AS x1, y1 + 4 AS y1 FROM boxes WHERE idx < 3),
words AS (SELECT *, idx AS word_idx FROM boxes WHERE idx >= 3),
pairs AS (SELECT w.page, w.word_idx, r.idx, greatest(0, least(w.x1, r.x1) - greatest(w.x0, r.x0)) * greatest(0, least(w.y1, r.y1) - greatest(w.y0, r.y0)) / ((w.x1 - w.x0) * (w.y1 - w.y0)) AS share, (r.x1 - r.x0) * (r.y1 - r.y0) AS area
  FROM words w JOIN regions r ON w.page = r.page),
near AS (SELECT *, max(share) OVER (PARTITION BY page, word_idx) AS best FROM pairs WHERE share >= 0.5),
assigned AS (SELECT page, word_idx, idx AS region_idx FROM near WHERE share >= best - 0.1 QUALIFY row_number() OVER (PARTITION BY page, word_idx ORDER BY area, idx) = 1)"""
TAG = "CASE event_id % 5 WHEN 0 THEN 'O' WHEN 1 THEN 'B-' || event_type WHEN 4 THEN 'O' ELSE 'I-' || event_type END"
PRED = "CASE WHEN value < 5 THEN 'O' ELSE " + TAG + " END"


def tagged(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1)
    return e.select(F.col("user_id").alias("seq"), F.col("pos").cast("long").alias("pos"), F.expr(TAG).alias("tag"), F.expr(PRED).alias("pred"))


TAGS = f"tags AS (SELECT user_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, {TAG} AS tag, {PRED} AS pred FROM events)"


def _spans(of: str, name: str) -> str:
    return f"""{name} AS (SELECT seq, min(pos) AS "start", max(pos) + 1 AS "end", type FROM (
  SELECT *, sum(CASE WHEN tag <> 'O' AND (prev IS NULL OR prev = 'O' OR tag LIKE 'B-%' OR prev[3:] <> type) THEN 1 ELSE 0 END) OVER (PARTITION BY seq ORDER BY pos) AS run FROM (
    SELECT seq, pos, {of} AS tag, {of}[3:] AS type, lag({of}) OVER (PARTITION BY seq ORDER BY pos) AS prev FROM tags)) WHERE tag <> 'O' GROUP BY seq, run, type)"""


# Text

_WS = r"[\s\p{Z}]+"
_CLEAN = f"translate(nfc_normalize(text), '{K.INVISIBLE}', '')"
for _a, _b in K.LIGATURES.items():
    _CLEAN = f"replace({_CLEAN}, '{_a}', '{_b}')"
_CLEAN = f"trim(regexp_replace({_CLEAN}, '{_WS}', ' ', 'g'))"
_CLEAN = f"trim(regexp_replace(regexp_replace({_CLEAN}, '^[{re.escape(K.BULLETS)}]+ *', '- '), '^[-–—] +', '- '))"


@query(f"WITH {LINES} SELECT doc_id, line_idx, {_CLEAN} AS text FROM lines")
def clean_line(spark, d):
    return doc_lines(spark, d).select("doc_id", "line_idx", T.clean_line(F.col("text")).alias("text"))


@query(r"SELECT doc_id, sha256(regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), chr(10)), '([\p{L}\p{N}_])-\n([a-zà-ỹ])', '\1\2', 'g')) AS text_sha256 FROM documents")
def join_lines(spark, d):
    return t(spark, d, "documents").select("doc_id", F.sha2(T.join_lines(F.split("text", "\n")), 256).alias("text_sha256"))


@query(rf"WITH {LINES} SELECT k, count(*) AS n FROM (SELECT trim(regexp_replace(lower(text), '\p{{Nd}}+', '#', 'g')) AS k FROM lines) GROUP BY k")
def margin_key(spark, d):
    return doc_lines(spark, d).groupBy(T.margin_key(F.col("text")).alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query(rf"WITH {LINES} SELECT count(*) AS n FROM lines WHERE regexp_matches(text, '(?i)^(page|trang)?\s*\d{{1,3}}\s*((/|of|trên|\|)\s*\d{{1,3}})?$')")
def page_number_lines(spark, d):
    return doc_lines(spark, d).filter(T.is_page_number(F.col("text"))).agg(F.count(F.lit(1)).alias("n"))


@query(rf"SELECT doc_id, length(s) >= 30 AND length(s) - length(regexp_replace(s, '[\x00-\x1F\x{{FFFD}}]', '', 'g')) < 0.1 * length(s) AS has_text FROM (SELECT doc_id, regexp_replace(text, '{_WS}', '', 'g') AS s FROM documents)")
def has_text_layer(spark, d):
    return t(spark, d, "documents").select("doc_id", T.has_text_layer(F.col("text")).alias("has_text"))


_FOLD = "trim(regexp_replace(lower(strip_accents(replace(replace(text, 'đ', 'd'), 'Đ', 'D'))), '[^a-z0-9]+', ' ', 'g'))"


@query(f"WITH {LINES} SELECT doc_id, line_idx, {_FOLD} AS folded FROM lines")
def fold_text(spark, d):
    return doc_lines(spark, d).select("doc_id", "line_idx", T.fold(F.col("text")).alias("folded"))


@query(f"WITH {LINES}, w AS (SELECT doc_id, line_idx, list_filter(regexp_split_to_array(text, '{_WS}'), lambda x: x <> '') AS k FROM lines) SELECT count(*) AS n FROM w WHERE len(k) > 2 AND 2 * len(list_filter(k, lambda x: length(x) <= 2)) > len(k)")
def letter_spaced(spark, d):
    return doc_lines(spark, d).filter(T.letter_spaced(F.col("text"))).agg(F.count(F.lit(1)).alias("n"))


_STEM = "CASE c_custkey % 3 WHEN 0 THEN 'CV_' || c_nationkey || '_page_' || c_custkey WHEN 1 THEN c_mktsegment || '-p' || c_custkey ELSE c_name END"


@query(rf"""SELECT c_custkey, CASE WHEN regexp_matches(s, '(?i)^cv[_ -]?\d+') THEN translate(lower(regexp_extract(s, '(?i)^(cv[_ -]?\d+)', 1)), ' -', '__')
WHEN regexp_matches(s, '(?i)^.*?[_ -](page|p)[_ -]?\d+$') THEN lower(regexp_extract(s, '(?i)^(.*?)[_ -](page|p)[_ -]?\d+$', 1)) ELSE lower(s) END AS doc,
coalesce(try_cast(regexp_extract(s, '(?i)(page|p)[_ -]?(\d{{1,9}})$', 2) AS INTEGER), 1) AS page FROM (SELECT c_custkey, {_STEM} AS s FROM customer)""")
def file_names(spark, d):
    s = F.expr(_STEM)
    return t(spark, d, "customer").select("c_custkey", T.group_of(s).alias("doc"), T.page_of(s).alias("page"))


@query("SELECT name, row_number() OVER (ORDER BY regexp_extract(name, '^[^0-9]*'), regexp_extract(name, '[0-9]+')::BIGINT) AS n FROM (SELECT DISTINCT p_brand AS name FROM part)")
def natural_sort(spark, d):
    rows = t(spark, d, "part").select(F.col("p_brand").alias("name")).distinct().withColumn("k", T.natural_key(F.col("name")))
    return H.number_rows(rows, [F.col("k")], "n").select("name", F.col("n").cast("long").alias("n"))


@query(r"SELECT page_id, regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) AS name FROM pages")
def url_file(spark, d):
    return t(spark, d, "pages").select("page_id", T.url_file(F.col("url")).alias("name"))


_HASH = f"lower(trim(regexp_replace(text, '{_WS}', ' ', 'g')))"


@query(f"SELECT doc_id, CASE WHEN {_HASH} <> '' THEN sha256({_HASH}) END AS hash FROM documents")
def content_hash(spark, d):
    return t(spark, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("hash"))


@query("SELECT p_size AS class_id, CASE p_size " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(K.CLASSES)) + " ELSE 'CLASS_' || p_size END AS class, count(*) AS n FROM part GROUP BY 1, 2")
def class_names(spark, d):
    return t(spark, d, "part").groupBy(F.col("p_size").alias("class_id"), T.class_name(F.col("p_size")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_orderpriority || '@' || strftime(o_orderdate, '%Y%m%d-%H%M') AS version FROM orders")
def weights_version(spark, d):
    return t(spark, d, "orders").select("o_orderkey", T.weights_version(F.col("o_orderpriority"), F.col("o_orderdate")).alias("version"))


@query("SELECT page_id, CASE WHEN e = 'pdf' THEN 'pdf' WHEN e IN ('" + "', '".join(K.IMAGE_EXTENSIONS) + "') THEN 'image' WHEN e IN ('" + "', '".join(K.OFFICE_EXTENSIONS) + r"') THEN 'office' END AS kind FROM (SELECT page_id, ['pdf', 'png', 'docx', 'txt', 'jpeg'][page_id % 5 + 1] AS e FROM pages)")
def route_files(spark, d):
    ext = F.element_at(F.array(*map(F.lit, ["pdf", "PNG", "docx", "txt", "jpeg"])), (F.col("page_id") % 5 + 1).cast("int"))
    return t(spark, d, "pages").select("page_id", T.kind_of(F.concat(F.lit("/in.box/f"), F.col("page_id").cast("string"), F.lit("."), ext)).alias("kind"))


# Fields

_EMAIL, _URL = K.FIELDS["EMAIL"].replace(r"\w", r"\p{L}\p{N}_"), K.FIELDS["URL"]
_COUNT = "coalesce(len(regexp_extract_all(text, '%s')), 0)"


@query(f"SELECT doc_id, {_COUNT % _EMAIL}::BIGINT AS n FROM documents")
def email_count(spark, d):
    return t(spark, d, "documents").select("doc_id", R.count_fields(F.col("text"), "EMAIL").alias("n"))


@query(f"SELECT page_id, coalesce(len(regexp_extract_all(url, '{_URL}')), 0)::BIGINT AS n FROM pages")
def url_count(spark, d):
    return t(spark, d, "pages").select("page_id", R.count_fields(F.col("url"), "URL").alias("n"))


@query(None)
def find_fields(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.explode(R.find_fields("text")).alias("f"))
    return rows.select("doc_id", "f.label", "f.start", "f.end", "f.text")


# Geometry

_PAIR = f"WITH {BOXES} SELECT a.page, a.idx, %s FROM boxes a JOIN boxes b ON a.page = b.page AND b.idx = a.idx + 1"


@query(_PAIR.replace("%s", "(a.x1 - a.x0) * (a.y1 - a.y0) AS area, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) / ((a.x1 - a.x0) * (a.y1 - a.y0)) AS ioa"))
def box_ioa(spark, d):
    b = boxes(spark, d).select("page", "idx", "bbox")
    nxt = b.select("page", (F.col("idx") - 1).alias("idx"), F.col("bbox").alias("other"))
    return b.join(nxt, ["page", "idx"]).select("page", "idx", G.area(F.col("bbox")).alias("area"), G.ioa(F.col("bbox"), F.col("other")).alias("ioa"))


@query(f"WITH {BOXES} SELECT page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM boxes GROUP BY page")
def box_union(spark, d):
    return boxes(spark, d).groupBy("page").agg(G.envelope(F.col("bbox")).alias("b")).select("page", "b.*")


@query(f"WITH {BOXES}, {REGIONS}, e AS (SELECT a.page, a.region_idx, min(x0) - 4 AS x0, min(y0) - 4 AS y0, max(x1) + 4 AS x1, max(y1) + 4 AS y1 FROM assigned a JOIN words w USING (page, word_idx) GROUP BY 1, 2) SELECT r.page, r.idx, CASE WHEN e.x0 IS NULL THEN r.x0 ELSE greatest(0, e.x0) END AS x0, CASE WHEN e.x0 IS NULL THEN r.y0 ELSE greatest(0, e.y0) END AS y0, CASE WHEN e.x0 IS NULL THEN r.x1 ELSE least(80, e.x1) END AS x1, CASE WHEN e.x0 IS NULL THEN r.y1 ELSE least(24, e.y1) END AS y1 FROM regions r LEFT JOIN e ON r.page = e.page AND r.idx = e.region_idx")
def snap_bbox(spark, d):
    r, w = regions_words(spark, d)
    pages = r.select("page", "width", "height").distinct()
    return L.snap_boxes(r.drop("width", "height"), L.assign_words(w, r, ["page"]), pages, ["page"]).select("page", "idx", "bbox.*")


_CLIP = "least(greatest(%s, 0), 1)"


@query(f"WITH {BOXES}, c AS (SELECT page, idx, {_CLIP % 'x0 / 100'} AS a, {_CLIP % 'y0 / 100'} AS b, {_CLIP % '(x0 / 100 + (x1 * 4) / 100)'} AS c, {_CLIP % '(y0 / 100 + y1 / 100)'} AS d FROM boxes) SELECT page, idx, (a + c) / 2 AS cx, (b + d) / 2 AS cy, c - a AS w, d - b AS h FROM c WHERE c - a > 1e-4 AND d - b > 1e-4")
def to_yolo(spark, d):
    b = F.col("bbox")
    rows = boxes(spark, d).withColumn("y", G.percent_to_center(b["x0"], b["y0"], b["x1"] * 4, b["y1"])).filter("y IS NOT NULL")
    return rows.select("page", "idx", "y.*")


@query(f"WITH {BOXES} SELECT page, idx, 100 * x0 / 60 AS x, 100 * y0 / 10 AS y, 100 * (least(60, x1) - x0) / 60 AS width, 100 * (least(10, y1) - y0) / 10 AS height FROM boxes WHERE least(60, x1) > x0 AND least(10, y1) > y0")
def to_percent(spark, d):
    rows = A.to_results(boxes(spark, d).withColumns({"width": F.lit(60), "height": F.lit(10)}))
    return rows.select("page", "idx", "value.*")


@query(f"WITH {BOXES} SELECT page, idx FROM boxes WHERE (x1 - x0) * (y1 - y0) >= 0.05 * 1920")
def min_area_filter(spark, d):
    return L.min_area(boxes(spark, d), F.col("width") * F.col("height"), 0.05).select("page", "idx")


# Joins


@query(f"""WITH {BOXES}, s AS (SELECT *, (x1 - x0) * (y1 - y0) AS a FROM boxes) SELECT page, idx, label FROM s WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.page = s.page AND o.label = s.label AND o.idx <> s.idx
AND greatest(0, least(s.x1, o.x1) - greatest(s.x0, o.x0)) * greatest(0, least(s.y1, o.y1) - greatest(s.y0, o.y0)) / s.a >= 0.85 AND (o.a > s.a OR (o.a = s.a AND o.idx < s.idx)))""")
def remove_contained(spark, d):
    return L.remove_contained(boxes(spark, d), ["page"]).select("page", "idx", "label")


@query(f"WITH {BOXES}, {REGIONS} SELECT * FROM assigned")
def assign_words(spark, d):
    r, w = regions_words(spark, d)
    return L.assign_words(w, r, ["page"]).select("page", "word_idx", "region_idx")


@query(f"WITH {BOXES}, {REGIONS} SELECT page, word_idx FROM words ANTI JOIN assigned USING (page, word_idx)")
def unassigned_words(spark, d):
    r, w = regions_words(spark, d)
    return L.unassigned(w, L.assign_words(w, r, ["page"]), ["page"]).select("page", "word_idx")


@query("SELECT doc_id FROM (SELECT DISTINCT doc_id FROM documents) ANTI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)")
def labels_anti(spark, d):
    docs = t(spark, d, "documents").select("doc_id")
    done = t(spark, d, "labels").filter("toxic = 1")
    return A.without_labelled(docs.distinct(), done, "doc_id")


@query(f"WITH {BOXES} SELECT label, count(*) AS n FROM (SELECT CASE label WHEN 'N' THEN 'A' ELSE label END AS label FROM boxes) WHERE label IN ('A', 'X') GROUP BY label")
def allowed_semi(spark, d):
    return A.allowed_only(boxes(spark, d), ["A", "X"], {"N": "A"}).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p.page_id, f.c_name AS path FROM (SELECT page_id, regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) AS name FROM pages) p LEFT JOIN (SELECT c_custkey::VARCHAR AS name, c_name FROM customer) f USING (name)")
def resolve_urls(spark, d):
    index = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("name"), F.col("c_name").alias("path"), F.col("c_custkey").alias("idx"))
    return A.resolve(t(spark, d, "pages").select("page_id", "url"), index).select("page_id", "path")


# Order


@query(f"WITH {BOXES}, r AS (SELECT *, max(x1) OVER (PARTITION BY page ORDER BY x0, x1, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM boxes) SELECT page, idx, (sum(CASE WHEN reach IS NULL OR x0 > reach + 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY x0, x1, idx) - 1)::BIGINT AS cut FROM r")
def interval_cut(spark, d):
    b = boxes(spark, d)
    return L.cut_groups(b, ["page"], F.col("bbox.x0"), F.col("bbox.x1"), 0.5).select("page", "idx", "cut")


def _columns(spark: SparkSession, d: str) -> DataFrame:
    """Ten orders a page, so that pages have enough lines for two columns."""
    b = boxes(spark, d)
    half = G.box(F.when(F.col("idx") % 2 == 0, 2).otherwise(45), F.col("bbox.x0"), F.when(F.col("idx") % 2 == 0, 30 + F.col("size")).otherwise(70), F.col("bbox.x0") + 2)
    wide = (F.col("page") % 29 == 0) & (F.col("idx") == 0)
    rows = b.select((F.col("page") / 10).cast("long").alias("page"), (F.col("page") * 100 + F.col("idx")).alias("idx"), F.when(wide, G.box(F.lit(2), F.col("bbox.x0"), F.lit(70), F.col("bbox.x0") + 2)).otherwise(half).alias("bbox"), "bold", "size")
    return rows


COLUMNS = f"""{BOXES}, cols AS (SELECT page // 10 AS page, page * 100 + idx AS idx, bold, CASE WHEN page % 29 = 0 AND idx = 0 OR idx % 2 = 0 THEN 2 ELSE 45 END::DOUBLE AS x0, x0 AS y0,
  CASE WHEN page % 29 = 0 AND idx = 0 THEN 70 WHEN idx % 2 = 0 THEN 30 + size ELSE 70 END::DOUBLE AS x1, x0 + 2 AS y1 FROM boxes),
counts AS (SELECT page, x, count(*) FILTER (WHERE x0 < x AND x < x1) AS crossings, count(*) FILTER (WHERE x1 <= x) AS l, count(*) FILTER (WHERE x0 >= x) AS r, count(*) AS n FROM cols, range(20, 60) t(x) GROUP BY page, x),
best AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY page ORDER BY crossings, x) = 1),
splits AS (SELECT page, x AS split, crossings FROM best WHERE crossings < n AND least(l, r) >= 3 AND crossings <= 0.15 * n)"""


@query(f"WITH {COLUMNS} SELECT page, split, crossings FROM splits")
def column_split(spark, d):
    return L.column_split(_columns(spark, d), ["page"], 80.0).select("page", F.col("split").cast("long").alias("split"), "crossings")


@query(f"""WITH {COLUMNS}, m AS (SELECT c.*, split, coalesce(x0 < split AND split < x1, false) AS wide, CASE WHEN split IS NULL OR (x0 < split AND split < x1) THEN 0 WHEN x1 <= split THEN 1 ELSE 2 END AS col FROM cols c LEFT JOIN splits USING (page)),
b AS (SELECT *, coalesce(sum(wide::INT) OVER (PARTITION BY page ORDER BY y0, x0, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS band FROM m)
SELECT page, idx, col, row_number() OVER (PARTITION BY page ORDER BY band, CASE WHEN wide THEN 3 ELSE col END, y0, x0, idx) - 1 AS ord FROM b""")
def band_order(spark, d):
    c = _columns(spark, d)
    return L.band_order(c, L.column_split(c, ["page"], 80.0), ["page"]).select("page", "idx", "col", "ord")


@query(None)
def xy_cut(spark, d):
    return L.reading_order(boxes(spark, d).select("page", "idx", "bbox", "width", "height"), ["page"]).select("page", "idx", "ord")


def _words(spark: SparkSession, d: str) -> DataFrame:
    return boxes(spark, d).select("page", F.col("idx").alias("word_idx"), F.concat("label", F.col("idx").cast("string")).alias("text"), "bbox", F.col("score").alias("conf"))


@query(None)
def build_lines(spark, d):
    return L.build_lines(_words(spark, d), ["page"]).select("page", "line_idx", "text", "bbox.*", "conf")


# Sections

_MARGINS = rf"""{LINES}, k AS (SELECT *, trim(regexp_replace(lower(text), '\p{{Nd}}+', '#', 'g')) AS k, y1 <= 70 OR y0 >= (1 - 0.07) * 1000 AS m FROM lines),
n AS (SELECT doc_id, count(DISTINCT page) AS n FROM lines GROUP BY 1), c AS (SELECT doc_id, k, count(DISTINCT page) AS c FROM k WHERE m GROUP BY 1, 2),
rep AS (SELECT doc_id, k FROM c JOIN n USING (doc_id) WHERE n >= 2 AND c >= greatest(2, ceil(0.6::DOUBLE * n))),
kept AS (SELECT k.* FROM k LEFT JOIN rep USING (doc_id, k) WHERE NOT (m AND (rep.k IS NOT NULL OR regexp_matches(text, '(?i)^(page|trang)?\s*\d{{1,3}}\s*((/|of|trên|\|)\s*\d{{1,3}})?$'))))"""


def _stripped(spark: SparkSession, d: str) -> DataFrame:
    lines = doc_lines(spark, d)
    return S.strip_headers_footers(lines, lines.select("doc_id", "page").distinct().withColumn("height", F.lit(1000)), ["doc_id"])


@query(f"WITH {_MARGINS} SELECT doc_id, line_idx FROM kept")
def strip_headers_footers(spark, d):
    return _stripped(spark, d).select("doc_id", "line_idx")


@query(f"WITH {_MARGINS}, h AS (SELECT doc_id, sha256({_HASH}) AS hash FROM (SELECT doc_id, string_agg({_CLEAN}, chr(10) ORDER BY line_idx) AS text FROM kept GROUP BY doc_id)) SELECT hash, count(*) AS n_docs, min(doc_id) AS first_doc FROM h GROUP BY hash")
def clean_corpus(spark, d):
    """Flagship: lines cleaned, repeated margin lines dropped, documents put together again and grouped by content."""
    lines = _stripped(spark, d).withColumn("text", T.clean_line(F.col("text")))
    whole = lines.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "text"))), lambda x: x["text"]), "\n").alias("text"))
    hashed = whole.select("doc_id", F.coalesce(T.content_hash(F.col("text")), F.sha2(F.lit(""), 256)).alias("hash"))
    return hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


def _regions(spark: SparkSession, d: str) -> DataFrame:
    """Documents of ten orders: page, ord, label, whether it has lines."""
    b = boxes(spark, d)
    return b.select((F.col("page") / 10).cast("long").alias("doc"), F.col("page"), (F.col("page") * 100 + F.col("idx")).alias("ord"), F.when(F.col("size") == 12, "UNASSIGNED").otherwise(F.col("label")).alias("label"), (F.col("bbox.y0") > 0).alias("has_lines"), "score", "source")


MERGED = f"""{BOXES}, g AS (SELECT page // 10 AS doc, page, page * 100 + idx AS ord, label, y0 > 0 AS has_lines, score, source FROM boxes WHERE size <> 12),
l AS (SELECT *, label = lag(label) OVER w AND has_lines AND lag(has_lines) OVER w AND (page = lag(page) OVER w OR page = lag(page) OVER w + 1) AS joins FROM g WINDOW w AS (PARTITION BY doc ORDER BY ord)),
merged AS (SELECT *, sum(CASE WHEN coalesce(joins, false) THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY ord) - 1 AS section_id FROM l)"""


@query(f"WITH {MERGED} SELECT doc, ord, section_id::BIGINT AS section_id FROM merged")
def merge_sections(spark, d):
    return S.merge_sections(_regions(spark, d), ["doc"]).select("doc", "ord", "section_id")


@query(f"WITH {MERGED} SELECT doc, section_id::BIGINT AS section_id, any_value(label) AS label, array_to_string(list_transform(list_sort(list_distinct(list(page))), lambda x: x::VARCHAR), ',') AS pages, max(score) AS score, array_to_string(list_sort(list_distinct(list(source))), ',') AS source, count(*) AS n_parts FROM merged GROUP BY 1, 2")
def section_summary(spark, d):
    return S.section_summary(S.merge_sections(_regions(spark, d), ["doc"]), ["doc"]).withColumn("pages", F.array_join("pages", ","))


def _styled(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents with sizes and weights; every seventh line is replaced by a heading keyword."""
    lines = doc_lines(spark, d)
    words = F.element_at(F.array(*[F.lit(k.upper()) for k, _ in K.KEYWORDS]), (F.col("doc_id") % len(K.KEYWORDS) + F.col("line_idx") / 7).cast("int") % len(K.KEYWORDS) + 1)
    head = F.col("line_idx") % 7 == 3
    return lines.select(F.col("doc_id").alias("doc"), F.col("line_idx").alias("ord"), "page", F.when(head, words).otherwise(F.col("text")).alias("text"), "bbox", F.when(head, 14.0).otherwise(10.0 + F.col("doc_id") % 2).alias("size"), head.alias("bold"), F.lit(0).alias("col"))


STYLED = f"""{LINES}, styled AS (SELECT doc_id AS doc, line_idx AS ord, page, CASE WHEN line_idx % 7 = 3 THEN ['{"', '".join(k.upper() for k, _ in K.KEYWORDS)}'][(doc_id % {len(K.KEYWORDS)} + line_idx // 7) % {len(K.KEYWORDS)} + 1] ELSE text END AS text,
  CASE WHEN line_idx % 7 = 3 THEN 14.0 ELSE 10.0 + doc_id % 2 END::DOUBLE AS size, line_idx % 7 = 3 AS bold FROM lines),
body AS (SELECT doc, size AS body FROM (SELECT doc, size, sum(length(text)) AS n, min(ord) AS f FROM styled GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n DESC, f) = 1)"""


@query(f"WITH {STYLED} SELECT doc, body FROM body")
def body_size(spark, d):
    return S.body_size(_styled(spark, d), ["doc"])


@query(rf"""WITH {STYLED}, w AS (SELECT s.*, body, list_filter(regexp_split_to_array(text, '{_WS}'), lambda x: x <> '') AS k FROM styled s JOIN body USING (doc))
SELECT doc, ord FROM w WHERE len(k) > 0 AND CASE WHEN len(k) > 2 AND 2 * len(list_filter(k, lambda x: length(x) <= 2)) > len(k) THEN 1 + len(regexp_extract_all(text, '  ')) ELSE len(k) END <= 7
AND NOT regexp_matches(rtrim(text), '[.,;]$') AND regexp_matches(text, '\p{{L}}') AND (size > body + 0.5 OR bold OR (upper(text) = text AND lower(text) <> text))""")
def heading_candidates(spark, d):
    lines = _styled(spark, d)
    rows = lines.join(S.body_size(lines, ["doc"]), "doc")
    return rows.filter(S.looks_like_heading(F.col("text"), F.col("size"), F.col("bold"), F.col("body"))).select("doc", "ord")


_KW = ", ".join(f"({i}, '{k}', '{label}')" for i, (k, label) in enumerate(K.KEYWORDS))


_SHORT = "len(list_filter(string_split(folded, ' '), lambda x: length(x) <= 2))"
_WORDS = "len(string_split(%s, ' '))"


@query(f"""WITH {STYLED}, kw(i, k, label) AS (VALUES {_KW}), f AS (SELECT DISTINCT {_FOLD} AS folded FROM styled),
h AS (SELECT folded, k, label, instr(' ' || folded || ' ', ' ' || k || ' ') AS p FROM f, kw WHERE contains(' ' || folded || ' ', ' ' || k || ' ')),
best AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY folded ORDER BY p, length(k) DESC, k, label) = 1),
cover AS (SELECT folded, list_concat(flatten(list(string_split(k, ' '))), ['{"', '".join(K.CONNECTORS)}']) AS ws FROM h GROUP BY folded),
spaced AS (SELECT folded, kw.label FROM f JOIN kw ON replace(folded, ' ', '') = replace(k, ' ', '') WHERE {_WORDS % "folded"} > 2 AND 2 * {_SHORT} > {_WORDS % "folded"} QUALIFY row_number() OVER (PARTITION BY folded ORDER BY i) = 1),
accepted AS (SELECT folded, label FROM best JOIN cover USING (folded) WHERE (p = 1 AND {_WORDS % "folded"} <= {_WORDS % "k"} + 2) OR len(list_filter(string_split(folded, ' '), lambda w: NOT list_contains(ws, w))) = 0)
SELECT folded, coalesce(s.label, a.label) AS label FROM f LEFT JOIN spaced s USING (folded) LEFT JOIN accepted a USING (folded) WHERE folded <> '' AND coalesce(s.label, a.label) IS NOT NULL""")
def match_label_exact(spark, d):
    folded = _styled(spark, d).select(T.fold(F.col("text")).alias("folded")).distinct()
    return folded.select("folded", S.match_exact(F.col("folded")).alias("label")).filter("label IS NOT NULL")


@query(None)
def match_label_fuzzy(spark, d):
    folded = _styled(spark, d).select(T.fold(F.col("text")).alias("text")).distinct()
    return folded.select("text", S.match_label(F.col("text")).alias("label"))


@query(None)
def find_headings(spark, d):
    return S.find_headings(_styled(spark, d), ["doc"])


@query(None)
def parse_documents(spark, d):
    return S.parse_documents(_styled(spark, d)).select("doc", "section_id", "section_label", "heading_text", "page", F.sha2("text", 256).alias("text_sha256"), "n_lines")


@query(f"WITH {LINES}, l AS (SELECT doc_id AS doc, line_idx AS ord, page, text, text[1:1] AS label FROM lines WHERE text <> ''), s AS (SELECT *, coalesce(label = lag(label) OVER w AND page = lag(page) OVER w, false) AS same FROM l WINDOW w AS (PARTITION BY doc ORDER BY ord)), r AS (SELECT *, sum(1 - same::INT) OVER (PARTITION BY doc ORDER BY ord) - 1 AS section_id FROM s) SELECT doc, section_id::BIGINT AS section_id, label AS section_label, page, sha256(string_agg(text, chr(10) ORDER BY ord)) AS text_sha256, count(*) AS n_lines FROM r GROUP BY doc, section_id, label, page")
def run_grouping(spark, d):
    lines = doc_lines(spark, d).filter("text <> ''").select(F.col("doc_id").alias("doc"), F.col("line_idx").alias("ord"), "page", "text", "bbox", F.substring("text", 1, 1).alias("label"), F.lit("").alias("heading_text"))
    return S.run_grouping(lines, ["doc"]).select("doc", "section_id", "section_label", "page", F.sha2("text", 256).alias("text_sha256"), "n_lines")


# Hygiene and splits

_FILES = "files AS (SELECT source || '/' || doc_id AS path, text FROM documents)"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), "text")


@query(f"WITH {_FILES} SELECT sha256(text) AS hash, count(*) AS n FROM files GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark, d):
    files = _texts(spark, d).select("path", F.encode("text", "UTF-8").alias("content")).withColumn("length", F.length("content"))
    return H.exact_duplicates(files).select("hash", "n")


@query(f"WITH {_FILES}, h AS (SELECT {_HASH} AS c FROM files) SELECT sha256(c) AS hash, count(*) AS n FROM h WHERE c <> '' GROUP BY 1 HAVING count(*) > 1")
def content_duplicates(spark, d):
    return H.content_duplicates(_texts(spark, d)).select("hash", "n")


@query("""WITH s AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'CV_' || s_suppkey ELSE 'scan' || s_suppkey END AS name, s_suppkey FROM supplier),
m AS (SELECT coalesce(max(s_suppkey), 0) AS top FROM s WHERE s_suppkey % 3 = 0)
SELECT name, 'CV_' || (top + row_number() OVER (ORDER BY s_suppkey)) AS new_name FROM s, m WHERE s_suppkey % 3 > 0""")
def rename_plan(spark, d):
    key = F.col("s_suppkey").cast("string")
    name = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("CV_"), key)).otherwise(F.concat(F.lit("scan"), key))
    return H.plan_renames(t(spark, d, "supplier").select(name.alias("name")), "CV")


@query("SELECT 'scan' || s_suppkey AS name, 'CV_' || row_number() OVER (ORDER BY s_suppkey) AS new_name FROM supplier")
def rename_all(spark, d):
    names = t(spark, d, "supplier").select(F.concat(F.lit("scan"), F.col("s_suppkey").cast("string")).alias("name"))
    return H.plan_renames(names, "CV", renumber=True)


_ORDERED = "k AS (SELECT DISTINCT o_custkey AS k FROM orders), o AS (SELECT k, row_number() OVER (ORDER BY sha256('7:' || k), k) AS i, count(*) OVER () AS n FROM k)"


@query(f"WITH {_ORDERED} SELECT k, CASE WHEN i <= round_even(n * 0.8, 0) THEN 'train' WHEN i <= round_even(n * 0.8, 0) + greatest(1, round_even(n * 0.1, 0)) THEN 'val' ELSE 'test' END AS split FROM o")
def group_split(spark, d):
    return H.group_split(t(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k", 7)


@query(f"WITH {_ORDERED} SELECT k, CASE WHEN i <= round_even(n * 0.1, 0) THEN 'test' WHEN i <= 2 * round_even(n * 0.1, 0) THEN 'dev' ELSE 'train' END AS split FROM o")
def ner_split(spark, d):
    return H.split_by_key(t(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k", 7)


@query("SELECT source, array_to_string(list_sort(list_distinct(list(lang))), ',') AS splits FROM documents GROUP BY source HAVING count(DISTINCT lang) > 1")
def leakage_check(spark, d):
    rows = t(spark, d, "documents").select("source", F.col("lang").alias("split"))
    return H.leaks(rows, "source").withColumn("splits", F.array_join("splits", ","))


_SPLIT = "CASE WHEN l_orderkey % 10 < 8 THEN 'train' WHEN l_orderkey % 10 = 8 THEN 'val' ELSE 'test' END"


@query(f"WITH c(class_id, class) AS (VALUES {', '.join(f'({i}, {chr(39)}{c}{chr(39)})' for i, c in enumerate(K.CLASSES))}), b AS (SELECT (l_suppkey % 11)::INT AS class_id, {_SPLIT} AS split FROM lineitem) SELECT coalesce(class, 'TOTAL') AS class, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val, count(*) FILTER (WHERE split = 'test') AS test, count(split) AS total FROM c LEFT JOIN b USING (class_id) GROUP BY ROLLUP (class)")
def class_stats(spark, d):
    return H.class_stats(t(spark, d, "lineitem").select((F.col("l_suppkey") % 11).cast("int").alias("class_id"), F.expr(_SPLIT).alias("split")))


@query("SELECT p_brand AS class, max(p_retailprice) FILTER (WHERE p_size < 20) AS small, max(p_retailprice) FILTER (WHERE p_size >= 20) AS large FROM part GROUP BY p_brand")
def pivot_metrics(spark, d):
    rows = t(spark, d, "part").select(F.col("p_brand").alias("class"), F.when(F.col("p_size") < 20, "small").otherwise("large").alias("model"), F.col("p_retailprice").alias("ap50_95"))
    return A.pivot_metrics(rows, ["small", "large"])


@query("SELECT p_partkey, p_size AS class_id, p_size / 64.0::DOUBLE AS cx, 0.5::DOUBLE AS cy, 0.25::DOUBLE AS w, 0.125::DOUBLE AS h FROM part WHERE p_partkey % 4 > 0")
def read_labels(spark, d):
    more = F.when(F.col("p_partkey") % 4 == 0, " 9").otherwise("")
    lines = t(spark, d, "part").select("p_partkey", F.concat(F.col("p_size").cast("string"), F.lit("  "), (F.col("p_size") / 64).cast("string"), F.lit(" 0.5 0.25 0.125"), more).alias("value"))
    return H.read_labels(lines)


# Tags


@query(f"WITH {TAGS}, {_spans('tag', 'spans')} SELECT * FROM spans")
def bio_spans(spark, d):
    return N.spans_of(tagged(spark, d), ["seq"])


@query("SELECT seq, pos, CASE WHEN pos % 7 >= 5 THEN 'O' WHEN pos % 7 = 0 THEN 'B-T' || (pos // 7 % 3) ELSE 'I-T' || (pos // 7 % 3) END AS tag FROM (SELECT user_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events)")
def bio_tags(spark, d):
    words = tagged(spark, d).select("seq", "pos", (F.col("pos") * 10).alias("start"))
    n = F.floor(F.col("pos") / 7)
    spans = words.filter("pos % 7 = 0").select("seq", n.alias("span_idx"), "start", (F.col("start") + 50).alias("end"), F.concat(F.lit("T"), (n % 3).cast("string")).alias("label"))
    return N.bio_tags(words, spans, ["seq"]).select("seq", "pos", "tag")


@query(f"""WITH {TAGS}, {_spans("tag", "g")}, {_spans("pred", "p")}, j AS (SELECT type, g.seq IS NOT NULL AS g, p.seq IS NOT NULL AS p FROM g FULL JOIN p USING (seq, "start", "end", type)),
c AS (SELECT coalesce(type, 'micro') AS type, count(*) FILTER (WHERE g AND p) AS h, count(*) FILTER (WHERE g) AS s, count(*) FILTER (WHERE p) AS n FROM j GROUP BY GROUPING SETS ((type), ())),
r AS (SELECT type, CASE WHEN n > 0 THEN h / n ELSE 0 END AS precision, CASE WHEN s > 0 THEN h / s ELSE 0 END AS recall, s FROM c)
SELECT type, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1, s::BIGINT AS support FROM r""")
def entity_prf(spark, d):
    x = tagged(spark, d)
    return N.entity_scores(N.spans_of(x, ["seq"]), N.spans_of(x, ["seq"], "pred"), ["seq"])


@query("WITH y AS (SELECT DISTINCT event_type AS t FROM events), l AS (SELECT 'O' AS label, '' AS t UNION ALL SELECT 'B-' || t, t FROM y UNION ALL SELECT 'I-' || t, t FROM y) SELECT row_number() OVER (ORDER BY t, label) - 1 AS label_id, label FROM l")
def label_list(spark, d):
    return N.label_list(t(spark, d, "events").select(F.col("event_type").alias("type")))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]'))::BIGINT AS n FROM documents")
def text_tokens(spark, d):
    return t(spark, d, "documents").select("doc_id", F.size(N.word_tokens(F.col("text"))).cast("long").alias("n"))


# Annotations


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey) = 1")
def latest_annotation(spark, d):
    note = F.struct(F.col("o_orderkey"), (F.col("o_orderkey") < 0).alias("was_cancelled"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"), F.lit("1900").alias("created_at"))
    tasks = t(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(note)).alias("annotations"))
    return tasks.select("o_custkey", A.newest(F.col("annotations"))["o_orderkey"].alias("o_orderkey"))


@query("SELECT c_custkey, coalesce(round_even(avg(l), 4), 0) AS score FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, l_linenumber AS l FROM orders JOIN lineitem ON o_orderkey = l_orderkey) USING (c_custkey) GROUP BY c_custkey")
def task_score(spark, d):
    results = t(spark, d, "orders").join(t(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("c_custkey"), F.col("l_linenumber").alias("score"))
    return A.task_scores(t(spark, d, "customer"), results, "c_custkey")


@query(f"WITH {BOXES}, r AS (SELECT source AS model, count(*) AS n_regions, avg(y0) AS mean_score FROM boxes GROUP BY 1), s AS (SELECT source AS model, count(*) AS n_sections FROM (SELECT DISTINCT source, page, label FROM boxes) GROUP BY 1), u AS (SELECT source AS model, count(*) AS n_unassigned FROM boxes WHERE idx > 5 GROUP BY 1) SELECT model, n_regions, mean_score, coalesce(n_sections, 0) AS n_sections, coalesce(n_unassigned, 0) AS n_unassigned FROM r LEFT JOIN s USING (model) LEFT JOIN u USING (model)")
def model_compare(spark, d):
    b = boxes(spark, d).withColumn("model", F.col("source")).withColumn("score", F.col("bbox.y0"))
    return A.model_compare(b, b.select("model", "page", "label").distinct(), b.filter("idx > 5"))


@query("SELECT count(*) FILTER (WHERE event_id % 4 = 3) AS unknown, count(*) FILTER (WHERE event_id % 4 <> 3 AND event_id % 5 = 0) AS dropped, count(*) FILTER (WHERE event_id % 7 = 0) AS rotated, count(*) FILTER (WHERE event_id % 4 <> 3 AND event_id % 5 <> 0) AS written FROM events")
def box_counters(spark, d):
    value = F.struct(F.lit(10.0).alias("x"), F.lit(20.0).alias("y"), F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(5.0).alias("width"), F.lit(5.0).alias("height"), F.when(F.col("event_id") % 7 == 0, 90.0).otherwise(0.0).alias("rotation"), F.array(F.concat(F.lit("c"), (F.col("event_id") % 4).cast("string"))).alias("rectanglelabels"))
    result = F.array(F.struct(F.lit("rectanglelabels").alias("type"), F.lit(0).alias("item_index"), value.alias("value")))
    note = F.array(F.struct(F.lit(False).alias("was_cancelled"), F.lit("a").alias("created_at"), F.lit("b").alias("updated_at"), result.alias("result")))
    tasks = t(spark, d, "events").select(F.col("event_id").alias("id"), note.alias("annotations"))
    return A.box_counters(A.task_boxes(tasks, {"c0": 0, "c1": 1, "c2": 2}))
