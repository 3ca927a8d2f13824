"""Queries of sources, sinks and what lies between files and tables, over relations derived from the test tables."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import geometry as G
from ..functions import text as T
from ..operators import annotation as A
from ..operators import hygiene as H
from ..operators import layout as L
from ..operators import ner as N
from ..operators import sections as S
from ..sources import readers as R
from ..sources import sinks
from .catalog import BOXES, COLUMNS, LINES, boxes, doc_lines, query, t

# Pages with a text layer


def _spans(spark: SparkSession, d: str) -> DataFrame:
    """Two boxes a line; each fifth span is blank, and each second line of an order stands twice."""
    b = boxes(spark, d).withColumn("line", F.floor(F.col("idx") / 2))
    text = F.when(F.col("idx") % 5 == 4, "  ").otherwise(F.concat(F.lit(" item "), F.col("label"), F.col("idx").cast("string"), F.lit(" of a list ")))
    rows = b.select("page", "line", "idx", text.alias("text"), "bbox", "size", "bold")
    return rows.unionByName(rows.filter("line = 1").withColumns({"line": F.lit(9).cast("long"), "idx": F.col("idx") + 20}))


SPANS = f"""{BOXES}, spans0 AS (SELECT page, idx // 2 AS line, idx, CASE WHEN idx % 5 = 4 THEN '  ' ELSE ' item ' || label || idx || ' of a list ' END AS text, x0, y0, x1, y1, size, bold FROM boxes),
spans AS (SELECT * FROM spans0 UNION ALL SELECT page, 9, idx + 20, text, x0, y0, x1, y1, size, bold FROM spans0 WHERE line = 1),
lines0 AS (SELECT page, line, trim(regexp_replace(string_agg(text, ' ' ORDER BY idx) FILTER (WHERE trim(text) <> ''), '\\s+', ' ', 'g')) AS text, bool_and(bold) FILTER (WHERE trim(text) <> '') AS bold, max(size) FILTER (WHERE trim(text) <> '') AS size,
  min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM spans GROUP BY page, line),
lines1 AS (SELECT * FROM lines0 WHERE coalesce(text, '') <> '' QUALIFY row_number() OVER (PARTITION BY page, text, round_even(x0 / 3, 0), round_even(y0 / 3, 0) ORDER BY line) = 1)"""


def _merge_rows(of: str, key: str, idx: str) -> str:
    """CTEs: the rows of a table (key, idx, text, x0 .. y1, size, bold) with neighbouring pieces of one visual row merged."""
    joins = "abs(m.by0 - o.y0) < 2 AND abs(m.by1 - o.y1) < 2 AND o.x0 - m.bx1 >= 0 AND o.x0 - m.bx1 < 6"
    return f"""ordered AS (SELECT *, {idx} AS piece, row_number() OVER (PARTITION BY {key} ORDER BY round_even(y0, 0), x0, {idx}) AS n FROM {of}),
m AS (SELECT {key}, n, piece AS piece_of, y0 AS by0, x1 AS bx1, y1 AS by1 FROM ordered WHERE n = 1
  UNION ALL SELECT o.{key}, o.n, CASE WHEN {joins} THEN m.piece_of ELSE o.piece END, CASE WHEN {joins} THEN least(m.by0, o.y0) ELSE o.y0 END, o.x1, CASE WHEN {joins} THEN greatest(m.by1, o.y1) ELSE o.y1 END
  FROM m JOIN ordered o ON o.{key} = m.{key} AND o.n = m.n + 1),
rows AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY min(n)) - 1 AS idx, string_agg(text, ' ' ORDER BY n) AS text, arg_min(x0, n) AS x0, min(y0) AS y0, arg_max(x1, n) AS x1, max(y1) AS y1, max(size) AS size, bool_and(bold) AS bold, count(*) AS pieces
  FROM m JOIN ordered USING ({key}, n) GROUP BY {key}, piece_of)"""


@query(f"WITH RECURSIVE {BOXES}, named AS (SELECT *, label AS text FROM boxes), {_merge_rows('named', 'page', 'idx')} SELECT page, idx, text, x0, y0, x1, y1, size, bold, pieces FROM rows")
def merge_same_row(spark, d):
    b = boxes(spark, d).select("page", "idx", F.col("label").alias("text"), "bbox", "size", "bold")
    return L.merge_same_row(b, ["page"]).select("page", F.col("idx").cast("long").alias("idx"), "text", "bbox.*", "size", "bold", "pieces")


@query(f"WITH RECURSIVE {SPANS}, {_merge_rows('lines1', 'page', 'line')} SELECT page, idx, text, x0, y0, x1, y1, size, bold, pieces FROM rows")
def read_lines(spark, d):
    return R.read_lines(_spans(spark, d), ["page"]).select("page", F.col("idx").cast("long").alias("idx"), "text", "bbox.*", "size", "bold", "pieces")


_LAYER = "layer AS (SELECT page FROM (SELECT page, regexp_replace(string_agg(text, ' ' ORDER BY line, idx), '\\s+', '', 'g') AS s FROM spans GROUP BY page) WHERE length(s) >= 30)"


@query(f"""WITH RECURSIVE {SPANS}, {_LAYER}, lines2 AS (SELECT * FROM lines1 SEMI JOIN layer USING (page)), {_merge_rows('lines2', 'page', 'line')},
cand AS (SELECT DISTINCT page, x FROM (SELECT page, 10 AS x FROM rows UNION ALL SELECT page, ceil(x1)::BIGINT FROM rows) WHERE x >= 10 AND x < 30 OR x = 10),
counts AS (SELECT page, x, count(*) FILTER (WHERE x0 < x AND x < x1) AS crossings, count(*) FILTER (WHERE x1 <= x) AS l, count(*) FILTER (WHERE x0 >= x) AS r, count(*) AS n FROM rows JOIN cand USING (page) GROUP BY page, x),
splits AS (SELECT page, x AS split FROM (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY page ORDER BY crossings, x) = 1) WHERE crossings < n AND least(l, r) >= 3 AND crossings <= 0.15::DOUBLE * n),
s AS (SELECT r.*, split, coalesce(x0 < split AND split < x1, false) AS wide, CASE WHEN split IS NULL OR (x0 < split AND split < x1) THEN 0 WHEN x1 <= split THEN 1 ELSE 2 END AS col FROM rows r LEFT JOIN splits USING (page)),
b AS (SELECT *, coalesce(sum(wide::INT) OVER (PARTITION BY page ORDER BY y0, x0, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS band FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY band, CASE WHEN wide THEN 3 ELSE col END, y0, x0, idx) AS k FROM b)
SELECT page // 4 AS doc, page, col, text, row_number() OVER (PARTITION BY page // 4 ORDER BY page, k) - 1 AS ord FROM o""")
def read_pdf_lines(spark, d):
    doc = (F.col("page") / 4).cast("long")
    spans = _spans(spark, d).withColumn("doc", doc)
    pages = boxes(spark, d).select("page", F.lit(40.0).alias("width")).distinct().withColumn("doc", doc)
    return R.read_pdf_lines(spans, pages, ["doc"]).select("doc", "page", "col", "text", F.col("ord").cast("long").alias("ord"))


@query(f"""WITH {COLUMNS}, m AS (SELECT c.*, split, coalesce(x0 < split AND split < x1, false) AS wide, CASE WHEN split IS NULL OR (x0 < split AND split < x1) THEN 0 WHEN x1 <= split THEN 1 ELSE 2 END AS col FROM cols c LEFT JOIN splits USING (page)),
b AS (SELECT *, coalesce(sum(wide::INT) OVER (PARTITION BY page ORDER BY y0, x0, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS band FROM m),
o AS (SELECT *, page // 4 AS doc, row_number() OVER (PARTITION BY page ORDER BY band, CASE WHEN wide THEN 3 ELSE col END, y0, x0, idx) - 1 AS k FROM b),
h AS (SELECT *, sum((col = 1 AND bold)::INT) OVER (PARTITION BY doc, page) AS heads, sum((col = 1)::INT) OVER (PARTITION BY doc, page) AS lefts FROM o),
s AS (SELECT *, heads >= 2 AND heads >= 0.4::DOUBLE * lefts AS side FROM h)
SELECT doc, page, idx, CASE WHEN side THEN 0 ELSE col END AS col, row_number() OVER (PARTITION BY doc ORDER BY page, CASE WHEN side THEN y0 - CASE WHEN col = 1 THEN 6 ELSE 0 END END, CASE WHEN side THEN x0 END, k) - 1 AS ord FROM s""")
def side_headings(spark, d):
    from .catalog import _columns

    c = _columns(spark, d)
    rows = L.band_order(c, L.column_split(c, ["page"], 80.0), ["page"]).withColumn("is_heading", (F.col("col") == 1) & F.col("bold"))
    return L.side_headings(rows.withColumn("doc", (F.col("page") / 4).cast("long")), ["doc"]).select("doc", "page", "idx", "col", "ord")


@query(f"WITH {BOXES} SELECT page, idx, trim(label || ' ') AS text, x0 * 1.5 AS x0, y0 * 1.5 AS y0, x1 * 1.5 AS x1, y1 * 1.5 AS y1, 1.0::DOUBLE AS conf FROM boxes WHERE idx % 4 > 0")
def text_layer_words(spark, d):
    b = boxes(spark, d).select("page", "idx", F.when(F.col("idx") % 4 > 0, F.concat("label", F.lit(" "))).otherwise(" \t").alias("text"), "bbox")
    return R.text_layer_words(b, 1.5).select("page", "idx", "text", "bbox.*", "conf")


@query("SELECT l_orderkey, l_linenumber, l_returnflag AS text, (l_quantity - 5) / 100 AS conf, l_partkey::DOUBLE AS x0, l_suppkey::DOUBLE AS y0, (l_partkey + 7)::DOUBLE AS x1, (l_suppkey + 3)::DOUBLE AS y1 FROM lineitem WHERE l_quantity >= 5 AND l_linestatus = 'O'")
def recognised_words(spark, d):
    text = F.when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), "l_returnflag")).otherwise(" ")
    raw = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"), (F.col("l_quantity") - 5).alias("conf"), F.col("l_partkey").alias("left"), F.col("l_suppkey").alias("top"), F.lit(7).alias("width"), F.lit(3).alias("height"))
    return R.recognised_words(raw).select("l_orderkey", "l_linenumber", "text", "conf", "bbox.*")


@query(f"WITH {BOXES} SELECT page, idx, (x0 / 100 - y0 / 400) * 60 AS x0, (x1 / 100 - y1 / 400) * 20 AS y0, (x0 / 100 + y0 / 400) * 60 AS x1, (x1 / 100 + y1 / 400) * 20 AS y1 FROM boxes")
def center_to_corners(spark, d):
    b = F.col("bbox")
    rows = boxes(spark, d)
    return rows.select("page", "idx", G.center_to_corners(b["x0"] / 100, b["x1"] / 100, b["y0"] / 200, b["y1"] / 200, F.lit(60), F.lit(20)).alias("b")).select("page", "idx", "b.*")


@query(f"WITH {BOXES} SELECT page, idx, x0 + size AS x0, y0 + 3 AS y0, x1 + size AS x1, y1 + 3 AS y1 FROM boxes")
def crop_offset(spark, d):
    crop = G.box(F.col("size"), F.lit(3.0), F.lit(90.0), F.lit(90.0))
    return boxes(spark, d).select("page", "idx", G.crop_offset(F.col("bbox"), crop).alias("b")).select("page", "idx", "b.*")


# Word-processor documents

_W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:mc="http://schemas.openxmlformats.org/markup-compatibility/2006"'
#: Base has size 11 and is bold; Mid leaves its size open; Heading 1 is a heading by name; Loop is its own base.
_STYLES = f"""<w:styles {_W}><w:style w:styleId="Base"><w:name w:val="body"/><w:rPr><w:sz w:val="22"/><w:b/></w:rPr></w:style>
<w:style w:styleId="Mid"><w:name w:val="middle"/><w:basedOn w:val="Base"/><w:rPr><w:b w:val="0"/></w:rPr></w:style>
<w:style w:styleId="H1"><w:name w:val="Heading 1"/><w:basedOn w:val="Mid"/><w:rPr><w:sz w:val="30"/></w:rPr></w:style>
<w:style w:styleId="Loop"><w:name w:val="loop"/><w:basedOn w:val="Loop"/></w:style></w:styles>"""


def _zipped(rows: DataFrame) -> DataFrame:
    """path, content of word-processor files from path, header, body (XML parts)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for header, body in zip(b["header"], b["body"], strict=True):
                data = io.BytesIO()
                with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
                    for name, part in (("word/styles.xml", _STYLES), ("word/header1.xml", header), ("word/document.xml", body)):
                        z.writestr(name, part)
                out.append(data.getvalue())
            yield pd.DataFrame({"path": b["path"], "content": out})

    return rows.mapInPandas(run, "path string, content binary")


@query("""WITH p AS (SELECT p_partkey, p_brand, p_size, ['Base', 'Mid', 'H1', 'Loop'][p_partkey % 4 + 1] AS style FROM part),
l AS (SELECT p_partkey, 0 AS o, 'top ' || p_brand AS text, 9.0::DOUBLE AS size, false AS bold FROM p
UNION ALL SELECT p_partkey, 1, p_brand || ' and more', greatest(CASE style WHEN 'Base' THEN 11 WHEN 'Mid' THEN 11 WHEN 'H1' THEN 15 ELSE 0 END, p_size / 2) + CASE style WHEN 'H1' THEN 2 ELSE 0 END, style IN ('Base', 'H1') FROM p
UNION ALL SELECT p_partkey, 2, 'in a box', 0, true FROM p WHERE p_size % 2 = 0)
SELECT 'f' || p_partkey AS path, row_number() OVER (PARTITION BY p_partkey ORDER BY o) - 1 AS idx, text, size::DOUBLE AS size, bold FROM l""")
def read_docx(spark, d):
    p = t(spark, d, "part")
    style = F.element_at(F.array(*map(F.lit, ["Base", "Mid", "H1", "Loop"])), (F.col("p_partkey") % 4 + 1).cast("int"))
    header = F.format_string(f'<w:hdr {_W}><w:p><w:r><w:rPr><w:sz w:val="18"/></w:rPr><w:t>top %s</w:t></w:r></w:p><w:p><w:r><w:t> </w:t></w:r></w:p></w:hdr>', F.col("p_brand"))
    box = "<w:p><w:r><w:txbxContent><w:p><w:r><w:rPr><w:b/></w:rPr><w:t>in a box</w:t></w:r></w:p></w:txbxContent></w:r></w:p>"
    copy = "<w:p><mc:Fallback><w:txbxContent><w:p><w:r><w:t>old copy</w:t></w:r></w:p></w:txbxContent></mc:Fallback></w:p>"
    body = F.format_string(
        f'<w:document {_W}><w:p><w:pPr><w:pStyle w:val="%s"/></w:pPr><w:r><w:t>%s</w:t></w:r><w:r><w:tab/></w:r><w:r><w:rPr><w:sz w:val="%d"/></w:rPr><w:t xml:space="preserve">  and more </w:t></w:r></w:p>%s{copy}</w:document>',
        style, F.col("p_brand"), F.col("p_size").cast("long"), F.when(F.col("p_size") % 2 == 0, box).otherwise(""),
    )
    files = p.select(F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("path"), header.alias("header"), body.alias("body"))
    return R.read_docx(_zipped(files)).select("path", F.col("idx").cast("long").alias("idx"), "text", "size", "bold")


# Annotation exports


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
last AS (SELECT * FROM o WHERE o_orderkey % 5 > 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY k DESC) = 1)
SELECT CASE WHEN o_custkey % 2 = 0 THEN 'cv' || o_custkey ELSE o_custkey::VARCHAR END AS doc, CASE WHEN o_custkey % 3 = 0 THEN 'SKILLS' ELSE 'OTHER' END AS section, 'text of ' || o_custkey AS text, 5 + k AS "start", 8 + k AS "end", 'L' || o_orderkey % 7 AS label FROM last""")
def text_examples(spark, d):
    span = F.struct(F.col("k").alias("start"), (F.col("k") + 3).alias("end"), F.array(F.concat(F.lit("L"), (F.col("o_orderkey") % 7).cast("string"))).alias("labels"))
    result = F.array(F.struct(F.lit("choices").alias("type"), span.alias("value")), F.struct(F.lit("labels").alias("type"), span.alias("value")))
    orders = t(spark, d, "orders").withColumn("k", F.expr("5 + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)"))
    notes = F.transform(F.array_sort(F.collect_list(F.struct("k", F.struct((F.col("o_orderkey") % 5 == 0).alias("was_cancelled"), result.alias("result")).alias("a")))), lambda x: x["a"])
    c = F.col("o_custkey")
    data = F.struct(F.when(c % 2 == 0, F.concat(F.lit("cv"), c.cast("string"))).alias("cv"), F.when(c % 3 == 0, "SKILLS").alias("section"), F.concat(F.lit("text of "), c.cast("string")).alias("text"))
    tasks = orders.groupBy("o_custkey").agg(notes.alias("annotations")).select(F.concat(F.lit("["), F.to_json(F.struct(c.alias("id"), data.alias("data"), "annotations")), F.lit("]")).alias("value"))
    rows = R.text_examples_of(tasks).select("doc", "section", "text", F.explode("spans").alias("s")).select("doc", "section", "text", "s.*")
    return rows.withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long")})


@query("""SELECT id, array_to_string(list, ' ') AS urls, n_boxes FROM (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN ['/data/a' || c_custkey, 'b.png'] WHEN 1 THEN ['https://h/x/' || c_custkey || '.PNG?d=1'] WHEN 2 THEN ['/data/upload'] END AS list,
CASE c_custkey % 3 WHEN 0 THEN 0 ELSE 1 END::BIGINT AS n_boxes FROM customer)""")
def box_tasks(spark, d):
    c = F.col("c_custkey")
    own = F.when(c % 4 == 0, F.format_string('"n":3,"empty":[],"pages":["/data/a%d","b.png"],"z":"q.png"', c)).when(c % 4 == 1, F.format_string('"name":"none","page":"https://h/x/%d.PNG?d=1"', c)).when(c % 4 == 2, F.lit('"a":"text","b":"/data/upload"')).otherwise(F.lit('"a":"text","b":7'))
    own = F.replace(own, F.lit("?d=1"), F.lit("?k=1"))
    box = '{"type":"rectanglelabels","item_index":0,"value":{"x":1.0,"y":2.0,"width":3.0,"height":4.0,"rotation":0,"rectanglelabels":["NAME"]}}'
    notes = F.when(c % 3 == 0, F.lit('{"was_cancelled":true,"updated_at":"2","result":[%s]}' % box)).otherwise(F.lit('{"was_cancelled":false,"updated_at":"1","result":[%s]},{"was_cancelled":true,"updated_at":"3","result":[]}' % box))
    value = F.concat(F.lit('[{"id":'), c.cast("string"), F.lit(',"data":{'), own, F.lit('},"annotations":['), notes, F.lit("]}]"))
    tasks = R.box_tasks_of(t(spark, d, "customer").select(value.alias("value")))
    found = A.newest(F.col("annotations"))["result"]
    urls = F.transform(A.page_urls(F.col("data")), lambda u: F.replace(u, F.lit("?k=1"), F.lit("?d=1")))
    return tasks.select("id", F.array_join(urls, " ").alias("urls"), F.coalesce(F.size(found), F.lit(0)).cast("long").alias("n_boxes")).withColumn("n_boxes", F.greatest("n_boxes", F.lit(0).cast("long")))


@query("SELECT o_orderkey AS id, 'l' || o_orderkey % 3 AS from_name, 'img' AS to_name, 'k' || o_orderkey % 5 AS value_key, o_orderkey % 2 = 0 AS multipage, 'A & B,C' || o_orderkey % 7 AS labels FROM orders")
def label_config(spark, d):
    k = F.col("o_orderkey")
    pattern = A.build_label_config(["A & B", "C@3"], True, "l@1", "img", "k@2").replace("%", "%%")
    for i in (1, 2, 3):
        pattern = pattern.replace(f"@{i}", f"%{i}$d")
    single = pattern.replace("valueList=", "value=")
    xml = F.when(k % 2 == 0, F.format_string(pattern, k % 3, k % 5, k % 7)).otherwise(F.format_string(single, k % 3, k % 5, k % 7))
    return t(spark, d, "orders").select(k.alias("id"), A.parse_label_config(xml).alias("c")).select("id", "c.*").withColumn("labels", F.array_join("labels", ","))


@query(f"SELECT c FROM (SELECT 'CLASS_' || p_size AS c FROM part UNION SELECT unnest(['{chr(39).join(K.CLASSES).replace(chr(39), chr(39) + ', ' + chr(39))}'])) EXCEPT SELECT 'CLASS_' || l_linenumber FROM lineitem EXCEPT SELECT unnest(['NAME', 'CONTACT'])")
def missing_labels(spark, d):
    label = lambda n, c: t(spark, d, n).select(T.class_name(F.col(c) + 1000).alias("label")).select(F.regexp_replace("label", "CLASS_10*", "CLASS_").alias("label"))
    fixed = lambda names: spark.createDataFrame([(c,) for c in names], "label string")
    model = label("part", "p_size").union(fixed(K.CLASSES))
    return A.missing_labels(model, label("lineitem", "l_linenumber"), fixed(["NAME", "CONTACT"])).select(F.col("label").alias("c"))


@query("SELECT source FROM (SELECT source FROM documents WHERE lang = 'en' INTERSECT SELECT source FROM documents WHERE lang <> 'en')")
def sources_in_both(spark, d):
    docs = t(spark, d, "documents")
    return docs.filter("lang = 'en'").select("source").intersect(docs.filter("lang <> 'en'").select("source"))


@query("SELECT c_nationkey AS \"group\", c_custkey % 6 AS page, arg_min(c_name, c_custkey) AS path FROM customer GROUP BY 1, 2")
def first_pages(spark, d):
    files = t(spark, d, "customer").select(F.col("c_nationkey").alias("group"), (F.col("c_custkey") % 6).alias("page"), F.col("c_name").alias("path"), F.col("c_custkey").alias("idx"))
    return A.first_pages(files)


@query("SELECT 'CV_' || c_custkey % 40 || '_Page_00' || c_custkey AS name, '/pdf/' || c_custkey % 40 AS path, (c_custkey - 1)::INT AS page FROM customer WHERE c_custkey % 40 BETWEEN 1 AND 30 AND c_custkey <= 100")
def render_source(spark, d):
    c = F.col("c_custkey")
    names = t(spark, d, "customer").select(F.concat(F.lit("CV_"), (c % 40).cast("string"), F.lit("_Page_00"), c.cast("string")).alias("name"))
    pdfs = spark.range(0, 31).select(F.when(F.col("id") > 0, F.concat(F.lit("CV_"), F.col("id").cast("string"))).otherwise("other").alias("stem"), F.concat(F.lit("/pdf/"), F.col("id").cast("string")).alias("path"), F.lit(100).alias("n_pages"))
    return R.render_source(names, pdfs)


@query("SELECT 'p' || p_partkey AS image, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'p' || p_partkey END AS \"group\" FROM part")
def image_groups(spark, d):
    part = t(spark, d, "part").withColumn("image", F.concat(F.lit("p"), F.col("p_partkey").cast("string")))
    known = part.filter("p_partkey % 2 = 0").select("image", F.col("p_brand").alias("group"))
    return R.with_groups(part.select("image"), known)


@query("SELECT '/data/local-files/?d=' || c_nationkey || '/' || c_name AS url FROM customer")
def local_files_url(spark, d):
    path = F.concat(F.lit("/srv/files/"), F.col("c_nationkey").cast("string"), F.lit("/"), "c_name")
    return t(spark, d, "customer").select(T.local_files_url(path, "/srv/files").alias("url"))


@query(f"WITH {LINES} SELECT DISTINCT doc_id, page FROM lines WHERE page < 3")
def page_limit(spark, d):
    return H.first_pages_of(doc_lines(spark, d).select("doc_id", "page").distinct(), 3)


@query("SELECT c_custkey FROM (SELECT c_custkey, sha256('3:' || c_custkey) AS h FROM customer) ORDER BY h, c_custkey LIMIT 20")
def seeded_sample(spark, d):
    return H.sample_rows(t(spark, d, "customer").select("c_custkey"), "c_custkey", 20, 3)


# Results as text


def _sections(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise(F.concat(F.lit('é "'), F.col("o_orderpriority"), F.lit('"\nline 2')))
    return o.select(
        (F.col("o_custkey") % 50).alias("doc"), F.col("o_orderkey").alias("section_id"), F.col("o_orderstatus").alias("section_label"), F.lit("").alias("heading_text"),
        F.lit("pdf").alias("source"), (F.col("o_orderkey") % 4).alias("page"), text.alias("text"), G.box(F.col("o_orderkey") / 2, F.lit(1), F.lit(2.5), F.lit(3)).alias("bbox"),
    )


_SECTIONS = """sec AS (SELECT o_custkey % 50 AS doc, o_orderkey AS section_id, o_orderstatus AS section_label, o_orderkey % 4 AS page, CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE 'é "' || o_orderpriority || '"' || chr(10) || 'line 2' END AS text FROM orders)"""


@query(f"""WITH {_SECTIONS} SELECT doc, to_json({{'cv': doc, 'sections': list({{'section_label': section_label, 'heading_text': '', 'source': 'pdf', 'page': page, 'text': text, 'bbox': [section_id / 2, 1.0::DOUBLE, 2.5::DOUBLE, 3.0::DOUBLE]}} ORDER BY section_id)}})::VARCHAR AS value FROM sec GROUP BY doc""")
def sections_jsonl(spark, d):
    return sinks.sections_jsonl(_sections(spark, d), "doc")


@query(f"""WITH {_SECTIONS} SELECT doc, section_id, to_json({{'data': {{'cv': doc, 'section': section_label, 'page': page, 'text': text}}}})::VARCHAR AS value FROM sec WHERE text <> ' '""")
def tagging_tasks(spark, d):
    return sinks.tagging_tasks(_sections(spark, d), "doc")


_R4 = "round_even(%s, 4)"


def _result_parts(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """Documents of 20 orders with a page and a section for each order, and a region for each box."""
    b = boxes(spark, d).withColumn("doc", (F.col("page") / 20).cast("long"))
    docs = b.select("doc").distinct().select("doc", F.concat(F.lit("f"), F.col("doc").cast("string")).alias("source"), F.lit("m.pt").alias("model"))
    pages = b.select("doc", F.col("page").alias("index"), "width", "height", (F.col("page") % 2 == 0).alias("has_text_layer")).distinct()
    order = (F.col("page") * 100 + F.col("idx")).alias("ord")
    third = G.box(F.col("bbox.x0") / 3, F.col("bbox.y0") / 3, F.col("bbox.x1") / 3, F.col("bbox.y1") / 3)
    regions = b.select("doc", order, "page", "label", (F.col("score") / 3).alias("score"), third.alias("bbox"), F.col("bbox").alias("det_bbox"), "source", F.concat("label", F.lit("\n"), "source").alias("text"))
    sections = b.groupBy("doc", F.col("page").alias("section_id")).agg(F.max(F.struct("idx", "label"))["label"].alias("label"), (F.max("score") / 3).alias("score"), F.max("source").alias("source"), F.array_sort(F.collect_list(order)).alias("region_orders"))
    sections = sections.select("doc", "section_id", "label", F.array("section_id").alias("pages"), "score", "source", "region_orders", F.when(F.col("label") != "A", F.concat("label", F.lit("\nx"))).otherwise("").alias("text"))
    lines = b.filter("idx % 2 = 0").select("doc", order, F.lit(0).alias("idx"), F.col("label").alias("text"), third.alias("bbox"), (F.col("score") / 7).alias("conf"))
    return docs, pages, regions, sections, lines


_R1 = ", ".join(f"round_even({c} / 3, 1)" for c in ("x0", "y0", "x1", "y1"))
_RESULT = f"""{BOXES}, b AS (SELECT *, page // 20 AS doc, page * 100 + idx AS ord FROM boxes),
pg AS (SELECT doc, list({{'index': page, 'width': 80, 'height': 24, 'has_text_layer': page % 2 = 0}} ORDER BY page) AS pages FROM (SELECT DISTINCT doc, page FROM b) GROUP BY doc),
s AS (SELECT doc, page AS section_id, arg_max(label, idx) AS label, max(score) / 3 AS score, max(source) AS source, list(ord ORDER BY ord) AS region_orders FROM b GROUP BY 1, 2),
s2 AS (SELECT *, CASE WHEN label <> 'A' THEN label || chr(10) || 'x' ELSE '' END AS text FROM s)"""


@query(f"""WITH {_RESULT},
sl AS (SELECT doc, list({{'id': section_id, 'label': label, 'pages': [section_id], 'score': {_R4 % "score"}, 'source': source, 'region_orders': region_orders, 'text': text}} ORDER BY section_id) AS sections FROM s2 GROUP BY doc),
rl AS (SELECT doc, list({{'order': ord, 'page': page, 'label': label, 'score': {_R4 % "score / 3"}, 'bbox': [{_R1}], 'det_bbox': [x0, y0, x1, y1], 'source': source, 'text': label || chr(10) || source,
  'lines': CASE WHEN idx % 2 = 0 THEN [{{'text': label, 'bbox': [{_R1}], 'conf': round_even(score / 7, 3)}}] ELSE [] END}} ORDER BY ord) AS regions FROM b GROUP BY doc)
SELECT doc, to_json({{'source': 'f' || doc, 'model': 'm.pt', 'num_pages': len(pages), 'pages': pages, 'sections': sections, 'regions': regions}})::VARCHAR AS value FROM pg JOIN sl USING (doc) JOIN rl USING (doc)""")
def result_json(spark, d):
    return sinks.result_json(*_result_parts(spark, d), "doc")


@query(f"""WITH {_RESULT},
sl AS (SELECT doc, string_agg('### ' || section_id || '. ' || label || '  _(trang ' || (section_id + 1) || ', score ' || printf('%.2f', score) || ', ' || source || ')_' || chr(10) || chr(10) || CASE WHEN text = '' THEN '{K.MARKDOWN_EMPTY}' ELSE replace(text, chr(10), '  ' || chr(10)) END || chr(10), chr(10) ORDER BY section_id) AS v FROM s2 GROUP BY doc),
rl AS (SELECT doc, string_agg('_Trang ' || (page + 1) || ':_  ' || chr(10) || label || '  ' || chr(10) || source, chr(10) ORDER BY ord) AS r FROM b WHERE bold AND doc % 2 = 0 GROUP BY doc)
SELECT doc, v || coalesce(chr(10) || '{K.MARKDOWN_REST}' || chr(10) || r, '') AS value FROM sl LEFT JOIN rl USING (doc)""")
def result_markdown(spark, d):
    _, _, _, sections, _ = _result_parts(spark, d)
    doc = (F.col("page") / 20).cast("long")
    leftover = boxes(spark, d).filter("bold").select(doc.alias("doc"), (F.col("page") * 100 + F.col("idx")).alias("ord"), "page", F.concat("label", F.lit("\n"), "source").alias("text")).filter("doc % 2 = 0")
    return sinks.result_markdown(sections, leftover, "doc")


@query("SELECT l_orderkey, l_linenumber, printf('%d %.6f %.6f %.6f %.6f', l_suppkey % 13, l_quantity / 64, 0.5, 0.25, l_linenumber / 8) AS value FROM lineitem")
def yolo_lines(spark, d):
    box = F.struct((F.col("l_quantity") / 64).alias("cx"), F.lit(0.5).alias("cy"), F.lit(0.25).alias("w"), (F.col("l_linenumber") / 8).alias("h"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", sinks.yolo_line((F.col("l_suppkey") % 13).cast("long"), box).alias("value"))


@query(f"""WITH {BOXES}, r AS (SELECT page // 4 AS cv, page % 4 AS item, idx, label, score, least(60, x1) AS r, x0, y0, least(20, y1) AS bt FROM boxes),
k AS (SELECT * FROM r WHERE label <> 'N' AND r > x0 AND bt > y0),
g AS (SELECT cv, round_even(avg(score), 4) AS score, list({{'id': sha256(concat_ws(':', cv, item, idx))[1:10], 'from_name': 'label', 'to_name': 'page', 'type': 'rectanglelabels', 'original_width': 60, 'original_height': 20, 'image_rotation': 0,
  'value': {{'x': 100 * x0 / 60, 'y': 100 * y0 / 20, 'width': 100 * (r - x0) / 60, 'height': 100 * (bt - y0) / 20, 'rotation': 0, 'rectanglelabels': [label]}}, 'score': round_even(score, 4), 'item_index': item}} ORDER BY item, idx) AS result FROM k GROUP BY cv),
p AS (SELECT cv, list('/p/' || item ORDER BY item) AS urls FROM (SELECT DISTINCT cv, item FROM r) GROUP BY cv)
SELECT cv, to_json({{'data': {{'pages': urls, 'cv_name': cv}}, 'predictions': [{{'model_version': 'm@1', 'score': coalesce(g.score, 0.0::DOUBLE), 'result': coalesce(result, [])}}]}})::VARCHAR AS value FROM p LEFT JOIN g USING (cv)""")
def prediction_tasks(spark, d):
    b = boxes(spark, d).withColumns({"cv": (F.col("page") / 4).cast("long"), "item_index": F.col("page") % 4, "width": F.lit(60), "height": F.lit(20)})
    pages = b.select("cv", "item_index", F.concat(F.lit("/p/"), F.col("item_index").cast("string")).alias("url")).distinct()
    results = A.to_results(A.allowed_only(b, ["A", "R"]))
    config = {"from_name": "label", "to_name": "page", "value_key": "pages", "multipage": True}
    return A.prediction_tasks(pages, results, "cv", "m@1", config)


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_nationkey / 4, c_custkey) AS rank FROM customer")
def labelling_order(spark, d):
    return A.least_confident_first(t(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") / 4).alias("score")), "c_custkey").select("c_custkey", F.col("rank").cast("long").alias("rank"))


@query("SELECT strftime(TIMESTAMP '2024-05-06 07:08:09', '%Y-%m-%dT%H:%M:%S') AS time, p_name AS old, 'CV_' || p_partkey AS new FROM part")
def rename_log(spark, d):
    renames = t(spark, d, "part").select(F.col("p_name").alias("name"), F.concat(F.lit("CV_"), F.col("p_partkey").cast("string")).alias("new_name"))
    return sinks.rename_log(renames, F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"))


# Tagging


@query(rf"""WITH RECURSIVE tok AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')) AS word, generate_subscripts(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]'), 1) AS i FROM documents),
cum AS (SELECT doc_id, i, sum(ceil(length(word) / 4)::INT) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS total FROM tok),
ends AS (SELECT doc_id, list(total ORDER BY i) AS t, count(*) AS n FROM cum GROUP BY doc_id),
run AS (SELECT doc_id, 0::BIGINT AS first, 0::BIGINT AS used, t, n FROM ends
  UNION ALL SELECT doc_id, last, t[last], t, n FROM (SELECT doc_id, t, n, greatest(first + 1, len(list_filter(t, lambda x: x <= used + 60))) AS last FROM run) WHERE last < n)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_words, count(r.doc_id) AS n_chunks, coalesce(string_agg(first, ',' ORDER BY first), '') AS firsts FROM documents d LEFT JOIN run r USING (doc_id) GROUP BY d.doc_id""")
def chunk_pack(spark, d):
    rows = t(spark, d, "documents").withColumn("pieces", F.transform(N.word_tokens(F.col("text")), lambda w: F.ceil(F.length(w) / 4).cast("int")))
    starts = F.coalesce(N.chunk_starts(F.col("pieces"), 62, 2), F.array().cast("array<int>"))
    return rows.select("doc_id", F.greatest(F.size("pieces"), F.lit(0)).cast("long").alias("n_words"), F.size(starts).cast("long").alias("n_chunks"), F.array_join(starts.cast("array<string>"), ",").alias("firsts"))


@query("""SELECT o_orderkey, CASE WHEN k = 0 THEN '101,102' ELSE '101,' || list_aggregate(list_transform(range(1, least(2 * k, 8) + 1), lambda i: (((i + 1) // 2) * 10 + (i - 1) % 2)::VARCHAR), 'string_agg', ',') || ',102' END AS ids,
list_aggregate(list_transform(range(0, least(k, 4)), lambda i: (2 * i + 1)::VARCHAR), 'string_agg', ',') AS word_index FROM (SELECT o_orderkey, o_orderkey % 8 AS k FROM orders) WHERE k > 0""")
def encode_chunk(spark, d):
    rows = t(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 8).cast("int").alias("k")).filter("k > 0")
    words = F.transform(F.sequence(F.lit(1), F.col("k")), lambda i: F.array(i * 10, i * 10 + 1))
    made = rows.select("o_orderkey", N.encode_chunk(words, F.array_repeat(F.lit(1), F.col("k")), 101, 102, 10).alias("e"))
    return made.select("o_orderkey", F.array_join(F.col("e.input_ids").cast("array<string>"), ",").alias("ids"), F.array_join(F.col("e.word_index").cast("array<string>"), ",").alias("word_index"))


@query("SELECT o_orderkey, array_to_string([CASE WHEN k > 0 THEN 1 ELSE 9 END, CASE WHEN k > 1 THEN 2 ELSE 9 END, CASE WHEN k > 2 THEN 3 ELSE 9 END], ',') AS ids, array_to_string([(k > 0)::INT, (k > 1)::INT, (k > 2)::INT], ',') AS mask FROM (SELECT o_orderkey, o_orderkey % 5 AS k FROM orders)")
def pad_batch(spark, d):
    ids = F.slice(F.array(*map(F.lit, range(1, 5))), F.lit(1), (F.col("o_orderkey") % 5).cast("int"))
    return t(spark, d, "orders").select("o_orderkey", *[F.array_join(x.cast("array<string>"), ",").alias(n) for n, x in (("ids", N.pad(ids, F.lit(3), 9)), ("mask", N.attention(ids, F.lit(3))))])


# Fields


_PHONE = r"(?:^|[^\p{L}\p{N}_.])(?:\+?84|0)(?:[ .-]?[0-9]){8,10}(?:\b|[A-Za-z_])"


@query(f"""SELECT doc_id, coalesce(len(regexp_extract_all(text, '{_PHONE}')), 0)::BIGINT AS n FROM (SELECT doc_id, 'tel 0' || lpad((doc_id * 7919 % 1000000000)::VARCHAR, 9, '1') || ' / +84 ' || doc_id % 90 + 10 || ' 4148 44.9 x0' || doc_id || chr(10) || text AS text FROM documents)""")
def phone_count(spark, d):
    k = F.col("doc_id")
    tel = F.concat(F.lit("tel 0"), F.lpad((k * 7919 % 1000000000).cast("string"), 9, "1"), F.lit(" / +84 "), (k % 90 + 10).cast("string"), F.lit(" 4148 44.9 x0"), k.cast("string"), F.lit("\n"), F.coalesce("text"))
    from ..functions import fields

    return t(spark, d, "documents").select("doc_id", fields.count_fields(tel, "PHONE").alias("n"))


_COLORS = " ".join(f"WHEN 'Brand#{i}' THEN {zlib.crc32(f'Brand#{i}'.encode()) % 14}" for i in range(100))


@query(f"SELECT p_brand AS label, CASE p_brand {_COLORS} END AS color FROM part GROUP BY 1, 2")
def color_index(spark, d):
    return t(spark, d, "part").select(F.col("p_brand").alias("label")).distinct().select("label", T.color_index(F.col("label")).alias("color"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END::BIGINT AS n FROM orders")
def date_count(spark, d):
    from ..functions import fields

    day, k = F.date_format("o_orderdate", "MM/yyyy"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.concat(F.lit("since "), day, F.lit(" - now"))).when(k == 1, F.concat(day, F.lit("–"), day)).when(k == 2, F.concat(day, F.lit(", then "), day)).otherwise("12/34 and 1809, 21000")
    return t(spark, d, "orders").select("o_orderkey", fields.count_fields(text, "DATE").alias("n"))


# Headings of a user's dictionary


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'WARE' WHEN p_size % 3 = 1 THEN 'PRICE' END AS label FROM part")
def own_dictionary(spark, d):
    words = S.load_keywords({"WARE": ["Our Goods", "Göods"], "PRICE": ["what it costs"]}, spark)
    text = F.when(F.col("p_size") % 3 == 0, "GÖODS").when(F.col("p_size") % 3 == 1, "What it costs:").otherwise("Skills")
    return t(spark, d, "part").select("p_partkey", S.match_exact(T.fold(text), words).alias("label"))
