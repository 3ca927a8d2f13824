"""Sinks: text forms of results as columns, to be written by Spark's own writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators.sections import rounded_box


def in_order(columns: Sequence[str | Column], *order: str) -> Column:
    """Aggregate: structs of the columns as an array, by the order columns."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.struct(*columns).alias("_v"))))
    return F.transform(rows, lambda x: x["_v"])


def _round4(name: str) -> Column:
    return F.bround(name, 4).alias(name)


def result_json(docs: DataFrame, pages: DataFrame, regions: DataFrame, sections: DataFrame, lines: DataFrame | None, doc: str) -> DataFrame:
    """doc and value: one JSON object per document of docs (doc, source, model).

    pages: doc, index, width, height, has_text_layer; regions: doc, ord, page, label, score, bbox, det_bbox, source, text;
    sections: doc, section_id, label, pages, score, source, region_orders, text; lines: doc, ord, idx, text, bbox, conf of
    regions, or None to leave lines out. Scores have four decimals, confidences three, boxes one.
    """
    corners = lambda b: F.array(*[rounded_box(F.col(b))[c] for c in ("x0", "y0", "x1", "y1")])
    own = ["order", "page", "label", "score", "bbox", "det_bbox", "source", "text"]
    if lines is not None:
        line = ["text", corners("bbox").alias("bbox"), F.bround("conf", 3).alias("conf")]
        regions = regions.join(lines.groupBy(doc, "ord").agg(in_order(line, "idx").alias("lines")), [doc, "ord"], "left")
        regions, own = regions.withColumn("lines", F.coalesce("lines", F.array().cast("array<struct<text:string,bbox:array<double>,conf:double>>"))), [*own, "lines"]
    regions = regions.withColumns({"order": F.col("ord"), "score": F.bround("score", 4), "bbox": corners("bbox"), "det_bbox": corners("det_bbox")})
    section = [F.col("section_id").alias("id"), "label", "pages", _round4("score"), "source", "region_orders", "text"]
    parts = {
        "pages": pages.groupBy(doc).agg(in_order(["index", "width", "height", "has_text_layer"], "index").alias("pages")),
        "sections": sections.groupBy(doc).agg(in_order(section, "section_id").alias("sections")),
        "regions": regions.groupBy(doc).agg(in_order(own, "ord").alias("regions")),
    }
    out = docs
    for name, part in parts.items():
        out = out.join(part, doc, "left").withColumn(name, F.coalesce(name, F.array().cast(dict(part.dtypes)[name])))
    whole = F.struct("source", "model", F.size("pages").alias("num_pages"), "pages", "sections", "regions")
    return out.select(doc, F.to_json(whole, {"ignoreNullFields": "false"}).alias("value"))


def _broken(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("  \n"))


def result_markdown(sections: DataFrame, leftover: DataFrame, doc: str) -> DataFrame:
    """doc and value: sections (doc, section_id, label, pages, score, source, text) in order, then what no region holds.

    leftover: doc, ord, page, text of regions that are unassigned and have lines.
    """
    pages = F.array_join(F.transform("pages", lambda p: (p + 1).cast("string")), ", ")
    head = F.format_string(K.MARKDOWN_HEAD, F.col("section_id").cast("long"), F.col("label"), pages, F.bround("score", 2), F.col("source"))
    body = F.when(F.coalesce("text", F.lit("")) == "", K.MARKDOWN_EMPTY).otherwise(_broken(F.col("text")))
    blocks = sections.groupBy(doc).agg(in_order([F.concat(head, F.lit("\n"), F.lit("\n"), body, F.lit("\n")).alias("b")], "section_id").alias("_s"))
    rest = F.concat(F.format_string(K.MARKDOWN_PAGE, (F.col("page") + 1).cast("long")), _broken(F.col("text")))
    others = leftover.groupBy(doc).agg(in_order([rest.alias("b")], "ord").alias("_r"))
    joined = blocks.join(others, doc, "full")
    parts = F.concat(
        F.coalesce(F.transform("_s", lambda x: x["b"]), F.array().cast("array<string>")),
        F.when(F.col("_r").isNotNull(), F.concat(F.array(F.lit(K.MARKDOWN_REST)), F.transform("_r", lambda x: x["b"]))).otherwise(F.array().cast("array<string>")),
    )
    return joined.select(doc, F.array_join(parts, "\n").alias("value"))


def sections_jsonl(sections: DataFrame, doc: str) -> DataFrame:
    """doc and value: a JSON line per document with its sections in order: {"cv": ..., "sections": [...]}."""
    bbox = F.when(F.col("bbox").isNotNull(), F.array(*[F.col("bbox")[c] for c in ("x0", "y0", "x1", "y1")])).alias("bbox")
    rows = sections.groupBy(doc).agg(in_order(["section_label", "heading_text", "source", "page", "text", bbox], "section_id").alias("sections"))
    return rows.select(doc, F.to_json(F.struct(F.col(doc).alias("cv"), "sections"), {"ignoreNullFields": "false"}).alias("value"))


def tagging_tasks(sections: DataFrame, doc: str) -> DataFrame:
    """doc, section_id and value: one JSON task per section with text."""
    kept = sections.filter(F.regexp_replace("text", r"(?U)\s", "") != "")
    data = F.struct(F.col(doc).alias("cv"), F.col("section_label").alias("section"), "page", "text")
    return kept.select(doc, "section_id", F.to_json(F.struct(data.alias("data"))).alias("value"))


def yolo_line(class_id: Column, box: Column) -> Column:
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id, *[F.bround(box[c], 6) for c in ("cx", "cy", "w", "h")])


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select("value").write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


def rename_log(renames: DataFrame, at: Column | None = None) -> DataFrame:
    """time, old, new of planned renames (name, new_name)."""
    time = F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss")
    return renames.select(time.alias("time"), F.col("name").alias("old"), F.col("new_name").alias("new"))


def append_log(renames: DataFrame, path: str) -> None:
    """Appends to the log of renames: rows without headers, as the log is a folder of part files; ``read_log`` names them."""
    rename_log(renames).write.mode("append").csv(path, header=False)


def read_log(spark, path: str) -> DataFrame:  # noqa: ANN001
    return spark.read.schema("time string, old string, new string").csv(path)
