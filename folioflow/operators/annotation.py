"""Annotation exports and pre-annotations."""

from __future__ import annotations

from collections.abc import Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import geometry as G
from ..functions import text as T

BOX_TASK = "id bigint, annotations array<struct<was_cancelled:boolean,created_at:string,updated_at:string,result:array<struct<type:string,item_index:int,value:struct<x:double,y:double,width:double,height:double,rotation:double,rectanglelabels:array<string>>>>>>"
TEXT_TASK = "id bigint, data struct<cv:string,section:string,text:string>, annotations array<struct<was_cancelled:boolean,result:array<struct<type:string,value:struct<start:int,`end`:int,labels:array<string>>>>>>"


def live(annotations: Column) -> Column:
    return F.filter(annotations, lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False)))


def newest(annotations: Column) -> Column:
    """The annotation changed last (by text of updated_at, else created_at), the first on ties; null without any."""
    stamp = lambda a: F.coalesce(F.nullif(a["updated_at"], F.lit("")), F.nullif(a["created_at"], F.lit("")), F.lit(""))
    kept = live(annotations)
    top = F.array_max(F.transform(kept, stamp))
    return F.get(F.filter(kept, lambda a: stamp(a) == top), F.lit(0))


def last_listed(annotations: Column) -> Column:
    """The other rule, of text tasks: the last that isn't cancelled."""
    return F.try_element_at(live(annotations), F.lit(-1))


def task_boxes(tasks: DataFrame, classes: dict[str, int]) -> DataFrame:
    """One row per annotated box: task id, item_index, class_id (null if unknown), rotated, yolo (null if dropped)."""
    r = tasks.select("id", F.explode(newest(F.col("annotations"))["result"]).alias("r"))
    v, ids = F.col("r.value"), F.create_map(*[F.lit(x) for name, i in classes.items() for x in (name, i)])
    label = F.get(v["rectanglelabels"], F.lit(0))
    rows = r.filter(v["rectanglelabels"].isNotNull() & (F.size(v["rectanglelabels"]) > 0))
    return rows.select("id", F.coalesce("r.item_index", F.lit(0)).alias("item_index"), label.alias("label"), F.try_element_at(ids, label).alias("class_id"), (F.coalesce(v["rotation"], F.lit(0.0)) != 0).alias("rotated"), G.percent_to_center(v["x"], v["y"], v["width"], v["height"]).alias("yolo"))


def box_counters(boxes: DataFrame) -> DataFrame:
    return boxes.agg(F.count_if(F.col("class_id").isNull()).alias("unknown"), F.count_if(F.col("class_id").isNotNull() & F.col("yolo").isNull()).alias("dropped"), F.count_if(F.col("rotated")).alias("rotated"), F.count_if(F.col("class_id").isNotNull() & F.col("yolo").isNotNull()).alias("written"))


def page_urls(data: Column, key: str | None = None) -> Column:
    """URLs of a task's pages, from a map of fields (JSON texts).

    The named field, as a list or one text; else the first list that begins with a text; else the first text that names an
    image or lies under /data/; null where there is none.
    """
    texts = lambda v: F.when(v.rlike(r"^\s*\["), F.from_json(v, "array<string>")).when(v.isNotNull(), F.array(v))
    if key is not None:
        return texts(F.try_element_at(data, F.lit(key)))
    values = F.map_values(data)
    lists = F.filter(values, lambda v: v.rlike(r'^\s*\[\s*"'))
    image = "(?i)\\.(" + "|".join(K.IMAGE_EXTENSIONS) + ")$"
    single = F.filter(values, lambda v: ~v.rlike(r"^\s*[\[{]") & (T.url_file(v).rlike(image) | F.contains(v, F.lit("/data/"))))
    return F.when(F.size(lists) > 0, F.from_json(F.get(lists, F.lit(0)), "array<string>")).when(F.size(single) > 0, F.array(F.get(single, F.lit(0))))


def resolve(urls: DataFrame, files: DataFrame) -> DataFrame:
    """url with path: by file name, then by the name without its upload hash; null when missing. The last path of a name counts."""
    index = files.groupBy("name").agg(F.max_by("path", "idx").alias("path"))
    named = urls.withColumns({"_a": T.url_file(F.col("url")), "_b": T.url_file_unhashed(F.col("url"))})
    one, two = index.select(F.col("name").alias("_a"), F.col("path").alias("_pa")), index.select(F.col("name").alias("_b"), F.col("path").alias("_pb"))
    return named.join(one, "_a", "left").join(two, "_b", "left").withColumn("path", F.coalesce("_pa", "_pb")).drop("_a", "_b", "_pa", "_pb")


def without_labelled(groups: DataFrame, labelled: DataFrame, key: str) -> DataFrame:
    return groups.join(labelled.select(key).distinct(), key, "left_anti")


def allowed_only(dets: DataFrame, allowed: Sequence[str], label_map: dict[str, str] | None = None) -> DataFrame:
    """Detections whose (mapped) label is in the list; an empty list allows all."""
    if label_map:
        to = F.create_map(*[F.lit(x) for kv in label_map.items() for x in kv])
        dets = dets.withColumn("label", F.coalesce(F.try_element_at(to, F.col("label")), F.col("label")))
    return dets.filter(F.col("label").isin(list(allowed))) if allowed else dets


def to_results(dets: DataFrame) -> DataFrame:
    """Detections (label, bbox, score, width, height) as percent values; clipped, inverted boxes dropped."""
    return dets.withColumn("value", G.pixels_to_percent(F.col("bbox"), F.col("width"), F.col("height"))).filter("value IS NOT NULL")


def task_scores(tasks: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """key, score: the mean score of a task's boxes to four decimals, 0 without any."""
    means = results.groupBy(key).agg(F.bround(F.avg("score"), 4).alias("score"))
    return tasks.select(key).distinct().join(means, key, "left").na.fill(0.0, ["score"])


def least_confident_first(scores: DataFrame, key: str) -> DataFrame:
    """scores with rank (from 1): the order in which tasks are to be labelled, ties by key."""
    from .hygiene import number_rows

    return number_rows(scores, [F.col("score"), F.col(key)], "rank")


def prediction_tasks(pages: DataFrame, results: DataFrame, key: str, version: str, config: dict[str, str | bool]) -> DataFrame:
    """key and value: one JSON task per key, with the URLs of its pages and its predictions in order.

    pages: key, item_index, url; results: key, item_index, idx, label, score, width, height, value (percent).
    config: from_name, to_name, value_key, multipage of the labelling configuration.
    """
    many, names = bool(config["multipage"]), [F.lit(config[n]).alias(n) for n in ("from_name", "to_name")]
    value = F.struct("value.*", F.lit(0).alias("rotation"), F.array("label").alias("rectanglelabels"))
    item = F.struct(
        F.substring(F.sha2(F.concat_ws(":", F.col(key).cast("string"), "item_index", "idx"), 256), 1, 10).alias("id"), *names, F.lit("rectanglelabels").alias("type"),
        F.col("width").alias("original_width"), F.col("height").alias("original_height"), F.lit(0).alias("image_rotation"),
        value.alias("value"), F.bround("score", 4).alias("score"), *(["item_index"] if many else []),
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("item_index", "idx", item.alias("r")))), lambda x: x["r"])
    found = results.groupBy(key).agg(ordered.alias("result"), F.bround(F.avg("score"), 4).alias("score"))
    urls = F.transform(F.array_sort(F.collect_list(F.struct("item_index", "url"))), lambda x: x["url"])
    tasks = pages.groupBy(key).agg(urls.alias("urls")).join(found, key, "left")
    data = F.struct((F.col("urls") if many else F.get("urls", F.lit(0))).alias(str(config["value_key"])), F.col(key).alias("cv_name"))
    none = F.array().cast(dict(found.dtypes)["result"])
    body = F.struct(F.lit(version).alias("model_version"), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("result", none).alias("result"))
    return tasks.select(key, F.to_json(F.struct(data.alias("data"), F.array(body).alias("predictions"))).alias("value"))


def first_pages(files: DataFrame, key: str = "group") -> DataFrame:
    """key, page, path: of several files of one page the first (by idx); pages in order make a task."""
    return files.groupBy(key, "page").agg(F.min_by("path", "idx").alias("path"))


def missing_labels(model: DataFrame, mapped: DataFrame, config: DataFrame) -> DataFrame:
    """Labels (column label) of a model that neither a label map nor the labelling configuration knows."""
    return model.select("label").subtract(mapped.select("label").union(config.select("label")))


def build_label_config(classes: Sequence[str], multipage: bool = True, name: str = "label", to: str = "page", value: str = "pages") -> str:
    """The labelling configuration as XML, names quoted as attributes."""
    q = quoteattr
    source = f"{'valueList' if multipage else 'value'}={q('$' + value)}"
    labels = "".join(f"<Label value={q(c)}/>" for c in classes)
    return f"<View><Image name={q(to)} {source}/><RectangleLabels name={q(name)} toName={q(to)}>{labels}</RectangleLabels></View>"


def read_label_config(xml: str) -> dict[str, str | bool | list[str] | None]:
    """from_name, to_name, value_key, multipage and labels of one labelling configuration; wrong ones are errors."""
    root = ElementTree.fromstring(xml)
    rect = next(root.iter("RectangleLabels"), None)
    if rect is None:
        raise ValueError("the labelling configuration has no RectangleLabels")
    to = rect.get("toName", "").split(",")[0].strip()
    image = next((e for e in root.iter("Image") if e.get("name") == to), None)
    if image is None:
        raise ValueError(f"no Image is named {to}")
    many = image.get("valueList")
    labels = [v for e in rect.iter("Label") if (v := e.get("value"))]
    return {"from_name": rect.get("name"), "to_name": to, "value_key": (many or image.get("value") or "").lstrip("$"), "multipage": bool(many), "labels": labels}


def parse_label_config(xml: Column) -> Column:
    """from_name, to_name, value key, multipage and labels of a labelling configuration; null for null.

    One without RectangleLabels, or whose image it doesn't name, is an error. Rows share few configurations: each is parsed once a batch.
    """

    @F.arrow_udf(_CONFIG)
    def run(texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()
        return pa.array([read_label_config(x) for x in coded.dictionary.to_pylist()], _ARROW_CONFIG).take(coded.indices)

    return run(xml)


_CONFIG = "struct<from_name:string,to_name:string,value_key:string,multipage:boolean,labels:array<string>>"
_ARROW_CONFIG = pa.struct([("from_name", pa.string()), ("to_name", pa.string()), ("value_key", pa.string()), ("multipage", pa.bool_()), ("labels", pa.list_(pa.string()))])


def model_compare(regions: DataFrame, sections: DataFrame, leftover: DataFrame) -> DataFrame:
    """Per model: regions, sections, mean score, unassigned words."""
    a = regions.groupBy("model").agg(F.count(F.lit(1)).alias("n_regions"), F.avg("score").alias("mean_score"))
    b = sections.groupBy("model").agg(F.count(F.lit(1)).alias("n_sections"))
    c = leftover.groupBy("model").agg(F.count(F.lit(1)).alias("n_unassigned"))
    return a.join(b, "model", "left").join(c, "model", "left").na.fill(0)


def pivot_metrics(metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """class and a column of ap50_95 per model; null where a model has no value."""
    return metrics.groupBy("class").agg(*[F.max(F.when(F.col("model") == m, F.col("ap50_95"))).alias(m) for m in models])
