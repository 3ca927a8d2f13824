"""Operators on boxes of a page: containment, word assignment, lines, reading order.

Tables carry doc/page keys and explicit indexes, since list positions decide ties. ``keys`` names the page key columns.
Every join has an equality on the page, so it is a hash or merge join with a residual predicate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T


def remove_contained(regions: DataFrame, keys: Sequence[str], threshold: float = 0.85) -> DataFrame:
    """Drops a region that lies in a larger one of its label (among equals, in an earlier one); compared with all regions."""
    a, b = regions.alias("a"), regions.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "label"]]
    small, large = G.area(F.col("a.bbox")), G.area(F.col("b.bbox"))
    inside = (G.ioa(F.col("a.bbox"), F.col("b.bbox")) >= threshold) & ((large > small) | ((large == small) & (F.col("b.idx") < F.col("a.idx"))))
    on = same[0]
    for c in [*same[1:], F.col("a.idx") != F.col("b.idx"), inside]:
        on &= c
    return a.join(b, on, "left_anti")


def min_area(regions: DataFrame, page_area: Column, share: float = 1e-4) -> DataFrame:
    return regions.filter(G.area(F.col("bbox")) >= share * page_area)


def assign_words(words: DataFrame, regions: DataFrame, keys: Sequence[str], min_ioa: float = 0.5, tie_margin: float = 0.1) -> DataFrame:
    """words with the idx of their region: overlap by min_ioa, near the best overlap, then least area, then first."""
    w, r = words.alias("w"), regions.alias("r")
    on = F.col("r.bbox").isNotNull()
    for k in keys:
        on &= F.col(f"w.{k}") == F.col(f"r.{k}")
    share = G.ioa(F.col("w.bbox"), F.col("r.bbox"))
    pairs = w.join(r, on & (share >= min_ioa)).select("w.*", F.col("r.idx").alias("region_idx"), share.alias("_share"), G.area(F.col("r.bbox")).alias("_area"))
    each = Window.partitionBy(*keys, "word_idx")
    near = pairs.withColumn("_best", F.max("_share").over(each)).filter("_share >= _best - %r" % tie_margin)
    return near.withColumn("_n", F.row_number().over(each.orderBy("_area", "region_idx"))).filter("_n = 1").drop("_share", "_area", "_best", "_n")


def unassigned(words: DataFrame, assigned: DataFrame, keys: Sequence[str]) -> DataFrame:
    return words.join(assigned.select(*keys, "word_idx"), [*keys, "word_idx"], "left_anti")


def snap_boxes(regions: DataFrame, assigned: DataFrame, pages: DataFrame, keys: Sequence[str], pad: float = 4.0) -> DataFrame:
    """Regions shrunk or grown to their words' envelope plus a margin, clipped to the page; unchanged without words."""
    around = assigned.groupBy(*keys, F.col("region_idx").alias("idx")).agg(G.envelope(F.col("bbox")).alias("_env"))
    snapped = G.expand(F.col("_env"), pad, F.col("width"), F.col("height"))
    out = regions.join(around, [*keys, "idx"], "left").join(pages.select(*keys, "width", "height"), list(keys), "left")
    return out.withColumn("det_bbox", F.col("bbox")).withColumn("bbox", F.coalesce(F.when(F.col("_env").isNotNull(), snapped), F.col("bbox"))).drop("_env", "width", "height")


def cut_groups(boxes: DataFrame, keys: Sequence[str], low: Column, high: Column, gap: Column | float) -> DataFrame:
    """One cut along an axis: ``cut`` numbers the groups that gaps wider than ``gap`` part."""
    rows = boxes.withColumns({"_lo": low, "_hi": high})
    order = Window.partitionBy(*keys).orderBy("_lo", "_hi", "idx")
    reach = F.max("_hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.when(reach.isNull() | (F.col("_lo") > reach + gap), 1).otherwise(0))
    return rows.withColumn("cut", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_lo", "_hi", "_new")


# Recursive XY-cut, per page


def _cut(spans: np.ndarray, members: list[int], gap: float) -> list[list[int]]:
    order = sorted(members, key=lambda i: (spans[i, 0], spans[i, 1], i))
    groups, reach = [[order[0]]], spans[order[0], 1]
    for i in order[1:]:
        if spans[i, 0] > reach + gap:
            groups.append([i])
            reach = spans[i, 1]
        else:
            groups[-1].append(i)
            reach = max(reach, spans[i, 1])
    return groups


def xy_order(boxes: np.ndarray, width: float, height: float, columns_first: bool = True, gap_share: float = 0.005, shrink: float = 0.03, max_depth: int = 64) -> list[int]:
    """Positions of the boxes in reading order.

    An explicit stack stands in for recursion. Boxes are shrunk before they are projected, so slight overlaps don't
    hide a gap. With columns first, neighbouring bands of a row cut that each hold several columns are read as one.
    """
    inner = (boxes[:, [2, 3]] - boxes[:, [0, 1]]) * shrink
    spans = [np.stack([boxes[:, a] + inner[:, a], boxes[:, a + 2] - inner[:, a]], axis=1) for a in (0, 1)]
    gaps = (gap_share * width, gap_share * height)
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(boxes))), 0)] if len(boxes) else []
    while stack:
        members, depth = stack.pop()
        groups: list[list[int]] = []
        if len(members) > 1 and depth <= max_depth:
            for axis in (0, 1) if columns_first else (1, 0):
                groups = _cut(spans[axis], members, gaps[axis])
                if len(groups) > 1:
                    if axis == 1 and columns_first:
                        wide = [len(g) > 1 and len(_cut(spans[0], g, gaps[0])) > 1 for g in groups]
                        bands: list[list[int]] = []
                        for i, g in enumerate(groups):
                            if i and wide[i] and wide[i - 1]:
                                bands[-1] = bands[-1] + g
                            else:
                                bands.append(list(g))
                        groups = bands if len(bands) > 1 else groups
                    break
        if len(groups) > 1:
            stack.extend((g, depth + 1) for g in reversed(groups))
        else:
            out += sorted(members, key=lambda i: (boxes[i, 1], boxes[i, 0]))
    return out


def _corners(pdf: pd.DataFrame) -> np.ndarray:
    return np.array([[b["x0"], b["y0"], b["x1"], b["y1"]] for b in pdf["bbox"]], float).reshape(-1, 4)


def per_group(df: DataFrame, keys: Sequence[str], order: str, extra: str, work: Callable[[pd.DataFrame], dict[str, list]]) -> DataFrame:
    """Adds the columns of ``extra``, which ``work`` gives for each group's rows in order.

    Groups come in sorted batches rather than one call each, as most groups are small.
    """
    keys, names = list(keys), df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(rows: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
            made: dict[str, list] = {}
            for i, j in zip(starts, [*starts[1:], len(rows)], strict=True):
                for c, values in work(rows.iloc[i:j]).items():
                    made.setdefault(c, []).extend(values)
            return rows[names].assign(**made)

        held = None
        for b in batches:
            rows = b if held is None else pd.concat([held, b], ignore_index=True)
            if not len(rows):
                continue
            starts = np.flatnonzero((rows[keys] != rows[keys].shift()).any(axis=1).to_numpy()).tolist()
            last = starts.pop()
            if starts:
                yield done(rows.iloc[:last], starts)
            held = rows.iloc[last:].reset_index(drop=True)
        if held is not None:
            yield done(held, [0])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", " + extra
    return df.repartition(*keys).sortWithinPartitions(*keys, order).mapInPandas(run, schema)


def reading_order(regions: DataFrame, keys: Sequence[str], columns_first: bool = True) -> DataFrame:
    """regions (with width, height of the page) with ord, their place in reading order."""

    def work(pdf: pd.DataFrame) -> dict[str, list]:
        order = xy_order(_corners(pdf), float(pdf["width"].iloc[0]), float(pdf["height"].iloc[0]), columns_first)
        return {"ord": np.argsort(np.array(order, int)).tolist()}

    return per_group(regions, keys, "idx", "ord int", work)


def line_groups(boxes: np.ndarray, y_overlap: float = 0.5, look_back: int = 4) -> list[list[int]]:
    """Words of one line each: a word joins the newest of the last few lines that it overlaps enough in height."""
    lines: list[list[int]] = []
    tops: list[float] = []
    bottoms: list[float] = []
    for i in sorted(range(len(boxes)), key=lambda i: ((boxes[i, 1] + boxes[i, 3]) / 2, boxes[i, 0])):
        top, bottom = boxes[i, 1], boxes[i, 3]
        for g in range(len(lines) - 1, max(-1, len(lines) - 1 - look_back), -1):
            shared = min(bottoms[g], bottom) - max(tops[g], top)
            if shared > 0 and shared >= y_overlap * min(bottom - top, bottoms[g] - tops[g]):
                lines[g].append(i)
                tops[g], bottoms[g] = min(tops[g], top), max(bottoms[g], bottom)
                break
        else:
            lines.append([i])
            tops.append(top)
            bottoms.append(bottom)
    return [sorted(g, key=lambda i: boxes[i, 0]) for g in lines]


def build_lines(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines of a region's words: keys, line_idx, text (cleaned), bbox, conf; lines without text are left out."""
    grouped = per_group(words, keys, "word_idx", "_line int, _place int", _place_words)
    lines = grouped.groupBy(*keys, "_line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", "text"))), lambda x: x["text"]), " ").alias("text"), G.envelope(F.col("bbox")).alias("bbox"), F.avg("conf").alias("conf"))
    lines = lines.withColumn("text", T.clean_line(F.col("text"))).filter(~F.col("text").isin("", "-"))
    order = Window.partitionBy(*keys).orderBy("bbox.y0", "bbox.x0", "_line")
    return lines.withColumn("line_idx", F.row_number().over(order) - 1).drop("_line")


def _place_words(pdf: pd.DataFrame) -> dict[str, list]:
    line, place = [0] * len(pdf), [0] * len(pdf)
    for g, members in enumerate(line_groups(_corners(pdf))):
        for n, i in enumerate(members):
            line[i], place[i] = g, n
    return {"_line": line, "_place": place}


def merge_same_row(lines: DataFrame, keys: Sequence[str], max_gap: float = 6.0) -> DataFrame:
    """Neighbouring pieces of one visual line become one: ``piece_of`` is the idx of the first piece; then aggregated."""

    def work(pdf: pd.DataFrame) -> dict[str, list]:
        b = _corners(pdf)
        idx, first = pdf["idx"].tolist(), [0] * len(pdf)
        place, open_box, owner, n = [0] * len(pdf), None, 0, 0
        for i in sorted(range(len(b)), key=lambda i: (round(b[i, 1]), b[i, 0])):
            if open_box is not None and abs(open_box[1] - b[i, 1]) < 2 and abs(open_box[3] - b[i, 3]) < 2 and 0 <= b[i, 0] - open_box[2] < max_gap:
                open_box = (open_box[0], min(open_box[1], b[i, 1]), b[i, 2], max(open_box[3], b[i, 3]))
            else:
                open_box, owner = tuple(b[i]), idx[i]
            first[i], place[i], n = owner, n, n + 1
        return {"piece_of": first, "_place": place}

    pieces = per_group(lines, keys, "idx", "piece_of long, _place int", work)
    last = F.max_by(F.col("bbox.x1"), F.col("_place"))
    merged = pieces.groupBy(*keys, "piece_of").agg(
        F.min("_place").alias("_at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", "text"))), lambda x: x["text"]), " ").alias("text"),
        F.struct(F.min_by(F.col("bbox.x0"), F.col("_place")).alias("x0"), F.min("bbox.y0").alias("y0"), last.alias("x1"), F.max("bbox.y1").alias("y1")).alias("bbox"),
        F.max("size").alias("size"), F.bool_and("bold").alias("bold"), F.count(F.lit(1)).alias("pieces"),
    )
    return merged.withColumn("idx", F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1).drop("_at")


def column_split(lines: DataFrame, keys: Sequence[str], width: float | str, min_gap: float = 0.25) -> DataFrame:
    """keys and split: the leftmost whole x that fewest lines cross, where both columns are real; pages without one are absent.

    width: of all pages, or the column that holds it. Crossings only fall where a line ends, so the middle part's first x
    and the lines' right ends are all that can be the leftmost best.
    """
    wide = F.max(width) if isinstance(width, str) else F.max(F.lit(width))
    pages = lines.groupBy(*keys).agg(F.collect_list(F.struct(F.col("bbox.x0").alias("a"), F.col("bbox.x1").alias("z"))).alias("b"), wide.alias("w"))
    low, high = F.floor(F.col("w") * min_gap).cast("long"), F.floor(F.col("w") * (1 - min_gap)).cast("long")
    ends = F.transform("b", lambda x: F.ceil(x["z"]).cast("long"))
    pages = pages.withColumn("xs", F.array_distinct(F.concat(F.array(low), F.filter(ends, lambda x: (x > low) & (x < high)))))
    count = lambda test: F.size(F.filter("b", test)).cast("long")
    tried = F.transform("xs", lambda x: F.struct(
        count(lambda v: (v["a"] < x) & (x < v["z"])).alias("crossings"), x.alias("split"), count(lambda v: v["z"] <= x).alias("left"), count(lambda v: v["a"] >= x).alias("right")
    ))
    best = pages.select(*keys, F.size("b").alias("n"), F.array_min(tried).alias("t")).select(*keys, "n", "t.*")
    real = (F.col("crossings") < F.col("n")) & (F.least("left", "right") >= 3) & (F.col("crossings") <= 0.15 * F.col("n"))
    return best.filter(real).select(*keys, "split", "crossings")


def band_order(lines: DataFrame, splits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """lines with col (0 full width or no split, 1 left, 2 right) and ord: bands between full-width lines, left before right."""
    rows = lines.join(splits.select(*keys, "split"), list(keys), "left")
    full = (F.col("bbox.x0") < F.col("split")) & (F.col("split") < F.col("bbox.x1"))
    rows = rows.withColumn("_full", F.when(F.coalesce(full, F.lit(False)), 1).otherwise(0))
    rows = rows.withColumn("col", F.when(F.col("split").isNull() | (F.col("_full") == 1), 0).when(F.col("bbox.x1") <= F.col("split"), 1).otherwise(2))
    down = Window.partitionBy(*keys).orderBy("bbox.y0", "bbox.x0", "idx")
    rows = rows.withColumn("_band", F.coalesce(F.sum("_full").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("_down", F.row_number().over(down))
    order = Window.partitionBy(*keys).orderBy("_band", F.when(F.col("_full") == 1, 3).otherwise(F.col("col")), "_down")
    return rows.withColumn("ord", F.row_number().over(order) - 1).drop("_full", "_band", "_down", "split")


def side_headings(lines: DataFrame, doc: Sequence[str]) -> DataFrame:
    """Pages whose left column is mostly headings (is_heading) are read row by row: ord and col anew."""
    page = Window.partitionBy(*doc, "page")
    left = F.when(F.col("col") == 1, 1).otherwise(0)
    heads = F.sum(F.when((F.col("col") == 1) & F.col("is_heading"), 1).otherwise(0)).over(page)
    rows = lines.withColumn("_side", (heads >= 2) & (heads >= 0.4 * F.sum(left).over(page)))
    lifted = F.when(F.col("_side"), F.col("bbox.y0") - F.when(F.col("col") == 1, 6).otherwise(0))
    order = Window.partitionBy(*doc).orderBy("page", lifted, F.when(F.col("_side"), F.col("bbox.x0")), "ord")
    return rows.withColumn("ord", F.row_number().over(order) - 1).withColumn("col", F.when(F.col("_side"), 0).otherwise(F.col("col"))).drop("_side")
