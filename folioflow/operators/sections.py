"""From ordered lines and regions to labelled sections."""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import constants as K
from ..functions import fields as R
from ..functions import geometry as G
from ..functions import text as T
from .layout import per_group, side_headings

#: (folded heading, label), in the order that decides ties.
Keywords = Sequence[tuple[str, str]]


def strip_headers_footers(lines: DataFrame, pages: DataFrame, doc: Sequence[str], margin: float = 0.07) -> DataFrame:
    """Drops page numbers, and lines that most pages repeat, where they stand in a page's upper or lower margin.

    lines: doc, page, text, bbox; pages: doc, page, height. Pages without lines count as pages.
    """
    keyed = lines.withColumn("_k", T.margin_key(F.col("text"))).join(pages.select(*doc, "page", F.col("height").alias("_h")), [*doc, "page"], "left")
    in_margin = F.coalesce((F.col("bbox.y1") <= margin * F.col("_h")) | (F.col("bbox.y0") >= (1 - margin) * F.col("_h")), F.lit(False))
    keyed = keyed.withColumn("_m", in_margin)
    n_pages = pages.groupBy(*doc).agg(F.countDistinct("page").alias("_n"))
    counts = keyed.filter("_m").groupBy(*doc, "_k").agg(F.countDistinct("page").alias("_c")).join(n_pages, list(doc))
    repeated = counts.filter((F.col("_n") >= 2) & (F.col("_c") >= F.greatest(F.lit(2), F.ceil(F.lit(0.6) * F.col("_n"))))).select(*doc, "_k", F.lit(True).alias("_r"))
    out = keyed.join(repeated, [*doc, "_k"], "left")
    return out.filter(~(F.col("_m") & (F.coalesce("_r", F.lit(False)) | T.is_page_number(F.col("text"))))).select(*lines.columns)


def islands(df: DataFrame, part: Sequence[str], order: Sequence[str], starts: Column, into: str) -> DataFrame:
    """Numbers runs from 0; ``starts`` is true on a run's first row (null counts as true)."""
    w = Window.partitionBy(*part).orderBy(*order)
    rows = df.withColumn("_s", F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0))
    return rows.withColumn(into, F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_s")


def merge_sections(regions: DataFrame, doc: Sequence[str], same_page: bool = True, cross_page: bool = True) -> DataFrame:
    """regions (doc, ord, page, label, has_lines) without UNASSIGNED, with section_id: neighbours of one label join."""
    w = Window.partitionBy(*doc).orderBy("ord")
    before = lambda c: F.lag(c).over(w)
    near = (F.lit(same_page) & (F.col("page") == before("page"))) | (F.lit(cross_page) & (F.col("page") == before("page") + 1))
    joins = (F.col("label") == before("label")) & F.col("has_lines") & before("has_lines") & near
    return islands(regions.filter("label <> 'UNASSIGNED'"), doc, ["ord"], ~joins, "section_id")


def section_summary(parts: DataFrame, doc: Sequence[str]) -> DataFrame:
    """One row per section: label, pages, best score, sources."""
    return parts.groupBy(*doc, "section_id").agg(
        F.first("label").alias("label"), F.array_sort(F.collect_set("page")).alias("pages"), F.max("score").alias("score"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("source") != "", F.col("source")))), ",").alias("source"), F.count(F.lit(1)).alias("n_parts"),
    )


def body_size(lines: DataFrame, doc: Sequence[str]) -> DataFrame:
    """The font size (one decimal) with the most characters; the first seen on ties."""
    sums = lines.groupBy(*doc, F.bround("size", 1).alias("body")).agg(F.sum(F.length("text")).alias("n"), F.min("ord").alias("first"))
    best = Window.partitionBy(*doc).orderBy(F.desc("n"), "first")
    return sums.withColumn("_k", F.row_number().over(best)).filter("_k = 1").select(*doc, "body")


def looks_like_heading(text: Column, size: Column, bold: Column, body: Column) -> Column:
    words = T.tokens(text)
    n = F.when(T.letter_spaced(text), 1 + F.regexp_count(text, F.lit("  "))).otherwise(F.size(words))
    shaped = (F.size(words) > 0) & (n <= K.HEADING_MAX_WORDS) & ~F.rtrim(text).rlike("[.,;]$") & text.rlike(r"\p{L}")
    return shaped & ((size > body + K.HEADING_SIZE_MARGIN) | bold | T.is_upper(text))


def load_keywords(labels: dict[str, Sequence[str]], spark: SparkSession) -> Keywords:
    """A user's dictionary (label -> headings, in order), folded as texts are."""
    rows = [(i, k, label) for i, (k, label) in enumerate((k, label) for label, ks in labels.items() for k in ks)]
    folded = spark.createDataFrame(rows, "i int, k string, label string").select("i", T.fold(F.col("k")).alias("k"), "label")
    return [(r["k"], r["label"]) for r in folded.orderBy("i").collect()]  # as many rows as the dictionary has


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a column that is computed, and named in the plan, once, however often f uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def whole_keyword(keywords: Keywords) -> str:
    """A pattern of any keyword as whole words, keywords of one first letter together."""
    by_first: dict[str, list[str]] = {}
    for k, _ in keywords:
        by_first.setdefault(k[:1], []).append(re.escape(k[1:]))
    return "(?:^| )(?:%s)(?: |\\z)" % "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in by_first.items())


def match_exact(folded: Column, keywords: Keywords = K.KEYWORDS) -> Column:
    """The label by whole keywords, NULL if none is accepted; the keywords are literals, so no join is needed."""
    compact = F.create_map(*[F.lit(x) for k, label in {k.replace(" ", ""): lab for k, lab in reversed(keywords)}.items() for x in (k, label)])

    def accepted(t: Column, hits: Column) -> Column:
        best, words = F.array_min(hits), T.tokens(t)
        starts = (best["at"] == 1) & (F.size(words) <= F.size(T.tokens(best["k"])) + 2)
        covered = F.concat(F.flatten(F.transform(hits, lambda h: F.split(h["k"], " "))), F.array(*map(F.lit, K.CONNECTORS)))
        return F.when(starts | (F.size(F.array_except(words, covered)) == 0), best["label"])

    def whole(t: Column) -> Column:
        places = lambda p: F.array(*[F.struct(F.locate(f" {k} ", p).alias("at"), F.lit(-len(k)).alias("n"), F.lit(k).alias("k"), F.lit(label).alias("label")) for k, label in keywords])
        hits = once(F.concat(F.lit(" "), t, F.lit(" ")), lambda p: F.filter(places(p), lambda h: h["at"] > 0))
        return F.when(t.rlike(whole_keyword(keywords)), once(hits, lambda h: accepted(t, h)))

    def spaced(t: Column) -> Column:
        glued = F.try_element_at(compact, F.replace(t, F.lit(" "), F.lit("")))
        return once(glued, lambda label: F.when(label.isNotNull(), F.when(T.letter_spaced(t), label)))

    return once(folded, lambda t: F.when(t != "", F.coalesce(spaced(t), whole(t))))


def keyword_free(folded: Column, most: int, keywords: Keywords = K.KEYWORDS) -> Column:
    """The text if it has one to ``most`` characters and no keyword as whole words, else an empty one."""
    return F.regexp_extract(folded, rf"(?s)^(?=.{{1,{most}}}\z)(?!.*{whole_keyword(keywords)}).*\z", 0)


def closest_keyword(t: str, least: float = K.HEADING_FUZZY_RATIO, keywords: Keywords = K.KEYWORDS) -> str | None:
    """The label of the most similar keyword (Ratcliff-Obershelp), if similar enough; the first on ties.

    A ratio is at most that of the shorter text's length, and of the characters in common; a keyword that can't reach ``least`` so isn't compared.
    """
    top, best = 0.0, None
    for k, label in keywords:
        n = len(t) + len(k)
        if n and 2.0 * min(len(t), len(k)) / n < least:
            continue
        pair = difflib.SequenceMatcher(None, t, k)
        if pair.quick_ratio() >= least and (ratio := pair.ratio()) >= least and (best is None or ratio > top):
            top, best = ratio, label
    return best


def match_fuzzy(folded: Column, keywords: Keywords = K.KEYWORDS) -> Column:
    @F.pandas_udf(StringType())
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(lambda t: closest_keyword(t, keywords=keywords) if t else None).astype(object)

    return run(folded)


def match_label(folded: Column, keywords: Keywords = K.KEYWORDS) -> Column:
    """Exact keywords first; only a text without any keyword is compared by similarity, and no text that is too long for it.

    Over an aggregate, Spark carries a copy of the text past the Python worker for each time that the expression names it.
    """
    longest = max((len(k) for k, _ in keywords), default=0)
    most = int(longest * (2 / K.HEADING_FUZZY_RATIO - 1)) + 1
    return F.coalesce(match_exact(folded, keywords), match_fuzzy(keyword_free(folded, most, keywords), keywords))


def style(text: Column, size: Column, bold: Column) -> Column:
    return F.struct(F.bround(size).cast("int").alias("size"), bold.alias("bold"), T.is_upper(text).alias("upper"))


def style_vote(cands: DataFrame, doc: Sequence[str], keywords: Keywords = K.KEYWORDS) -> DataFrame:
    """Which heading candidates (doc, ord, folded, label, style) stay, with their label.

    Where labelled candidates share a style, one with a style of its own must be a keyword; candidates in the most
    frequent style that begin with a keyword are labelled by the last such keyword; a text that occurs twice goes.
    """
    by_doc, by_style = Window.partitionBy(*doc), Window.partitionBy(*doc, "style")
    found = F.col("label").isNotNull()
    rows = cands.withColumn("_n", F.sum(F.when(found, 1).otherwise(0)).over(by_style)).withColumn("_top", F.max("_n").over(by_doc))
    first = F.min(F.when(found & (F.col("_n") == F.col("_top")), F.col("ord"))).over(by_doc)
    rows = rows.withColumn("_head", F.max(F.when(F.col("ord") == first, F.col("style"))).over(by_doc))
    exact = F.col("folded").isin([k for k, _ in keywords])
    kept = found & ((F.col("_top") < 2) | (F.col("_n") >= 2) | exact)
    padded = F.concat("folded", F.lit(" "))
    begins = F.filter(F.array(*[F.struct(F.lit(f"{k} ").alias("k"), F.lit(label).alias("label")) for k, label in keywords]), lambda x: F.startswith(padded, x["k"]))
    rescued = F.when(~kept & (F.col("_top") >= 2) & (F.col("style") == F.col("_head")) & (F.size(begins) > 0), F.element_at(begins, -1)["label"])
    rows = rows.withColumn("label", F.when(kept, F.col("label")).otherwise(rescued)).filter("label IS NOT NULL")
    return rows.withColumn("_r", F.count(F.lit(1)).over(Window.partitionBy(*doc, "folded"))).filter("_r = 1").drop("_n", "_top", "_head", "_r")


def find_headings(lines: DataFrame, doc: Sequence[str], keywords: Keywords = K.KEYWORDS) -> DataFrame:
    """Heading lines of lines (doc, ord, text, size, bold) with their label. Distinct folded texts are looked up once."""
    rows = lines.join(body_size(lines, doc), list(doc)).filter(looks_like_heading(F.col("text"), F.col("size"), F.col("bold"), F.col("body")))
    rows = rows.withColumn("folded", T.fold(F.col("text"))).withColumn("style", style(F.col("text"), F.col("size"), F.col("bold")))
    labels = rows.select("folded").distinct().withColumn("label", match_label(F.col("folded"), keywords))
    return style_vote(rows.join(labels, "folded"), doc, keywords).select(*doc, "ord", "label")


def name_line(lines: DataFrame, doc: Sequence[str]) -> DataFrame:
    """doc and name (folded): the largest short line without digits and fields on the first line's page, headings aside."""
    w = Window.partitionBy(*doc)
    first_page = F.min_by("page", "ord").over(w)
    rows = lines.withColumn("_p", first_page).filter(F.col("page") == F.col("_p"))
    rows = rows.filter(~F.col("is_heading") & (F.size(T.tokens(F.col("text"))) <= 6) & ~F.col("text").rlike(r"\p{Nd}") & (F.size("fields") == 0))
    return rows.withColumn("_k", F.row_number().over(w.orderBy(F.desc("size"), "ord"))).filter("_k = 1").select(*doc, T.fold(F.col("text")).alias("name"))


def header_label(line: dict, prev: str, prev_style: tuple, name: str) -> str:
    """The label of a line above the first heading, given the label and style of the line before."""
    folded, words = line["folded"], len(line["text"].split())
    if folded and folded == name:
        return "NAME"
    if line["has_field"] or "@" in line["text"] or folded.startswith(tuple(K.CONTACT_PREFIXES)):
        return "CONTACT"
    if prev in ("NAME", "JOB_TITLE") and prev_style == (round(line["size"]), line["bold"]):
        return prev
    if prev == "NAME" and words <= K.JOB_TITLE_MAX_WORDS:
        return "JOB_TITLE"
    plain = not any(c.isdigit() for c in line["text"])
    return "SUMMARY" if prev == "SUMMARY" or (plain and words >= K.SUMMARY_MIN_WORDS) else "CONTACT"


def label_lines(lines: DataFrame, doc: Sequence[str]) -> DataFrame:
    """lines with label and heading_text; heading lines get a null label. The header's state makes this a fold per document."""

    def work(pdf: pd.DataFrame) -> dict[str, list]:
        rows = pdf.to_dict("records")
        tops: dict[int, float] = {}
        for r in rows:
            if r["is_heading"]:
                tops[r["page"]] = min(tops.get(r["page"], float("inf")), r["bbox"]["y0"])
        current, heading, prev, prev_style = None, "", "", ()
        labels, heads = [], []
        for i, r in enumerate(rows):
            enters = r["col"] == 2 and (i == 0 or rows[i - 1]["col"] != 2)
            if enters and not r["is_heading"] and r["bbox"]["y0"] < tops.get(r["page"], float("inf")):
                current, heading, prev = None, "", ""
            if r["is_heading"]:
                current, heading = r["heading"], r["text"]
                labels.append(None)
                heads.append(heading)
                continue
            label = current or header_label(r, prev, prev_style, r["name"] or "")
            if r["contact_only"] and label not in ("CONTACT", "REFERENCE"):
                label = "CONTACT"
            prev, prev_style = label, (round(r["size"]), r["bold"])
            labels.append(label)
            heads.append(heading if current else "")
        return {"label": labels, "heading_text": heads}

    return per_group(lines, doc, "ord", "label string, heading_text string", work)


def rounded_box(b: Column) -> Column:
    """To one decimal, half to even."""
    return F.struct(*[F.bround(b[c], 1).alias(c) for c in ("x0", "y0", "x1", "y1")])


def run_grouping(lines: DataFrame, doc: Sequence[str]) -> DataFrame:
    """Consecutive lines of one label, heading and page as one section: text, envelope (to one decimal), number of lines."""
    w = Window.partitionBy(*doc).orderBy("ord")
    body = lines.filter("label IS NOT NULL")
    same = F.lit(True)
    for c in ("label", "heading_text", "page"):
        same &= F.col(c) == F.lag(c).over(w)
    runs = islands(body, doc, ["ord"], ~same, "section_id")
    grouped = runs.groupBy(*doc, "section_id", F.col("label").alias("section_label"), "heading_text", "page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n").alias("text"),
        G.envelope(F.col("bbox")).alias("bbox"), F.count(F.lit(1)).alias("n_lines"),
    )
    return grouped.withColumn("bbox", rounded_box(F.col("bbox")))


def parse_documents(lines: DataFrame, doc: Sequence[str] = ("doc",), keywords: Keywords = K.KEYWORDS, source: str = "pdf") -> DataFrame:
    """Labelled sections of documents' lines (doc, ord, page, text, bbox, size, bold, col), with their source.

    Only pages have side headings and places: with source "docx" lines keep their order, and sections have no box.
    """
    heads = find_headings(lines, doc, keywords).select(*doc, "ord", F.col("label").alias("heading"))
    rows = lines.join(heads, [*doc, "ord"], "left").withColumn("is_heading", F.col("heading").isNotNull())
    rows = side_headings(rows, doc) if source == "pdf" else rows
    # offsets are taken only where a pattern matches at all, which is seldom
    rows = rows.withColumn("fields", F.when(R.has_fields(F.col("text")), R.find_fields(F.when(R.has_fields(F.col("text")), F.col("text")))).otherwise(F.array().cast(R.SCHEMA)))
    rows = rows.withColumn("has_field", F.exists("fields", lambda f: f["label"] != "DATE")).withColumn("contact_only", R.is_contact_only(F.col("text"), F.col("fields"))).withColumn("folded", T.fold(F.col("text")))
    rows = rows.join(name_line(rows, doc), list(doc), "left").drop("fields")
    out = run_grouping(label_lines(rows, doc), doc).withColumn("source", F.lit(source))
    return out if source == "pdf" else out.withColumn("bbox", F.lit(None).cast(dict(out.dtypes)["bbox"]))
