"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Every stage sees all that its predecessor kept, and its decisions take effect: toxic documents go, boilerplate lines are
cut, one document of each near-duplicate group stays, contaminated documents go, and the last stage encodes what is left.
All but the last return the columns of documents; n_chars follows a changed text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import bpe, jaccard, lines, phrases, toxicity
from folioflow.llm.common import free, stored, table
from folioflow.session import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shipped(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run


@_shipped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity reaches the cut go."""
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.filter(~F.col(scored.columns[-1])).select(*docs.columns)


@_shipped
def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that exceed the boilerplate ratio of their source go; all documents stay, if only with an empty text."""
    out = lines.drop_boilerplate(docs, counts=True)
    n_chars = F.when(F.col(out.columns[-1]) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs as a stored table with a number for each row, in a column of a name that docs hasn't."""
    row = free("_row", docs.columns)
    return stored(docs.withColumn(row, F.monotonically_increasing_id())), row


@_shipped
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the document with the smallest doc_id stays.

    A null doc_id comes last; of equal ones the first row counts. SimHash finds most links, exact comparison the rest.
    """
    numbered, row = _numbered(docs)
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col(row).alias("row")).alias("name")
    copies = jaccard.groups(numbered.select("text", row, name), row, "name").filter("name <> component_id").select(row)
    return numbered.join(copies, row, "left_anti").select(*docs.columns)


@_shipped
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages cover by a twentieth or more go."""
    numbered, row = _numbered(docs)
    found = phrases.contamination(numbered.select(row, "text"), table(spark, sf_dir, "benchmark"), key=row).filter("contaminated").select(row)
    return numbered.join(found, row, "left_anti").select(*docs.columns)


@_shipped
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]
#: Hash functions and the vocabulary aren't SQL's; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
