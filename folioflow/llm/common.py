"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which every executor shares.

    Where that setting is missing, a temporary folder stands in if master is this machine; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="folioflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/folioflow-{uuid.uuid4().hex}"


def gone_at_exit(spark: SparkSession, path: str) -> None:
    """The folder goes when the application ends; results may be read until then."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).deleteOnExit(folder)


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """df written to the shared folder and read back: the plan behind it is cut, and lost executors cost nothing."""
    spark, path = df.sparkSession, work_dir(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    gone_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def free(name: str, *taken: Iterable[str]) -> str:
    """name, with as many underscores before it as make it differ from all column names taken."""
    known = {c.lower() for names in taken for c in names}
    while name.lower() in known:
        name = f"_{name}"
    return name


def text_of(column: Column | str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
