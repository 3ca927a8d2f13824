"""Content deduplication of a stream of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def new_contents(stream: DataFrame, at: str = "ts", text: str = "text", delay: str = "1 hour") -> DataFrame:
    """Rows whose normalised content wasn't seen within the watermark, with content_hash; rows without content are left out."""
    hashed = stream.withColumn("content_hash", T.content_hash(F.col(text))).filter("content_hash IS NOT NULL")
    return hashed.withWatermark(at, delay).dropDuplicatesWithinWatermark(["content_hash"])
