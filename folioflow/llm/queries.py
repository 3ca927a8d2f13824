"""Queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, digest, katz, lines, phrases, pii, simhash, suffixes, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz": katz.op1_katz,
    "op2_suffix_dedup": suffixes.op2_suffix_dedup,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_bpe": bpe.op4_bpe,
    "op5_simhash": simhash.op5_simhash,
    "op6_warc": warc.op6_warc,
    "op7_decontamination": phrases.op7_decontamination,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_pii": pii.op9_pii,
    "op10_fingerprints": digest.op10_fingerprints,
}
SQL: dict[str, str] = {"op3_line_dedup": lines.OP3_SQL, "op6_warc": warc.OP6_SQL}
