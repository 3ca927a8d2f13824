"""Fixed-format fields. Counts of one label are JVM-side; offsets need Python code points and label precedence."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import constants as K

SCHEMA = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType())]))
_PATTERNS = [(label, re.compile(p)) for label, p in K.FIELDS.items()]


def fields_of(text: str | None) -> list[tuple[str, int, int, str]]:
    """Matches by label precedence, none overlapping an earlier-taken one, in order of start; text without trailing .,;)"""
    kept: list[tuple[str, int, int, str]] = []
    for label, pattern in _PATTERNS:
        for m in pattern.finditer(text or ""):
            if all(m.end() <= s or e <= m.start() for _, s, e, _ in kept):
                kept.append((label, m.start(), m.end(), m[0].rstrip(".,;)")))
    kept.sort(key=lambda f: f[1])
    return kept


@F.pandas_udf(SCHEMA)
def find_fields(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for b in batches:
        yield b.map(lambda t: [dict(zip(("label", "start", "end", "text"), f, strict=True)) for f in fields_of(t)])


def java(pattern: str) -> str:
    """The same classes of characters in Java: Unicode letters and digits."""
    return "(?U)" + pattern


def has_fields(text: Column) -> Column:
    """Whether any pattern matches."""
    found = F.lit(False)
    for pattern in K.FIELDS.values():
        found = found | text.rlike(java(pattern))
    return found


def count_fields(text: Column, label: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(java(K.FIELDS[label]))), F.lit(0)).cast("long")


def is_contact_only(text: Column, fields: Column) -> Column:
    """Fields other than dates cover four fifths of the text's characters, blanks aside."""
    found = F.filter(fields, lambda f: f["label"] != "DATE")
    covered = F.aggregate(found, F.lit(0), lambda a, f: a + F.length(f["text"]))
    return (F.size(found) > 0) & (covered >= 0.8 * F.length(F.replace(text, F.lit(" "), F.lit(""))))
