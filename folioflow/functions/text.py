"""Text functions: Column in, Column out, all JVM-side."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

WS = r"(?U)\s+"


def nfc(c: Column) -> Column:
    """Canonical composition; ASCII texts are left alone."""
    composed = F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.when(c.isNotNull(), composed))


def clean_line(c: Column) -> Column:
    """Composed, without invisible characters and ligatures, white space squeezed, bullets as '- '."""
    c = F.translate(nfc(c), K.INVISIBLE, "")
    for ligature, letters in K.LIGATURES.items():
        c = F.replace(c, F.lit(ligature), F.lit(letters))
    c = strip(F.regexp_replace(c, WS, " "))
    c = F.regexp_replace(c, rf"^[{re.escape(K.BULLETS)}]+ *", "- ")
    return strip(F.regexp_replace(c, "^[-–—] +", "- "))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def join_lines(lines: Column) -> Column:
    """An array of lines as one text; a word broken by a hyphen at a line's end is joined."""
    return F.regexp_replace(F.array_join(F.filter(lines, lambda x: x != ""), "\n"), r"([\p{L}\p{N}_])-\n([a-zà-ỹ])", "$1$2")


def margin_key(c: Column) -> Column:
    """Lines that differ in numbers or case only have one key."""
    return F.trim(F.regexp_replace(F.lower(c), r"\p{Nd}+", "#"))


def is_page_number(c: Column) -> Column:
    """Fixed pattern: a number of up to three digits, maybe after 'page' and before 'of n'."""
    return c.rlike(r"(?iu)^(page|trang)?\s*\d{1,3}\s*((/|of|trên|\|)\s*\d{1,3})?$")


def fold(c: Column) -> Column:
    """Without accents, lower case, letters and digits of ASCII only, single blanks."""
    c = F.replace(F.replace(c, F.lit("đ"), F.lit("d")), F.lit("Đ"), F.lit("D"))
    apart = F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), c, F.lit(False))
    c = F.when(F.octet_length(c) == F.length(c), c).otherwise(F.when(c.isNotNull(), F.regexp_replace(apart, r"\p{Mn}", "")))
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, WS), lambda x: x != "")


def letter_spaced(c: Column) -> Column:
    t = tokens(c)
    return (F.size(t) > 2) & (2 * F.size(F.filter(t, lambda x: F.length(x) <= 2)) > F.size(t))


def is_upper(c: Column) -> Column:
    return (F.upper(c) == c) & (F.lower(c) != c)


def has_text_layer(c: Column) -> Column:
    """At least 30 characters besides white space, less than a tenth of them broken."""
    solid = F.regexp_replace(c, WS, "")
    good = F.regexp_replace(solid, "[\\x00-\\x1F�]", "")
    return (F.length(solid) >= 30) & ((F.length(solid) - F.length(good)) < 0.1 * F.length(solid))


def natural_key(c: Column) -> Column:
    """array<struct<n, s>> that sorts digit runs as numbers; parts alternate between text and digits."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{Nd}+|[^\p{Nd}]+)"), F.lit(1))
    keyed = F.transform(parts, lambda p: F.when(p.rlike(r"^\p{Nd}"), F.struct(F.lit(1).alias("d"), F.length(F.regexp_replace(p, "^0+", "")).alias("n"), F.regexp_replace(p, "^0+", "").alias("s"))).otherwise(F.struct(F.lit(0).alias("d"), F.lit(0).alias("n"), p.alias("s"))))
    text_first = F.concat(F.array(F.struct(F.lit(0).alias("d"), F.lit(0).alias("n"), F.lit("").alias("s"))), keyed)
    return F.when(c.rlike(r"^\p{Nd}"), text_first).otherwise(keyed)


def group_of(stem: Column) -> Column:
    """The document that a page's file name belongs to."""
    numbered, paged = F.regexp_extract(stem, r"(?i)^(cv[_ -]?\d+)", 1), F.regexp_extract(stem, r"(?i)^(.*?)[_ -](page|p)[_ -]?\d+$", 1)
    is_paged = stem.rlike(r"(?i)^.*?[_ -](page|p)[_ -]?\d+$")
    return F.when(numbered != "", F.translate(F.lower(numbered), " -", "__")).when(is_paged, F.lower(paged)).otherwise(F.lower(stem))


def page_of(stem: Column) -> Column:
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(stem, r"(?i)(page|p)[_ -]?(\d{1,9})$", 2), F.lit("")), F.lit("999999999")).cast("int"), F.lit(1))


def _url_path(url: Column) -> Column:
    asked = F.regexp_extract(url, r"[?&]d=([^&#]*)", 1)
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.coalesce(F.call_function("try_url_decode", F.when(url.rlike("[?&]d="), asked).otherwise(path)), path)


def url_file(url: Column) -> Column:
    """File name in a URL (of its d= parameter if it has one); back slashes part folders too."""
    return F.regexp_extract(F.replace(_url_path(url), F.lit("\\"), F.lit("/")), r"([^/]*)$", 1)


def url_file_unhashed(url: Column) -> Column:
    """The same for uploads, whose names begin with a hash; back slashes are ordinary."""
    return F.regexp_replace(F.regexp_extract(_url_path(url), r"([^/]*)$", 1), "^[0-9a-f]{6,}-(?=.)", "")


def local_files_url(path: Column, root: str) -> Column:
    return F.concat(F.lit("/data/local-files/?d="), F.regexp_replace(path, f"^{re.escape(root.rstrip('/'))}/", ""))


def content_hash(text: Column) -> Column:
    """SHA-256 of the text without differences of case and white space; null if nothing is left."""
    c = F.lower(strip(F.regexp_replace(text, WS, " ")))
    return F.when(c != "", F.sha2(c, 256))


def class_name(class_id: Column) -> Column:
    """The class of an id, or CLASS_<id>."""
    known = F.create_map(*[F.lit(x) for i, name in enumerate(K.CLASSES) for x in (i, name)])
    return F.coalesce(F.try_element_at(known, class_id.cast("int")), F.concat(F.lit("CLASS_"), class_id.cast("string")))


def color_index(label: Column, colors: int = 14) -> Column:
    return (F.crc32(label) % colors).cast("int")


def weights_version(stem: Column, at: Column) -> Column:
    return F.concat(stem, F.lit("@"), F.date_format(at, "yyyyMMdd-HHmm"))


def kind_of(path: Column) -> Column:
    """Routing by extension: pdf, image, office, or null for what can't be read."""
    ext = F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))
    return F.when(ext == "pdf", "pdf").when(ext.isin(K.IMAGE_EXTENSIONS), "image").when(ext.isin(K.OFFICE_EXTENSIONS), "office")
