"""WARC archives compressed with Zstandard (.warc.zst): writer and validating reader.

An archive is a skippable frame (magic 0x184D2A5D) whose content is the dictionary, then one frame per record, each
with its content size and checksum. The reader takes the dictionary from the leading frame, decodes one frame at a time,
and checks of each record: version line, required headers, Content-Length against the block, the block's and the
payload's digests, the record type, and that no bytes remain.

Payloads of ``MIN_REVISIT`` bytes or more that are equal are stored once: the smallest page_id's record is the response,
the others are revisit records that name it and carry the payload's digest and length, but no payload.

Archives are rows (path, content), as Spark's binaryFile source gives them, so they can live in any store that Spark
reads; ``save`` also writes them as files where the folder is a file system of all machines.

Defined results: null html is an empty payload; rows that share the smallest page_id of equal payloads are all
responses; a null page_id sorts after all others, is written as a record without an id header and read back as null; repeated rows stay
rows; an empty table gives no archive and an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, text_of

MAGIC = 0x184D2A5D
MIN_REVISIT, ARCHIVE_BYTES, DICT_BYTES, SAMPLE_BYTES, LEVEL = 100, 16_000_000, 32_768, 1_000_000, 3
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of URLs, RFC 4122
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REQUIRED = ("WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length")


class BrokenArchive(ValueError):
    """What is read isn't a whole, valid archive."""


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def record_id(page: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, page)}>"


def write_record(page: str | None, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    block = HTTP if refers_to is not None else HTTP + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page or ""),
        "WARC-Date": "2000-01-01T00:00:00Z",
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page is not None:
        headers["X-Page-ID"] = page
    if refers_to is not None:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to), "X-Refers-To": refers_to}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> Record:
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise BrokenArchive("no WARC version line")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name.strip() or name in headers:
            raise BrokenArchive(f"bad header line {line[:60]!r}")
        headers[name] = value.strip()
    if missing := [h for h in REQUIRED if not headers.get(h)]:
        raise BrokenArchive(f"missing headers: {missing}")
    length = headers["Content-Length"]
    if not length.isascii() or not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BrokenArchive("the block's length isn't Content-Length")
    block = rest[:-4]
    if (digest := headers.get("WARC-Block-Digest")) and digest != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise BrokenArchive("the block isn't its digest's")
    return Record(headers, block)


def payload_of(record: Record) -> bytes:
    """The payload of a response, checked against its digest; empty for a revisit."""
    head, sep, payload = record.block.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"HTTP/"):
        raise BrokenArchive("no HTTP head in the block")
    kind = record.headers["WARC-Type"]
    if kind == "response" and record.headers.get("WARC-Payload-Digest", "") != f"sha256:{hashlib.sha256(payload).hexdigest()}":
        raise BrokenArchive("the payload isn't its digest's")
    if kind == "revisit" and (payload or record.headers.get("WARC-Profile") != PROFILE or "WARC-Refers-To" not in record.headers):
        raise BrokenArchive("a revisit record with a payload or without what it refers to")
    return payload


def train(records: list[bytes]) -> bytes:
    """A dictionary from the first records, up to SAMPLE_BYTES; empty where there is too little to train on."""
    sample, size = [], 0
    for r in records:
        sample.append(r[:65_536])
        size += len(sample[-1])
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICT_BYTES, sample, k=64, d=8).as_bytes() if len(sample) >= 16 else b""
    except zstandard.ZstdError:
        return b""


#: Digests of repeated payloads are broadcast up to this many rows, and joined by shuffling beyond.
BROADCAST_ROWS = 100_000


def pack(records: list[bytes]) -> bytes:
    dictionary = train(records)
    c = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True, write_content_size=True)
    return b"".join([struct.pack("<II", MAGIC, len(dictionary)), dictionary, *map(c.compress, records)])


def unpack(content: bytes) -> Iterator[Record]:
    """The records of an archive, one frame at a time."""
    if len(content) < 8:
        raise BrokenArchive("no leading frame")
    magic, size = struct.unpack_from("<II", content)
    if magic != MAGIC or len(content) < 8 + size:
        raise BrokenArchive("no whole dictionary frame at the start")
    dictionary = content[8 : 8 + size]
    if dictionary[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may itself be compressed
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary, max_output_size=1 << 27)
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    at = 8 + size
    view = memoryview(content)
    while at < len(content):
        try:
            said = zstandard.get_frame_parameters(view[at : at + 18]).content_size
            for stop in (min(len(content), at + (said if said < 1 << 40 else 0) * 2 + 4096), len(content)):  # mostly, the first is enough
                frame = d.decompressobj()
                data = frame.decompress(view[at:stop])
                if frame.eof:
                    break
        except zstandard.ZstdError as e:
            raise BrokenArchive(f"frame at byte {at}: {e}") from e
        if not frame.eof:
            raise BrokenArchive(f"frame at byte {at} is cut off")
        if said not in (zstandard.CONTENTSIZE_UNKNOWN, len(data)):
            raise BrokenArchive(f"frame at byte {at} has another length than it says")
        yield parse_record(data)
        at = stop - len(frame.unused_data)


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(path, content): the archives of all pages, about ARCHIVE_BYTES of records each."""
    p = pages.select(F.col(key).cast("string").alias("page"), F.coalesce(F.col(url), F.lit("")).alias("url"), text_of(F.col(html)).alias("payload"), F.col(key).alias("k"))
    p = p.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    first = p.filter(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    first = stored(first)
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    # payloads that can have no copy go past the join, so that they don't meet by a digest of no use
    large = p.filter(F.col("size") >= MIN_REVISIT).join(first, "digest", "left")
    small = p.filter(F.col("size") < MIN_REVISIT).withColumn("first", F.lit(None).cast(dict(p.dtypes)["k"]))
    p = large.unionByName(small).withColumn("refers_to", F.when(~F.col("first").eqNullSafe(F.col("k")), F.col("first").cast("string")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def archive() -> pd.DataFrame:
            content = pack(held)
            return pd.DataFrame({"path": [f"{hashlib.sha256(content).hexdigest()[:32]}.warc.zst"], "content": [content]})

        for b in batches:
            for page, u, payload, digest, refers in zip(b["page"], b["url"], b["payload"], b["digest"], b["refers_to"], strict=True):
                held.append(write_record(page if isinstance(page, str) else None, u.replace("\r", "").replace("\n", ""), payload.encode(), digest, refers if isinstance(refers, str) else None))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    return p.select("page", "url", "payload", "digest", "refers_to").mapInPandas(run, "path string, content binary")


def save(archives: DataFrame, folder: str) -> DataFrame:
    """Writes each archive as a file of a folder that all machines share; returns path and bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                part = f"{folder}/.{path}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, f"{folder}/{path}")
            yield pd.DataFrame({"path": b["path"], "bytes": b["content"].map(len)})

    return archives.mapInPandas(run, "path string, bytes long")


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of rows (path, content): page, url, payload_bytes, payload_digest, record_type, refers_to, and the payload on request."""

    def rows(contents: Iterable[bytes]) -> Iterator[tuple]:
        for content in contents:
            for r in unpack(content):
                h, payload = r.headers, payload_of(r)
                if h["WARC-Type"] == "response" and h.get("X-Payload-Length", str(len(payload))) != str(len(payload)):
                    raise BrokenArchive("the payload's length isn't the one in its header")
                yield (h.get("X-Page-ID"), h.get("WARC-Target-URI"), int(h.get("X-Payload-Length", len(payload))), h["WARC-Payload-Digest"].removeprefix("sha256:"), h["WARC-Type"], h.get("X-Refers-To"), *([payload] if payloads else []))

    names = ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payloads else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame(list(rows(b["content"])), columns=names).astype({"payload_bytes": "int64"})

    return archives.select("content").mapInPandas(run, "page string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string" + ", payload binary" * payloads)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = dict(pages.dtypes)["page_id"]
    back = read_archives(stored(write_archives(pages), "uncompressed"))
    return back.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


OP6_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= {MIN_REVISIT} GROUP BY d)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
       CASE WHEN p.n >= {MIN_REVISIT} AND p.page_id <> f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.n >= {MIN_REVISIT} AND p.page_id <> f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= {MIN_REVISIT}
"""  # noqa: S608
