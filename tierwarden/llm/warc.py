"""WARC archives on shared storage: a Spark writer and a sequential reader.

Each record is one gzip member, whatever its size. The writer is Spark's text sink: it adds a separator after each row,
and a member's last byte is the highest byte of the little-endian length of its content, zero below
16 MiB. So that byte is left out and the separator puts it back; the few larger records go to archives of
their own, one write for each value of that byte. The files are plain concatenated gzip,
written under Spark's commit protocol, so a lost executor leaves no half archive.

Records of equal payloads of at least ``min_revisit`` bytes: the one of the smallest id is a response, the others
revisit it and carry only the HTTP head. The minimum is combined before the shuffle; payloads move once.

All members start with the same ten bytes, and archives are read as text separated by them: Spark cuts large
archives between members, and a task goes through its members in order. ``Reader`` takes chunks of any size, inflates them
incrementally, frames records by Content-Length and verifies block and payload digests; its memory is one record. (Those ten bytes inside a
member are put back before the next chunk, so they do no harm.) Archives of other writers are read whole, up to 2 GB each, with ``whole=True``.

Defined results: a null payload is empty; a null url has no target; a null id is written as
``null``, is never referred to and reads back as null; repeated rows each have a record; an archive that ends inside
a member, or holds anything but WARC records, raises.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwarden.llm.storage import stored

NEW_LINE = b"\r\n"
MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff"      # gzip, deflate, no flags, no time, no level, no system
LIMIT = 1 << 24


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class Record:
    headers: dict[str, str]
    http: bytes
    payload: bytes
    verified: bool


def to_member(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """The gzip member of a record."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,!~*()#[]')}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    record = "\r\n".join(lines).encode() + block + NEW_LINE * 2
    deflated = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflated.compress(record) + deflated.flush()
    return MEMBER + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class Reader:
    """Records of one archive, from its bytes in order."""

    def __init__(self) -> None:
        self.inflater, self.text, self.begun = zlib.decompressobj(31), bytearray(), False

    def feed(self, chunk: bytes) -> Iterator[Record]:
        while chunk:
            self.begun = True
            self.text += self.inflater.decompress(chunk)
            chunk = b""
            if self.inflater.eof:
                chunk = self.inflater.unused_data
                if self.text:      # an empty member holds no record
                    yield self._record(bytes(self.text))
                self.inflater, self.text, self.begun = zlib.decompressobj(31), bytearray(), False

    def close(self) -> None:
        if self.begun:
            raise ValueError("the archive ends inside a member")

    @staticmethod
    def _record(data: bytes) -> Record:
        head, found, rest = data.partition(NEW_LINE * 2)
        first, *lines = head.decode().split("\r\n")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        if not first.startswith("WARC/") or not found or "content-length" not in headers:
            raise ValueError("not a WARC record")
        size = int(headers["content-length"])
        if len(rest) != size + 4 or rest[size:] != NEW_LINE * 2:
            raise ValueError(f"the record's length is not {size}")
        block = rest[:size]
        http, _, payload = block.partition(NEW_LINE * 2)
        verified = headers.get("warc-block-digest") == f"sha1:{base32_sha1(block)}"
        if headers.get("warc-type") != "revisit":
            verified = verified and headers.get("warc-payload-digest") == f"sha1:{base32_sha1(payload)}"
        return Record(headers, http, payload, verified)


def write_archives(df: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   min_revisit: int = 0, records_per_file: int = 5000, date: str = "2000-01-01T00:00:00Z") -> None:
    """A record for every row of ``df``, in archives of at most ``records_per_file`` under ``path``."""
    @F.pandas_udf("binary")
    def member(ids: pd.Series, urls: pd.Series, bodies: pd.Series, digests: pd.Series, refers: pd.Series) -> pd.Series:
        return pd.Series([to_member(i, u, b, base64.b32encode(bytes.fromhex(d)).decode(), r, date)
                          for i, u, b, d, r in zip(ids, urls, bodies, digests, refers, strict=True)], dtype=object)

    def write(members: DataFrame, last: int, mode: str) -> None:
        # the separator is the last byte of every member
        (members.select(F.expr("substring(member, 1, octet_length(member) - 1)").cast("string")).write.mode(mode)
         .option("encoding", "ISO-8859-1").option("lineSep", chr(last)).option("compression", "none")
         .option("maxRecordsPerFile", records_per_file).text(path))

    rows = df.select(F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
                     F.coalesce(F.col(payload).cast("string").cast("binary"), F.lit(b"")).alias("body")).withColumn("digest", F.sha1("body"))
    first = rows.groupBy("digest").agg(F.min("id").alias("first"))
    refers = F.when((F.octet_length("body") >= min_revisit) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")),
                    F.col("first").cast("string"))
    joined = rows.join(first, "digest").withColumn("refers", refers)
    made = member(F.coalesce(F.col("id").cast("string"), F.lit("null")), "url", "body", "digest", "refers")
    # headers are far below 4,096 bytes and a quoted url; the others are as long as they are
    carried = F.when(F.col("refers").isNull(), F.octet_length("body")).otherwise(0)
    surely = carried + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + 4096 < LIMIT
    write(joined.filter(surely).select(made.alias("member")), 0, "error")
    if rows.filter(F.octet_length("body") + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + 4096 >= LIMIT).isEmpty():
        return
    large = stored(joined.filter(~surely).select(made.alias("member")), "large-members")
    last = F.conv(F.hex(F.expr("substring(member, octet_length(member), 1)")), 16, 10).cast("int")
    for r in large.select(last.alias("last")).distinct().collect():      # at most 256 values
        write(large.filter(last == r["last"]), r["last"], "append")


def read_archives(spark: SparkSession, path: str, payloads: bool = True, chunk: int = 1 << 16, whole: bool = False) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes and payload_digest (of the full payload), verified, payload (null for revisits)."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, rows, held = Reader(), [], 0
        for batch in batches:
            for part in batch["content"]:
                if whole or not len(part):      # an archive begins with the separator: an empty row
                    reader.close()
                data = part if whole or not len(part) else MEMBER + part
                for at in range(0, len(data), chunk):
                    for r in reader.feed(data[at:at + chunk]):
                        rows.append(_row(r, payloads))
                        held += len(r.payload) if payloads else 1
                        if len(rows) >= 2000 or held > 1 << 24:
                            yield pd.DataFrame(rows, columns=COLUMNS)
                            rows, held = [], 0
        reader.close()
        yield pd.DataFrame(rows, columns=COLUMNS)

    # files in hidden folders of an unfinished write are not listed
    if whole:
        members = spark.read.format("binaryFile").load(path).select("content")
    else:
        members = (spark.read.option("encoding", "ISO-8859-1").option("lineSep", MEMBER.decode("latin-1")).text(path)
                   .select(F.col("value").cast("binary").alias("content")))
    return members.mapInPandas(
        each, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
              "verified boolean, payload binary")


COLUMNS = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "verified", "payload"]


def _id(value: str | None) -> int | None:
    name = (value or "null").removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def _row(r: Record, payloads: bool) -> tuple:
    revisit = r.headers["warc-type"] == "revisit"
    size = len(r.payload)
    if revisit:
        size = int(next(x for x in r.http.decode().split("\r\n") if x.lower().startswith("content-length:")).split(":")[1])
    uri = r.headers.get("warc-target-uri")
    return (_id(r.headers["warc-record-id"]), None if uri is None else unquote(uri), r.headers["warc-type"],
            _id(r.headers.get("warc-refers-to")), size, r.headers["warc-payload-digest"].removeprefix("sha1:"), r.verified,
            r.payload if payloads and not revisit else None)
