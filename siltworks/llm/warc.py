"""WARC archives: writing captures with revisits, reading records, assembling transactions.

A capture is three records: request, response or revisit, and metadata. Request and metadata name the
response in ``WARC-Concurrent-To``; the join through these identifiers gives one nested row per capture. Records are
column expressions and Spark's text writer puts them into gzip files, so a lost task writes its file anew. Archives are
read by Spark's binary reader, one file at a time, and unpacked as a stream; a file should stay below 2 GB, which
holds for what ``write`` makes, as it writes one file per partition of its input.

Which payloads repeat is found from digests and lengths alone. The payloads themselves are shuffled only if the digests
that repeat are counted to be too many for a broadcast.

Defined results: a null payload is empty; payloads below ``LEAST`` bytes never become revisits; of equal ones the
smallest id is the response (all rows of that id, if it repeats; null ids are largest, and all-null ones are all
responses); a null url has no target; line breaks in a url are percent-encoded; an empty table gives empty archives
and no captures. A record without a partner still gives a row, with nulls for what is missing. Other columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.words import by_value
from siltworks.session import stored

LEAST = 100
#: Digests that are broadcast: at about 150 bytes, 30 MB.
MOST_BROADCAST = 200_000
#: Bytes of payload sent back at once.
BATCH_BYTES = 4 << 20
#: Fixed values of the format.
CRLF = "\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_KIND = (
    "record_type string, record_id string, concurrent_to array<string>, target_uri string, date string, "
    "payload_digest string, refers_to_uri string, http_length long, payload binary"
)


def first_captures(rows: DataFrame) -> DataFrame:
    """``digest, first_id, first_uri`` of the payloads of at least ``LEAST`` bytes that more than one row has."""
    long = rows.filter(F.col("_length") >= LEAST).groupBy(F.col("_digest").alias("digest"))
    first = long.agg(F.min("_id").alias("first_id"), F.min_by("_uri", "_id").alias("first_uri"), F.count("*").alias("n"))
    return stored(first.filter("n > 1 and first_id is not null").drop("n"), "first-captures")


def _record(fields: list[tuple[str, Column | str]], block: Column) -> Column:
    """A record up to its block; fields with a null value are left out."""
    lines = [
        F.coalesce(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF)), F.lit(""))
        for name, value in fields
    ]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF))
    return F.concat(F.lit("WARC/1.1" + CRLF), *lines, length, block)


def _urn(kind: str) -> Column:
    h = F.md5(F.concat("_capture", F.lit(kind)))
    return F.concat(F.lit("<urn:uuid:"), *[F.concat(F.substring(h, a, n), F.lit(s)) for a, n, s in ((1, 8, "-"), (9, 4, "-"), (13, 4, "-"), (17, 4, "-"), (21, 12, ">"))])


def write(df: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Archives below ``path`` with the three records of each row."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    uri = F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A")
    rows = df.select(F.col(key).alias("_id"), uri.alias("_uri"), body.alias("_body"))
    rows = rows.withColumns({"_digest": F.sha2("_body", 256), "_length": F.octet_length("_body").cast("long")})
    first = first_captures(rows)
    few = first.count() <= MOST_BROADCAST
    rows = rows.join(F.broadcast(first) if few else first, (F.col("_digest") == F.col("digest")) & (F.col("_length") >= LEAST), "left")
    again = F.col("first_id").isNotNull() & ~F.col("_id").eqNullSafe(F.col("first_id"))
    rows = rows.withColumns({"_again": again, "_capture": F.expr("uuid()")})
    host, target = F.regexp_extract("_uri", "(?s)^.*?://([^/?#]*)(.*)$", 1), F.regexp_extract("_uri", "(?s)^.*?://([^/?#]*)([^#]*)", 2)
    asked = F.concat(F.lit("GET "), F.coalesce(F.nullif(target, F.lit("")), F.lit("/")), F.lit(f" HTTP/1.1{CRLF}Host: "), F.coalesce(host, F.lit("")), F.lit(CRLF + CRLF))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("_length").cast("string"), F.lit(CRLF + CRLF))
    answer = F.when(F.col("_again"), head).otherwise(F.concat(head, "_body"))
    when = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    common = [("WARC-Target-URI", F.col("_uri")), ("WARC-Date", when)]
    main = [
        ("WARC-Type", F.when(F.col("_again"), "revisit").otherwise("response")), ("WARC-Record-ID", _urn("response")), *common,
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "_digest")),
        ("WARC-Profile", F.when(F.col("_again"), SAME_PAYLOAD)),
        ("WARC-Refers-To-Target-URI", F.when(F.col("_again"), F.col("first_uri"))),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    request = [("WARC-Type", "request"), ("WARC-Record-ID", _urn("request")), ("WARC-Concurrent-To", _urn("response")), *common, ("Content-Type", "application/http;msgtype=request")]
    notes = [("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata")), ("WARC-Concurrent-To", _urn("response")), *common, ("Content-Type", "application/warc-fields")]
    noted = F.coalesce(F.concat(F.lit("pageId: "), F.col("_id").cast("string"), F.lit(CRLF)), F.lit(""))
    gap = F.lit(CRLF + CRLF)
    records = F.concat(_record(request, asked), gap, _record(main, answer), gap, _record(notes, noted))
    rows.select(records.alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)


class _Stream:
    """Bytes of a file, unpacked as they are asked for; gzip members follow each other."""

    def __init__(self, content: bytes):
        self.raw, self.at, self.packed = memoryview(content), 0, content[:2] == b"\x1f\x8b"
        self.data, self.pos, self.unpack = b"", 0, None

    def more(self) -> bool:
        """Append further bytes to what is not yet read."""
        if self.at >= len(self.raw):
            return False
        chunk = self.raw[self.at : self.at + (1 << 18)]
        self.at += len(chunk)
        if self.packed:
            out = []
            while chunk:
                self.unpack = self.unpack or zlib.decompressobj(31)
                out.append(self.unpack.decompress(chunk))
                chunk = b""
                if self.unpack.eof:
                    chunk, self.unpack = self.unpack.unused_data, None
            chunk = b"".join(out)
        self.data, self.pos = self.data[self.pos :] + bytes(chunk), 0
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the mark, which is passed; None at the end."""
        seen = self.pos
        while (end := self.data.find(mark, seen)) < 0:
            left = len(self.data) - self.pos
            if not self.more():
                return None
            seen = max(0, left - len(mark))
        found = self.data[self.pos : end]
        self.pos = end + len(mark)
        return found

    def take(self, n: int) -> bytes:
        parts, have = [], len(self.data) - self.pos
        while have < n:
            parts.append(self.data[self.pos :])
            n -= have
            self.data, self.pos = b"", 0
            if not self.more():
                raise ValueError("the archive ends within a record")
            have = len(self.data)
        parts.append(self.data[self.pos : self.pos + n])
        self.pos += n
        return b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    return dict(_named_fields(head))


def _named_fields(head: bytes) -> list[tuple[str, str]]:
    lines = (x.partition(b":") for x in head.split(b"\r\n")[1:])
    return [(k.strip().lower().decode("utf-8", "replace"), v.strip().decode("utf-8", "replace")) for k, _, v in lines]


def parse(content: bytes) -> Iterator[tuple]:
    """The records of an archive, as tuples of ``RECORD_KIND``. Of HTTP answers, the payload is the body."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = _named_fields(head.lstrip(b"\r\n"))
        f = dict(fields)
        block = stream.take(int(f.get("content-length", 0)))
        stream.until(b"\r\n\r\n")
        kind, http_length = f.get("warc-type"), None
        if kind in ("response", "revisit") and f.get("content-type", "").startswith("application/http"):
            http, _, block = block.partition(b"\r\n\r\n")
            stated = _fields(http).get("content-length", "")
            http_length = int(stated) if stated.isdigit() else None
        others = [v for k, v in fields if k == "warc-concurrent-to"] or None  # the one field that may repeat
        names = ("warc-target-uri", "warc-date", "warc-payload-digest", "warc-refers-to-target-uri")
        yield (kind, f.get("warc-record-id"), others, *(f.get(n) for n in names), http_length, block)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    names = [x.split()[0] for x in RECORD_KIND.split(", ")]
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), *[pa.string()] * 4, pa.int64(), pa.binary()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for record in parse(content.as_py()):
                    rows.append(record)
                    held += len(record[-1]) + 500
                    if held > BATCH_BYTES:
                        yield made(rows)
                        rows, held = [], 0
                yield made(rows)

    return files.mapInArrow(task, RECORD_KIND)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture``, ``response`` (or revisit), ``request`` and the list ``metadata``.

    ``records`` may have any columns beside ``record_type``, ``record_id`` and the list ``concurrent_to``. Records join the
    response that they name, or that names them; of several that they name, a response that is there, the smallest. ``records`` are
    read several times: store them, or what is wanted of their payloads, before.
    """
    main = F.col("record_type").isin("response", "revisit")
    whole = F.struct(*records.columns)
    answers = records.filter(main).select(F.col("record_id").alias("capture"), whole.alias("response"))
    named = records.filter(main & F.col("concurrent_to").isNotNull())
    named = named.select(F.explode("concurrent_to").alias("_other"), F.col("record_id").alias("_by"))
    named = named.groupBy("_other").agg(F.min("_by").alias("_by"))
    others = records.filter(~main | F.col("record_type").isNull()).join(named, F.col("record_id") == F.col("_other"), "left")
    several = records.filter(~main & (F.size("concurrent_to") > 1)).select(F.col("record_id").alias("_of"), F.explode("concurrent_to").alias("capture"))
    several = several.join(answers.select("capture"), "capture", "left_semi").groupBy("_of").agg(F.min("capture").alias("_one"))
    others = others.join(several, F.col("record_id") == F.col("_of"), "left").drop("_of")
    capture = F.coalesce("_by", "_one", F.get("concurrent_to", F.lit(0)), "record_id")
    sides = others.groupBy(capture.alias("capture")).agg(
        F.min(F.when(F.col("record_type") == "request", whole)).alias("request"),
        F.collect_list(F.when(F.col("record_type") == "metadata", whole)).alias("metadata"),
    )
    return answers.join(sides, "capture", "full_outer")


def noted(field: str) -> Column:
    """A field of the capture's first metadata record that has it."""
    texts = F.transform("metadata", lambda m: F.regexp_extract(m["payload"].cast("string"), f"(?m)^{field}: (.*?)\r?$", 1))
    return F.get(F.filter(texts, lambda t: t != ""), F.lit(0))


by_value(sys.modules[__name__])
