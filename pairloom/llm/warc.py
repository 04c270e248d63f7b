"""WARC archives: writing captures, reading records, assembling transactions.

``write_archives`` stores three records per capture: the request, the response (or
a revisit of an earlier one with an equal payload) and metadata, tied to the
response by ``WARC-Concurrent-To``. Archives are gzip files written by Spark's text
writer, whose line end is the blank lines that close a record, so they lie
wherever Spark can write. ``read_records`` reads each file through Spark, inflates it
bit by bit and cuts records by their ``Content-Length``, whatever bytes they hold.
``transactions`` joins the three kinds and gives one nested row per capture.

The joins are by record ids, which are unique, but for revisits: thousands may
refer to one response. That side is aggregated to one row per response, and the
adaptive skew join splits the other.

Defined cases: null html is an empty payload, null url an empty target; null
page ids are captures like others; rows that repeat in all three columns are
written as often as they occur, and of such repeats of the response's row all but the first
revisit it; an empty table gives no archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.llm.common import arrow_schema, map_batches
from pairloom.session import stored

CRLF = "\r\n"
END = CRLF + CRLF
RECORDS_PER_FILE = 30_000
DATE = "2024-01-01T00:00:00Z"
MISSING_ID = "none"
#: The base32 alphabet, a fixed value of RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> tuple[Column, Column]:
    """The SHA-1 of a binary column as bits, and as 32 base32 digits of five bits
    each, read from a column ``_bits`` that holds the first."""
    bits = F.concat(*[
        F.lpad(F.conv(F.substring(F.sha1(data), 1 + 10 * i, 10), 16, 2), 40, "0") for i in range(4)
    ])
    digits = [
        F.substring(F.lit(BASE32), (F.conv(F.substring(F.col("_bits"), 1 + 5 * i, 5), 2, 10).cast("int") + 1), F.lit(1))
        for i in range(32)
    ]
    return bits, F.concat(*digits)


def captures(pages: DataFrame, least: int = 0) -> DataFrame:
    """One row per page: payload, digest, whether it is the response of its digest
    and the page it refers to. Payloads under ``least`` bytes are never revisits."""
    plain = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    plain = plain.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    held = plain.groupBy("sha1", "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
    newest = stored(held.groupBy("sha1").agg(
        F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "url", "n")).alias("newest")
    ), "newest")
    first = F.col("newest.page_id").eqNullSafe(F.col("page_id")) & (F.col("newest.url") == F.col("url"))
    met = plain.join(newest, "sha1").withColumn("first", first)
    columns = ["page_id", "url", "html", "sha1", "newest"]
    twice = F.col("first") & (F.col("newest.n") > 1)
    once = met.where(~twice).select(*columns, "first")
    # rows that repeat the response's row: equal in all columns, so a count tells all of them
    copies = met.where(twice).groupBy(*columns).agg(F.count(F.lit(1)).cast("int").alias("n"))
    repeats = copies.select(*columns, F.explode(F.sequence(F.lit(1), "n")).alias("copy")).select(*columns, (F.col("copy") == 1).alias("first"))
    # tables without such repeats, the usual case, are spared a second pass over the pages
    rows = once.union(repeats) if newest.where("newest.n > 1").limit(1).count() else once
    return rows.select(
        *columns, "first", (F.col("first") | (F.octet_length("html") < least)).alias("is_response"),
        F.when(F.col("first"), -1).otherwise(F.monotonically_increasing_id()).alias("copy"),
    )


def _urn(*parts) -> Column:
    digest = F.md5(F.concat_ws("\t", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]))
    pieces = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _lines(*pairs) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws(CRLF, *[F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in pairs])


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    rows = captures(pages, least)
    page, target = F.coalesce(F.col("page_id").cast("string"), F.lit(MISSING_ID)), F.regexp_replace("url", r"[\r\n]+", " ")
    mine = _urn(page, F.col("url"), F.col("sha1"), F.col("copy"), F.lit("response"))
    newest = F.coalesce(F.col("newest.page_id").cast("string"), F.lit(MISSING_ID))
    other = _urn(newest, F.col("newest.url"), F.col("sha1"), F.lit(-1), F.lit("response"))
    bits, digits = base32_sha1(F.col("html").cast("binary"))
    rows = rows.withColumn("_bits", bits).withColumn("digest", digits)
    status = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8"
    full = F.concat(F.lit(status + CRLF + "Content-Length: "), F.octet_length("html").cast("string"), F.lit(END), "html")
    stub = F.concat(F.lit(status + CRLF + "Content-Length: "), F.octet_length("html").cast("string"), F.lit(END))
    asked = F.lit(f"GET / HTTP/1.1{CRLF}Host: archive.invalid{END}")
    about = F.concat(F.lit("page-id: "), page, F.lit(CRLF))
    none = F.lit(None).cast("string")

    def record(kind, ident, block, mime, concurrent=none, refers=none, digest=none):
        head = F.concat(F.lit("WARC/1.1" + CRLF), _lines(
            ("WARC-Type", kind), ("WARC-Record-ID", ident), ("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", target),
            ("WARC-Concurrent-To", concurrent), ("WARC-Refers-To", refers),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)), ("Content-Type", F.lit(mime)),
            ("Content-Length", F.octet_length(block)),
        ))
        return F.concat(head, F.lit(END), block)

    here = F.col("is_response")
    records = F.array(
        record(F.lit("request"), _urn(mine, "request"), asked, "application/http; msgtype=request", concurrent=mine),
        record(
            F.when(here, "response").otherwise("revisit"), mine, F.when(here, full).otherwise(stub),
            "application/http; msgtype=response", refers=F.when(~here, other), digest=F.col("digest"),
        ),
        record(F.lit("metadata"), _urn(mine, "metadata"), about, "application/warc-fields", concurrent=mine),
    )
    rows.select(F.explode(records).alias("value")).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


class _Inflated:
    """The bytes of a gzip file of one or more members, inflated as they are asked for."""

    def __init__(self, packed: bytes, step: int = 1 << 20):
        self.packed, self.at, self.step = memoryview(packed), 0, step
        self.member = zlib.decompressobj(31)
        self.ready = bytearray()

    def fill(self, n: int) -> bool:
        while len(self.ready) < n and self.at < len(self.packed):
            part = self.packed[self.at : self.at + self.step]
            self.at += len(part)
            self.ready += self.member.decompress(part)
            while self.member.eof and self.member.unused_data:
                rest, self.member = self.member.unused_data, zlib.decompressobj(31)
                self.ready += self.member.decompress(rest)
            if self.member.eof:
                self.member = zlib.decompressobj(31)
        return len(self.ready) >= n

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while True:
            at = self.ready.find(mark, max(0, seen - len(mark)))
            if at >= 0:
                return self.take(at + len(mark))
            seen = len(self.ready)
            if not self.fill(seen + 1):
                return None

    def take(self, n: int) -> bytes:
        self.fill(n)
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def records_in(packed: bytes):
    """(headers with lower-case names, block) of each record of an archive."""
    source = _Inflated(packed)
    while (head := source.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8").strip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        length = int(fields["content-length"])
        block = source.take(length)
        if len(block) != length or source.take(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
        yield fields, block


RECORD = (
    "record_id string, type string, target string, concurrent_to string, refers_to string, digest string, "
    "http string, payload binary, fields string"
)
_FILL = 8 << 20


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``: ids, kind, HTTP head and payload."""
    schema = arrow_schema(RECORD)

    def parse(batch):
        rows, held = [], 0
        for packed in batch.column("content"):
            for fields, block in records_in(memoryview(packed.as_buffer())):
                kind = fields["warc-type"]
                http, body = (block.partition(b"\r\n\r\n")[::2] if fields.get("content-type", "").startswith("application/http") else (None, None))
                rows.append((
                    fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields.get("warc-concurrent-to"),
                    fields.get("warc-refers-to"), fields.get("warc-payload-digest"),
                    None if http is None else http.decode("utf-8", "replace"), body,
                    block.decode("utf-8", "replace") if kind == "metadata" else None,
                ))
                held += len(block)
                if held > _FILL:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return map_batches(files, parse, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (the response or revisit), ``request``,
    ``metadata``, and for a revisit the ``original`` capture it refers to. Records
    that miss their partner give null in its place."""
    caught = records.where("type in ('response', 'revisit')").select(
        F.col("record_id").alias("id"),
        F.struct("record_id", "type", "target", "refers_to", "digest", "http", F.octet_length("payload").alias("bytes")).alias("capture"),
    )
    tied = records.where("type in ('request', 'metadata')").groupBy(F.col("concurrent_to").alias("id")).agg(
        F.max(F.when(F.col("type") == "request", F.struct("record_id", "http"))).alias("request"),
        F.max(F.when(F.col("type") == "metadata", F.struct("record_id", "fields"))).alias("metadata"),
    )
    whole = stored(caught.join(tied, "id", "left"), "transactions")
    original = whole.where("capture.type = 'response'").select(
        F.col("id").alias("original_id"), F.struct("capture", "metadata").alias("original")
    )
    again = whole.where("capture.type = 'revisit'").withColumn("original_id", F.col("capture.refers_to"))
    first = whole.where("capture.type = 'response'")
    kind = original.schema["original"].dataType
    return again.join(original, "original_id", "left").select(*whole.columns, "original").union(
        first.withColumn("original", F.lit(None).cast(kind))
    )
