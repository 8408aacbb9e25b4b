"""WARC archives: writing records in segments and reading them back (operator 4).

Pages become HTTP responses in chunked transfer framing. A response longer than a segment is written as
a first record and continuation records, which name the first one as their origin, carry segment
numbers, and on the last one the total length. Of pages with equal payloads only one is written whole;
the others are revisit records that refer to it. Files hold one record after the other, each ended by
two line breaks as the format asks, gzipped, written by Spark to the shared folder.

Reading takes each archive file as a stream of records, emits whole records at once and groups only
continued ones by their origin: ordered by segment number, checked against the total length, joined,
freed of the chunk framing, and checked against the digest in the header.

Defined results: null html is an empty payload; repeated rows give one record each (of equal rows one is
the response); rows with a null id get a record, and come back with a null id; text ids may hold any
characters, as headers carry them escaped; pages of any length are
segmented; an empty table gives no rows. Only the columns named as parameters are read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .support import hint_if_small, keep, let, workers_find_package

SEGMENT = 48 * 1024  # code points of a response's block in one record
CHUNK = 8 * 1024  # code points of a chunk
FILE_BYTES = 64 << 20  # of records in a file
# Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


def base32(digest: Column) -> Column:
    """Upper-case base32 of 160 bits in hexadecimal: four times eight digits of 40 bits."""

    def eight(block: Column) -> Column:
        def digit(bits: Column) -> Column:
            places = [F.shiftright(bits, 35 - 5 * k).bitwiseAND(31) + 1 for k in range(8)]
            return F.concat(*(F.substring(F.lit(BASE32), p.cast("int"), F.lit(1)) for p in places))

        return let(F.conv(F.substring(digest, block * 10 + 1, F.lit(10)), 16, 10).cast("long"), digit)

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), eight), "")


def _pieces(text: Column, size: int) -> Column:
    """The text in pieces of so many code points; none for an empty text."""
    count = F.ceil(F.length(text) / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.substring(text, k * size + 1, F.lit(size)))
    return F.when(count > 0, cut).otherwise(F.array().cast("array<string>"))


def _chunked(payload: Column) -> Column:
    framed = F.transform(
        _pieces(payload, CHUNK), lambda c: F.concat(F.lower(F.hex(F.octet_length(c))), F.lit(EOL), c, F.lit(EOL))
    )
    return F.concat(F.array_join(framed, ""), F.lit("0" + EOL + EOL))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its final two line breaks; headers with a null value are left out."""
    lines = [F.concat(F.lit(name + ": "), value.cast("string")) for name, value in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws(EOL, F.lit("WARC/1.1"), *lines, length), F.lit(EOL + EOL), block)


def _urn(hexed: Column) -> Column:
    """The id of the one record that holds a payload whole."""
    return F.concat(F.lit("<urn:page-payload:"), hexed, F.lit(">"))


def _written_id(id_: Column) -> Column:
    """An id as a header can hold it: whatever could end a line or be trimmed is escaped."""
    return F.url_encode(id_.cast("string"))


def _payload(html_col: str) -> Column:
    return F.coalesce(F.col(html_col).cast("string"), F.lit(""))


def records(pages: DataFrame, id_col: str, html_col: str, segment: int = SEGMENT) -> tuple[DataFrame, int]:
    """One string per record, and the mean size of a page in bytes.

    Which page of equal payloads is the response follows from narrow rows alone (digest, id). Pages are told
    apart by their content, never by their place, so `pages` may come from a shuffle and be evaluated twice.
    Revisits are written from the narrow rows; their payloads are dropped where they are read if the table
    of revisits is proven small, and move with the others otherwise.
    """
    named = pages.select(F.col(id_col).alias("id"), _payload(html_col).alias("payload"))
    named = named.withColumn("hex", F.sha1(F.col("payload").cast("binary")))
    narrow = keep(named.select("id", "hex", F.octet_length("payload").alias("bytes")), "digests")
    size = narrow.agg(F.avg("bytes")).first()[0] or 0
    groups = narrow.groupBy("hex", "id").agg(F.count(F.lit(1)).alias("n"))
    totals = groups.groupBy("hex").agg(F.max("id").alias("best"), F.sum("n").alias("total")).where("total > 1")
    equal = keep(groups.join(totals, "hex").withColumn("is_best", F.col("id").eqNullSafe(F.col("best"))), "equal")

    def but_for(rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
        others = others.select(F.col("hex").alias("_hex"), F.col("id").alias("_id"))
        return rows.join(hint_if_small(others), (F.col("hex") == F.col("_hex")) & F.col("id").eqNullSafe(F.col("_id")), how)

    # Repeated rows of a response's own id: one of them is the response, whichever, as they are equal.
    repeated = equal.where("is_best AND n > 1")
    single = but_for(named, equal.where("NOT is_best OR n > 1"), "left_anti")
    responses = single
    if not repeated.isEmpty():
        own = but_for(named, repeated, "left_semi")
        responses = single.unionByName(own.groupBy("hex", "id").agg(F.any_value("payload").alias("payload")))

    digest = F.concat(F.lit("sha1:"), base32(F.col("hex")))
    head = "HTTP/1.1 200 OK" + EOL + "Content-Type: text/html; charset=utf-8" + EOL + "Transfer-Encoding: chunked" + EOL + EOL
    blocks = responses.select("id", "hex", F.concat(F.lit(head), _chunked(F.col("payload"))).alias("block"))
    # A block has a head, so there is a part; the outer form keeps Spark from testing that by a filter, which
    # it would move to the scan together with all that the parts are made of.
    segments = blocks.select(
        "id", "hex", F.octet_length("block").alias("total"), _pieces(F.col("block"), segment).alias("parts")
    ).select("id", "hex", "total", F.size("parts").alias("n"), F.posexplode_outer("parts").alias("i", "part"))
    split, begins, last = F.col("n") > 1, F.col("i") == 0, F.col("i") == F.col("n") - 1
    name = F.when(begins, _urn(F.col("hex"))).otherwise(
        F.concat(F.lit("<urn:page-segment:"), F.col("hex"), F.lit(":"), (F.col("i") + 1).cast("string"), F.lit(">"))
    )
    written = _record([
        ("WARC-Type", F.when(begins, "response").otherwise("continuation")), ("WARC-Record-ID", name),
        ("X-Page-Id", F.when(begins, _written_id(F.col("id")))), ("WARC-Payload-Digest", F.when(begins, digest)),
        ("WARC-Segment-Number", F.when(split, F.col("i") + 1)),
        ("WARC-Segment-Origin-ID", F.when(~begins, _urn(F.col("hex")))),
        ("WARC-Segment-Total-Length", F.when(split & last, F.col("total"))),
    ], F.col("part"))
    more = F.col("n") - F.col("is_best").cast("int")
    again = equal.where(more > 0).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), more)))
    own = F.concat(F.lit("<urn:page-revisit:"), F.col("hex"), F.lit(":"),
                   F.coalesce(_written_id(F.col("id")), F.lit("")), F.lit(":"), F.col("k").cast("string"), F.lit(">"))
    revisits = again.select(_record([
        ("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", own), ("X-Page-Id", _written_id(F.col("id"))),
        ("WARC-Payload-Digest", digest), ("WARC-Profile", F.lit(REVISIT)), ("WARC-Refers-To", _urn(F.col("hex"))),
        ("X-Refers-To-Page-Id", _written_id(F.col("best"))),
    ], F.lit("HTTP/1.1 200 OK" + EOL + EOL)).alias("value"))
    return segments.select(written.alias("value")).unionByName(revisits), int(size)


def write(pages: DataFrame, path: str, id_col: str = "page_id", html_col: str = "html", segment: int = SEGMENT) -> None:
    """Archive files of about FILE_BYTES before compression below `path`, which must not exist."""
    lines, size = records(pages, id_col, html_col, segment)
    per_file = max(100, FILE_BYTES // (size + 500))  # 500 bytes of headers; long pages are in segments
    # A record ends with two line breaks: exactly what the text writer puts after each row.
    out = lines.write.option("lineSep", EOL + EOL).option("compression", "gzip")
    out.option("maxRecordsPerFile", per_file).text(path)


def parse(stream: io.BufferedIOBase):
    """(headers, block) of each record of an archive."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not the start of a record: {line[:60]!r}")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            if not line:
                raise ValueError("a record ends within its headers")
            name, _, value = line.decode().partition(":")
            headers[name.strip()] = value.strip()
        length = int(headers["Content-Length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut short")
        yield headers, block


def dechunked(block: bytes) -> bytes:
    """Payload of an HTTP response, without the chunk framing if it has one."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(parts)
        parts.append(body[at : at + size])
        if len(parts[-1]) != size or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        at += size + 2


class Inflating(io.RawIOBase):
    """Gzip members of a byte string, inflated piece by piece."""

    def __init__(self, data):
        self.data, self.at, self.inflate = memoryview(data), 0, None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while self.at < len(self.data) or (self.inflate and self.inflate.unconsumed_tail):
            if self.inflate is None or self.inflate.eof:
                self.at -= len(self.inflate.unused_data) if self.inflate else 0
                self.inflate = zlib.decompressobj(31)
                if self.at >= len(self.data):
                    return 0
            piece = self.inflate.unconsumed_tail or self.data[self.at : self.at + 65536]
            if not self.inflate.unconsumed_tail:
                self.at += len(piece)
            out = self.inflate.decompress(piece, len(buffer))
            if out:
                buffer[: len(out)] = out
                return len(out)
        return 0


READ = T.StructType([
    T.StructField("record", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("page_id", T.StringType()), T.StructField("refers", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("intact", T.BooleanType()),
    T.StructField("segment", T.IntegerType()), T.StructField("total", T.LongType()),
    T.StructField("block", T.BinaryType()),
])


def _read_id(written: str | None) -> str | None:
    return None if written is None else unquote_plus(written)


def _read(batches):
    schema = pa.schema([
        *((n, pa.string()) for n in ("record", "kind", "page_id", "refers", "refers_to", "digest")),
        ("payload_bytes", pa.int64()), ("intact", pa.bool_()), ("segment", pa.int32()), ("total", pa.int64()),
        ("block", pa.binary()),
    ])
    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            for headers, block in parse(io.BufferedReader(Inflating(content.as_buffer()), 1 << 17)):
                get = headers.get
                segmented = get("WARC-Segment-Number")
                row = {
                    "record": get("WARC-Segment-Origin-ID", get("WARC-Record-ID")), "kind": get("WARC-Type"),
                    "page_id": _read_id(get("X-Page-Id")), "refers": get("WARC-Refers-To"),
                    "refers_to": _read_id(get("X-Refers-To-Page-Id")),
                    "digest": get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
                    "segment": int(segmented) if segmented else None,
                    "total": int(get("WARC-Segment-Total-Length", "0")) or None,
                }
                if segmented:
                    row["block"] = block
                    held += len(block)
                elif row["kind"] == "response":
                    payload = dechunked(block)
                    row["payload_bytes"] = len(payload)
                    row["intact"] = base64.b32encode(hashlib.sha1(payload).digest()).decode() == row["digest"]
                rows.append(row)
                if len(rows) >= 2000 or held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


WHOLE = T.StructType([T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType())])


@F.pandas_udf(WHOLE)
def _reassembled(blocks, totals):
    import pandas as pd

    out = []
    for parts, total in zip(blocks, totals):
        block = b"".join(bytes(p) for p in parts)
        if len(block) != total:
            raise ValueError(f"segments hold {len(block)} bytes, the last one says {total}")
        payload = dechunked(block)
        out.append((len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()))
    return pd.DataFrame(out, columns=["payload_bytes", "payload_digest"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per page record: page_id (string), payload_bytes, payload_digest, record_type, refers_to, intact."""
    workers_find_package(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = files.mapInArrow(_read, READ)
    whole = parsed.where("segment is null")
    responses = whole.where("kind = 'response'").select("record", "page_id", "digest", "payload_bytes", "intact")
    parts = F.sort_array(F.collect_list(F.struct("segment", "block")))  # of one record
    grouped = parsed.where("segment is not null").groupBy("record").agg(
        parts.alias("parts"), F.max("total").alias("total"), F.max("page_id").alias("page_id"),
        F.max("digest").alias("digest"), F.max("segment").alias("n"),
    )
    in_order = F.forall(F.sequence(F.lit(1), F.col("n")), lambda k: F.get(F.col("parts"), k - 1).segment == k)
    checked = F.when(in_order, F.col("parts.block")).otherwise(
        F.raise_error(F.concat(F.lit("segments missing: "), F.col("record"))).cast("array<binary>")
    )
    joined = grouped.withColumn("done", _reassembled(checked, F.col("total"))).select(
        "record", "page_id", "digest", "done.payload_bytes",
        (F.col("done.payload_digest") == F.col("digest")).alias("intact"),
    )
    responses = responses.unionByName(joined)
    # A revisit's payload is that of the record it refers to.
    revisits = whole.where("kind = 'revisit'").select("page_id", "refers", "refers_to", "digest")
    originals = responses.select(
        F.col("record").alias("refers"), F.col("payload_bytes"), F.col("digest").alias("own"), "intact"
    )
    resolved = revisits.join(originals, "refers", "left").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"),
        "refers_to", (F.col("intact") & (F.col("own") == F.col("digest"))).alias("intact"),
    )
    return responses.select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("response").alias("record_type"),
        F.lit(None).cast("string").alias("refers_to"), "intact",
    ).unionByName(resolved)


def round_trip(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", segment: int = SEGMENT) -> DataFrame:
    """Write the pages to new archives in the shared folder and read those back."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path, id_col, html_col, segment)
    kind = pages.schema[id_col].dataType
    back = read(pages.sparkSession, path)
    return back.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def op4(pages: DataFrame) -> DataFrame:
    return round_trip(pages.select("page_id", "html"))


#: DuckDB: base32 of the digest from its bits, five at a time.
SQL = """
WITH payload AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digest AS (SELECT page_id, strlen(html) AS payload_bytes, html, sha1(html) AS hex FROM payload),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS response FROM digest)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((('0x' || substring(hex, CAST(10 * (i // 8) + 1 AS INT), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31 AS INT) + 1, 1)), '')
           AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to,
       true AS intact
FROM marked
"""
