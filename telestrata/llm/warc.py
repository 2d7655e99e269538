"""WARC archives: writing with segmentation, and reassembly on reading.

Writing frames each page as an HTTP response with chunked transfer coding. A response
block longer than ``SEGMENT`` bytes is split into a first record and continuation records
that name it by ``WARC-Segment-Origin-ID``; the last one carries the total length. Of pages
with equal payloads the one with the smallest id is the response, the others are revisits
that refer to it and carry headers only.

Reading parses the archives by content length, groups the segments of a record by origin
identifier, orders them by segment number, verifies the total length, undoes the chunked
framing and verifies the payload digest. A record with a missing or surplus segment, a
wrong length, broken framing or a wrong digest raises an error.

Archives are Parquet-free: Spark's text sink writes records with the record end
(two line breaks) as line separator, so the files are plain ``.warc`` streams; they are
read as binary files of bounded size.

Defined cases: a null payload counts as empty. A payload below ``least`` bytes is always a
response. Rows without id sort before others. Repeated rows are records of their own; of
equal ids with equal payloads one is the response. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telestrata.llm.common import ship, stored
from telestrata.sources.storage import workspace

SEGMENT = 16 * 1024  # bytes of a record's block at most
CHUNK = 4 * 1024  # bytes of a transfer chunk at most
FILE_BYTES = 16 * 1024 * 1024  # aim for the size of an archive
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), CHUNK):
        part = payload[at : at + CHUNK]
        parts += [b"%X\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(framed: bytes) -> bytes:
    """The payload of chunked framing; raises ``ValueError`` where it is broken."""
    parts, at = [], 0
    while True:
        line = framed.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size without end")
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2 + size
        if framed[at : at + 2] != b"\r\n" and size:
            raise ValueError("chunk without end")
        if not size:
            return b"".join(parts)
        parts.append(framed[line + 2 : at])
        at += 2


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode()


def records(number: int, page_id, url: str | None, payload: bytes | None, refers_to) -> Iterator[bytes]:
    """The records of one page, without the record end. ``number`` is unique in the archive set."""
    origin = f"<urn:telestrata:{number:x}>"
    named = [
        ("WARC-Target-URI", None if url is None else " ".join(url.split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("X-Page-ID", page_id),
        ("WARC-Payload-Digest", None if payload is None else f"sha1:{digest(payload)}"),
    ]
    if refers_to is not None:
        payload_digest, length, original = refers_to
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", origin), *named[:3],
                  ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("WARC-Profile", PROFILE),
                  ("X-Refers-To-Page", original), ("X-Payload-Length", length), ("Content-Length", 0)]
        yield _header(fields)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    for i, part in enumerate(parts, 1):
        last = i == len(parts)
        if i == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", origin), *named]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:telestrata:{number:x}:{i}>"),
                      ("WARC-Segment-Origin-ID", origin)]
        fields += [
            ("WARC-Segment-Number", i if len(parts) > 1 else None),
            ("WARC-Segment-Total-Length", len(block) if last and i > 1 else None),
            ("Content-Type", "application/http; msgtype=response" if i == 1 else None),
            ("Content-Length", len(part)),
        ]
        yield _header(fields) + part


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive."""
    at, end = 0, END.encode()
    while at < len(archive):
        head = archive.find(end, at)
        if head < 0 or archive[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        lines = archive[at:head].decode().split("\r\n")[1:]
        fields = dict(line.split(": ", 1) for line in lines)
        body = head + 4
        at = body + int(fields["Content-Length"])
        if archive[at : at + 4] != end:
            raise ValueError(f"record without end at byte {at}")
        yield fields, archive[body:at]
        at += 4


# Writing


def assigned(pages: DataFrame, least: int, page_id: str, payload: str) -> DataFrame:
    """``(row, refers_to, length)`` of the rows that revisit another; written once.

    Only hashes are shuffled. A payload that a third of all rows have is reduced to its
    smallest row before it moves; the join back is on the hash, and Spark splits what is
    skewed.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    keyed = pages.select(
        "row", F.col(page_id).alias("id"), F.sha1(body).alias("sha"), F.octet_length(body).alias("length")
    ).where(F.col("length") >= least)
    first = keyed.groupBy("sha", "length").agg(F.min(F.struct(F.col("id").alias("id"), F.col("row").alias("row"))).alias("f"), F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").select("sha", "length", F.col("f.id").alias("refers_to"), F.col("f.row").alias("first_row"))
    again = keyed.join(first, ["sha", "length"]).where("row <> first_row")
    return stored(again.select("row", "sha", "length", "refers_to"), "revisits")


def write(
    pages: DataFrame, path: str, least: int = 0, page_id: str = "page_id", url: str = "url", payload: str = "html"
) -> None:
    """Write the pages to ``.warc`` files in the folder ``path``.

    ``WARC-Record-ID`` comes from the row's place in the scan, which a repeated task finds again.
    """
    ship(pages.sparkSession)
    numbered = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(page_id).alias(page_id),
        F.col(url).alias(url), F.col(payload).alias(payload),
    )
    revisits = assigned(numbered, least, page_id, payload)
    # Revisits carry no payload on; the join keeps to what the optimizer finds best for their number.
    rows = numbered.join(revisits, "row", "left").select(
        "row", F.col(page_id).cast("string").alias("id"), F.col(url).alias("url"),
        F.when(F.col("sha").isNull(), F.coalesce(F.col(payload), F.lit("")).cast("binary")).alias("payload"),
        "sha", "length", F.col("refers_to").cast("string").alias("refers_to"),
    )

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row, id_, url_, body, sha, length, original in zip(*(c.to_pylist() for c in batch.columns)):
                refers = None
                if sha is not None:
                    refers = (base64.b32encode(bytes.fromhex(sha)).decode(), length, original)
                for record in records(row, id_, url_, body, refers):
                    out.append(record)
                    size += len(record)
                if size > FILE_BYTES // 4:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    # Records are at most a segment and a header, so their number bounds the size of a file.
    (
        rows.mapInArrow(framed, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", END)
        .option("maxRecordsPerFile", 2 * FILE_BYTES // SEGMENT)
        .text(path)
    )


# Reading

PIECES = "origin string, number int, total long, type string, page_id string, refers_to string, length long, digest string, block binary"


def _pieces(batches: Iterator[pa.RecordBatch], segmented: bool | None) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("type", pa.string()),
                        ("page_id", pa.string()), ("refers_to", pa.string()), ("length", pa.int64()),
                        ("digest", pa.string()), ("block", pa.binary())])
    whole = lambda text: None if text is None else int(text)
    for batch in batches:
        for archive in batch.column(0):
            rows = []
            for f, block in parsed(archive.as_py()):
                if segmented not in (None, "WARC-Segment-Number" in f):
                    continue
                rows.append((
                    f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]), whole(f.get("WARC-Segment-Number")),
                    whole(f.get("WARC-Segment-Total-Length")), f["WARC-Type"], f.get("X-Page-ID"),
                    f.get("X-Refers-To-Page"), whole(f.get("X-Payload-Length")),
                    f.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, block,
                ))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)] if rows
                                             else [pa.array([], t.type) for t in schema], schema=schema)


def read(spark: SparkSession, path: str, segmented: bool | None = None) -> DataFrame:
    """``(origin, number, total, type, page_id, refers_to, length, digest, block)`` of each record.

    ``segmented`` picks the records that are segments, or those that aren't.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(lambda batches: _pieces(batches, segmented), PIECES)


def reassembled(spark: SparkSession, path: str) -> DataFrame:
    """One row per logical record of the archives, segments put together.

    Records of one segment stay where they were read. The others are grouped by their origin;
    a group is one document, not a share of the table.
    """
    single = read(spark, path, segmented=False).select(
        "type", "page_id", "refers_to", "length", "digest", "block", F.lit(True).alias("sound")
    )
    parts = read(spark, path, segmented=True)
    joined = parts.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        F.max("number").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.max("page_id").alias("page_id"),
        F.max("digest").alias("digest"),
        F.sum((F.col("type") == "response").cast("int")).alias("firsts"),
    )
    whole = joined.withColumn("block", F.expr("aggregate(parts, x'', (b, p) -> b || p.block)"))
    sound = (F.col("n") == F.col("last")) & (F.col("firsts") == 1) & (F.col("total") == F.octet_length("block"))
    several = whole.select(
        F.lit("response").alias("type"), "page_id", F.lit(None).cast("string").alias("refers_to"),
        F.lit(None).cast("long").alias("length"), "digest", "block", F.coalesce(sound, F.lit(False)).alias("sound"),
    )
    return single.union(several)


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind, page, refers, length, digests, blocks, sound = (c.to_pylist() for c in batch.columns)
        size = []
        for i, block in enumerate(blocks):
            if not sound[i]:
                raise ValueError(f"page {page[i]}: its segments don't make up the record")
            if kind[i] == "revisit":
                size.append(length[i])
                continue
            head, _, body = block.partition(b"\r\n\r\n")
            body = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
            if digest(body) != digests[i]:
                raise ValueError(f"page {page[i]}: wrong payload digest")
            size.append(len(body))
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(size, pa.int64()), batch.column(4), batch.column(0), batch.column(2)],
            ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        )


def summaries(records_: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of each record."""
    ship(records_.sparkSession)
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    return records_.mapInArrow(_payloads, schema)


def round_trip(pages: DataFrame, least: int = 0, page_id: str = "page_id") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and summarise what is read back."""
    path = workspace(pages.sparkSession, "warc")
    write(pages, path, least, page_id)
    found = summaries(reassembled(pages.sparkSession, path))
    kind = pages.schema[page_id].dataType
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


