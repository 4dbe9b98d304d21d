"""WARC archives: written with segments and chunked payloads, read back by reassembly.

A record is a head of ``Name: value`` lines, an empty line, and a block of Content-Length bytes. Long
blocks are cut into segments: the first one is the record itself, the others are ``continuation``
records that name it as their origin. The reader groups segments by origin, orders them by number,
verifies the total length, and takes the chunk framing off the HTTP body.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslane.llm.shared import payload, shuffle_width, stored

VERSION = b"WARC/1.1"
END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Records are cut so that no archive exceeds RECORDS_PER_ARCHIVE * SEGMENT_BYTES.
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
RECORDS_PER_ARCHIVE = 2000
REVISIT_BYTES = 1000
ROWS_IN_BATCH = 256
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
PARSED = (
    "record_id string, origin_id string, number int, total_length long, record_type string, "
    "page_id long, uri string, refers_to_id string, digest string, block binary"
)


MEASURES = "payload_bytes long, payload_digest string"
# What is told of a record, besides its payload.
RECORD = ["record_id", "record_type", "page_id", "uri", "refers_to_id", "digest"]
# Copies of one row that a task writes.
COPIES_IN_TASK = 1000


class CorruptRecord(ValueError):
    """A record that does not keep what its head says."""


def with_record_types(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """What is to be written of every page; rows that are equal in all come as one.

    Returns page_id, uri, payload, digest, spread, copies, response_id and response_uri. A row stands
    for ``copies`` equal pages, each of which is written as a record of its own. Of equal payloads of
    REVISIT_BYTES or more the page with the largest id is the response; the others revisit the first
    copy of ``response_id`` and ``response_uri``, which are null for responses. A null text is an empty
    payload. A page without an id is a response, as no record can refer to it; so are rows that repeat
    the response's id.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("uri"),
        payload(html).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # No record refers to a page without an id, so equal ones need not meet in one task.
    spread = F.when(F.col("page_id").isNull(), F.spark_partition_id()).otherwise(0)
    distinct = (
        rows.withColumn("spread", spread)
        .withColumn("row_key", _row_key())
        .groupBy("row_key")
        .agg(
            *(F.first(c).alias(c) for c in ("page_id", "uri", "payload", "digest", "spread")),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    slim = rows.where(
        (F.octet_length("payload") >= REVISIT_BYTES) & F.col("page_id").isNotNull()
    ).select("page_id", "uri", "digest")
    responses = (
        slim.groupBy("digest")
        .agg(F.max(F.struct("page_id", "uri")).alias("response"), F.min("page_id").alias("least"))
        .where(F.col("least") < F.col("response.page_id"))
        .select(
            "digest",
            F.col("response.page_id").alias("response_id"),
            F.col("response.uri").alias("response_uri"),
        )
    )
    revisits = (
        slim.join(responses, "digest")
        .where(F.col("page_id") < F.col("response_id"))
        .withColumn("spread", F.lit(0))
        .select(_row_key().alias("row_key"), "response_id", "response_uri")
        .dropDuplicates(["row_key"])
    )
    return distinct.join(revisits, "row_key", "left").drop("row_key")


def _row_key() -> Column:
    """A name of page_id, spread, digest and uri that tells nulls from all values."""
    page, uri = F.col("page_id").cast("string"), F.concat(F.lit("="), F.col("uri"))
    named = [F.coalesce(page, F.lit("")), "spread", "digest", F.coalesce(uri, F.lit(""))]
    return F.sha2(F.concat_ws("\n", *named).cast("binary"), 256)


def record_id(
    page_id: int | None, uri: str | None, digest: str, spread: int = 0, copy: int = 0
) -> str:
    """The id of one written row: of its page, address and payload, and of the copy of these."""
    name = json.dumps([page_id, uri, digest, spread, copy])
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing."""
    pieces = (body[at : at + size] for at in range(0, len(body), size))
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in pieces) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload within chunked framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            raise CorruptRecord("broken chunk size")
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise CorruptRecord("chunk of another length than stated")
        out.append(body[end + 2 : at])
        at += 2


def _head(kind: str, own_id: str, length: int, **more: object) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {own_id}", f"WARC-Date: {DATE}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items() if v is not None]
    lines.append(f"Content-Length: {length}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + END.encode()


def records_of(
    page_id: int | None,
    uri: str | None,
    body: bytes,
    digest: str,
    spread: int,
    response_id: int | None,
    response_uri: str | None,
    copy: int,
) -> Iterator[bytes]:
    """The WARC records of one copy of a page, without the empty lines that end a record."""
    own_id = record_id(page_id, uri, digest, spread, copy)
    safe = None if uri is None else uri.replace("\r", "%0D").replace("\n", "%0A")
    fields = {
        "WARC_Target_URI": safe, "X_Page_ID": page_id, "WARC_Payload_Digest": f"sha1:{digest}"
    }
    if response_id is not None:
        response = record_id(response_id, response_uri, digest)
        fields |= {"WARC_Profile": PROFILE, "WARC_Refers_To": response}
        yield _head("revisit", own_id, len(HTTP_HEAD), **fields) + HTTP_HEAD
        return
    block = HTTP_HEAD + chunked(body)
    fields["Content_Type"] = "application/http; msgtype=response"
    if len(block) <= SEGMENT_BYTES:
        yield _head("response", own_id, len(block), **fields) + block
        return
    segments = [block[at : at + SEGMENT_BYTES] for at in range(0, len(block), SEGMENT_BYTES)]
    first = _head("response", own_id, len(segments[0]), **fields, WARC_Segment_Number=1)
    yield first + segments[0]
    for number, segment in enumerate(segments[1:], start=2):
        last = len(block) if number == len(segments) else None
        segment_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own_id}#{number}')}>"
        head = _head(
            "continuation", segment_id, len(segment), WARC_Segment_Origin_ID=own_id,
            WARC_Segment_Number=number, WARC_Segment_Total_Length=last,
        )
        yield head + segment


def write_archives(rows: DataFrame, path: str) -> None:
    """Write the rows of ``with_record_types`` as gzip-compressed archives under ``path``.

    The text sink ends every record with the two empty lines that the format asks for, and writes to
    any file system that Spark can reach.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for *row, first, end in zip(*(batch[c].to_pylist() for c in fields), strict=True):
                for copy in range(first, end):
                    for record in records_of(*row, copy):
                        out.append(record)
                        size += len(record)
                    if size > 4 * 1024**2:
                        yield pa.record_batch({"record": pa.array(out, pa.binary())})
                        out, size = [], 0
            yield pa.record_batch({"record": pa.array(out, pa.binary())})

    fields = [
        "page_id", "uri", "payload", "digest", "spread", "response_id", "response_uri", "first_copy",
        "end_copy",
    ]
    # Many copies of one row are written by many tasks, each some of them; other rows stay where they are.
    few = F.col("copies") <= COPIES_IN_TASK
    here = rows.where(few).withColumns({"first_copy": F.lit(0).cast("long"), "end_copy": F.col("copies")})
    firsts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_IN_TASK).cast("long"))
    dealt = (
        rows.where(~few)
        .withColumn("first_copy", F.explode(firsts))
        .withColumn("end_copy", F.least("copies", F.col("first_copy") + COPIES_IN_TASK))
        .repartition(shuffle_width(rows.sparkSession), "digest", "uri", "page_id", "first_copy")
    )
    records = here.unionByName(dealt).select(*fields).mapInArrow(write, "record binary")
    (
        records.select(F.col("record").cast("string"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_ARCHIVE)
        .text(path)
    )


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of an archive, by the lengths in their heads."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        body = data.find(END.encode(), at) + len(END)
        lines = data[at:body].decode().split("\r\n")
        if lines[0].encode() != VERSION or body < len(END):
            raise CorruptRecord(f"no record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:] if line)
        end = body + int(head["Content-Length"])
        if data[end : end + len(END)] != END.encode():
            raise CorruptRecord(f"{head['WARC-Record-ID']} has another length than stated")
        number, page = head.get("WARC-Segment-Number"), head.get("X-Page-ID")
        total = head.get("WARC-Segment-Total-Length")
        yield {
            "record_id": head["WARC-Record-ID"],
            "origin_id": head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]),
            "number": None if number is None else int(number),
            "total_length": None if total is None else int(total),
            "record_type": head["WARC-Type"],
            "page_id": None if page is None else int(page),
            "uri": head.get("WARC-Target-URI"),
            "refers_to_id": head.get("WARC-Refers-To"),
            "digest": head.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
            "block": data[body:end],
        }
        at = end + len(END)


def _parsed(archives: DataFrame, measured: bool) -> DataFrame:
    """Records of the archives; the block of a record that is not in segments is its payload.

    If ``measured``, the size and digest of such a payload take its place.
    """
    columns = f"{PARSED}, {MEASURES}" if measured else PARSED
    schema = _arrow_schema(columns)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows: list[dict] = []
                for row in parse_archive(content.as_py()):
                    if row["number"] is None:
                        row["block"] = http_payload(row["block"])
                        if measured:
                            body = row.pop("block")
                            row |= {"payload_bytes": len(body), "payload_digest": hashlib.sha1(body).hexdigest()}
                    rows.append(row)
                    if len(rows) == ROWS_IN_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return archives.mapInArrow(parse, columns)


def _arrow_schema(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    pairs = (x.split() for x in columns.split(", "))
    return pa.schema([(name, kinds[kind]) for name, kind in pairs])


def _grouped(records: DataFrame, *more: Column) -> DataFrame:
    """One row per origin: RECORD of its first or only part, and its segments in order as ``parts``."""
    number = F.col("number")
    first = number.isNull() | (number == 1)
    return records.groupBy("origin_id").agg(
        F.array_sort(F.collect_list(F.when(number.isNotNull(), F.struct("number", "block")))).alias("parts"),
        F.max("total_length").alias("total"),
        F.max("number").alias("last"),
        *(F.max(F.when(first, F.col(name))).alias(name) for name in RECORD),
        *more,
    )


def _joined(row: pa.RecordBatch) -> bytes:
    """The block of the one record in ``row`` of `_grouped`, which is in segments; lengths are verified."""
    origin, total, last, own = (row[c][0].as_py() for c in ("origin_id", "total", "last", "record_id"))
    parts = row["parts"].flatten()
    numbers, blocks = (parts.field(name).to_pylist() for name in ("number", "block"))
    # A record that was read twice has equal segments; one of each number counts.
    distinct = dict.fromkeys(zip(numbers, blocks, strict=True))
    block = b"".join(block for _, block in distinct)
    if own is None or len(distinct) != last or total != len(block):
        raise CorruptRecord(f"segments of {origin} are not whole")
    return block


def _kinds(df: DataFrame) -> str:
    return ", ".join(f"{name} {df.schema[name].dataType.simpleString()}" for name in RECORD)


def reassembled(segments: DataFrame) -> DataFrame:
    """One row per origin, with RECORD and ``block``: blocks joined in order, lengths verified.

    A group holds the segments of one record, no more than one payload, and these are joined once, so the
    time follows the length. Segments may lie in any archives. A record without its first or last
    segment, with a gap, or with another total length than its last segment states stops the job.
    """
    grouped = _grouped(segments)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(at, 1) for at in range(batch.num_rows)):
                columns = [*(row[c] for c in RECORD), pa.array([_joined(row)], pa.binary())]
                yield pa.record_batch(columns, names=[*RECORD, "block"])

    return grouped.mapInArrow(join, f"{_kinds(grouped)}, block binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """RECORD and ``payload`` of every record.

    The archives are unpacked and parsed once. Whole records are decoded where they are read; only
    segments are shuffled. A revisit has an empty payload. Broken records stop the job with
    CorruptRecord.
    """

    @F.pandas_udf("binary")
    def decoded(blocks: pd.Series) -> pd.Series:
        return blocks.map(http_payload)

    archives = spark.read.format("binaryFile").load(path).select("content")
    parsed = stored(_parsed(archives, measured=False), "parsed")
    is_whole = F.col("number").isNull()
    whole = parsed.where(is_whole).select(*RECORD, F.col("block").alias("payload"))
    joined = reassembled(parsed.where(~is_whole)).select(*RECORD, decoded("block").alias("payload"))
    return whole.unionByName(joined)


def measured_archives(spark: SparkSession, path: str) -> DataFrame:
    """RECORD, ``payload_bytes`` and ``payload_digest`` of every record, as `read_archives` reads it.

    Payloads are measured where they are decoded, and not kept. All records go through one grouping, in
    which those that are not in segments have no block; so the archives are parsed once, and nothing
    is stored for it.
    """
    archives = spark.read.format("binaryFile").load(path).select("content")
    measures = ["payload_bytes", "payload_digest"]
    grouped = _grouped(_parsed(archives, measured=True), *(F.max(name).alias(name) for name in measures))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segmented = batch["last"].is_valid()
            whole = batch.filter(pc.invert(segmented))
            yield pa.record_batch([whole[c] for c in (*RECORD, *measures)], names=[*RECORD, *measures])
            batch = batch.filter(segmented)
            for row in (batch.slice(at, 1) for at in range(batch.num_rows)):
                body = http_payload(_joined(row))
                made = [pa.array([len(body)], pa.int64()), pa.array([hashlib.sha1(body).hexdigest()])]
                yield pa.record_batch([*(row[c] for c in RECORD), *made], names=[*RECORD, *measures])

    return grouped.mapInArrow(measure, f"{_kinds(grouped)}, {MEASURES}")


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP message, without its framing."""
    block = bytes(block)
    head, found, body = block.partition(END.encode())
    if not found:
        raise CorruptRecord("HTTP head does not end")
    if b"\r\ntransfer-encoding: chunked" in head.lower() and body:
        return dechunked(body)
    return body


def payloads_of(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record read.

    ``records`` has ``payload_bytes`` and ``payload_digest`` of the decoded payloads. Revisits take
    them from the response they refer to, whose page is ``refers_to``.
    """
    is_revisit = F.col("record_type") == "revisit"
    response = records.where(~is_revisit).groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.max("page_id").alias("refers_to"),
        F.max("payload_bytes").alias("response_bytes"),
        F.max("payload_digest").alias("response_digest"),
    )
    # Responses have no refers_to_id; they go by their own id, as a null would be one hot key.
    key = F.coalesce("refers_to_id", "record_id")
    return records.withColumn("refers_to_id", key).join(response, "refers_to_id", "left").select(
        "page_id",
        *(
            F.when(is_revisit, F.col(theirs)).otherwise(F.col(own)).alias(own)
            for own, theirs in (
                ("payload_bytes", "response_bytes"),
                ("payload_digest", "response_digest"),
            )
        ),
        "record_type",
        F.when(is_revisit, F.col("refers_to")).alias("refers_to"),
    )


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` to ``path``, read them back, and describe every record; see `payloads_of`.

    A null text is an empty payload; one of any length is cut into segments and joined again, in time that
    follows its length, as one value of up to 2 GB. Equal rows are written and described each by itself. An
    empty table gives an empty table, and other columns are ignored.
    """
    write_archives(with_record_types(pages), path)
    return payloads_of(stored(measured_archives(pages.sparkSession, path), "records"))
