"""WARC archives: writing with segmentation and revisits, and reassembly.

Written by Spark's text writer (one record per row, the blank lines between
records as line separator, gzip), read back as whole files of bounded size.
A record larger than a segment is split: the first segment keeps the record's
type, the others are ``continuation`` records that name the first by
``WARC-Segment-Origin-ID``. Reading groups them by origin, orders them by
segment number, verifies the total length and decodes the chunked framing.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberledger.llm.common import cut, lookup

#: Payloads from this size on are stored once.
REVISIT_BYTES = 100
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: Records per file; with the segment size it bounds a file.
RECORDS = 2000
SEPARATOR = "\r\n\r\n"

RECORD = (
    "file string, record_id string, origin_id string, type string, segment int, total long, "
    "page_id {id}, refers_to string, digest string, body binary"
)


# -- writing --------------------------------------------------------------


def _chunked(body: bytes, size: int) -> bytes:
    out = [b"%x\r\n%b\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join(out) + b"0\r\n\r\n"


def _records(row: dict, segment: int, chunk: int) -> Iterator[bytes]:
    """The record of one page, without the blank lines that end it."""
    revisit = row["refers_to"] is not None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = head + b"\r\n" if revisit else head + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(row["payload"] or b"", chunk)
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"] or "")
    common = [("WARC-Date", "2024-01-01T00:00:00Z"), *([("WARC-Target-URI", url)] if url else [])]
    own = [("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("Content-Type", "application/http; msgtype=response")]
    if row["page_id"] is not None:
        own.append(("Page-Id", row["page_id"]))
    if revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        own += [("WARC-Refers-To", row["refers_to"]), ("WARC-Profile", profile)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    for n, part in enumerate(parts, 1):
        kind = ("revisit" if revisit else "response") if n == 1 else "continuation"
        name = row["record_id"] if n == 1 else f"{row['record_id'][:-1]}-{n}>"
        fields = [("WARC-Type", kind), ("WARC-Record-ID", name), *common, *(own if n == 1 else [])]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", n))
        if n > 1:
            fields.append(("WARC-Segment-Origin-ID", row["record_id"]))
            if n == len(parts):
                fields.append(("WARC-Segment-Total-Length", len(block)))
        fields.append(("Content-Length", len(part)))
        yield "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + part


def _record_id(page: str, ordinal: str, digest: str):
    h = F.md5(F.concat_ws("/", F.coalesce(F.col(page).cast("string"), F.lit("-")), F.col(ordinal).cast("string"), F.col(digest)))
    dashed = F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    records_per_file: int = RECORDS,
) -> None:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``).

    Of rows whose payloads (UTF-8; a null html is empty) are equal and at
    least ``REVISIT_BYTES`` long, the one with the smallest page id (a null
    id is largest; of equal ids, one of them) is the response and the others
    revisit it. Shorter payloads are all responses. Other columns are not
    written; repeated rows are records of their own; an empty table makes an
    archive without records.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.monotonically_increasing_id().alias("ordinal"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "ordinal")
    groups = (
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min(key).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", F.col("first.page_id").alias("first_page"), F.col("first.ordinal").alias("first_ordinal"))
    )
    joined = lookup(rows, cut(groups), "digest")
    revisit = F.col("first_ordinal").isNotNull() & (F.col("first_ordinal") != F.col("ordinal"))
    records = joined.select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "digest",
        _record_id("page_id", "ordinal", "digest").alias("record_id"),
        F.when(revisit, _record_id("first_page", "first_ordinal", "digest")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = [r for row in batch.slice(lo, 256).to_pylist() for r in _records(row, segment_bytes, chunk_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    raw = records.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    raw.write.option("lineSep", SEPARATOR).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


# -- reading --------------------------------------------------------------


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an archive, in order."""
    at, end = 0, len(data)
    while at < end:
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        begin = stop + 4
        length = int(fields["content-length"])
        if begin + length > end:
            raise ValueError(f"record at byte {at} is cut off")
        yield fields, data[begin : begin + length]
        at = begin + length
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"no record end at byte {at}")
        at += 4


def dechunk(body: bytes) -> bytes:
    """The body of a chunked message; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        size = int(body[at:stop].partition(b";")[0], 16)
        at = stop + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError(f"chunk at byte {at} is not {size} bytes long")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The entity of an HTTP response, chunked framing decoded."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunk(body) if re.search(rb"\r\ntransfer-encoding:\s*chunked", head, re.I) else body


def read_records(spark: SparkSession, path: str, segmented: bool, id_type: str = "bigint") -> DataFrame:
    """Records of the archives in ``path``: those in segments, or the others."""
    schema = RECORD.format(id=id_type)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 4 + [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for f, block in parse(zlib.decompressobj(31).decompress(content.as_buffer())):
                    if ("warc-segment-number" in f) != segmented:
                        continue
                    name = f["warc-record-id"]
                    total = f.get("warc-segment-total-length")
                    digest = f.get("warc-payload-digest", "").rpartition(":")[2] or None
                    rows.append((
                        file, name, f.get("warc-segment-origin-id", name), f["warc-type"],
                        int(f.get("warc-segment-number", 1)), None if total is None else int(total),
                        f.get("page-id"), f.get("warc-refers-to"), digest, block,
                    ))
                    held += len(block)
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    text_id = RECORD.format(id="string")
    return files.mapInArrow(run, text_id).withColumn("page_id", F.col("page_id").cast(id_type))


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Every record of the archives, put together again.

    ``record_id``, ``type``, ``page_id``, ``refers_to`` (a record id),
    ``declared`` (the digest in the header), ``payload``, ``error``: null, or
    what is wrong (a segment missing, a length or digest that disagrees, bad
    framing); the payload is then null. Only the records of one origin meet
    in a task.
    """
    whole = read_records(spark, path, False, id_type).withColumn("length", F.lit(None).cast("long"))
    parts = read_records(spark, path, True, id_type).groupBy("origin_id").agg(
        F.sort_array(F.collect_list(F.struct("segment", "body"))).alias("s"),
        F.max("total").alias("length"),
        *[F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in ("type", "page_id", "refers_to", "digest")],
    )
    numbers = F.transform("s", lambda x: x["segment"])
    complete = numbers == F.sequence(F.lit(1), F.size("s"))
    body = F.reduce(F.transform("s", lambda x: x["body"]), F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    columns = [F.col("origin_id").alias("record_id"), "type", "page_id", "refers_to", "digest", "length"]
    joined = whole.select(*columns, "body", F.lit(True).alias("complete")).unionByName(
        parts.select(*columns, body.alias("body"), (complete & F.col("length").isNotNull()).alias("complete"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, errors = [], []
            for row in batch.select(["type", "digest", "length", "complete", "body"]).to_pylist():
                payload, error = None, None
                try:
                    if not row["complete"]:
                        error = "segments are missing"
                    elif row["length"] not in (None, len(row["body"])):
                        error = f"{len(row['body'])} bytes in segments, {row['length']} declared"
                    else:
                        payload = payload_of(row["body"])
                        if row["type"] == "response" and row["digest"] not in (None, hashlib.sha256(payload).hexdigest()):
                            payload, error = None, "digest disagrees"
                except ValueError as e:
                    payload, error = None, str(e)
                payloads.append(payload)
                errors.append(error)
            kept = [batch.column(c) for c in ("record_id", "type", "page_id", "refers_to", "digest")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(payloads, pa.binary()), pa.array(errors, pa.string())],
                names=["record_id", "type", "page_id", "refers_to", "declared", "payload", "error"],
            )

    return joined.mapInArrow(
        run,
        f"record_id string, type string, page_id {id_type}, refers_to string, declared string, payload binary, error string",
    )


def page_records(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` to archives in ``path``, read them back, and resolve
    revisits: ``page_id``, ``payload_bytes``, ``payload_digest`` (both of the
    full payload), ``record_type``, ``refers_to`` (a page id), ``error``."""
    spark = pages.sparkSession
    write_archives(pages, path)
    kind = pages.select("page_id").schema[0].dataType.simpleString()
    read = read_archives(spark, path, kind).select(
        "record_id", "type", "page_id", "refers_to", "declared", "error",
        F.when(F.col("type") == "response", F.octet_length("payload")).cast("long").alias("bytes"),
        F.when(F.col("type") == "response", F.sha2("payload", 256)).alias("digest"),
    )
    read = cut(read)
    target = read.filter("type = 'response'").select(
        F.col("record_id").alias("t_id"), F.col("page_id").alias("t_page"), F.col("bytes").alias("t_bytes"), F.col("digest").alias("t_digest")
    )
    responses = read.filter("type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.lit(None).cast(kind).alias("refers_to"), "error",
    )
    found = read.filter("type = 'revisit'").join(target, F.col("refers_to") == F.col("t_id"), "left")
    agrees = F.col("t_digest").eqNullSafe(F.col("declared"))
    revisits = found.select(
        "page_id", F.col("t_bytes").alias("payload_bytes"), F.col("t_digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("t_page").alias("refers_to"),
        F.coalesce("error", F.when(~agrees, F.lit("the record it refers to is missing or differs"))).alias("error"),
    )
    return responses.unionByName(revisits)
