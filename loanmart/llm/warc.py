"""WARC archives: index first, then coalesced byte-range reads.

Writing: every task writes one archive (a gzip member per record) straight to
the shared folder and returns an index row per record - file, offset, length,
URL, digest.  A file's name holds the task attempt, and only files named by
the committed index count, so a repeated or speculative task does no harm.
Payload bytes are written once: of records with equal payloads one is a
``response``, the others are ``revisit`` records that refer to it.

Reading: the selected index rows are sorted by file and offset, neighbours
are coalesced into one range as long as the gap between them is small, and a
task reads each range with one request and parses the records in it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, scratch, written

INDEX = "file string, offset long, length long, url string, digest string, record_id string, record_type string"
_INDEX = ["file", "offset", "length", "url", "digest", "record_id", "record_type"]
RECORD = "record_id string, url string, record_type string, refers_to string, digest string, payload binary"
_RECORD = ["record_id", "url", "record_type", "refers_to", "digest", "payload"]
CRLF = b"\r\n"
#: Largest number of unwanted bytes read to save a request, and the largest range.
GAP_BYTES, RANGE_BYTES = 64 << 10, 4 << 20
#: Archive bytes for one reading task: the index is small, so its own size must not set the number of tasks.
TASK_BYTES = 32 << 20
#: Bytes a writer buffers before it hands them to the store.
BUFFER_BYTES = 1 << 20


def sha1_label(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def one_line(url: str | None) -> str | None:
    """A URL as a header can hold it."""
    return None if url is None else "".join(url.splitlines())


def encode_record(rid: str, url: str | None, kind: str, payload: bytes | None, digest: str, refers_to: str | None) -> bytes:
    """One gzip member: WARC headers, an HTTP header block, the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (payload or b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", one_line(url) or ""), ("WARC-Payload-Digest", digest)]
    if refers_to is not None:
        head += [("WARC-Refers-To", refers_to),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    raw = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}".encode() + CRLF for k, v in head) + CRLF + body + CRLF + CRLF
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def decode_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(CRLF + CRLF)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(CRLF + CRLF)[2]


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write rows ``(record_id, url, record_type, refers_to, payload)`` as
    archives under ``folder`` and return their index (see INDEX)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        fs, path = pafs.FileSystem.from_uri(folder)
        out, at = None, 0
        for batch in batches:
            index = []
            for row in batch.to_pylist():
                payload = row["payload"] or b""
                digest = sha1_label(payload)
                kind = row["record_type"]
                data = encode_record(row["record_id"], row["url"], kind, payload if kind == "response" else None, digest, row["refers_to"])
                if out is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None, buffer_size=BUFFER_BYTES)
                out.write(data)
                index.append((f"{folder}/{name}", at, len(data), one_line(row["url"]), digest, row["record_id"], kind))
                at += len(data)
            if index:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i != 3 else pa.array(c, pa.string()) for i, c in enumerate(zip(*index))], names=_INDEX)
        if out is not None:
            out.close()

    return written(records.select("record_id", "url", "record_type", "refers_to", "payload").mapInArrow(write, INDEX), "warc-index")


def coalesced(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted ``(file, offset, length)`` to ranges ``(file, start, end, members)``."""
    file, start, end, members = None, 0, 0, []
    for f, offset, length in rows:
        if members and (f != file or offset - end > GAP_BYTES or offset + length - start > RANGE_BYTES):
            yield file, start, end, members
            members = []
        if not members:
            file, start = f, offset
        members.append((offset, length))
        end = offset + length
    if members:
        yield file, start, end, members


def read_records(index: DataFrame) -> DataFrame:
    """The records (see RECORD) that the selected ``index`` rows point at."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            name, source = None, None
            for file, start, end, members in coalesced(rows):
                if file != name:
                    if source is not None:
                        source.close()
                    fs, path = pafs.FileSystem.from_uri(file)
                    name, source = file, fs.open_input_file(path)
                data = memoryview(source.read_at(end - start, start))
                out = []
                for offset, length in members:
                    h, payload = decode_record(data[offset - start: offset - start + length])
                    out.append((h["WARC-Record-ID"], h["WARC-Target-URI"], h["WARC-Type"], h.get("WARC-Refers-To"), h["WARC-Payload-Digest"], payload))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i == 5 else pa.string()) for i, c in enumerate(zip(*out))], names=_RECORD)
            if source is not None:
                source.close()

    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = -(-size // TASK_BYTES) or 1
    ordered = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(read, RECORD)


def page_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Rows for ``write_archives``, one per page: equal payloads of at least
    ``min_bytes`` bytes become one response (the largest page_id) and revisits.

    Payloads are equal when length and SHA-256 agree.  A record is named by its
    page_id and its payload's SHA-256, so pages that share a page_id, or have
    none, stay apart.  Pages that repeat page_id and payload of the response
    are revisits of nothing: they are responses too.  A null page_id is never
    the response of a group that has another id.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.cast("binary").alias("payload"))
    keyed = rows.withColumn("size", F.octet_length("payload")).withColumn("sha", F.unhex(F.sha2("payload", 256)))
    first = (keyed.where(F.col("size") >= min_bytes).groupBy("sha", "size")
             .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "size", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(":"), F.lower(F.hex("sha")), F.lit(">"))
    return keyed.join(first, ["sha", "size"], "left").select(
        name(F.col("page_id")).alias("record_id"), "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, name(F.col("first"))).alias("refers_to"), "payload")


def pages_round_trip(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Archive every page, read the archives back by their index, and return
    per page ``(page_id, payload_bytes, payload_digest, record_type,
    refers_to)`` from the records read.

    ``payload_digest`` is the lower-case hex SHA-1 of the full payload.  A
    revisit has no payload of its own; its length is that of the response it
    refers to, and its digest is checked against that response (a mismatch
    raises).  A null html is an empty payload.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    index = write_archives(page_records(pages, min_bytes), scratch(spark, "warc"))
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+):", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    got = read_records(index).select(
        "record_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1"))
    got = written(got, "warc-read")
    responses = got.where("record_type = 'response'")
    target = (got.where("record_type = 'revisit'").select("refers_to").distinct()
              .join(responses.select(F.col("record_id").alias("refers_to"), F.col("size").alias("size0"), F.col("sha1").alias("sha0"), F.col("digest").alias("digest0"))
                    .distinct(), "refers_to"))
    revisits = got.where("record_type = 'revisit'").join(target, "refers_to", "left")
    sound = F.when(F.col("digest").eqNullSafe(F.col("digest0")), F.col("sha0")).otherwise(
        F.raise_error(F.concat(F.lit("revisit without its response: "), F.col("record_id"))))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(number(F.col("record_id")).alias(cols[0]), F.col("size").alias(cols[1]), F.col("sha1").alias(cols[2]),
                            "record_type", F.lit(None).cast("long").alias(cols[4])).unionByName(
        revisits.select(number(F.col("record_id")).alias(cols[0]), F.col("size0").alias(cols[1]), sound.alias(cols[2]),
                        "record_type", number(F.col("refers_to")).alias(cols[4])))
