"""Web archives of individually compressed records with a shared Zstandard dictionary.

An archive is a sequence of Zstandard frames: first a skippable frame that holds the dictionary, then one
frame per WARC record, so that a record can be read on its own once the dictionary is known. Records with
a payload that another record stores are revisits and carry the HTTP header only.

Spark's text writer writes the archives: a row is a whole archive, and the line separator it puts behind
each row is an empty skippable frame, which readers pass over. So files appear by Spark's commit in
whatever store the path names, and a task that is run again leaves no half-written archive.

The dictionary is trained on a bounded sample: about ``SAMPLE_ROWS`` pages picked by a hash, in whole, of
``SAMPLE_BYTES`` at most. Too small a sample is used as raw dictionary content.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.sieve import bit_table, perhaps
from rowloom.operators.keys import apart
from rowloom.session import materialize

SAMPLE_ROWS = 1000
SAMPLE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 8 << 20
LEVEL = 6
DATE = "2026-01-01T00:00:00Z"

# fixed values of the formats
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "id string, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to string, payload binary"


def train(pages: DataFrame, payload: str) -> bytes:
    """Dictionary from a bounded sample of the pages; empty when there is nothing to learn from."""
    rows = pages.select(F.col(f"`{payload}`").cast("binary").alias("p")).filter(F.length("p") > 0)
    n = rows.count()
    if not n:
        return b""
    samples, size = [], 0
    for row in rows.filter(F.pmod(F.xxhash64("p"), F.lit(n)) < SAMPLE_ROWS).toLocalIterator():
        if size + len(row.p) > SAMPLE_BYTES or len(samples) == 2 * SAMPLE_ROWS:
            break
        samples.append(bytes(row.p))
        size += len(row.p)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _uuid(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.blake2b(f'{page}|{digest}'.encode(), digest_size=16).digest())}>"


def _record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = (url or f"urn:page:{page}").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uuid(page, digest)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if page is not None:
        head.append(f"WARC-Source-ID: {page}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_uuid(refers_to, digest)}"]
        head += [f"WARC-Refers-To-Source-ID: {refers_to}"] if refers_to is not None else []
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _archives(shared):
    def run(batches):
        dictionary = shared.value
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
        head = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        held, size = [head], len(head)
        for batch in batches:
            for page, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = payload or b""
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                held.append(compressor.compress(_record(page, url, payload, digest, refers_to, revisit)))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.record_batch({"archive": pa.array([b"".join(held)], pa.binary())})
                    held, size = [head], len(head)
        if len(held) > 1:
            yield pa.record_batch({"archive": pa.array([b"".join(held)], pa.binary())})

    return run


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> None:
    """Write a record for every page into archives below ``path``.

    Of pages with equal payloads of at least ``least_bytes`` bytes, those with the largest id are responses
    and the others revisit them. A null payload is empty; null ids are below all others. Rows that repeat
    the largest id with the same payload are all stored. Only payloads that occur twice are exchanged.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(f"`{page_id}`").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    lead = rows.filter(F.length("payload") >= least_bytes).groupBy("digest").agg(F.max("page").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    lead = materialize(lead, "repeated-payloads")
    twice = rows.withColumn("twice", perhaps(bit_table(lead.select(F.xxhash64("digest").alias("h")), "h"), F.xxhash64("digest")))
    joined = twice.filter("twice").join(lead.select(apart("digest").alias("key"), "lead"), F.col("digest") == F.col("key"), "left")
    revisit = F.col("key").isNotNull() & ~F.col("page").eqNullSafe(F.col("lead"))
    columns = [F.col("page").cast("string").alias("page"), "url", "payload"]
    out = twice.filter(~F.col("twice")).select(*columns, F.lit(None).cast("string").alias("lead"), F.lit(False).alias("revisit"))
    out = out.union(joined.select(*columns, F.when(revisit, F.col("lead").cast("string")), revisit))
    archives = out.mapInArrow(_archives(spark.sparkContext.broadcast(train(pages, payload))), "archive binary")
    archives.select(F.col("archive").cast("string")).write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)


def frames(data: bytes):
    """(dictionary or None, start, end) of every record frame, by walking frame and block headers."""
    dictionary, at = None, 0
    while at < len(data):
        (magic,) = struct.unpack_from("<I", data, at)
        if magic in SKIPPABLE:
            (size,) = struct.unpack_from("<I", data, at + 4)
            if magic == DICTIONARY_MAGIC:
                dictionary = data[at + 8 : at + 8 + size]
            at += 8 + size
            continue
        start = at
        header = data[at : at + 18]
        at += zstandard.frame_header_size(header)
        last = False
        while not last:
            block = int.from_bytes(data[at : at + 3], "little")
            last = bool(block & 1)
            at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        at += 4 * zstandard.get_frame_parameters(header).has_checksum
        yield dictionary, start, at


def parse(record: bytes) -> dict:
    """A record's fields; the payload of a response is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(named["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = named["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = named["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {named['WARC-Record-ID']} does not match its digest")
    return {
        "id": named.get("WARC-Source-ID"), "url": named["WARC-Target-URI"], "record_type": named["WARC-Type"], "payload_digest": digest,
        "payload_bytes": size, "refers_to": named.get("WARC-Refers-To-Source-ID"), "payload": None if revisit else payload,
    }


def _records(with_payload: bool):
    kind = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in ("id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload")])

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                data, held = content.as_py(), []
                used, decompressor = None, zstandard.ZstdDecompressor()
                for dictionary, start, end in frames(data):
                    if dictionary is not used:
                        used, decompressor = dictionary, zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
                    held.append(parse(decompressor.decompress(data[start:end])) | ({} if with_payload else {"payload": None}))
                    if len(held) == 256:
                        yield pa.RecordBatch.from_pylist(held, schema=kind)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kind)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``; every response is checked against its digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_records(with_payload), RECORD)
