"""WARC archives compressed record by record with a shared Zstandard dictionary.

An archive is one file: a skippable frame that holds the dictionary, then one Zstandard
frame for each record. Spark's own text writer lays the frames down, so the files go
through its committer to any file system, and a lost task is simply run again. The line
separator of that writer is itself an empty skippable frame, which readers pass over.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from veil.llm.common import stored
from veil.runtime import measured

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FILLER = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads from this size on are stored once.
LEAST_SHARED_BYTES = 100
#: Payload bytes of an archive, about.
ARCHIVE_BYTES = 16 << 20
#: The dictionary is built from this many records (the first by a hash of their id), 64 KB of each.
DICTIONARY_RECORDS = 400
DICTIONARY_SAMPLE_BYTES = 64 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit of page ``refers_to`` without the payload."""
    revisit = refers_to is not None
    target = (url or f"urn:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (b"" if revisit else payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> dict:
    """Header fields and payload of one record; raises if lengths or the digest of a response don't fit."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    if len(rest) != length + 4:
        raise ValueError(f"a record of {len(rest) - 4} bytes announces {length}")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "payload_bytes": size,
        "payload_digest": digest, "refers_to": number("X-Refers-To-Page"), "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; from too few or too uniform samples, their own bytes as one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def skippable(payload: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(payload)) + payload


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, each decompressed on its own with the embedded dictionary."""
    view, at, inflate = memoryview(archive), 0, None
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at) if len(view) - at >= 8 else (0, 0)
        if magic in SKIPPABLE:
            if magic == DICTIONARY_MAGIC and inflate is None:
                inflate = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[at + 8:at + 8 + size])))
            at += 8 + size
            continue
        one, parts = (inflate or zstandard.ZstdDecompressor()).decompressobj(), []
        while not one.eof:
            piece = view[at:at + 16384]
            if not len(piece):
                raise ValueError("an archive ends inside a record")
            parts.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(parts)


def with_payload(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to) of (page_id, url, html)."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).withColumn("payload_digest", F.sha2("payload", 256))
    shared = (
        rows.where(F.col("payload_bytes") >= LEAST_SHARED_BYTES).groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("payload_digest", "first")
    )
    shared = stored(shared, "shared-payloads")
    return rows.join(measured(shared), "payload_digest", "left").withColumn(
        "refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    ).drop("first")


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives of all rows of ``pages`` (page_id, url, html) below ``path``.

    Of equal payloads of at least ``LEAST_SHARED_BYTES`` bytes the row with the smallest page_id is
    a response, the others revisit it. Null html is an empty payload. A null page_id sorts last; rows that
    repeat the smallest id are responses each. Other columns are not read. An empty table makes no record.
    """
    total = pages.agg(F.sum(F.octet_length("html").cast("bigint"))).first()[0] or 0
    archives = max(1, -(-total // ARCHIVE_BYTES))

    def train(batches):
        samples = [s for batch in batches for s in batch.column(0).to_pylist()]
        yield pa.record_batch([pa.array([build_dictionary(samples)], pa.binary())], ["dictionary"])

    def record(p, u, b, n, d, r):
        return encode_record(p, u, b, n, d, r)

    rows = with_payload(pages)
    chosen = pages.select("page_id", "url", F.substring("html", 1, DICTIONARY_SAMPLE_BYTES // 4).alias("html"))
    chosen = chosen.orderBy(F.xxhash64("page_id"), "page_id").limit(DICTIONARY_RECORDS)

    def samples(batches):
        for batch in batches:
            found = []
            for p, u, h in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                b = (h or "").encode("utf-8", "surrogatepass")
                found.append(record(p, u, b, len(b), hashlib.sha256(b).hexdigest(), None))
            yield pa.record_batch([pa.array(found, pa.binary())], ["record"])

    made = chosen.mapInArrow(samples, "record binary").coalesce(1).mapInArrow(train, "dictionary binary").collect()
    shared = pages.sparkSession.sparkContext.broadcast(bytes(made[0][0]) if made else b"")

    def compress(batches):
        whole = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=whole) if whole else zstandard.ZstdCompressor(level=LEVEL)
        first = True
        names = ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
        for batch in batches:
            columns = [batch.column(c) for c in names]
            for at in range(0, batch.num_rows, 256):
                part = [c.slice(at, 256).to_pylist() for c in columns]
                out = [press.compress(record(*x)) for x in zip(*part, strict=True)]
                if first:
                    out.insert(0, skippable(shared.value))
                    first = False
                yield pa.record_batch([pa.array(out, pa.binary())], ["frame"])

    packed = rows.repartition(archives, F.xxhash64("page_id", "payload_digest")).mapInArrow(compress, "frame binary")
    packed.select(F.col("frame").cast("string")).write.option("lineSep", FILLER).option("compression", "none").text(path)


RECORDS = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``RECORDS`` of all archives below ``path``; a revisit has no payload. Payloads of responses are checked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def parse(batches):
        for batch in batches:
            for archive in batch.column(0):
                rows = []
                for record in frames(archive.as_py()):
                    row = decode_record(record)
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    if len(rows) == 512:
                        yield _records(rows, names)
                        rows = []
                if rows:
                    yield _records(rows, names)

    return files.select("content").mapInArrow(parse, RECORDS)


def _records(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)
