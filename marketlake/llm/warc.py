"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record.

Pages become response records; of equal payloads of at least ``SHARED_BYTES`` bytes only that of the largest page id
keeps its payload, the others are revisits that refer to it. Tasks pack records into archives of a bounded size, each
with a dictionary trained on its own first records (``SAMPLE_BYTES``, a bound by design). Spark's text writer stores
every archive as one file; the line end it adds is an empty skippable frame, which Zstandard readers pass over.
Reading loads the dictionary, finds each frame by its block headers, decodes it alone, and checks the record's version
line, lengths, end and payload digest; a fault raises ``ValueError`` with the offset.

Defined results: a NULL html is an empty payload; rows with the same page id and payload are both responses; a NULL
page id counts below every id; an empty table gives no archives; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import stored
from marketlake.session import scratch_path

SHARED_BYTES = 1000
ARCHIVE_BYTES = 32 << 20  # payload and headers in one archive
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # the pages table has no time of capture

#: Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
EMPTY_FRAME = struct.pack("<II", SKIPPABLE_MAGIC, 0).decode("ascii")


# --- records ---------------------------------------------------------------------------------------------------------


def sha1_header(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id: int | None, url: str, digest: bytes) -> str:
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, url + digest.hex())}>"
    return f"<urn:page:{page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = hashlib.sha1(payload).digest()
    url = (url or "").replace("\r", "%0D").replace("\n", "%0A").strip()
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    )
    block = http if refers_to is not None else http + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, url, digest),
        "WARC-Date": DATE,
        **({"WARC-Target-URI": url} if url else {}),
        "WARC-Payload-Digest": sha1_header(digest),
        **({} if refers_to is None else {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, "", b"")}),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items())]
    return b"\r\n".join(lines) + END + block + END


def header_lines(head: bytes, at: int) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"offset {at}: header line without a name: {line[:60]!r}")
        out[name.decode().strip().lower()] = value.decode().strip()
    return out


def page_of(urn: str | None) -> int | None:
    prefix = "<urn:page:"
    return int(urn[len(prefix) : -1]) if urn and urn.startswith(prefix) else None


def parse(data: bytes, at: int) -> dict:
    """The one record of a frame."""
    head, gap, rest = data.partition(END)
    first, _, lines = head.partition(b"\r\n")
    if first != VERSION or not gap:
        raise ValueError(f"offset {at}: no WARC version line")
    headers = header_lines(lines, at)
    length = headers.get("content-length", "")
    if not length.isdigit() or len(rest) != int(length) + len(END) or not rest.endswith(END):
        raise ValueError(f"offset {at}: the block is not of its Content-Length")
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit") or "warc-record-id" not in headers or "warc-date" not in headers:
        raise ValueError(f"offset {at}: a required header is missing")
    http, gap, payload = rest[: -len(END)].partition(END)
    inner = header_lines(http.partition(b"\r\n")[2], at)
    size, digest = inner.get("content-length", ""), headers.get("warc-payload-digest", "")
    if not gap or not size.isdigit() or not digest.startswith("sha1:"):
        raise ValueError(f"offset {at}: no payload length or digest")
    if kind == "response" and (len(payload) != int(size) or sha1_header(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"offset {at}: the payload does not fit its length or digest")
    return {
        "page_id": page_of(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": int(size),
        "payload_digest": base64.b32decode(digest[5:]).hex(),
        "record_type": kind,
        "refers_to": page_of(headers.get("warc-refers-to")),
        "payload": payload if kind == "response" else None,
    }


# --- archives --------------------------------------------------------------------------------------------------------


def dictionary_of(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Trained on the first records; None if there is too little to train on."""
    samples, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        samples.append(r[: SAMPLE_BYTES - size])
        size += len(r)
    if len(samples) < 16 or size < 8 * DICTIONARY_BYTES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
    except zstandard.ZstdError:
        return None


def archive(records: list[bytes]) -> bytes:
    known = dictionary_of(records)
    out = []
    if known is not None:
        packed = zstandard.ZstdCompressor(level=19).compress(known.as_bytes())
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True, write_content_size=True)
    out += [packer.compress(r) for r in records]
    return b"".join(out)


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends: its header, its blocks by their headers, its checksum."""
    checked = data[at + 4] & 4
    place = at + zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        if place + 3 > len(data):
            raise ValueError(f"offset {at}: the frame is cut short")
        header = int.from_bytes(data[place : place + 3], "little")
        last, kind, size = header & 1, header >> 1 & 3, header >> 3
        place += 3 + (1 if kind == 1 else size)
    place += 4 if checked else 0
    if place > len(data):
        raise ValueError(f"offset {at}: the frame is cut short")
    return place


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded bytes) of every frame of an archive."""
    data, at, known = memoryview(content), 0, None
    unpacker = zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError(f"offset {at}: the archive is cut short")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            if magic == DICTIONARY_MAGIC and at == 0:
                own = bytes(data[8 : 8 + size])
                if own[:4] == struct.pack("<I", FRAME_MAGIC):
                    own = zstandard.ZstdDecompressor().decompress(own)
                known = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_FULLDICT)
                unpacker = zstandard.ZstdDecompressor(dict_data=known)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"offset {at}: neither a frame nor a skippable frame")
        end = frame_end(data, at)
        try:
            yield at, unpacker.decompress(data[at:end])
        except zstandard.ZstdError as fault:
            raise ValueError(f"offset {at}: {fault}") from fault
        at = end


# --- jobs ------------------------------------------------------------------------------------------------------------


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (page_id, url, payload, refers_to) as archives, one a row."""

    def whole(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([archive(records)], pa.binary())], names=["archive"])

    held, size = [], 0
    for batch in batches:
        for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(record(page_id, url, payload or b"", refers_to))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield whole(held)
                held, size = [], 0
    if held:
        yield whole(held)


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives of all rows of ``pages`` (page_id, url, html) below ``path``."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    shared = rows.where(F.octet_length("payload") >= SHARED_BYTES).groupBy("digest")
    responses = stored(
        shared.agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-responses"
    )
    typed = rows.join(responses, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        F.when(F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias(
            "refers_to"
        ),
    )
    archives = typed.mapInArrow(pack, "archive binary")
    lines = archives.select(F.col("archive").cast("string").alias("value"))  # the bytes stay as they are
    lines.write.option("maxRecordsPerFile", 1).option("lineSep", EMPTY_FRAME).text(path)


FIELDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record of the archives below ``path``."""
    schema = ARROW.append(pa.field("payload", pa.binary())) if with_payload else ARROW

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [parse(data, at) for at, data in frames(content.as_py())]
                yield pa.RecordBatch.from_pylist(
                    [{k: r[k] for k in schema.names} for r in rows], schema=schema
                )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(records, FIELDS + (", payload binary" if with_payload else ""))


def warc_report(pages: DataFrame) -> DataFrame:
    """The pages as read back from archives written of them."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, with_payload=False).drop("url")


ORACLE = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
r AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS response FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM r
"""
