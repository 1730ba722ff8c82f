"""WARC archives: one gzip member per record, written in parallel, read back sequentially with every digest verified.

Writing: records of a task are compressed one by one and gathered into archive files of about `FILE_BYTES`; Spark's
committer puts each file in place once, whatever executors are lost, on any file system that Spark reaches. Spark's
text writer ends a file with a line separator, which here is an empty gzip member, so that files stay valid gzip.

Reading: a file's bytes pass through zlib in small pieces, member by member; the header is parsed, the block is framed
by Content-Length, and both digests are verified. A damaged file raises.

Of records with equal payloads of at least `revisit_min_bytes`, that with the smallest page_id is a response and
the others revisit it; smaller payloads are all responses.

Defined cases: null html is an empty payload; a null url becomes `urn:page:<id>`, control characters in a url are
percent-encoded; a null page_id is kept and is never what others refer to, unless no other has the payload (then all
are responses); rows that repeat the smallest page_id with its payload are responses too; an empty table gives no
records, in one archive without content; other columns are not read; payloads of any length are one record each.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.llm.common import is_small, salted, shared_folder, table

FILE_BYTES = 8 << 20
PIECE = 1 << 16
SALTS = 32
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member without content.
EMPTY_MEMBER = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 0xFF, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload}')}>"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record as one gzip member."""
    sha1 = digest(payload)
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    block = "\r\n".join(lines).encode()
    if refers_to is None:
        block += payload
        kind = ["WARC-Type: response"]
    else:
        kind = ["WARC-Type: revisit", f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, sha1)}"]
        kind.append(f"X-Refers-To-Page: {refers_to}")
    target = f"urn:page:{page_id}" if url is None else quote(url, safe="".join(map(chr, range(33, 127))))
    header = [
        "WARC/1.1",
        *kind,
        f"WARC-Record-ID: {record_id(page_id, sha1)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        *([] if page_id is None else [f"X-Page-Id: {page_id}"]),
        "",
        "",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(header).encode() + block + b"\r\n\r\n") + packer.flush()


def with_record_types(pages: DataFrame, revisit_min_bytes: int = 0) -> DataFrame:
    """Adds `payload` and `refers_to`. Copies are counted by digest before anything is shuffled."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload")))
    repeated = (
        rows.where(F.octet_length("payload") >= revisit_min_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1 and first is not null")
        .select("sha1", "first")
    )
    if is_small(repeated):
        joined = rows.join(F.broadcast(repeated), "sha1", "left")
    else:  # a hot payload's rows are dealt out over salted keys
        dealt = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", salted(F.col("sha1"), SALTS, F.col("page_id"))).join(dealt, ["sha1", "salt"], "left")
    refers_to = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    return joined.select("page_id", "url", "payload", refers_to.alias("refers_to"))


def write_warc(pages: DataFrame, path: str, revisit_min_bytes: int = 0, date: str | None = None) -> str:
    """Writes a record per page and returns the folder of archives."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        # Spark opens the first partition's file even if it has no rows: a member without content keeps it valid gzip.
        wrote = TaskContext.get().partitionId() > 0
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                data = member(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), date)
                held.append(data)
                size += len(data)
                if size >= FILE_BYTES:
                    yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(held)], pa.binary())})
                    held, size, wrote = [], 0, True
        if held or not wrote:
            yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(held)], pa.binary())})

    (
        with_record_types(pages, revisit_min_bytes)
        .mapInArrow(archives, "archive binary")
        .select(F.col("archive").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .text(path)
    )
    return path


def members_of(content: bytes) -> Iterator[bytes]:
    """The decompressed members of a file, one at a time, fed to zlib piece by piece."""
    view, at = memoryview(content), 0
    while at < len(view):
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            out.append(unpacker.decompress(view[at : at + PIECE]))
            at = min(at + PIECE, len(view)) - len(unpacker.unused_data)
        if any(out):
            yield b"".join(out)


def record_of(data: bytes) -> dict:
    """Header fields and block of a record, framed by its Content-Length, digests verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:40]}")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    block = rest[:length]
    if len(block) < length or rest[length:] != b"\r\n\r\n":
        raise ValueError("Content-Length doesn't frame the record")
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    response = fields["WARC-Type"] == "response"
    if response and fields["WARC-Payload-Digest"] != f"sha1:{digest(payload)}":
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    full = len(payload) if response else int(http.decode().rpartition("Content-Length: ")[2])
    optional = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": optional("X-Page-Id"),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": full,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "record_type": fields["WARC-Type"],
        "refers_to": optional("X-Refers-To-Page"),
        "payload": payload if response else None,
    }


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row per record of all archives below `path`; with `payloads`, the bytes of responses too."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    schema = schema.append(pa.field("record_type", pa.string())).append(pa.field("refers_to", pa.int64()))
    schema = schema.append(pa.field("payload", pa.binary())) if payloads else schema

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for data in members_of(content.as_py()):
                    rows.append(record_of(data))
                    size += len(data) if payloads else 200
                    if size >= FILE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(records, RECORD + (", payload binary" if payloads else ""))


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), shared_folder(spark, "warc"))
    return read_warc(spark, path).drop("url")
