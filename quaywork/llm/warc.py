"""WARC archives: one gzip member a record, written and read in sequence."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywork.llm.common import settle, whole_text
from quaywork.session import scratch_path

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
END = b"\r\n\r\n"
CHUNK = 1 << 20


class ArchiveError(ValueError):
    """An archive that is cut short, badly framed, or whose digests differ."""


def record_bytes(fields: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member of its own."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields), b"Content-Length: %d" % len(block)]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + END + block + END) + packer.flush()


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _one_line(text: str) -> str:
    return " ".join(text.split())


def page_record(page: dict, date: str, level: int) -> bytes:
    """The record of one marked page (see :func:`mark_revisits`)."""
    body = (page["payload"] or "").encode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {page['payload_bytes']}\r\n\r\n"
    ).encode()
    name = f"urn:page:{page['page_id']}" if page["page_id"] is not None else f"urn:uuid:{uuid.uuid4()}"
    block = http + body
    fields = [
        ("WARC-Type", page["record_type"]),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", _base32(bytes.fromhex(page["payload_digest"]))),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())),
        ("Content-Type", HTTP_TYPE),
    ]
    if page["url"] is not None:
        fields.append(("WARC-Target-URI", _one_line(page["url"])))
    if page["refers_to"] is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{page['refers_to']}>")]
    return record_bytes(fields, block, level)


def mark_revisits(
    pages: DataFrame, least_bytes: int = 1000, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Pages with payload size, SHA-1, record type, and what a revisit refers to.

    Among payloads of at least ``least_bytes`` that are equal, the page with the
    largest key is the response and the others revisit it.  Only digests that
    occur more than once are joined back, one row each.
    """
    payload = whole_text(F.col(f"`{html}`"))
    sized = pages.select(
        F.col(f"`{key}`").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"),
    )
    repeats = settle(
        sized.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1 AND latest IS NOT NULL")
        .select("payload_digest", "latest"),
        "repeats",
    )
    joined = sized.join(repeats, "payload_digest", "left")
    revisit = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return joined.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("latest")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 1000,
    max_file_bytes: int = 1 << 28,
    date: str = "1970-01-01T00:00:00Z",
    level: int = 6,
    **columns: str,
) -> DataFrame:
    """Write one record per page and return the files: path, records, bytes.

    ``folder`` must be reachable by every executor; by default a new one in the
    shared scratch folder.  Each task writes files under names of its own
    attempt and starts another when one is full; the list has the files of the
    tasks that counted, so what a lost task left behind is never read.

    Null payload: empty.  Null key: a record with a random name, read back as a
    null key.  Null address: left out.  Repeated rows: a record each; repeats of
    the page that is the response are responses too.  Other columns are left
    out.  Empty input: no files.
    """
    folder = folder or scratch_path(pages.sparkSession, "archives")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        task = TaskContext.get()
        stem = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        done, out, name, count, size = [], None, "", 0, 0
        try:
            for batch in batches:
                for page in batch.to_pylist():
                    if out is None:
                        name, count, size = f"{stem}-{len(done):04d}.warc.gz", 0, 0
                        out = store.open_output_stream(name, compression=None)
                        info = [
                            ("WARC-Type", "warcinfo"),
                            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                            ("WARC-Date", date),
                            ("Content-Type", "application/warc-fields"),
                        ]
                        out.write(record_bytes(info, b"format: WARC File Format 1.1\r\n", level))
                    data = page_record(page, date, level)
                    out.write(data)
                    count, size = count + 1, size + len(data)
                    if size >= max_file_bytes:
                        out.close()
                        out = None
                        done.append((name, count, size))
        finally:
            if out is not None:
                out.close()
                done.append((name, count, size))
        rows = [{"path": p, "records": c, "bytes": s} for p, c, s in done]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(FILES))

    FILES = [("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]
    marked = mark_revisits(pages, least_bytes, **columns)
    files = settle(marked.mapInArrow(write, "path string, records bigint, bytes bigint"), "archive-files")
    scheme = folder.split("://", 1)[0] + "://" if "://" in folder else ""
    host = folder.split("://", 1)[1].split("/", 1)[0] if scheme else ""
    return files.withColumn("path", F.concat(F.lit(scheme + host), F.col("path")))


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of each gzip member, decompressed as chunks arrive; the last must be whole."""
    packer, parts, fresh = zlib.decompressobj(31), [], True
    for chunk in chunks:
        while chunk:
            fresh = False
            parts.append(packer.decompress(chunk))
            if not packer.eof:
                break
            chunk = packer.unused_data
            yield b"".join(parts)
            packer, parts, fresh = zlib.decompressobj(31), [], True
    if not fresh:
        raise ArchiveError("the last record is cut short")


def parse_record(data: bytes, verify: bool = True) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record, framed by its content length; digests are checked."""
    head, found, rest = data.partition(END)
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ArchiveError("a record has no header")
    pairs = (line.decode().split(":", 1) for line in lines[1:])
    fields = {k.strip().lower(): v.strip() for k, v in pairs}
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != END:
        raise ArchiveError(f"{fields.get('warc-record-id')} does not end where its length says")
    stated = fields.get("warc-block-digest")
    if verify and stated and stated != _base32(hashlib.sha1(block).digest()):
        raise ArchiveError(f"{fields.get('warc-record-id')} differs from its block digest")
    return fields, block


def _key_in(name: str | None) -> int | None:
    text = (name or "").strip("<>")
    return int(text.removeprefix("urn:page:")) if text.startswith("urn:page:") else None


def page_row(fields: dict[str, str], block: bytes, verify: bool, with_payload: bool) -> dict:
    head, _, payload = block.partition(END)
    lengths = [line for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
    if fields["warc-type"] == "response":
        if verify and hashlib.sha1(payload).digest() != digest:
            raise ArchiveError(f"{fields['warc-record-id']} differs from its payload digest")
        if int(lengths[0].split(b":")[1]) != len(payload):
            raise ArchiveError(f"{fields['warc-record-id']} differs from its HTTP length")
    row = {
        "page_id": _key_in(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": int(lengths[0].split(b":")[1]),
        "payload_digest": digest.hex(),
        "record_type": fields["warc-type"],
        "refers_to": _key_in(fields.get("warc-refers-to")),
    }
    if with_payload:
        row["payload"] = payload.decode() if fields["warc-type"] == "response" else None
    return row


def read_archives(files: DataFrame, verify: bool = True, with_payload: bool = True) -> DataFrame:
    """The pages of the archives listed in ``files`` (path), each file read in sequence by one task.

    One row per response or revisit: page_id, url, payload_bytes, payload_digest
    (hex), record_type, refers_to, and the payload (null for revisits).  Memory
    holds one record at a time.  A file that is cut short, badly framed, or
    whose digests differ raises :class:`ArchiveError`.  No files: no rows.
    """
    names = [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        *([("payload", pa.string())] if with_payload else []),
    ]
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, " + (
        "refers_to bigint, payload string" if with_payload else "refers_to bigint"
    )

    def chunks(path: str) -> Iterator[bytes]:
        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_stream(name, compression=None) as file:
            while chunk := file.read(CHUNK):
                yield chunk

    def rows(paths: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in paths:
            for path in batch.column(0).to_pylist():
                for data in members(chunks(path)):
                    fields, block = parse_record(data, verify)
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    held.append(page_row(fields, block, verify, with_payload))
                    size += len(block)
                    if len(held) >= 1000 or with_payload and size >= 1 << 24:
                        yield pa.RecordBatch.from_pylist(held, pa.schema(names))
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, pa.schema(names))

    spread = files.select("path").repartition(max(1, files.count()))
    return spread.mapInArrow(rows, schema)
