"""WARC archives: a writer with revisit records, and a reader that splits compressed archives by byte ranges.

Each record is a gzip member of its own.  A reading task takes a byte range, looks for
the gzip magic, and takes a place for a record only if what it holds decodes to the
head of a WARC record: the magic also occurs by chance within compressed data.  A
range owns the records that start in it, reading past its end where the last one goes on.

Archives are opened with ``pyarrow.fs``, by URI: local or mounted folders, HDFS, S3, GCS, Azure.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.llm.batches import byte_slices
from rosterflow.session import materialize

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
ARCHIVE_BYTES = 1 << 30


# ------------------------------------------------------------------ classifying


def classify(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", least: int = 100) -> DataFrame:
    """``key, url, payload, digest, bytes, record_type, refers_to`` of every page.

    Of pages with equal payloads of ``least`` bytes or more, that with the smallest key
    is the response and the others revisit it; smaller pages are responses.  A null body
    is the empty payload.  Pages that share the smallest key are all responses; a
    null key revisits if any page of its payload has a key.  Groups are combined before
    the shuffle and joined with the pages as the small side, so that a payload of
    very many pages can be split.
    """
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("bigint").alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("bytes"), F.unhex(F.sha2(payload, 256)).alias("digest"),
    )
    groups = (
        rows.where(F.col("bytes") >= least).groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("shared"), "first")
    )
    revisits = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    return rows.join(groups, rows.digest == groups.shared, "left").select(
        "key", "url", "payload", "digest", "bytes",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first")).alias("refers_to"),
    )


# ---------------------------------------------------------------------- writing


def record(key, url: str | None, payload: bytes, digest: bytes, kind: str, refers_to, date: str) -> bytes:
    """The bytes of one WARC record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD_ID}{'' if key is None else key}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!\"#$%&'()*+,/:;<=>?@[\\]^`{|}~"))
    head.append(f"WARC-Payload-Digest: sha256:{digest.hex()}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_ID}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Write what :func:`classify` gives to archives in ``folder``; gives ``path, size, records`` of each.

    A task writes its rows to files of its own, named by partition and attempt, and a
    new one beyond ``ARCHIVE_BYTES``.  The list that comes back is a table that Spark has
    committed: it names the files of the attempts that counted, so files that
    a lost or second attempt left are never read.  No rows give no archives.
    """
    ship(records.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, top = fs.FileSystem.from_uri(folder)
        out, path, size, count, made = None, "", 0, 0, []
        try:
            for part in byte_slices(batches, "payload"):
                for row in part.to_pylist():
                    if out is None:
                        store.create_dir(top, recursive=True)
                        name = f"part-{context.partitionId():05d}-{len(made):03d}-{context.taskAttemptId()}.warc.gz"
                        path, size, count = f"{folder}/{name}", 0, 0
                        out = store.open_output_stream(f"{top}/{name}", compression=None)
                    data = member(record(row["key"], row["url"], row["payload"], row["digest"], row["record_type"], row["refers_to"], date), level)
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        made.append((path, size, count))
                        out = None
        finally:
            if out is not None:
                out.close()
        if out is not None:
            made.append((path, size, count))
        yield pa.RecordBatch.from_pydict(
            {"path": [m[0] for m in made], "size": [m[1] for m in made], "records": [m[2] for m in made]},
            schema=pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())]),
        )

    return materialize(records.mapInArrow(write, "path string, size bigint, records bigint"), "archives")


# ---------------------------------------------------------------------- reading


class Window:
    """A file read in blocks from some place on; what lies before ``drop`` is let go."""

    def __init__(self, source, start: int, size: int):
        self.source, self.size = source, size
        self.base, self.data = start, b""
        source.seek(start)

    def more(self) -> bool:
        """Read the next block; false at the end of the file."""
        block = self.source.read(BLOCK)
        self.data += block
        return bool(block)

    def drop(self, offset: int) -> None:
        """Forget what lies before ``offset`` of the file, reading on if it isn't here yet."""
        while offset > self.base + len(self.data) and self.more():
            if offset > self.base + len(self.data):
                self.base, self.data = self.base + len(self.data), b""
        cut = min(len(self.data), offset - self.base)
        self.base, self.data = self.base + cut, self.data[cut:]

    def find_magic(self, stop: int) -> int:
        """The place of the next gzip magic before ``stop``, or -1."""
        while True:
            at = self.data.find(MAGIC)
            if at >= 0:
                return self.base + at if self.base + at < stop else -1
            if self.base + len(self.data) - len(MAGIC) + 1 >= stop:
                return -1
            keep = min(len(self.data), len(MAGIC) - 1)
            self.base, self.data = self.base + len(self.data) - keep, self.data[len(self.data) - keep :]
            if not self.more():
                return -1


def parse_head(head: bytes) -> dict[str, str] | None:
    """The fields of a WARC head by lower-case name; None if it isn't one."""
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/1.") or any(b":" not in x for x in lines[1:]):
        return None
    fields = {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, v in (x.split(b":", 1) for x in lines[1:])}
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def decode_member(window: Window, at: int) -> tuple[int, dict[str, str], bytes] | None:
    """The record whose gzip member starts at ``at``: where it ends, its head and its block.

    None if no WARC head decodes there.  A record that breaks off behind its head raises.
    """
    window.drop(at)
    inflate = zlib.decompressobj(31)
    text, fields, used, seen = bytearray(), None, 0, 0
    while not inflate.eof:
        if used >= len(window.data) and not window.more():
            break
        part = window.data[used : used + (1 << 16)]
        used += len(part)
        try:
            text += inflate.decompress(part)
        except zlib.error as error:
            if fields is None:
                return None
            raise ValueError(f"broken record at byte {at}") from error
        if fields is None:
            if not bytes(text[:7]).startswith(b"WARC/1."[: len(text)]):
                return None
            end = text.find(b"\r\n\r\n", seen)
            if end < 0:  # a head has no limit: its url may be of any length
                seen = max(0, len(text) - 3)
                continue
            fields = parse_head(bytes(text[:end]))
            if fields is None:
                return None
            begin = end + 4
    if fields is None:
        return None
    length = int(fields["content-length"])
    if not inflate.eof or len(text) < begin + length:
        raise ValueError(f"record at byte {at} breaks off")
    return at + used - len(inflate.unused_data), fields, bytes(text[begin : begin + length])


def records_in_range(uri: str, start: int, stop: int, size: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """The records of an archive that start in ``start <= place < stop``: place, head and block."""
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as source:
        window = Window(source, start, size)
        while (at := window.find_magic(stop)) >= 0:
            found = decode_member(window, at)
            if found is None:
                window.drop(at + 1)
                continue
            end, fields, block = found
            yield at, fields, block
            window.drop(end)


RECORD_SCHEMA = pa.schema([
    ("path", pa.string()), ("place", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
    ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])
RECORD_DDL = (
    "path string, place bigint, record_id string, record_type string, url string, refers_to string, payload_digest string, "
    "payload_bytes bigint, payload binary"
)


def bare(field: str | None) -> str | None:
    return field.strip("<>") if field else None


def as_row(path: str, place: int, fields: dict[str, str], block: bytes) -> dict:
    """A record's row.  The payload is the HTTP body, null for revisits; its size is the HTTP length."""
    kind, http, payload = fields["warc-type"], block, None
    length = len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        declared = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        length = int(declared[0]) if declared else len(payload)
    elif kind != "revisit":
        payload = block
    digest = fields.get("warc-payload-digest")
    return {
        "path": path, "place": place, "record_id": bare(fields.get("warc-record-id")), "record_type": kind,
        "url": fields.get("warc-target-uri"), "refers_to": bare(fields.get("warc-refers-to")),
        "payload_digest": digest.rpartition(":")[2] if digest else None,
        "payload_bytes": length, "payload": None if kind == "revisit" else payload,
    }


def read_archives(spark: SparkSession, archives: DataFrame, range_bytes: int = 64 << 20, most_tasks: int = 20_000) -> DataFrame:
    """All records of the archives, which are named by ``path`` and ``size``.

    Columns: ``path, place, record_id, record_type, url, refers_to, payload_digest,
    payload_bytes, payload``.  Ranges are dealt to tasks; one archive may be read by many.
    Records are taken once each, whatever the range size.  No archives give no rows.
    """
    ship(spark)
    total = archives.agg(F.sum(F.ceil(F.col("size") / range_bytes))).head()[0]
    tasks = int(min(most_tasks, max(1, total or 1)))
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(range_bytes).cast("bigint")))
    ranges = archives.where("size > 0").select("path", "size", starts.alias("start")).repartition(tasks, "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows, held = [], 0
                for place, fields, block in records_in_range(r["path"], r["start"], r["start"] + range_bytes, r["size"]):
                    rows.append(as_row(r["path"], place, fields, block))
                    held += len(block)
                    if held >= 2 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, RECORD_SCHEMA)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORD_SCHEMA)

    return ranges.mapInArrow(read, RECORD_DDL)


def new_folder(base: str) -> str:
    return f"{base}/warc-{uuid.uuid4().hex}"
