"""WARC archives as a Spark data source: one record per page, read back as a table of chunks.

Writing: every task streams its rows into archives of its own (``*.warc.gz``, one gzip
member per record), payload slice by payload slice. A driver-side commit names the archives
of the tasks that succeeded in a manifest, so that what a lost or repeated attempt left
behind is never read.

Reading: an archive is inflated piece by piece and comes out as rows of (record, chunk
number, at most ``chunk_bytes`` of payload) that carry the payload's length and SHA-256 up
to their end. The last chunk of a record thus holds the digest of the whole payload, and no
task ever holds more of a record than one chunk, however large the record is.

The folder has to be one that ``pyarrow.fs`` opens on every executor: a shared file system,
HDFS or an object store.

Odd rows: a null payload counts as empty. Of pages with equal payloads of ``least`` bytes
or more, those of the smallest page_id are responses (all of them, if that id is repeated)
and the others revisits; pages without an id revisit the smallest id there is, and are all
responses where there is none. A null url leaves the field out; control characters and
spaces in one are percent-encoded. A record that the archive's end cuts off, or whose bytes
do not give the stated digest, comes with ``intact`` false. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from affinia.llm.tables import written
from affinia.operators.sizes import broadcast_if_small
from affinia.session import scratch_path

FORMAT, MANIFEST = "affinia_warc", "_archives-"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
END = b"\r\n\r\n"

#: Bytes read at once, bytes of a record's or message's head at most, and of a batch of rows.
PIECE, HEAD, BATCH = 32 << 10, 1 << 20, 4 << 20
#: Payload bytes of a row, and compressed bytes after which the next archive begins.
CHUNK_BYTES, ARCHIVE_BYTES = 1 << 20, 1 << 30
#: Payloads shorter than this are never replaced by a reference.
LEAST = 100

RECORDS = """record_id string, record_type string, target_uri string, refers_to string, payload_digest string,
    payload_bytes bigint, payload binary"""
CHUNKS = """archive string, record_no bigint, record_id string, record_type string, target_uri string, refers_to string,
    stated_digest string, chunk_no int, chunk_start bigint, chunk binary, bytes_so_far bigint, digest_so_far string,
    last boolean, payload_bytes bigint, intact boolean"""
_CHUNKS = pa.schema([
    ("archive", pa.string()), ("record_no", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
    ("target_uri", pa.string()), ("refers_to", pa.string()), ("stated_digest", pa.string()), ("chunk_no", pa.int32()),
    ("chunk_start", pa.int64()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
    ("last", pa.bool_()), ("payload_bytes", pa.int64()), ("intact", pa.bool_()),
])


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and folder of a path with or without a scheme."""
    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][\w+.-]*:", path) else (fs.LocalFileSystem(), path)


def manifests(store: fs.FileSystem, folder: str) -> list[str]:
    """One file per committed write, which lists its archives."""
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.startswith(MANIFEST) and f.base_name.endswith(".json"))


# --- writing -------------------------------------------------------------------------------


def record_head(row: dict, date: str) -> tuple[bytes, bytes]:
    """A record's own fields, and the head of the HTTP message that its block begins with."""
    message = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    in_block = len(message) + (row["payload_bytes"] if row["record_type"] == "response" else 0)
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", date)]
    if row["target_uri"] is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["target_uri"])))
    fields.append(("WARC-Payload-Digest", "sha256:" + row["payload_digest"]))
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<{row['refers_to']}>")]
    fields += [("Content-Type", HTTP), ("Content-Length", str(in_block))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n", message.encode()


def write_record(out, row: dict, payload: memoryview, date: str, level: int) -> int:
    """One gzip member; the payload goes through in slices. Returns the compressed bytes."""
    member, size = zlib.compressobj(level, zlib.DEFLATED, 31), 0
    for head in record_head(row, date):
        size += out.write(member.compress(head))
    for at in range(0, len(payload), CHUNK_BYTES):
        size += out.write(member.compress(payload[at:at + CHUNK_BYTES]))
    return size + out.write(member.compress(END) + member.flush())


@dataclass
class Archived(WriterCommitMessage):
    archives: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.date, self.overwrite = options["path"], options.get("date", "1970-01-01T00:00:00Z"), overwrite
        self.level, self.archive_bytes = int(options.get("level", 3)), int(options.get("archivebytes", ARCHIVE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Archived:
        store, folder = open_store(self.path)
        out, size, names = None, 0, []
        try:
            for batch in iterator:
                payloads = batch.column("payload")
                rest = batch.drop_columns(["payload"]).to_pylist()
                for at, row in enumerate(rest):
                    if out is None:
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        store.create_dir(folder, recursive=True)
                        out, size = store.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                    held = payloads[at].as_buffer() if row["record_type"] == "response" else None
                    size += write_record(out, row, memoryview(held if held is not None else b""), self.date, self.level)
                    if size >= self.archive_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Archived(names)

    def commit(self, messages) -> None:
        store, folder = open_store(self.path)
        store.create_dir(folder, recursive=True)
        names = sorted(n for m in messages if m is not None for n in m.archives)
        before = manifests(store, folder) if self.overwrite else []
        part = f"{folder}/{uuid.uuid4().hex}.part"
        with store.open_output_stream(part, compression=None) as out:
            out.write(json.dumps(names).encode())
        store.move(part, f"{folder}/{MANIFEST}{uuid.uuid4().hex}.json")
        for old in before:
            store.delete_file(old)

    def abort(self, messages) -> None:
        store, folder = open_store(self.path)
        for name in (n for m in messages if m is not None for n in m.archives):
            store.delete_file(f"{folder}/{name}")


# --- reading -------------------------------------------------------------------------------


def inflated(raw, size: int = PIECE) -> Iterator[bytes]:
    """The bytes of an archive in pieces, whether it is plain or a row of gzip members."""
    data = raw.read(size)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = raw.read(size)
        return
    member = zlib.decompressobj(31)
    while data:
        out = member.decompress(data, 4 * size)
        if out:
            yield out
        while not member.eof and (member.unconsumed_tail or len(out) == 4 * size):  # more lies inside the inflater
            if out := member.decompress(member.unconsumed_tail, 4 * size):
                yield out
        if member.eof:
            data, member = member.unused_data or raw.read(size), zlib.decompressobj(31)
        else:
            data = raw.read(size)


class Source:
    """Bytes that are read once, forwards."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at = pieces, b"", 0

    def take(self, most: int) -> bytes:
        """Some of the next bytes; none at the end."""
        if self.at == len(self.held):
            self.held, self.at = next(self.pieces, b""), 0
        out = self.held[self.at:self.at + most]
        self.at += len(out)
        return out

    def head(self, most: int = HEAD) -> bytes | None:
        """Up to and with the next empty line; None if there is none within ``most`` bytes."""
        while (end := self.held.find(END, self.at, self.at + most)) < 0:
            piece = next(self.pieces, b"") if len(self.held) - self.at < most else b""
            if not piece:
                return None
            self.held, self.at = self.held[self.at:] + piece, 0
        out = self.held[self.at:end + len(END)]
        self.at = end + len(END)
        return out

    def at_record(self) -> bool:
        """Skips line ends between records; False at the end."""
        while byte := self.take(1):
            if byte not in b"\r\n":
                self.at -= 1
                return True
        return False


def fields_of(head: bytes) -> dict[str, str]:
    out, name = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in " \t" and line and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _within(text: str | None) -> str | None:
    return text[1:-1] if text and text[0] == "<" and text[-1] == ">" else text


def records(source: Source, chunk_bytes: int) -> Iterator[dict]:
    """The rows of every record in turn; only one chunk is held at a time."""
    record_no = 0
    while source.at_record():
        head = source.head()
        if head is None or not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where record {record_no} should begin")
        fields = fields_of(head)
        left, size, digest = int(fields["content-length"]), 0, hashlib.sha256()
        kind, message = fields.get("warc-type", ""), {}
        if fields.get("content-type", "").startswith("application/http") and left:
            first = source.head(min(left, HEAD))
            if first is not None:
                left, message = left - len(first), fields_of(first)
        stated = fields.get("warc-payload-digest", "")
        stated = stated[7:].lower() if stated.lower().startswith("sha256:") else None
        base = {
            "record_no": record_no, "record_id": _within(fields.get("warc-record-id")), "record_type": kind,
            "target_uri": fields.get("warc-target-uri"), "refers_to": _within(fields.get("warc-refers-to")), "stated_digest": stated,
        }
        chunk_no, cut = 0, False
        while True:
            parts, start, room = [], size, min(chunk_bytes, left)
            while room and (part := source.take(room)):
                parts.append(part)
                digest.update(part)
                room, left, size = room - len(part), left - len(part), size + len(part)
            cut = room > 0
            row = base | {
                "chunk_no": chunk_no, "chunk_start": start, "chunk": b"".join(parts), "bytes_so_far": size,
                "digest_so_far": digest.hexdigest(), "last": cut or not left}
            if row["last"]:
                if kind == "revisit":  # the payload is the referred record's; its length stands in the message's head
                    length = message.get("content-length", "")
                    row |= {"payload_bytes": int(length) if length.isdigit() else None, "intact": not cut}
                else:
                    row |= {"payload_bytes": size, "intact": not cut and stated in (None, row["digest_so_far"])}
            yield row
            if row["last"]:
                break
            chunk_no += 1
        record_no += 1


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.chunk_bytes = options["path"], int(options.get("chunkbytes", CHUNK_BYTES))
        self.payloads = options.get("payloads", "true") == "true"

    def partitions(self) -> list[InputPartition]:
        """One archive each, which a writer keeps to about ``archive_bytes``."""
        store, folder = open_store(self.path)
        if listed := manifests(store, folder):
            names = []
            for path in listed:
                with store.open_input_stream(path, compression=None) as manifest:
                    names += [f"{folder}/{n}" for n in json.loads(manifest.read())]
        else:  # archives from elsewhere
            found = store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
            names = sorted(f.path for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz")))
        return [InputPartition(n) for n in names]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes where there are no archives
            return
        store, _ = open_store(self.path)
        rows, size = [], 0
        with store.open_input_stream(partition.value, compression=None) as raw:
            for row in records(Source(inflated(raw)), self.chunk_bytes):
                if not self.payloads:
                    row["chunk"] = None
                row["archive"] = partition.value.rsplit("/", 1)[-1]
                rows.append(row)
                size += 512 + len(row["chunk"] or b"")
                if size >= BATCH:
                    yield pa.RecordBatch.from_pylist(rows, _CHUNKS)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, _CHUNKS)


class Warc(DataSource):
    """``spark.read.format("affinia_warc")`` after ``register``; options path, chunkBytes, payloads, archiveBytes, level, date."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return CHUNKS

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def read_chunks(spark: SparkSession, path: str, payloads: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of a folder of archives; without ``payloads`` only lengths and digests come along."""
    spark.dataSource.register(Warc)
    return spark.read.format(FORMAT).option("payloads", str(payloads).lower()).option("chunkBytes", chunk_bytes).load(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: its last chunk, which carries the length and digest of all of them."""
    last = read_chunks(spark, path, payloads=False).where("last")
    return last.select(
        "archive", "record_no", "record_id", "record_type", "target_uri", "refers_to", "payload_bytes",
        F.when(F.col("record_type") == "revisit", F.col("stated_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "intact")


# --- pages ---------------------------------------------------------------------------------


def _urn(page_id, digest):
    """A record's name, from the page's id and the payload."""
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), F.substring(digest, 1, 16))


def page_records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows to write: payloads once, later copies as references to the smallest page_id.

    Copies are counted by digest on the map side first; only digests that occur twice are
    joined back, by a broadcast if their measured bytes allow it. Payloads are then not
    shuffled.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("target_uri"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).select(
        "page_id", "target_uri", "payload", F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    copied = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    copied = written(copied.select("payload_digest", "first"), "payloads-copied")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(broadcast_if_small(copied), "payload_digest", "left").select(
        _urn(F.col("page_id"), F.col("payload_digest")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(again, _urn(F.col("first"), F.col("payload_digest"))).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"))


def write_records(rows: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Rows of ``RECORDS`` as archives in a new folder."""
    rows.sparkSession.dataSource.register(Warc)
    rows.write.format(FORMAT).option("archiveBytes", archive_bytes).mode("append").save(path)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Archives all pages and reads the archives back: one row per record."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_records(page_records(pages), path)
    found = read_records(pages.sparkSession, path)

    def page(name: str):
        return F.regexp_extract(name, "^urn:page:(-?[0-9]+):", 1).try_cast("bigint")

    return found.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
