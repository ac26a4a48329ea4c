"""WARC archives compressed record by record with a shared Zstandard dictionary.

Each archive trains a dictionary on its own first records, keeps it in a leading skippable frame, and has one frame for
each record, so a record can be read with the dictionary alone. Payloads that an earlier page has are revisit records.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, partitions, written

#: Type of the skippable frame that holds the dictionary, and the mark of a Zstandard dictionary.
SKIPPABLE, DICTIONARY = 0x184D2A5D, b"\x37\xa4\x30\xec"
FRAME = 0xFD2FB528
#: Uncompressed bytes after which a new archive begins; of the records that the dictionary is trained on; and its size.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 256 << 20, 4 << 20, 64 << 10
#: Payloads below this are never revisits. A digest of more than one in HOT rows is hot.
MIN_REVISIT, HOT = 100, 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header(value: str | None) -> str:
    """A value on one line: control characters and line ends as %XX."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def record_uri(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response record with the payload, or a revisit record with the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_uri(page_id)}>", f"WARC-Date: {date}", f"WARC-Target-URI: {_header(url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_uri(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Fields of a record that ``make_record`` made, in lower case, and ``block``."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return fields | {"block": rest[:size]}


def train(samples: list[bytes]) -> bytes:
    """A dictionary for the samples, or nothing if they are too few to train on."""
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


class Writer:
    """Writes records into one archive; the first SAMPLE_BYTES of them wait until the dictionary is trained."""

    def __init__(self, stream, level: int = 3) -> None:
        self.stream, self.level = stream, level
        self.waiting: list[bytes] | None = []
        self.bytes = self.records = 0

    def add(self, record: bytes) -> None:
        self.bytes += len(record)
        self.records += 1
        if self.waiting is None:
            self.stream.write(self.compress(record))
            return
        self.waiting.append(record)
        if self.bytes >= SAMPLE_BYTES:
            self.begin()

    def begin(self) -> None:
        data = train(self.waiting or [])
        if data:
            self.stream.write(struct.pack("<II", SKIPPABLE, len(data)) + data)
            self.compress = zstandard.ZstdCompressor(self.level, dict_data=zstandard.ZstdCompressionDict(data)).compress
        else:
            self.compress = zstandard.ZstdCompressor(self.level).compress
        for r in self.waiting or []:
            self.stream.write(self.compress(r))
        self.waiting = None

    def close(self) -> None:
        if self.waiting is not None:
            self.begin()
        self.stream.close()


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, one at a time; the dictionary is taken from its skippable frame."""
    data = stream.read(8)
    dictionary, rest = None, data
    if len(data) == 8 and struct.unpack("<II", data)[0] == SKIPPABLE:
        size = struct.unpack("<II", data)[1]
        raw = stream.read(size)
        if raw[:4] == struct.pack("<I", FRAME):  # the dictionary may be compressed itself
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary, rest = zstandard.ZstdCompressionDict(raw), b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    at = 0  # what comes before ``at`` in ``rest`` is read; it goes with the next block, so no byte is copied twice
    while True:
        one, out = reader.decompressobj(), []
        step = 1 << 14
        while not one.eof:
            if at == len(rest):
                rest, at = stream.read(1 << 20), 0
                if not rest:
                    if out:
                        raise ValueError("the archive ends within a record")
                    return
            some = rest[at : at + step]
            out.append(one.decompress(some))
            at += len(some)
            step = 1 << 20
        at -= len(one.unused_data)
        yield b"".join(out)


#: Names that Hadoop has for stores that Arrow knows by another one.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "viewfs": "hdfs"}


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    scheme, sep, rest = path.partition("://")
    if not sep:
        return pafs.FileSystem.from_uri("file://" + path.removeprefix("file:"))
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


def plan_records(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` with payload, digest, revisit and refers_to.

    Of payloads of at least MIN_REVISIT bytes that several rows have, the row with the smallest page_id is the response;
    rows that repeat that page_id and payload are responses too; rows with a null page_id revisit if there is a
    response. Counts are aggregated before the shuffle. Digests that more than one in HOT rows have are fewer than HOT and
    are broadcast, so a payload that a third of all pages have doesn't move; small payloads are dealt out by page.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= MIN_REVISIT
    light = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    light = written(light.where("n > 1 and first is not null").select("digest", "first", "n"), "warc-repeats")
    hot_from = rows.count() // HOT
    hot, rest = F.broadcast(light.where(F.col("n") > hot_from).select("digest", "first")), light.where(F.col("n") <= hot_from).select(F.col("digest").alias("key"), "first")
    other = rows.join(hot.select("digest"), "digest", "left_anti").withColumn("key", F.when(large, F.col("digest")).otherwise(F.concat(F.lit("page:"), F.coalesce(F.col("page_id").cast("string"), F.col("url"), F.lit("")))))
    names = ["page_id", "url", "payload", "digest", "first"]
    rows = rows.join(hot, "digest").select(*names).union(other.join(rest, "key", "left").select(*names))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "payload", "digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as archives in ``folder``, a URI that all executors reach; -> path, records, bytes of each archive.

    An archive has the task's attempt in its name and is never written again. The manifest is a table that Spark commits,
    so it has the archives of one attempt of each task, and those of lost, late or speculative ones are deleted.
    Records stream; a task holds one batch and the dictionary's sample. Null html is an empty payload. No rows, no
    archives. Folders are those that Arrow can write (local and shared paths, hdfs, s3, gs, abfs, by Hadoop's names too).
    """
    planned = plan_records(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = _open(folder)
        attempt = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        writer, made = None, []

        def finish():
            nonlocal writer
            if writer:
                writer.close()
                made.append((f"{folder}/{name}", writer.records, writer.bytes))
                writer = None

        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for i in range(len(batch)):
                page, url, payload, digest, revisit, first = (c[i].as_py() for c in columns)
                if writer is None:
                    name = f"{attempt}-{len(made):05d}.warc.zst"
                    writer = Writer(fs.open_output_stream(f"{root}/{name}", compression=None))
                writer.add(make_record(page, url, payload, digest, first, revisit, date))
                if writer.bytes >= archive_bytes:
                    finish()
        finish()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())], names=["path", "records", "bytes"])

    spark = pages.sparkSession
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path)
    manifest = written(planned.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")
    named = {r["path"].rpartition("/")[2] for r in manifest.select("path").toLocalIterator()}  # one name for each archive
    for f in fs.listStatus(jvm_path):
        if f.getPath().getName() not in named:
            fs.delete(f.getPath(), False)
    return manifest


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the archives in ``manifest(path)``: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for revisits). Digests of responses are computed from the payload and compared with the
    record's; a difference raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inside = _open(path)
                rows: list[tuple] = []
                with fs.open_input_stream(inside, compression=None) as stream:
                    for record in read_archive(stream):
                        r = parse_record(record)
                        head, _, payload = r["block"].partition(b"\r\n\r\n")
                        size = int(re.search(rb"(?i)content-length: (\d+)", head)[1])  # type: ignore[index]
                        digest = r["warc-payload-digest"].removeprefix("sha256:")
                        kind = r["warc-type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"a payload in {path} isn't what its record says")
                        rows.append((_page(r["warc-record-id"]), r["warc-target-uri"], size, digest, kind, _page(r.get("warc-refers-to")), payload if kind == "response" else None))
                        if len(rows) >= 500:
                            yield _rows(rows)
                            rows = []
                yield _rows(rows)

    return manifest.select("path").repartition(partitions(manifest.sparkSession) * 4, "path").mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Archive the pages in the shared folder and read the archives back."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    return read_archives(write_archives(pages, folder))


