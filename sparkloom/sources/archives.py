"""Members of archives as rows: listing with nesting, and reading of chosen members.

Archives are opened by path and read as streams, so their size doesn't matter; small ones may also arrive as binary rows.
Listing never keeps contents, and errors become rows.
"""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import struct
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.content import MAGIC, bare_dicom

#: Levels of archives in archives; members of one archive that are listed; bytes of a nested archive that is opened.
MAX_DEPTH, MAX_MEMBERS, MAX_NESTED = 3, 250_000, 256 << 20
ENTRIES = "archive string, display string, member string, size long, depth int, encrypted boolean, sniffed string, error string"
#: First bytes that tell what a member without an extension is.
SNIFFED = 512
_TAR = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz")
_SINGLE = {".gz": gzip.open, ".bz2": bz2.open, ".xz": lzma.open}


def kind_of(name: str, head: bytes = b"") -> str | None:
    low = name.lower()
    if low.endswith(".zip") or head[:4] == b"PK\x03\x04":
        return "zip"
    if low.endswith(_TAR) or head[257:262] == b"ustar":
        return "tar"
    if low.endswith(tuple(_SINGLE)) and not low.endswith(".nii.gz"):
        return "single"
    return None


def sniff(head: bytes) -> str | None:
    """Kind of a file by its first bytes, null if unknown."""
    for offset, magic, kind in MAGIC:
        if head[offset : offset + len(magic)] == magic and (kind != "webp" or head[:4] == b"RIFF"):
            return kind
    return "dicom" if bare_dicom(head) else None


@dataclass(frozen=True)
class Member:
    """A file in an archive; ``open`` gives a stream of its content."""

    name: str
    size: int
    encrypted: bool
    open: Callable[[], BinaryIO]


def members(name: str, stream: BinaryIO) -> Iterator[Member]:
    """The files of an archive, from a stream that can seek. Members of tars must be opened before the next is taken."""
    head = stream.read(SNIFFED)
    stream.seek(0)
    kind = kind_of(name, head)
    if kind == "zip":
        z = zipfile.ZipFile(stream)
        for i in z.infolist():
            if not i.is_dir():
                yield Member(i.filename, i.file_size, bool(i.flag_bits & 1), lambda i=i: z.open(i))
    elif kind == "tar":
        with tarfile.open(fileobj=stream, mode="r:*") as t:
            for m in t:
                if m.isfile():
                    yield Member(m.name, m.size, False, lambda m=m: t.extractfile(m))  # type: ignore[misc]
    elif kind == "single":
        suffix = next(s for s in _SINGLE if name.lower().endswith(s))

        def inside() -> BinaryIO:
            stream.seek(0)
            return _SINGLE[suffix](stream)

        size, out = 0, inside()
        while block := out.read(1 << 20):
            size += len(block)
        yield Member(name.rsplit("/", 1)[-1][: -len(suffix)], size, False, inside)


def walk(archive: str, name: str, stream: BinaryIO, depth: int = 0, prefix: str = "", max_depth: int = MAX_DEPTH, cap: int = MAX_MEMBERS) -> Iterator[tuple]:
    """Rows of ENTRIES; nested archives are opened in place, down to ``max_depth``. Members beyond the cap are counted in a row
    of their own, whose size is their number."""
    over = 0
    try:
        for n, m in enumerate(members(name, stream)):
            if n >= cap:
                over += 1
                continue
            display = f"{prefix}{m.name}"
            sniffed = None
            if not m.encrypted and "." not in m.name.rsplit("/", 1)[-1] and m.size:
                with m.open() as f:
                    sniffed = sniff(f.read(SNIFFED))
            yield archive, display, m.name, m.size, depth, m.encrypted, sniffed, None
            if not m.encrypted and depth + 1 < max_depth and m.size <= MAX_NESTED and kind_of(m.name):
                with m.open() as f:
                    yield from walk(archive, m.name, io.BytesIO(f.read()), depth + 1, f"{display}!/", max_depth, cap)
    except Exception as e:  # noqa: BLE001  a broken archive is a row, not a failed job
        yield archive, prefix, None, None, depth, False, None, f"{type(e).__name__}: {e}"[:300]
    if over:
        yield archive, prefix, None, over, depth, False, None, f"members beyond the first {cap} aren't listed"


def _stream(path: str, content: bytes | None) -> BinaryIO:
    """The archive's stream: its content, or the file at the path."""
    if content is not None:
        return io.BytesIO(content)
    fs, inside = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    return fs.open_input_file(inside)


def _columns(files: DataFrame) -> DataFrame:
    return files.select("path", "content" if "content" in files.columns else F.lit(None).cast("binary").alias("content"))


def list_archives(files: DataFrame, max_depth: int = MAX_DEPTH, cap: int = MAX_MEMBERS) -> DataFrame:
    """``files(path)`` -> a row for each member (ENTRIES). Archives are read where they are, by ranges; where there is a column
    ``content binary`` that isn't null, it is read instead. What can't be opened is an error row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ENTRIES.split(", ")]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with _stream(path or "", None if content is None else bytes(content)) as f:
                        rows = list(walk(path, path or "", f, max_depth=max_depth, cap=cap))
                except Exception as e:  # noqa: BLE001
                    rows = [(path, "", None, None, 0, False, None, f"{type(e).__name__}: {e}"[:300])]
                yield pd.DataFrame(rows, columns=names).astype({"size": "Int64"})

    return _columns(files).mapInPandas(run, ENTRIES)


def read_members(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Contents of the wanted (archive, display) members: archive, display, content, error; each wanted member once, also if it
    can't be read.

    Each archive is opened once, with the list of its wanted members beside it, and left once all are read. An error
    while a member is read is that member's; one while the archive is walked is that of all that are still missing.
    """
    lists = wanted.groupBy("archive").agg(F.collect_set("display").alias("displays"))
    joined = _columns(files).join(lists, F.col("path") == F.col("archive")).select("path", "content", "displays")

    def dig(name: str, stream: BinaryIO, prefix: str, left: set) -> Iterator[tuple[str, bytes | None, str | None]]:
        for m in members(name, stream):
            display = f"{prefix}{m.name}"
            inner = any(x.startswith(f"{display}!/") for x in left)
            if display in left or inner:
                try:
                    with m.open() as f:
                        got, error = f.read(), None
                except Exception as e:  # noqa: BLE001
                    got, error = None, f"{type(e).__name__}: {e}"[:300]
                if display in left:
                    left.discard(display)
                    yield display, got, error
                if inner and got is not None:
                    yield from dig(m.name, io.BytesIO(got), f"{display}!/", left)
            if not left:
                return

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content, displays in zip(pdf["path"], pdf["content"], pdf["displays"], strict=True):
                left, error = set(displays), "not in the archive"
                try:
                    with _stream(path, None if content is None else bytes(content)) as f:
                        for display, got, why in dig(path, f, "", left):
                            yield pd.DataFrame([(path, display, got, why)], columns=["archive", "display", "content", "error"])
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"[:300]
                yield pd.DataFrame([(path, d, None, error) for d in sorted(left)], columns=["archive", "display", "content", "error"])

    return joined.mapInPandas(run, "archive string, display string, content binary, error string")


@dataclass(frozen=True)
class Entry:
    """A member of a zip as its directory has it; ``offset``: where its own head is."""

    name: str
    size: int
    packed: int
    crc: int
    method: int
    offset: int


def central_directory(size: int, read: Callable[[int, int], bytes]) -> list[Entry]:
    """The members of a zip from ``read(offset, length)``, without reading them; folders and encrypted ones are left out."""
    tail = read(max(0, size - 65_557), min(size, 65_557))
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no central directory")
    count, length, offset = struct.unpack("<HII", tail[at + 10 : at + 20])
    locator = tail.rfind(b"PK\x06\x07", 0, at)
    if locator >= 0 and (offset == 0xFFFFFFFF or count == 0xFFFF):
        place = struct.unpack("<Q", tail[locator + 8 : locator + 16])[0]
        count, length, offset = struct.unpack("<QQQ", read(place, 56)[32:56])
    data, out, p = read(offset, length), [], 0
    wrapped = 0  # writers without 64-bit fields let offsets beyond 4 GB begin anew
    before = -1
    for _ in range(count):
        if data[p : p + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is broken")
        flags, method = struct.unpack("<HH", data[p + 8 : p + 12])
        crc, packed, full = struct.unpack("<III", data[p + 16 : p + 28])
        n, extra, comment = struct.unpack("<HHH", data[p + 28 : p + 34])
        place = struct.unpack("<I", data[p + 42 : p + 46])[0]
        exact = place == 0xFFFFFFFF
        name = data[p + 46 : p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        x, end = p + 46 + n, p + 46 + n + extra
        while x + 4 <= end:  # 64-bit sizes
            tag, size_ = struct.unpack("<HH", data[x : x + 4])
            if tag == 1:
                values = list(struct.unpack(f"<{size_ // 8}Q", data[x + 4 : x + 4 + size_ // 8 * 8]))
                full = values.pop(0) if full == 0xFFFFFFFF and values else full
                packed = values.pop(0) if packed == 0xFFFFFFFF and values else packed
                place = values.pop(0) if exact and values else place
            x += 4 + size_
        p = end + comment
        if not exact:
            wrapped += (place + wrapped < before and size > 1 << 32) << 32
            place += wrapped
        before = place
        if not name.endswith("/") and not flags & 1:
            out.append(Entry(name, full, packed, crc, method, place))
    return out


class ZipListingSource(DataSource):
    """Members of zips from range reads of their central directories, one task a zip. Option ``paths``: URIs separated
    by ``;`` that pyarrow can open, such as file: or s3:."""

    @classmethod
    def name(cls) -> str:
        return "zip_listing"

    def schema(self) -> str:
        return "path string, name string, size long, compressed_size long, crc long, method int, header_offset long, error string"

    def reader(self, schema) -> DataSourceReader:
        return _ZipReader(self.options["paths"].split(";"))


class _ZipReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        try:
            fs, inside = pafs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
            with fs.open_input_file(inside) as f:
                def read(offset: int, length: int) -> bytes:
                    f.seek(offset)
                    return f.read(length)

                for e in central_directory(f.size(), read):
                    yield path, e.name, e.size, e.packed, e.crc, e.method, e.offset, None
        except Exception as e:  # noqa: BLE001
            yield path, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:300]
