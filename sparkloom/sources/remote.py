"""Archives behind HTTP or any store, read by ranges: listings, single members, and what the first bytes tell.

Everything works on ``read(offset, length)`` and a size, so local files, stores and servers are alike. A meter stops a read
that would exceed its budget.
"""

from __future__ import annotations

import bz2
import io
import json
import lzma
import struct
import tarfile
import urllib.request
import zlib
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from .archives import Entry, central_directory

Read = Callable[[int, int], bytes]
#: Bytes and requests that the probe of one archive may take, and bytes of one read.
PROBE_BYTES, PROBE_REQUESTS, BLOCK = 64 << 20, 400, 1 << 20
PROBED = "path string, name string, size long, method string, complete boolean, error string"


class BudgetSpent(Exception):
    """More was asked for than the budget allows."""


class Meter:
    """A reader that counts bytes and requests and raises before it exceeds them."""

    def __init__(self, read: Read, most_bytes: int = PROBE_BYTES, most_requests: int = PROBE_REQUESTS) -> None:
        self._read, self.most_bytes, self.most_requests = read, most_bytes, most_requests
        self.bytes = self.requests = 0

    def __call__(self, offset: int, length: int) -> bytes:
        if self.bytes + length > self.most_bytes or self.requests + 1 > self.most_requests:
            raise BudgetSpent(f"{self.bytes + length} bytes in {self.requests + 1} requests")
        self.bytes, self.requests = self.bytes + length, self.requests + 1
        return self._read(offset, length)


class HttpRanges:
    """A URL whose bytes are asked for by range. A server that sends the whole file instead raises."""

    def __init__(self, url: str, timeout: float = 30.0, headers: dict[str, str] | None = None) -> None:
        self.url, self.timeout, self.headers = url, timeout, headers or {}
        with self._get(0, 1) as r:
            self.size = int(r.headers["Content-Range"].rpartition("/")[2])

    def _get(self, offset: int, length: int):
        r = urllib.request.urlopen(urllib.request.Request(self.url, headers=self.headers | {"Range": f"bytes={offset}-{offset + length - 1}"}), timeout=self.timeout)  # noqa: S310
        if r.status != 206 or "Content-Range" not in r.headers:
            r.close()
            raise OSError("the server doesn't give ranges")
        return r

    def __call__(self, offset: int, length: int) -> bytes:
        length = min(length, self.size - offset)
        if length <= 0:
            return b""
        with self._get(offset, length) as r:
            return r.read()


def ranges(path: str) -> tuple[Read, int]:
    """A reader of ranges, and the size, of an http(s) URL or of what Arrow can open."""
    if path.startswith(("http://", "https://")):
        http = HttpRanges(path)
        return http, http.size
    fs, inside = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")
    f = fs.open_input_file(inside)
    return lambda offset, length: f.read_at(max(0, min(length, f.size() - offset)), offset), f.size()


class RangeFile(io.RawIOBase):
    """A seekable file over ranges, for libraries that want one."""

    def __init__(self, read: Read, size: int) -> None:
        self._read, self.size, self.at = read, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = (0, self.at, self.size)[whence] + offset
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, buffer) -> int:
        got = self._read(self.at, min(len(buffer), max(0, self.size - self.at)))
        buffer[: len(got)] = got
        self.at += len(got)
        return len(got)


def inflated(read: Read, entry: Entry, block: int = BLOCK) -> Iterator[bytes]:
    """The content of a zip's member in pieces; a wrong size or checksum raises at the end."""
    head = read(entry.offset, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no member at this place")
    name, extra = struct.unpack("<HH", head[26:30])
    at, end = entry.offset + 30 + name + extra, entry.offset + 30 + name + extra + entry.packed
    if entry.method not in (0, 8):
        raise NotImplementedError(f"compression method {entry.method}")
    unpack = zlib.decompressobj(-15) if entry.method == 8 else None
    size = crc = 0
    while at < end:
        raw = read(at, min(block, end - at))
        if not raw:
            raise ValueError("the archive ends within the member")
        at += len(raw)
        out = unpack.decompress(raw) if unpack else raw
        size, crc = size + len(out), zlib.crc32(out, crc)
        if size > entry.size:
            raise ValueError("the member is longer than its entry says")
        yield out
    tail = unpack.flush() if unpack else b""
    if tail:
        yield tail
    if size + len(tail) != entry.size or zlib.crc32(tail, crc) != entry.crc:
        raise ValueError("the member isn't what its entry says")


def fetch_member(read: Read, entry: Entry, most: int) -> bytes:
    """A whole member of at most ``most`` bytes."""
    if entry.size > most:
        raise BudgetSpent(f"{entry.size} bytes")
    return b"".join(inflated(read, entry))


def truncated(listed: int, reported: int | None, cap: int) -> bool:
    """Whether a listing lacks members: fewer than reported, or exactly as many as a listing may have."""
    return (reported is not None and listed < reported) or (reported is None and listed >= cap)


def listing_to_json(entries: list[Entry]) -> str:
    return json.dumps([list(asdict(e).values()) for e in entries])


def listing_from_json(text: str) -> list[Entry]:
    return [Entry(*values) for values in json.loads(text)]


@dataclass(frozen=True)
class Found:
    """A listed member, and whether the listing is whole."""

    name: str
    size: int


def tar_members(read: Read, size: int) -> Iterator[Found]:
    """Members of a plain tar by hopping from header to header; contents are never read."""
    at, long_name, zero = 0, None, 0
    while at + 512 <= size:
        head = read(at, 512)
        if head == bytes(512):
            zero += 1
            if zero == 2:
                return
            at += 512
            continue
        info = tarfile.TarInfo.frombuf(head, "utf-8", "surrogateescape")
        at += 512
        if info.type == tarfile.GNUTYPE_LONGNAME:
            long_name = read(at, info.size).rstrip(b"\0").decode("utf-8", "surrogateescape")
        elif info.type in (tarfile.XHDTYPE, tarfile.SOLARIS_XHDTYPE):
            fields = dict(x.split(b" ", 1)[1].split(b"=", 1) for x in read(at, info.size).split(b"\n") if b"=" in x)
            long_name = fields[b"path"].decode() if b"path" in fields else long_name
        elif info.isreg():
            yield Found(long_name or info.name, info.size)
            long_name = None
        elif info.type != tarfile.XGLTYPE:
            long_name = None
        at += -(-info.size // 512) * 512 if info.type not in (tarfile.DIRTYPE, tarfile.LNKTYPE, tarfile.SYMTYPE) else 0


def unpacked_head(name: str, head: bytes, most: int = 8 << 20) -> bytes:
    """What the first bytes of a compressed file unpack to, as far as they reach."""
    low = name.lower()
    kinds = {(".gz", ".tgz"): lambda: zlib.decompressobj(31), (".bz2", ".tbz2"): bz2.BZ2Decompressor, (".xz", ".txz"): lzma.LZMADecompressor}
    make = next((m for ends, m in kinds.items() if low.endswith(ends)), None)
    if make is None:
        raise NotImplementedError(f"no decompressor for {name}")
    return make().decompress(head, most)


def head_members(name: str, head: bytes) -> Iterator[Found]:
    """Members of a compressed tar whose headers are in its first bytes."""
    data = unpacked_head(name, head)
    try:
        yield from tar_members(lambda offset, length: data[offset : offset + length], len(data))
    except (tarfile.HeaderError, ValueError):
        return  # cut within a header


def probe(name: str, read: Read, size: int) -> Iterator[tuple[str, int, str, bool]]:
    """(member, size, method, whether all are listed) by the cheapest way for the format: a zip's directory, hops over a tar, the
    unpacked head of a compressed tar or file."""
    low = name.lower()
    if low.endswith(".zip"):
        for e in central_directory(size, read):
            yield e.name, e.size, "directory", True
    elif low.endswith(".tar"):
        for f in tar_members(read, size):
            yield f.name, f.size, "hops", True
    elif low.endswith((".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz")):
        whole = size <= BLOCK
        for f in head_members(name, read(0, min(size, BLOCK))):
            yield f.name, f.size, "head", whole
    elif low.endswith((".gz", ".bz2", ".xz")):
        got = unpacked_head(name, read(0, min(size, BLOCK)))
        yield name.rsplit("/", 1)[-1].rpartition(".")[0], len(got), "head", size <= BLOCK
    else:
        raise NotImplementedError(f"no probe for {name}")


def probe_archives(files: DataFrame, most_bytes: int = PROBE_BYTES, most_requests: int = PROBE_REQUESTS) -> DataFrame:
    """``files(path)`` -> PROBED: the members of each archive as far as the budget reaches, ``complete`` false where there may be more,
    and an error row for what can't be probed. One task probes one archive after the other; nothing is downloaded whole."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path in f["path"]:
                rows, error, whole = [], None, True
                try:
                    raw, size = ranges(path)
                    for name, n, method, complete in probe(path, Meter(raw, most_bytes, most_requests), size):
                        rows.append([path, name, n, method, complete, None])
                        whole = whole and complete
                except BudgetSpent as e:
                    error, whole = f"budget: {e}", False
                except Exception as e:  # noqa: BLE001  an archive that can't be probed is a row
                    error, whole = f"{type(e).__name__}: {e}"[:300], False
                if error:
                    rows.append([path, None, None, None, False, error])
                for r in rows:
                    r[4] = whole
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in PROBED.split(", ")]).astype({"size": "Int64"})

    return files.select("path").mapInPandas(run, PROBED)
