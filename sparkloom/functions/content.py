"""What the first bytes of a file say. Prefix rules are Column expressions; rules that parse are Arrow functions."""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Offset (from 0), bytes and content kind, in the order they are tried.
MAGIC: tuple[tuple[int, bytes, str], ...] = (
    (0, b"\xff\xd8\xff", "jpeg"), (0, b"\xff\x0a", "jpegxl"), (0, b"\x00\x00\x00\x0cJXL \r\n\x87\n", "jpegxl"),
    (0, b"\x00\x00\x00\x0cjP  \r\n\x87\n", "jpeg2000"), (0, b"\xff\x4f\xff\x51", "jpeg2000"), (0, b"II\xbc", "jpegxr"),
    (0, b"\x89PNG\r\n\x1a\n", "png"), (0, b"GIF87a", "gif"), (0, b"GIF89a", "gif"), (0, b"BM", "bmp"), (0, b"II*\x00", "tiff"),
    (0, b"MM\x00*", "tiff"), (0, b"II+\x00", "tiff"), (0, b"MM\x00+", "tiff"), (8, b"WEBP", "webp"), (128, b"DICM", "dicom"),
    (0, b"\x89HDF\r\n\x1a\n", "hdf5"), (512, b"\x89HDF\r\n\x1a\n", "hdf5"), (0, b"\x93NUMPY", "npy"), (0, b"MATLAB 5.0", "mat5"),
    (0, b"MATLAB 7.3", "mat5"), (0, b"Octave-1-", "octave"), (208, b"MAP ", "mrc"), (208, b"MAP\x00", "mrc"), (0, b"%PDF", "PDF"),
    (0, b"PK\x03\x04", "zip archive"), (0, b"\x1f\x8b", "gzip stream"),
)
# Value representations of DICOM whose length has 4 bytes behind 2 reserved ones, and the others.
DICOM_LONG = frozenset("OB OD OF OL OV OW SQ UC UN UR UT".split())
DICOM_SHORT = frozenset("AE AS AT CS DA DS DT FL FD IS LO LT PN SH SL SS ST SV TM UI UL US UV".split())
# Limits of a plausible first element without a preamble: groups, largest element number, longest value.
BARE_GROUPS, BARE_ELEMENT, BARE_LENGTH = (0x0002, 0x0008), 0x2000, 1024
# Markers of JPEG that have no segment; those that begin a frame, by process.
JPEG_ALONE = frozenset((0x01, 0xD8, 0xD9, *range(0xD0, 0xD8)))
JPEG_PROCESS = {0xC0: "baseline", 0xC1: "extended", 0xC2: "progressive", 0xC3: "lossless", 0xC5: "differential", 0xC6: "differential", 0xC7: "lossless", 0xC9: "arithmetic", 0xCA: "arithmetic", 0xCB: "arithmetic lossless", 0xCD: "arithmetic", 0xCE: "arithmetic", 0xCF: "arithmetic lossless"}
# How texts of known formats begin, in lower case; what tells links of git-annex and error pages.
TEXT_BEGINS = {"nrrd": ("nrrd000",), "metaimage": ("objecttype", "ndims"), "octave text": ("# created by octave",), "git-lfs pointer": ("version https://git-lfs",)}
SVG_BEGINS = ("<?xml", "<svg", "<!doctype svg", "<!--")
ANNEX = re.compile(r"(?:\.\./)*\.git/annex/|.{0,300}?/\.git/annex/objects/", re.S)
CONTROLS = re.compile(r"[\x00-\x07\x0b\x0e-\x1a\x1c-\x1f]")


def magic_kind(head: Column) -> Column:
    """Content kind by magic bytes, null if none fits; ``empty`` for no bytes."""
    at = lambda off, b: F.substring(head, off + 1, len(b)) == F.unhex(F.lit(b.hex()))
    out = F.when(F.octet_length(head) == 0, F.lit("empty"))
    for off, b, kind in MAGIC:
        cond = at(off, b)
        if kind == "webp":
            cond = cond & at(0, b"RIFF")
        if kind == "bmp":
            cond = cond & (F.octet_length(head) >= 26)
        out = out.when(cond, F.lit(kind))
    return out


def head_text(head: bytes) -> str | None:
    """The bytes as UTF-8 text, null if they aren't: a character may be cut at the end, and one in a hundred characters may be
    a control character."""
    text = codecs.getincrementaldecoder("utf-8")("replace").decode(head)
    return None if "\ufffd" in text or 100 * len(CONTROLS.findall(text)) > len(text) else text


#: Kinds of marked-up and other texts with what tells them, the first that holds.
_MARKUP = (
    ("git-annex link", lambda t: ANNEX.match(t) is not None),
    ("svg", lambda t: "<svg" in t and t.startswith(SVG_BEGINS)),
    ("html page", lambda t: t.startswith("<!doctype html") or "<html" in t[:512]),
    ("XML error page", lambda t: t.startswith("<") and "<error>" in t[:1024]),
    ("XML document", lambda t: t.startswith("<")),
    ("JSON", lambda t: t.startswith(("{", "["))),
)


def text_kind(head: bytes) -> str | None:
    """Kind of a text by its first 2 KB, null for what isn't text."""
    text = head_text(head[:2048])
    if not text:
        return None
    low = text.lstrip("\ufeff \t\r\n").lower()
    known = (kind for kind, begins in TEXT_BEGINS.items() if low.startswith(begins))
    return next(known, None) or next((kind for kind, tells in _MARKUP if tells(low)), "text")


@dataclass(frozen=True)
class Element:
    """A data element: its tag and the place of its value."""

    tag: tuple[int, int]
    start: int
    length: int


def dicom_elements(data: bytes, start: int = 0) -> Iterator[Element]:
    """The data elements of a little-endian stream, explicit or implicit, as far as their heads are there."""
    view = memoryview(data)
    while start + 8 <= len(view):
        group, number = struct.unpack_from("<HH", view, start)
        vr = bytes(view[start + 4 : start + 6]).decode("latin-1")
        head, form = (12, "<I") if vr in DICOM_LONG else (8, "<H") if vr in DICOM_SHORT else (8, "<I")
        at = start + (6 if form == "<H" else head - 4)
        if start + head > len(view):
            return
        length = struct.unpack_from(form, view, at)[0]
        yield Element((group, number), start + head, length)
        start += head + length


def bare_dicom(head: bytes) -> bool:
    """Whether the bytes begin with data elements of DICOM without its preamble: the first two, as far as they are there, are
    of groups 2 or 8, ascending, and have plausible numbers and lengths."""
    first = list(islice(dicom_elements(head), 2))
    plausible = all(e.tag[0] in BARE_GROUPS and e.tag[1] <= BARE_ELEMENT and e.length <= BARE_LENGTH for e in first)
    return bool(first) and plausible and [e.tag for e in first] == sorted({e.tag for e in first})


@F.pandas_udf(T.StringType())
def text_kind_udf(head: pd.Series) -> pd.Series:
    return head.map(lambda b: None if b is None else text_kind(bytes(b)))


@F.pandas_udf(T.BooleanType())
def bare_dicom_udf(head: pd.Series) -> pd.Series:
    return head.map(lambda b: b is not None and bare_dicom(bytes(b)))


def content_kind(head: Column) -> Column:
    """Magic bytes first, then DICOM without a preamble, then text."""
    return F.coalesce(magic_kind(head), F.when(bare_dicom_udf(head), F.lit("dicom")), text_kind_udf(head))


def jpeg_segments(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(marker, content) of the segments before the picture data; markers may be filled up with FF."""
    at = data.find(b"\xff", 2)
    while 0 <= at < len(data) - 1:
        marker = data[at + 1]
        if marker in (0x00, 0xFF):
            at = data.find(b"\xff", at + 1)
        elif marker in JPEG_ALONE:
            yield marker, b""
            at = data.find(b"\xff", at + 2)
        else:
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            yield marker, data[at + 4 : at + 2 + size]
            at = data.find(b"\xff", at + 2 + size)


def jpeg_frame(data: bytes) -> dict | None:
    """Process, precision, rows, cols and components from the frame's head in a JPEG stream; None if it isn't there."""
    for marker, content in jpeg_segments(data):
        if marker in (0xD9, 0xDA):  # end, or picture data
            return None
        if marker in JPEG_PROCESS and len(content) >= 6:
            return {"process": JPEG_PROCESS[marker], **dict(zip(("precision", "rows", "cols", "components"), struct.unpack_from(">BHHB", content), strict=True))}
    return None
