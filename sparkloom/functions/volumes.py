"""Arrays of simple scientific formats with NumPy alone: NIfTI-1, NRRD, MetaImage, ENVI, BART and NumPy files.

Each reader takes the bytes (and those of the data file, where header and data are apart) and gives an array; what a file
lacks or a reader can't do raises ValueError.
"""

from __future__ import annotations

import gzip
import io
import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element types by the formats' names and numbers.
NIFTI_TYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8"}
NRRD_TYPES = {
    "i1": ("signed char", "int8", "int8_t"), "u1": ("uchar", "unsigned char", "uint8", "uint8_t"), "i2": ("short", "short int", "signed short", "int16", "int16_t"),
    "u2": ("ushort", "unsigned short", "unsigned short int", "uint16", "uint16_t"), "i4": ("int", "signed int", "int32", "int32_t"),
    "u4": ("uint", "unsigned int", "uint32", "uint32_t"), "i8": ("longlong", "long long", "int64", "int64_t"),
    "u8": ("ulonglong", "unsigned long long", "uint64", "uint64_t"), "f4": ("float",), "f8": ("double",),
}
META_TYPES = {"MET_CHAR": "i1", "MET_UCHAR": "u1", "MET_SHORT": "i2", "MET_USHORT": "u2", "MET_INT": "i4", "MET_UINT": "u4", "MET_LONG_LONG": "i8", "MET_ULONG_LONG": "u8", "MET_FLOAT": "f4", "MET_DOUBLE": "f8"}
ENVI_TYPES = {1: "u1", 2: "i2", 3: "i4", 4: "f4", 5: "f8", 6: "c8", 9: "c16", 12: "u2", 13: "u4", 14: "i8", 15: "u8"}
ENVI_ORDERS = {"bsq": (0, 1, 2), "bil": (1, 0, 2), "bip": (2, 0, 1)}


def _shaped(raw: bytes, kind: str, shape: list[int], order: str) -> np.ndarray:
    """The first elements of the raw bytes in the shape; too few raise."""
    n = int(np.prod(shape, dtype=np.int64))
    if n <= 0 or len(raw) < n * np.dtype(kind).itemsize:
        raise ValueError("the data are shorter than the header says")
    return np.frombuffer(raw, kind, n).reshape(shape, order=order)


def nifti(data: bytes) -> np.ndarray:
    """A NIfTI-1 volume, gzipped or not, x first, with its slope and intercept."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    end = next((e for e in "<>" if len(data) >= 352 and np.frombuffer(data, e + "i4", 1)[0] == 348), None)
    if end is None or data[344:348] not in (b"n+1\0", b"ni1\0"):
        raise ValueError("not NIfTI-1")
    dim = np.frombuffer(data, end + "i2", 8, 40)
    kind = NIFTI_TYPES.get(int(np.frombuffer(data, end + "i2", 1, 70)[0]))
    if kind is None or not 1 <= dim[0] <= 7:
        raise ValueError("an element type or shape that isn't read")
    offset, slope, intercept = np.frombuffer(data, end + "f4", 3, 108)
    out = _shaped(data[int(offset) :], end + kind, [int(d) for d in dim[1 : 1 + dim[0]]], "F")
    return out if slope in (0, 1) and intercept == 0 or not np.isfinite(slope) else out * float(slope) + float(intercept)


def _fields(text: str, separator: str) -> dict[str, str]:
    pairs = (line.split(separator, 1) for line in text.splitlines() if separator in line and not line.startswith("#"))
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _unpacked(raw: bytes, encoding: str) -> bytes:
    if encoding in ("gzip", "gz"):
        return gzip.decompress(raw)
    if encoding != "raw":
        raise ValueError(f"encoding {encoding} isn't read")
    return raw


def nrrd(data: bytes, detached: bytes | None = None) -> np.ndarray:
    """A NRRD volume, fastest axis first; a header with a data file apart needs its bytes."""
    if not data.startswith(b"NRRD000"):
        raise ValueError("not NRRD")
    head, _, raw = data.partition(b"\n\n") if b"\n\n" in data else (data, b"", b"")
    f = _fields(head.decode("utf-8", "replace"), ":")
    if "data file" in f or "datafile" in f:
        if detached is None:
            raise ValueError("companion data file missing")
        raw = detached
    kind = next((k for k, names in NRRD_TYPES.items() if f.get("type", "").lower() in names), None)
    if kind is None or "sizes" not in f:
        raise ValueError("an element type or shape that isn't read")
    end = ">" if f.get("endian", "little").lower() == "big" else "<"
    return _shaped(_unpacked(raw, f.get("encoding", "raw").lower()), end + kind, [int(x) for x in f["sizes"].split()], "F")


def metaimage(data: bytes, detached: bytes | None = None) -> np.ndarray:
    """A MetaImage volume, fastest axis first; a header with a data file apart needs its bytes."""
    m = re.search(rb"(?im)^\s*ElementDataFile\s*=\s*(\S+)[^\n]*(?:\n|$)", data[: 1 << 20])
    if not m:
        raise ValueError("not MetaImage")
    f = _fields(data[: m.end()].decode("latin-1"), "=")
    local = m[1].upper() == b"LOCAL"
    if not local and detached is None:
        raise ValueError("companion data file missing")
    raw = data[m.end() :] if local else detached or b""
    if f.get("compresseddata", "false").lower() == "true":
        raw = zlib.decompress(raw)
    kind = META_TYPES.get(f.get("elementtype", "").upper())
    if kind is None or "dimsize" not in f:
        raise ValueError("an element type or shape that isn't read")
    channels = int(f.get("elementnumberofchannels", 1))
    end = ">" if f.get("binarydatabyteordermsb", f.get("elementbyteordermsb", "false")).lower() == "true" else "<"
    shape = [int(x) for x in f["dimsize"].split()]
    return _shaped(raw, end + kind, ([channels] if channels > 1 else []) + shape, "F")


def envi(header: str, data: bytes) -> np.ndarray:
    """An ENVI image as bands, lines, samples."""
    f = {m[1].strip().lower(): m[2].strip().strip("{}").strip() for m in re.finditer(r"(?m)^[ \t]*([^=\n]+?)[ \t]*=[ \t]*(\{[^}]*\}|[^\n]*)", header)}
    try:
        shape = {"bands": int(f.get("bands", 1)), "lines": int(f["lines"]), "samples": int(f["samples"])}
        kind = (">" if f.get("byte order", "0") == "1" else "<") + ENVI_TYPES[int(f["data type"])]
        axes = ENVI_ORDERS[f.get("interleave", "bsq").lower()]
    except KeyError as e:
        raise ValueError(f"the header lacks or has an unknown {e}") from e
    stored = {"bsq": ("bands", "lines", "samples"), "bil": ("lines", "bands", "samples"), "bip": ("lines", "samples", "bands")}[f.get("interleave", "bsq").lower()]
    return _shaped(data[int(f.get("header offset", 0)) :], kind, [shape[s] for s in stored], "C").transpose(axes)


def bart(header: str, data: bytes) -> np.ndarray:
    """A BART array (complex, column-major), axes of length 1 left out."""
    m = re.search(r"(?m)^#\s*Dimensions\s*\n([0-9 ]+)", header)
    if not m:
        raise ValueError("not BART")
    return _shaped(data, "<c8", [int(x) for x in m[1].split()], "F").squeeze()


def numpy_arrays(data: bytes) -> dict[str, np.ndarray]:
    """The arrays of a .npy or .npz file by name (empty for .npy); objects are never unpickled, such arrays are left out."""
    if data[:6] == b"\x93NUMPY":
        return {"": np.load(io.BytesIO(data), allow_pickle=False)}
    out = {}
    with np.load(io.BytesIO(data), allow_pickle=False) as z:
        for name in z.files:
            try:
                out[name] = z[name]
            except ValueError:
                continue
    return out


READERS: dict[str, Callable[..., np.ndarray]] = {".nii": nifti, ".nii.gz": nifti, ".nrrd": nrrd, ".nhdr": nrrd, ".mha": metaimage, ".mhd": metaimage}


def read_volume(ext: str, data: bytes, companion: bytes | None = None) -> np.ndarray:
    """The volume of a file by its extension, with its data file's bytes where they are apart."""
    if ext == ".hdr":
        if companion is None:
            raise ValueError("companion data file missing")
        text = data.decode("latin-1")
        return bart(text, companion) if "# Dimensions" in text else envi(text, companion)
    if ext not in READERS:
        raise ValueError(f"no reader for {ext}")
    return READERS[ext](data) if READERS[ext] is nifti else READERS[ext](data, companion)


def en_face(volume: np.ndarray, axis: int) -> np.ndarray:
    """The mean along an axis, of the magnitude where values are complex."""
    return (np.abs(volume) if np.iscomplexobj(volume) else volume).mean(axis=axis, dtype=np.float64)


#: Likely images among the arrays of a container: how a name speaks for it, sides of a plane, arrays that are tried.
GOOD_NAMES, BAD_NAMES = re.compile(r"(?i)im(?:g|age)|oct|scan|volume|fundus|data|pixel"), re.compile(r"(?i)label|weight|bias|index|kernel|mask|time|coord")
LEAST_SIDE, TRIED = 32, 6


def candidates(shapes: dict[str, tuple[int, ...]], tried: int = TRIED) -> list[str]:
    """Names of the arrays that may be images, the likeliest first: by what their name says, then by the size of their largest
    plane, then by name."""
    rows = []
    for name, shape in shapes.items():
        sides = sorted((n for n in shape if n > 1), reverse=True)
        if len(sides) >= 2 and sides[1] >= LEAST_SIDE:
            rows.append((bool(BAD_NAMES.search(name)), not GOOD_NAMES.search(name), -sides[0] * sides[1], name))
    return [name for *_, name in sorted(rows)[:tried]]


FACTS = T.StructType([T.StructField(n, k) for n, k in (("rows", T.IntegerType()), ("cols", T.IntegerType()), ("low", T.DoubleType()), ("high", T.DoubleType()), ("error", T.StringType()))])


@F.pandas_udf(FACTS)
def volume_facts_udf(ext: pd.Series, data: pd.Series, companion: pd.Series) -> pd.DataFrame:
    def one(e, d, c):
        try:
            v = read_volume(e, bytes(d), None if c is None else bytes(c))
            v = np.abs(v) if np.iscomplexobj(v) else v
            return v.shape[0], v.shape[1] if v.ndim > 1 else 1, float(v.min()), float(v.max()), None
        except Exception as x:  # noqa: BLE001  a file that can't be read is a row
            return None, None, None, None, f"{type(x).__name__}: {x}"[:300]

    rows = [one(*x) for x in zip(ext, data, companion, strict=True)]
    return pd.DataFrame(rows, columns=["rows", "cols", "low", "high", "error"]).astype({"rows": "Int32", "cols": "Int32"})


def volume_facts(ext: Column, data: Column, companion: Column) -> Column:
    """struct(rows, cols, low, high, error): the first two axes and the range of a volume's values; ``companion`` may be null."""
    return volume_facts_udf(ext, data, companion)
