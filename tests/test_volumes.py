"""Readers of simple scientific formats."""

import gzip
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import volumes as V

A = np.arange(24, dtype="<i2").reshape(2, 3, 4)  # x, y, z


def nifti(order="<", slope=0.0, kind=4, a=A):
    head = bytearray(352)
    head[0:4] = np.array(348, order + "i4").tobytes()
    head[40:56] = np.array([3, *a.shape, 1, 1, 1, 1], order + "i2").tobytes()
    head[70:72] = np.array(kind, order + "i2").tobytes()
    head[108:120] = np.array([352, slope, 1 if slope else 0], order + "f4").tobytes()
    head[344:348] = b"n+1\0"
    return bytes(head) + a.astype(a.dtype.newbyteorder(order)).tobytes("F")


def test_volumes():
    assert (V.nifti(nifti()) == A).all() and (V.nifti(gzip.compress(nifti(">"))) == A).all() and (V.nifti(nifti(slope=2.0)) == A * 2.0 + 1).all()
    raw = A.tobytes("F")
    text = "NRRD0004\n# note\ntype: short\ndimension: 3\nsizes: 2 3 4\nendian: little\nencoding: {}\n"
    assert (V.nrrd(text.format("raw").encode() + b"\n" + raw) == A).all()
    assert (V.nrrd(text.format("gzip").encode() + b"\n" + gzip.compress(raw)) == A).all()
    assert (V.nrrd((text.format("raw") + "data file: x.raw\n").encode(), raw) == A).all()
    meta = "ObjectType = Image\nNDims = 3\nDimSize = 2 3 4\nElementType = MET_SHORT\nBinaryDataByteOrderMSB = {}\nElementDataFile = {}\n"
    assert (V.metaimage(meta.format("False", "LOCAL").encode() + raw) == A).all()
    assert (V.metaimage(meta.format("True", "x.raw").encode(), A.astype(">i2").tobytes("F")) == A).all()
    bands = np.arange(24, dtype="<u2").reshape(2, 3, 4)  # bands, lines, samples
    for order, axes in (("bsq", (0, 1, 2)), ("bil", (1, 0, 2)), ("bip", (1, 2, 0))):
        header = f"ENVI\nsamples = 4\nlines = 3\nbands = 2\nheader offset = 5\ndata type = 12\ninterleave = {order}\nbyte order = 0\nwavelength = {{1,\n 2}}\n"
        assert (V.envi(header, b"12345" + bands.transpose(axes).tobytes()) == bands).all()
    z = (A + 1j * A).astype("<c8")
    assert (V.bart("# Dimensions\n2 3 4 1 1 \n# Command\n", z.tobytes("F")) == z).all()
    assert V.en_face(z, 2).shape == (2, 3) and np.allclose(V.en_face(A, 2), A.mean(2))


@pytest.mark.parametrize("broken", [b"", b"NRRD0004\ntype: block\nsizes: 2\n\n12", nifti()[:360], nifti(kind=1), b"ElementDataFile = LOCAL\n"])
def test_broken_volumes_raise(broken):
    for read in (V.nifti, V.nrrd, V.metaimage):
        with pytest.raises(ValueError):
            read(broken)
    with pytest.raises(ValueError):
        V.read_volume(".mhd", b"DimSize = 2 2\nElementType = MET_UCHAR\nElementDataFile = no.raw\n")
    with pytest.raises(ValueError):
        V.envi("ENVI\nlines = 2", b"")


def test_arrays_of_containers():
    out = io.BytesIO()
    np.savez(out, scan=np.zeros((40, 50)), label=np.zeros((90, 90)), x=np.zeros((60, 60)), small=np.zeros((3, 900)), o=np.array([{}], object))
    got = V.numpy_arrays(out.getvalue())
    assert set(got) == {"scan", "label", "x", "small"}
    assert V.candidates({k: v.shape for k, v in got.items()}) == ["scan", "x", "label"] and V.candidates({}) == []
    one = io.BytesIO()
    np.save(one, A)
    assert (V.numpy_arrays(one.getvalue())[""] == A).all()


def test_volume_facts(spark):
    rows = [(".nii", bytearray(nifti()), None), (".hdr", bytearray(b"ENVI\nsamples = 2\nlines = 2\ndata type = 1\n"), bytearray(b"\1\2\3\4")), (".nii", bytearray(b"x"), None), (".czi", bytearray(b""), None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, ext string, data binary, companion binary")
    got = [r["f"] for r in df.select("i", V.volume_facts(F.col("ext"), F.col("data"), F.col("companion")).alias("f")).orderBy("i").collect()]
    assert [(f["rows"], f["cols"], f["low"], f["high"]) for f in got[:2]] == [(2, 3, 0.0, 23.0), (1, 2, 1.0, 4.0)] and all(f["error"] for f in got[2:])
