"""Sources, sinks, content checks, conforming and streaming on small local files."""

import dataclasses
import gzip
import http.server
import io
import json
import tarfile
import threading
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import content as K
from sparkloom.functions import images as I
from sparkloom.plans import conform as P
from sparkloom.plans import workbook as W
from sparkloom.sources import archives as A
from sparkloom.sources import records as R
from sparkloom.sources import remote as M
from sparkloom.sources import sinks as Z
from sparkloom.streaming import tail as T


def test_scrape(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"results": [{"source_id": 1, "source": "zenodo"}, {"id": "2", "source": "Figshare"}, {"title": "no id"}, {"source_id": "figshare-3", "source": "figshare"}]}))
    got = {r["source_id"]: r["figshare_id"] for r in R.scrape(spark, str(tmp_path / "s.json")).collect()}
    assert got == {"1": None, "figshare-2": "2", "figshare-3": None}
    with pytest.raises(Exception, match="mixes"):
        R.one_source(R.scrape(spark, str(tmp_path / "s.json"))).collect()


def test_log(spark, tmp_path):
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    a.write_text('{"record_id": "1", "status": "error"}\n{"record_id": "2", "status": "ok", "kept": true}\n{"record_id": "3", "sta')
    b.write_text('{"record_id": "1", "status": "ok"}\n\n{"x": 1}\n')
    rows = R.status_rows(R.latest_rows(R.log_lines(spark, [str(a), str(b)]))).collect()
    assert {r["record_id"]: (r["status"], r["kept"]) for r in rows} == {"1": ("ok", None), "2": ("ok", True)}


def test_ids_and_csv(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("3, 1 # two\n1\n\n2 3\n")
    assert [r["id"] for r in R.ids_file(spark, str(tmp_path / "ids.txt")).orderBy("pos").collect()] == ["3", "1", "2"]
    (tmp_path / "t.csv").write_text("model_version,n\nv1,2\n,\nv2,3\n")
    assert R.csv_table(spark, str(tmp_path / "t.csv"), ["model_version"]).count() == 2
    with pytest.raises(ValueError, match="no column"):
        R.csv_table(spark, str(tmp_path / "t.csv"), ["other"])


def test_documents(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir(), two.mkdir()
    doc = {"id": "1", "access": {"record": "public", "files": "restricted", "status": "restricted", "embargo": {"active": False}}, "parent": {"access": {}}, "metadata": {"rights": [{"id": "cc-by-4.0"}], "title": "T"}, "files": [{"key": "a.zip", "size": 5, "checksum": "md5:ab", "links": {"self": "u"}}, {"filename": "b", "filesize": 7}, {"size": 1}]}
    (one / "1.json").write_text(json.dumps(doc))
    (two / "1.json").write_text("{}")
    (two / "2.json").write_text("{broken")
    docs = R.json_documents(spark, [str(one), str(two)])
    assert [(r["id"], r["folder"]) for r in docs.select("id", "folder").collect()] == [("1", 0)]
    files = [tuple(r) for r in R.record_files(docs).select("key", "size", "md5", "url").orderBy("key").collect()]
    assert files == [("a.zip", 5, "ab", "u"), ("b", 7, None, None)]
    a = R.access_fields(docs).first()
    assert (a["access_files"], a["access_settings_exposed"], a["access_allow_user_requests"], a["access_files_public_now"], a["access_license_ids"]) == ("restricted", False, None, False, ["cc-by-4.0"])


def test_figshare(spark):
    kind = "id long, title string, doi string, version int, description string, published_date string, is_confidential boolean, is_embargoed boolean, download_disabled boolean, authors array<struct<full_name:string,first_name:string,last_name:string,orcid_id:string>>, tags array<string>, categories array<struct<title:string>>, license struct<name:string>, files array<struct<id:long,name:string,size:long,is_link_only:boolean,download_url:string,computed_md5:string>>"
    f = [(10, "a.png", 1, False, "u1", "m"), (11, "a.png", 2, False, "u2", None), (12, "x", 0, True, "link", None), (13, "d/b.png", 3, False, "u3", None)]
    df = spark.createDataFrame([(7, "T", "d", 1, "x", "2024-01-02T00", False, True, True, [("A", None, None, "")], ["t"], [("c",)], ("CC BY",), f)], kind)
    assert [r["key"] for r in R.figshare_files(df).where("not link_only").orderBy("pos").collect()] == ["a.png", "11_a.png", "b.png"]
    m = R.figshare_record(df).first()
    assert m["id"] == "figshare-7" and m["metadata"]["access_right"] == "embargoed" and m["metadata"]["keywords"] == ["t", "c"]
    assert P.dataset_document(R.figshare_record(df)).first()["provenance"]["title"] == "metadata.title"


def archive() -> bytes:
    inner, tar, outer = io.BytesIO(), io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("in.png", b"inner")
    with tarfile.open(fileobj=tar, mode="w:gz") as t:
        info = tarfile.TarInfo("t.png")
        info.size = 3
        t.addfile(info, io.BytesIO(b"tar"))
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("a.png", b"outer")
        z.writestr("n.zip", inner.getvalue())
        z.writestr("n.tar.gz", tar.getvalue())
        z.writestr("img.tif.gz", gzip.compress(b"tif"))
        z.writestr("read.txt", b"x")
    return outer.getvalue()


def test_archives(spark, tmp_path):
    files = spark.createDataFrame([("x.zip", bytearray(archive())), ("bad.zip", bytearray(b"PK\x03\x04junk")), ("none.zip", None)], "path string, content binary")
    rows = A.list_archives(files).collect()
    shown = {r["display"]: r["size"] for r in rows if r["archive"] == "x.zip"}
    assert {"a.png", "n.zip", "n.zip!/in.png", "n.tar.gz", "n.tar.gz!/t.png", "img.tif.gz", "img.tif.gz!/img.tif", "read.txt"} == set(shown) and shown["n.zip!/in.png"] == 5
    assert all(r["error"] for r in rows if r["archive"] != "x.zip")
    capped = A.list_archives(files.where("path = 'x.zip'"), max_depth=1, cap=2).collect()
    assert [r["display"] for r in capped if r["member"]] == ["a.png", "n.zip"] and capped[-1]["size"] == 3
    assert "n.zip!/in.png" not in {r["display"] for r in A.list_archives(files, max_depth=1).collect()}
    want = spark.createDataFrame([("x.zip", "n.zip!/in.png"), ("x.zip", "a.png"), ("x.zip", "no"), ("bad.zip", "q")], "archive string, display string")
    got = {(r["archive"], r["display"]): r["content"] for r in A.read_members(files, want).collect()}
    assert got == {("x.zip", "n.zip!/in.png"): b"inner", ("x.zip", "a.png"): b"outer", ("x.zip", "no"): None, ("bad.zip", "q"): None}
    (tmp_path / "x.zip").write_bytes(archive())
    spark.dataSource.register(A.ZipListingSource)
    listed = spark.read.format("zip_listing").option("paths", f"{tmp_path}/x.zip;{tmp_path}/no.zip").load().collect()
    assert {r["name"] for r in listed if r["name"]} == {"a.png", "n.zip", "n.tar.gz", "img.tif.gz", "read.txt"} and sum(r["error"] is not None for r in listed) == 1


def test_archives_of_any_size_are_opened_by_path(spark, tmp_path):
    """A zip with a stored member of 2.2 GB, a hole in the file, and members that can't be read beside such that can."""
    big = tmp_path / "big.zip"
    size = 2_200_000_000
    with big.open("wb") as f:
        f.write(b"PK\x03\x04" + b"\0" * 22 + (5).to_bytes(2, "little") + b"\0\0" + b"a.raw")
        f.seek(f.tell() + size)
        second = f.tell()
        f.write(b"PK\x03\x04" + b"\x0a\0" + b"\0" * 8 + zlib.crc32(b"DICOM").to_bytes(4, "little") + (5).to_bytes(4, "little") * 2 + (1).to_bytes(2, "little") + b"\0\0" + b"b" + b"DICOM")
        third = f.tell()
        f.write(b"PK\x03\x04" + b"\x0a\0" + b"\0" * 8 + (1).to_bytes(4, "little") + (5).to_bytes(4, "little") * 2 + (1).to_bytes(2, "little") + b"\0\0" + b"c" + b"wrong")
        at = f.tell()
        for name, crc, n, place in ((b"a.raw", 0, size, 0), (b"b", zlib.crc32(b"DICOM"), 5, second), (b"c", 1, 5, third)):
            f.write(b"PK\x01\x02" + b"\x14\0\x0a\0" + b"\0" * 8 + crc.to_bytes(4, "little") + n.to_bytes(4, "little") * 2 + len(name).to_bytes(2, "little") + b"\0" * 12 + place.to_bytes(4, "little") + name)
        end = f.tell()
        f.write(b"PK\x05\x06" + b"\0" * 4 + (3).to_bytes(2, "little") * 2 + (end - at).to_bytes(4, "little") + at.to_bytes(4, "little") + b"\0\0")
    files = spark.createDataFrame([(str(big),), (str(tmp_path / "none.zip"),)], "path string")
    rows = A.list_archives(files, max_depth=1).collect()
    assert {(r["member"], r["size"]) for r in rows if r["archive"] == str(big)} >= {("a.raw", size), ("b", 5)}
    assert all(r["error"] for r in rows if r["archive"] != str(big))
    want = spark.createDataFrame([(str(big), x) for x in "bcd"], "archive string, display string")
    got = {r["display"]: (r["content"], r["error"]) for r in A.read_members(files, want).collect()}
    assert got["b"] == (b"DICOM", None) and got["c"][0] is None and "CRC" in got["c"][1] and got["d"] == (None, "not in the archive")


@pytest.fixture
def server(tmp_path):
    """A local server that gives ranges, and whole files below ``whole/``."""

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            data = (tmp_path / self.path.strip("/").removeprefix("whole/")).read_bytes()
            first, last = (int(x) for x in self.headers["Range"].removeprefix("bytes=").split("-"))
            part = data if self.path.startswith("/whole/") else data[first : last + 1]
            self.send_response(200 if self.path.startswith("/whole/") else 206)
            self.send_header("Content-Range", f"bytes {first}-{last}/{len(data)}")
            self.send_header("Content-Length", str(len(part)))
            self.end_headers()
            self.wfile.write(part)

        def log_message(self, *args):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_members_by_range(tmp_path, server):
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.txt", "words " * 100_000)
        z.writestr("d/", "")
        z.writestr(zipfile.ZipInfo("b.bin"), b"stored")
    read, size = M.ranges(f"{server}/x.zip")
    entries = A.central_directory(size, read)
    assert [e.name for e in entries] == ["a.txt", "b.bin"] and M.listing_from_json(M.listing_to_json(entries)) == entries
    meter = M.Meter(read, 1 << 20, 50)
    assert M.fetch_member(meter, entries[0], 10**6) == b"words " * 100_000 and M.fetch_member(meter, entries[1], 10) == b"stored"
    assert meter.requests == 4 and meter.bytes < 20_000
    with pytest.raises(M.BudgetSpent):
        M.fetch_member(read, entries[0], 1000)
    with pytest.raises(M.BudgetSpent):
        M.fetch_member(M.Meter(read, 100), entries[0], 10**6)
    wrong = dataclasses.replace(entries[1], crc=1)
    with pytest.raises(ValueError, match="isn't what"):
        M.fetch_member(read, wrong, 10)
    with pytest.raises(OSError, match="ranges"):
        M.ranges(f"{server}/whole/x.zip")
    with zipfile.ZipFile(io.BufferedReader(M.RangeFile(read, size))) as z:
        assert z.read("b.bin") == b"stored"
    assert M.truncated(10, 12, 100) and M.truncated(100, None, 100) and not M.truncated(99, None, 100) and not M.truncated(100, 100, 100)


def test_probes(spark, tmp_path, server):
    names = ["a.png", "d/" + "long" * 60 + ".dcm", "b.bin"]
    for suffix, mode, form in ((".tar", "w", tarfile.GNU_FORMAT), (".tar.gz", "w:gz", tarfile.PAX_FORMAT), (".tar.xz", "w:xz", tarfile.GNU_FORMAT)):
        with tarfile.open(tmp_path / f"t{suffix}", mode, format=form) as t:
            for i, n in enumerate(names):
                info = tarfile.TarInfo(n)
                info.size = 1000 * i
                t.addfile(info, io.BytesIO(b"x" * info.size))
            t.addfile(tarfile.TarInfo("folder/")) if suffix == ".tar" else None
    (tmp_path / "img.tif.gz").write_bytes(gzip.compress(b"tif" * 10))
    (tmp_path / "x.zip").write_bytes(archive())
    (tmp_path / "bad.zip").write_bytes(b"junk")
    paths = [f"{server}/{n}" for n in ("t.tar", "t.tar.gz", "x.zip", "bad.zip", "no.7z")] + [str(tmp_path / n) for n in ("t.tar.xz", "img.tif.gz")]
    rows = M.probe_archives(spark.createDataFrame([(p,) for p in paths if "no.7z" not in p], "path string")).collect()
    of = lambda end: sorted((r["name"], r["size"]) for r in rows if r["path"].endswith(end) and r["name"] and not r["name"].endswith("/"))
    want = sorted((n, 1000 * i) for i, n in enumerate(names))
    assert of("t.tar.gz") == of("t.tar.xz") == want and [x for x in of("t.tar") if x[0] != "folder"] == want
    assert of("img.tif.gz") == [("img.tif", 30)] and ("n.zip") in {n for n, _ in of("x.zip")}
    assert all(r["complete"] == (not r["path"].endswith("bad.zip")) for r in rows) and sum(r["error"] is not None for r in rows) == 1
    few = M.probe_archives(spark.createDataFrame([(str(tmp_path / "t.tar"),)], "path string"), most_requests=3).collect()
    assert few[-1]["error"].startswith("budget") and not any(r["complete"] for r in few) and few[0]["name"] == "a.png"


def test_members_without_extension_are_sniffed(spark, tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in (("d/IM1", b"\0" * 128 + b"DICM"), ("IM2", b"\x08\x00\x05\x00CS\x04\x00ISO "), ("README", b"text"), ("p.png", b"\x89PNG\r\n\x1a\n"), ("J", b"\xff\xd8\xff")):
            z.writestr(name, data)
    got = {r["member"]: r["sniffed"] for r in A.list_archives(spark.createDataFrame([("x.zip", bytearray(out.getvalue()))], "path string, content binary")).collect()}
    assert got == {"d/IM1": "dicom", "IM2": "dicom", "README": None, "p.png": None, "J": "jpeg"}


def test_readme_sample(spark, tmp_path):
    for name, text in (("a/README.md", "first"), ("b/Readme.TXT", "second"), ("c/readme_not.md", "no"), ("d/x.png", "\xff"), ("e/README", "")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    names = ("readme.md", "readme.txt", "readme")
    assert R.readme_sample(spark, str(tmp_path), names, 4, 6).first()["text"] == "firs\nse"
    assert R.readme_sample(spark, str(tmp_path), names, 100, 1000).first()["text"] == "first\nsecond"


def test_content(spark):
    cases = {b"\xff\xd8\xff\xe0": "jpeg", b"\x89PNG\r\n\x1a\n": "png", b"\0" * 128 + b"DICM": "dicom", b"": "empty", b"<!DOCTYPE html><html>": "html page", b'<?xml version="1.0"?><Error>x': "XML error page", b"version https://git-lfs.github.com": "git-lfs pointer", b'{"a": 1}': "JSON", b"plain": "text", b"\x00\x01\x02\x03": None, b"../../.git/annex/objects/x": "git-annex link", b"RIFF\0\0\0\0WEBP": "webp", b"\x08\x00\x05\x00CS\x04\x00ISO ": "dicom"}
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(cases)], "i int, head binary")
    assert [r[0] for r in df.orderBy("i").select(K.content_kind(F.col("head"))).collect()] == list(cases.values())
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc2\x00\x11\x08\x00\x10\x00\x20\x03" + b"\0" * 12
    assert K.jpeg_frame(jpeg) == {"process": "progressive", "precision": 8, "rows": 16, "cols": 32, "components": 3}
    assert K.jpeg_frame(b"\xff\xd8\xff\xd9\0\0\0") is None


def test_images(spark):
    rng = np.random.default_rng(0)
    photo = rng.integers(0, 256, (200, 200, 3), dtype=np.uint8)
    mask = np.zeros((200, 200, 3), np.uint8)
    mask[50:90, 40:140] = 255
    assert I.mask_like(mask) and not I.mask_like(photo) and I.pixel_flags(np.zeros((64, 64, 3), np.uint8))["blank"]
    assert I.native_mask_like(photo[..., 0]) is None and not I.native_mask_like(rng.integers(0, 4000, (300, 300)))
    assert I.content_box(mask[..., 0]) == (50, 90, 40, 140)
    assert I.image_plane((10, 400, 500)) == ((5, None, None), (400, 500)) and I.image_plane((400, 500, 3)) == ((None, None, None), (400, 500)) and I.image_plane((1000, 5)) is None
    assert I.preprocess(photo).shape == (3, 224, 224)
    rows = [("a", bytearray(photo.tobytes()), 200, 200), ("b", bytearray(b"xx"), 5, 5), ("c", bytearray(200 * 200 * 3), 200, 200)]
    fake = lambda: lambda batch: np.tile([0.25, 0.75], (len(batch), 1))
    got = {r["path"]: r for r in I.score(spark.createDataFrame(rows, "path string, pixels binary, rows int, cols int"), fake).collect()}
    assert got["a"]["probs"] == [0.25, 0.75] and got["b"]["error"] and got["c"]["blank"] and got["c"]["probs"] is None


def test_conform(spark):
    reply = 'Sure! {broken ```json\n{"task_type": "x", "placements": [{"glob": "Raw/**/*", "addf_dir": "retina/cfp", "modality": "CFP"}, {"glob": "*.csv", "addf_dir": "tables"}, {"no": 1}], "notes": ["n", 2, []]}``` done'
    r = P.recipe(reply)
    assert len(r["placements"]) == 2 and r["placements"][1]["modality"] == "other" and r["notes"] == ["n", "2"]
    assert P.recipe("nothing") is None and P.recipe('{"placements": []}') is None
    files = spark.createDataFrame([("Raw/a/x.jpg", 1, 2), ("Raw/t.csv", 1, 1), ("t.csv", 1, 0), ("other.bin", 1, 0)], "path string, size long, depth int")
    plan = P.placement_plan(P.inventory(files), r["placements"])
    assert {x["path"]: x["target"] for x in plan.collect()} == {"Raw/a/x.jpg": "retina/cfp", "Raw/t.csv": "retina/cfp", "t.csv": "tables", "other.bin": "_unplaced"}
    d = P.descriptor(plan).collect()
    assert [x["directoryName"] for x in d] == ["retina", "tables"] and d[0]["directoryList"][0]["directoryName"] == "cfp" and d[1]["directoryList"] is None
    v = P.validate_tree(P.descriptor(plan), spark.createDataFrame([("tables",)], "directoryName string")).first()
    assert v["missing"] == ["retina"] and v["ok"] is False


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "token=SECRET", 5)], "record_id string, line string, n int")
    Z.append_log(df, str(tmp_path / "log"), ["SECRET", ""])
    Z.append_log(df, str(tmp_path / "log"), ["SECRET"])
    assert [r["line"] for r in spark.read.json(str(tmp_path / "log")).collect()] == ["token=[redacted]"] * 2
    modes = spark.createDataFrame([(1, "local"), (2, "none"), (3, "local")], "record_id long, mode string")
    assert {r["mode"]: r["n"] for r in Z.id_lists(modes, str(tmp_path / "ids")).collect()} == {"local": 2, "none": 1}
    Z.workbook({"Records": df.withColumn("a", F.array("n"))}, str(tmp_path / "book"), ("parquet", "csv"))
    assert spark.read.csv(str(tmp_path / "book/Records.csv"), header=True).first()["a"] == "[5]"
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    (src / "a.txt").write_text("x")
    plan = spark.createDataFrame([("a.txt", "d"), ("missing", "d")], "path string, target string")
    assert {r["path"]: r["action"] for r in Z.place_files(plan, str(src), str(dst)).collect()} == {"a.txt": "linked", "missing": "failed"}
    assert (dst / "d/a.txt").read_text() == "x"


def test_workbook(spark, tmp_path):
    rows = [(10, "ok", "deep", 4, ["OCTA"], {"OCTA": (3, 0.5), "NEG": (1, 0.9)}, False, 0.2, "NEGATIVE", [("u", "o", "k")], [("a.zip", 5)], {"png": 3}, {"czi": 1}, True, 2_000_000, '{"t": 1}', {"title": "x"}, "OP\x01"), (9, "no_files", None, 0, [], None, None, None, None, None, None, None, None, None, None, None, None, None)]
    kind = "record_id long, status string, sampling_pass string, n_classified int, present array<string>, classes map<string,struct<n:int,conf:double>>, mask_dominated boolean, eye_image_fraction double, setfit_label string, weblinks array<struct<url:string,origins:string,kind:string>>, probes array<struct<key:string,size:int>>, formats_classified map<string,int>, formats_unread map<string,int>, kept boolean, kept_bytes long, document string, provenance map<string,string>, dicom_modality string"
    records = spark.createDataFrame(rows, kind)
    other = spark.createDataFrame([(1, "x")], "rank int, title string")
    book = W.sheets(records, other, other)
    assert len(book) == 12
    Z.workbook(book, str(tmp_path / "book"), ("parquet", "csv"))
    read = lambda n: spark.read.parquet(str(tmp_path / f"book/{n}.parquet")).collect()
    assert [r["record_id"] for r in book["Records"].collect()] == [9, 10] and {r["dicom_modality"] for r in read("DICOM_Mapping")} == {"OP", None}
    assert [r["review_likely_false_positive"] for r in read("Review_Likely_FP")] == ["only OCTA; discovery SetFit label NEGATIVE; eye image fraction 0.20 < 0.5"]
    assert {(r["class"], r["n"], r["share"]) for r in read("Record_Classes")} == {("OCTA", 3, 0.75), ("NEG", 1, 0.25)}
    assert {r["key"]: r["value"] for r in read("README")} == {"Records": "2", "Records with classified images": "1", "Records with an eye modality": "1", "Records whose images are mostly masks": "0", "Records whose fetched files were kept": "1", "Bytes kept": "2.0 MB", "Records with documents": "1", "Status: no_files": "1", "Status: ok": "1", "Pass: (none)": "1", "Pass: deep": "1"}
    empty = W.sheets(records.limit(0), other, other)
    assert {n: t.count() for n, t in empty.items() if n not in ("README", "Access_Requests", "Model_Training_Datasets")} == dict.fromkeys(set(book) - {"README", "Access_Requests", "Model_Training_Datasets"}, 0)


def test_stream(spark, tmp_path):
    log, table, mark = tmp_path / "log", str(tmp_path / "table"), str(tmp_path / "mark")
    log.mkdir()
    line = lambda i, s: json.dumps({"record_id": i, "status": s}) + "\n"
    run = lambda: T.run_once(lambda: T.keep_latest(T.log_stream(spark, str(log), suffix=".jsonl"), table, mark))
    state = lambda: {r["record_id"]: r["status"] for r in T.read_latest(spark, table).collect()}
    with pytest.raises(FileNotFoundError):
        T.read_latest(spark, table)
    one = log / "1.jsonl"
    one.write_text(line("a", "started") + line("b", "ok") + "not json\n" + '{"record_id": "b", "sta')
    (log / "other.txt").write_text(line("x", "ok"))
    run()
    assert state() == {"a": "started", "b": "ok"}
    with one.open("a") as f:  # the same file grows, and the half line is finished
        f.write('tus": "error"}\n' + line("a", "ok") + line("a", "failed") + "".join(line(f"r{i}", "ok") for i in range(300)))
    run()
    assert state() == {"a": "failed", "b": "error"} | {f"r{i}": "ok" for i in range(300)}
    (log / "2.jsonl").write_text(line("c", "started") + line("a", "done"))
    run()
    run()
    assert state() == {"a": "done", "b": "error", "c": "started"} | {f"r{i}": "ok" for i in range(300)}
    files = {f for v in T._versions(spark, table).values() for f in v.values()}
    assert len(files) <= len(T._folders(spark, table, 1 << 62)) + 2  # replaced versions are gone, but for those before the last batch
    m = T.monitor(T.read_latest(spark, table), 400, ("started",)).first()
    assert (m["done"], m["left"], m["by_status"]["ok"]) == (302, 98, 300)


def test_tail_splits_large_logs(tmp_path, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 7)
    path = tmp_path / "x.log"
    lines = ["", "a", "bb" * 10, "ccc", "é"]
    path.write_text("\n".join(lines) + "\nhalf")
    r = T._TailReader(str(path), "")
    end = r.latestOffset()
    got = [x for p in r.partitions({}, end) for x in r.read(p)]
    assert [v for _, _, v in got] == lines and [at for _, at, _ in got] == sorted({at for _, at, _ in got})
    assert r.partitions(end, end) == [] and [v for p in r.partitions({str(path): 1}, end) for _, _, v in r.read(p)] == lines[1:]
