"""Boundary cases of names, texts, links and rules."""

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import links as L
from sparkloom.functions import names as N
from sparkloom.functions import text as X
from sparkloom.operators import merge as M
from sparkloom.operators import sampling as S
from sparkloom.operators import state as G
from sparkloom.operators import strata as C


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_names(spark):
    names = ["a/b/scan.nii.gz", "x.tar.gz", "data.z01", "img.tif.gz", "README", "x.part2.rar", "x.7z.001", "data.002", "x.zip.partaa", "a.JPG", "x.foo", None]
    assert column(spark, names, N.extension) == [".nii.gz", ".tar.gz", ".z01", ".gz", "", ".rar", ".001", ".002", ".partaa", ".jpg", ".foo", None]
    assert column(spark, names[:11], N.file_kind) == ["volume", "archive", "fragment", "compressed", "noext", "fragment", "archive", "fragment", "archive", "raster", "other"]
    wanted = dict(zip(["fundus.zip", "paper.pdf", "reads.fastq.gz", "img.tif.gz", "x.csv.gz", "scan"], column(spark, ["fundus.zip", "paper.pdf", "reads.fastq.gz", "img.tif.gz", "x.csv.gz", "scan"], N.wanted), strict=True))
    assert wanted == {"fundus.zip": True, "paper.pdf": False, "reads.fastq.gz": False, "img.tif.gz": True, "x.csv.gz": False, "scan": True}
    assert column(spark, ["x.tar.001", "x.zip.partab", "x.part02", "x.zip"], N.split_stem) == ["x.tar", "x.zip", "x", None]
    assert column(spark, ["__MACOSX/a.png", "d/._a.png", "d/.DS_Store", "a.png"], N.is_junk) == [True, True, True, False]
    assert column(spark, ["blank: no finite", "wrong_format (no reader)", "x"], N.unread_reason) == ["blank", "wrong_format", "decode_error"]


@pytest.mark.parametrize(
    ("path", "side"),
    [("study/right-eye/7.png", "R"), ("cohort_os/OD.tif", "R"), ("r.bmp", "U"), ("visit3 R.bmp", "R"), ("L/left2/x9.png", "U"), ("od_os.jpg", "U"), ("pair.tar!/OU/k.png", "B"), ("bilateral_left.png", "L"), ("re/plain.png", "U"), ("plain/re 4.png", "R"), ("", "U"), (None, "U")],
)
def test_laterality(spark, path, side):
    assert column(spark, [path], X.laterality)[0]["side"] == side


def test_license_use(spark):
    cases = [(["PDDL"], "train"), (["bsd-3-clause", " Apache-2.0 "], "train"), (["cc-by-sa-3.0", "notspecified"], "train"), (["pddl", "cc-by-nc-sa-3.0"], "evaluate_only_nc_nd"), (["CC-BY-ND-2.0"], "evaluate_only_nc_nd"), ([" ", "None"], "no_license"), ([None, ""], "no_license"), (None, "no_license"), (["mit", "eupl-1.2"], "check_license"), (["nda"], "check_license")]
    assert column(spark, [c[0] for c in cases], X.license_use, "array<string>") == [c[1] for c in cases]


def test_keywords(spark):
    assert column(spark, ["OCTA and oct of a Macula", "Doctors of eyesight", "Corneal uveitis, uveitis; DME; FAF", None], X.keyword_terms) == [["macula", "OCTA"], [], ["corneal", "uveitis", "DME", "FAF"], []]


def test_links(spark):
    assert column(spark, ["https://a.org/releases/The", "https://a.org/x(1", "https://a.org/x).", "https://a.org/�junk", None], L.clean_link) == ["https://a.org/releases/", "https://a.org/x", "https://a.org/x", "https://a.org/", ""]
    kinds = column(spark, ["https://doi.org/10.5281/zenodo.1", "https://doi.org/10.1000/x", "https://huggingface.co/datasets/a", "https://x.ac.uk/a", "https://b.example/x"], lambda c: L.category(c)[0])
    assert kinds == ["dataset_repository", "paper_doi", "dataset_repository", "institutional", "other"]
    df = spark.createDataFrame([("https://zenodo.org/records/12", "12"), ("https://zenodo.org/records/123", "12"), ("https://doi.org/10.5281/zenodo.12", "12"), ("https://x.figshare.com/articles/a/77", "figshare-77")], "u string, r string")
    assert [r[0] for r in df.select(L.is_self_link(F.col("u"), F.col("r"))).collect()] == [True, False, True, True]


def test_globs(spark):
    import re

    match = lambda g, s: bool(re.match(X.glob_regex(g), s))
    assert match("Raw/**/*", "Raw/sub/x.jpg") and match("Raw/**/*", "Raw/x.jpg")
    assert not match("images/**/*.jpg", "images/a.jpg") and match("*.csv", "a/b.csv")
    assert match("a[!b]c", "axc") and not match("a[!b]c", "abc")


@pytest.mark.parametrize(("counts", "cap", "want"), [({"a": 70, "b": 21, "c": 9}, 10, {"a": 7, "b": 2, "c": 1}), ({"a": 4, "b": 1}, 5, {"a": 4, "b": 1}), ({"x": 3, "y": 3, "z": 3}, 7, {"x": 3, "y": 2, "z": 2}), ({"a": 0, "b": 6}, 4, {"a": 0, "b": 4})])
def test_allocate(spark, counts, cap, want):
    df = spark.createDataFrame(list(counts.items()), "g string, n long")
    assert {r["g"]: r["quota"] for r in S.allocate(df, "g", "n", cap).collect()} == want


def test_prefix_samples(spark):
    df = spark.range(100).selectExpr("id % 2 as g", "id")
    triage = {r["id"] for r in S.two_pass(df, ["g"], "id", 1, 5, 5).collect()}
    deep = {r["id"] for r in S.two_pass(df, ["g"], "id", 1, 5, 20).collect()}
    assert len(triage) == 10 and len(deep) == 40 and triage < deep


def test_series(spark):
    rows = [(f"plate{i}_z.tif", 700 + i) for i in range(6)] + [(f"tiny{i}.tif", 2) for i in range(5)]
    df = spark.createDataFrame(rows, "name string, size long").withColumn("series", N.series(F.col("name")))
    assert S.series_sample(df, [], ["series"], "name", "size", 1, 2, 500).count() == 7
    assert S.series_sample(df, [], ["series"], "name", "size", 1, 0, 500).count() == 11


def test_strata(spark):
    rows = [(1, "disk", "CFP", 6)] * 6 + [(1, "range", "IR", 90)] * 15 + [(2, "disk", "IR", 40)] * 4
    df = spark.createDataFrame(rows, "rec int, s string, cls string, pop long")
    f = C.label_fractions(C.stratum_weights(df, ["rec"], "s", "pop"), ["rec"], "cls", ["CFP", "IR"]).orderBy("rec").collect()
    assert [(round(x["frac_IR"], 12), round(x["frac_CFP"], 12), x["w_total"]) for x in f] == [(0.9375, 0.0625, 96.0), (1.0, 0.0, 4.0)]


def test_dominant_ties(spark):
    df = spark.range(1)
    assert df.select(C.dominant({"CFP": F.lit(2), "IR": F.lit(2)})).first()[0] == "CFP"
    assert df.select(C.dominant({"CFP": F.lit(0), "IR": F.lit(None).cast("int")})).first()[0] is None


def test_merge(spark):
    log = spark.createDataFrame([(7, 0, 0, "started"), (7, 0, 1, "no_files"), (7, 2, 9, "awaiting_deep"), (8, 0, 2, "crashed"), (8, 1, 0, "started"), (9, 1, 1, "ok"), (9, 2, 0, "error")], "id int, run int, pos int, status string")
    got = {r["id"]: (r["status"], r["run"]) for r in M.merge_runs(log, "id", "run", "pos", "status", ("started", "crashed", "awaiting_deep")).collect()}
    assert got == {7: ("no_files", 0), 8: ("started", 1), 9: ("error", 2)}


def test_mask_rule(spark):
    cases = [((51, 49), False), ((9, 8), True), ((8, 9), False), ((200, 3), True), ((90, 12), False)]
    for (masks, rest), want in cases:
        exempt = "CFP" if rest >= 10 else None
        got = spark.range(1).select(C.mask_dominated(F.lit(masks / (masks + rest)), F.lit(rest), F.lit(exempt).cast("string"))).first()[0]
        assert got is want


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id int, run int, pos int, status string, size double")
    assert M.latest(empty, ["id"], ["pos"]).count() == 0
    assert S.budget_prefix(empty, ["id"], "status", "size", "pos", 5).count() == 0
    assert S.greedy_budget(empty, ["id"], ["pos"], "size", 5).count() == 0


def _events(spark, tmp_path, *stamps):
    rows = ", ".join(f"({i}L, timestamp_ntz '{t}', 1L, 'view', 0D, '')" for i, t in enumerate(stamps))
    spark.sql(f"select * from values {rows} as t(event_id, ts, user_id, event_type, value, props)").write.parquet(f"{tmp_path}/events.parquet")


def _both(spark, tmp_path, name):
    import duckdb

    from sparkloom.plans.queries import ORACLE_SQL, QUERIES

    c = duckdb.connect()
    c.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    return sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()), sorted(c.execute(ORACLE_SQL[name]).fetchall())


def test_rate_of_fractional_seconds(spark, tmp_path):
    """Seconds are rounded: the first event is a day before the newest, the others are less."""
    _events(spark, tmp_path, "2024-01-01 00:00:00.4", "2024-01-01 00:00:00.6", "2024-01-01 00:00:02.5", "2024-01-01 23:59:59.7", "2024-01-02 00:00:00.2")
    got, want = _both(spark, tmp_path, "q_rate_eta")
    assert got == want and got[0][:2] == (1, 4)
    assert G.rate_and_eta(spark.read.parquet(f"{tmp_path}/events.parquet").where("event_id in (0, 4)"), "user_id", "ts", 5).first()["recent"] == 1


def test_sessions_of_fractional_seconds(spark, tmp_path):
    """A gap of 5:59:59.6 counts as 6 hours where rounding makes it so, one of 6:00:00.2 doesn't where it doesn't."""
    _events(spark, tmp_path, "2024-01-01 00:00:00.4", "2024-01-01 06:00:00.0", "2024-01-01 12:00:00.5", "2024-01-01 18:00:01.5", "2024-01-02 00:00:01.4")
    got, want = _both(spark, tmp_path, "q_sessions")
    assert got == want
