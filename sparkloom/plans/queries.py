"""Queries of the operators over the driver's tables, each with the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links as L
from ..functions import names as N
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import merge as M
from ..operators import sampling as S
from ..operators import state as G
from ..operators import strata as C

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, read when they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def r6(c: F.Column | str) -> F.Column:
    return F.round(c, 6)


# ---- flagship: stratified class fractions of sampled documents ----

_CLASS_SQL = "CASE WHEN l.doc_id IS NULL THEN 'UNCERTAIN' WHEN toxic = 1 THEN 'MASK' WHEN quality = 1 THEN 'CFP' ELSE 'NEG' END"


def _classified(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "lang", "source")
    population = docs.groupBy("source", "lang").agg(F.count("*").alias("population"))
    sample = S.seeded_rank(docs, ["source", "lang"], "doc_id", 7).where("rn <= 40")
    label = F.when(F.col("toxic").isNull(), "UNCERTAIN").when(F.col("toxic") == 1, "MASK").when(F.col("quality") == 1, "CFP").otherwise("NEG")
    joined = sample.join(t.labels, "doc_id", "left").withColumn("cls", label)
    return joined.join(population, ["source", "lang"])


_CLASSIFIED_SQL = f"""
d AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY source, lang ORDER BY md5('7:' || source || ':' || lang || ':' || doc_id), doc_id) AS rn,
  count(*) OVER (PARTITION BY source, lang) AS population FROM documents),
c AS (SELECT d.*, {_CLASS_SQL} AS cls FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE rn <= 40),
k AS (SELECT *, count(*) OVER (PARTITION BY source, lang) AS k FROM c),
w AS (SELECT *, CASE WHEN (SELECT count(DISTINCT lang) FROM c c2 WHERE c2.source = k.source) > 1 THEN greatest(population, k)::DOUBLE / k ELSE 1.0 END AS w FROM k)
"""

_LABELS = ["CFP", "NEG", "UNCERTAIN", "MASK"]
_FRACTIONS_SQL = "SELECT source, count(*) AS n, sum(w) AS total, " + ", ".join(f"count(*) FILTER (cls = '{c}') AS n_{c}, coalesce(sum(w) FILTER (cls = '{c}'), 0) AS w_{c}" for c in _LABELS) + " FROM w GROUP BY source"


def _fractions(t: Tables) -> DataFrame:
    weighted = C.stratum_weights(_classified(t), ["source"], "lang", "population")
    return C.label_fractions(weighted, ["source"], "cls", _LABELS)


@query(f"""WITH {_CLASSIFIED_SQL}, f AS ({_FRACTIONS_SQL})
SELECT source, n, n_MASK, round(w_CFP / total, 6) AS frac_cfp, round(w_NEG / total, 6) AS frac_neg, round(w_UNCERTAIN / total, 6) AS frac_uncertain, round(w_MASK / total, 6) AS frac_mask,
  CASE WHEN w_CFP > 0 AND w_CFP >= w_NEG AND w_CFP >= w_UNCERTAIN THEN 'CFP' WHEN w_NEG > 0 AND w_NEG >= w_UNCERTAIN THEN 'NEG' WHEN w_UNCERTAIN > 0 THEN 'UNCERTAIN' END AS dominant,
  CASE WHEN w_MASK / total >= 0.5 THEN 'mask_dominated' WHEN w_CFP / total >= 0.05 THEN 'ok' ELSE 'no_eye_images' END AS status FROM f""")
def q_modality_rollup(t: Tables) -> DataFrame:
    f = _fractions(t)
    status = C.cascade([(F.col("frac_MASK") >= 0.5, "mask_dominated"), (F.col("frac_CFP") >= 0.05, "ok")], "no_eye_images")
    return f.select("source", "n", "n_MASK", *[r6(f"frac_{c}").alias(f"frac_{c.lower()}") for c in _LABELS], C.dominant({c: F.col(f"w_{c}") for c in _LABELS[:3]}).alias("dominant"), status.alias("status"))


@query(f"""WITH {_CLASSIFIED_SQL} SELECT doc_id, source, lang, round(w, 6) AS w FROM w""")
def q_strata_weights(t: Tables) -> DataFrame:
    return C.stratum_weights(_classified(t), ["source"], "lang", "population").select("doc_id", "source", "lang", r6("w").alias("w"))


# ---- logs ----


@query("""SELECT user_id, event_type AS status, event_id, event_type <> 'view' AS final FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_status(t: Tables) -> DataFrame:
    last = M.latest(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])
    return last.select("user_id", F.col("event_type").alias("status"), "event_id", M.is_final(F.col("event_type"), ("view",)).alias("final"))


_RUNS_SQL = """r AS (SELECT user_id, event_id % 3 AS run, event_id, event_type, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id DESC) AS rn FROM events),
m AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (event_type NOT IN ('view', 'click'))::INT DESC, run DESC) AS rk FROM r WHERE rn = 1)"""


def _merged(t: Tables) -> DataFrame:
    runs = t.events.select("user_id", (F.col("event_id") % 3).alias("run"), "event_id", "event_type")
    return M.merge_runs(runs, "user_id", "run", "event_id", "event_type", ("view", "click"))


@query(f"WITH {_RUNS_SQL} SELECT user_id, run, event_id, event_type FROM m WHERE rk = 1")
def q_merge_runs(t: Tables) -> DataFrame:
    return _merged(t).select("user_id", "run", "event_id", "event_type")


@query(f"WITH {_RUNS_SQL} SELECT event_type AS status, count(*) AS n_records, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM m WHERE rk = 1 GROUP BY event_type")
def q_status_rollup(t: Tables) -> DataFrame:
    counts = _merged(t).groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n_records"))
    total = counts.agg(F.sum("n_records").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("status", "n_records", r6(100.0 * F.col("n_records") / F.col("total")).alias("percent"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus <> 'P')")
def q_todo_anti(t: Tables) -> DataFrame:
    done = t.orders.where(M.is_final(F.col("o_orderstatus"), ("P",))).select(F.col("o_custkey").alias("c_custkey"))
    return M.todo(t.customer.select("c_custkey", "c_mktsegment"), done, "c_custkey")


@query("SELECT user_id, event_id, 'crashed' AS event_type FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type = 'click'")
def q_crashed_rows(t: Tables) -> DataFrame:
    return M.crashed(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"], "event_type", "click").select("user_id", "event_id", "event_type")


@query("""WITH b AS (SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1), a AS (SELECT CASE WHEN event_type = 'error' THEN 'retried' ELSE event_type END AS status, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(b.status, a.status) AS status, coalesce(b.n, 0) AS before, coalesce(a.n, 0) AS after FROM b FULL JOIN a ON a.status = b.status""")
def q_log_rerun(t: Tables) -> DataFrame:
    e = t.events.withColumnRenamed("event_type", "status")
    return M.merge_counts(e, e.withColumn("status", F.when(F.col("status") == "error", "retried").otherwise(F.col("status"))), "status")


@query("""WITH n AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 4 = 0), l AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0)
SELECT * FROM l WHERE o_custkey NOT IN (SELECT o_custkey FROM n) UNION ALL SELECT * FROM n""")
def q_log_merge(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return M.replace_by_id(o.where("o_orderkey % 4 <> 0"), o.where("o_orderkey % 4 = 0"), "o_custkey")


# ---- samples and budgets ----


@query("""SELECT source, doc_id, rn, CASE WHEN rn <= 3 THEN 'triage' ELSE 'deep' END AS stage FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('11:' || source || ':' || doc_id), doc_id) AS rn FROM documents) WHERE rn <= 10""")
def q_seeded_sample(t: Tables) -> DataFrame:
    return S.two_pass(t.documents.select("source", "doc_id"), ["source"], "doc_id", 11, 3, 10).select("source", "doc_id", F.col("rn").cast("long").alias("rn"), "stage")


_ALLOCATE_SQL = """n AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang),
q AS (SELECT *, sum(n) OVER (PARTITION BY source) AS total, ({cap} * n) // greatest(sum(n) OVER (PARTITION BY source), 1) AS q, ({cap} * n) % greatest(sum(n) OVER (PARTITION BY source), 1) AS r FROM n),
a AS (SELECT source, lang, n, CASE WHEN total <= {cap} THEN n ELSE least(n, q + (row_number() OVER (PARTITION BY source ORDER BY r DESC, lang) <= {cap} - sum(q) OVER (PARTITION BY source))::INT) END::BIGINT AS quota FROM q)"""


@query("WITH " + _ALLOCATE_SQL.replace("{cap}", "13") + " SELECT source, lang, n, quota FROM a")
def q_allocate(t: Tables) -> DataFrame:
    counts = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"))
    return S.allocate(counts, "lang", "n", 13, ["source"])


@query("WITH " + _ALLOCATE_SQL.replace("{cap}", "13") + """, d AS (SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY md5('5:' || source || ':' || lang || ':' || doc_id), doc_id) AS rn FROM documents)
SELECT d.source, d.lang, d.doc_id FROM d JOIN a ON d.source = a.source AND d.lang = a.lang WHERE rn <= quota""")
def q_member_sample(t: Tables) -> DataFrame:
    return S.quota_sample(t.documents.select("source", "lang", "doc_id"), ["source"], "lang", "doc_id", 5, 13)


@query("""WITH p AS (SELECT p_partkey, p_brand, p_type, p_size, p_size >= 20 AS large FROM part)
SELECT p_partkey, p_brand, p_type, p_size FROM p QUALIFY NOT large OR row_number() OVER (PARTITION BY p_brand, p_type, large ORDER BY md5('3:' || p_brand || ':' || p_partkey), p_partkey) <= 2""")
def q_series_sample(t: Tables) -> DataFrame:
    return S.series_sample(t.part.select("p_partkey", "p_brand", "p_type", "p_size"), ["p_brand"], ["p_type"], "p_partkey", "p_size", 3, 2, 20)


@query("""WITH u AS (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS s, min(l_linenumber) AS f FROM lineitem GROUP BY 1, 2),
k AS (SELECT *, sum(s) OVER (PARTITION BY l_orderkey ORDER BY s, f, l_suppkey ROWS UNBOUNDED PRECEDING) <= 60 AS kept FROM u)
SELECT l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_quantity, k.kept FROM lineitem l JOIN k USING (l_orderkey, l_suppkey)""")
def q_budget_prefix(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
    return S.budget_prefix(rows, ["l_orderkey"], "l_suppkey", "l_quantity", "l_linenumber", 60).select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "kept")


@query("""WITH x AS (SELECT o_custkey, o_orderkey, o_totalprice, md5('9:' || o_custkey || ':' || o_orderkey) AS h FROM orders),
s AS (SELECT *, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY h, o_orderkey ROWS UNBOUNDED PRECEDING) > 500000 AS over FROM x)
SELECT o_custkey, o_orderkey, NOT bool_or(over) OVER (PARTITION BY o_custkey ORDER BY h, o_orderkey ROWS UNBOUNDED PRECEDING) AS kept FROM s""")
def q_budget_stop(t: Tables) -> DataFrame:
    return S.budget_stop(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_orderkey", "o_totalprice", 9, 500_000).select("o_custkey", "o_orderkey", "kept")


@query("""WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, round(o_totalprice)::BIGINT AS price, row_number() OVER (PARTITION BY o_custkey ORDER BY round(o_totalprice)::BIGINT DESC, o_orderkey) AS i FROM orders),
f(o_custkey, o_orderkey, i, total, kept) AS (
  SELECT o_custkey, o_orderkey, i, CASE WHEN price <= 400000 THEN price ELSE 0 END, price <= 400000 FROM o WHERE i = 1
  UNION ALL SELECT o.o_custkey, o.o_orderkey, o.i, CASE WHEN f.total + price <= 400000 THEN f.total + price ELSE f.total END, f.total + price <= 400000 FROM f JOIN o ON o.o_custkey = f.o_custkey AND o.i = f.i + 1)
SELECT o_custkey, o_orderkey FROM f WHERE kept""")
def q_greedy_budget(t: Tables) -> DataFrame:
    price = F.round("o_totalprice").cast("long")
    rows = t.orders.select("o_custkey", (-price).alias("first"), "o_orderkey", price.alias("price"))
    return S.greedy_budget(rows, ["o_custkey"], ["first", "o_orderkey"], "price", 400_000).select("o_custkey", "o_orderkey")


@query("""WITH RECURSIVE o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q, l_linenumber % 3 AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem),
s(l_orderkey, i, l_linenumber, l_partkey, opened, images, streak, total, reason) AS (
  SELECT l_orderkey, 0, 0, 0::BIGINT, 0, 0, 0, 0::DOUBLE, '' FROM o WHERE i = 1
  UNION ALL SELECT l_orderkey, i, l_linenumber, l_partkey, opened + ok, images + ok * n, CASE WHEN ok = 0 THEN streak WHEN n > 0 THEN 0 ELSE streak + 1 END, total + ok * q, reason FROM (
    SELECT *, CASE WHEN reason IS NULL THEN 1 ELSE 0 END AS ok FROM (SELECT o.*, s.opened, s.images, s.streak, s.total,
      CASE WHEN opened >= 4 THEN 'opened' WHEN images >= 3 THEN 'images' WHEN streak >= 2 THEN 'empty' WHEN q > 45 THEN 'size' WHEN total + q > 120 THEN 'budget' END AS reason FROM s JOIN o ON o.l_orderkey = s.l_orderkey AND o.i = s.i + 1)))
SELECT l_orderkey, l_linenumber, l_partkey, reason IS NULL AS fetched, reason FROM s WHERE i > 0""")
def q_nested_fetch(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", (F.col("l_linenumber") % 3).alias("images"))
    out = S.capped_fold(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "l_quantity", "images", 4, 3, 2, 45, 120)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "fetched", "reason")


@query("""SELECT l_orderkey, l_linenumber, n_total, greatest(n_total - 3, 0) AS n_over FROM (SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS n_total, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn <= 3""")
def q_entry_cap(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return S.entry_cap(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], 3).select("l_orderkey", "l_linenumber", "n_total", "n_over")


# ---- decisions ----


@query("""WITH c AS (SELECT o_orderpriority, CASE o_orderstatus WHEN 'O' THEN 'OCT' WHEN 'F' THEN 'CFP' ELSE 'IR' END AS cls FROM orders),
n AS (SELECT o_orderpriority, cls, count(*) AS n FROM c GROUP BY 1, 2)
SELECT o_orderpriority, cls AS dominant, n::DOUBLE AS dominant_n FROM n QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, CASE cls WHEN 'CFP' THEN 1 WHEN 'IR' THEN 2 ELSE 3 END) = 1""")
def q_dominant(t: Tables) -> DataFrame:
    cls = F.when(F.col("o_orderstatus") == "O", "OCT").when(F.col("o_orderstatus") == "F", "CFP").otherwise("IR")
    rows = t.orders.select("o_orderpriority", cls.alias("cls"), F.lit(1.0).alias("w"))
    return C.dominant_rows(rows, ["o_orderpriority"], "cls", "w", C.CLASSES)


@query(f"""WITH {_CLASSIFIED_SQL}, f AS ({_FRACTIONS_SQL})
SELECT source, CASE WHEN total > 0 AND (w_CFP + w_NEG) / total >= 0.05 THEN concat_ws(', ', CASE WHEN n_CFP >= 1 AND w_CFP / total >= 0.2 THEN 'CFP' END, CASE WHEN n_NEG >= 1 AND w_NEG / total >= 0.2 THEN 'NEG' END) ELSE '' END AS present FROM f""")
def q_presence_rule(t: Tables) -> DataFrame:
    f = _fractions(t)
    two = ["CFP", "NEG"]
    return f.select("source", F.array_join(C.present({c: F.col(f"n_{c}") for c in two}, {c: F.col(f"w_{c}") for c in two}, F.col("w_total"), 0.2, 0.05), ", ").alias("present"))


_MASK_SQL = """m AS (SELECT source, CASE WHEN toxic = 1 THEN 'MASK' WHEN quality = 1 THEN 'CFP' ELSE 'IR' END AS cls, (d.doc_id % 50) / 100.0 + 0.5 AS conf FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
e AS (SELECT source, cls, count(*) AS n, avg(conf) AS c FROM m WHERE cls IN ('CFP', 'IR') GROUP BY 1, 2 HAVING count(*) >= 10 AND avg(conf) >= 0.75),
b AS (SELECT source, cls AS exempt FROM e QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, cls) = 1),
s AS (SELECT source, count(*) AS n, count(*) FILTER (cls = 'MASK') AS n_mask FROM m GROUP BY 1)"""


def _masks(t: Tables) -> DataFrame:
    cls = F.when(F.col("toxic") == 1, "MASK").when(F.col("quality") == 1, "CFP").otherwise("IR")
    return t.documents.select("doc_id", "source").join(t.labels, "doc_id").select("source", cls.alias("cls"), ((F.col("doc_id") % 50) / 100.0 + 0.5).alias("conf"))


@query(f"WITH {_MASK_SQL} SELECT s.source, n, n_mask, exempt, n_mask::DOUBLE / n >= 0.1 AND n - n_mask < 50 AND exempt IS NULL AS dominated FROM s LEFT JOIN b USING (source)")
def q_mask_dominated(t: Tables) -> DataFrame:
    m = _masks(t)
    exempt = C.mask_exempt(m, ["source"], "cls", "conf", ["CFP", "IR"])
    sums = m.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("cls") == "MASK").alias("n_mask"))
    frac = F.col("n_mask") / F.col("n")
    dominated = C.mask_dominated(F.when(frac >= 0.1, 1.0).otherwise(0.0), F.col("n") - F.col("n_mask"), F.col("exempt"))
    return sums.join(exempt, "source", "left").select("source", "n", "n_mask", "exempt", dominated.alias("dominated"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'ok' WHEN o_orderstatus = 'P' THEN 'remote_listing_failed' WHEN o_orderpriority LIKE '1%' THEN 'no_images_in_archives' WHEN o_totalprice > 100000 THEN 'images_unreadable' ELSE 'no_image_files' END
  || CASE WHEN o_orderkey % 7 = 0 AND NOT (o_totalprice <= 300000 AND o_orderstatus = 'P') THEN '_partial_download' ELSE '' END AS status FROM orders""")
def q_status_cascade(t: Tables) -> DataFrame:
    status = C.cascade(
        [(F.col("o_totalprice") > 300_000, "ok"), (F.col("o_orderstatus") == "P", "remote_listing_failed"), (F.col("o_orderpriority").startswith("1"), "no_images_in_archives"), (F.col("o_totalprice") > 100_000, "images_unreadable")],
        "no_image_files",
    )
    partial = (F.col("o_orderkey") % 7 == 0) & (F.col("status") != "remote_listing_failed")
    return t.orders.select("o_orderkey", status.alias("status")).select("o_orderkey", F.concat("status", F.when(partial, "_partial_download").otherwise("")).alias("status"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: exp(x::DOUBLE - list_max(embedding)::DOUBLE)) AS e FROM embeddings), p AS (SELECT vec_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM v)
SELECT vec_id, 'c' || list_position(p, list_max(p)) AS top, round(list_max(p), 6) AS p, CASE WHEN list_max(p) >= 0.018 THEN 'c' || list_position(p, list_max(p)) ELSE 'UNCERTAIN' END AS label FROM p""")
def q_threshold_argmax(t: Tables) -> DataFrame:
    logits = F.transform("embedding", lambda x: x.cast("double"))
    probs = t.embeddings.select("vec_id", C.softmax(logits).alias("probs"))
    top, p, label = C.thresholded(F.col("probs"), [f"c{i + 1}" for i in range(64)], 0.018)
    return probs.select("vec_id", top.alias("top"), r6(p).alias("p"), label.alias("label"))


@query("SELECT label, " + ", ".join(f"round(sum((vec_id % 5 + 1) * embedding[{i + 1}]::DOUBLE) / sum(vec_id % 5 + 1), 6) AS mean_{i}" for i in range(64)) + " FROM embeddings GROUP BY label")
def q_mean_vector(t: Tables) -> DataFrame:
    rows = t.embeddings.select("label", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"), (F.col("vec_id") % 5 + 1).alias("w"))
    m = C.mean_vector(rows, ["label"], "embedding", 64, "w")
    return m.select("label", *[r6(f"mean_{i}").alias(f"mean_{i}") for i in range(64)])


# ---- names ----

_NAMES = ["scan.nii.gz", "x.tar.gz", "data.z01", "img.tif.gz", "a.b.JPG", "photo.jpeg", "vol.hdr", "oct.e2e", "clip.mp4", "arr.npz", "m.czi", "set.part2.rar", "set.7z.001", "data.002", "x.zip.partab", "README", "paper.pdf", "reads.fastq.gz", "x.dcm", "fig.svg", "t.unknown"]
_NAMES_SQL = "(SELECT p_partkey, ([" + ", ".join(f"'{n}'" for n in _NAMES) + f"])[(p_partkey % {len(_NAMES)})::INT + 1] AS name FROM part)"
_KIND_SQL = "CASE WHEN frag THEN 'fragment' " + " ".join(f"WHEN ext IN ({', '.join(repr(e) for e in exts)}) THEN '{kind}'" for kind, exts in N.KINDS.items() if kind not in ("archive", "compressed")) + f" WHEN ext IN ({', '.join(repr(e) for e in N.KINDS['archive'])}) OR first THEN 'archive' WHEN ext IN ({', '.join(repr(e) for e in N.KINDS['compressed'])}) THEN 'compressed' WHEN ext = '' THEN 'noext' ELSE 'other' END"
_EXT_SQL = "coalesce(nullif(regexp_extract(lower(name), '(" + "|".join(e.replace(".", "\\.") for e in N._KNOWN) + ")$', 1), ''), regexp_extract(lower(name), '(\\.[^.]*)$', 1))"
_FRAG_SQL = r"regexp_matches(lower(name), '\.[zr][0-9]{2,3}$') OR coalesce(try_cast(regexp_extract(lower(name), '\.part([0-9]+)\.rar$', 1) AS INT) > 1, false) OR coalesce(try_cast(regexp_extract(lower(name), '\.([0-9]{3})$', 1) AS INT) > 1, false) OR (regexp_extract(lower(name), '\.part([a-z]{2})$', 1) NOT IN ('', 'aa')) OR coalesce(try_cast(regexp_extract(lower(name), '\.part([0-9]{1,3})$', 1) AS INT) > 1, false)"
_FIRST_SQL = r"coalesce(try_cast(regexp_extract(lower(name), '\.([0-9]{3})$', 1) AS INT) = 1, false) OR regexp_matches(lower(name), '\.partaa$') OR coalesce(try_cast(regexp_extract(lower(name), '\.part([0-9]{1,3})$', 1) AS INT) = 1, false)"


def _named(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.get(F.array(*map(F.lit, _NAMES)), (F.col("p_partkey") % len(_NAMES)).cast("int")).alias("name"))


@query(f"WITH n AS (SELECT p_partkey, name, {_EXT_SQL} AS ext, {_FRAG_SQL} AS frag, {_FIRST_SQL} AS first FROM {_NAMES_SQL}) SELECT p_partkey, name, ext, {_KIND_SQL} AS kind FROM n")
def q_file_ext_kind(t: Tables) -> DataFrame:
    return _named(t).select("p_partkey", "name", N.extension(F.col("name")).alias("ext"), N.file_kind(F.col("name")).alias("kind"))


@query(r"""WITH n AS (SELECT p_partkey, p_brand, (['big.z01', 'big.zip', 'set.part1.rar', 'set.part2.rar', 'a.7z.001', 'b.tar.002', 'c.zip.partab', 'one.png'])[(p_partkey % 8)::INT + 1] AS name FROM part),
k AS (SELECT *, coalesce(CASE WHEN regexp_matches(lower(name), '\.([0-9]{3}|part[a-z]{2}|part[0-9]{1,3})$') THEN 'g:' || lower(regexp_replace(lower(name), '\.([0-9]{3}|part[a-z]{2}|part[0-9]{1,3})$', '')) END,
  CASE WHEN regexp_matches(lower(name), '^(.+)\.(z[0-9]{2,3}|zip)$') THEN '0:' || regexp_extract(lower(name), '^(.+)\.(z[0-9]{2,3}|zip)$', 1) END,
  CASE WHEN regexp_matches(lower(name), '^(.+)\.part[0-9]+\.rar$') THEN '1:' || regexp_extract(lower(name), '^(.+)\.part[0-9]+\.rar$', 1) END) AS set_key FROM n)
SELECT p_brand, set_key, count(*) AS n_parts, count(*) > 1 OR set_key LIKE '1:%' AS is_set FROM k WHERE set_key IS NOT NULL GROUP BY 1, 2""")
def q_split_sets(t: Tables) -> DataFrame:
    names = ["big.z01", "big.zip", "set.part1.rar", "set.part2.rar", "a.7z.001", "b.tar.002", "c.zip.partab", "one.png"]
    n = t.part.select("p_brand", F.get(F.array(*map(F.lit, names)), (F.col("p_partkey") % 8).cast("int")).alias("name"))
    keyed = n.select("p_brand", N.split_set(F.col("name")).alias("set_key")).where("set_key is not null")
    return keyed.groupBy("p_brand", "set_key").agg(F.count("*").alias("n_parts")).withColumn("is_set", (F.col("n_parts") > 1) | F.col("set_key").startswith("1:"))


@query("""WITH f AS (SELECT p_brand, 'v' || (p_partkey // 6) || (['.hdr', '.dat', '.IMG', '.mhd', '.zraw', '.png'])[(p_partkey % 6)::INT + 1] AS name FROM part),
h AS (SELECT p_brand, name AS header, lower(name[:length(name) - 4]) AS stem, lower(name[length(name) - 3:]) AS ext FROM f WHERE lower(name[length(name) - 3:]) IN ('.hdr', '.mhd')),
o(ext, rank, data) AS (VALUES ('.hdr', 0, '.img'), ('.hdr', 1, '.cfl'), ('.hdr', 2, '.dat'), ('.hdr', 3, '.raw'), ('.mhd', 0, '.raw'), ('.mhd', 1, '.zraw'), ('.mhd', 2, '.img'))
SELECT h.p_brand, h.header, arg_min(f.name, rank) AS data FROM h JOIN o ON h.ext = o.ext JOIN f ON f.p_brand = h.p_brand AND lower(f.name) = h.stem || o.data GROUP BY 1, 2""")
def q_companion(t: Tables) -> DataFrame:
    exts = [".hdr", ".dat", ".IMG", ".mhd", ".zraw", ".png"]
    f = t.part.select("p_brand", F.concat(F.lit("v"), F.expr("p_partkey div 6").cast("string"), F.get(F.array(*map(F.lit, exts)), (F.col("p_partkey") % 6).cast("int"))).alias("name"))
    return J.companions(f, ["p_brand"], "name")


_ROUTE_SQL = """r AS (SELECT o_orderkey, l_linenumber, CASE WHEN p_size = l_quantity::INT THEN 'available' WHEN l_returnflag = 'R' THEN 'remote_zip' WHEN l_quantity > 25 THEN 'fetch' ELSE 'skip' END AS route
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey),
m AS (SELECT o_orderkey, CASE WHEN bool_or(route = 'remote_zip') THEN 'remote_zip' WHEN bool_or(route = 'fetch') THEN 'download' WHEN bool_or(route = 'available') THEN 'local' ELSE 'none' END AS mode FROM r GROUP BY 1)"""


def _modes(t: Tables) -> DataFrame:
    files = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("part"), F.col("l_quantity").cast("int").alias("size"), "l_returnflag", "l_quantity")
    files = t.orders.select("o_orderkey").join(files, "o_orderkey")
    local = t.part.select(F.col("p_partkey").alias("part"), F.col("p_size").alias("size"))
    return J.record_mode(J.route(files, local, ["part"], "size", F.col("l_quantity") > 25, F.col("l_returnflag") == "R"), ["o_orderkey"])


@query(f"WITH {_ROUTE_SQL} SELECT o_orderkey, mode FROM m")
def q_plan_route(t: Tables) -> DataFrame:
    return _modes(t)


@query(f"WITH {_ROUTE_SQL} SELECT mode, count(*) AS n FROM m GROUP BY mode")
def q_partition_counts(t: Tables) -> DataFrame:
    return _modes(t).groupBy("mode").agg(F.count("*").alias("n"))


# ---- links ----

_HREF = 'href="([^"]*)"'
_STRIP_SQL = "regexp_replace({}, '[.,;:)\\]}}>''\"]+$', '')"
_GLUED_SQL = "regexp_replace({}, '([a-z0-9/_\\-])(" + L.GLUED.split(")(", 1)[1].removesuffix(")$") + ")$', '\\1')"
_CLEAN_SQL = _STRIP_SQL.format(_GLUED_SQL.format(_STRIP_SQL.format(_GLUED_SQL.format(_STRIP_SQL.format("trim(href)")))))
_LINKS_SQL = f"""h AS (SELECT page_id, unnest(regexp_extract_all(html, '{_HREF}', 1)) AS href, generate_subscripts(regexp_extract_all(html, '{_HREF}', 1), 1) AS pos FROM pages)"""


def _hrefs(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))).alias("pos", "href"))


@query(f"""WITH {_LINKS_SQL} SELECT page_id, pos, href, {_CLEAN_SQL} AS clean FROM h""")
def q_links_extract(t: Tables) -> DataFrame:
    return _hrefs(t).select("page_id", (F.col("pos") + 1).cast("long").alias("pos"), "href", L.clean_link(F.col("href")).alias("clean"))


_SITES = ["zenodo.org/records/{}", "github.com/a/{}", "doi.org/10.5281/zenodo.{}", "doi.org/10.1038/s{}", "drive.google.com/file/{}", "huggingface.co/datasets/x{}", "huggingface.co/x{}", "www.uni-ulm.edu/{}", "arxiv.org/abs/{}", "me.github.io/{}", "example.net/data/{}.zip", "example.net/page/{}"]


def _site(t: Tables) -> DataFrame:
    url = F.replace(F.get(F.array(*[F.lit("https://" + s) for s in _SITES]), (F.col("c_custkey") % len(_SITES)).cast("int")), F.lit("{}"), F.col("c_custkey").cast("string"))
    return t.customer.select("c_custkey", url.alias("url"))


def _like(hay: str, needles: tuple[str, ...]) -> str:
    return "regexp_matches(" + hay + ", '" + "|".join(n.replace(".", "\\.") for n in needles) + "')"


_SITE_SQL = "s AS (SELECT c_custkey, replace(([" + ", ".join(f"'https://{s}'" for s in _SITES) + f"])[(c_custkey % {len(_SITES)})::INT + 1], '{{}}', c_custkey::VARCHAR) AS url FROM customer), hp AS (SELECT *, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM s), dd AS (SELECT *, CASE WHEN host LIKE '%doi.org%' THEN nullif(regexp_extract(url, '(10\\.[0-9]{{4,9}}/[^\\s\"<>]+)', 1), '') END AS doi FROM hp)".replace("{{", "{").replace("}}", "}")
_CATEGORY_SQL = f"""CASE WHEN split_part(doi, '/', 1) IN ({', '.join(repr(p) for p in L.DATA_DOI_PREFIXES)}) THEN 'dataset_repository' WHEN doi IS NOT NULL THEN 'paper_doi' WHEN {_like('host', L.CLOUD_DOMAINS)} THEN 'cloud_drive'
  WHEN host LIKE '%huggingface.co%' AND path LIKE '%/datasets/%' THEN 'dataset_repository' WHEN host LIKE '%huggingface.co%' THEN 'code' WHEN {_like('lower(host || path)', L.DATASET_DOMAINS)} THEN 'dataset_repository'
  WHEN {_like('host', L.CODE_DOMAINS)} THEN 'code' WHEN {_like('host', L.PAPER_DOMAINS)} THEN 'paper_doi' WHEN regexp_matches(host, '{L.INSTITUTION}') OR host LIKE '%github.io' THEN 'institutional' ELSE 'other' END"""


@query(f"""WITH {_SITE_SQL}, c AS (SELECT *, {_CATEGORY_SQL} AS category FROM dd)
SELECT c_custkey, url, category, CASE WHEN category IN ('dataset_repository', 'cloud_drive') THEN true WHEN regexp_matches(path, '{L.DATA_EXT}') THEN true WHEN category = 'paper_doi' THEN false ELSE regexp_matches(path, '{L.DATA_PATH}') END AS dataset_likely FROM c""")
def q_links_category(t: Tables) -> DataFrame:
    kind, _ = L.category(F.col("url"))
    rows = _site(t).withColumn("category", kind)
    return rows.select("c_custkey", "url", "category", L.likely_dataset(F.col("url"), F.col("category"), F.lit(None).cast("string")).alias("dataset_likely"))


@query(f"""WITH {_LINKS_SQL}, k AS (SELECT page_id, pos, href, replace(rtrim(lower({_CLEAN_SQL}), '/'), 'http://', 'https://') AS key, CASE WHEN pos % 2 = 0 THEN 'even' ELSE 'odd' END AS origin, CASE WHEN pos % 3 = 0 THEN 'third' END AS kind FROM h),
o AS (SELECT page_id, key, origin, min(pos) AS p FROM k GROUP BY 1, 2, 3)
SELECT k.page_id, k.key, arg_min(href, pos) AS url, (SELECT string_agg(origin, '; ' ORDER BY p) FROM o WHERE o.page_id = k.page_id AND o.key = k.key) AS origins, arg_min(kind, pos) FILTER (kind IS NOT NULL) AS kind, min(pos) AS first_pos FROM k GROUP BY 1, 2""")
def q_links_dedupe(t: Tables) -> DataFrame:
    h = _hrefs(t).withColumn("pos", (F.col("pos") + 1).cast("long"))
    rows = h.select("page_id", "pos", "href", L.link_key(L.clean_link(F.col("href"))).alias("key"), F.when(F.col("pos") % 2 == 0, "even").otherwise("odd").alias("origin"), F.when(F.col("pos") % 3 == 0, "third").alias("kind"))
    return A.merge_links(rows, ["page_id"], "key", "href", "origin", "kind", "pos")


# ---- texts ----


@query("""SELECT page_id, length(trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')))::BIGINT AS n, md5(trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) AS digest FROM pages""")
def q_strip_html(t: Tables) -> DataFrame:
    plain = t.pages.select("page_id", X.strip_html(F.col("html"), entities=False).alias("plain"))
    return plain.select("page_id", F.length("plain").cast("long").alias("n"), F.md5(F.col("plain").cast("binary")).alias("digest"))


_TERMS = ["Retinal fundus", "OCT", "octopus", "Glaucoma eyes", "AMD and DME", "the OCTA of eyes", "corneal", "optic disc", "a b c", "faf FAF"]


def _terms_sql() -> str:
    """Words in lower case in order of place, then acronyms, each once."""
    words, acronyms = (x.replace("(?U)", "").replace("(?i)", "") for x in (X.EYE_WORDS, X.EYE_ACRONYMS))
    both = f"list_concat(list_transform(regexp_extract_all(s, '(?i){words}', 1), lambda x: lower(x)), regexp_extract_all(s, '{acronyms}', 1))"
    return f"list_filter({both}, lambda x, i: list_position({both}, x) = i)"


_EYE_SQL = "p_name || ' ' || (" + "[" + ", ".join(f"'{x}'" for x in _TERMS) + "])[(p_partkey % 10)::INT + 1] || ' ' || p_type || ' ' || ([" + ", ".join(f"'{x}'" for x in _TERMS) + "])[(p_partkey // 10 % 10)::INT + 1]"


@query(f"""WITH x AS (SELECT p_partkey, {_EYE_SQL} AS s FROM part) SELECT p_partkey, array_to_string({_terms_sql()}, '; ') AS terms FROM x""")
def q_keywords(t: Tables) -> DataFrame:
    at = lambda k: F.get(F.array(*map(F.lit, _TERMS)), (k % 10).cast("int"))
    s = F.concat_ws(" ", "p_name", at(F.col("p_partkey")), "p_type", at(F.expr("p_partkey div 10")))
    return t.part.select("p_partkey", F.array_join(X.keyword_terms(s), "; ").alias("terms"))


_IDS = ["cc-by-4.0", "cc-by-nc-4.0", "mit", "gpl", "", "other-closed", "cc0-1.0", "none", "cc-by-nd-4.0"]


@query("WITH i AS (SELECT s_suppkey, list_filter([([" + ", ".join(f"'{x}'" for x in _IDS) + "])[(s_suppkey % 9)::INT + 1], ([" + ", ".join(f"'{x}'" for x in _IDS) + """])[(s_suppkey % 4)::INT + 1]], lambda x: x NOT IN ('', 'none')) AS ids FROM supplier)
SELECT s_suppkey, CASE WHEN len(ids) = 0 THEN 'no_license' WHEN len(list_filter(ids, lambda x: regexp_matches(x, '(^|-)(nc|nd)(-|$)'))) > 0 THEN 'evaluate_only_nc_nd' WHEN len(list_filter(ids, lambda x: NOT regexp_matches(x, '^(cc0|cc-by|mit)'))) = 0 THEN 'train' ELSE 'check_license' END AS use FROM i""")
def q_license_use(t: Tables) -> DataFrame:
    ids = F.array(*map(F.lit, _IDS))
    at = lambda k: F.get(ids, (F.col("s_suppkey") % k).cast("int"))
    return t.supplier.select("s_suppkey", X.license_use(F.array(at(9), at(4))).alias("use"))


_FOLDERS = ["set/OD", "left_eyes", "zip.zip!/both_eyes", "re", "OD_OS", "plain", "R 1/x", "bilateral/OS"]
_FILE_NAMES = ["img_01", "12_L", "L", "scan_L1_R2", "pt_left_OS", "a_R_b_L", "x", "re", "ou-3", "Right.eye_1", "le"]


def _laterality_sql() -> str:
    """The sides of the name and of its folders from the nearest, the first that has any."""
    sides = "CASE t " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.SIDES.items()) + " END"
    return rf"""p AS (SELECT p_partkey, ([{', '.join(f"'{x}'" for x in _FOLDERS)}])[(p_partkey % 8)::INT + 1] || '/' || ([{', '.join(f"'{x}'" for x in _FILE_NAMES)}])[(p_partkey // 8 % 11)::INT + 1] || '.png' AS path FROM part),
c AS (SELECT p_partkey, list_reverse(list_filter(string_split_regex(path, '!/|/'), lambda x: x <> '')) AS parts FROM p),
k AS (SELECT p_partkey, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM c),
w AS (SELECT p_partkey, i, list_filter(string_split_regex(lower(CASE WHEN i = 1 THEN regexp_replace(part, '\.[^.]*$', '') ELSE part END), '[^a-z0-9]+'), lambda x: x <> '') AS tokens FROM k),
u AS (SELECT p_partkey, i, len(tokens) AS n, unnest(tokens) AS t FROM w),
s AS (SELECT p_partkey, i, {sides} AS side FROM u WHERE {sides} IS NOT NULL AND NOT (t IN ('r', 'l') AND n < 2) AND (t NOT IN ('re', 'le') OR i = 1)),
f AS (SELECT p_partkey, i, list(DISTINCT side) FILTER (side <> 'B') AS one FROM s GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY i) = 1)"""


@query(f"""WITH {_laterality_sql()} SELECT p.p_partkey, CASE WHEN f.i IS NULL OR len(one) > 1 THEN 'U' ELSE coalesce(one[1], 'B') END AS side, CASE WHEN f.i IS NULL THEN 'none' WHEN f.i = 1 THEN 'basename' ELSE 'dirname' END AS source, coalesce(len(one) > 1, false) AS conflict FROM p LEFT JOIN f ON f.p_partkey = p.p_partkey""")
def q_laterality(t: Tables) -> DataFrame:
    at = lambda values, k: F.get(F.array(*map(F.lit, values)), (k % len(values)).cast("int"))
    path = F.concat(at(_FOLDERS, F.col("p_partkey")), F.lit("/"), at(_FILE_NAMES, F.expr("p_partkey div 8")), F.lit(".png"))
    return t.part.select("p_partkey", X.laterality(path).alias("x")).select("p_partkey", "x.*")


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_type, 'STEEL$|steel$') THEN 0 WHEN regexp_matches(p_type, '(?i)^standard') THEN 1 WHEN regexp_matches(p_type, '(?i)brush|polish') THEN 2 END AS ordinal,
 CASE WHEN regexp_matches(p_type, 'STEEL$|steel$') THEN 'metal' WHEN regexp_matches(p_type, '(?i)^standard') THEN 'plain' WHEN regexp_matches(p_type, '(?i)brush|polish') THEN 'finish' END AS maker FROM part""")
def q_pattern_join(t: Tables) -> DataFrame:
    return J.first_match(t.part.select("p_partkey", "p_type"), "p_type", [("STEEL$|steel$", "metal"), ("(?i)^standard", "plain"), ("(?i)brush|polish", "finish")], ["maker"]).drop("p_type")


_GLOBS = [("en/**/*", "english"), ("*/1*", "ones"), ("*.html", "pages"), ("fr/**/*", "french")]


@query("""WITH u AS (SELECT page_id, regexp_extract(url, '://[^/?#]*/?([^?#]*)', 1) AS path FROM pages)
SELECT page_id, path, CASE WHEN path LIKE 'en/%/%' OR path LIKE 'en/%' THEN 'english' WHEN path LIKE '%/1%' THEN 'ones' WHEN path LIKE '%.html' THEN 'pages' WHEN path LIKE 'fr/%' THEN 'french' ELSE '_unplaced' END AS target FROM u""")
def q_glob_placement(t: Tables) -> DataFrame:
    path = F.regexp_extract("url", "://[^/?#]*/?([^?#]*)", 1)
    rows = J.first_match(t.pages.select("page_id", path.alias("path")), "path", [(X.glob_regex(g), d) for g, d in _GLOBS], ["target"])
    return rows.select("page_id", "path", F.coalesce("target", F.lit("_unplaced")).alias("target"))


# ---- rollups ----


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '://[^/?#]*/?([^?#]*)', 1) AS path FROM pages)
SELECT split_part(path, '/', 1) AS top, count(*) AS n_files, count(DISTINCT split_part(path, '/', 2)) AS n_children, min(page_id) AS first_pos FROM p GROUP BY 1""")
def q_descriptor(t: Tables) -> DataFrame:
    parts = F.split(F.regexp_extract("url", "://[^/?#]*/?([^?#]*)", 1), "/")
    rows = t.pages.select("page_id", parts[0].alias("top"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("child"))
    return rows.groupBy("top").agg(F.count("*").alias("n_files"), F.count_distinct("child").alias("n_children"), F.min("page_id").alias("first_pos"))


@query("""WITH f AS (SELECT regexp_extract(url, '://[^/?#]*/([a-z]*)/', 1) AS lang, octet_length(encode(html)) AS size, length(url) - length(replace(url, '/', '')) - 2 AS depth, CASE WHEN regexp_extract(url, '(\\.html)', 1) <> '' THEN '.html' ELSE '' END AS ext FROM pages)
SELECT lang, count(*) AS n_files, sum(size)::BIGINT AS total_bytes, max(depth)::BIGINT AS max_depth, count(*) FILTER (ext = '.html') AS n_readable, count(DISTINCT ext) AS n_modalities, coalesce(string_agg(DISTINCT ext, ',') FILTER (ext <> '.html'), '') AS unreadable_exts FROM f GROUP BY lang""")
def q_inventory(t: Tables) -> DataFrame:
    ext = F.regexp_extract("url", r"(\.html)", 1)
    f = t.pages.select(
        F.regexp_extract("url", "://[^/?#]*/([a-z]*)/", 1).alias("lang"), F.octet_length("html").cast("long").alias("size"),
        (F.length("url") - F.length(F.replace("url", F.lit("/"), F.lit(""))) - 2).cast("long").alias("depth"), ext.alias("ext"), ext.alias("modality"), (ext != "").alias("readable"),
    )
    return A.inventory(f, ["lang"], "size", "depth", "modality", "ext", "readable")


@query("""WITH o AS (SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT c_custkey, c_mktsegment, CASE WHEN o.o_custkey IS NULL THEN 'none' WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS access_status, CASE WHEN o.o_custkey IS NULL THEN 'none' WHEN o_orderpriority LIKE '1%' THEN 'none' ELSE o_orderpriority END AS access_priority FROM customer LEFT JOIN o ON o_custkey = c_custkey""")
def q_overlay(t: Tables) -> DataFrame:
    last = M.latest(t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    with_priority = F.map_from_arrays(F.array(F.lit("access_status"), F.lit("access_priority")), F.array(status, F.col("o_orderpriority")))
    fields = F.when(F.col("o_orderpriority").startswith("1"), F.map_from_arrays(F.array(F.lit("access_status")), F.array(status))).otherwise(with_priority)
    supplement = last.select(F.col("o_custkey").alias("c_custkey"), fields.alias("fields"))
    base = t.customer.select("c_custkey", "c_mktsegment", F.lit("none").alias("access_status"), F.lit("none").alias("access_priority"))
    return M.overlay(base, supplement, "c_custkey", ("access_", "cmds_"))


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, 'none') AS mode FROM orders""")
def q_backfill(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("mode"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("other"))
    return M.backfill(rows, {"mode": ["other", F.lit("none")]}).select("o_orderkey", "mode")


@query("SELECT source, lang AS name, count(*) AS n FROM documents GROUP BY 1, 2")
def q_explode_classes(t: Tables) -> DataFrame:
    counts = A.count_map(t.documents.select("source", "lang"), ["source"], "lang", "langs")
    return A.explode_counts(counts, ["source"], {"lang": "langs"}).select("source", "name", "n")


@query("""WITH n AS (SELECT p_type, p_brand, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, first) AS rn FROM n)
SELECT p_type, string_agg(p_brand || ' (' || n || ')', '; ' ORDER BY rn) AS top FROM r WHERE rn <= 3 GROUP BY 1""")
def q_topk_map(t: Tables) -> DataFrame:
    return A.top_counts(t.part.select("p_type", "p_brand", "p_partkey"), ["p_type"], "p_brand", "p_partkey")


@query("""WITH x AS (SELECT source, 'lang' AS kind, lang AS name, count(*) AS n FROM documents GROUP BY 1, 3 UNION ALL SELECT source, 'size', CASE WHEN n_chars >= 1000 THEN 'long' ELSE 'short' END, count(*) FROM documents GROUP BY 1, 3)
SELECT kind, name, sum(n)::BIGINT AS images, count(DISTINCT source) AS records FROM x GROUP BY 1, 2""")
def q_formats(t: Tables) -> DataFrame:
    d = t.documents.select("source", "lang", F.when(F.col("n_chars") >= 1000, "long").otherwise("short").alias("size"))
    maps = A.count_map(d, ["source"], "lang", "langs").join(A.count_map(d, ["source"], "size", "sizes"), "source")
    return A.formats(A.explode_counts(maps, ["source"], {"lang": "langs", "size": "sizes"}), "source")


@query("""SELECT 'status' AS field, count(*) FILTER (o_orderkey % 2 = 0) AS n_filled, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) FILTER (o_orderkey % 2 = 0) AS sources FROM orders
UNION ALL SELECT 'price', count(*) FILTER (o_totalprice > 100000), string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus) FILTER (o_totalprice > 100000) FROM orders""")
def q_provenance(t: Tables) -> DataFrame:
    o = t.orders.select(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"), F.when(F.col("o_totalprice") > 100_000, F.col("o_totalprice")).alias("price"), "o_orderpriority", "o_orderstatus")
    return A.provenance(o, "o_orderkey", {"status": "o_orderpriority", "price": "o_orderstatus"})


@query("""WITH s AS (SELECT c_custkey AS id, c_custkey AS pos, lower(CASE WHEN c_custkey % 5 = 0 THEN 'Restricted' ELSE 'open' END) AS a FROM customer), r AS (SELECT o_custkey AS id, min(o_orderkey) AS pos, max(o_orderstatus) AS st FROM orders GROUP BY 1)
SELECT coalesce(s.id, r.id) AS id, s.pos AS scrape_pos, r.pos AS row_pos FROM s FULL JOIN r ON s.id = r.id WHERE a = 'restricted' OR st = 'F'""")
def q_access_targets(t: Tables) -> DataFrame:
    s = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("pos"), F.when(F.col("c_custkey") % 5 == 0, "Restricted").otherwise("open").alias("access"))
    r = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderkey").alias("pos"), F.max("o_orderstatus").alias("status")).withColumn("right", F.lit(None).cast("string"))
    return J.select_targets(s, r, "id", "pos", "access", "status", "right", ("restricted", "embargoed", "closed"), ("F",))


@query("""SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY coalesce(CASE WHEN s_suppkey % 4 > 0 THEN s_acctbal END, -1e18) DESC, s_suppkey) AS rank FROM supplier""")
def q_access_rank(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 4 > 0, F.col("s_acctbal")).alias("p"))
    return C.numbered(rows, ["s_nationkey"], [F.col("p").desc_nulls_last(), F.col("s_suppkey").cast("string").try_cast("bigint"), "s_suppkey"]).select("s_suppkey", "s_nationkey", F.col("rank").cast("long").alias("rank"))


# ---- states ----


@query("""WITH m AS (SELECT max(ts) AS now FROM events), s AS (SELECT count(DISTINCT user_id) AS done, count(*) FILTER (epoch(ts)::BIGINT > epoch(now)::BIGINT - 86400) AS recent FROM events, m)
SELECT done, recent, round(greatest(5000 - done, 0) * 24.0 / recent, 6) AS eta_hours FROM s""")
def q_rate_eta(t: Tables) -> DataFrame:
    out = G.rate_and_eta(t.events, "user_id", "ts", 5000, 24.0)
    return out.withColumn("eta_hours", r6("eta_hours"))


@query("""WITH g AS (SELECT *, coalesce(epoch(ts)::BIGINT - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))::BIGINT >= 21600, true)::INT AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, session::BIGINT AS session, count(*) AS n_events FROM s GROUP BY 1, 2""")
def q_sessions(t: Tables) -> DataFrame:
    return G.sessions(t.events, "user_id", "ts", "event_id", 21600).select("user_id", F.col("session").cast("long").alias("session"), "n_events")


@query("""SELECT user_id, CASE WHEN bool_or(event_type = 'purchase') THEN 'removed' WHEN bool_or(event_type = 'error') THEN 'keep_failed' WHEN bool_or(event_type = 'signup') THEN 'ready' ELSE 'absent' END AS state, count(*) FILTER (event_type = 'click') AS attempts FROM events GROUP BY 1""")
def q_state_machine(t: Tables) -> DataFrame:
    e = t.events.select("user_id", "event_type", "ts")
    return G.fold_states(e, "user_id", "event_type", "ts", [("purchase", "removed"), ("error", "keep_failed"), ("signup", "ready")], "absent").join(G.attempts(e, "user_id", "event_type", "click"), "user_id")


@query("SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def q_turns_latest(t: Tables) -> DataFrame:
    return M.latest(t.conversations.select("conv_id", "turn", "role"), ["conv_id"], ["turn"])


@query("""SELECT 'lang_' || lang AS counter, count(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT 'source_' || source, count(*) FROM documents GROUP BY 1""")
def q_access_summary(t: Tables) -> DataFrame:
    return A.counters(t.documents.select("lang", "source"), {"lang": "lang", "source": "source"})


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, json_extract(props, '$.missing') IS NOT NULL AS has_missing FROM events")
def q_json_props(t: Tables) -> DataFrame:
    v = F.try_parse_json("props")
    return t.events.select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.try_variant_get(v, "$.missing", "string").isNotNull().alias("has_missing"))
