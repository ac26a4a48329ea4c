"""Queries of the operators on records, listings and dataset descriptions, with their SQL. Registered beside those of ``queries``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import documents as D
from ..functions import names as N
from ..operators import dicom as I
from ..operators import probe as P
from ..operators import queue as Q
from ..operators import review as R
from ..operators.strata import CLASSES as T_CLASSES
from . import workbook as W
from .queries import Tables, query, r6


def literals(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def pick(values, key: str, step: int = 1) -> F.Column:
    """One of the values for each row."""
    return F.get(F.array(*map(F.lit, values)), (F.expr(f"{key} div {step}") % len(values)).cast("int"))


def pick_sql(values, key: str, step: int = 1) -> str:
    return f"({literals(values)})[(({key} // {step}) % {len(values)})::INT + 1]"


def half_up(x: str, digits: int) -> str:
    """A number with fixed digits, ties up."""
    return f"(round(({x})::DECIMAL(28, 10), {digits})::DECIMAL(28, {digits})::VARCHAR)"


# ---- review of records ----

_RECORDS_SQL = """r AS (SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment, count(o_orderkey) AS n, list_sort(list(DISTINCT CASE o_orderstatus WHEN 'O' THEN 'OCTA' WHEN 'F' THEN 'PSC' ELSE 'CFP' END) FILTER (o_orderkey IS NOT NULL)) AS present,
  count(*) FILTER (o_orderstatus = 'O')::DOUBLE / nullif(count(o_orderkey), 0) AS eye, count(*) FILTER (o_orderpriority LIKE '1%')::DOUBLE / nullif(count(o_orderkey), 0) AS masks, max(o_orderkey) % 100 / 100.0::DOUBLE AS conf
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)"""


def _records(t: Tables) -> DataFrame:
    cls = F.when(F.col("o_orderstatus") == "O", "OCTA").when(F.col("o_orderstatus") == "F", "PSC").when(F.col("o_orderstatus").isNotNull(), "CFP")
    n = F.count("o_orderkey")
    some = F.when(n > 0, n)
    rows = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.groupBy("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment").agg(
        n.alias("n"), F.array_sort(F.collect_set(cls)).alias("present"), (F.count_if(F.col("o_orderstatus") == "O") / some).alias("eye"),
        (F.count_if(F.col("o_orderpriority").startswith("1")) / some).alias("masks"), (F.max("o_orderkey") % 100 / 100.0).alias("conf"),
    )


@query(f"""WITH {_RECORDS_SQL}, w AS (SELECT *, list_filter([CASE WHEN c_mktsegment = 'BUILDING' THEN 'discovery SetFit label NEGATIVE' END, CASE WHEN eye < 0.5 THEN 'eye image fraction ' || {half_up('eye', 2)} || ' < 0.5' END], lambda x: x IS NOT NULL) AS why FROM r)
SELECT c_custkey, CASE WHEN c_nationkey % 3 < 2 AND len(present) > 0 AND len(list_filter(present, lambda c: c NOT IN ('OCTA', 'PSC'))) = 0 AND len(why) > 0 THEN 'only ' || array_to_string(present, ' + ') || '; ' || array_to_string(why, '; ') ELSE '' END AS review FROM w""")
def q_review_fp(t: Tables) -> DataFrame:
    status = F.get(F.array(F.lit("ok"), F.lit("ok_partial_download"), F.lit("error")), F.col("c_nationkey") % 3)
    label = F.when(F.col("c_mktsegment") == "BUILDING", "negative").otherwise("POSITIVE")
    return _records(t).select("c_custkey", R.likely_false_positive(status, F.col("present"), label, F.col("eye")).alias("review"))


@query(f"""WITH {_RECORDS_SQL}, f AS (SELECT *, CASE WHEN c_nationkey % 4 > 0 THEN (c_acctbal + 1000) / 11000 END AS p, CASE c_mktsegment WHEN 'BUILDING' THEN 'NEGATIVE' WHEN 'MACHINERY' THEN '' ELSE 'EYE' END AS label, CASE WHEN n > 0 THEN present[1] END AS dom FROM r),
g AS (SELECT *, coalesce(p < 0.2, false) OR (p IS NULL AND label = 'NEGATIVE') AS not_eye, coalesce(masks >= 0.3, false) AS mask FROM f)
SELECT c_custkey, CASE WHEN n > 0 THEN concat_ws('; ', CASE WHEN not_eye THEN 'setfit_not_eye (SetFit p(eye) ' || coalesce({half_up('p', 3)}, 'n/a') || ', label ' || CASE WHEN label = '' THEN 'n/a' ELSE label END || ')' END,
  CASE WHEN mask THEN 'mask_like (' || {half_up('masks * 100', 0)} || '% of classified images are masks or label maps)' END, CASE WHEN conf < 0.75 THEN 'low_confidence (' || dom || ' mean top-1 confidence ' || {half_up('conf', 2)} || ')' END) ELSE '' END AS flags,
  n > 0 AND (not_eye OR mask) AS low_trust FROM g""")
def q_review_flags(t: Tables) -> DataFrame:
    p = F.when(F.col("c_nationkey") % 4 > 0, (F.col("c_acctbal") + 1000) / 11000)
    label = F.when(F.col("c_mktsegment") == "BUILDING", "Negative").when(F.col("c_mktsegment") == "MACHINERY", "").otherwise("eye")
    r = _records(t)
    return r.select("c_custkey", R.modality_review(F.col("present"), p, label, F.col("masks"), F.get("present", F.lit(0)), F.col("conf")).alias("x")).select("c_custkey", "x.*")


_IR_SQL = """s AS (SELECT s_suppkey, count(l_orderkey) AS n, count(*) FILTER (l_returnflag = 'R')::DOUBLE / nullif(count(l_orderkey), 0) AS share FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1),
e AS (SELECT *, s_suppkey % 7 = 0 AS gone, s_suppkey % 5 = 0 AS dom, CASE WHEN s_suppkey % 3 = 0 THEN 'Topcon' || CASE WHEN s_suppkey % 2 = 0 THEN ' TRC-NW8' ELSE '' END WHEN s_suppkey % 3 = 1 AND s_suppkey % 4 < 2 THEN 'Heidelberg Engineering' END AS own,
  CASE WHEN s_suppkey % 2 = 0 THEN 'dicom_header' ELSE 'exif' END AS src, CASE WHEN s_suppkey % 4 = 1 THEN 'Spectralis (record-level text)' WHEN s_suppkey % 4 = 2 THEN 'Optos (record-level hint)' END AS rec FROM s),
a AS (SELECT *, NOT gone AND n > 0 AND (dom OR share >= 0.2) AS applies, concat_ws('; ', own || ' (IR images, ' || src || ')', rec) AS text FROM e)"""


@query(f"""WITH {_IR_SQL} SELECT s_suppkey, CASE WHEN NOT applies THEN '' WHEN own IS NULL AND rec IS NULL THEN 'no manufacturer hint found' ELSE text END AS hint,
  applies AND (own IS NOT NULL OR rec IS NOT NULL) AND NOT regexp_matches(coalesce(own, text), '(?i)heidelberg|spectralis') AS candidate FROM a""")
def q_ir_rule(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    n = F.count("l_orderkey")
    s = t.supplier.join(t.lineitem, F.col("l_suppkey") == k, "left").groupBy("s_suppkey").agg(n.alias("n"), (F.count_if(F.col("l_returnflag") == "R") / F.when(n > 0, n)).alias("share"))
    present = F.when(k % 7 == 0, F.expr("cast(array() as array<string>)")).when(k % 2 == 0, F.array(F.lit("IR")))
    maker = F.when(k % 3 == 0, "Topcon").when((k % 3 == 1) & (k % 4 < 2), "Heidelberg Engineering").otherwise("")
    model = F.when((k % 3 == 0) & (k % 2 == 0), "TRC-NW8")
    hint = F.when(k % 4 == 1, "Spectralis").when(k % 4 == 2, "Optos")
    x = R.ir_device(present, F.col("n"), F.col("share"), k % 5 == 0, maker, F.when(k % 2 == 0, "dicom_header").otherwise("exif"), model, hint, F.when(k % 4 == 1, "text"))
    return s.select("s_suppkey", x.alias("x")).select("s_suppkey", "x.*")


@query("""WITH r AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderpriority LIKE '1%') AS a, count(*) FILTER (o_orderpriority LIKE '2%') AS b, count(*) FILTER (o_orderpriority LIKE '3%') AS c FROM orders GROUP BY 1)
SELECT o_custkey, concat_ws(', ', CASE WHEN a >= 1 AND a::DOUBLE / n >= 0.25 THEN 'CFP' END, CASE WHEN b >= 1 AND b::DOUBLE / n >= 0.25 THEN 'IR' END, CASE WHEN c >= 1 AND c::DOUBLE / n >= 0.25 THEN 'OCT' END) AS present FROM r""")
def q_classes_present(t: Tables) -> DataFrame:
    r = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), *[F.count_if(F.col("o_orderpriority").startswith(p)).alias(c) for c, p in (("CFP", "1"), ("IR", "2"), ("OCT", "3"))])
    return r.select("o_custkey", F.array_join(R.classes_present({c: F.col(c) for c in ("CFP", "IR", "OCT")}, F.col("n"), 0.25), ", ").alias("present"))


_SAYINGS = ["acquired with a Zeiss Cirrus scanner", "Spectralis OCT and HRA 2 images", "University of California", "Optos California camera", "UWF images", "Topcon TRC-NW8 and Canon CR-2", "from DRI OCT Triton", "nothing said", "Nidek AFC-330, Kowa", "RTVue by Optovue", "Eidon and Remidio FOP-NM", "VG 200 of SVision"]
_FILES = ["a/x_cirrus.png", "scan.e2e", "b/optomap_1.tif", "vol.fda", "plain.jpg", "p.vol", "c/Casia_3.png", "d/drs.oct", "telesto.raw"]
_BESIDE = "optos|optomap"


def _makers_sql() -> str:
    """The hints of a text and two names."""
    plain = lambda p: p.replace(r"|\.img\b(?=.*cirrus)", "").replace(r"|\bdrs\b(?=.*(fundus|retin))", "")  # noqa: E731  what looks ahead doesn't occur here
    n = lambda e: f"(len(list_filter(names, lambda x: ends_with(lower(x), '{e}'))))"
    parts = [f"CASE WHEN {n(e)} > 0 THEN '{m}||{e} x' || {n(e)} || '|extension' END" for e, m in R.MAKER_OF_ENDING]
    for maker, pattern, models in R.MAKERS:
        tries = []
        for source in ("text", "filename"):
            h = f"h_{source}"
            hit = f"regexp_extract({h}, '{plain(pattern)}')"
            ok = f"{hit} <> ''"
            if maker in R.WEAK_WORDS:
                ok += f" AND (replace({hit}, ' ', '-') NOT IN ({', '.join(repr(w) for w in R.WEAK_WORDS[maker][0])}) OR regexp_matches({h}, '{_BESIDE}'))"
            model = "CASE " + " ".join(f"WHEN contains({h}, '{k}') THEN '{v}'" for k, v in models) + " ELSE '' END" if models else "''"
            tries.append(f"CASE WHEN {ok} THEN '{maker}|' || {model} || '|' || {hit}[1:40] || '|{source}' END")
        own = [f"{n(e)} = 0" for e, m in R.MAKER_OF_ENDING if m == maker] or ["true"]
        parts.append(f"CASE WHEN {' AND '.join(own)} THEN coalesce({', '.join(tries)}) END")
    return "concat_ws('; ', " + ", ".join(parts) + ")"


@query(f"""WITH p AS (SELECT p_partkey, p_name || ' ' || {pick_sql(_SAYINGS, 'p_partkey')} AS text, [{pick_sql(_FILES, 'p_partkey', 12)}, {pick_sql(_FILES, 'p_partkey', 5)}] AS names FROM part), h AS (SELECT *, lower(text) AS h_text, lower(array_to_string(names, ' ')) AS h_filename FROM p)
SELECT p_partkey, {_makers_sql()} AS hints FROM h""")
def q_maker_hints(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", F.concat("p_name", F.lit(" "), pick(_SAYINGS, "p_partkey")).alias("text"), F.array(pick(_FILES, "p_partkey", 12), pick(_FILES, "p_partkey", 5)).alias("names"))
    hints = R.maker_hints(F.col("text"), F.col("names"))
    return p.select("p_partkey", F.array_join(F.transform(hints, lambda h: F.concat_ws("|", h["manufacturer"], h["model"], h["matched"], h["source"])), "; ").alias("hints"))


_LAYERS = ["x/superficial_1.png", "DCP/a.png", "deep learning.png", "y/choroid/b.png", "onh.png", "svp_dcp.png", "plain.png", "accurate.png", "z_cc_1.png"]
_PROSE = ["the superficial capillary plexus", "deep vascular complex of the eye", "CC BY 4.0", "choriocapillaris and choroidal flow", "", "choriocapillaris"]


@query("WITH p AS (SELECT p_partkey, lower(" + pick_sql(_LAYERS, "p_partkey") + ") AS path, lower(p_name || ' ' || " + pick_sql(_PROSE, "p_partkey", 9) + ") AS prose FROM part), h AS (SELECT *, list_filter(["
       + ", ".join(f"CASE WHEN regexp_matches(path, '(?:^|[^a-z])(?:{w})(?:[^a-z]|$)') THEN 'DCM {c} {m}' END" for c, m, w, _ in R.SLABS) + "], lambda x: x IS NOT NULL) AS a, list_filter(["
       + ", ".join(f"CASE WHEN regexp_matches(prose, '{x}') THEN 'DCM {c} {m}' END" for c, m, _, x in R.SLABS) + f"], lambda x: x IS NOT NULL) AS b FROM p) SELECT p_partkey, CASE WHEN len(a) = 1 THEN a[1] WHEN len(a) = 0 AND len(b) = 1 THEN b[1] ELSE '{R.NO_SLAB}' END AS slab FROM h")
def q_octa_slab(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", R.octa_slab(pick(_LAYERS, "p_partkey"), F.concat("p_name", F.lit(" "), pick(_PROSE, "p_partkey", 9))).alias("slab"))


# ---- queue and keeping ----


@query("""WITH m AS (SELECT l_orderkey, (l_extendedprice * 1000)::BIGINT AS transfer, ((l_quantity - 1) * 200000000)::BIGINT AS inflated FROM lineitem), o AS (SELECT *, transfer > 60000000 OR inflated > 4294967296 AS over FROM m)
SELECT l_orderkey, count(*) FILTER (over) AS n_over, count(*) FILTER (inflated <= 0) AS n_empty, count(*) FILTER (NOT over AND inflated > 0) AS n_in_frame FROM o GROUP BY 1""")
def q_frame_counts(t: Tables) -> DataFrame:
    m = t.lineitem.select("l_orderkey", (F.col("l_extendedprice") * 1000).cast("decimal(20,0)").cast("long").alias("transfer"), ((F.col("l_quantity") - 1) * 200_000_000).cast("long").alias("inflated"))
    return Q.frame_counts(m, ["l_orderkey"], "transfer", "inflated", 60_000_000)


_COST_SQL = "c AS (SELECT l_orderkey AS o_orderkey, least(100000, coalesce(sum(l_quantity * 1000) FILTER (l_returnflag = 'R'), 0)) + 50000000 * count(*) FILTER (l_returnflag = 'A') AS cost FROM lineitem GROUP BY 1)"


def _costs(t: Tables) -> DataFrame:
    files = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_quantity") * 1000).alias("size"), F.when(F.col("l_returnflag") == "R", "fetch").when(F.col("l_returnflag") == "A", "remote_zip").otherwise("skip").alias("route"))
    return Q.costs(files, ["o_orderkey"], "size", "route", 100_000)


@query(f"WITH {_COST_SQL} SELECT o_orderkey, cost::DOUBLE AS cost FROM c")
def q_fetch_cost(t: Tables) -> DataFrame:
    return _costs(t)


@query(f"""WITH {_COST_SQL}, f AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority LIKE '1%'),
t AS (SELECT o.o_orderkey, coalesce(cost, 0)::DOUBLE AS cost, rank FROM orders o LEFT JOIN c USING (o_orderkey) LEFT JOIN f USING (o_orderkey) WHERE o_orderstatus <> 'F')
SELECT o_orderkey, cost, rank AS refetch_rank FROM t ORDER BY rank NULLS LAST, CASE WHEN rank IS NULL THEN cost END, o_orderkey LIMIT 200""")
def q_work_order(t: Tables) -> DataFrame:
    """The head of the queue: the limit is the feature."""
    first = t.orders.where((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").startswith("1")).select("o_orderkey", F.expr("row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey)").alias("rank"))
    todo = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey")
    return Q.head(Q.work_order(todo, _costs(t), first, "o_orderkey", "o_orderkey"), 200).select("o_orderkey", "cost", F.col("refetch_rank").cast("long").alias("refetch_rank"))


@query("""WITH p AS (SELECT user_id, ts, event_id, event_type FROM events WHERE event_type IN ('click', 'view') QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1)
SELECT user_id, event_id, event_type, coalesce(c_mktsegment, 'stub') AS segment FROM p LEFT JOIN customer ON c_custkey = user_id WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 90)""")
def q_requests(t: Tables) -> DataFrame:
    pending = t.events.where(F.col("event_type").isin("click", "view")).select("user_id", "ts", "event_id", "event_type")
    served = t.events.where((F.col("event_type") == "error") & (F.col("value") > 90)).select("user_id")
    scope = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return Q.requests(pending, scope, served, "user_id", "ts", {"segment": F.lit("stub")}).select("user_id", "event_id", "event_type", "segment")


@query("""SELECT l_orderkey, l_linenumber, EXISTS (SELECT 1 FROM lineitem f WHERE f.l_orderkey = s.l_orderkey AND f.l_linenumber = s.l_linenumber AND f.l_returnflag <> 'N' AND f.l_quantity > 10) AS reused FROM lineitem s WHERE l_quantity > 5""")
def q_not_fetched(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return Q.not_fetched(t.lineitem.where("l_quantity > 5").select(*keys), t.lineitem.where("l_returnflag <> 'N' and l_quantity > 10").select(*keys), keys)


@query("""WITH m AS (SELECT user_id, min(ts) AS marked FROM events WHERE event_type = 'signup' GROUP BY 1), d AS (SELECT user_id, max(ts) AS done FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT user_id FROM m JOIN d USING (user_id) WHERE epoch(date_trunc('second', done)) >= epoch(date_trunc('second', marked)) - 1""")
def q_done_since(t: Tables) -> DataFrame:
    markers = t.events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("marked"))
    return Q.done_since(t.events.where("event_type = 'purchase'").select("user_id", "ts"), markers, "user_id", "ts", "marked").select("user_id")


_KEEP_SQL = """r AS (SELECT o_custkey, o_orderkey, o_orderkey % 5 AS n_eye, o_orderstatus = 'P' AS skip, round(o_totalprice)::BIGINT AS need, CASE WHEN o_orderpriority LIKE '5%' THEN 100000 ELSE 10000000 END AS free FROM orders),
c AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM r WHERE n_eye > 0 AND NOT skip AND need <= free),
f(o_custkey, o_orderkey, i, total, fits) AS (SELECT o_custkey, o_orderkey, i, CASE WHEN need <= 500000 THEN need ELSE 0 END, need <= 500000 FROM c WHERE i = 1
  UNION ALL SELECT c.o_custkey, c.o_orderkey, c.i, CASE WHEN f.total + need <= 500000 THEN f.total + need ELSE f.total END, f.total + need <= 500000 FROM f JOIN c ON c.o_custkey = f.o_custkey AND c.i = f.i + 1)"""


@query(f"""WITH RECURSIVE {_KEEP_SQL} SELECT r.o_orderkey, CASE WHEN n_eye <= 0 THEN 'no eye image' WHEN skip THEN 'skipped' WHEN need > free THEN 'disk' WHEN NOT coalesce(fits, false) THEN 'cap' ELSE '' END AS reason,
  n_eye > 0 AND NOT skip AND need <= free AND coalesce(fits, false) AS kept FROM r LEFT JOIN f ON f.o_orderkey = r.o_orderkey AND f.o_custkey = r.o_custkey""")
def q_keep_decisions(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 5).alias("n_eye"), F.round("o_totalprice").cast("long").alias("need"), F.when(F.col("o_orderpriority").startswith("5"), 100_000).otherwise(10_000_000).alias("free"), "o_orderstatus")
    return Q.keep_decisions(rows, ["o_custkey"], ["o_orderkey"], "n_eye", F.col("o_orderstatus") == "P", "need", F.col("free"), 500_000).select("o_orderkey", "reason", "kept")


_LAST_SQL = """l AS (SELECT o_orderkey AS id, o_orderstatus <> 'P' AS final, o_orderpriority LIKE '5%' AS has_kept, o_custkey % 3 AS n_eye, o_custkey % 2 AS n_classified, o_orderkey % 11 = 0 AS nothing FROM orders),
p AS (SELECT l_orderkey AS id, count(*) FILTER (l_returnflag = 'R') AS n_pred FROM lineitem GROUP BY 1),
x AS (SELECT o_orderkey AS id, max(o_custkey % 4) AS n_eye, max(round(o_totalprice / 1000)::BIGINT) AS bytes FROM orders WHERE o_orderpriority LIKE '5%' AND o_totalprice > 250000 GROUP BY 1 HAVING max(o_custkey % 4) > 0),
b AS (SELECT l.id FROM l LEFT JOIN p USING (id) WHERE final AND NOT has_kept AND NOT nothing AND (n_eye > 0 OR (n_classified > 0 AND coalesce(n_pred, 0) > 0))),
u AS (SELECT coalesce(b.id, x.id) AS id, coalesce(n_eye, 0)::BIGINT AS n_eye, coalesce(bytes, 0)::BIGINT AS bytes, b.id IS NOT NULL AS before FROM b FULL JOIN x ON x.id = b.id WHERE coalesce(b.id, x.id) % 13 <> 0)"""


def _backfill(t: Tables, budget: float | None) -> DataFrame:
    k = F.col("o_orderkey").alias("id")
    last = t.orders.select(k, (F.col("o_orderstatus") != "P").alias("final"), F.col("o_orderpriority").startswith("5").alias("has_kept"), (F.col("o_custkey") % 3).alias("n_eye"), (F.col("o_custkey") % 2).alias("n_classified"), (F.col("o_orderkey") % 11 == 0).alias("nothing_fetched"))
    label = F.when(F.col("l_returnflag") == "R", "OCT").otherwise("NEG")
    predictions = Q.predicted_eye_images(t.lineitem.select(F.col("l_orderkey").alias("id"), label.alias("label")), "id", "label")
    refused = t.orders.where(F.col("o_orderpriority").startswith("5") & (F.col("o_totalprice") > 250_000)).select(k, (F.col("o_custkey") % 4).alias("n_eye"), F.round(F.col("o_totalprice") / 1000).cast("long").alias("bytes"))
    return Q.backfill(last, predictions, refused, t.orders.where("o_orderkey % 13 = 0").select(k), "id", budget)


@query(f"WITH {_LAST_SQL} SELECT id, n_eye, bytes, before FROM u")
def q_backfill_ids(t: Tables) -> DataFrame:
    return _backfill(t, None).select("id", "n_eye", "bytes", "before")


@query(f"""WITH RECURSIVE {_LAST_SQL}, c AS (SELECT *, row_number() OVER (ORDER BY (NOT before)::INT, n_eye DESC, bytes, length(id::VARCHAR), id) AS i FROM u WHERE bytes > 0),
f(id, i, total, fits) AS (SELECT id, i, CASE WHEN bytes <= 20000 THEN bytes ELSE 0 END, bytes <= 20000 FROM c WHERE i = 1 UNION ALL SELECT c.id, c.i, CASE WHEN f.total + bytes <= 20000 THEN f.total + bytes ELSE f.total END, f.total + bytes <= 20000 FROM f JOIN c ON c.i = f.i + 1)
SELECT u.id, u.bytes = 0 OR coalesce(fits, false) AS chosen FROM u LEFT JOIN f ON f.id = u.id""")
def q_backfill_budget(t: Tables) -> DataFrame:
    return _backfill(t, 20_000).select("id", "chosen")


@query("""SELECT s_suppkey, row_number() OVER (ORDER BY coalesce(CASE WHEN s_suppkey % 4 > 0 THEN s_acctbal END, -1e18) DESC, s_suppkey) AS rank FROM supplier WHERE s_suppkey % 3 > 0 AND s_nationkey % 4 > 0""")
def q_access_requests(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 4 > 0, F.col("s_acctbal")).alias("p"))
    return Q.access_requests(rows, "s_suppkey", F.col("s_suppkey") % 3 > 0, F.col("s_nationkey") % 4 == 0, "p").select("s_suppkey", F.col("rank").cast("long").alias("rank"))


@query("""SELECT o_orderkey, o_orderstatus = 'F' AND regexp_matches(CASE o_custkey % 4 WHEN 0 THEN '--keep-max-gb 5' WHEN 1 THEN 'disk: full' WHEN 2 THEN 'no eye image' END, '^(--keep-max-gb|disk:)') IS TRUE AS refused,
  o_orderkey % 600 IN (429, 500, 502, 503, 504) AS retryable, (o_custkey % 9 + o_orderkey % 4)::BIGINT AS n_eye FROM orders""")
def q_keep_flags(t: Tables) -> DataFrame:
    reason = F.get(F.array(F.lit("--keep-max-gb 5"), F.lit("disk: full"), F.lit("no eye image"), F.lit(None)), (F.col("o_custkey") % 4).cast("int"))
    counts = {"CFP": (F.col("o_custkey") % 9).cast("string"), "OCT": (F.col("o_orderkey") % 4).cast("string"), "IR": F.lit("n/a"), "NEG": F.lit("100")}
    return t.orders.select("o_orderkey", Q.refused_for_room(F.col("o_orderstatus") != "F", reason).alias("refused"), Q.retryable((F.col("o_orderkey") % 600).cast("int")).alias("retryable"), Q.eye_images(counts).alias("n_eye"))


# ---- listings and estimates ----

#: Names with every known ending, parts of split archives and junk among them.
_ENDINGS = [*N._KNOWN, ".z01", ".z02", ".part1.rar", ".part2.rar", ".7z.001", ".zip.002", ".partaa", ".partab", ".tif.gz", ".csv.gz", ".xyz", ""]
_STEMS = ["", "scan", "__MACOSX/._", "README", "d/.DS_Store", "License"]
_MEMBER_SQL = f"n AS (SELECT p_partkey, p_brand, p_size, {pick_sql(_STEMS, 'p_partkey', 7)} || CASE WHEN {pick_sql(_STEMS, 'p_partkey', 7)} IN ('', 'scan') THEN replace(p_name, ' ', '_') ELSE '' END || {pick_sql(_ENDINGS, 'p_partkey')} AS name FROM part)"


def _members(t: Tables) -> DataFrame:
    stem = pick(_STEMS, "p_partkey", 7)
    own = F.when(stem.isin("", "scan"), F.replace("p_name", F.lit(" "), F.lit("_"))).otherwise("")
    return t.part.select("p_partkey", "p_brand", "p_size", F.concat(stem, own, pick(_ENDINGS, "p_partkey")).alias("name"))


def _names_sql() -> str:
    from .queries import _EXT_SQL, _FIRST_SQL, _FRAG_SQL, _KIND_SQL

    base = lambda s: s.replace("lower(name)", "lower(regexp_extract(name, '([^/]*)$', 1))")
    inner = base(_EXT_SQL).replace("name, '([^/]*)$'", "inside, '([^/]*)$'")
    images = ", ".join(repr(k) for k in N.IMAGE_KINDS)
    kind = lambda ext, frag, first: _KIND_SQL.replace("frag THEN", f"{frag} THEN").replace("ext ", f"{ext} ").replace("OR first THEN", f"OR {first} THEN")
    frag2, first2 = _FRAG_SQL.replace("lower(name)", "lower(inside)"), _FIRST_SQL.replace("lower(name)", "lower(inside)")
    return f"""{_MEMBER_SQL}, e AS (SELECT *, {base(_EXT_SQL)} AS ext, {_FRAG_SQL} AS frag, {_FIRST_SQL} AS first FROM n),
k AS (SELECT *, {_KIND_SQL} AS kind, name[1:length(name) - length(ext)] AS inside FROM e), k2 AS (SELECT *, {inner} AS ext2, {frag2} AS frag2, {first2} AS first2 FROM k),
k3 AS (SELECT *, {kind('ext2', 'frag2', 'first2')} AS kind2, starts_with(name, '__MACOSX/') OR contains(name, '/__MACOSX/') OR starts_with(regexp_extract(name, '([^/]*)$', 1), '._') OR regexp_extract(name, '([^/]*)$', 1) = '.DS_Store' AS junk FROM k2),
m AS (SELECT *, kind = 'archive' OR (kind = 'compressed' AND kind2 IN ({images}, 'archive', 'noext')) AS worth FROM k3),
s AS (SELECT *, CASE WHEN junk THEN '' WHEN kind IN ({images}) THEN 'image' WHEN kind = 'fragment' OR (kind IN ('archive', 'compressed') AND worth) THEN 'nested'
  WHEN kind = 'noext' AND lower(regexp_extract(name, '([^/]*)$', 1)) NOT IN ({', '.join(repr(x) for x in P.TEXT_NAMES)}) AND p_size >= 8 AND p_size < 67108864 THEN 'noext' ELSE '' END AS signal,
  CASE WHEN first OR frag THEN 'split' WHEN kind = 'archive' THEN CASE {' '.join(f"WHEN ext = '{e}' THEN '{f}'" for e, f in P.FAMILIES.items())} ELSE 'other' END WHEN kind = 'compressed' THEN 'single' ELSE '' END AS family,
  CASE WHEN regexp_matches(lower(name), '\\.(7z|zip)\\.001$') THEN regexp_extract(lower(name), '(\\.(?:7z|zip)\\.001)$', 1) WHEN regexp_matches(ext, '{P.PLAIN_SUFFIX}') THEN ext ELSE '' END AS suffix FROM m)"""


@query("WITH " + _names_sql() + " SELECT p_partkey, name, ext, kind, family, signal, suffix, worth FROM s")
def q_probe_names(t: Tables) -> DataFrame:
    n = F.col("name")
    return _members(t).select("p_partkey", "name", N.extension(n).alias("ext"), N.file_kind(n).alias("kind"), P.probe_family(n).alias("family"), P.member_signal(n, F.col("p_size"), F.lit(True)).alias("signal"), P.scratch_suffix(n).alias("suffix"), N.nested_worth(n).alias("worth"))


@query("WITH " + _names_sql() + """ SELECT p_brand, count(*) AS n_members, count(*) FILTER (signal = 'image') AS n_images, count(*) FILTER (signal = 'nested') AS n_nested, count(*) FILTER (signal = 'noext') AS n_noext, arg_min(name, p_partkey) FILTER (signal <> '') AS hit FROM s GROUP BY 1""")
def q_probe_listing(t: Tables) -> DataFrame:
    return P.listing(_members(t), ["p_brand"], "name", "p_size", "p_partkey", F.lit(True))


@query("""WITH f AS (SELECT p_brand, 'v' || (p_partkey // 6) || (['.hdr', '.dat', '.IMG', '.mhd', '.zraw', '.png'])[(p_partkey % 6)::INT + 1] AS name FROM part),
o(data, rank, ext) AS (VALUES ('.img', 0, '.hdr'), ('.cfl', 0, '.hdr'), ('.dat', 0, '.hdr'), ('.raw', 0, '.hdr'), ('.raw', 1, '.mhd'), ('.zraw', 1, '.mhd'), ('.img', 1, '.mhd'), ('.raw', 2, '.nhdr'), ('.zraw', 2, '.nhdr'), ('.img', 2, '.nhdr')),
d AS (SELECT p_brand, name AS data, regexp_extract(lower(name), '^(.*)\\.[a-z]+$', 1) AS stem, regexp_extract(lower(name), '(\\.[a-z]+)$', 1) AS e FROM f)
SELECT d.p_brand, d.data, arg_min(f.name, rank) AS header FROM d JOIN o ON o.data = d.e JOIN f ON f.p_brand = d.p_brand AND lower(f.name) = d.stem || o.ext GROUP BY 1, 2""")
def q_header_of(t: Tables) -> DataFrame:
    exts = [".hdr", ".dat", ".IMG", ".mhd", ".zraw", ".png"]
    f = t.part.select("p_brand", F.concat(F.lit("v"), F.expr("p_partkey div 6").cast("string"), pick(exts, "p_partkey")).alias("name"))
    return P.headers_of(f, ["p_brand"], "name")


_PARTS = [".zip", ".z01", ".ZIP", ".zip", ".tar", ".part1.rar", ".part2.rar"]
_PARTS_SQL = f"f AS (SELECT p_partkey, p_brand, p_size, 'set' || (p_partkey // 5 % 40) || {pick_sql(_PARTS, 'p_partkey')} AS name FROM part)"


def _parts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_brand", "p_size", F.concat(F.lit("set"), (F.expr("p_partkey div 5") % 40).cast("string"), pick(_PARTS, "p_partkey")).alias("name"))


@query(f"WITH {_PARTS_SQL} SELECT p_partkey, name FROM f WHERE lower(name) LIKE '%.zip' AND NOT EXISTS (SELECT 1 FROM f g WHERE g.p_brand = f.p_brand AND g.name = lower(f.name)[1:length(f.name) - 4] || '.z01')")
def q_remote_zips(t: Tables) -> DataFrame:
    return P.remote_zips(_parts(t), ["p_brand"], "name").select("p_partkey", "name")


@query(f"""WITH {_PARTS_SQL}, k AS (SELECT *, p_size % 2 = 0 AS streamed, CASE WHEN regexp_matches(lower(name), '\\.(z01|zip)$') THEN '0:' || regexp_extract(lower(name), '^(.+)\\.(z01|zip)$', 1) WHEN regexp_matches(lower(name), '\\.part[0-9]+\\.rar$') THEN '1:' || regexp_extract(lower(name), '^(.+)\\.part[0-9]+\\.rar$', 1) END AS set_key FROM f),
s AS (SELECT p_brand, set_key, count(*) AS n, count(*) FILTER (streamed) AS st FROM k WHERE set_key IS NOT NULL GROUP BY 1, 2)
SELECT p_partkey, k.set_key, coalesce(n > 1 AND st > 0 AND st < n AND NOT streamed, false) AS link FROM k LEFT JOIN s ON s.p_brand = k.p_brand AND s.set_key = k.set_key""")
def q_colocate(t: Tables) -> DataFrame:
    return P.colocated(_parts(t).withColumn("streamed", F.col("p_size") % 2 == 0), ["p_brand"], "name", "streamed").select("p_partkey", "set_key", "link")


@query("""WITH r AS (SELECT l_orderkey, count(*) AS listed, count(*) FILTER (l_returnflag = 'N') AS noext, count(*) FILTER (l_returnflag = 'A') AS added, count(*) FILTER (l_quantity > 25) AS direct, count(*) FILTER (l_quantity > 49) AS over, count(*) FILTER (l_quantity < 3) AS empty, count(*) FILTER (l_linestatus = 'F') AS fetched, sum(l_linenumber) AS images FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN added ELSE listed END AS seen, round(CASE WHEN l_orderkey % 2 = 0 THEN CASE WHEN direct > 0 THEN greatest(0, noext - over - empty) * added / direct ELSE 0 END ELSE greatest(0, listed - over - empty) END, 6)::DOUBLE AS direct, round(CASE WHEN fetched > 0 THEN images * listed / fetched ELSE 0 END, 6)::DOUBLE AS nested FROM r""")
def q_population(t: Tables) -> DataFrame:
    has = lambda c, v: F.count_if(F.col(c) == v)
    q = F.col("l_quantity")
    r = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("listed"), has("l_returnflag", "N").alias("noext"), has("l_returnflag", "A").alias("added"), F.count_if(q > 25).alias("direct"), F.count_if(q > 49).alias("over"), F.count_if(q < 3).alias("empty"), has("l_linestatus", "F").alias("fetched"), F.sum("l_linenumber").alias("images"))
    c = {x: F.col(x) for x in r.columns}
    x = P.population(c["listed"], c["l_orderkey"] % 2 == 0, c["noext"], c["added"], c["direct"], c["over"], c["empty"], c["images"], c["listed"], c["fetched"])
    return r.select("l_orderkey", x.alias("x")).select("l_orderkey", "x.seen", r6("x.direct").alias("direct"), r6("x.nested").alias("nested"))


@query("""WITH m AS (SELECT source, lang, CASE WHEN toxic = 1 THEN 'MASK' WHEN quality = 1 THEN 'CFP' ELSE 'NEG' END AS cls FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT source, lang, count(*) AS n, count(*) FILTER (cls <> 'MASK') AS nm, count(*) FILTER (cls = 'CFP') AS eye FROM m GROUP BY 1, 2)
SELECT source, lang, n AS n_triage, round(eye::DOUBLE / nullif(nm, 0), 6) AS eye_share, CASE WHEN nm = 0 OR eye::DOUBLE / nm < 0.9 THEN 'triage' WHEN n > 3 THEN 'deep' ELSE 'complete' END AS decision,
  CASE WHEN nm = 0 THEN 'no non-mask image in the triage sample' WHEN eye::DOUBLE / nm < 0.9 THEN 'below' ELSE 'reached' END AS reason FROM s""")
def q_triage_decision(t: Tables) -> DataFrame:
    cls = F.when(F.col("toxic") == 1, "MASK").when(F.col("quality") == 1, "CFP").otherwise("NEG")
    rows = t.documents.select("doc_id", "source", "lang").join(t.labels, "doc_id").select("source", "lang", cls.alias("cls"))
    return P.triage_decision(rows, ["source", "lang"], "cls", 0.9, F.count("*") > 3).withColumn("eye_share", r6("eye_share"))


@query("""WITH m AS (SELECT user_id, regexp_replace(event_type || ' ' || props, '[0-9]+', '#', 'g')[1:80] AS m FROM events), n AS (SELECT user_id, m, count(*) AS n FROM m GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, m) AS rn FROM n)
SELECT user_id, string_agg(m || '=' || n, '; ' ORDER BY n DESC, m) AS counts FROM r WHERE rn <= 3 GROUP BY 1""")
def q_message_counts(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.concat("event_type", F.lit(" "), "props").alias("message"))
    return P.counted(rows, ["user_id"], "message", 3, "#").select("user_id", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "; ").alias("counts"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'metadata_unavailable' WHEN o_orderkey % 6 = 0 THEN CASE WHEN o_orderstatus = 'F' THEN 'restricted' ELSE 'no_files' END WHEN o_custkey % 3 > 0 AND o_custkey % 5 = 0 AND o_orderkey % 2 = 0 AND o_orderpriority NOT LIKE '1%' THEN 'skipped_size'
  WHEN (o_custkey % 3 > 0 OR o_orderpriority LIKE '1%') AND o_totalprice > 300000 THEN 'skipped_disk' END AS status FROM orders""")
def q_fetch_status(t: Tables) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    access = F.when(F.col("o_orderstatus") == "F", "closed").when(F.col("o_orderstatus") == "O", "open")
    status = P.fetch_status(k % 6, access, k % 17 != 0, c % 3, c % 5, k % 2, F.when(F.col("o_orderpriority").startswith("1"), 1).otherwise(0), F.col("o_totalprice") <= 300_000)
    return t.orders.select("o_orderkey", status.alias("status"))


@query("""WITH i AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 10 = 0 THEN '../' WHEN l_suppkey % 10 = 1 THEN '/' ELSE '' END || 'f' || l_linenumber AS path, CASE WHEN l_suppkey % 4 > 0 THEN l_quantity::BIGINT END AS size FROM lineitem),
g AS (SELECT l_orderkey, 'f' || l_linenumber AS path, (l_quantity - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS found FROM lineitem WHERE l_returnflag <> 'A')
SELECT * FROM (SELECT i.l_orderkey, i.path, CASE WHEN i.path LIKE '/%' OR i.path LIKE '../%' THEN 'outside' WHEN g.path IS NULL THEN 'missing' WHEN size <> found THEN 'size changed: ' || found || ' != ' || size END AS problem FROM i LEFT JOIN g ON g.l_orderkey = i.l_orderkey AND g.path = i.path) WHERE problem IS NOT NULL""")
def q_spool_problems(t: Tables) -> DataFrame:
    s = F.col("l_suppkey") % 10
    path = F.concat(F.when(s == 0, "../").when(s == 1, "/").otherwise(""), F.lit("f"), F.col("l_linenumber").cast("string"))
    items = t.lineitem.select("l_orderkey", path.alias("path"), F.when(F.col("l_suppkey") % 4 > 0, F.col("l_quantity").cast("long")).alias("size"))
    found = t.lineitem.where("l_returnflag <> 'A'").select("l_orderkey", F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias("path"), (F.col("l_quantity") - F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("long").alias("found_size"))
    return P.spool_problems(items, found, ["l_orderkey"], "path", "size")


@query("SELECT source, lang, count(*)::BIGINT * 2 AS n FROM documents GROUP BY 1, 2 UNION ALL SELECT 'src_all', lang, count(*) FROM documents GROUP BY 2")
def q_sum_counts(t: Tables) -> DataFrame:
    one = t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"))
    return P.sum_counts([one, one, t.documents.groupBy(F.lit("src_all").alias("source"), "lang").agg(F.count("*").alias("n"))], ["source", "lang"], "n")


# ---- dataset descriptions ----


@query("""WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN ' ' WHEN c_custkey % 3 = 0 THEN c_name || ', X' ELSE ' ' || c_name END AS name, CASE WHEN c_custkey % 4 = 0 THEN '0000-' || c_custkey WHEN c_custkey % 4 = 1 THEN 'https://orcid.org/' || c_custkey WHEN c_custkey % 4 = 2 THEN '' END AS v, CASE c_custkey % 3 WHEN 0 THEN 'orcid' WHEN 1 THEN 'ISNI' ELSE 'ORCID' END AS s, n_name, n_nationkey FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey, trim(name) AS who, CASE WHEN contains(name, ',') OR c_custkey % 7 = 0 THEN 'Personal' ELSE 'Organizational' END AS kind, CASE WHEN v <> '' THEN CASE WHEN lower(s) = 'orcid' AND NOT starts_with(v, 'http') THEN 'https://orcid.org/' || v ELSE v END || ' ' || upper(s) ELSE '' END AS ids,
  n_name AS home, CASE WHEN n_nationkey % 2 = 0 THEN 'ROR' WHEN n_nationkey % 3 = 0 THEN 'GRID' ELSE 'Other' END AS scheme FROM p WHERE trim(name) <> ''""")
def q_people(t: Tables) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    name = F.when(k % 10 == 0, F.lit(" ")).when(k % 3 == 0, F.concat("c_name", F.lit(", X"))).otherwise(F.concat(F.lit(" "), "c_name"))
    v = F.when(k % 4 == 0, F.concat(F.lit("0000-"), k.cast("string"))).when(k % 4 == 1, F.concat(F.lit("https://orcid.org/"), k.cast("string"))).when(k % 4 == 2, "")
    ids = F.array(F.struct(v.alias("value"), pick(["orcid", "ISNI", "ORCID"], "c_custkey").alias("scheme")))
    org = F.when(n % 2 == 0, "https://ror.org/1").when(n % 3 == 0, "grid.5").otherwise("x1")
    homes = F.array(F.struct(F.col("n_name").alias("name"), org.alias("id"), F.when(n % 2 == 0, "ror").alias("scheme")), F.struct(F.lit("").alias("name"), org.alias("id"), F.lit("").alias("scheme")))
    p = rows.select("c_custkey", D.person(name, F.lit(None).cast("string"), F.when(k % 7 == 0, "G"), ids, homes).alias("p")).where("p is not null")
    said = F.array_join(F.transform("p.identifiers", lambda i: F.concat(i["value"], F.lit(" "), i["scheme"])), "; ")
    home = F.col("p.affiliations")[0]
    return p.select("c_custkey", F.col("p.name").alias("who"), F.col("p.name_type").alias("kind"), said.alias("ids"), D.managing_organisation(F.array("p"), "Zenodo").alias("home"), home["scheme"]["scheme"].alias("scheme"))


@query("""WITH s AS (SELECT p_brand, p_partkey AS pos, trim(p_type) AS v, p_size % 2 = 0 AS has, 'http://id/mesh/D' || p_size || '#' AS uri, CASE WHEN p_partkey % 2 = 0 THEN upper(p_type) ELSE p_type END AS shown FROM part),
f AS (SELECT p_brand, lower(v) AS k, arg_min(shown || CASE WHEN has THEN ' MeSH D' || replace(split_part(uri, 'D', 2), '#', '') ELSE '' END, (NOT has)::BIGINT * 1000000000 + pos) AS item, min(pos) AS pos FROM s GROUP BY 1, 2)
SELECT p_brand, string_agg(item, '; ' ORDER BY pos) AS subjects FROM f GROUP BY 1""")
def q_subjects(t: Tables) -> DataFrame:
    v = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_type")).otherwise(F.col("p_type"))
    none = F.lit(None).cast("string")
    s = D.subject(F.concat(v, F.lit(" ")), F.when(F.col("p_size") % 2 == 0, "MeSH"), none, F.lit(""), F.concat(F.lit("http://id/mesh/D"), F.col("p_size").cast("string"), F.lit("#")))
    m = D.merge_subjects(t.part.select("p_brand", "p_partkey", s.alias("s")), ["p_brand"], "s", "p_partkey")
    said = F.array_join(F.transform("subjects", lambda x: F.concat_ws(" ", x["value"], x["scheme"], x["code"])), "; ")
    return m.select("p_brand", said.alias("subjects"))


_RIGHTS = ["cc-by-4.0", " MIT ", "cc-zero", "gpl-3.0", "my own", "CC-BY-NC-SA-3.0", "odbl"]
_RIGHTS_IDS = ["CC-BY-4.0", "MIT", "CC0-1.0", "GPL-3.0-only", "my own", "CC-BY-NC-SA-3.0", "ODbL-1.0"]


@query("WITH i(raw, id) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in zip(_RIGHTS, _RIGHTS_IDS, strict=True)) + f"""), c AS (SELECT c_custkey, {pick_sql(_RIGHTS, 'c_custkey')} AS raw, CASE WHEN c_nationkey % 3 = 0 THEN 'Figshare' ELSE 'Zenodo' END AS repo FROM customer)
SELECT c_custkey, id, CASE WHEN id <> 'my own' THEN 'SPDX' WHEN repo = 'Zenodo' THEN 'Zenodo license id' ELSE repo || ' license name' END AS scheme, repo, CASE WHEN repo = 'Zenodo' THEN 'Zenodo record zenodo_datacite' ELSE 'Figshare record figshare_datacite' END AS text FROM c JOIN i USING (raw)""")
def q_rights(t: Tables) -> DataFrame:
    repo = D.repository(F.when(F.col("c_nationkey") % 3 == 0, F.concat(F.lit("figshare-"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string")), F.lit("zenodo"))
    return t.customer.select("c_custkey", D.rights_in(pick(_RIGHTS, "c_custkey"), repo).alias("r"), repo.alias("repo"), D.retarget(F.lit("Zenodo record zenodo_datacite"), repo).alias("text")).select("c_custkey", "r.*", "repo", "text")


_NOTE_SQL = """CASE WHEN public THEN 'files are public now; no request needed' ELSE concat_ws('; ', CASE WHEN embargo THEN 'embargoed until ' || coalesce(until, 'a date not given') END,
  CASE WHEN users THEN 'the owner accepts access requests from logged-in Zenodo users (Request access on the landing page)' WHEN NOT users THEN 'the owner does not accept access requests through Zenodo; contact the depositor' ELSE 'Zenodo does not expose whether the owner accepts requests; try Request access on the landing page or contact the depositor' END,
  CASE WHEN guests THEN 'guest (no account) requests are accepted too' END, CASE WHEN o_orderkey % 11 = 0 THEN 'the owner sets conditions (see access_accept_conditions_text)' END) END"""


@query(f"""WITH a AS (SELECT o_orderkey, o_orderkey % 7 = 0 AS public, o_orderstatus = 'F' AS embargo, CASE WHEN o_custkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS until, CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS users, o_custkey % 5 = 0 AS guests FROM orders), n AS (SELECT *, {_NOTE_SQL} AS note FROM a)
SELECT o_orderkey, note, CASE WHEN embargo THEN 'Embargoed' ELSE 'Restricted' END || ' by the depositor on Zenodo' || CASE WHEN embargo AND until IS NOT NULL THEN ' until ' || until ELSE '' END || ' (record restricted, files unknown). ' || upper(note[1]) || note[2:] || '. Landing page: https://z/' || o_orderkey AS sentence,
  CASE WHEN embargo AND until IS NOT NULL THEN 'Embargoed by the depositor until ' || until || ' (access_right: embargoed)' WHEN embargo THEN 'Embargoed by the depositor (access_right: embargoed)' WHEN users THEN 'public release as image files' WHEN NOT users THEN 'access_right: open; no image files read' ELSE 'access_right: unknown; files not publicly released, no image files read' END AS level FROM n""")
def q_access_texts(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    a = t.orders.select(
        "o_orderkey", (k % 7 == 0).alias("public"), (F.col("o_orderstatus") == "F").alias("embargo"), F.when(F.col("o_custkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("until"),
        F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("users"), (F.col("o_custkey") % 5 == 0).alias("guests"), F.when(k % 11 == 0, "x").otherwise("").alias("conditions"),
    )
    c = {x: F.col(x) for x in a.columns}
    a = a.withColumn("note", D.request_note(c["public"], c["embargo"], c["until"], c["users"], c["guests"], c["conditions"]))
    access = F.when(c["embargo"], "embargoed").when(c["users"].isNotNull(), "open").otherwise("")
    level = D.de_identification(access, F.coalesce(c["users"], F.lit(False)), c["until"])
    sentence = D.access_sentence(c["embargo"], c["until"], F.lit("restricted"), F.lit(None).cast("string"), F.col("note"), F.concat(F.lit("https://z/"), k.cast("string")))
    return a.select("o_orderkey", "note", sentence.alias("sentence"), level["text"].alias("level"))


@query(f"""WITH s AS (SELECT o_orderkey, (CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 WHEN 3 THEN 1000000000 ELSE 1000000000000 END) * (o_custkey % 900 + 1)::DOUBLE AS n, o_orderpriority, o_orderstatus FROM orders)
SELECT o_orderkey, CASE WHEN n >= 1e12 THEN {half_up('n / 1e12', 1)} || ' TB' WHEN n >= 1e9 THEN {half_up('n / 1e9', 1)} || ' GB' WHEN n >= 1e6 THEN {half_up('n / 1e6', 1)} || ' MB' WHEN n >= 1e3 THEN {half_up('n / 1e3', 1)} || ' KB' ELSE n::BIGINT || ' B' END AS size,
  CASE WHEN length(o_orderpriority || '  x') > 9 THEN regexp_replace(o_orderpriority || '  x', '\\s+', ' ', 'g')[1:6] || '...' ELSE regexp_replace(o_orderpriority || '  x', '\\s+', ' ', 'g') END AS short, 'a: ' || o_orderstatus || '; b: 1' AS cell, CASE WHEN o_orderstatus IN ('O', 'F') THEN o_orderstatus ELSE 'Other' END AS enum FROM s""".replace("length(o_orderpriority || '  x') > 9", "length(regexp_replace(o_orderpriority || '  x', '\\s+', ' ', 'g')) > 9"))
def q_cells(t: Tables) -> DataFrame:
    n = F.get(F.array(*[F.lit(10.0 ** (3 * i)) for i in range(5)]), (F.col("o_orderkey") % 5).cast("int")) * (F.col("o_custkey") % 900 + 1)
    return t.orders.select("o_orderkey", D.human_size(n).alias("size"), D.short(F.concat(F.lit(" "), "o_orderpriority", F.lit("  x")), 9).alias("short"), D.flat_map(F.create_map(F.lit("a"), "o_orderstatus", F.lit("b"), F.lit("1"))).alias("cell"), D.allowed(F.col("o_orderstatus"), ("O", "F")).alias("enum"))


_PHOTO = ["RGB", "YBR_FULL_422", "monochrome2", "PALETTE COLOR", "", "CMYK"]


@query(f"""WITH h AS (SELECT l_orderkey, l_linenumber, {pick_sql(_PHOTO, 'l_suppkey')} AS p, l_linenumber - 1 AS s, CASE WHEN l_returnflag = 'R' THEN 24 ELSE 0 END AS al, (l_partkey % 40)::INT AS st, l_shipdate, l_returnflag, l_quantity AS x, l_linestatus FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN p LIKE 'RGB%' OR p LIKE 'YBR%' THEN 3 WHEN upper(p) LIKE 'MONO%' OR p LIKE 'PAL%' THEN 1 WHEN s > 0 THEN s END AS samples, CASE WHEN al > 0 THEN al WHEN st > 0 THEN CASE WHEN st = 1 THEN 1 WHEN st <= 8 THEN 8 WHEN st <= 16 THEN 16 WHEN st <= 32 THEN 32 ELSE 64 END END AS bits,
  'A\\' || l_linenumber AS value, CASE WHEN l_returnflag = 'R' THEN '' ELSE strftime(l_shipdate, '%Y%m%d%H%M%S') END AS stamp, 'SCT ' || l_linenumber AS code,
  CASE WHEN l_returnflag = 'A' THEN round(0.5 / 1000, 6) WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN round(0.001 / x, 6) WHEN l_linenumber = 1 OR x IN (72, 96, 150, 300) THEN NULL ELSE round(CASE WHEN l_linenumber = 3 THEN 10.0 ELSE 25.4 END / x, 6) END AS spacing FROM h""")
def q_header_values(t: Tables) -> DataFrame:
    x, line = F.col("l_quantity"), F.col("l_linenumber")
    text = F.when(F.col("l_returnflag") == "A", 'PhysicalSizeX="0.5"').when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "ImageJ unit=micron")
    stamp = F.when(F.col("l_returnflag") == "R", "0000:00:00").otherwise(F.date_format("l_shipdate", "yyyy:MM:dd HH:mm:ss"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", D.samples_per_pixel(pick(_PHOTO, "l_suppkey"), line - 1).alias("samples"), D.bits_allocated(F.when(F.col("l_returnflag") == "R", 24).otherwise(0), (F.col("l_partkey") % 40).cast("int")).alias("bits"),
        D.header_value(F.array(F.lit("A "), line.cast("string"))).alias("value"), D.exif_time(stamp).alias("stamp"), D.code_text(F.lit("SCT"), line.cast("string"), F.lit(" ")).alias("code"),
        D.tiff_spacing(x, x, line, text)[0].alias("spacing"),
    )


@query("""SELECT p_partkey, p_size::VARCHAR AS samples, p_brand || ', b' AS bands, CASE WHEN p_partkey % 2 = 0 THEN 'last' ELSE 'bsq' END AS interleave FROM part""")
def q_envi_header(t: Tables) -> DataFrame:
    text = F.concat(F.lit("ENVI\n Samples = "), F.col("p_size").cast("string"), F.lit("\nband names={"), "p_brand", F.lit(", b}\ninterleave = bsq\n"), F.when(F.col("p_partkey") % 2 == 0, "interleave = last").otherwise(""))
    h = F.col("h")
    return t.part.select("p_partkey", D.envi_header(text).alias("h")).select("p_partkey", h["samples"].alias("samples"), h["band names"].alias("bands"), h["interleave"].alias("interleave"))


@query("""WITH f AS (SELECT DISTINCT '/data/' || lang || '/' || source || '/results' AS path FROM documents), e AS (SELECT path, k, array_to_string(list_slice(string_split(path[2:], '/'), 4 - k + 1, 4), '/') AS tail FROM f, (SELECT unnest(range(1, 5)) AS k)),
s AS (SELECT k, tail, min(path) AS path FROM e GROUP BY 1, 2 HAVING count(*) = 1)
SELECT path, coalesce((SELECT arg_min(tail, k) FROM s WHERE s.path = f.path), path[2:]) AS label, CASE WHEN starts_with(path, '/data/en/') THEN path[10:] ELSE path END AS relative FROM f""")
def q_folder_labels(t: Tables) -> DataFrame:
    f = t.documents.select(F.concat(F.lit("/data/"), "lang", F.lit("/"), "source", F.lit("/results")).alias("path"))
    return D.folder_labels(f, "path").select("path", "label", D.relative_folder(F.col("path"), F.lit("/data/en/")).alias("relative"))


@query("""SELECT doc_id, '[Abstract] ' || CASE WHEN length(text) + 11 > 60 THEN text[1:49] || ' [truncated; full text in dataset_description.json]' ELSE text END AS flat, CASE lang WHEN 'en' THEN 'D041623' WHEN 'fr' THEN 'C188577' END AS code FROM documents""")
def q_flat_description(t: Tables) -> DataFrame:
    d = F.array(F.struct(F.lit("Abstract").alias("type"), F.col("text").alias("text")))
    modality = F.when(F.col("lang") == "en", "retinal_oct").when(F.col("lang") == "fr", "volumetric_imaging").otherwise("derived_data")
    return t.documents.select("doc_id", D.flat_description(d, 60).alias("flat"), D.modality_term(modality)["code"].alias("code"))


# ---- images in DICOM's terms ----

_CLASSES = [*T_CLASSES, "MASK"]
_BITS = [8, 12, 32, 16]
_WHO = ["Topcon", "Optos", "", "Kowa"]
_WHERE = ["x/1.png", "AS-OCT/2.png", "onh_3.png", "cornea/4.png", "rnfl.png"]
_WORDS = ["", "circumpapillary scans", "anterior segment images", "optic disc cubes"]


def _attributes_sql() -> str:
    deep = "bits > 8 AND bits <= 16"
    rows = ", ".join("(" + ", ".join("'" + (y[0] if isinstance(y, tuple) else y).replace("'", "''") + "'" for y in (c, *v)) + ")" for c, v in I.ATTRIBUTES.items())
    return f"""p AS (SELECT p_partkey, {pick_sql(_CLASSES, 'p_partkey')} AS cls, {pick_sql(_BITS, 'p_partkey', 8)}::INT AS bits, lower({pick_sql(_WHO, 'p_partkey', 3)}) AS who, lower({pick_sql(_WHERE, 'p_partkey', 5)}) AS path, lower({pick_sql(_WORDS, 'p_partkey', 40)}) AS prose, p_size % 2 AS zero FROM part),
a(cls, modality, sop, image_type, body_part, anatomy, device, filter, channels, illumination) AS (VALUES {rows}),
j AS (SELECT p.*, a.* EXCLUDE (cls) FROM p JOIN a ON a.cls = p.cls)
SELECT p_partkey, modality, CASE WHEN sop = '{I.OP8[0]}' AND {deep} THEN '{I.OP16[1]}' ELSE CASE sop {' '.join(f"WHEN '{u}' THEN '{n}'" for u, n in (I.OP8, I.OPT, I.OPTENF, I.OTHER))} END END AS sop_name, image_type,
  CASE WHEN cls <> 'OCT' THEN anatomy WHEN regexp_matches(path, '{I.ANTERIOR_PATH}') OR regexp_matches(prose, '{I.ANTERIOR_TEXT}') THEN '{I.ANTERIOR}' WHEN regexp_matches(path, '{I.DISC_PATH}') OR regexp_matches(prose, '{I.DISC_TEXT}') THEN '{I.DISC}' ELSE anatomy END AS anatomy,
  CASE WHEN cls = 'FAF' AND regexp_matches(who, '{I.FLASH_MAKERS}') THEN '{I.CAMERA}' ELSE device END AS device, CASE WHEN cls = 'FAF' AND contains(who, 'optos') THEN '{I.GREEN}' ELSE filter END AS filter,
  CASE WHEN cls = 'PSC' AND zero = 0 THEN '' ELSE channels END AS channels, CASE WHEN cls = 'PSC' AND zero = 1 THEN 2 END AS samples_used FROM j"""


@query("WITH " + _attributes_sql())
def q_class_attributes(t: Tables) -> DataFrame:
    k = "p_partkey"
    x = I.class_attributes(pick(_CLASSES, k), pick(_BITS, k, 8), pick(_WHO, k, 3), pick(_WHERE, k, 5), pick(_WORDS, k, 40), (F.col("p_size") % 2).cast("double"))
    return t.part.select(k, x.alias("x")).where("x is not null").select(k, *[f"x.{c}" for c in ("modality", "sop_name", "image_type", "anatomy", "device", "filter", "channels", "samples_used")])


_MODELS = ["TRC", "Cirrus", "", "HRA"]


@query(f"""WITH i AS (SELECT l_orderkey, l_partkey * 1000 + l_suppkey AS pos, l_quantity::INT AS rows, l_suppkey AS cols, (l_partkey % 20)::INT AS bits, CASE WHEN l_linenumber = 3 THEN 5 END AS frames, {pick_sql(_PHOTO, 'l_suppkey')} AS photometric, {pick_sql(_MODELS, 'l_partkey')} AS model,
  CASE WHEN l_returnflag = 'R' THEN 'OP' WHEN l_returnflag = 'A' THEN 'OPT' END AS hm, CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN 'Zeiss' END AS hmk, CASE WHEN l_linestatus = 'F' THEN 'Canon' END AS make, CASE WHEN l_linenumber = 1 THEN 'CFP' WHEN l_linenumber = 2 THEN 'OCT' ELSE 'MASK' END AS cls,
  CASE WHEN l_returnflag = 'R' AND l_suppkey % 2 = 0 THEN 'L' END AS hs, l_suppkey % 3 AS w FROM lineitem),
s AS (SELECT *, coalesce(hs, CASE w WHEN 0 THEN 'R' WHEN 1 THEN 'L' ELSE 'U' END) AS side, CASE WHEN hs IS NOT NULL THEN 'dicom_header' WHEN w = 0 THEN 'dirname' WHEN w = 1 THEN 'basename' ELSE 'none' END AS src, CASE WHEN upper(photometric) LIKE 'RGB%' OR photometric LIKE 'YBR%' THEN 3 WHEN upper(photometric) LIKE 'MONO%' OR photometric LIKE 'PAL%' THEN 1 END AS spp FROM i),
v AS (SELECT l_orderkey, pos, unnest(['photometric', 'spp', 'bits', 'model', 'hm', 'hmk', 'make']) AS name, unnest([photometric, spp::VARCHAR, CASE WHEN bits IS NOT NULL THEN bits::VARCHAR END, model, hm, hmk, make]) AS value FROM s),
n AS (SELECT l_orderkey, name, value, count(*) AS n, min(pos) AS first FROM v WHERE value <> '' GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, name ORDER BY n DESC, first) AS rank FROM n),
x AS (SELECT l_orderkey, {', '.join(f"coalesce(string_agg(value || ' (' || n || ')', '; ' ORDER BY rank) FILTER (name = '{c}' AND rank <= {k}), '') AS {c}_set" for c, k in (('photometric', 4), ('spp', 3), ('bits', 4), ('model', 3), ('hm', 4)))}, min(value) FILTER (name = 'hmk' AND rank = 1) AS hmk, min(value) FILTER (name = 'make' AND rank = 1) AS make FROM r GROUP BY 1),
g AS (SELECT l_orderkey, count(*) AS n, count(hm) AS n_header, min(rows) AS r0, max(rows) AS r1, max(coalesce(frames, 1)) AS frames_max, count(*) FILTER (frames > 1) AS multiframe, count(*) FILTER (bits > 16) AS too_deep, count(*) FILTER (hm IS NOT NULL AND cls <> 'MASK') AS q1, count(*) FILTER (hm = CASE cls WHEN 'CFP' THEN 'OP' WHEN 'OCT' THEN 'OPT' END) AS q0,
  count(*) FILTER (side = 'R') AS sr, count(*) FILTER (side = 'L') AS sl, count(*) FILTER (side = 'U') AS su, count(*) FILTER (side <> 'U' AND src = 'dicom_header') AS f1, count(*) FILTER (side <> 'U' AND src = 'basename') AS f2, count(*) FILTER (side <> 'U' AND src = 'dirname') AS f3 FROM s GROUP BY 1)
SELECT l_orderkey, n, n_header, CASE WHEN r0 = r1 THEN r0::VARCHAR ELSE r0 || '-' || r1 END AS rows_range, frames_max, multiframe, too_deep, concat_ws(' ', CASE WHEN sr > 0 THEN 'R:' || sr END, CASE WHEN sl > 0 THEN 'L:' || sl END, CASE WHEN su > 0 THEN 'U:' || su END) AS sides,
  concat_ws('; ', CASE WHEN f1 > 0 THEN 'dicom_header:' || f1 END, CASE WHEN f2 > 0 THEN 'basename:' || f2 END, CASE WHEN f3 > 0 THEN 'dirname:' || f3 END) AS side_sources, coalesce(photometric_set, '') AS photometric_set, coalesce(spp_set, '') AS samples_per_pixel_set, coalesce(bits_set, '') AS bits_set, coalesce(model_set, '') AS model_set, coalesce(hm_set, '') AS header_modality_set,
  coalesce(hmk, make, '') AS maker, CASE WHEN hmk IS NOT NULL THEN 'dicom_header' WHEN make IS NOT NULL THEN 'exif' ELSE '' END AS maker_source, CASE WHEN q1 > 0 THEN q0 || '/' || q1 ELSE '' END AS qc FROM g LEFT JOIN x USING (l_orderkey)""")
def q_dicom_rollup(t: Tables) -> DataFrame:
    flag, line, supp = F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_suppkey")
    images = t.lineitem.select(
        "l_orderkey", (F.col("l_partkey") * 1000 + supp).alias("pos"), F.when(line == 1, "CFP").when(line == 2, "OCT").otherwise("MASK").alias("cls"), F.when(supp % 3 == 0, "od/a.png").when(supp % 3 == 1, "b_left.png").otherwise("c.png").alias("path"),
        F.col("l_quantity").cast("int").alias("rows"), supp.alias("cols"), (F.col("l_partkey") % 20).cast("int").alias("bits"), F.when(line == 3, 5).alias("frames"), pick(_PHOTO, "l_suppkey").alias("photometric"),
        F.lit(None).cast("int").alias("samples"), F.lit(None).cast("int").alias("allocated"), F.when(F.col("l_linestatus") == "F", "Canon").alias("make"), pick(_MODELS, "l_partkey").alias("model"), F.lit(None).cast("string").alias("lossy"),
        F.when(flag == "R", "OP").when(flag == "A", "OPT").alias("header_modality"), F.when((flag == "R") & (line % 2 == 0), "Zeiss").alias("header_maker"), F.when((flag == "R") & (supp % 2 == 0), "l").alias("header_side"),
    )
    return I.record_rollup(images, ["l_orderkey"], "pos").drop("cols_range", "side_conflicts", "bits_allocated_set", "high_bit_set", "lossy_set")


# ---- workbook ----

_SURVEY_SQL = """r AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, count(l_orderkey) AS n_classified FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)"""


def _survey(t: Tables) -> DataFrame:
    flags = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("conf"))
    classes = flags.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", F.struct("n", "conf")))).alias("classes"), F.sum("n").alias("n_classified"))
    k = F.col("o_orderkey")
    return t.orders.join(classes, F.col("l_orderkey") == k, "left").select(
        k.alias("record_id"), F.col("o_orderstatus").alias("status"), F.when(k % 3 > 0, F.col("o_orderpriority")).alias("sampling_pass"), F.coalesce("n_classified", F.lit(0)).alias("n_classified"), "classes",
        F.when(k % 2 == 0, F.array(F.lit("OCT"))).otherwise(F.expr(R.NO_TEXTS)).alias("present"), (k % 5 == 0).alias("mask_dominated"), F.when(k % 4 > 0, k % 4 == 1).alias("kept"), F.round("o_totalprice").cast("long").alias("kept_bytes"),
        F.when(F.col("o_custkey") % 2 == 0, F.struct(F.col("o_custkey").alias("c"))).alias("document"), F.when(F.col("o_custkey") % 3 == 0, F.create_map(F.lit("title"), "o_orderstatus", F.lit("date"), "o_orderpriority")).otherwise(F.create_map(F.lit("title"), "o_orderstatus")).alias("provenance"),
    )


@query(f"""WITH {_SURVEY_SQL}, s AS (SELECT count(*) AS n, count(*) FILTER (n_classified > 0) AS c, count(*) FILTER (o_orderkey % 2 = 0) AS e, count(*) FILTER (o_orderkey % 5 = 0) AS m, count(*) FILTER (o_orderkey % 4 = 1) AS k, coalesce(sum(round(o_totalprice)) FILTER (o_orderkey % 4 = 1), 0) AS b, count(*) FILTER (o_custkey % 2 = 0) AS d FROM r),
t AS (SELECT 0 AS part, '' AS o, unnest(['Records', 'Records with classified images', 'Records with an eye modality', 'Records whose images are mostly masks', 'Records whose fetched files were kept', 'Bytes kept', 'Records with documents']) AS key, unnest([n::VARCHAR, c::VARCHAR, e::VARCHAR, m::VARCHAR, k::VARCHAR,
  CASE WHEN b >= 1e12 THEN {half_up('b / 1e12', 1)} || ' TB' WHEN b >= 1e9 THEN {half_up('b / 1e9', 1)} || ' GB' WHEN b >= 1e6 THEN {half_up('b / 1e6', 1)} || ' MB' ELSE {half_up('b / 1e3', 1)} || ' KB' END, d::VARCHAR]) AS value, unnest(range(7)) AS i FROM s
  UNION ALL SELECT 1, o_orderstatus, 'Status: ' || o_orderstatus, count(*)::VARCHAR, 0 FROM r GROUP BY o_orderstatus UNION ALL SELECT 2, p, 'Pass: ' || p, count(*)::VARCHAR, 0 FROM (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority ELSE '(none)' END AS p FROM r) GROUP BY p)
SELECT row_number() OVER (ORDER BY part, i, o) - 1 AS position, key, value FROM t""")
def q_workbook_readme(t: Tables) -> DataFrame:
    return W.readme(W.summary(_survey(t))).select(F.col("position").cast("long").alias("position"), "key", "value")


@query("""WITH c AS (SELECT l_orderkey AS record_id, l_returnflag AS class, count(*) AS n, round(avg(l_discount), 6) AS mean_conf FROM lineitem GROUP BY 1, 2)
SELECT record_id, class, n, mean_conf, round(n::DOUBLE / sum(n) OVER (PARTITION BY record_id), 6) AS share FROM c WHERE record_id IN (SELECT o_orderkey FROM orders)""")
def q_record_classes(t: Tables) -> DataFrame:
    return W.record_classes(_survey(t)).withColumn("share", r6("share"))


@query("""WITH p AS (SELECT 'title' AS field, o_orderstatus AS source FROM orders UNION ALL SELECT 'date', o_orderpriority FROM orders WHERE o_custkey % 3 = 0), n AS (SELECT field, source, count(*) AS n FROM p GROUP BY 1, 2)
SELECT field, sum(n)::BIGINT AS n_filled, string_agg(source || ' (' || n || ')', '; ' ORDER BY n DESC, source) AS sources FROM n GROUP BY 1""")
def q_schema_fields(t: Tables) -> DataFrame:
    return W.schema_fields(_survey(t))


@query("""WITH s AS (SELECT p_brand AS mv, p_partkey AS pos, 's' || p_partkey AS id, p_type AS class, p_size AS train, p_size % 7 AS test, p_size = 13 AS synth, p_size = 1 AS ev, p_size >= 49 AS flag FROM part)
SELECT mv AS model_version, min(pos) AS first, mv || ': ' || count(*) || ' source rows over ' || count(DISTINCT class) || ' classes (' || string_agg(DISTINCT class, ', ' ORDER BY class) || '), ' || sum(train) || ' training images, ' || sum(test) || ' test images'
  || coalesce('; synthetic: ' || string_agg(id, ', ' ORDER BY pos) FILTER (synth), '') || coalesce('; evaluation only (never trained on): ' || string_agg(id, ', ' ORDER BY pos) FILTER (ev), '') || coalesce('; trained on sources not cleared by license policy: ' || string_agg(id, ', ' ORDER BY pos) FILTER (flag), '') AS text FROM s GROUP BY mv""")
def q_train_summary(t: Tables) -> DataFrame:
    s = t.part.select(
        F.col("p_partkey").alias("position"), F.col("p_brand").alias("model_version"), F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("source_id"), F.col("p_type").alias("class"), F.col("p_size").alias("train_n"), (F.col("p_size") % 7).alias("test_n"),
        F.when(F.col("p_size") == 13, "Yes").alias("synthetic"), F.when(F.col("p_size") == 1, "eval_only_x").alias("role"), F.when(F.col("p_size") >= 49, "blocked").alias("policy"),
    )
    return W.training_summary(s)
