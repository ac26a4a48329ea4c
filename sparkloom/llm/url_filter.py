"""URL filters: listed rules, and for the rest a tree of path templates per host, judged by labelled purity.

All steps are DataFrame operations over counts: a host with a third of all pages costs one row per template and task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Table, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Segments that are variable by their form: pattern, wildcard.
VARIABLE = (("^[0-9]+$", "{n}"), ("^[0-9]+\\.[A-Za-z0-9]{1,5}$", "{n}.x"), ("^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$", "{d}"), ("^[0-9a-fA-F-]{16,}$", "{h}"))
#: A node with at least so many branches and at most so many pages a branch is variable as a whole.
WIDE, THIN = 8, 4.0
#: A branch joins its siblings unless its share of bad pages is over so many standard errors from theirs.
Z = 2.0
#: Weight of the overall share in a template's share, and the share from which a template is rejected.
PRIOR, REJECT = 4.0, 0.5
#: A form that more than one in so many pages have is hot; there are fewer than HOT such forms, so they can be broadcast.
HOT = 1000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null if none fits. ``rules``: (verdict, host + path), a short list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, rule in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(say)).otherwise(verdict)
    return name, verdict


def form_of(path: Column) -> Column:
    """The non-empty segments of a path, those of a variable form as wildcards."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), _form)


def _form(seg: Column) -> Column:
    return reduce(lambda c, x: c.when(seg.rlike(x[0]), F.lit(x[1])), VARIABLE[1:], F.when(seg.rlike(VARIABLE[0][0]), F.lit(VARIABLE[0][1]))).otherwise(seg)


def templates(pages: DataFrame) -> DataFrame:
    """``pages(host, form, bad int or null)`` -> host, form, n, template, share, method: a row for each distinct form of path.

    Level by level from the root, a branch becomes ``*`` if its node is wide and thin, or if its share of bad pages is
    like its siblings'; a branch with no labelled page is like them. The tree is as deep as its paths: it ends where the
    rest of the path is the same for all forms of a template. A template's share is smoothed towards the share of all
    labelled pages; from REJECT on, it is blocked.
    """
    t = pages.groupBy("host", "form").agg(F.count("*").alias("n"), F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    at = Table(t.withColumn("template", F.lit("")), "url-forms")  # each level reads it several times
    overall = at.df.agg((F.sum("bad") / F.when(F.sum("lab") > 0, F.sum("lab"))).alias("p0"))
    p0 = overall.first()["p0"]
    level = 0
    while True:
        rest = F.slice("form", F.lit(level + 1), F.greatest(F.size("form") - level, F.lit(0)))
        open_ = at.df.groupBy("host", "template").agg((F.min(rest) != F.max(rest)).alias("branches")).where("branches")
        if open_.isEmpty():
            break
        t = at.df.withColumn("seg", F.coalesce(F.get("form", F.lit(level)), F.lit("")))
        branch = t.groupBy("host", "template", "seg").agg(F.sum("n").alias("bn"), F.sum("lab").alias("bl"), F.sum("bad").alias("bb"))
        node = branch.where(F.col("seg") != "").groupBy("host", "template").agg(F.count("*").alias("nk"), F.sum("bn").alias("nn"), F.sum("bl").alias("nl"), F.sum("bb").alias("nb"))
        p = F.col("nb") / F.col("nl")
        like = (F.col("bl") == 0) | (F.abs(F.col("bb") / F.col("bl") - p) <= Z * F.sqrt(p * (1 - p) / F.col("bl")))
        like = F.when((F.col("bl") > 0) & (F.col("nl") > 0), like).otherwise(True)
        wide = (F.col("nk") >= WIDE) & (F.col("nn") <= THIN * F.col("nk"))
        seg = F.when(F.col("seg") == "", F.lit("")).when((F.col("nk") > 1) & (wide | like), F.lit("/*")).otherwise(F.concat(F.lit("/"), "seg"))
        named = branch.join(node, ["host", "template"], "left").select("host", "template", "seg", F.concat("template", seg).alias("next"))
        t = t.join(named, ["host", "template", "seg"]).drop("template", "seg").withColumnRenamed("next", "template")
        before, at = at, Table(t, "url-templates")
        before.drop()
        level += 1
    t = at.df.withColumn("template", F.concat("template", F.array_join(F.transform(rest, lambda x: F.concat(F.lit("/"), x)), "")))
    ends = t.groupBy("host", "template").agg(F.sum("lab").alias("tl"), F.sum("bad").alias("tb"))
    share = (F.col("tb") + F.lit(PRIOR * (p0 or 0.0))) / (F.col("tl") + PRIOR)
    ends = ends.select("host", "template", share.alias("share"), F.when(share >= REJECT, F.lit("block")).otherwise(F.lit("allow")).alias("method"))
    out = written(t.select("host", "form", "n", "template").join(ends, ["host", "template"]), "url-verdicts")
    at.drop()
    return out


def judge(pages: DataFrame, rules: list[tuple[str, str]], labels: DataFrame | None = None) -> DataFrame:
    """``pages(page_id, url)`` -> page_id, host, path, rule, verdict, template, share; one row per row of ``pages``.

    ``labels(page_id, bad int)`` are the labelled pages; several rows of a page count as bad if one is; null labels
    don't count. Without labels, or in templates without labelled pages, the prior decides. Null urls have an empty
    host and path and are judged as such. Other columns are ignored.
    """
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if labels is None:
        base = base.withColumn("bad", F.lit(None).cast("int"))
    else:
        one = labels.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").cast("int").alias("bad"))
        base = base.join(one, "page_id", "left")
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("page_id", "host", "path", "bad", rule.alias("rule"), said.alias("said"), form_of(F.col("path")).alias("form"))
    found = templates(base)
    keys, result = ["host", "form"], ["page_id", "host", "path", "rule", F.coalesce("said", "method").alias("verdict"), "template", "share"]
    hot_from = (found.agg(F.sum("n")).first()[0] or 0) // HOT
    hot, rest = F.broadcast(found.where(F.col("n") > hot_from)), found.where(F.col("n") <= hot_from)
    return base.join(hot, keys).select(*result).union(base.join(hot.select(*keys), keys, "left_anti").join(rest, keys).select(*result))
