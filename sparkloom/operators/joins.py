"""Joins with a rule: first match of ordered patterns, companions, targets, routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import DATA_OF_HEADER, extension

#: More patterns than this aren't a pattern list.
MAX_PATTERNS = 10_000


def first_match(df: DataFrame, text: str | Column, patterns: list[tuple[str, ...]], names: list[str]) -> DataFrame:
    """Add ``ordinal`` and the columns ``names`` of the first pattern that the text has; null where none does.

    ``patterns`` are (regex, *values) in order. They become one CASE, so each row tests them in order and stops, and nothing is
    joined or shuffled.
    """
    if len(patterns) > MAX_PATTERNS:
        raise ValueError("too many patterns")
    c = F.col(text) if isinstance(text, str) else text
    if not patterns:
        return df.withColumns({"ordinal": F.lit(None).cast("int"), **{n: F.lit(None).cast("string") for n in names}})
    rule = None
    for i, (regex, *_) in enumerate(patterns):
        rule = F.when(c.rlike(regex), F.lit(i)) if rule is None else rule.when(c.rlike(regex), F.lit(i))
    df = df.withColumn("ordinal", rule)
    values = {n: F.get(F.array(*[F.lit(p[1 + k]) for p in patterns]), F.col("ordinal")) for k, n in enumerate(names)}
    return df.withColumns(values)


def companions(files: DataFrame, group: list[str], name: str) -> DataFrame:
    """The data file of each volume header: same group, same stem in any case, the first ending in the header's order.

    A header explodes into its few possible names, so this is an equi-join on (group, lower-case name).
    """
    ext = F.col("__ext")
    stem = F.lower(F.col(name).substr(F.lit(1), F.length(name) - F.length(ext)))
    options = F.create_map(*[x for h, data in DATA_OF_HEADER.items() for x in (F.lit(h), F.array(*map(F.lit, data)))])
    headers = files.withColumn("__ext", extension(F.col(name))).where(ext.isin(*DATA_OF_HEADER)).select(*group, F.col(name).alias("header"), stem.alias("__stem"), F.posexplode(F.element_at(options, ext)).alias("__rank", "__data"))
    headers = headers.withColumn("__low", F.concat("__stem", "__data"))
    data = files.select(*group, F.lower(name).alias("__low"), F.col(name).alias("data"))
    return headers.join(data, [*group, "__low"]).groupBy(*group, "header").agg(F.min_by("data", F.struct("__rank", "data")).alias("data"))


def select_targets(scrape: DataFrame, rows: DataFrame, key: str, position: str, access: str, status: str, right: str, wanted_access: tuple[str, ...], wanted_status: tuple[str, ...]) -> DataFrame:
    """Ids to look at: by the scrape's access, or by a row's status or access right; in scrape order, then row order."""
    s = scrape.select(F.col(key).alias("k"), F.col(position).alias("__sp"), F.lower(access).alias("__a"))
    r = rows.select(F.col(key).alias("k"), F.col(position).alias("__rp"), F.col(status).alias("__s"), F.lower(right).alias("__r"))
    hit = F.coalesce(F.col("__a").isin(*wanted_access), F.lit(False)) | F.coalesce(F.col("__s").isin(*wanted_status), F.lit(False)) | F.coalesce(F.col("__r").isin(*wanted_access), F.lit(False))
    return s.join(r, "k", "full").where(hit).select(F.col("k").alias(key), F.col("__sp").alias("scrape_pos"), F.col("__rp").alias("row_pos"))


def in_order(targets: DataFrame) -> DataFrame:
    return targets.orderBy(F.col("scrape_pos").asc_nulls_last(), F.col("row_pos").asc_nulls_last())


def route(files: DataFrame, local: DataFrame, key: list[str], size: str, wanted: Column, remote_zip: Column) -> DataFrame:
    """Plan of each file: ``available`` with a complete local copy, else ``remote_zip``, ``fetch`` or ``skip``."""
    have = local.groupBy(*key).agg(F.max(size).alias("__size"))
    joined = files.join(have, key, "left")
    return joined.withColumn("route", F.when(F.col("__size") == F.col(size), "available").when(remote_zip, "remote_zip").when(wanted, "fetch").otherwise("skip")).drop("__size")


def record_mode(routes: DataFrame, record: list[str]) -> DataFrame:
    """What a record needs as a whole: remote_zip before download before local before none."""
    has = lambda r: F.bool_or(F.col("route") == r)
    return routes.groupBy(*record).agg(F.when(has("remote_zip"), "remote_zip").when(has("fetch"), "download").when(has("available"), "local").otherwise("none").alias("mode"))


def repair(states: DataFrame, requests: DataFrame, key: str, state: str, waiting: str) -> DataFrame:
    """Keys that wait for a request which isn't there."""
    return states.where(F.col(state) == waiting).join(requests.select(key).distinct(), key, "left_anti")
