"""Merging of append-only logs: last write wins, merging of runs, overlays and backfills.

"Latest" is a max_by over a total order, not a window: it is pre-aggregated before the shuffle, so a key with very many
versions sends one row of each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """For each key the row that is last in ``order``; rows that tie in it should be equal, else one of them is taken."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, "__row.*")


def merge_runs(df: DataFrame, key: str, run: str, position: str, status: str, unfinished: tuple[str, ...]) -> DataFrame:
    """Merge the logs of several runs: of each run the last line of a key counts; a finished line beats unfinished ones
    of any run, and among equals the later run wins."""
    last = latest(df, [key, run], [position])
    finished = (~F.col(status).isin(*unfinished)).cast("int")
    return latest(last.withColumn("__finished", finished), [key], ["__finished", run]).drop("__finished")


def is_final(status: Column, unfinished: tuple[str, ...], retry: tuple[str, ...] = ()) -> Column:
    """A missing row isn't final."""
    return status.isNotNull() & ~status.isin(*unfinished, *retry)


def todo(scope: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of the scope whose key has no row in ``done``."""
    return scope.join(done.select(key).distinct(), key, "left_anti")


def crashed(log: DataFrame, key: str, order: list[str], status: str, started: str, becomes: str = "crashed") -> DataFrame:
    """Rows to append for keys whose last line says that work began."""
    return latest(log, [key], order).where(F.col(status) == started).withColumn(status, F.lit(becomes))


def overlay(base: DataFrame, supplement: DataFrame, key: str, prefixes: tuple[str, ...], fields: str = "fields") -> DataFrame:
    """Overwrite columns of ``base`` whose name has one of the prefixes with the supplement's, where the supplement has
    the key. ``fields`` is a map of what each supplement row has: a present key overwrites even with null, an absent key leaves the column as it is."""
    chosen = [c for c in base.columns if c.startswith(prefixes)]
    s = supplement.select(F.col(key).alias("__k"), F.col(fields).alias("__f"))
    joined = base.join(s, F.col(key) == F.col("__k"), "left")
    has = lambda c: F.coalesce(F.map_contains_key("__f", F.lit(c)), F.lit(False))
    out = [F.when(has(c), F.col("__f")[c].cast(base.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in chosen else F.col(c) for c in base.columns]
    return joined.select(*out)


def backfill(df: DataFrame, chains: dict[str, list[str | Column]]) -> DataFrame:
    """Fill each column, where it is null, from the first of its alternatives that isn't."""
    return df.withColumns({c: F.coalesce(F.col(c), *[F.col(x) if isinstance(x, str) else x for x in chain]) for c, chain in chains.items()})


def merge_counts(before: DataFrame, after: DataFrame, status: str) -> DataFrame:
    """Counts of each status before and after a rerun."""
    b = before.groupBy(status).agg(F.count("*").alias("before"))
    a = after.groupBy(status).agg(F.count("*").alias("after"))
    return b.join(a, status, "full").select(status, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


def replace_by_id(log: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """A log after a rerun: rows with a new version are replaced, new keys are added."""
    return log.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)
