"""States of records from their events, rates and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def whole_seconds(ts: Column) -> Column:
    """Seconds since 1970 rounded to whole ones, halves to the even one, as SQL's cast of an epoch does."""
    return F.rint(F.unix_micros(ts.cast("timestamp")) / 1e6).cast("long")


def fold_states(events: DataFrame, key: str, event: str, ts: str, priority: list[tuple[str, str]], start: str) -> DataFrame:
    """State of each key: the first in ``priority`` (event, state) whose event is there, else ``start``. One pre-aggregated pass."""
    flags = events.groupBy(key).agg(*[F.max(F.when(F.col(event) == e, F.col(ts))).alias(f"__{i}") for i, (e, _) in enumerate(priority)])
    state = None
    for i, (_, name) in enumerate(priority):
        cond = F.col(f"__{i}").isNotNull()
        state = F.when(cond, F.lit(name)) if state is None else state.when(cond, F.lit(name))
    return flags.select(key, state.otherwise(F.lit(start)).alias("state"))


def attempts(events: DataFrame, key: str, event: str, started: str) -> DataFrame:
    return events.groupBy(key).agg(F.count_if(F.col(event) == started).alias("attempts"))


def rate_and_eta(events: DataFrame, key: str, ts: str, total: int, hours: float = 1.0) -> DataFrame:
    """One row: distinct keys done, those of the last hours before the newest event, and hours left at that rate."""
    newest = events.agg(F.max(ts).alias("__now"))
    last = events.crossJoin(F.broadcast(newest))  # one row
    recent = whole_seconds(F.col(ts)) > whole_seconds(F.col("__now")) - F.lit(int(hours * 3600))
    out = last.agg(F.count_distinct(key).alias("done"), F.count_if(recent).alias("recent"))
    return out.withColumn("eta_hours", F.when(F.col("recent") > 0, F.greatest(F.lit(total) - F.col("done"), F.lit(0)) * F.lit(hours) / F.col("recent")))


def sessions(events: DataFrame, key: str, ts: str, order: str, gap_seconds: int) -> DataFrame:
    """Sessions of each key: runs of events with gaps below ``gap_seconds``."""
    w = Window.partitionBy(key).orderBy(ts, order)
    new = F.coalesce(whole_seconds(F.col(ts)) - whole_seconds(F.lag(ts).over(w)) >= gap_seconds, F.lit(True)).cast("int")
    marked = events.withColumn("session", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "session").agg(F.count("*").alias("n_events"), F.min(ts).alias("started"), F.max(ts).alias("ended"))
