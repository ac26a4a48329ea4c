"""Seeded, budgeted and proportional sampling with window functions.

The seed orders rows by md5(seed ':' key ...), so samples are repeatable on any cluster, agree with SQL, and a larger
cap only adds rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def seeded(seed: int | str, *columns: str | Column) -> Column:
    """A repeatable order: md5 of the seed and the columns, joined by colons (nulls are left out)."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def seeded_rank(df: DataFrame, group: list[str], key: str, seed: int, before: tuple[str, ...] = (), out: str = "rn") -> DataFrame:
    """Position of each row in its group's seeded order, from 1; ``before`` are columns that come first in the order."""
    w = Window.partitionBy(*group).orderBy(*before, seeded(seed, *group, key), F.col(key))
    return df.withColumn(out, F.row_number().over(w))


def two_pass(df: DataFrame, group: list[str], key: str, seed: int, triage: int, cap: int) -> DataFrame:
    """The first ``cap`` rows of each group in seeded order, with ``stage``: triage for the first ``triage``, else deep.
    Spark keeps only ``cap`` rows a group and task before the shuffle."""
    ranked = seeded_rank(df, group, key, seed).where(F.col("rn") <= cap)
    return ranked.withColumn("stage", F.when(F.col("rn") <= min(triage, cap), F.lit("triage")).otherwise(F.lit("deep")))


def allocate(counts: DataFrame, group: str, n: str, cap: int, within: list[str] | None = None, out: str = "quota") -> DataFrame:
    """Largest-remainder shares of ``cap`` over groups of ``n`` members, in integers: all get their n if the total fits;
    else floor(cap n / total), and what is left goes to the largest remainders, ties by group."""
    w = Window.partitionBy(*(within or [F.lit(0)]))
    total, cap_ = F.sum(n).over(w), F.lit(cap).cast("long")
    df = counts.withColumn("__total", total).withColumn("__q", F.expr(f"({cap} * `{n}`) div greatest(__total, 1)")).withColumn("__r", F.expr(f"({cap} * `{n}`) % greatest(__total, 1)"))
    left = cap_ - F.sum("__q").over(w)
    rank = F.row_number().over(w.orderBy(F.desc("__r"), F.col(group)))
    share = F.when(F.col("__total") <= cap_, F.col(n)).otherwise(F.least(F.col(n), F.col("__q") + (rank <= left).cast("long")))
    return df.withColumn(out, share.cast("long")).drop("__total", "__q", "__r")


def quota_sample(df: DataFrame, within: list[str], group: str, key: str, seed: int, cap: int, floor_cap: int = 0) -> DataFrame:
    """Members of each group up to its share of ``cap``, at least its share of ``floor_cap``: a deep pass after a triage
    pass with the same seed contains it."""
    counts = df.groupBy(*within, group).agg(F.count("*").alias("n"))
    shares = allocate(counts, group, "n", cap, within)
    if floor_cap:
        low = allocate(counts, group, "n", floor_cap, within, "low").drop("n")
        shares = shares.join(low, [*within, group]).withColumn("quota", F.greatest("quota", "low")).drop("low")
    return seeded_rank(df, [*within, group], key, seed).join(shares.drop("n"), [*within, group]).where(F.col("rn") <= F.col("quota")).drop("rn", "quota")


def series_sample(df: DataFrame, group: list[str], series: list[str], key: str, size: str, seed: int, k: int, min_size: int) -> DataFrame:
    """``k`` rows, in seeded order, of each series of more than ``k`` large rows; small rows all stay. ``k`` <= 0 keeps all."""
    if k <= 0:
        return df
    w = Window.partitionBy(*group, *series, "__large")
    large = df.withColumn("__large", F.coalesce(F.col(size) >= min_size, F.lit(False)))
    ranked = large.withColumn("__rn", F.row_number().over(w.orderBy(seeded(seed, *group, key), F.col(key))))
    return ranked.where(~F.col("__large") | (F.col("__rn") <= k)).drop("__large", "__rn")


def budget_prefix(df: DataFrame, group: list[str], unit: str, size: str, position: str, budget: float, out: str = "kept") -> DataFrame:
    """Mark the rows of whole units, the smallest first (ties by first position, then unit), while their running total stays within the budget.

    Units are summed first, so the window runs over units.
    """
    units = df.groupBy(*group, unit).agg(F.sum(size).alias("__size"), F.min(position).alias("__first"))
    w = Window.partitionBy(*group).orderBy("__size", "__first", unit).rowsBetween(Window.unboundedPreceding, 0)
    fit = units.withColumn(out, F.sum("__size").over(w) <= budget).drop("__size", "__first")
    return df.join(fit, [*group, unit])


def budget_stop(df: DataFrame, group: list[str], key: str, size: str, seed: int, budget: float, out: str = "kept") -> DataFrame:
    """Mark rows in seeded order up to the first that would exceed the budget; that one and all later are left out."""
    w = Window.partitionBy(*group).orderBy(seeded(seed, *group, key), F.col(key)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("__sum", F.sum(size).over(w)).withColumn(out, ~F.bool_or(F.col("__sum") > budget).over(w)).drop("__sum")


def _folded(df: DataFrame, group: list[str], order: list[str], used: list[str], begin: Callable[[], list], step: Callable[..., tuple | None], added: T.StructType) -> DataFrame:
    """Pass over each group's rows in order with a state of the group: ``step(state, *used)`` changes the state and gives the
    values of the ``added`` columns, or None to drop the row.

    Rows are sorted in their partitions and stream through, so neither many small groups nor a long one is held in memory.
    A group's rows pass one task: the outcome of each depends on all before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            kept, values = [], [[] for _ in added.fields]
            groups = zip(*[batch.column(c).to_pylist() for c in group], strict=True)
            rows = zip(*[batch.column(c).to_pylist() for c in used], strict=True)
            for i, (now, row) in enumerate(zip(groups, rows, strict=True)):
                if state is None or now != key:
                    key, state = now, begin()
                got = step(state, *row)
                if got is not None:
                    kept.append(i)
                    for v, x in zip(values, got, strict=True):
                        v.append(x)
            out = batch.take(pa.array(kept, pa.int64()))
            more = [pa.array(v, to_arrow_type(f.dataType)) for v, f in zip(values, added.fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*out.columns, *more], names=[*out.schema.names, *[f.name for f in added.fields]])

    rows = df.repartition(*group).sortWithinPartitions(*group, *order)
    return rows.mapInArrow(run, T.StructType([*df.schema.fields, *added.fields]))


def greedy_budget(df: DataFrame, group: list[str], order: list[str], size: str, budget: float) -> DataFrame:
    """Rows that fit, taken in order, skipping those that don't. Null sizes don't fit."""

    def step(state: list, s: float | None) -> tuple | None:
        if s is None or state[0] + s > budget:
            return None
        state[0] += s
        return ()

    return _folded(df, group, order, [size], lambda: [0.0], step, T.StructType())


def capped_fold(df: DataFrame, group: list[str], order: list[str], size: str, images: str, max_opened: int, max_images: int, empty_streak: int, max_size: float, budget: float, out: str = "fetched") -> DataFrame:
    """Mark which nested archives a record fetches, in order, with ``reason`` for those it doesn't: ``size`` and ``budget`` skip
    one archive; ``opened``, ``images`` and ``empty`` end the loop: after ``max_opened``, once it has ``max_images``, or after
    ``empty_streak`` archives without images in a row. Null sizes are skipped."""

    def step(state: list, s: float | None, n: int | None) -> tuple:
        opened, seen, streak, total = state
        stop = "opened" if opened >= max_opened else "images" if seen >= max_images else "empty" if streak >= empty_streak else None
        stop = stop or ("size" if s is None or s > max_size else "budget" if total + s > budget else None)
        if stop is None:
            state[:] = opened + 1, seen + (n or 0), 0 if n else streak + 1, total + s
        return stop is None, stop

    return _folded(df, group, order, [size, images], lambda: [0, 0, 0, 0.0], step, T.StructType([T.StructField(out, T.BooleanType()), T.StructField("reason", T.StringType())]))


def entry_cap(df: DataFrame, group: list[str], order: list[str], cap: int) -> DataFrame:
    """The first ``cap`` rows of a group, with ``n_total`` and ``n_over`` of the group."""
    totals = df.groupBy(*group).agg(F.count("*").alias("n_total")).withColumn("n_over", F.greatest(F.col("n_total") - cap, F.lit(0)))
    first = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__rn") <= cap).drop("__rn")
    return first.join(totals, group)
