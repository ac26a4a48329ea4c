"""What to work on next: scope, order by cost, requests, and what is kept afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import greedy_budget
from .strata import EYE_CLASSES

# Nominal bytes of a zip that is read by ranges; largest inflated member; reasons of refusal for lack of room;
# HTTP statuses that are worth another try; access that isn't public.
ZIP_COST, INFLATED_MAX = 50e6, 4 << 30
ROOM_REASONS = r"^(--keep-max-gb|disk:)"
RETRY_STATUSES = (429, 500, 502, 503, 504)


def in_scope(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed; a list with repeats counts once."""
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def refused_for_room(kept: Column, reason: Column) -> Column:
    return F.coalesce((kept == F.lit(False)) & reason.rlike(ROOM_REASONS), F.lit(False))


def retryable(status: Column) -> Column:
    return F.coalesce(status.isin(*RETRY_STATUSES), F.lit(False))


def oversize(transfer: Column, inflated: Column, limit: int) -> Column:
    """Whether a member is too large to sample: by what is transferred, or once it is inflated."""
    return (transfer > limit) | (inflated > max(limit, INFLATED_MAX))


def frame_counts(members: DataFrame, group: list[str], transfer: str, inflated: str, limit: int) -> DataFrame:
    """For each group n_over, n_empty and n_in_frame: members too large, of no bytes, and those a sample may draw."""
    over, empty = F.coalesce(oversize(F.col(transfer), F.col(inflated), limit), F.lit(False)), F.coalesce(F.col(inflated) <= 0, F.lit(True))
    return members.groupBy(*group).agg(F.count_if(over).alias("n_over"), F.count_if(empty).alias("n_empty"), F.count_if(~over & ~empty).alias("n_in_frame"))


def costs(files: DataFrame, record: list[str], size: str, route: str, cap: float) -> DataFrame:
    """Bytes that a record is expected to move: files that are fetched whole, up to the cap, and a nominal size for each zip
    that is read by ranges. ``route`` is as ``joins.route`` gives it."""
    whole = F.coalesce(F.sum(F.when(F.col(route) == "fetch", F.col(size))).cast("double"), F.lit(0.0))
    return files.groupBy(*record).agg((F.least(F.lit(float(cap)), whole) + ZIP_COST * F.count_if(F.col(route) == "remote_zip")).alias("cost"))


def work_order(todo: DataFrame, cost: DataFrame, refetch: DataFrame, key: str, position: str) -> DataFrame:
    """``todo`` with cost and rank: rows that are fetched again come first, in the order of ``refetch(key, rank)``; the
    rest by cost (unknown: 0), then position. The rank is a range-partitioned sort's, without one task for all rows."""
    first = refetch.groupBy(key).agg(F.min("rank").alias("refetch_rank"))
    rows = todo.join(cost, key, "left").join(first, key, "left").withColumn("cost", F.coalesce("cost", F.lit(0.0)))
    return rows.orderBy(F.col("refetch_rank").asc_nulls_last(), F.when(F.col("refetch_rank").isNull(), F.col("cost")), F.col(position))


def head(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first rows, all without a limit."""
    return rows if limit is None else rows.limit(limit)


def requests(pending: DataFrame, scope: DataFrame, served: DataFrame, key: str, time: str, fill: dict[str, Column]) -> DataFrame:
    """The oldest pending request of each key that isn't served yet, with the scope's columns; ``fill`` gives those of keys
    outside the scope. Requests that tie in time should be equal."""
    rest = [c for c in pending.columns if c not in (key, time)]
    oldest = pending.groupBy(key).agg(F.min_by(F.struct(time, *rest), F.struct(time, *rest)).alias("__r")).select(key, "__r.*")
    rows = oldest.join(served.select(key).distinct(), key, "left_anti").join(scope, key, "left")
    return rows.withColumns({c: F.coalesce(F.col(c), v) for c, v in fill.items()})


def not_fetched(sampled: DataFrame, fetched: DataFrame, keys: list[str]) -> DataFrame:
    """Sampled members with ``reused``: whether an earlier pass has fetched them."""
    return sampled.join(fetched.select(*keys).distinct().withColumn("__f", F.lit(True)), keys, "left").withColumn("reused", F.coalesce("__f", F.lit(False))).drop("__f")


def done_since(rows: DataFrame, markers: DataFrame, key: str, finished: str, marked: str, slack: int = 1) -> DataFrame:
    """Markers whose record was finished at or after the mark, up to ``slack`` seconds before it."""
    last = rows.groupBy(key).agg(F.max(finished).alias("__t"))
    return markers.join(last, key).where(F.unix_timestamp("__t") >= F.unix_timestamp(marked) - slack).drop("__t")


def eye_images(counts: dict[str, Column]) -> Column:
    """Images of eye classes in a row; what isn't a number counts as none."""
    out = F.lit(0).cast("long")
    for c in EYE_CLASSES:
        if c in counts:
            out = out + F.coalesce(counts[c].try_cast("long"), F.lit(0))
    return out


def predicted_eye_images(predictions: DataFrame, record: str, label: str) -> DataFrame:
    """Predictions of eye classes of each record."""
    return predictions.groupBy(record).agg(F.count_if(F.col(label).isin(*EYE_CLASSES)).alias("n_eye_pred"))


def keep_decisions(rows: DataFrame, group: list[str], order: list[str], n_eye: str, skip: Column, need: str, free: Column, cap: float) -> DataFrame:
    """Add kept and reason to finished records, in the order they finish: none without eye images, none that is skipped, none
    that would take what is kept over the cap (what is refused takes no room), none that the disk lacks room for.

    The running total depends on earlier decisions, so candidates are folded in order; a group is one keep folder.
    """
    fits = rows.where((F.col(n_eye) > 0) & ~skip & (F.col(need) <= free))
    kept = greedy_budget(fits.select(*group, *order, need), group, order, need, cap).select(*group, *order).withColumn("__kept", F.lit(True))
    reason = (
        F.when(F.coalesce(F.col(n_eye), F.lit(0)) <= 0, "no eye image").when(skip, "skipped").when(F.col(need) > free, "disk")
        .when(F.col("__kept").isNull(), "cap").otherwise("")
    )
    return rows.join(kept, [*group, *order], "left").withColumn("reason", reason).withColumn("kept", F.col("reason") == "").drop("__kept")


def keep_totals(markers: DataFrame, measured: DataFrame, key: str) -> DataFrame:
    """Bytes of each kept record: its marker's, else what was measured."""
    rows = measured.join(markers, key, "full")
    return rows.select(key, F.coalesce("bytes_total", "bytes_measured", F.lit(0)).alias("bytes"))


def backfill(last: DataFrame, predictions: DataFrame, refused: DataFrame, kept: DataFrame, key: str, budget: float | None = None) -> DataFrame:
    """Records to fetch again so that they can be kept -> key, n_eye, bytes, before, rank, chosen.

    ``last(key, final, has_kept, n_eye, n_classified, nothing_fetched)`` are the last rows: those that are final, without a
    word on keeping, and have eye images by their own counts or by ``predictions(key, n_eye_pred)``; ``refused(key, n_eye,
    bytes)`` were refused for lack of room. Records that are ``kept`` are left out. Order: before keeping existed first,
    most eye images, fewest bytes, shortest id, id. ``chosen``: in that order as long as bytes fit in the budget.
    """
    old = last.where(F.col("final") & ~F.col("has_kept") & ~F.coalesce(F.col("nothing_fetched"), F.lit(False)))
    seen = old.join(predictions, key, "left").where((F.col("n_eye") > 0) | ((F.col("n_classified") > 0) & (F.coalesce("n_eye_pred", F.lit(0)) > 0)))
    sizes = refused.groupBy(key).agg(F.max("n_eye").alias("n_eye"), F.max("bytes").alias("bytes")).where("n_eye > 0 and bytes > 0")
    ids = seen.select(key, F.lit(True).alias("before")).join(sizes, key, "full").join(kept.select(key).distinct(), key, "left_anti")
    ids = ids.select(key, F.coalesce("n_eye", F.lit(0)).cast("long").alias("n_eye"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), F.coalesce("before", F.lit(False)).alias("before"))
    order = [(~F.col("before")).cast("int").alias("o1"), (-F.col("n_eye")).alias("o2"), F.col("bytes").alias("o3"), F.length(F.col(key).cast("string")).alias("o4")]
    rows = ids.select("*", *order, F.lit(0).alias("__all"))
    if budget is None:
        return rows.drop("o1", "o2", "o3", "o4", "__all").withColumn("chosen", F.lit(True))
    free = rows.where("bytes = 0").select(key)  # these always fit
    picked = greedy_budget(rows.where("bytes > 0").select("__all", "o1", "o2", "o3", "o4", key, "bytes"), ["__all"], ["o1", "o2", "o3", "o4", key], "bytes", budget).select(key)
    chosen = free.union(picked).withColumn("chosen", F.lit(True))
    return rows.drop("o1", "o2", "o3", "o4", "__all").join(chosen, key, "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))


def access_requests(rows: DataFrame, key: str, relevant: Column, public: Column, p: str) -> DataFrame:
    """Records of interest whose files aren't public, with ``rank``: highest probability first (none last), then by number
    and text of the id. The ranked list is the report, as long as its records."""
    some = rows.where(F.coalesce(relevant, F.lit(False)) & ~F.coalesce(public, F.lit(False)))
    return some.withColumn("rank", F.row_number().over(Window.orderBy(F.col(p).desc_nulls_last(), F.coalesce(F.col(key).cast("string").try_cast("bigint"), F.lit(0)), F.col(key).cast("string"))))
