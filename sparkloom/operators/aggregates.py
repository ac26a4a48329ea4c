"""Rollups with declared order: counts as maps and texts, inventories, link catalogues, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import top_text


def top_counts(df: DataFrame, group: list[str], value: str, position: str, n: int = 3, out: str = "top") -> DataFrame:
    """``a (5); b (2)`` of the most frequent non-empty values of each group; ties by first appearance.

    Values are counted before they are collected, and a group collects only its distinct values.
    """
    counts = df.where(F.col(value).isNotNull() & (F.col(value).cast("string") != "")).groupBy(*group, value).agg(F.count("*").alias("n"), F.min(position).alias("first"))
    best = counts.withColumn("__r", F.expr(f"row_number() OVER (PARTITION BY {', '.join(f'`{g}`' for g in group)} ORDER BY n DESC, first, `{value}`)")).where(F.col("__r") <= n)
    return best.groupBy(*group).agg(top_text(F.collect_list(F.struct("n", "first", F.col(value).alias("k"))), n).alias(out))


def count_map(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """map<value, count> of each group."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "n")))).alias(out))


def explode_counts(df: DataFrame, keys: list[str], maps: dict[str, str]) -> DataFrame:
    """Rows (keys, kind, name, n) from several columns of counts; ``maps``: kind -> column."""
    parts = [df.select(*keys, F.lit(kind).alias("kind"), F.explode(c).alias("name", "n")) for kind, c in maps.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def formats(exploded: DataFrame, record: str) -> DataFrame:
    """For each kind and name the images and the records, most images first."""
    return exploded.groupBy("kind", "name").agg(F.sum("n").alias("images"), F.count_distinct(record).alias("records")).orderBy(F.desc("images"), "kind", "name")


def inventory(files: DataFrame, group: list[str], size: str, depth: str, modality: str, ext: str, readable: str) -> DataFrame:
    """Count, bytes, depth, readable count and the unreadable extensions of each group."""
    return files.groupBy(*group).agg(
        F.count("*").alias("n_files"),
        F.sum(size).alias("total_bytes"),
        F.max(depth).alias("max_depth"),
        F.count_if(F.col(readable)).alias("n_readable"),
        F.count_distinct(modality).alias("n_modalities"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col(readable), F.col(ext)))), ",").alias("unreadable_exts"),
    )


def merge_links(links: DataFrame, record: list[str], key: str, url: str, origin: str, kind: str, position: str) -> DataFrame:
    """One row for each record and link key: the first link as written, its origins in order of first appearance, the
    first type that isn't null."""
    origins = links.groupBy(*record, key, origin).agg(F.min(position).alias("p"), F.min_by(url, position).alias("u"), F.min_by(kind, F.when(F.col(kind).isNotNull(), F.col(position))).alias("t"), F.min(F.when(F.col(kind).isNotNull(), F.col(position))).alias("tp"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("p", F.col(origin).alias("o")))), lambda x: x["o"])
    return origins.groupBy(*record, key).agg(F.min_by("u", "p").alias("url"), F.array_join(texts, "; ").alias("origins"), F.min_by("t", "tp").alias("kind"), F.min("p").alias("first_pos"))


def provenance(df: DataFrame, record: str, fields: dict[str, str]) -> DataFrame:
    """For each field how many rows fill it and which sources they name; ``fields``: field -> column of its source."""
    parts = [df.select(F.lit(f).alias("field"), (F.col(f).isNotNull() & (F.col(f).cast("string") != "")).cast("int").alias("filled"), F.col(s).cast("string").alias("source")) for f, s in fields.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    used = F.array_join(F.array_sort(F.collect_set(F.when(F.col("filled") == 1, F.col("source")))), ", ")
    return out.groupBy("field").agg(F.sum("filled").alias("n_filled"), used.alias("sources"))


def counters(df: DataFrame, dimensions: dict[str, str]) -> DataFrame:
    """(counter, n): a counter ``prefix_value`` for each value of each dimension; ``dimensions``: prefix -> column."""
    pairs = F.array(*[F.concat(F.lit(f"{prefix}_"), F.coalesce(F.col(c).cast("string"), F.lit("none"))) for prefix, c in dimensions.items()])
    return df.select(F.explode(pairs).alias("counter")).groupBy("counter").agg(F.count("*").alias("n"))
