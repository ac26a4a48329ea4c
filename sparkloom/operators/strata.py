"""Stratified class fractions and the rules that turn them into record decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The classes in their declared order, which decides ties, and the labels that are no modality.
CLASSES = ["CFP", "IR", "PSC", "FAF", "OCT", "OCTA", "NEG"]
EYE_CLASSES = CLASSES[:6]
UNCERTAIN, MASK = "UNCERTAIN", "MASK"
MASK_DOMINATED_FRAC, MASK_DOMINATED_MIN_NON_MASK = 0.5, 50
MASK_EXEMPT_MIN_IMAGES, MASK_EXEMPT_MIN_CONF = 10, 0.75


def stratum_weights(rows: DataFrame, record: list[str], stratum: str, population: str, out: str = "w") -> DataFrame:
    """Weight of each row: max(population, k) / k of its stratum with k rows; 1 where a record has one stratum only.

    Counts are aggregated and joined back, so a large stratum doesn't meet in one window.
    """
    k = rows.groupBy(*record, stratum).agg(F.count("*").alias("__k"), F.max(population).alias("__p"))
    n = k.groupBy(*record).agg(F.count("*").alias("__n"))
    weight = F.when(F.col("__n") > 1, F.greatest(F.coalesce(F.col("__p").cast("double"), F.col("__k").cast("double")), F.col("__k").cast("double")) / F.col("__k")).otherwise(1.0)
    return rows.join(k.join(n, record).select(*record, stratum, weight.alias(out)), [*record, stratum])


def label_fractions(rows: DataFrame, record: list[str], label: str, labels: list[str], weight: str = "w") -> DataFrame:
    """For each record: n, and for each label n_<label> (raw count), w_<label> (weighted) and frac_<label>."""
    is_ = lambda c: F.col(label) == c
    sums = [F.count("*").alias("n"), F.sum(weight).alias("w_total")]
    for c in labels:
        sums += [F.count_if(is_(c)).alias(f"n_{c}"), F.sum(F.when(is_(c), F.col(weight)).otherwise(0.0)).alias(f"w_{c}")]
    out = rows.groupBy(*record).agg(*sums)
    return out.withColumns({f"frac_{c}": F.col(f"w_{c}") / F.col("w_total") for c in labels})


def dominant(counts: dict[str, Column]) -> Column:
    """The label with the largest count; ties go to the first in the dict; null if every count is zero."""
    best = F.array_max(F.array(*[F.struct(F.coalesce(c.cast("double"), F.lit(0.0)).alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("name")) for i, (name, c) in enumerate(counts.items())]))
    return F.when(best["n"] > 0, best["name"])


def dominant_rows(rows: DataFrame, record: list[str], label: str, weight: str, order: list[str]) -> DataFrame:
    """Dominant label of each record from long rows, by a pre-aggregated sum and max."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col(label)), F.lit(0))
    sums = rows.where(F.col(label).isin(*order)).groupBy(*record, label).agg(F.sum(weight).alias("__n"))
    best = F.max_by(F.col(label), F.struct(F.col("__n"), -rank))
    return sums.where("__n > 0").groupBy(*record).agg(best.alias("dominant"), F.max("__n").alias("dominant_n"))


def present(counts: dict[str, Column], weights: dict[str, Column], total: Column, min_class: float, min_all: float) -> Column:
    """Labels with a raw count of at least 1 and a weighted share of at least ``min_class``, if all together reach ``min_all``."""
    share = lambda c: F.when(total > 0, weights[c] / total).otherwise(0.0)
    every = reduce(lambda a, b: a + b, [share(c) for c in counts])
    listed = F.filter(F.array(*[F.when((counts[c] >= 1) & (share(c) >= min_class), F.lit(c)) for c in counts]), lambda x: x.isNotNull())
    return F.when((total > 0) & (every >= min_all), listed).otherwise(F.expr("cast(array() as array<string>)"))


def mask_exempt(rows: DataFrame, record: list[str], label: str, confidence: str, classes: list[str], min_n: int = MASK_EXEMPT_MIN_IMAGES, min_conf: float = MASK_EXEMPT_MIN_CONF) -> DataFrame:
    """The class that exempts a record: of those with enough rows and mean confidence the most rows; ties by class order."""
    rank = F.array_position(F.array(*map(F.lit, classes)), F.col(label))
    groups = rows.where(F.col(label).isin(*classes)).groupBy(*record, label).agg(F.count("*").alias("__n"), F.avg(confidence).alias("__c"))
    return groups.where((F.col("__n") >= min_n) & (F.col("__c") >= min_conf)).groupBy(*record).agg(F.max_by(F.col(label), F.struct("__n", -rank)).alias("exempt"))


def mask_dominated(frac_mask: Column, n_non_mask: Column, exempt: Column) -> Column:
    return F.coalesce((frac_mask >= MASK_DOMINATED_FRAC) & (n_non_mask < MASK_DOMINATED_MIN_NON_MASK) & exempt.isNull(), F.lit(False))


def cascade(rules: list[tuple[Column, str]], otherwise: str | None) -> Column:
    """The value of the first rule that holds."""
    first, *rest = rules
    out = F.when(first[0], F.lit(first[1]))
    for cond, value in rest:
        out = out.when(cond, F.lit(value))
    return out.otherwise(F.lit(otherwise))


def mean_vector(rows: DataFrame, record: list[str], vector: str, size: int, weight: str) -> DataFrame:
    """Weighted mean of each of the first ``size`` components: mean_0, mean_1, ..."""
    total = F.sum(weight)
    return rows.groupBy(*record).agg(*[(F.sum(F.col(weight) * F.col(vector)[i]) / total).alias(f"mean_{i}") for i in range(size)])


def softmax(logits: Column) -> Column:
    """Exponentials of the differences from the maximum, divided by their sum."""
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def thresholded(probs: Column, classes: list[str], threshold: float) -> tuple[Column, Column, Column]:
    """Top class, its probability, and the label: the top class, or UNCERTAIN below the threshold."""
    p = F.array_max(probs)
    top = F.get(F.array(*map(F.lit, classes)), F.array_position(probs, p).cast("int") - 1)
    return top, p, F.when(p >= threshold, top).otherwise(F.lit(UNCERTAIN))


def estimates(population: Column, fraction: Column) -> Column:
    """Population times fraction, to the nearest even on ties."""
    return F.bround(population * fraction).cast("long")


def rank_of(label: Column, order: list[str]) -> Column:
    return F.array_position(F.array(*map(F.lit, order)), label)


def first_seen(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Distinct keys with their first position."""
    return df.groupBy(*keys).agg(F.min(position).alias("first_pos"))


def numbered(df: DataFrame, group: list[str], order: list[str | Column], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
