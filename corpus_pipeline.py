"""Corpus pipeline: language ID, n-gram Jaccard join, substring dedup, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import common
from sparkloom.llm.bpe import encode_documents
from sparkloom.llm.common import Table, read_table
from sparkloom.llm.decontaminate import without_contaminated
from sparkloom.llm.jaccard_join import jaccard_components
from sparkloom.llm.language_id import identify
from sparkloom.llm.queries import vocabulary
from sparkloom.llm.substring_dedup import dedup_substrings


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def _beside(docs: DataFrame, added: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage(docs)`` with the columns of ``docs``: those that are named like what the operator adds are put aside and keep
    their values."""
    aside = {c: f"__aside_{i}" for i, c in enumerate(docs.columns) if c.lower() in added}
    out = stage(docs.withColumnsRenamed(aside))
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (null text, no letter) go."""
    return _beside(docs, ("lang_pred", "score"), lambda d: identify(d).where("lang_pred <> 'und'"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays. Null doc_ids stay."""
    gone = jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return _columns(docs.join(gone, "doc_id", "left_anti"), docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; documents of which nothing is left go. n_chars follows the text."""

    def stage(d: DataFrame) -> DataFrame:
        out = dedup_substrings(d).where("removed_words < n_words or n_words = 0 or n_words is null")
        if "n_chars" in d.columns:
            changed = F.when(F.col("removed_words") > 0, F.length("text").cast(d.schema["n_chars"].dataType))
            out = out.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
        return out

    return _beside(docs, ("n_words", "removed_words", "removed"), stage)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, as op5 returns them."""
    return encode_documents(docs, *vocabulary())


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: SQL can't express cross-parsing, CGK sampling or BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; between stages the rows are written and read again, and what a stage
    has written for itself is dropped."""
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        before = len(common.TABLES)
        kept = Table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        common.drop_written(before)
        if last:
            last.drop()
        docs, last = kept.df, kept
    return STAGES[-1][1](spark, docs, sf_dir)
