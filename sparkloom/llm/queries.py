"""Queries over the driver's tables, one for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents
from .chat import chat_digests, format_chats
from .common import read_table
from .decontaminate import contaminated
from .embedding_dedup import near_duplicates
from .jaccard_join import jaccard_components
from .language_id import held_out, identify
from .sharding import shard_documents
from .substring_dedup import dedup_substrings
from .url_filter import judge
from .warc import archive_and_read

ODD_CHAT = "\\### Assistant: </turn> ok"
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", ODD_CHAT), (-7, 1, "assistant", ODD_CHAT)], "conv_id long, turn long, role string, text string")
    return chat_digests(format_chats(turns.unionByName(odd)))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(read_table(spark, sf_dir, "pages")).drop("payload", "url")


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and pattern of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), *vocabulary())


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    bad = labels.select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int").alias("bad"))
    return judge(read_table(spark, sf_dir, "pages"), RULES, bad).select("page_id", "host", "path", "rule", "verdict")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), train=docs).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


QUERIES = {"op1_chat_formatting": op1_chat_formatting, "op2_embedding_dedup": op2_embedding_dedup, "op3_sharding": op3_sharding, "op4_warc": op4_warc, "op5_bpe": op5_bpe, "op6_url_filter": op6_url_filter, "op7_jaccard_join": op7_jaccard_join, "op8_decontamination": op8_decontamination, "op9_substring_dedup": op9_substring_dedup, "op10_language_id": op10_language_id}
