"""From an inventory and a recipe to a placement plan, a descriptor, a log and documents."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import conform_extension, conform_format
from ..functions.text import glob_regex
from ..operators.joins import first_match

# Keys and defaults of a placement.
PLACEMENT_DEFAULTS = {"modality": "other", "role": "raw", "directory_type": "modality"}
AGENT_CONFIDENCE = 0.7


def json_object(text: str | None) -> dict | None:
    """The first JSON object in prose: from each opening brace the decoder is asked; None if none parses."""
    decoder, at = json.JSONDecoder(), -1
    while text and (at := text.find("{", at + 1)) >= 0:
        try:
            found, _ = decoder.raw_decode(text, at)
            return found if isinstance(found, dict) else None
        except ValueError:
            continue
    return None


def recipe(reply: str | None) -> dict | None:
    """task_type, placements, confidence and notes of a model's reply; None without a usable placement."""
    data = json_object(reply) or {}
    raw = data.get("placements")
    placements = [{"glob": str(p["glob"]), "addf_dir": str(p["addf_dir"]), **{k: str(p.get(k, v)) for k, v in PLACEMENT_DEFAULTS.items()}} for p in (raw if isinstance(raw, list) else []) if isinstance(p, dict) and "glob" in p and "addf_dir" in p]
    if not placements:
        return None
    return {"task_type": str(data.get("task_type", "raw")), "placements": placements, "confidence": AGENT_CONFIDENCE, "notes": [str(n) for n in data.get("notes") or [] if isinstance(n, (str, int, float))]}


def inventory(files: DataFrame) -> DataFrame:
    """``files(path, size, depth)`` with ext, reader, modality and readable."""
    ext = conform_extension(F.col("path"))
    return files.withColumn("ext", ext).withColumn("f", conform_format(F.col("ext"))).select("*", "f.*").drop("f")


def placement_plan(files: DataFrame, placements: list[dict]) -> DataFrame:
    """Where each path goes: the first placement whose glob it has, else ``_unplaced``."""
    patterns = [(glob_regex(p["glob"]), p["addf_dir"], p["modality"], p["role"], p["directory_type"]) for p in placements]
    out = first_match(files, "path", patterns, ["target", "modality_out", "role", "directory_type"])
    return out.withColumn("target", F.coalesce("target", F.lit("_unplaced")))


def descriptor(plan: DataFrame) -> DataFrame:
    """A row for each top directory in order of first use: directoryName, directoryType, directoryDescription and its
    subdirectories as an array of structs, also in order of first use."""
    placed = plan.where("ordinal is not null").groupBy("target", "modality_out", "role", "directory_type").agg(F.min(F.struct("ordinal", "path")).alias("first"))
    top, sub = F.split("target", "/", 2)[0], F.get(F.split("target", "/", 2), F.lit(1))
    parts = placed.select(top.alias("top"), sub.alias("sub"), "modality_out", "role", "directory_type", "first")
    subs = parts.where("sub is not null").groupBy("top", "sub").agg(F.min("first").alias("f"), F.min_by(F.struct("modality_out", "role"), "first").alias("m"))
    listed = subs.groupBy("top").agg(F.array_sort(F.collect_list(F.struct("f", F.struct(F.col("sub").alias("directoryName"), F.lit("dataType").alias("directoryType"), F.concat(F.col("m.modality_out"), F.lit(" — "), F.col("m.role"), F.lit(" ("), F.col("sub"), F.lit(")")).alias("directoryDescription")).alias("d")))).alias("l"))
    tops = parts.groupBy("top").agg(F.min("first").alias("first"), F.min_by("modality_out", "first").alias("modality"), F.min_by("directory_type", "first").alias("type"))
    rows = tops.join(listed, "top", "left").orderBy("first")
    return rows.select(F.col("top").alias("directoryName"), F.col("type").alias("directoryType"), F.concat("modality", F.lit(" data")).alias("directoryDescription"), F.transform("l", lambda x: x["d"]).alias("directoryList"))


def validate_tree(described: DataFrame, existing: DataFrame, key: str = "directoryName") -> DataFrame:
    """One row: missing directories, and ok if there are none; readers' failures don't count against it."""
    missing = described.select(key).join(existing.select(key).distinct(), key, "left_anti")
    return missing.agg(F.array_sort(F.collect_list(key)).alias("missing")).select("missing", (F.size("missing") == 0).alias("ok"))


def run_log(results: DataFrame) -> DataFrame:
    """Counts of each status."""
    return results.groupBy("status").agg(F.count("*").alias("n"), F.avg("recipe_confidence").alias("mean_confidence"), F.count_if("validation_ok").alias("n_valid"))


def dataset_document(records: DataFrame) -> DataFrame:
    """A metadata document for each record of (id, metadata struct), and where each field comes from."""
    m = "metadata."
    doc = F.struct(
        F.struct(F.col("id").alias("identifierValue"), F.lit("record").alias("identifierType")).alias("identifier"),
        F.array(F.struct(F.col(m + "title").alias("titleValue"))).alias("title"),
        F.col(m + "creators").alias("creator"),
        F.col(m + "publication_date").alias("publicationDate"),
        F.array_distinct(F.coalesce(m + "keywords", F.expr("cast(array() as array<string>)"))).alias("subject"),
        F.col(m + "license.id").alias("rights"),
    )
    sources = F.create_map(*[x for f, c in (("title", "title"), ("creator", "creators"), ("publicationDate", "publication_date"), ("subject", "keywords"), ("rights", "license")) for x in (F.lit(f), F.when(F.col(m + c).isNotNull(), F.lit(f"metadata.{c}")).otherwise(F.lit("not given")))])
    return records.select("id", doc.alias("doc"), sources.alias("provenance"))
