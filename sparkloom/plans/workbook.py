"""The twelve tables of a survey's workbook, from one row per record. A table is a plan; ``sinks.workbook`` writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.documents import flat_map, human_size
from ..operators.aggregates import explode_counts, formats
from ..operators.review import likely_false_positive

#: Control characters that a cell can't hold.
ILLEGAL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
CELL_CHARS = 32_000


def in_order(rows: DataFrame, key: str = "record_id", position: str | None = None) -> DataFrame:
    """Numeric ids ascending, then the others by position, or by id."""
    number = F.col(key).try_cast("bigint")
    return rows.orderBy(number.isNull(), number, position or key)


def cells(rows: DataFrame) -> DataFrame:
    """Every column as a cell holds it: texts without control characters and cut, maps as ``k: v; ...``, arrays joined, structs as
    JSON."""

    def cell(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType):
            c = F.when(c.isNotNull(), flat_map(c))
        elif isinstance(f.dataType, T.ArrayType):
            inner = (lambda x: F.to_json(x)) if isinstance(f.dataType.elementType, (T.StructType, T.MapType, T.ArrayType)) else (lambda x: x.cast("string"))
            c = F.array_join(F.transform(c, inner), "; ")
        elif isinstance(f.dataType, T.StructType):
            c = F.to_json(c)
        elif not isinstance(f.dataType, T.StringType):
            return c.alias(f.name)
        return F.substring(F.regexp_replace(c, ILLEGAL, ""), 1, CELL_CHARS).alias(f.name)

    return rows.select(*[cell(f) for f in rows.schema.fields])


def summary(records: DataFrame) -> DataFrame:
    """One row: n, n_classified, n_eye, n_mask_dominated, n_kept, kept_bytes, n_documents, and records by status and by pass."""
    kept = F.coalesce(F.col("kept"), F.lit(False))
    one = records.agg(
        F.count("*").alias("n"), F.count_if(F.col("n_classified") > 0).alias("n_classified"), F.count_if(F.size("present") > 0).alias("n_eye"), F.count_if("mask_dominated").alias("n_mask_dominated"),
        F.count_if(kept).alias("n_kept"), F.coalesce(F.sum(F.when(kept, F.col("kept_bytes"))), F.lit(0)).alias("kept_bytes"), F.count("document").alias("n_documents"),
    )
    by = lambda c: records.groupBy(F.coalesce(c, F.lit("(none)")).alias("k")).agg(F.count("*").alias("n")).agg(F.coalesce(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))), F.create_map().cast("map<string,bigint>")).alias(f"by_{c}"))
    return one.crossJoin(by("status")).crossJoin(by("sampling_pass"))  # one row each


def readme(counts: DataFrame) -> DataFrame:
    """(position, key, value) of the summary: totals, then a line for each status and pass."""
    total = lambda label, c: F.struct(F.lit(label).alias("key"), c.cast("string").alias("value"))
    lines = lambda label, m: F.transform(F.map_entries(m), lambda e: F.struct(F.concat(F.lit(f"{label}: "), e["key"]).alias("key"), e["value"].cast("string").alias("value")))
    fixed = F.array(
        total("Records", F.col("n")), total("Records with classified images", F.col("n_classified")), total("Records with an eye modality", F.col("n_eye")),
        total("Records whose images are mostly masks", F.col("n_mask_dominated")), total("Records whose fetched files were kept", F.col("n_kept")), total("Bytes kept", human_size(F.col("kept_bytes"))),
        total("Records with documents", F.col("n_documents")),
    )
    return counts.select(F.posexplode(F.concat(fixed, lines("Status", F.col("by_status")), lines("Pass", F.col("by_sampling_pass")))).alias("position", "x")).select("position", "x.*")


def record_classes(records: DataFrame) -> DataFrame:
    """A row for each class of each record: n, mean_conf and the share of the record's classified images."""
    rows = records.select("record_id", "n_classified", F.explode("classes").alias("class", "c"))
    return rows.select("record_id", "class", F.col("c.n").alias("n"), F.col("c.conf").alias("mean_conf"), (F.col("c.n") / F.when(F.col("n_classified") > 0, F.col("n_classified"))).alias("share"))


def schema_fields(records: DataFrame) -> DataFrame:
    """For each field of the documents how many records fill it, and the sources, most frequent first, ties by name."""
    counts = records.select(F.explode("provenance").alias("field", "source")).groupBy("field", "source").agg(F.count("*").alias("n"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "source")))
    return counts.groupBy("field").agg(F.sum("n").alias("n_filled"), F.array_join(F.transform(order, lambda x: F.concat(x["source"], F.lit(" ("), (-x["n"]).cast("string"), F.lit(")"))), "; ").alias("sources"))


def training_summary(sources: DataFrame) -> DataFrame:
    """A text for each model_version of ``sources(position, model_version, source_id, class, train_n, test_n, synthetic, role,
    policy)``, in order of first appearance: rows, classes, images, and the sources that are synthetic, only evaluated on, or
    trained on against their policy."""
    listed = lambda cond: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("position", F.coalesce("source_id", F.lit("?")).alias("s"))))), lambda x: x["s"])
    policy = F.coalesce(F.nullif(F.col("policy"), F.lit("")), F.lit("allowed"))
    g = sources.groupBy(F.coalesce(F.nullif(F.col("model_version"), F.lit("")), F.lit("(none)")).alias("model_version")).agg(
        F.min("position").alias("first"), F.count("*").alias("n"), F.array_sort(F.collect_set(F.when(F.col("class") != "", F.col("class")))).alias("classes"), F.coalesce(F.sum("train_n"), F.lit(0)).alias("train"), F.coalesce(F.sum("test_n"), F.lit(0)).alias("test"),
        listed(F.lower("synthetic").isin("yes", "true", "1")).alias("synthetic"), listed(F.col("role").startswith("eval_only")).alias("evaluated"), listed((policy != "allowed") & (F.col("train_n") > 0)).alias("flagged"),
    )
    some = lambda c, label: F.when(F.size(c) > 0, F.concat(F.lit(f"; {label}: "), F.array_join(c, ", "))).otherwise("")
    classes = F.when(F.size("classes") > 0, F.concat(F.lit(" over "), F.size("classes").cast("string"), F.lit(" classes ("), F.array_join("classes", ", "), F.lit(")"))).otherwise("")
    text = F.concat(
        "model_version", F.lit(": "), F.col("n").cast("string"), F.lit(" source rows"), classes, F.lit(", "), F.col("train").cast("string"), F.lit(" training images, "), F.col("test").cast("string"), F.lit(" test images"),
        some("synthetic", "synthetic"), some("evaluated", "evaluation only (never trained on)"), some("flagged", "trained on sources not cleared by license policy"),
    )
    return g.select("model_version", "first", text.alias("text"))


def sheets(records: DataFrame, requests: DataFrame, training: DataFrame) -> dict[str, DataFrame]:
    """All tables by name. ``records(record_id, status, sampling_pass, n_classified, present array, classes map<class, struct<n, conf>>,
    mask_dominated, eye_image_fraction, setfit_label, weblinks and probes array<struct>, formats_classified and formats_unread
    map, kept, kept_bytes, document, provenance map, and columns dicom_*)``; ``requests`` and ``training`` as they are listed."""
    why = likely_false_positive(F.col("status"), F.col("present"), F.col("setfit_label"), F.col("eye_image_fraction"))
    listed = records.withColumn("review_likely_false_positive", why).where("review_likely_false_positive <> ''")
    nested = ("weblinks", "probes", "document", "provenance", "classes")
    counts = explode_counts(records, ["record_id"], {"classified": "formats_classified", "unread": "formats_unread"})
    dicom = [c for c in records.columns if c.startswith("dicom_")]
    return {
        "README": readme(summary(records)),
        "Records": in_order(cells(records.drop(*nested))),
        "Record_Classes": in_order(record_classes(records)),
        "Weblinks": in_order(records.select("record_id", F.explode("weblinks").alias("x")).select("record_id", "x.*")),
        "Archive_Probes": in_order(records.select("record_id", F.explode("probes").alias("x")).select("record_id", "x.*")),
        "Review_Likely_FP": in_order(cells(listed.select("record_id", "status", "review_likely_false_positive", "present", "eye_image_fraction", "n_classified", "setfit_label", "kept"))),
        "DICOM_Mapping": in_order(cells(records.select("record_id", *dicom))),
        "Schema_Fields": schema_fields(records).orderBy("field"),
        "CMDS_JSON": in_order(cells(records.where("document is not null").select("record_id", "document"))),
        "Formats": formats(counts, "record_id"),
        "Access_Requests": requests,
        "Model_Training_Datasets": training,
    }
