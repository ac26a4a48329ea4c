"""Attributes of image classes in DICOM's terms, and the rollup of sampled images to records.

Values are counted per record, attribute and value before anything is ranked, so an attribute that all images share sends one
row from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.documents import bits_allocated, samples_per_pixel
from ..functions.text import laterality, range_text
from .review import octa_slab

# Storage classes, and coded terms as "scheme value meaning".
OP8 = ("1.2.840.10008.5.1.4.1.1.77.1.5.1", "Ophthalmic Photography 8 Bit Image Storage")
OP16 = ("1.2.840.10008.5.1.4.1.1.77.1.5.2", "Ophthalmic Photography 16 Bit Image Storage")
OPT = ("1.2.840.10008.5.1.4.1.1.77.1.5.4", "Ophthalmic Tomography Image Storage")
OPTENF = ("1.2.840.10008.5.1.4.1.1.77.1.5.7", "Ophthalmic Optical Coherence Tomography En Face Image Storage")
OTHER = ("1.2.840.10008.5.1.4.1.1.7", "Secondary Capture Image Storage")
RETINA, DISC, ANTERIOR = "SCT 5665001 Retina", "SCT 81016008 Optic nerve head", "SCT 31636006 Anterior chamber of eye"
CAMERA, SLO, SCANNER = "SCT 409898007 Fundus Camera", "SCT 392001008 Scanning Laser Ophthalmoscope", "SCT 392012008 Optical Coherence Tomography Scanner"
GREEN = "SCT 445465004 Green optical filter"
# Fixed values by class: modality, storage class, image type, body part, anatomy, device, light path filter, channels, illumination.
ATTRIBUTES = {
    "CFP": ("OP", OP8, r"ORIGINAL\PRIMARY\\COLOR", "EYE", RETINA, CAMERA, "DCM 111609 No filter", "", "DCM 111625 Diffuse direct illumination"),
    "IR": ("OP", OP8, r"ORIGINAL\PRIMARY", "EYE", RETINA, SLO, "SCT 445169002 Infrared optical filter", "SCT 414497003 Infrared", ""),
    "PSC": ("OP", OP8, r"ORIGINAL\PRIMARY", "EYE", RETINA, SLO, "", "SCT 371240000 Red; SCT 371246006 Green", ""),
    "FAF": ("OP", OP8, r"ORIGINAL\PRIMARY", "EYE", RETINA, SLO, "SCT 445084008 Blue optical filter", "", ""),
    "OCT": ("OPT", OPT, r"ORIGINAL\PRIMARY", "EYE", RETINA, SCANNER, "", "", ""),
    "OCTA": ("OPTENF", OPTENF, r"DERIVED\PRIMARY", "EYE", RETINA, SCANNER, "", "", ""),
    "NEG": ("OT", OTHER, r"DERIVED\SECONDARY", "", "", "", "", "", ""),
}
NAMES = ("modality", "sop", "image_type", "body_part", "anatomy", "device", "filter", "channels", "illumination")
# Makers of flash autofluorescence; words for parts of the eye, in paths and in prose.
FLASH_MAKERS = "(?i)topcon|canon|kowa|visucam"
ANTERIOR_PATH = r"anterior[ _-]?(?:segment|chamber)|cornea|(?:^|[^a-z])as-?oct(?:[^a-z]|$)|iridocorneal"
ANTERIOR_TEXT = r"anterior[ -]segment|\bas-?oct\b|anterior chamber|\bcorneal oct\b|iridocorneal angle"
DISC_PATH = r"(?:^|[^a-z])onh(?:[^a-z]|$)|optic[ _-]?(?:disc|disk|nerve)|rnfl|peripapillary"
DISC_TEXT = r"\bperipapillary\b|\bcircumpapillary\b|optic nerve head (?:oct|scans?|cubes?|volumes?)|\bonh[ -]oct\b|optic dis[ck] (?:oct|scans?|cubes?|volumes?)"


def class_attributes(cls: Column, bits: Column, maker: Column, paths: Column, text: Column, blue_zero_share: Column) -> Column:
    """struct of NAMES, sop_name, ophthalmic_type and samples_used of a class's images; null for a label that is no class.
    ``paths``: those of the class's own images; ``text``: the record's words, of which only set phrases count."""
    table = F.create_map(*[x for c, v in ATTRIBUTES.items() for x in (F.lit(c), F.struct(*[F.lit(y[0] if isinstance(y, tuple) else y).alias(n) for y, n in zip(v, NAMES, strict=True)]))])
    a = F.try_element_at(table, cls)
    path, prose, who = (F.lower(F.coalesce(c, F.lit(""))) for c in (paths, text, maker))
    deep = (bits > 8) & (bits <= 16) & (a["sop"] == OP8[0])
    sop = F.when(deep, F.lit(OP16[0])).otherwise(a["sop"])
    names = F.create_map(*[F.lit(x) for pair in (OP8, OP16, OPT, OPTENF, OTHER) for x in pair])
    anatomy = (
        F.when(cls != "OCT", a["anatomy"])
        .when(path.rlike(ANTERIOR_PATH) | prose.rlike(ANTERIOR_TEXT), ANTERIOR)
        .when(path.rlike(DISC_PATH) | prose.rlike(DISC_TEXT), DISC)
        .otherwise(a["anatomy"])
    )
    zero = F.coalesce(blue_zero_share >= 0.5, F.lit(False))
    parts = {
        **{n: a[n] for n in NAMES},
        "sop": sop,
        "anatomy": anatomy,
        "device": F.when((cls == "FAF") & who.rlike(FLASH_MAKERS), CAMERA).otherwise(a["device"]),
        "filter": F.when((cls == "FAF") & who.contains("optos"), GREEN).otherwise(a["filter"]),
        "channels": F.when((cls == "PSC") & ~zero, "").otherwise(a["channels"]),
        "sop_name": F.try_element_at(names, sop),
        "ophthalmic_type": F.when(cls == "OCTA", octa_slab(paths, text)).otherwise(""),
        "samples_used": F.when((cls == "PSC") & zero, 2),
    }
    return F.when(a.isNotNull(), F.struct(*[c.alias(n) for n, c in parts.items()]))


def modality_of(cls: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for c, v in ATTRIBUTES.items() for x in (c, v[0])]), cls)


def top_values(rows: DataFrame, record: list[str], position: str, columns: dict[str, int]) -> DataFrame:
    """For each record a text ``a (5); b (2)`` of the most frequent values of each column, up to its number; ties by first
    appearance; nulls and empty texts don't count.

    Rows that are alike are counted before they move; then all rows of a record are in one task, and ranking moves nothing."""
    names = list(columns)
    alike = rows.groupBy(*record, *[F.col(c).cast("string").alias(c) for c in names]).agg(F.count("*").alias("__n"), F.min(position).alias("__first"))
    alike = alike.repartition(*[F.col(c) for c in record])
    pairs = F.explode(F.array(*[F.when(F.col(c) != "", F.struct(F.lit(i).alias("name"), F.col(c).alias("value"))) for i, c in enumerate(names)]))
    counts = alike.select(*record, "__n", "__first", pairs.alias("p")).where("p is not null").groupBy(*record, "p.name", "p.value").agg(F.sum("__n").alias("n"), F.min("__first").alias("first"))
    best = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*record, "name").orderBy(F.desc("n"), "first"))).where(F.col("rank") <= max(columns.values()))
    best = best.where(" or ".join(f"(name = {i} and rank <= {n})" for i, n in enumerate(columns.values())))
    said = F.concat("value", F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    kept = best.groupBy(*record).agg(F.array_sort(F.collect_list(F.struct("name", "rank", said.alias("text")))).alias("kept"))
    of = lambda i: F.array_join(F.transform(F.filter("kept", lambda x: x["name"] == i), lambda x: x["text"]), "; ")
    return kept.select(*record, *[of(i).alias(c) for i, c in enumerate(names)])


def record_rollup(images: DataFrame, record: list[str], position: str) -> DataFrame:
    """``images(record.., position, cls, path, rows, cols, bits, frames, photometric, samples, allocated, make, model, lossy,
    header_modality, header_maker, header_side)`` -> one row for each record.

    Sets are as ``top_values`` has them; ranges as ``5-9``; sides come from headers where they have one, else from paths;
    the maker is the most frequent one of headers, else of the images' own tags; qc counts headers that agree with their class.
    """
    rows = images.withColumns({"samples_per_pixel": samples_per_pixel(F.col("photometric"), F.col("samples")), "bits_allocated": bits_allocated(F.col("allocated"), F.col("bits")), "high_bit": F.when(F.col("bits") > 0, F.col("bits") - 1)})
    tops = {"photometric": 4, "samples_per_pixel": 3, "bits_allocated": 4, "bits": 4, "high_bit": 4, "lossy": 2, "model": 3, "header_modality": 4, "header_maker": 1, "make": 1}
    sets = top_values(rows, record, position, tops)
    side = laterality(F.col("path"))
    own = F.when(F.upper("header_side").isin("R", "L", "B"), F.upper("header_side"))
    rows = rows.withColumns({"__side": side, "__own": own})  # once for each row
    side, own = F.col("__side"), F.col("__own")
    rows = rows.withColumns({"side": F.coalesce(own, side["side"]), "side_source": F.when(own.isNotNull(), "dicom_header").otherwise(side["source"]), "conflict": own.isNull() & side["conflict"]})
    header = F.col("header_modality").isNotNull()
    expected = modality_of(F.col("cls"))
    n_frames = F.coalesce("frames", F.lit(1))
    sums = rows.groupBy(*record).agg(
        F.count("*").alias("n"), F.min(F.when(F.col("rows") > 0, F.col("rows"))).alias("r0"), F.max(F.when(F.col("rows") > 0, F.col("rows"))).alias("r1"),
        F.min(F.when(F.col("cols") > 0, F.col("cols"))).alias("c0"), F.max(F.when(F.col("cols") > 0, F.col("cols"))).alias("c1"),
        F.max(n_frames).alias("frames_max"), F.count_if(n_frames > 1).alias("multiframe"), F.count_if(F.col("bits") > 16).alias("too_deep"), F.count_if(header).alias("n_header"),
        F.count_if(header & expected.isNotNull()).alias("q1"), F.count_if(header & (expected == F.col("header_modality"))).alias("q0"), F.count_if("conflict").alias("side_conflicts"),
        *[F.count_if(F.col("side") == s).alias(f"side_{s}") for s in "RLBU"],
        *[F.count_if((F.col("side") != "U") & (F.col("side_source") == s)).alias(f"from_{s}") for s in ("dicom_header", "basename", "dirname")],
    )
    counts = lambda names, prefix, sep: F.concat_ws(sep, *[F.when(F.col(f"{prefix}{x}") > 0, F.concat(F.lit(f"{x}:"), F.col(f"{prefix}{x}").cast("string"))) for x in names])
    first = lambda c: F.regexp_replace(F.col(c), r" \([0-9]+\)$", "")
    maker = F.when(F.col("header_maker") != "", first("header_maker")).otherwise(first("make"))
    return sums.join(sets, record, "left").select(
        *record, "n", "n_header", range_text(F.col("r0"), F.col("r1")).alias("rows_range"), range_text(F.col("c0"), F.col("c1")).alias("cols_range"), "frames_max", "multiframe", "too_deep",
        counts("RLBU", "side_", " ").alias("sides"), counts(("dicom_header", "basename", "dirname"), "from_", "; ").alias("side_sources"), "side_conflicts",
        *[F.coalesce(c, F.lit("")).alias(f"{c}_set") for c in tops if c not in ("header_maker", "make")],
        F.coalesce(maker, F.lit("")).alias("maker"), F.when(F.col("header_maker") != "", "dicom_header").when(F.col("make") != "", "exif").otherwise("").alias("maker_source"),
        F.when(F.col("q1") > 0, F.concat(F.col("q0").cast("string"), F.lit("/"), F.col("q1").cast("string"))).otherwise("").alias("qc"),
    )
