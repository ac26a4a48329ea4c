"""What listings of archives say before anything is downloaded, and estimates from partial samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.text import once
from .strata import EYE_CLASSES, MASK

# Sizes in which a member without extension may be an image; names without extension that are texts.
SNIFFED = (8, 64 << 20)
TEXT_NAMES = (
    "readme", "license", "licence", "copying", "copyright", "notice", "authors", "contributors", "changelog", "changes", "history",
    "news", "install", "makefile", "dockerfile", "version", "manifest", "todo", "citation", "gemfile", "procfile", "vagrantfile",
    "jenkinsfile",
)
# Families of archives that are probed alike.
FAMILIES = {".zip": "zip", ".tar": "tar", ".7z": "7z", ".rar": "rar", **dict.fromkeys((".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz", ".tar.zst", ".tzst"), "tar_stream")}
#: Extension that a scratch copy keeps: short and plain, so that it can't carry a path.
PLAIN_SUFFIX = r"^[a-z0-9.]{1,16}$"


def probe_family(name: Column) -> Column:
    """How an archive is probed: split, tar, tar_stream, 7z, rar, zip, other or single; empty for what is none."""
    table = F.create_map(*[F.lit(x) for kv in FAMILIES.items() for x in kv])

    def family(n: Column, kind: Column) -> Column:
        return (
            F.when(N.is_first_part(n) | N.is_fragment(n), "split")
            .when(kind == "archive", F.coalesce(F.try_element_at(table, N.extension(n)), F.lit("other")))
            .when(kind == "compressed", "single")
            .otherwise("")
        )

    return once(name, lambda n: once(N.file_kind(n), lambda kind: family(n, kind)))


def member_signal(name: Column, size: Column, sniffable: Column, image_head: Column | None = None) -> Column:
    """What a listed member stands for: image, nested, noext or nothing (empty). ``sniffable``: whether members without
    extension are read in this format; ``image_head``: whether the first bytes are an image's, null where unread."""
    head = F.lit(None).cast("boolean") if image_head is None else image_head

    def signal(n: Column, kind: Column) -> Column:
        open_ = (kind == "noext") & sniffable & ~F.lower(N.base_name(n)).isin(*TEXT_NAMES) & (size >= SNIFFED[0]) & (size < SNIFFED[1])
        return (
            F.when(N.is_junk(n), "")
            .when(kind.isin(*N.IMAGE_KINDS), "image")
            .when((kind == "fragment") | (kind.isin("archive", "compressed") & N.nested_worth(n)), "nested")
            .when(open_, F.when(head.isNull(), "noext").when(head, "image").otherwise(""))
            .otherwise("")
        )

    return once(name, lambda n: once(N.file_kind(n), lambda kind: signal(n, kind)))


def listing(members: DataFrame, archive: list[str], name: str, size: str, position: str, sniffable: Column) -> DataFrame:
    """For each archive: n_members, n_images, n_nested, n_noext and hit, the first member that stands for something."""
    path = F.replace(F.col(name), F.lit("\\"), F.lit("/"))
    rows = members.withColumn("__name", path).withColumn("__signal", member_signal(path, F.col(size), sniffable))
    is_ = lambda s: F.count_if(F.col("__signal") == s)
    hit = F.min_by(F.when(F.col("__signal") != "", F.col("__name")), F.when(F.col("__signal") != "", F.struct(position, "__name")))
    return rows.groupBy(*archive).agg(F.count("*").alias("n_members"), is_("image").alias("n_images"), is_("nested").alias("n_nested"), is_("noext").alias("n_noext"), hit.alias("hit"))


def headers_of(files: DataFrame, group: list[str], name: str) -> DataFrame:
    """The header that a data file of a volume belongs to: same group and stem in any case; of several the first by the
    order of header kinds."""
    ext = F.col("__ext")
    kinds = list(N.DATA_OF_HEADER)
    data_exts = sorted({e for exts in N.DATA_OF_HEADER.values() for e in exts})
    options = F.create_map(*[x for e in data_exts for x in (F.lit(e), F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(h).alias("ext")) for i, h in enumerate(kinds) if e in N.DATA_OF_HEADER[h]]))])
    stem = F.lower(F.col(name).substr(F.lit(1), F.length(name) - F.length(ext)))
    data = files.withColumn("__ext", N.extension(F.col(name))).where(ext.isin(*data_exts)).select(*group, F.col(name).alias("data"), stem.alias("__stem"), F.explode(F.element_at(options, ext)).alias("__o"))
    data = data.withColumn("__low", F.concat("__stem", F.col("__o.ext")))
    heads = files.select(*group, F.lower(name).alias("__low"), F.col(name).alias("header"))
    return data.join(heads, [*group, "__low"]).groupBy(*group, "data").agg(F.min_by("header", F.struct(F.col("__o.rank"), "header")).alias("header"))


def remote_zips(files: DataFrame, group: list[str], name: str) -> DataFrame:
    """Zips that can be read by ranges: those without a ``.z01`` beside them, which would make them part of a set."""
    low = F.lower(name)
    zips = files.where(low.endswith(".zip")).withColumn("__stem", low.substr(F.lit(1), F.length(low) - 4))
    parts = files.where(F.col(name).endswith(".z01")).select(*group, F.col(name).substr(F.lit(1), F.length(name) - 4).alias("__stem")).distinct()
    return zips.join(parts, [*group, "__stem"], "left_anti").drop("__stem")


def scratch_suffix(name: Column) -> Column:
    """The ending that a scratch copy of a member keeps, else empty."""
    low = F.lower(name)
    plain = once(N.extension(name), lambda ext: F.when(ext.rlike(PLAIN_SUFFIX), ext).otherwise(""))
    return F.when(low.rlike(r"\.(7z|zip)\.001$"), F.regexp_extract(low, r"(\.(?:7z|zip)\.001)$", 1)).otherwise(plain)


def colocated(parts: DataFrame, record: list[str], name: str, streamed: str) -> DataFrame:
    """Parts of split archives with ``link``: whether a local part must be linked beside the streamed ones of its set."""
    keyed = parts.withColumn("set_key", N.split_set(F.col(name)))
    sets = keyed.where("set_key is not null").groupBy(*record, "set_key").agg(F.count("*").alias("__n"), F.count_if(streamed).alias("__s"))
    mixed = sets.where("__n > 1 and __s > 0 and __s < __n").select(*record, "set_key", F.lit(True).alias("__mixed"))
    return keyed.join(mixed, [*record, "set_key"], "left").withColumn("link", F.coalesce(F.col("__mixed") & ~F.col(streamed), F.lit(False))).drop("__mixed")


def sum_counts(parts: list[DataFrame], keys: list[str], n: str) -> DataFrame:
    """Counts of several sources as one."""
    out = parts[0].select(*keys, n)
    for p in parts[1:]:
        out = out.unionByName(p.select(*keys, n))
    return out.groupBy(*keys).agg(F.sum(n).alias(n))


def population(listed: Column, noext: bool | Column, noext_listed: Column, added: Column, direct: Column, over: Column, empty: Column, nested_images: Column, nested_listed: Column, nested_fetched: Column) -> Column:
    """struct(seen, direct, nested): images estimated from a partial sample. Of members without extension the share of
    images among those read counts for all that could be; images in nested archives are scaled from those opened."""
    frame = lambda n: F.greatest(F.lit(0), n - over - empty)
    open_ = F.lit(noext) if isinstance(noext, bool) else noext
    share = F.when(direct > 0, frame(noext_listed) * added / direct).otherwise(0.0)
    return F.struct(
        F.when(open_, added).otherwise(listed).cast("long").alias("seen"),
        F.when(open_, share).otherwise(frame(listed).cast("double")).alias("direct"),
        F.when(nested_fetched > 0, nested_images * nested_listed / nested_fetched).otherwise(0.0).alias("nested"),
    )


def triage_decision(rows: DataFrame, record: list[str], label: str, least: float, more: Column) -> DataFrame:
    """After the triage sample: n_triage, eye_share of its images that aren't masks, and what follows: ``triage`` if too few
    are of eye classes, ``deep`` if more can be sampled (``more``, an aggregate), else ``complete``."""
    masks, eye = F.col(label) == MASK, F.col(label).isin(*EYE_CLASSES)
    sums = rows.groupBy(*record).agg(F.count("*").alias("n_triage"), F.count_if(~masks).alias("__n"), F.count_if(eye).alias("__e"), more.alias("__more"))
    share = F.when(F.col("__n") > 0, F.col("__e") / F.col("__n"))
    reason = F.when(share.isNull(), "no non-mask image in the triage sample").when(share < least, F.lit("below")).otherwise(F.lit("reached"))
    then = F.when(F.coalesce(share < least, F.lit(True)), "triage").when(F.col("__more"), "deep").otherwise("complete")
    return sums.select(*record, "n_triage", share.alias("eye_share"), then.alias("decision"), reason.alias("reason"))


def counted(rows: DataFrame, record: list[str], value: str, n: int, digits: str | None = None) -> DataFrame:
    """The ``n`` most frequent values of each record as a map; ``digits`` replaces runs of digits, so that messages that
    differ in numbers only count together. Ties go to the smaller value."""
    v = F.col(value) if digits is None else F.substring(F.regexp_replace(value, "[0-9]+", digits), 1, 80)
    sums = rows.where(F.col(value).isNotNull()).groupBy(*record, v.alias("__v")).agg(F.count("*").alias("__n"))
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("__n")).alias("n"), F.col("__v").alias("v")))), 1, n)
    return sums.groupBy(*record).agg(F.map_from_entries(F.transform(best, lambda x: F.struct(x["v"], -x["n"]))).alias("counts"))


def fetch_status(n_files: Column, access: Column, metadata: Column, planned: Column, fits: Column, local: Column, remote: Column, room: Column) -> Column:
    """How a record ends before anything is read, null if work goes on: no metadata, no files (by its access), nothing that
    fits the download limit, no room on the disk."""
    work = (planned > 0) | (remote > 0)
    return (
        F.when(~metadata, "metadata_unavailable")
        .when(n_files == 0, F.when(F.coalesce(access, F.lit("")).isin("", "open"), "no_files").otherwise("restricted"))
        .when((planned > 0) & (fits == 0) & (local == 0) & (remote == 0), "skipped_size")
        .when(work & ~room, "skipped_disk")
    )


def spool_problems(items: DataFrame, found: DataFrame, record: list[str], path: str, size: str) -> DataFrame:
    """Items of manifests that can't be used -> record, path, problem: outside the record's folder, missing, or of another
    size than ``found(record, path, found_size)`` says. A null size isn't compared."""
    outside = F.col(path).startswith("/") | F.array_contains(F.split(path, "/"), "..")
    rows = items.join(found.withColumn("__there", F.lit(True)), [*record, path], "left")
    problem = F.when(outside, "outside").when(F.col("__there").isNull(), "missing").when(F.col(size) != F.col("found_size"), F.concat(F.lit("size changed: "), F.col("found_size").cast("string"), F.lit(" != "), F.col(size).cast("string")))
    return rows.select(*record, path, problem.alias("problem")).where("problem is not null")
