"""Scans of catalogues, logs, lists and documents as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import latest


def scrape(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue in JSON: a list of records, or an object with them in ``results`` or ``records``.

    Rows: source_id (Figshare ids with a prefix, so that they can't collide), figshare_id, source, and rec, the record
    as a variant. Records without an id are dropped.
    """
    doc = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    one = F.coalesce(F.try_variant_get("v", "$.results", "array<variant>"), F.try_variant_get("v", "$.records", "array<variant>"), F.try_variant_get("v", "$", "array<variant>"))
    recs = doc.select(F.posexplode(one).alias("pos", "rec"))
    text = lambda p: F.trim(F.coalesce(F.try_variant_get("rec", p, "string"), F.lit("")))
    sid = F.when(text("$.source_id") != "", text("$.source_id")).otherwise(text("$.id"))
    fig = (F.lower(text("$.source")) == "figshare") & ~sid.startswith("figshare-")
    out = recs.select("pos", F.when(fig, F.concat(F.lit("figshare-"), sid)).otherwise(sid).alias("source_id"), F.when(fig, sid).alias("figshare_id"), F.lower(text("$.source")).alias("source"), "rec")
    return out.where("source_id <> ''")


def one_source(df: DataFrame) -> DataFrame:
    """The kind of source of a scrape, as one row; raises when it runs if there are several."""
    kind = F.when(F.col("source_id").startswith("figshare-"), "figshare").otherwise("zenodo")
    n = df.select(kind.alias("kind")).agg(F.count_distinct("kind").alias("n"), F.min("kind").alias("kind"))
    return n.select("kind", F.when(F.col("n") > 1, F.raise_error(F.lit("the scrape mixes sources"))).otherwise(F.lit(True)).cast("boolean").alias("ok")).where("ok or ok is null")


def log_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of append-only JSON logs, in the order of the given files and within each file: run, block, mid, line variant.
    Half-written lines are dropped."""
    parts = []
    for i, p in enumerate(paths):
        lines = spark.read.text(p).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("mid"))
        parts.append(lines.select(F.lit(i).alias("run"), "file", "block", "mid", F.try_parse_json("value").alias("line")).where("line is not null"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_rows(lines: DataFrame, key: str = "record_id") -> DataFrame:
    """The last line of each id: key, line."""
    keyed = lines.select(F.try_variant_get("line", f"$.{key}", "string").alias(key), "run", "file", "block", "mid", F.to_json("line").alias("json")).where(f"`{key}` is not null")
    return latest(keyed, [key], ["run", "file", "block", "mid"]).select(key, "json", F.parse_json("json").alias("line"))


def status_rows(rows: DataFrame, key: str = "record_id") -> DataFrame:
    """Only what scheduling needs of the latest rows."""
    get = lambda p, kind: F.try_variant_get("line", p, kind)
    return rows.select(key, get("$.status", "string").alias("status"), get("$.kept", "boolean").alias("kept"), F.substring(get("$.kept_reason", "string"), 1, 40).alias("kept_reason"))


def ids_file(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a text file, separated by white space or commas, ``#`` begins a comment: id, pos; distinct, first one kept."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line"))
    tokens = lines.select("line", F.posexplode(F.split(F.split("value", "#")[0], r"[\s,]+")).alias("i", "id")).where("id <> ''")
    return tokens.groupBy("id").agg(F.min(F.struct("line", "i")).alias("pos"))


def csv_table(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A CSV table of strings with a header; missing required columns raise, blank rows are skipped."""
    df = spark.read.csv(path, header=True, encoding="UTF-8", multiLine=True)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return df.where(F.coalesce(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in df.columns]).isNotNull())


def json_documents(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Documents <id>.json of several folders, the first folder that has an id wins: id, folder, doc variant. What isn't JSON is dropped."""
    parts = []
    for i, folder in enumerate(folders):
        raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(F.col("_metadata.file_name").alias("name"), "value")
        parts.append(raw.select(F.regexp_replace("name", r"\.json$", "").alias("id"), F.lit(-i).alias("rank"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    valid = out.where(F.try_parse_json("value").isNotNull())
    return latest(valid, ["id"], ["rank"]).select("id", (-F.col("rank")).alias("folder"), F.parse_json("value").alias("doc"))


def record_files(docs: DataFrame) -> DataFrame:
    """Files of records' documents: id, key, size, md5, url; entries without a name are dropped."""
    f = docs.select("id", F.posexplode(F.try_variant_get("doc", "$.files", "array<variant>")).alias("pos", "f"))
    get = lambda p, kind="string": F.try_variant_get("f", p, kind)
    name = F.coalesce(F.nullif(get("$.key"), F.lit("")), get("$.filename"))
    md5 = F.regexp_extract(F.coalesce(get("$.checksum"), F.lit("")), "^md5:(.*)$", 1)
    url = F.coalesce(get("$.links.self"), get("$.links.content"), get("$.links.download"))
    return f.select("id", "pos", name.alias("key"), F.coalesce(get("$.size", "bigint"), get("$.filesize", "bigint"), F.lit(0)).alias("size"), F.nullif(md5, F.lit("")).alias("md5"), url.alias("url")).where("coalesce(key, '') <> ''")


def figshare_files(articles: DataFrame) -> DataFrame:
    """Files of articles (id, files array): key, size, md5, url, link_only. A repeated name gets the file's id in front."""
    f = articles.select(F.col("id").alias("article"), F.posexplode("files").alias("pos", "f"))
    name = F.trim(F.element_at(F.split(F.regexp_replace(F.coalesce("f.name", F.col("f.id").cast("string")), r"\\", "/"), "/"), -1))
    rows = f.select("article", "pos", name.alias("name"), F.col("f.id").alias("file_id"), F.coalesce("f.size", F.lit(0)).alias("size"), F.col("f.computed_md5").alias("md5"), F.col("f.download_url").alias("url"), F.coalesce("f.is_link_only", F.lit(False)).alias("link_only"))
    rows = rows.where("url is not null and (link_only or name <> '')")
    nth = F.expr("row_number() OVER (PARTITION BY article, link_only, name ORDER BY pos)")
    key = F.when(nth > 1, F.concat(F.col("file_id").cast("string"), F.lit("_"), F.col("name"))).otherwise(F.col("name"))
    return rows.select("article", "pos", key.alias("key"), "size", "md5", "url", "link_only")


def figshare_access(a: str = "") -> Column:
    """Access right of an article: closed, embargoed, restricted or open."""
    flag = lambda c: F.coalesce(F.col(f"{a}{c}"), F.lit(False))
    return F.when(flag("is_confidential"), "closed").when(flag("is_embargoed"), "embargoed").when(flag("download_disabled"), "restricted").otherwise("open")


def figshare_record(articles: DataFrame) -> DataFrame:
    """Articles in the shape of repository records: id, metadata struct, and files as ``record_files`` has them."""
    people = F.transform(F.coalesce("authors", F.expr("cast(array() as array<struct<full_name:string,first_name:string,last_name:string,orcid_id:string>>)")), lambda p: F.struct(p["full_name"].alias("name"), F.nullif(p["orcid_id"], F.lit("")).alias("orcid")))
    return articles.select(
        F.concat(F.lit("figshare-"), F.col("id").cast("string")).alias("id"),
        F.struct(
            figshare_access().alias("access_right"), F.col("title"), F.col("description"), people.alias("creators"),
            F.array_distinct(F.concat(F.coalesce("tags", F.expr("cast(array() as array<string>)")), F.transform(F.coalesce("categories", F.expr("cast(array() as array<struct<title:string>>)")), lambda c: c["title"]))).alias("keywords"),
            F.substring("published_date", 1, 10).alias("publication_date"), F.col("version").cast("string").alias("version"), F.struct(F.lower("license.name").alias("id")).alias("license"), F.col("doi"),
        ).alias("metadata"),
    )


def access_fields(docs: DataFrame) -> DataFrame:
    """Access fields of record documents (id, doc variant); what a document doesn't expose is null, never false."""
    get = lambda p, kind="string": F.try_variant_get("doc", p, kind)
    settings = get("$.parent.access.settings", "variant").isNotNull()
    rights = F.coalesce(F.try_variant_get("doc", "$.metadata.rights", "array<variant>"), F.expr("cast(array() as array<variant>)"))
    ids = F.filter(F.transform(rights, lambda r: F.try_variant_get(r, "$.id", "string")), lambda x: x.isNotNull())
    return docs.select(
        "id", get("$.access.record").alias("access_record"), get("$.access.files").alias("access_files"), get("$.access.status").alias("access_status"),
        get("$.access.embargo.active", "boolean").alias("access_embargo_active"), get("$.access.embargo.until").alias("access_embargo_until"),
        (F.coalesce(get("$.access.files") == "public", F.lit(False)) & ~F.coalesce(get("$.access.embargo.active", "boolean"), F.lit(False))).alias("access_files_public_now"),
        F.coalesce(settings, F.lit(False)).alias("access_settings_exposed"), get("$.parent.access.settings.allow_user_requests", "boolean").alias("access_allow_user_requests"),
        get("$.parent.access.settings.allow_guest_requests", "boolean").alias("access_allow_guest_requests"), ids.alias("access_license_ids"), get("$.metadata.title").alias("access_title"),
    )


def tree(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a folder: path relative to it, size, depth. Contents aren't read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "length")
    root = path.rstrip("/").removeprefix("file://").removeprefix("file:")
    rel = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), "^\\Q" + root + "\\E/", "")
    return f.select(rel.alias("path"), F.col("length").alias("size"), (F.size(F.split(rel, "/")) - 1).alias("depth"))


def readme_sample(spark: SparkSession, root: str, names: tuple[str, ...], per_file: int, budget: int) -> DataFrame:
    """One row with the first ``per_file`` characters of readme files in path order, until ``budget`` characters. Only files
    whose names begin like one of ``names`` are opened, and at most ``budget`` of them are looked at, as each has a character."""
    stems = sorted({n.split(".")[0] for n in names})
    glob = "{" + ",".join("".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in s) + "*" for s in stems) + "}"
    text = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob).select(F.col("_metadata.file_path").alias("p"), F.substring("value", 1, per_file).alias("t"))
    wanted = text.where(F.lower(F.element_at(F.split("p", "/"), -1)).isin(*names) & (F.length("t") > 0)).orderBy("p").limit(budget)
    kept = wanted.withColumn("s", F.expr("sum(length(t)) OVER (ORDER BY p) - length(t)")).where(F.col("s") < budget).select("p", F.substring("t", F.lit(1), (F.lit(budget) - F.col("s")).cast("int")).alias("t"))
    return kept.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "t"))), lambda x: x["t"]), "\n").alias("text"))
