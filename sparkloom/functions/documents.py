"""Parts of dataset descriptions: people, subjects, rights, access, texts and header values. All are Column expressions.

Null and empty inputs give what the docstrings say; arrays of structs keep their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import once, rights_id

# Schemes of organisation ids with their URIs; ontology terms of modalities; name of a record's repository;
# units of TIFF spacing in millimetres; resolutions of screens, which say nothing of the object.
ORG_SCHEMES = {"ROR": "https://ror.org", "ISNI": "https://isni.org", "GRID": "https://www.grid.ac", "Crossref Funder ID": "https://www.crossref.org/services/funder-registry/"}
MODALITY_TERMS = {
    "retinal_oct": ("Optical Coherence Tomography", "D041623", "Medical Subject Headings (MeSH)", "https://meshb.nlm.nih.gov/record/ui?ui=D041623"),
    "retinal_photography": ("Fundus Photography", "D005654", "Medical Subject Headings (MeSH)", "https://meshb.nlm.nih.gov/record/ui?ui=D005654"),
    "retinal_imaging": ("Retinal Imaging", "C168215", "NCI Thesaurus (NCIT)", "https://ncit.nci.nih.gov/ncitbrowser/pages/concept_details.jsf?code=C168215"),
    "volumetric_imaging": ("Volumetric Imaging", "C188577", "NCI Thesaurus (NCIT)", "https://ncit.nci.nih.gov/ncitbrowser/pages/concept_details.jsf?code=C188577"),
}
ORCID = "https://orcid.org/"
SPACING_UNITS = {"micron": 1e-3, "um": 1e-3, "µm": 1e-3, "mm": 1.0, "nm": 1e-6}
SCREEN_DPI = (72.0, 96.0, 150.0, 300.0)
CELL_CHARS = 32_000
# How a repository keeps files from the public.
CLOSED_ACCESS = {"restricted": "Access restricted by the depositor", "embargoed": "Embargoed by the depositor", "closed": "Access closed by the depositor"}


def blank(c: Column) -> Column:
    """Trimmed, and null if nothing is left."""
    t = F.trim(c)
    return F.when(t != "", t)


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def _pick(values: Column, keep) -> Column:
    """The non-null results of ``keep`` over an array; a null array is empty."""
    return F.filter(F.transform(values, keep), lambda x: x.isNotNull())


def org_scheme(value: Column, declared: Column) -> Column:
    """struct(scheme, uri): the declared scheme in its usual spelling, else what the id looks like, else Other."""
    said = F.coalesce(F.trim(declared), F.lit(""))
    canon = lookup({k.lower(): k for k in ORG_SCHEMES}, F.lower(said))
    low = F.lower(value)
    guess = F.when(low.contains("ror.org/"), "ROR").when(low.contains("isni"), "ISNI").when(low.contains("grid."), "GRID")
    scheme = F.coalesce(canon, F.when(said != "", said), guess, F.lit("Other"))
    return F.struct(scheme.alias("scheme"), lookup(ORG_SCHEMES, scheme).alias("uri"))


def allowed(value: Column, values: tuple[str, ...], default: str = "Other") -> Column:
    """The value if it is one of ``values``, else the default."""
    return F.when(value.isin(*values), value).otherwise(F.lit(default))


def name_type(name: Column, declared: Column, given: Column) -> Column:
    """Personal or Organizational: as declared, else by a comma or a given name."""
    return F.when(declared.isin("Personal", "Organizational"), declared).when(name.contains(",") | (F.coalesce(given, F.lit("")) != ""), "Personal").otherwise("Organizational")


def person(name: Column, declared: Column, given: Column, ids: Column, affiliations: Column) -> Column:
    """struct(name, name_type, identifiers, affiliations), null without a name. ``ids``: array<struct<value, scheme>>, those
    without either are left out, ORCIDs become URIs; ``affiliations``: array<struct<name, id, scheme>>, those without a
    name are left out. Repeats count once."""
    who = blank(name)

    def identifier(i: Column) -> Column:
        orcid = F.upper(i["scheme"]) == "ORCID"
        value = F.when(orcid & ~i["value"].startswith("http"), F.concat(F.lit(ORCID), i["value"])).otherwise(i["value"])
        return F.when((i["value"] != "") & (i["scheme"] != ""), F.struct(value.alias("value"), F.when(orcid, "ORCID").otherwise(i["scheme"]).alias("scheme"), F.when(orcid, F.lit(ORCID)).alias("uri")))

    def affiliation(a: Column) -> Column:
        has = F.coalesce(a["id"], F.lit("")) != ""
        return F.when(a["name"] != "", F.struct(a["name"].alias("name"), F.when(has, a["id"]).alias("id"), F.when(has, org_scheme(a["id"], a["scheme"])).alias("scheme")))

    return F.when(who.isNotNull(), F.struct(who.alias("name"), name_type(who, declared, given).alias("name_type"), F.array_distinct(_pick(ids, identifier)).alias("identifiers"), F.array_distinct(_pick(affiliations, affiliation)).alias("affiliations")))


def plain_person(name: Column, orcid: Column, affiliation: Column) -> Column:
    """The same from a record that has one ORCID and one affiliation at most."""
    ids = F.when(orcid != "", F.array(F.struct(orcid.alias("value"), F.lit("ORCID").alias("scheme"))))
    homes = F.when(affiliation != "", F.array(F.struct(affiliation.alias("name"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("scheme"))))
    return person(name, F.lit(None).cast("string"), F.lit(None).cast("string"), ids, homes)


def managing_organisation(creators: Column, otherwise: str) -> Column:
    """The first named affiliation of the people of a record (arrays ``affiliations`` of structs with name), else the repository."""
    every = F.flatten(F.transform(creators, lambda p: p["affiliations"]))
    return F.coalesce(F.get(F.filter(F.transform(every, lambda a: a["name"]), lambda n: n != ""), F.lit(0)), F.lit(otherwise))


def subject(value: Column, scheme: Column, scheme_uri: Column, code: Column, uri: Column) -> Column:
    """struct(value, code, scheme, scheme_uri, uri), null without a value. The code is the one given, else the last part of
    the URI; without code and scheme all but the value are null."""
    tail = F.element_at(F.split(F.regexp_replace(uri, "[/#]+$", ""), "[/#]"), -1)
    found = F.coalesce(blank(code), blank(tail))
    ok = found.isNotNull() & blank(scheme).isNotNull()
    part = lambda c, n: F.when(ok, c).alias(n)
    return F.when(blank(value).isNotNull(), F.struct(blank(value).alias("value"), part(found, "code"), part(blank(scheme), "scheme"), part(blank(scheme_uri), "scheme_uri"), part(blank(uri), "uri")))


def merge_subjects(rows: DataFrame, record: list[str], item: str, position: str) -> DataFrame:
    """Subjects of each record, one for each text in any case, in order of first appearance; the first with a code stands for
    the others. Pre-aggregated, so a subject that many rows repeat travels once from each task."""
    s = F.col(item)
    one = rows.where(s.isNotNull()).groupBy(*record, F.lower(s["value"]).alias("__k")).agg(F.min_by(s, F.struct(s["code"].isNull(), F.col(position))).alias("__s"), F.min(position).alias("__p"))
    return one.groupBy(*record).agg(F.transform(F.array_sort(F.collect_list(F.struct("__p", "__k", "__s"))), lambda x: x["__s"]).alias("subjects"))


def retarget(text: Column, repository: Column, of: str = "Zenodo") -> Column:
    """A text of our own making with another repository's name, as it is written and in lower case."""
    return F.when(repository == of, text).otherwise(F.replace(F.replace(text, F.lit(of), repository), F.lit(of.lower()), F.lower(repository)))


def repository(record_id: Column, source: Column) -> Column:
    return F.when(record_id.startswith("figshare-") | (F.lower(source) == "figshare"), "Figshare").otherwise("Zenodo")


def rights_in(value: Column, repo: Column) -> Column:
    """``rights_id`` whose scheme names the record's repository."""
    r = rights_id(value)
    scheme = F.when(r["scheme"] == "SPDX", "SPDX").when(repo == "Zenodo", r["scheme"]).otherwise(F.concat(repo, F.lit(" license name")))
    return F.struct(r["id"].alias("id"), scheme.alias("scheme"))


def modality_term(modality: Column) -> Column:
    """struct(term, code, scheme, uri) of a modality, null if it has none."""
    names = ("term", "code", "scheme", "uri")
    return F.try_element_at(F.create_map(*[x for k, v in MODALITY_TERMS.items() for x in (F.lit(k), F.struct(*[F.lit(y).alias(n) for y, n in zip(v, names, strict=True)]))]), modality)


def de_identification(access: Column, images: Column, until: Column) -> Column:
    """struct(level, text): ``public`` for open records with images; ``restricted`` with the depositor's terms; else ``default``."""
    known = lookup(CLOSED_ACCESS, access)
    ends = F.when((access == "embargoed") & (until != ""), F.concat(F.lit(" until "), until)).otherwise(F.lit(""))
    why = F.when(access == "open", "no image files read").otherwise("files not publicly released, no image files read")
    return (
        F.when((access == "open") & images, F.struct(F.lit("public").alias("level"), F.lit("public release as image files").alias("text")))
        .when(known.isNotNull(), F.struct(F.lit("restricted").alias("level"), F.concat(known, ends, F.lit(" (access_right: "), access, F.lit(")")).alias("text")))
        .otherwise(F.struct(F.lit("default").alias("level"), F.concat(F.lit("access_right: "), F.coalesce(F.when(access != "", access), F.lit("unknown")), F.lit("; "), F.coalesce(why, F.lit("files not publicly released, no image files read"))).alias("text")))
    )


def request_note(public: Column, embargo: Column, until: Column, users: Column, guests: Column, conditions: Column) -> Column:
    """One line on how to get the files. ``users`` and ``guests``: whether requests are accepted, null if that isn't told."""
    parts = F.concat_ws(
        "; ",
        F.when(embargo, F.concat(F.lit("embargoed until "), F.coalesce(F.when(until != "", until), F.lit("a date not given")))),
        F.when(users, "the owner accepts access requests from logged-in Zenodo users (Request access on the landing page)")
        .when(~users, "the owner does not accept access requests through Zenodo; contact the depositor")
        .otherwise("Zenodo does not expose whether the owner accepts requests; try Request access on the landing page or contact the depositor"),
        F.when(guests, "guest (no account) requests are accepted too"),
        F.when(conditions != "", "the owner sets conditions (see access_accept_conditions_text)"),
    )
    return F.when(public, "files are public now; no request needed").otherwise(parts)


def access_sentence(embargo: Column, until: Column, record: Column, files: Column, note: Column, landing: Column) -> Column:
    """The access of a record as a sentence, with its request note and landing page."""
    known = lambda c: F.coalesce(F.when(c != "", c), F.lit("unknown"))
    kind = F.when(embargo, "Embargoed").otherwise("Restricted")
    ends = F.when(embargo & (until != ""), F.concat(F.lit(" until "), until)).otherwise(F.lit(""))
    upper = F.concat(F.upper(F.substring(note, 1, 1)), note.substr(F.lit(2), F.length(note)))
    return F.concat(kind, F.lit(" by the depositor on Zenodo"), ends, F.lit(" (record "), known(record), F.lit(", files "), known(files), F.lit("). "), upper, F.lit(". Landing page: "), landing)


def flat(parts: Column, separator: str = "; ") -> Column:
    """An array of texts as one, without nulls; a null array is empty."""
    return F.coalesce(F.array_join(parts, separator), F.lit(""))


def flat_description(descriptions: Column, limit: int = 2000) -> Column:
    """``[type] text | ...`` of array<struct<type, text>>, cut at the limit with a word on it."""
    whole = flat(F.transform(descriptions, lambda d: F.concat(F.lit("["), d["type"], F.lit("] "), d["text"])), " | ")
    return F.when(F.length(whole) > limit, F.concat(F.substring(whole, 1, limit), F.lit(" [truncated; full text in dataset_description.json]"))).otherwise(whole)


def flat_map(m: Column) -> Column:
    """``key: value; ...`` of a map, in its order."""
    return F.substring(flat(F.transform(F.map_entries(m), lambda e: F.concat(e["key"].cast("string"), F.lit(": "), F.coalesce(e["value"].cast("string"), F.lit("None"))))), 1, CELL_CHARS)


def flat_files(files: Column) -> Column:
    """``name (size) link; ...`` of array<struct<key, size, url>>."""
    return F.substring(flat(F.transform(files, lambda f: F.trim(F.concat(f["key"], F.lit(" ("), human_size(f["size"]), F.lit(") "), F.coalesce(f["url"], F.lit("")))))), 1, CELL_CHARS)


def human_size(n: Column) -> Column:
    """Bytes with a unit of 1000 and one digit; null counts as 0."""
    x = F.coalesce(n.cast("double"), F.lit(0.0))
    out = F.concat(x.cast("long").cast("string"), F.lit(" B"))
    for power, unit in ((1, "KB"), (2, "MB"), (3, "GB"), (4, "TB")):
        out = F.when(x >= 1000.0**power, F.concat(F.format_string("%.1f", x / 1000.0**power), F.lit(f" {unit}"))).otherwise(out)
    return out


def short(text: Column, limit: int) -> Column:
    """One line of at most ``limit`` characters, with dots where it is cut; null as empty."""
    line = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(F.length(line) > limit, F.concat(F.substring(line, 1, limit - 3), F.lit("..."))).otherwise(line)


def code_text(scheme: Column, value: Column, meaning: Column) -> Column:
    """``scheme value meaning`` of a coded term, what is missing left out."""
    return F.concat_ws(" ", blank(scheme), blank(value), blank(meaning))


def samples_per_pixel(photometric: Column, samples: Column) -> Column:
    """Samples as DICOM would encode them, which has no alpha channel: 3 for colour, 1 for gray and palettes, else as given."""
    p = F.upper(F.coalesce(photometric, F.lit("")))
    return F.when(p.startswith("RGB") | p.startswith("YBR"), 3).when(p.startswith("MONOCHROME") | p.startswith("PALETTE"), 1).otherwise(F.when(samples > 0, samples.cast("int")))


def bits_allocated(allocated: Column, stored: Column) -> Column:
    """The header's value, else stored bits rounded up to 1, 8, 16, 32 or 64; null if neither is there."""
    steps = F.when(stored == 1, 1).when(stored <= 8, 8).when(stored <= 16, 16).when(stored <= 32, 32).otherwise(64)
    return F.when(allocated > 0, allocated.cast("int")).when(stored > 0, steps)


def header_value(values: Column) -> Column:
    """An array of header values as DICOM joins them; null as empty."""
    return F.coalesce(F.array_join(F.transform(values, lambda v: F.trim(v.cast("string"))), "\\"), F.lit(""))


def exif_time(text: Column) -> Column:
    """``YYYY:MM:DD hh:mm:ss`` as ``YYYYMMDDhhmmss``; empty for what has no date."""
    digits = F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), r"\D", ""), 1, 14)
    return F.when((F.length(digits) >= 8) & ~digits.startswith("0000"), digits).otherwise(F.lit(""))


def tiff_spacing(xres: Column, yres: Column, unit: Column, description: Column) -> Column:
    """array(row, column) spacing in millimetres: of OME physical sizes, else of resolutions with the unit in the text, else
    with the tag's unit (2 inch, 3 centimetre); null where there is none, for unit 1 and for screen resolutions."""
    text = F.coalesce(description, F.lit(""))
    size = lambda axis: F.regexp_extract(text, f'PhysicalSize{axis}="([0-9.eE+-]+)"', 1).try_cast("double") / 1000.0
    pair = lambda row, col: F.array(F.round(row, 6), F.round(col, 6))
    named = F.regexp_extract(text, r"unit=(\S+)", 1)
    scale = F.try_element_at(F.create_map(*[F.lit(x) for kv in SPACING_UNITS.items() for x in kv]), F.lower(named))
    good = (xres > 0) & (yres > 0)
    tag = F.coalesce(unit, F.lit(2))
    per = F.when(tag == 3, 10.0).otherwise(25.4)
    return (
        F.when(size("X").isNotNull(), pair(F.coalesce(size("Y"), size("X")), size("X")))
        .when(~F.coalesce(good, F.lit(False)), None)
        .when(named != "", F.when(scale.isNotNull(), pair(scale / yres, scale / xres)))
        .when((tag == 1) | xres.isin(*SCREEN_DPI), None)
        .otherwise(pair(per / yres, per / xres))
    )


def envi_header(text: Column) -> Column:
    """``key = value`` lines of an ENVI header as a map with keys in lower case; values in braces may have several lines; of
    repeated keys the last counts."""
    pattern = r"(?m)^[^\S\n]*([^=\n]+?)[^\S\n]*=[^\S\n]*(\{[^}]*\}|[^\n]*)"
    keys = lambda t: F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(1)), lambda k: F.lower(F.trim(k)))
    values = lambda t: F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(2)), lambda v: F.trim(F.regexp_replace(F.trim(v), r"^\{+|\}+$", "")))
    parsed = lambda t: once(keys(t), lambda k: F.struct(k.alias("k"), F.reverse(k).alias("r"), F.size(k).alias("n"), values(t).alias("v")))

    def last(x: Column) -> Column:
        own = F.transform(x["k"], lambda k, i: F.when(i == x["n"] - F.array_position(x["r"], k), F.struct(k.alias("key"), F.get(x["v"], i).alias("value"))))
        return F.map_from_entries(F.array_compact(own))

    return once(text, lambda t: once(parsed(t), last))


def folder_labels(folders: DataFrame, path: str) -> DataFrame:
    """The shortest end of each folder's path that no other folder has, ``label``: paths explode into their ends, and ends
    that one folder has remain. A folder given twice is one."""
    parts = F.filter(F.split(path, r"[\\/]"), lambda p: (p != "") & ~p.rlike("^[A-Za-z]:$"))
    one = folders.select(path).distinct().withColumn("__parts", parts)
    n = F.size("__parts")
    ends = one.select(path, F.explode(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.struct(k.alias("k"), F.array_join(F.slice("__parts", n - k + 1, k), "/").alias("end")))).alias("e")).where(n > 0)
    single = ends.groupBy(F.col("e.k").alias("k"), F.col("e.end").alias("end")).agg(F.count("*").alias("n"), F.min(path).alias(path)).where("n = 1")
    best = single.groupBy(path).agg(F.min_by("end", "k").alias("__label"))
    return one.join(best, path, "left").select(path, F.coalesce("__label", F.array_join("__parts", "/")).alias("label"))


def relative_folder(path: Column, root: Column, marker: str = "cmds") -> Column:
    """A path relative to the root; outside of it, from the marker folder on, else as it is."""
    p = F.regexp_replace(path, r"\\", "/")
    absolute = p.startswith("/") | p.rlike("^[A-Za-z]:/")
    base = F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"))
    at = F.regexp_extract(p, f"(?:^|/)({marker}(?:/.*)?)$", 1)
    return F.when(~absolute, p).when(p.startswith(base), p.substr(F.length(base) + 1, F.length(p))).when(at != "", at).otherwise(p)
