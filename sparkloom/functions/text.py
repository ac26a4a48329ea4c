"""Text, licence, laterality and formatting expressions."""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Terms of eye imaging; words match in any case, acronyms as written.
EYE_WORDS = (
    r"(?U)(?i)\b(retina[ls]?|retinopath\w*|fundus|fundi|ophthalm\w*|optical coherence tomograph\w*|macula[r]?|maculopath\w*|glaucoma\w*|"
    r"choroid\w*|uveitis|keratoconus|cornea[l]?|autofluorescen\w*|fluorescein angiograph\w*|indocyanine green|scanning laser ophthalmoscop\w*|"
    r"optic (?:nerve|disc|disk)|eyes?|ocular|intraocular|vitreo\w*|diabetic eye|age[- ]related macular)\b"
)
EYE_ACRONYMS = r"(?U)\b(OCTA?|AMD|nAMD|SLO|FAF|UWF|DME|RNFL)\b"
# Licences that allow training, by the beginning of their id, and the parts that forbid it.
TRAIN_OK = r"(?i)^(cc0|cc-zero|cc-by(-sa)?(-[0-9]\.[0-9])?|odc-by|pddl|odc-pddl|mit|mit-license|bsd|bsd-[0-9]-clause|apache|apache-2\.0|public-domain|pdm|cc-pdm)"
NC_ND = r"(?i)(^|-)(nc|nd)(-|$)"
# Words for the side of the eye.
SIDES = {"od": "R", "re": "R", "right": "R", "r": "R", "os": "L", "le": "L", "left": "L", "l": "L", "ou": "B", "both": "B", "bilateral": "B"}
ANY_SIDE = f"(?i)(?:^|[^a-z0-9])(?:{'|'.join(SIDES)})(?:[^a-z0-9]|$)"
# Canonical spelling of licence ids that aren't their own lower case.
SPDX = {
    **{s.lower(): s for s in (
        "CC-BY-1.0", "CC-BY-2.0", "CC-BY-2.5", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-SA-2.0", "CC-BY-SA-2.5", "CC-BY-SA-3.0", "CC-BY-SA-4.0",
        "CC-BY-NC-2.0", "CC-BY-NC-2.5", "CC-BY-NC-3.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-2.0", "CC-BY-NC-SA-2.5", "CC-BY-NC-SA-3.0",
        "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-2.0", "CC-BY-NC-ND-2.5", "CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0", "CC-BY-ND-2.0", "CC-BY-ND-2.5",
        "CC-BY-ND-3.0", "CC-BY-ND-4.0", "CC0-1.0", "CC-PDDC", "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only",
        "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only",
        "AGPL-3.0-or-later", "MPL-2.0", "ODbL-1.0", "ODC-By-1.0", "PDDL-1.0", "Unlicense", "EUPL-1.2", "Artistic-2.0", "ISC", "Zlib",
        "OFL-1.1", "etalab-2.0",
    )},
    "cc-zero": "CC0-1.0", "cc0": "CC0-1.0", "odc-by": "ODC-By-1.0", "odbl": "ODbL-1.0", "gpl-3.0": "GPL-3.0-only",
    "gpl-2.0": "GPL-2.0-only", "lgpl-3.0": "LGPL-3.0-only", "agpl-3.0": "AGPL-3.0-only",
}


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, however often the body uses it. Spark shares what occurs twice
    neither within branches nor where there are lambdas, so without this the cost doubles at every level."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


@F.pandas_udf(T.StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    """Entities as characters; Spark has no built-in for the full table."""
    return s.map(html.unescape, na_action="ignore")


def strip_html(text: Column, entities: bool = True) -> Column:
    """Tags as blanks, entities resolved, white space collapsed; null as empty."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " ")
    if entities:
        out = unescape_html(out)
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def keyword_terms(*texts: Column) -> Column:
    """Distinct eye imaging terms in order of first appearance: per text its words in lower case, then its acronyms."""
    found = []
    for t in texts:
        t = F.coalesce(t, F.lit(""))
        found += [F.transform(F.regexp_extract_all(t, F.lit(EYE_WORDS), F.lit(1)), F.lower), F.regexp_extract_all(t, F.lit(EYE_ACRONYMS), F.lit(1))]
    return F.array_distinct(F.flatten(F.array(*found)))


def license_use(ids: Column) -> Column:
    """What may be done under a list of licence ids."""
    clean = F.filter(F.transform(F.coalesce(ids, F.expr("cast(array() as array<string>)")), lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & ~x.isin("", "notspecified", "none"))
    return (
        F.when(F.size(clean) == 0, F.lit("no_license"))
        .when(F.exists(clean, lambda x: x.rlike(NC_ND)), F.lit("evaluate_only_nc_nd"))
        .when(F.forall(clean, lambda x: x.rlike(TRAIN_OK)), F.lit("train"))
        .otherwise(F.lit("check_license"))
    )


def rights_id(value: Column) -> Column:
    """struct(id, scheme): the canonical SPDX id where there is one."""
    v = F.trim(value)
    spdx = F.try_element_at(F.create_map(*[F.lit(x) for kv in SPDX.items() for x in kv]), F.lower(v))
    return F.struct(F.coalesce(spdx, v).alias("id"), F.when(spdx.isNotNull(), F.lit("SPDX")).otherwise(F.lit("Zenodo license id")).alias("scheme"))


def laterality(path: Column) -> Column:
    """struct(side, source, conflict): the file's name without extension first, then its folders from the nearest.

    A lone r or l counts only beside another token, re and le only in the name; two sides in one component are a conflict.
    """
    folders = F.replace(F.replace(path, F.lit("!/"), F.lit("/")), F.lit("\\"), F.lit("/"))
    parts = F.filter(F.split(folders, "/"), lambda p: p != "")
    none = F.struct(F.lit("U").alias("side"), F.lit("none").alias("source"), F.lit(False).alias("conflict"))
    sides = F.create_map(*[F.lit(x) for kv in SIDES.items() for x in kv])

    def found(component: Column, base: Column) -> Column:
        tokens = F.regexp_extract_all(F.lower(component), F.lit("([a-z0-9]+)"), F.lit(1))
        ok = lambda ts: F.filter(ts, lambda t: F.map_contains_key(sides, t) & ~(t.isin("r", "l") & (F.size(ts) < 2)) & (~t.isin("re", "le") | base))
        return once(tokens, lambda ts: F.array_distinct(F.transform(ok(ts), lambda t: sides[t])))

    def component(p: Column, i: Column, n: Column) -> Column:
        base = i == n - 1
        return F.struct(found(F.when(base, F.regexp_replace(p, r"\.[^.]*$", "")).otherwise(p), base).alias("sides"), F.when(base, F.lit("basename")).otherwise(F.lit("dirname")).alias("source"))

    def nearest(ps: Column) -> Column:
        found = F.transform(ps, lambda p, i: component(p, i, F.size(ps)))
        return F.get(F.filter(F.reverse(found), lambda c: F.size(c["sides"]) > 0), F.lit(0))

    def answer(hit: Column) -> Column:
        single = F.filter(hit["sides"], lambda s: s != "B")
        some = once(single, lambda s: F.when(F.size(s) > 1, F.struct(F.lit("U").alias("side"), hit["source"].alias("source"), F.lit(True).alias("conflict"))).otherwise(F.struct(F.coalesce(F.get(s, F.lit(0)), F.lit("B")).alias("side"), hit["source"].alias("source"), F.lit(False).alias("conflict"))))
        return F.when(hit.isNull(), none).otherwise(some)

    return F.when(path.rlike(ANY_SIDE), once(parts, lambda ps: once(nearest(ps), answer))).otherwise(none)


def glob_regex(glob: str) -> str:
    """A regular expression for a glob in which ``*`` and ``?`` match any character, slashes too. A glob that ends in
    ``/**/*`` also takes all that is below its folder."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif close > 0:
            inside = glob[i + 1 : close]
            out += "[" + ("^" + inside[1:] if inside.startswith("!") else inside).replace("\\", "\\\\") + "]"
            i = close
        else:
            out += "\\" + c if not c.isalnum() and c != "_" and c != "/" else c
        i += 1
    if glob.endswith("/**/*"):
        out += "|" + re.escape(glob[: -len("**/*")]) + ".*"
    return f"(?s)^(?:{out})$"


def top_text(items: Column, n: int = 3) -> Column:
    """``a (5); b (2)`` from an array of struct(n, first, k): by count, then by first appearance."""
    order = F.array_sort(items, lambda a, b: F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1).when(a["first"] < b["first"], -1).when(a["first"] > b["first"], 1).otherwise(0))
    return F.array_join(F.transform(F.slice(order, 1, n), lambda x: F.concat(x["k"].cast("string"), F.lit(" ("), x["n"].cast("string"), F.lit(")"))), "; ")


def range_text(low: Column, high: Column) -> Column:
    """``5`` or ``5-9``; empty without values."""
    return F.when(low.isNull(), F.lit("")).when(low == high, low.cast("string")).otherwise(F.concat(low.cast("string"), F.lit("-"), high.cast("string")))


def human_bytes(n: Column) -> Column:
    """Bytes with a unit of 1000."""
    out = F.concat(n.cast("string"), F.lit(" B"))
    for power, unit in ((1, "kB"), (2, "MB"), (3, "GB"), (4, "TB")):
        out = F.when(n >= 1000**power, F.concat(F.format_number(n / 1000.0**power, 1), F.lit(f" {unit}"))).otherwise(out)
    return out


def cell(value: Column, limit: int = 32_000) -> Column:
    """Text of a table cell, cut at the limit."""
    return F.substring(value.cast("string"), 1, limit)


def retry_after(header: Column, now: Column, floor: int = 1, cap: int = 3600) -> Column:
    """Seconds to wait by a Retry-After header: a number or an HTTP date; null if neither."""
    stamp = F.try_to_timestamp(F.regexp_replace(header, "^[A-Za-z]{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    seconds = F.coalesce(header.try_cast("double"), (F.unix_timestamp(stamp) - F.unix_timestamp(now)).cast("double"))
    return F.greatest(F.lit(float(floor)), F.least(F.lit(float(cap)), seconds))
