"""Rules that mark records for a human check, and what text and names say about the device.

All are Column expressions over one row per record. Null inputs count as unknown: no rule holds for them.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import once

# Classes that are often wrong when they are alone, the statuses that are looked at, and limits.
DOUBTFUL_CLASSES = ("OCTA", "PSC")
REVIEWED_STATUSES = ("ok", "ok_partial_download")
EYE_SHARE, NOT_EYE_P, MASK_SHARE, LOW_CONFIDENCE, IR_SHARE = 0.5, 0.2, 0.3, 0.75, 0.2
HINT_CHARS, MATCH_CHARS, NAMES_READ = 1000, 40, 5000
HEIDELBERG = r"(?i)heidelberg|spectralis|\bhra ?2?\b|\bhrt\b|\.e2e\b|\.sdb\b"
# Makers, the pattern that names them in lower-case text, and words that tell the model.
MAKERS: tuple[tuple[str, str, tuple[tuple[str, str], ...]], ...] = (
    ("Heidelberg Engineering", r"heidelberg|spectralis|\bhra ?2?\b|\bhrt\b|\.e2e\b|\.sdb\b", (("spectralis", "Spectralis"), ("hra", "HRA2"), ("hrt", "HRT"))),
    ("Carl Zeiss Meditec", r"zeiss|cirrus|clarus|visucam|plex ?elite|stratus|angioplex|\.img\b(?=.*cirrus)", (("cirrus", "Cirrus HD-OCT"), ("clarus", "Clarus"), ("visucam", "Visucam"), ("plex", "PLEX Elite 9000"), ("stratus", "Stratus OCT"))),
    ("Topcon", r"topcon|triton|maestro|trc-?nw\d*|dri ?oct|3d ?oct-?\d+|\.fd[as]\b", (("triton", "DRI OCT Triton"), ("maestro", "3D OCT-1 Maestro"), ("trc", "TRC-NW"))),
    ("Optos", r"optos|optomap|daytona|california|silverstone|monaco|200tx|ultra-?wide-?field|\buwf\b", (("daytona", "Daytona"), ("california", "California"), ("silverstone", "Silverstone"), ("monaco", "Monaco"), ("200tx", "200Tx"))),
    ("Canon", r"\bcanon\b|\bcr-?2\b|\bcx-?1\b|xephilio|\bcr-?dgi\b", (("cr-2", "CR-2"), ("cx-1", "CX-1"), ("xephilio", "Xephilio OCT-A1"))),
    ("Nidek", r"nidek|afc-?\d{3}|rs-?3000|mirante|retiscan", (("afc", "AFC"), ("rs-3000", "RS-3000"), ("mirante", "Mirante"))),
    ("Optovue (Visionix)", r"optovue|avanti|rtvue|angiovue|\bsolix\b|\biwellness\b", (("avanti", "RTVue XR Avanti"), ("solix", "Solix"))),
    ("Kowa", r"\bkowa\b|nonmyd", ()),
    ("CenterVue / iCare", r"centervue|\beidon\b|\bdrs\b(?=.*(fundus|retin))|\bicare\b", (("eidon", "EIDON"), ("drs", "DRS"))),
    ("Leica / Bioptigen", r"bioptigen|envisu", (("envisu", "Envisu"),)),
    ("Remidio", r"remidio|fop-?nm", ()),
    ("Phelcom", r"phelcom|\beyer\b", (("eyer", "Eyer"),)),
    ("SVision", r"svision|vg ?200", (("vg200", "VG200"),)),
    ("Moptim", r"moptim", ()),
    ("Tomey", r"\btomey\b|casia", (("casia", "CASIA (anterior segment)"),)),
    ("Welch Allyn / Hillrom", r"welch ?allyn|riscan", ()),
    ("Thorlabs", r"thorlabs|telesto|ganymede", ()),
)
# Makers by the ending of their own formats; words for Optos that are ordinary words too, and what must stand beside them.
MAKER_OF_ENDING = ((".e2e", "Heidelberg Engineering"), (".sdb", "Heidelberg Engineering"), (".vol", "Heidelberg Engineering"), (".fda", "Topcon"), (".fds", "Topcon"), (".oct", "Bioptigen/Leica or Optovue"))
WEAK_WORDS = {"Optos": (("california", "daytona", "silverstone", "monaco", "200tx", "uwf", "ultra-widefield", "ultrawidefield", "ultra-wide-field"), "optos|optomap")}
# Layers of en-face angiography: code, meaning, words in paths, phrases in prose; and the code without a layer.
SLABS = (
    ("128265", "Superficial retina vasculature flow", "superficial|svp|scp", r"\bsuperficial (?:capillary|vascular|retinal) (?:plexus|complex|layer|slab)"),
    ("128269", "Deep retina vasculature flow", "deep|dcp", r"\bdeep (?:capillary|vascular|retinal) (?:plexus|complex|layer|slab)"),
    ("128271", "Outer retina vasculature flow", "outer retina|avascular|orcc", r"\bouter retina(?:l)? (?:slab|flow|layer)|\bavascular (?:outer retina|slab)\b"),
    ("128273", "Choriocapillaris vasculature flow", "choriocapillaris|cc", r"\bchoriocapillaris\b"),
    ("128275", "Choroid vasculature flow", "choroid", r"\bchoroid(?:al)? (?:slab|vasculature|vessel layer|flow)\b"),
    ("128263", "Radial peripapillary vasculature flow", "rpc|peripapillary|onh|disc", r"\bradial peripapillary capillar"),
)
NO_SLAB = "DCM 128259 Retina vasculature flow"

NO_TEXTS = "cast(array() as array<string>)"


def _texts(*rules: tuple[Column, Column]) -> Column:
    """The texts of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, text) for cond, text in rules]))


def likely_false_positive(status: Column, present: Column, label: Column, eye_share: Column) -> Column:
    """Why a record is on the list of likely false positives, else empty: only doubtful classes are present, and the
    metadata or the share of eye images speaks against it."""
    classes = F.array_sort(F.array_distinct(F.coalesce(present, F.expr(NO_TEXTS))))
    only = (F.size(classes) > 0) & (F.size(F.array_except(classes, F.array(*map(F.lit, DOUBTFUL_CLASSES)))) == 0)
    why = _texts(
        (F.upper(label) == "NEGATIVE", F.lit("discovery SetFit label NEGATIVE")),
        (eye_share < EYE_SHARE, F.concat(F.lit("eye image fraction "), F.format_string("%.2f", eye_share), F.lit(f" < {EYE_SHARE:g}"))),
    )
    listed = F.coalesce(status.isin(*REVIEWED_STATUSES), F.lit(False)) & only & (F.size(why) > 0)
    return F.when(listed, F.concat(F.lit("only "), F.array_join(classes, " + "), F.lit("; "), F.array_join(why, "; "))).otherwise(F.lit(""))


def modality_review(present: Column, p_eye: Column, label: Column, mask_share: Column, dominant: Column, confidence: Column) -> Column:
    """struct(flags, low_trust): what contradicts the eye classes of a record. Low confidence is told but not low trust."""
    name = F.upper(F.coalesce(label, F.lit("")))
    some = F.size(F.coalesce(present, F.expr(NO_TEXTS))) > 0
    not_eye = F.coalesce(p_eye < NOT_EYE_P, F.lit(False)) | (p_eye.isNull() & (name == "NEGATIVE"))
    masks = F.coalesce(mask_share >= MASK_SHARE, F.lit(False))
    said = F.concat(F.lit("setfit_not_eye (SetFit p(eye) "), F.coalesce(F.format_string("%.3f", p_eye), F.lit("n/a")), F.lit(", label "), F.when(name == "", "n/a").otherwise(name), F.lit(")"))
    said = F.when(p_eye.isNull(), F.concat(F.lit("setfit_not_eye (SetFit p(eye) n/a, label "), F.when(name == "", "n/a").otherwise(name), F.lit(")"))).otherwise(said)
    flags = _texts(
        (not_eye, said),
        (masks, F.concat(F.lit("mask_like ("), F.format_string("%.0f", mask_share * 100), F.lit("% of classified images are masks or label maps)"))),
        (dominant.isNotNull() & (confidence < LOW_CONFIDENCE), F.concat(F.lit("low_confidence ("), dominant, F.lit(" mean top-1 confidence "), F.format_string("%.2f", confidence), F.lit(")"))),
    )
    return F.struct(F.when(some, F.array_join(flags, "; ")).otherwise(F.lit("")).alias("flags"), (some & (not_eye | masks)).alias("low_trust"))


def ir_device(present: Column, n: Column, share: Column, dominant: Column, maker: Column, source: Column, model: Column, hint: Column, hint_source: Column) -> Column:
    """struct(hint, candidate): evidence of the device where infrared images are dominant or substantial, and whether it
    speaks for another maker than Heidelberg.

    ``maker`` from the images' own headers (source dicom_header or exif) decides alone; hints of the record only without
    it. ``present``: the eye classes; an empty array means a record without eye images, null that it isn't known.
    """
    full = lambda c: F.when(c != "", c)  # noqa: E731  empty as null
    own = F.when(source.isin("dicom_header", "exif"), F.concat_ws(" ", full(maker), F.when(full(maker).isNotNull(), full(model))))
    own = full(own)
    record = F.when(full(hint).isNotNull(), F.concat(hint, F.lit(" (record-level "), F.coalesce(full(hint_source), F.lit("hint")), F.lit(")")))
    text = F.concat_ws("; ", F.concat(own, F.lit(" (IR images, "), source, F.lit(")")), record)
    applies = F.coalesce(F.size(present) > 0, F.lit(True)) & F.coalesce(n > 0, F.lit(False)) & F.coalesce(F.coalesce(dominant, F.lit(False)) | (share >= IR_SHARE), F.lit(False))
    none = own.isNull() & record.isNull()
    return F.struct(
        F.when(~applies, "").when(none, "no manufacturer hint found").otherwise(F.substring(text, 1, HINT_CHARS)).alias("hint"),
        (applies & ~none & ~F.coalesce(own, text).rlike(HEIDELBERG)).alias("candidate"),
    )


def classes_present(counts: dict[str, Column], n: Column, least: float) -> Column:
    """Classes with at least one image and at least the share ``least`` of ``n``, in the order given."""
    return _texts(*[((F.coalesce(c, F.lit(0)) >= 1) & (n > 0) & (c / F.when(n > 0, n) >= least), F.lit(name)) for name, c in counts.items()])


def beginnings(pattern: str) -> list[str]:
    """The plain text that each alternative of a pattern begins with. A text without any of them has no match."""
    out = []
    for part in re.split(r"\|(?![^(]*\))", pattern):
        plain, rest = re.match(r"(?:\\b)?((?:[a-z0-9 -]|\\\.)+)(.?)", part).groups()
        plain = plain.replace("\\", "")
        out.append(plain[:-1] if rest and rest in "?*{" else plain)
    if not all(out):
        raise ValueError("an alternative has no plain beginning")
    return out


def maker_hints(text: Column, names: Column) -> Column:
    """array<struct(manufacturer, model, matched, source)>: makers by the endings of file names, then by words of the text, then
    of the names; each maker once but for endings. Of the names the first NAMES_READ count."""
    plain = F.coalesce(names, F.expr(NO_TEXTS))
    hint = lambda maker, model, matched, source: F.struct(F.lit(maker).alias("manufacturer"), model.alias("model"), matched.alias("matched"), F.lit(source).alias("source"))
    ends = lambda e: lambda x: x.endswith(e) & (F.length(x) > len(e)) & ~x.endswith("/" + e)

    def counted(low: Column) -> Column:
        counts = [F.size(F.filter(low, ends(e))).alias(f"n{i}") for i, (e, _) in enumerate(MAKER_OF_ENDING)]
        return F.struct(*counts, F.lower(F.coalesce(text, F.lit(""))).alias("text"), F.array_join(F.slice(low, 1, NAMES_READ), " ").alias("filename"))

    def word(maker: str, pattern: str, models: tuple[tuple[str, str], ...], source: str, h: Column) -> Column:
        def said(hit: Column) -> Column:
            ok = hit != ""
            if maker in WEAK_WORDS:
                weak, beside = WEAK_WORDS[maker]
                ok = ok & (~F.replace(hit, F.lit(" "), F.lit("-")).isin(*weak) | h.rlike(beside))
            model = reduce(lambda c, m: F.when(h.contains(m[0]), F.lit(m[1])).otherwise(c), reversed(models), F.lit(""))
            return F.when(ok, hint(maker, model, F.substring(hit, 1, MATCH_CHARS), source))

        near = reduce(lambda a, b: a | b, [h.contains(x) for x in beginnings(pattern)])
        return F.when(near, once(F.regexp_extract(h, pattern, 0), said))

    def found(x: Column) -> Column:
        out, seen = [], {}
        for i, (ending, maker) in enumerate(MAKER_OF_ENDING):
            n = x[f"n{i}"]
            out.append(F.when(n > 0, hint(maker, F.lit(""), F.concat(F.lit(f"{ending} x"), n.cast("string")), "extension")))
            seen[maker] = seen.get(maker, F.lit(False)) | (n > 0)
        for maker, pattern, models in MAKERS:
            tries = [word(maker, pattern, models, source, x[source]) for source in ("text", "filename")]
            out.append(F.when(~seen.get(maker, F.lit(False)), F.coalesce(*tries)))
        return F.array_compact(F.array(*out))

    return once(F.transform(plain, lambda n: F.lower(n)), lambda low: once(counted(low), found))


def octa_slab(paths: Column, text: Column) -> Column:
    """The code of the one layer that the paths name, else the text; the general code if none or several are named."""
    path, prose = F.lower(F.coalesce(paths, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))
    said = lambda code, meaning: F.lit(f"DCM {code} {meaning}")
    by_path = _texts(*[(path.rlike(f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"), said(code, meaning)) for code, meaning, words, _ in SLABS])
    by_text = _texts(*[(prose.rlike(phrase), said(code, meaning)) for code, meaning, _, phrase in SLABS])
    hits = F.when(F.size(by_path) > 0, by_path).otherwise(by_text)
    return F.when(F.size(hits) == 1, F.element_at(hits, 1)).otherwise(F.lit(NO_SLAB))
