"""Cleaning, categories and keys of links."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# DOI prefixes of data repositories.
DATA_DOI_PREFIXES = {
    "10.5281": "Zenodo", "10.5061": "Dryad", "10.6084": "figshare", "10.17632": "Mendeley Data", "10.21227": "IEEE DataPort",
    "10.6019": "EMPIAR", "10.7910": "Harvard Dataverse", "10.13026": "PhysioNet", "10.7937": "TCIA", "10.17605": "OSF",
    "10.34740": "Kaggle", "10.60775": "FAIRhub", "10.18150": "Figshare institutional", "10.4121": "4TU.ResearchData",
    "10.15468": "GBIF", "10.25740": "Stanford Digital Repository", "10.57967": "Hugging Face",
}
# Parts of host names (of host and path for datasets) by category.
DATASET_DOMAINS = (
    "zenodo.org", "figshare.com", "datadryad.org", "data.mendeley.com", "kaggle.com", "physionet.org", "osf.io", "dataverse",
    "ieee-dataport.org", "openneuro.org", "grand-challenge.org", "lila.science", "ebi.ac.uk", "medicaldecathlon.com", "synapse.org",
    "cancerimagingarchive.net", "dnanex.us", "proteinatlas.org", "ukbiobank.ac.uk", "fairhub.io", "aireadi.org", "openml.org",
    "data.gov", "datacite.org", "b2share", "archive.ics.uci.edu", "paperswithcode.com/dataset", "tianchi.aliyun.com", "dataportal",
    "4tu.nl", "gin.g-node.org", "brainlife.io",
)
CODE_DOMAINS = ("github.com", "gitlab", "bitbucket.org", "pypi.org", "sourceforge.net", "colab.research.google.com", "hub.docker.com", "cran.r-project.org", "readthedocs")
PAPER_DOMAINS = (
    "doi.org", "arxiv.org", "biorxiv.org", "medrxiv.org", "pubmed", "ncbi.nlm.nih.gov", "sciencedirect.com", "springer", "nature.com",
    "wiley.com", "mdpi.com", "frontiersin.org", "ieeexplore.ieee.org", "dl.acm.org", "plos.org", "elsevier", "tandfonline.com",
    "researchgate.net", "arvojournals.org", "bmj.com", "jamanetwork.com", "thelancet.com", "cell.com", "science.org", "oup.com",
    "sagepub.com", "semanticscholar.org", "openreview.net", "aclanthology.org", "cvf.com", "neurips.cc", "iop.org", "osapublishing",
    "optica.org", "spiedigitallibrary.org", "hindawi.com", "karger.com", "lww.com",
)
CLOUD_DOMAINS = (
    "drive.google.com", "docs.google.com", "dropbox.com", "onedrive", "1drv.ms", "sharepoint.com", "box.com", "mega.nz", "pan.baidu.com",
    "wetransfer", "amazonaws.com", "storage.googleapis.com", "blob.core.windows.net", "icloud.com", "jianguoyun", "weiyun",
)
# Words that scrapers glue to the end of a link, and what marks a path as data.
GLUED = (
    r"(?<=[a-z0-9/_\-])(The|This|These|That|For|In|See|And|Available|Please|More|Our|We|It|All|To|Data|Dataset|Code|Paper|Link|Download|"
    r"Here|Note|From|With)$"
)
DATA_PATH = r"(?i)(?:^|[/_\-.?=])(data|dataset|datasets|download|downloads|files?)(?:$|[/_\-.?=])"
DATA_EXT = r"(?i)\.(zip|tar|tgz|gz|7z|rar|h5|nii|dcm|png|jpe?g|tiff?)$"
INSTITUTION = r"\.(edu|gov|ac\.[a-z]{2}|edu\.[a-z]{2}|gov\.[a-z]{2})$|(^|\.)(uni-|univ|university|hospital|institut|klinik)"
PUNCTUATION = ".,;:)]}>'\""


def _rstrip(c: Column) -> Column:
    return F.regexp_replace(c, "[" + re.escape(PUNCTUATION) + "]+$", "")


def clean_link(url: Column) -> Column:
    """Cut at U+FFFD and at an unbalanced bracket, then twice strip punctuation and a glued word, and punctuation again."""
    u = F.split(F.trim(F.coalesce(url, F.lit(""))), "�")[0]
    opens = F.length(u) - F.length(F.replace(u, F.lit("("), F.lit("")))
    closes = F.length(u) - F.length(F.replace(u, F.lit(")"), F.lit("")))
    u = F.when(opens > closes, F.regexp_replace(u, r"\([^(]*$", "")).otherwise(u)
    for _ in range(2):
        u = F.regexp_replace(_rstrip(u), GLUED, "")
    return _rstrip(u)


def absolute(url: Column) -> Column:
    """Links as they are, bare DOIs and www hosts with a scheme, all else null."""
    return F.when(url.rlike("^(https?|ftp)://"), url).when(url.startswith("10."), F.concat(F.lit("https://doi.org/"), url)).when(url.startswith("www."), F.concat(F.lit("https://"), url))


def link_key(url: Column) -> Column:
    """What equal links share."""
    return F.replace(F.regexp_replace(F.lower(url), "/+$", ""), F.lit("http://"), F.lit("https://"))


def link_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1))


def link_path(url: Column) -> Column:
    return F.regexp_extract(url, "^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)", 1)


def doi_of(url: Column) -> Column:
    """The DOI in a text, without trailing dots, or null."""
    hit = F.regexp_extract(url, r"(10\.[0-9]{4,9}/[^\s\"<>]+)", 1)
    return F.when(hit != "", F.regexp_replace(hit, r"\.+$", ""))


def _any(hay: Column, needles: tuple[str, ...]) -> Column:
    return hay.rlike("|".join(re.escape(n) for n in needles))


def category(url: Column) -> tuple[Column, Column]:
    """(category, detail): a data or paper DOI, cloud drive, data hub, dataset repository, code, paper, institution, other."""
    host, path = link_host(url), link_path(url)
    doi = F.when(host.contains("doi.org") | url.startswith("10."), doi_of(url))
    names = F.create_map(*[F.lit(x) for kv in DATA_DOI_PREFIXES.items() for x in kv])
    repository = F.try_element_at(names, F.split(doi, "/")[0])
    rules = [
        (repository.isNotNull(), "dataset_repository"),
        (doi.isNotNull(), "paper_doi"),
        (_any(host, CLOUD_DOMAINS), "cloud_drive"),
        (host.contains("huggingface.co") & path.contains("/datasets/"), "dataset_repository"),
        (host.contains("huggingface.co"), "code"),
        (_any(F.lower(F.concat(host, path)), DATASET_DOMAINS), "dataset_repository"),
        (_any(host, CODE_DOMAINS), "code"),
        (_any(host, PAPER_DOMAINS), "paper_doi"),
        (host.rlike(INSTITUTION) | host.endswith("github.io"), "institutional"),
    ]
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, value in rules[1:]:
        out = out.when(cond, F.lit(value))
    return out.otherwise(F.lit("other")), F.when(repository.isNotNull(), F.concat(F.lit("DOI "), repository)).when(doi.isNotNull(), F.lit("DOI")).otherwise(host)


def likely_dataset(url: Column, kind: Column, scraper: Column) -> Column:
    path = link_path(url)
    return (
        F.when(kind.isin("dataset_repository", "cloud_drive"), True)
        .when(F.coalesce(scraper.isin("archive_download", "direct_file", "potential_download"), F.lit(False)), True)
        .when(path.rlike(DATA_EXT), True)
        .when(kind == "paper_doi", False)
        .otherwise(path.rlike(DATA_PATH))
    )


def is_self_link(key: Column, record: Column) -> Column:
    """Whether a link's key names the record itself: its pages, downloads or DOI."""
    article = F.regexp_replace(record, "^figshare-", "")
    quoted = F.concat(F.lit("\\Q"), article, F.lit("\\E"))
    fig = F.regexp_like(key, F.concat(F.lit(r"figshare\.com/(articles/(.+/)?|ndownloader/articles/|v2/articles/)"), quoted, F.lit(r"($|[/?#])"))) | F.regexp_like(key, F.concat(F.lit(r"10\.6084/m9\.figshare\."), quoted, F.lit(r"(\.v[0-9]+)?$")))
    zen = F.regexp_like(key, F.concat(F.lit(r"zenodo\.org/(records?|deposit)/"), quoted, F.lit(r"($|[/?#])"))) | F.endswith(key, F.concat(F.lit("10.5281/zenodo."), record))
    return F.when(F.coalesce(record, F.lit("")) == "", False).when(record.startswith("figshare-"), fig).otherwise(zen)


def definitive(status: Column) -> Column:
    """An HTTP answer that a retry won't change."""
    return F.coalesce((status >= 200) & (status < 500) & ~status.isin(408, 429), F.lit(False))


def is_zenodo(url: Column) -> Column:
    host, path = link_host(url), link_path(url)
    return (host == "zenodo.org") | host.endswith(".zenodo.org") | (host.endswith("doi.org") & F.lower(path).startswith("/10.5281/"))
