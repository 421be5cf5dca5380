"""Column functions on what external services and web pages return; the services themselves are input tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import missing
from .registry import typification
from .text import strip_tags

#: File extensions of supplements.
EXTENSIONS = ("xlsx", "xls", "docx", "doc", "csv", "tsv", "txt", "zip", "pdf")


def html_types(page: Column) -> Column:
    """Types named in the typification section of a registry page, as ``typification`` gives them, without empty ones."""
    section = F.regexp_extract(page, r"(?is)typification\s*(?:details)?\s*:?\s*(?:</[^>]+>\s*)*(.*?)(?:<h\d|</table|</div|$)", 1)
    text = F.trim(F.regexp_replace(strip_tags(F.regexp_replace(section, r"(?i)<br\s*/?>|</p>|</li>", " ")), r"\s+", " "))
    return F.filter(typification(F.when(text != "", text)), lambda t: (t["type_of_type"] != "") & (F.size(t["material"]) > 0))


def file_name(url: Column) -> Column:
    """The last part of a link's path, decoded, fit for a file system."""
    path = F.regexp_replace(url, r"[?#].*$", "")
    return F.regexp_replace(F.try_url_decode(F.substring_index(path, "/", -1)), r'[\\/:*?"<>|\s]+', "_")


def file_type(url: Column) -> Column:
    """The supplement's extension, from the path or a query parameter; null for other links."""
    ext = F.lower(F.regexp_extract(url, r"(?i)\.(" + "|".join(EXTENSIONS) + r")(?:$|[?#&])", 1))
    return F.when(ext != "", ext)


def page_links(page: Column) -> Column:
    """array<struct<url, label>> of the links of a page, each address once, in order."""
    anchors = F.regexp_extract_all(page, F.lit(r"(?is)<a\s[^>]*href=[\"'][^\"']+[\"'][^>]*>.*?</a>"), 0)
    one = F.transform(anchors, lambda a: F.struct(F.regexp_extract(a, r"(?i)href=[\"']([^\"']+)[\"']", 1).alias("url"), F.trim(strip_tags(a)).alias("label")))
    return F.filter(one, lambda x, i: ~F.exists(F.slice(one, F.lit(1), i), lambda y: y["url"] == x["url"]))


def supplement_links(page: Column) -> Column:
    """Links to files, or labelled as supplements."""
    return F.filter(page_links(page), lambda x: file_type(x["url"]).isNotNull() | F.coalesce(x["label"].rlike(r"(?i)supplement|additional file|appendix|table s\d"), F.lit(False)))


def occurrence_country(country: Column, code_name: Column, verbatim: Column, publishing: Column | None = None) -> Column:
    """The country of an occurrence: its name, its code's name, the verbatim text; the publisher's only if asked for."""
    pick = lambda c: F.when(~missing(c), F.trim(c))
    return F.coalesce(pick(country), pick(code_name), *([pick(publishing)] if publishing is not None else []), pick(verbatim))


def occurrence_matches(code: Column, fields: list[Column], species: Column | None = None, name: Column | None = None) -> Column:
    """An occurrence bears a code: a field equals it after normalisation; or, if the genera don't differ, it fits.

    A code of letters and digits fits if all its runs occur in one field or in all fields together, one of letters
    only if one of its words is a whole word of a field; digits alone must be equal. The genus of ``species`` must
    occur in ``name`` where both are given.
    """
    from .codes import code_key_match, genus_of

    key = code_key_match(code)
    letters, digits = F.transform(F.regexp_extract_all(code, F.lit("[A-Za-z]+"), 0), lambda x: F.lower(x)), F.regexp_extract_all(code, F.lit("[0-9]+"), 0)
    runs = F.concat(letters, digits)
    texts = F.filter(F.array(*fields), lambda v: v.isNotNull())
    merged = code_key_match(F.array_join(texts, ""))
    holds = lambda text: F.forall(runs, lambda r: F.contains(text, r))
    both = (F.size(letters) > 0) & (F.size(digits) > 0)
    word = F.exists(texts, lambda v: F.arrays_overlap(letters, F.split(F.lower(v), r"\W+")))
    fits = F.when(both, holds(merged) | F.exists(texts, lambda v: holds(F.lower(v)))).when(F.size(letters) > 0, word).otherwise(F.lit(False))
    if species is not None and name is not None:
        genus = F.lower(genus_of(species))
        fits = fits & (genus.isNull() | (F.coalesce(F.trim(name), F.lit("")) == "") | F.contains(F.lower(name), genus))
    equal = F.exists(texts, lambda v: (code_key_match(v) == key) & (key != ""))
    return F.coalesce((key != "") & (equal | fits), F.lit(False))


def salvaged_pairs(answer: Column) -> Column:
    """array<struct<voucher, country>> from a model's answer: strict JSON, the text between the outermost brackets, or single pairs by pattern."""
    schema = "array<struct<voucher: string, country: string>>"
    strict = F.from_json(answer, schema)
    inner = F.from_json(F.regexp_extract(answer, r"(?s)(\[.*\])", 1), schema)
    hits = F.regexp_extract_all(answer, F.lit(r'"voucher"\s*:\s*"[^"]*"\s*,\s*"country"\s*:\s*"[^"]*"'), 0)
    loose = F.transform(hits, lambda h: F.struct(F.regexp_extract(h, r'"voucher"\s*:\s*"([^"]*)"', 1).alias("voucher"), F.regexp_extract(h, r'"country"\s*:\s*"([^"]*)"', 1).alias("country")))
    good = lambda a: F.when(F.exists(a, lambda x: x["voucher"].isNotNull()), a)
    return F.coalesce(good(strict), good(inner), loose)


def publisher_of(url: Column, domains: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The first publisher one of whose domains occurs in the address, ``generic`` for others. ``domains`` is a parameter."""
    low = F.lower(url)
    out = F.when(low.isNull(), F.lit(None).cast("string"))
    for name, parts in (DOMAINS if domains is None else domains).items():
        for d in parts:
            out = out.when(low.contains(d), name)
    return out.otherwise("generic")


#: Domains of publishers whose supplement pages differ.
DOMAINS = {"springer": ("springer.com", "link.springer"), "wiley": ("wiley.com",), "elsevier": ("sciencedirect.com", "elsevier.com"), "taylor": ("tandfonline.com",), "mdpi": ("mdpi.com",), "pensoft": ("pensoft.net",), "frontiers": ("frontiersin.org",), "plos": ("plos.org",)}
