"""Column functions of the nomenclatural registry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of type material.
KINDS = ("holotype", "isotype", "paratype", "neotype", "lectotype", "epitype", "isolectotype", "syntype")
_KIND = r"(?i)\b(" + "|".join(KINDS) + r")s?\b"
#: Publishers by the prefix of their DOIs.
PUBLISHERS = (("springer", "10.1007/"), ("elsevier", "10.1016/"), ("wiley", "10.1111/"), ("wiley", "10.1002/"), ("taylor", "10.1080/"), ("mdpi", "10.3390/"), ("pensoft", "10.3897/"), ("frontiers", "10.3389/"), ("plos", "10.1371/"))


def typification(c: Column) -> Column:
    """array<struct<type_of_type, material array<string>>>: text split before each kind of type, material at commas.

    Text without a kind is one entry of the kind ``""``; "(Designated by ..." is cut off.
    """
    text = F.trim(F.regexp_replace(F.regexp_replace(c, r"^Typification:\s*", ""), r"(?i)\(designated by[^)]*\)?", ""))
    names = F.regexp_extract_all(text, F.lit(_KIND), 1)
    parts = F.split(text, _KIND)
    split = lambda s: F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != "")
    known = F.transform(names, lambda n, i: F.struct(F.initcap(n).alias("type_of_type"), split(F.get(parts, i + 1)).alias("material")))
    return F.when(F.size(names) > 0, known).when(text != "", F.array(F.struct(F.lit("").alias("type_of_type"), split(text).alias("material"))))


def merged_types(api: Column, html: Column) -> Column:
    """The first list and those of the second whose kind, case aside, the first lacks."""
    have = F.transform(api, lambda t: F.lower(t["type_of_type"]))
    return F.concat(api, F.filter(html, lambda t: ~F.array_contains(have, F.lower(t["type_of_type"]))))


def taxonomic_status(name_status: Column, name: Column, current: Column) -> Column:
    s = F.lower(F.trim(name_status))
    blank = F.coalesce(F.trim(current), F.lit("")) == ""
    return F.when(s == "invalid", "invalid").when(s == "orthographic variant", "orthographic_variant").when(blank, "unresolved").when(F.trim(name) == F.trim(current), "accepted").otherwise("synonym")


def protologue(journal: Column, volume: Column, part: Column, page: Column, year: Column) -> Column:
    """``Journal volume(part): page (year)``; missing pieces are left out."""
    vol = F.concat(volume, F.coalesce(F.concat(F.lit("("), part, F.lit(")")), F.lit("")))
    return F.concat_ws(" ", journal, F.concat(F.coalesce(vol, F.lit("")), F.coalesce(F.concat(F.lit(": "), page), F.lit(""))), F.concat(F.lit("("), year, F.lit(")")))


def publisher(doi: Column, prefixes: tuple[tuple[str, str], ...] = PUBLISHERS) -> Column:
    """The first publisher whose prefix the DOI has; null for others."""
    out = None
    for name, prefix in prefixes:
        out = F.when(doi.startswith(prefix), name) if out is None else out.when(doi.startswith(prefix), name)
    return out


def pdf_name(doi: Column) -> Column:
    return F.concat(F.regexp_replace(doi, r"[^A-Za-z0-9._-]+", "_"), F.lit(".pdf"))


def record(record_id: Column, species: Column, host: Column, typification: Column, basionym_record_id: Column, name_status: Column, current_name: Column, current_name_id: Column) -> Column:
    """struct<species, host, types, basionym, status, current_name, current_id> of a registry answer.

    A name that is its own basionym has none; the current name stays with synonyms and orthographic variants
    only; a name whose current record is itself is accepted.
    """
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    status = F.when(name_status == "Invalid", "invalid").when(name_status == "Orthographic variant", "orthographic_variant").when(F.trim(current_name_id) == record_id, "accepted").when(text(current_name) != "", "synonym").otherwise("unresolved")
    other = status.isin("synonym", "orthographic_variant")
    types = F.coalesce(_types(typification), F.array().cast("array<struct<type_of_type: string, material: array<string>>>"))
    return F.struct(
        species.alias("species"), F.trim(F.regexp_replace(F.coalesce(host, F.lit("")), "<[^>]+>", "")).alias("host"), types.alias("types"),
        F.when(basionym_record_id == record_id, "").otherwise(F.coalesce(basionym_record_id, F.lit(""))).alias("basionym"), status.alias("status"),
        F.when(other, text(current_name)).otherwise("").alias("current_name"), F.when(other, text(current_name_id)).otherwise("").alias("current_id"),
    )


_types = typification
