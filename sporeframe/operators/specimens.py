"""Specimen and country pairs from the prose of sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.codes import code_key_prose
from ..functions.tokens import is_no_collector
from .places import mentions

#: A collector or herbarium with a number.
CODE = r"\b(?:[A-Z][a-z]{3,}|[A-Z]{3,6}) ?\d{2,6}\b"
#: A name with a series of numbers, a name with a number, an acronym with a number.
SERIES = r"\b[A-Z][A-Za-z'-]+\s+\d{2,7}[A-Za-z]?(?:\s*,\s*\d{2,7}[A-Za-z]?)+\b"
NAMED = r"\b[A-Z][A-Za-z'-]+\s+\d{2,7}[A-Za-z]?\b"
ACRONYM = r"\b[A-Z]{2,}[-\s:]?\d{2,7}(?:\.\d+)?\b"
_NAME, _NUMBER = r"^([A-Z][A-Za-z'-]*)", r"\d{2,7}[A-Za-z]?"


def clause_vouchers(clause: Column) -> Column:
    """array<string> of the vouchers of a clause: series spelled out, then names and acronyms with a number; months are no names.

    Vouchers that are equal without blanks, punctuation and case count once, as first found.
    """
    hits = lambda p: F.regexp_extract_all(clause, F.lit(p), 0)
    join = lambda h, n, name=_NAME: F.concat_ws(" ", F.regexp_extract(h, name, 1), n)
    series = F.flatten(F.transform(hits(SERIES), lambda h: F.transform(F.regexp_extract_all(h, F.lit(_NUMBER), 0), lambda n: join(h, n))))
    named = F.transform(hits(NAMED), lambda h: join(h, F.regexp_extract(h, r"\s(\S+)$", 1)))
    acronyms = F.transform(hits(ACRONYM), lambda h: join(h, F.regexp_extract(h, r"(\d+(?:\.\d+)?)$", 1), "^([A-Z]+)"))
    known = F.filter(F.concat(series, named, acronyms), lambda v: ~is_no_collector(F.substring_index(v, " ", 1)))
    keys = F.transform(known, lambda v: code_key_prose(v))
    return F.filter(known, lambda v, i: F.array_position(keys, F.get(keys, i)) == i + 1)


def clauses(sections: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, pos, clause)``: text cut at full stops and semicolons; "Ibid." begins a clause."""
    flat = F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"(?i)\bibid\.?,?", "; ")
    return sections.select(key, F.posexplode(F.split(flat, r"[.;]\s+")).alias("pos", "clause"))


def clause_pairs(sections: DataFrame, key: str, text: str, countries: DataFrame) -> DataFrame:
    """``(key, pos, voucher, country)``: the vouchers of each clause with the last single country named up to it.

    ``countries`` (country, spelling, ord) is a fixed list. A clause with several countries carries none on.
    """
    c = clauses(sections, key, text)
    named = mentions(c, [key, "pos"], "clause", countries).groupBy(key, "pos").agg(F.collect_set("country").alias("cs"))
    x = c.join(named, [key, "pos"], "left").withColumn("mark", F.when(F.size("cs") == 1, F.get("cs", F.lit(0))).when(F.size("cs") > 1, ""))
    x = x.withColumn("country", F.last("mark", ignorenulls=True).over(W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)))
    return x.select(key, "pos", F.explode(clause_vouchers(F.col("clause"))).alias("voucher"), "country").filter("country <> ''")
