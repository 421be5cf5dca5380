"""Predicates for values that were not given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Filler words that stand for "no value was given", in lower case.
FILLERS = (
    "-", "--", "?", "n/a", "na", "nan", "none", "null", "missing", "unknown", "not applicable",
    "not collected", "not provided", "not recorded", "missing: not given",
)

#: Tokens that the gap operators take as missing.
GAP_TOKENS = ("", "nan", "none")


def squeeze(c: Column | str) -> Column:
    """White space of any kind collapsed to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def absent(c: Column | str) -> Column:
    """True for null, blank and filler words; never null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(squeeze(c)).isin("", *FILLERS), F.lit(True))


def missing(c: Column | str, tokens: tuple[str, ...] = GAP_TOKENS) -> Column:
    """True for null and for the given tokens, ends and case aside; never null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(F.lower(c)).isin(*tokens), F.lit(True))


def sql_absent(c: str) -> str:
    """The predicate ``absent`` in portable SQL, for the oracles."""
    words = ", ".join("'" + w + "'" for w in ("", *FILLERS))
    return f"(coalesce(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), '') in ({words}))"
