"""Text folding. Everything is a column expression; only ``ascii_fold`` beyond Latin letters would need a UDF."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _table() -> tuple[str, str]:
    a, b = [], []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode()
        if len(base) == 1:
            a.append(chr(cp))
            b.append(base)
    return "".join(a), "".join(b)


_FROM, _TO = _table()


def ascii_fold(c: Column) -> Column:
    """Lower case; Latin letters lose their accents, whatever else isn't ASCII vanishes."""
    return F.lower(F.regexp_replace(F.translate(c, _FROM, _TO), r"[^\x00-\x7f]", ""))


def ascii_only(c: Column) -> Column:
    return c.rlike(r"^[\x00-\x7f]*$")


def ngrams(words: Column, n: int) -> Column:
    """Word n-grams in order; none if there are too few words."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))


def context(words: Column, at: Column, around: int, width: int | Column = 1) -> Column:
    """The words around position ``at`` (from 1)."""
    first = F.greatest(F.lit(1), at - around)
    return F.array_join(F.slice(words, first, at + width + around - first), " ")


def jaccard_sizes(a: Column, b: Column) -> Column:
    """struct<common, all> of two arrays as sets."""
    return F.struct(F.size(F.array_intersect(a, b)).alias("common"), F.size(F.array_union(a, b)).alias("all"))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), "&nbsp;", " "), "&lt;", "<"), "&amp;", "&")
