"""Marker classification and the specimen matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import absent

#: Marker phrases of this engine's own seed dictionary, in the order that breaks ties.
PHRASES = (
    ("ITS", "internal transcribed spacer"), ("ITS", "its region"), ("ITS", "5.8s ribosomal"), ("LSU", "large subunit ribosomal"), ("LSU", "lsu region"), ("LSU", "28s ribosomal"),
    ("SSU", "small subunit ribosomal"), ("SSU", "ssu region"), ("SSU", "18s ribosomal"), ("TEF1", "translation elongation factor 1"), ("TEF1", "tef1 region"), ("RPB1", "rna polymerase ii largest subunit"),
    ("RPB1", "rpb1 region"), ("RPB2", "rna polymerase ii second largest subunit"), ("RPB2", "rpb2 region"), ("BTUB", "beta-tubulin"), ("BTUB", "beta tubulin"), ("ACT", "actin gene"),
)
#: Patterns tried in this order where no phrase occurs, each with one that must not occur (other factors, alike names).
FALLBACK = (
    ("ITS", r"\bits[12]?\b", None), ("LSU", r"\b(lsu|28s|nlsu)\b", None), ("SSU", r"\b(ssu|18s|nssu)\b", None),
    ("TEF1", r"\b(tef1?|ef1)\b|(elongation\s+factor|\bef)[-\s]*(1[-\s]?alpha|alpha[-\s]?1|1)\b", r"(factor|\bef)[-\s]*(g|tu|2|3|1[-\s]?(gamma|beta|delta))\b|\bspt[456]\b"),
    ("RPB2", r"\brpb2\b|rna\s+polymerase\s+(ii|2|b)\s+(second\s+(largest\s+)?)?subunit", None),
    ("RPB1", r"\brpb1\b|rna\s+polymerase\s+(ii|2)\s+largest\s+subunit", r"largest\s+subunit\s*2"),
    ("BTUB", r"beta[-\s]?tubulin|\btub2?\b.*(gene|partial|cds)", r"beta[-\s]?tubulin[-\s]*(like|domain)"),
    ("ATP6", r"\batp6\b|atp(ase)?\s+synthase\s+(subunit\s+)?6", None),
)
#: Every marker that the dictionary knows, in its order.
MARKERS = tuple(dict.fromkeys([m for m, _ in PHRASES] + [m for m, *_ in FALLBACK]))


def marker_of(description: Column, phrases: Sequence[tuple[str, str]] = PHRASES) -> Column:
    """The marker of the longest phrase that occurs (tie: the earlier one), else of the first fallback pattern.

    One CASE over the ordered dictionary: it stops at the first hit and never multiplies rows.
    """
    low = F.lower(description)
    out = None
    for m, p in sorted(phrases, key=lambda x: -len(x[1])):
        out = F.when(low.contains(p), m) if out is None else out.when(low.contains(p), m)
    for m, p, no in FALLBACK:
        out = out.when(low.rlike(p) & ~low.rlike(no) if no else low.rlike(p), m)
    return out


def joined_set(c: Column) -> Column:
    """Distinct present values, sorted, joined by a bar."""
    return F.array_join(F.array_sort(F.collect_set(F.when(~absent(c), c))), " | ")


def long_matrix(df: DataFrame, key: str, marker: str, accession: str, order: str) -> DataFrame:
    """``(key, marker, accession)``: the last record of each cell by ``order``."""
    return df.filter(F.col(key).isNotNull() & F.col(marker).isNotNull()).groupBy(key, marker).agg(F.max_by(accession, order).alias(accession))


def specimen_matrix(df: DataFrame, key: str, sets: Sequence[str], marker: str, accession: str, order: str, markers: Sequence[str]) -> DataFrame:
    """One row a key: joined sets, one column for each marker (the last record wins) and the number of filled ones.

    One aggregation with map-side combination; the markers are an explicit list, so no pivot pass over the data.
    """
    cell = {m: F.max_by(F.when(F.col(marker) == m, F.col(accession)), F.when(F.col(marker) == m, F.col(order))) for m in markers}
    got = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[joined_set(F.col(s)).alias(s) for s in sets], *[c.alias(m) for m, c in cell.items()])
    return got.withColumn("how_multiloci", sum((F.when(F.coalesce(F.col(m), F.lit("")) != "", 1).otherwise(0) for m in markers), F.lit(0)))


def wide_matrix(df: DataFrame, key: str, sets: Sequence[str], marker: str, accession: str, sequence: str, order: str, markers: Sequence[str]) -> DataFrame:
    """``specimen_matrix`` with a column ``seq<M>`` beside each marker ``M``: the sequence of the record that won the cell.

    ``markers`` is a list of run time, such as the distinct ones of the data; a marker without records gives empty columns.
    """
    of = lambda c, m: F.max_by(F.when(F.col(marker) == m, F.struct(c)), F.when(F.col(marker) == m, F.col(order)))[c]
    cells = [x for m in markers for x in (of(accession, m).alias(m), of(sequence, m).alias(f"seq{m}"))]
    got = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[joined_set(F.col(s)).alias(s) for s in sets], *cells)
    return got.withColumn("how_multiloci", sum((F.when(F.coalesce(F.col(m), F.lit("")) != "", 1).otherwise(0) for m in markers), F.lit(0)))
