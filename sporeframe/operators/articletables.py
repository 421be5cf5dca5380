"""Tables of articles in long form ``(table keys, r, header, value)``: what their columns hold, and their rows as records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import tokens as K
from .prose import carry

#: Header words of each column type, in the order in which they are tried; a header need only contain one.
COLUMN_WORDS = {
    "species": ("species", "taxon", "organism", "name", "taxa", "genus/species", "genera/species", "scientific name"),
    "voucher": ("voucher", "specimen", "collection", "herbarium", "culture", "strain", "isolate", "sample"),
    "country": ("country", "locality", "location", "origin", "geo", "region", "collecting site"),
    "gb_its": ("its", "its1", "its2"),
    "gb_lsu": ("lsu", "28s", "d1/d2"),
    "gb_ssu": ("ssu", "18s"),
    "gb_tef1": ("tef", "ef1", "ef-1"),
    "gb_rpb1": ("rpb1", "rpb-1", "rpb 1"),
    "gb_rpb2": ("rpb2", "rpb-2", "rpb 2"),
    "gb_beta_tubulin": ("btub", "β-tubulin", "beta-tubulin", "tub2"),
    "accession": ("accession", "genbank", "gb"),
}
#: Values of a column that are looked at, and how many of them must be accessions.
SAMPLE, LEAST = 10, 3
ACCESSION = r"^[A-Z]{1,3}\d{5,8}(\.\d+)?$"
EMPTY = ("", "-", "nan", "none", "n/a")


def present(c: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(c)).isin(*EMPTY), F.lit(False))


def type_by_header(header: Column, words: Mapping[str, Sequence[str]] = COLUMN_WORDS) -> Column:
    low = F.lower(F.trim(header))
    out = None
    for kind, ws in words.items():
        hit = F.lit(False)
        for w in ws:
            hit = hit | low.contains(w)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def sampled(cells: DataFrame, table: Sequence[str], k: int = SAMPLE) -> DataFrame:
    """The first k present values of each column by row; the limit is applied before the shuffle."""
    w = W.partitionBy(*table, "header").orderBy("r", "value")
    return cells.filter(present(F.col("value"))).withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k)


def column_types(cells: DataFrame, table: Sequence[str], words: Mapping[str, Sequence[str]] = COLUMN_WORDS) -> DataFrame:
    """``(table, header, field, how)``: by header words, else ``accession`` if three of the first ten values are accessions; others vanish."""
    heads = cells.groupBy(*table, "header").agg(F.count("*").alias("cells"))
    acc = sampled(cells, table).groupBy(*table, "header").agg(F.count_if(F.trim("value").rlike(ACCESSION)).alias("acc"))
    x = heads.join(acc, [*table, "header"], "left").withColumn("by", type_by_header(F.col("header"), words))
    field = F.coalesce("by", F.when(F.col("acc") >= LEAST, "accession"))
    return x.withColumn("field", field).filter("field is not null").select(*table, "header", "field", F.when(F.col("by").isNotNull(), "header").otherwise("values").alias("how"))


def records(cells: DataFrame, table: Sequence[str], types: DataFrame) -> DataFrame:
    """``(table, r, species, voucher, country, codes)`` of the rows with an accession; codes is a sorted array of ``field=accession``.

    Of several columns of one type the last header in order counts, as a later column overwrites.
    """
    x = cells.filter(present(F.col("value"))).join(types, [*table, "header"])
    last = lambda f: F.max_by(F.when(F.col("field") == f, F.trim("value")), F.when(F.col("field") == f, F.col("header"))).alias(f)
    code = (F.col("field").startswith("gb_") | (F.col("field") == "accession")) & F.trim("value").rlike(ACCESSION)
    codes = F.array_sort(F.collect_set(F.when(code, F.concat_ws("=", "field", F.trim("value"))))).alias("codes")
    return x.groupBy(*table, "r").agg(last("species"), last("voucher"), last("country"), codes).filter("size(codes) > 0")


def merged_rows(cells: DataFrame, table: Sequence[str]) -> DataFrame:
    """``(table, r)`` of rows that hold several records: two accessions in a column of no gene, or two names with numbers in one cell."""
    v = F.col("value")
    gene = F.lower("header").rlike("its|lsu|tef|rpb")
    codes = F.size(F.regexp_extract_all(v, F.lit(r"\b[A-Z]{1,2}\d{5,8}\b"), 0)) >= 2
    names = (F.size(F.regexp_extract_all(v, F.lit(r"[A-Z][a-z]*\s*\d+"), 0)) >= 2) & v.contains(" ")
    return cells.filter((codes & ~gene) | names).select(*table, "r").distinct()


def filled_down(rows: DataFrame, table: Sequence[str], order: str, species: str, voucher: str, others: Sequence[str], block: Column | None = None) -> DataFrame:
    """Rows of tables whose species stands only in the first row of a group, or in a row of its own above it.

    A species row without other values opens a group and vanishes, as repeated heads do. A voucher, or any other
    text beside values, in the species column moves to the voucher column if that is empty. ``filled`` says
    whether the species came from above; ``block`` as in ``carry``.
    """
    value = F.trim(F.coalesce(F.col(species), F.lit("")))
    named = value.rlike(r"^[A-Z][a-z]*\.?\s+[a-z]+")
    beside = F.lit(False)
    for c in (voucher, *others):
        beside = beside | present(F.col(c))
    head = F.lower(value).contains("voucher") & F.lower(value).contains("reference")
    x = rows.filter(~head).withColumns({"_text": value, "_named": named, "_beside": beside})
    x = carry(x, list(table), order, F.when(F.col("_named"), F.col("_text")), "_last", block)
    code = F.col("_text").rlike(r"^[A-Z]{2,6}[- ]?\d+|^[A-Z][a-z]+\s+\d+") & ~F.col("_named")
    filled = ~F.col("_named") & F.col("_last").isNotNull() & (~present(F.col("_text")) | code | F.col("_beside"))
    moved = filled & present(F.col("_text")) & ~present(F.col(voucher))
    out = x.filter(~(F.col("_named") & ~F.col("_beside"))).withColumn("filled", filled)
    return out.withColumns({voucher: F.when(moved, F.col("_text")).otherwise(F.col(voucher)), species: F.when(F.col("filled"), F.col("_last")).otherwise(F.col("_text"))}).drop("_text", "_named", "_beside", "_last")


def best_header(heads: DataFrame, key: Sequence[str], order: str, genes: str) -> DataFrame:
    """The header of each document with the most gene columns among those whose gene names are short and known; the first of equals.

    A document without any such header keeps its first one. ``genes`` is an array of column heads.
    """
    short = F.coalesce(F.array_max(F.transform(genes, lambda g: F.length(F.trim(g)))), F.lit(0)) <= 30
    known = F.exists(genes, lambda g: F.lower(g).rlike("its|lsu|ssu|tef|rpb|btub|28s|18s|accession"))
    rank = F.struct(F.coalesce(short & known, F.lit(False)).alias("ok"), F.when(short & known, F.size(genes)).otherwise(0).alias("n"), (-F.col(order)).alias("o"))
    return heads.groupBy(*key).agg(F.max_by(F.struct(*[c for c in heads.columns if c not in key]), rank).alias("h")).select(*key, "h.*")
