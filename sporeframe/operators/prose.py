"""Operators on ordered lines, clauses and n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lines_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, line_no, line)``: trimmed non-empty lines, numbered as they stand."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("line", F.trim("line")).filter("line <> ''")


def runs(df: DataFrame, key: str, order: str, flag: Column) -> DataFrame:
    """``(key, start, end, n)`` of the maximal runs of flagged consecutive rows (gaps and islands)."""
    w = W.partitionBy(key).orderBy(order)
    x = df.withColumn("_i", F.row_number().over(w)).filter(flag)
    x = x.withColumn("_g", F.col("_i") - F.row_number().over(w))
    return x.groupBy(key, "_g").agg(F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("n")).drop("_g")


def sections(df: DataFrame, key: str, order: str, start: Column) -> DataFrame:
    """Rows with the number of their section, which a start row opens; 0 before the first."""
    return df.withColumn("section", F.sum(F.when(start, 1).otherwise(0)).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def carry(df: DataFrame, key: Sequence[str], order: str, value: Column, name: str, block: Column | None = None) -> DataFrame:
    """The last present value up to each row.

    ``block`` is a bounded, order-preserving part of the order column (a day, a range of row numbers): values
    are carried inside blocks, and the blocks' last values from block to block, so that no task sorts more
    than a block of one key or its list of blocks. ``value`` and ``order`` must be unique inside a key.
    """
    keys = list(key)
    if block is None:
        return df.withColumn(name, F.last(value, ignorenulls=True).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))
    x = df.withColumn("_b", block).withColumn("_v", value)
    inner = F.last("_v", ignorenulls=True).over(W.partitionBy(*keys, "_b").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    ends = x.groupBy(*keys, "_b").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(order))).alias("_e"))
    before = ends.withColumn("_p", F.last("_e", ignorenulls=True).over(W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1))).drop("_e")
    before = before.select("_p", F.col("_b").alias("_b2"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    on = F.col("_b").eqNullSafe(F.col("_b2"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return x.withColumn("_i", inner).join(before, on, "left").select(*df.columns, F.coalesce("_i", "_p").alias(name))


def series_codes(c: Column) -> Column:
    """``Name 12, 15 and 17`` as codes with the name repeated."""
    hits = F.regexp_extract_all(c, F.lit(r"[A-Z][a-z]+ [0-9]+(?:, [0-9]+)*"), 0)
    return F.flatten(F.transform(hits, lambda h: F.transform(F.regexp_extract_all(h, F.lit("[0-9]+"), 0), lambda n: F.concat(F.regexp_extract(h, "^([A-Z][a-z]+)", 1), F.lit(" "), n))))


def asof(left: DataFrame, right: DataFrame, key: str, at: str, columns: Sequence[str]) -> DataFrame:
    """Each left row with the columns of the last right row at or before it: a union and values carried day by day; no range join."""
    names = [c for c in left.columns if c not in (key, at)]
    right = right.dropna(subset=[key, at]).select(key, at, F.lit(0).alias("_s"), *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in names], F.struct(*columns).alias("_r"))
    rows = left.withColumn("_s", F.lit(1)).withColumn("_r", F.lit(None).cast(right.schema["_r"].dataType)).unionByName(right)
    day = F.to_date(at) if dict(left.dtypes)[at].startswith("timestamp") else F.floor(F.col(at) / 65536)
    got = carry(rows.withColumn("_o", F.struct(at, "_s")), [key], "_o", F.col("_r"), "_l", day)
    return got.filter("_s = 1").select(key, at, *names, *[F.col(f"_l.{c}").alias(f"last_{c}") for c in columns])


def merge_pairs(first: DataFrame, second: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The first source with a confidence (confirmed, conflict, single), and the second where the first has no such key."""
    s = second.groupBy(*keys).agg(F.max(value).alias("_v"))
    a = first.join(s, list(keys), "left").withColumn("confidence", F.when(F.col("_v").isNull(), "single").when(F.col("_v") == F.col(value), "confirmed").otherwise("conflict")).drop("_v").withColumn("origin", F.lit("first"))
    b = second.join(first.select(*keys).distinct(), list(keys), "left_anti").withColumn("confidence", F.lit("single")).withColumn("origin", F.lit("second"))
    return a.unionByName(b)


def judged(pairs: DataFrame, gold: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Pairs with match, mismatch or not_in_gold."""
    g = gold.select(*keys, F.col(value).alias("_g"))
    return pairs.join(g, list(keys), "left").withColumn("status", F.when(F.col("_g").isNull(), "not_in_gold").when(F.col("_g") == F.col(value), "match").otherwise("mismatch")).drop("_g")


def transpose_cells(cells: DataFrame, table: str, row: str, col: str) -> DataFrame:
    """Tables in long form with rows and columns swapped."""
    return cells.withColumn("_t", F.col(row)).withColumn(row, F.col(col)).withColumn(col, F.col("_t")).drop("_t")
