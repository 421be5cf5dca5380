"""Gap detection, conflict-aware merging, validation, fallbacks and review of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.missing import missing


def gap_flags(df: DataFrame, voucher: str, country: str, species: str) -> DataFrame:
    """The table with flags voucher_gap, country_gap, species_gap and embedded_code."""
    return df.withColumns({"voucher_gap": missing(voucher), "country_gap": missing(country, ("", "nan")), "species_gap": C.species_incomplete(F.col(species)), "embedded_code": C.embedded_code(F.col(species))["code"].isNotNull()})


def first_present(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """One row a key; each column takes its first present value by ``order``."""
    return df.groupBy(key).agg(*[F.min_by(F.when(~missing(c), F.col(c)), F.when(~missing(c), F.col(order))).alias(c) for c in columns], F.count("*").alias("merged"))


def unanimous(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, status, value, choices)``: applied if all present values agree, ambiguous with the sorted list if not."""
    got = df.filter(~missing(value)).groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias("s"))
    one = F.size("s") == 1
    return got.select(*keys, F.when(one, "applied").otherwise("ambiguous").alias("status"), F.when(one, F.get("s", F.lit(0))).alias("value"), F.array_join("s", "|").alias("choices"))


def priority_fallback(df: DataFrame, key: str, sources: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """``(key, value, method)`` from the first source (name, table, value column; one row a key) that has the key."""
    out = df
    value, method = [], None
    for name, t, c in sources:
        out = out.join(t.select(key, F.col(c).alias(f"_{name}")), key, "left")
        value.append(F.col(f"_{name}"))
        hit = F.col(f"_{name}").isNotNull()
        method = F.when(hit, name) if method is None else method.when(hit, name)
    return out.select(key, F.coalesce(*value).alias("value"), method.alias("method")).filter("value is not null")


def _decision(rules: Sequence[tuple[Column, str, str]], candidate: Column) -> Column:
    status, reason = None, None
    for when, s, r in rules:
        status = F.when(when, s) if status is None else status.when(when, s)
        reason = F.when(when, r) if reason is None else reason.when(when, r)
    status = status.otherwise("accepted")
    return F.struct(status.alias("status"), reason.otherwise("ok").alias("reason"), F.when(status == "accepted", F.trim(candidate)).alias("value"))


def judge_voucher(candidate: Column, existing: Column, accession: Column) -> Column:
    """struct<status, reason, value> for a proposed specimen code."""
    key = C.code_key_match
    rules = [
        (missing(candidate), "rejected", "empty"),
        (C.citation_marker(candidate), "rejected", "citation_marker"),
        (F.coalesce(key(C.without_version(candidate)) == key(C.without_version(accession)), F.lit(False)), "rejected", "own_accession"),
        (C.accession_like(candidate) & ~C.looks_like_specimen_code(candidate), "rejected", "looks_like_accession"),
        (~candidate.rlike("[0-9]"), "rejected", "no_digit"),
        (~missing(existing) & (key(candidate) == key(existing)), "deferred", "already_present"),
        (~missing(existing), "deferred", "voucher_conflict"),
    ]
    return _decision(rules, candidate)


def judge_country(candidate: Column, existing: Column, canonical: Column, choices: Column) -> Column:
    rules = [(missing(candidate), "rejected", "empty"), (canonical.isNull(), "rejected", "unknown_country"), (choices > 1, "deferred", "ambiguous_country"), (~missing(existing), "deferred", "existing_country")]
    return _decision(rules, canonical)


def judge_species(candidate: Column, existing: Column, known_genus: Column) -> Column:
    rules = [(missing(candidate), "rejected", "empty"), (C.species_incomplete(candidate), "rejected", "candidate_incomplete"), (~C.species_incomplete(existing), "deferred", "existing_species_complete"), (~F.coalesce(known_genus, F.lit(True)), "rejected", "unknown_genus")]
    return _decision(rules, candidate)


def signatures(df: DataFrame, key: str, markers: Sequence[str]) -> DataFrame:
    """The table with a signature of its filled markers; rows without any vanish."""
    parts = [F.when(~missing(m), F.concat(F.lit(f"{m}="), F.trim(F.col(m)))) for m in markers]
    sig = F.concat_ws(";", *parts)
    return df.withColumn("signature", sig).filter("signature <> ''")


def review(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(signature, change, column, before, after)``: changed cells of common signatures, and removed and added ones.

    Both tables have one row a signature.
    """
    a, b = old.select("signature", *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("_a")), new.select("signature", *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("_b"))
    j = a.join(b, "signature", "full_outer")
    cells = F.filter(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"a_{c}").alias("before"), F.col(f"b_{c}").alias("after")) for c in columns]), lambda x: ~x["before"].eqNullSafe(x["after"]))
    gone = F.array(F.struct(F.lit("").alias("column"), F.lit(None).cast("string").alias("before"), F.lit(None).cast("string").alias("after")))
    change = F.when(F.col("_b").isNull(), "removed").when(F.col("_a").isNull(), "added").otherwise("changed")
    return j.select("signature", change.alias("change"), F.explode(F.when(change == "changed", cells).otherwise(gone)).alias("c")).select("signature", "change", "c.*")


def chunks(df: DataFrame, order: str, value: str, size: int, block_rows: int = 100_000) -> DataFrame:
    """``(chunk, n, first, last)`` of ordered values in chunks of ``size``.

    Ranks come from a range partitioning: rows are numbered inside blocks of the order column, and the
    blocks' running totals are added, so no task sees more than a block and the list of blocks.
    """
    lo, hi, n = df.agg(F.min(order), F.max(order), F.count("*")).first()
    if not n:
        return df.sparkSession.createDataFrame([], "chunk long, n long, first string, last string")
    blocks = max(1, n // block_rows)
    b = F.floor((F.col(order) - lo) * blocks / F.lit(max(1, hi - lo + 1))).cast("int")
    rows = df.select(order, value).withColumn("_b", b)
    totals = rows.groupBy("_b").agg(F.count("*").alias("_n"))
    before = totals.select("_b", (F.sum("_n").over(W.orderBy("_b")) - F.col("_n")).alias("_off"))
    at = F.row_number().over(W.partitionBy("_b").orderBy(order)) - 1 + F.col("_off")
    return rows.join(before, "_b").withColumn("chunk", F.floor(at / size)).groupBy("chunk").agg(F.count("*").alias("n"), F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group, with their place; the rank filter is pushed into the window."""
    return df.withColumn("place", F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col("place") <= k)


def upsert(store: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The store with whole records replaced or added by ``new``."""
    return store.join(new.select(key), key, "left_anti").unionByName(new)


def inherit(df: DataFrame, key: str, base: str, columns: Sequence[str]) -> DataFrame:
    """Blank columns take the value of the record that ``base`` names; ``inherited`` says whether it exists."""
    b = df.select(F.col(key).alias(base), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    filled = {c: F.coalesce(F.when(~missing(c), F.col(c)), F.col(f"_{c}")) for c in columns}
    return df.join(b, base, "left").withColumns(filled).withColumn("inherited", F.col("_hit").isNotNull()).drop("_hit", *[f"_{c}" for c in columns])
