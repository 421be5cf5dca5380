"""The stages as plans: build the specimen matrix, qualify names, enrich gaps, review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import registry as R
from ..functions.missing import absent
from ..operators import cluster, frames, matrix, prose
from ..sources.flatfile import read_flatfiles

MARKERS = matrix.MARKERS
#: Qualifiers in the order in which they name a specimen.
PREFERRED = ("specimen_voucher", "strain", "isolate", "culture_collection", "bio_material")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Parsed flat files with a record number in file order; malformed records are left out of the plan."""
    return read_flatfiles(spark, path).filter("corrupt is null").withColumn("seq_no", F.monotonically_increasing_id())


def build_matrix(recs: DataFrame) -> DataFrame:
    """Distinct cleaned records, clustered by any shared code, one row a specimen."""
    names = [c for c in recs.columns if c not in ("seq_no", "corrupt")]
    x = recs.groupBy(*names).agg(F.min("seq_no").alias("seq_no"))
    x = x.withColumns({c: C.clean_text(F.col(c)) for c in names if dict(recs.dtypes)[c] == "string"})
    values = x.select("seq_no", F.explode(F.array(*PREFERRED)).alias("v")).filter(~absent("v") & ~C.invalid_code(F.col("v"))).select("seq_no", C.code_key_dictionary(F.col("v")).alias("value")).filter("value <> ''").distinct()
    comp = values.join(cluster.components(values, "seq_no", "value"), "seq_no")
    keys = cluster.representative(comp, "cluster", "value")
    of = comp.select("seq_no", "cluster").distinct().join(keys, "cluster").select("seq_no", F.col("cluster_key").alias("code"))
    y = x.join(of, "seq_no").withColumn("marker", matrix.marker_of(F.col("description")))
    return matrix.specimen_matrix(y, "code", ["species", "geo_loc_name", "host", "type_material", "title"], "marker", "gbn", "seq_no", MARKERS)


def qualify(names: DataFrame, store: DataFrame) -> DataFrame:
    """New registry names with their status, and inherited basionym fields, upserted into the store."""
    new = names.filter(F.col("taxon_rank").isin("sp.", "f.", "var.")).join(store.select("record_id"), "record_id", "left_anti")
    new = new.withColumn("taxonomic_status", R.taxonomic_status(F.col("name_status"), F.col("species"), F.col("current_name")))
    merged = frames.upsert(store, new.select(*store.columns), "record_id")
    return frames.inherit(merged, "record_id", "basionym_record_id", ["host", "country"]).drop("inherited").select(*store.columns)


def enrich(specimens: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Specimens whose blank country takes, in this order, the article row of an accession and the unanimous prose country.

    ``rows`` (accession, country), ``pairs`` (voucher, country).
    """
    acc = specimens.select("code", F.explode(F.array(*MARKERS)).alias("a")).filter("a is not null").select("code", F.upper(C.without_version("a")).alias("accession"))
    table = acc.join(rows.filter(~absent("country")).withColumn("accession", F.upper(C.without_version(F.col("accession")))), "accession").groupBy("code").agg(F.min_by("country", "accession").alias("c"))
    said = frames.unanimous(pairs.withColumn("code", C.code_key_dictionary(F.col("voucher"))), ["code"], "country").filter("status = 'applied'").select("code", F.col("value").alias("c"))
    gaps = specimens.filter(absent("geo_loc_name")).select("code")
    got = frames.priority_fallback(gaps, "code", [("table", table, "c"), ("prose", said, "c")])
    return specimens.join(got, "code", "left").withColumn("geo_loc_name", F.coalesce("value", "geo_loc_name")).withColumnRenamed("method", "country_from").drop("value")


def review(before: DataFrame, after: DataFrame) -> DataFrame:
    """Changed cells between two versions of the matrix."""
    a, b = (frames.signatures(t, "code", MARKERS).groupBy("signature").agg(*[F.min_by(c, "code").alias(c) for c in ("species", "geo_loc_name", "host")]) for t in (before, after))
    return frames.review(a, b, ["species", "geo_loc_name", "host"])


def confidence(first: DataFrame, second: DataFrame) -> DataFrame:
    return prose.merge_pairs(first, second, ["doc", "code"], "country")
