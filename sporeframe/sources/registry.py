"""Registry extracts and incremental inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "struct<species: string, author: string, protologue: string, basionym: string, basionym_record_id: string, typification: string, locality_raw: string, country: string, host: string, name_status: string, current_name: string, types: array<struct<type_of_type: string, material: array<string>>>>"


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """A JSON store ``{record_id: record}`` of whole files as one row a record."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", f"map<string, {RECORD}>")
    return raw.select(F.explode(m).alias("record_id", "r")).select("record_id", "r.*")


def parse_names(df: DataFrame, xml: str) -> DataFrame:
    """Names of a service's XML answers, one row each; escaped blanks in element names are undone first."""
    clean = F.regexp_replace(xml, "_x0020_", "_")
    item = "struct<RECORD_NUMBER: string, NAME_OF_FUNGUS: string, AUTHORS: string, INFRASPECIFIC_RANK: string, NAME_STATUS: string, CURRENT_NAME: string>"
    parsed = F.from_xml(clean, f"struct<Name: array<{item}>>")
    return df.select(F.explode(parsed["Name"]).alias("n")).select(*[F.col(f"n.{c}").alias(c.lower()) for c in ("RECORD_NUMBER", "NAME_OF_FUNGUS", "AUTHORS", "INFRASPECIFIC_RANK", "NAME_STATUS", "CURRENT_NAME")])


def changed_since(spark: SparkSession, path: str, at: Column, form: str = "text") -> DataFrame:
    """Rows of the files that were modified at or after ``at``; older files aren't read."""
    return spark.read.format(form).load(path).filter(F.col("_metadata.file_modification_time") >= at)


def new_aliases(found: DataFrame, aliases: DataFrame) -> DataFrame:
    """``(cluster_key, alias)`` to add: a found code beside an existing one joins that one's cluster, or opens a new one.

    ``found`` (existing, candidate), ``aliases`` (cluster_key, alias), codes normalised alike.
    """
    known = aliases.select(F.col("alias").alias("existing"), "cluster_key").dropDuplicates(["existing"])
    got = found.join(known, "existing", "left").select(F.coalesce("cluster_key", "existing").alias("cluster_key"), F.col("candidate").alias("alias"), F.col("cluster_key").isNull().alias("opened"), "existing")
    both = got.select("cluster_key", "alias").union(got.filter("opened").select("cluster_key", F.col("existing").alias("alias")))
    return both.distinct().join(aliases, ["cluster_key", "alias"], "left_anti")
