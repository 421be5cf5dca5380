"""Records that share a value: clusters, representatives and alias dictionaries.

Components are found on the bipartite graph of rows and values, which has one edge per (row, value) pair,
so a value held by a third of all rows is that many edges and never its square. Labels are minima that
alternate between rows and values with pointer jumping; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Stages


def components(edges: DataFrame, row: str, value: str) -> DataFrame:
    """``(row, cluster)``: rows linked by shared values, directly or not; the cluster is its least row."""
    stages = Stages(edges.sparkSession, "clusters")
    e = stages.cut(edges.select(F.col(row).alias("r"), F.col(value).alias("v")).dropna().distinct())
    label = stages.cut(e.select("r", F.col("r").alias("l")).distinct())
    while True:
        by_value = e.join(label, "r").groupBy("v").agg(F.min("l").alias("l"))
        low = e.join(by_value, "v").groupBy("r").agg(F.min("l").alias("m"))
        # jump: a row takes over the label of its label
        step = low.join(label.select(F.col("r").alias("m"), F.col("l").alias("j")), "m", "left").select("r", F.least("m", F.coalesce("j", "m")).alias("n"))
        new = stages.cut(label.join(step, "r").select("r", F.least("l", "n").alias("l"), (F.col("n") < F.col("l")).alias("changed")))
        more = new.filter("changed").limit(1).count()
        stages.drop(label)
        label = new.drop("changed")
        label._stage_path = new._stage_path
        if not more:
            return label.select(F.col("r").alias(row), F.col("l").alias("cluster"))


def representative(values: DataFrame, cluster: str, value: str) -> DataFrame:
    """``(cluster, cluster_key)``: not a bare number if possible, then the shortest, then the first in order."""
    return values.groupBy(cluster).agg(F.min(F.struct(F.col(value).rlike("^[0-9]+$").alias("n"), F.length(value).alias("k"), F.col(value).alias("v"))).alias("m")).select(cluster, F.col("m.v").alias("cluster_key"))


def aliases(keyed: DataFrame, key: str, alias: str) -> DataFrame:
    """``(key, aliases)`` with aliases distinct and sorted."""
    return keyed.groupBy(key).agg(F.array_sort(F.collect_set(alias)).alias("aliases"))
