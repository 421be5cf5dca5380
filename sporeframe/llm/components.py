"""Consolidating pairwise matches into groups: contraction, core, restoration.

Each round removes an independent set of vertices of degree one and two: a leaf hands over to its only
neighbour, a vertex inside a chain to one of its two neighbours, which become adjacent. Which of two
removable neighbours goes is decided by a hash that changes every round (list ranking by independent
sets), so a chain of any length shrinks by a constant factor a round, as does a tree. What stays, the
core with at least three neighbours each, is solved by alternating large-star and small-star steps.
At last the labels go back to the removed vertices by pointer jumping over the hand-over links, whose
depth is at most the number of rounds.

All state is tables in the shared folder; the driver sees only counts. A hub's neighbours are never
gathered: every step is an aggregate with map-side combination or an equi-join that may be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Stages


def _contract(adj: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """From the symmetric adjacency (v, u): the removed (v, parent, other) and the new adjacency, both lazy."""
    rank = lambda c: F.struct(F.xxhash64(c, F.lit(seed)), c)
    degree = adj.groupBy("v").agg(F.count("*").alias("d"), F.min("u").alias("a"), F.max("u").alias("b"))
    weak = degree.filter("d <= 2")
    # the strongest removable neighbour of each removable vertex
    ends = weak.select("v", F.explode(F.array_distinct(F.array("a", "b"))).alias("u"))
    rivals = ends.join(weak.select(F.col("v").alias("u")), "u", "left_semi").groupBy("v").agg(F.max(rank(F.col("u"))).alias("rival"))
    gone = weak.join(rivals, "v", "left").filter(F.col("rival").isNull() | (rank(F.col("v")) > F.col("rival")))
    return gone.select("v", F.col("a").alias("parent"), F.when(F.col("a") != F.col("b"), F.col("b")).alias("other")), degree


def _shrink(adj: DataFrame, gone: DataFrame) -> DataFrame:
    v = gone.select("v")
    kept = adj.join(v, "v", "left_anti").join(v.withColumnRenamed("v", "u"), "u", "left_anti").select("v", "u")
    link = gone.filter("other is not null")
    spliced = link.select(F.col("parent").alias("v"), F.col("other").alias("u")).union(link.select("other", "parent"))
    return kept.union(spliced).distinct()


def _core(adj: DataFrame, stages: Stages) -> DataFrame:
    """(v, root) for the vertices of a graph given as (v, u) with v > u, by large-star and small-star."""
    edges = stages.cut(adj.filter("v > u").distinct())
    while True:
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.filter("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v > u").distinct()
        large = stages.cut(large)
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array_distinct(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u"))))).alias("e")).select("e.v", "e.u").filter("v > u").distinct()
        small = stages.cut(small)
        # at the fixed point every vertex has one edge, to the least one, which has none
        n, vs = small.agg(F.count("*"), F.count_distinct("v")).first()
        roots = small.select("u").distinct().join(small.select(F.col("v").alias("u")), "u", "left_semi").limit(1).count()
        stages.drop(edges, large)
        edges = small
        if n == vs and not roots:
            return small.select("v", F.col("u").alias("root"))


def groups(pairs: DataFrame, a: str = "a", b: str = "b", members: DataFrame | None = None, rate: float = 0.02, most: int = 60) -> DataFrame:
    """One row ``(id, group_id)`` for each id linked with another one; group_id is the least id of its group.

    ``pairs`` are links in either direction, repeated or not; links with a null end and of an id with
    itself link nothing. With ``members`` (one column of ids) only links whose two ends are both members
    count. Contraction ends once a round removes less than ``rate`` of the vertices (or after ``most``
    rounds); the core steps solve whatever is left, so neither value changes the result. An empty table
    gives no rows.
    """
    spark = pairs.sparkSession
    stages = Stages(spark, "components")
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    links = pairs.select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v")).filter("u < v and u is not null").distinct()
    if members is not None:
        ids = members.select(F.col(members.columns[0]).cast("long").alias("v"))
        links = links.join(ids, "v", "left_semi").join(ids.withColumnRenamed("v", "u"), "u", "left_semi")
    adj = stages.cut(links.select("v", "u").union(links.select("u", "v")))
    removed: list[DataFrame] = []
    for k in range(most):
        gone, degree = _contract(adj, k)
        gone = stages.cut(gone)
        n, left = gone.count(), degree.count()
        if not n:
            stages.drop(gone)
            break
        removed.append(gone)
        smaller = stages.cut(_shrink(adj, gone))
        stages.drop(adj)
        adj = smaller
        if n < rate * left or n == left:
            break
    roots = None
    if adj.limit(1).count():
        roots = _core(adj, stages)
    stages.drop(adj)
    return _restore(removed, roots, stages, spark)


def _restore(removed: list[DataFrame], roots: DataFrame | None, stages: Stages, spark) -> DataFrame:
    """Labels for removed vertices: pointer jumping to the last one of each hand-over chain, then the least id of each root."""
    up = None
    for g in removed:
        g = g.select("v", F.col("parent").alias("p"))
        up = g if up is None else up.union(g)
    if roots is not None:
        r = roots.select("v", F.col("root").alias("p"))
        up = r if up is None else up.union(r)
    if up is None:
        return spark.createDataFrame([], "id long, group_id long")
    up = stages.cut(up)
    depth = len(removed) + 1
    while depth > 1:
        nxt = up.select(F.col("v").alias("p"), F.col("p").alias("q"))
        jumped = stages.cut(up.join(nxt, "p", "left").select("v", F.coalesce("q", "p").alias("p")))
        stages.drop(up)
        up = jumped
        depth = (depth + 1) // 2
    # roots have no link of their own
    least = up.groupBy("p").agg(F.min("v").alias("m")).select("p", F.least("m", "p").alias("group_id"))
    return up.join(least, "p").select(F.col("v").alias("id"), "group_id").union(least.select("p", "group_id"))
