"""Filling containers of fixed capacity with items: bulk-synchronous best fit.

Items are taken by falling size. In a superstep all items of one size meet the gaps: they go to the
successor of their size among the gaps, the tightest gaps that hold them, in the order of their ranks
(item number r of the size to gap number r), so that no two items claim one gap; the gaps shrink and the
step repeats until the size is used up; where no gap is left, new containers open. Items larger than the
capacity are cut into full containers and a rest, nothing else is cut.

Sizes are whole numbers up to the capacity, so items of one size and containers with one gap are
interchangeable: the supersteps run on runs of equal sizes and equal gaps, (size, first rank, number)
against (gap, first container, number). The run table that says which ranks go to which containers is
made from the counts by size alone, at most as many as the capacity, in one executor task a capacity. Ranks
are given in parallel: within hash blocks of a size, then shifted by the running totals of the blocks. Rows
meet their runs in an equi-join on blocks of ranks. The driver sees the list of capacities only.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Stages

#: Ranks in a block of the join between items and runs.
BLOCK = 4096


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Runs ``(size, first rank, number, first container)`` that pack counts[size] items of each size 1..capacity.

    Equal to item-by-item best-fit decreasing. Containers are numbered from 0. The state is the runs of
    containers by gap; its size depends on the number of sizes, not of items.
    """
    runs: list[tuple[int, int, int, int]] = []
    gaps: list[int] = []
    at: dict[int, list[tuple[int, int]]] = {}
    opened = 0

    def put(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in at:
                insort(gaps, gap)
                at[gap] = []
            at[gap].append((first, n))

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            i = bisect_left(gaps, size)
            if i == len(gaps):
                # new containers, each filled with this size as far as it goes
                gap, n = capacity, max(1, left // (capacity // size))
                first, opened = opened, opened + n
            else:
                gap = gaps[i]
                first, have = at[gap].pop()
                n = min(left, have)
                if n < have:
                    at[gap].append((first + n, have - n))
                if not at[gap]:
                    del at[gap]
                    gaps.pop(i)
            runs.append((size, rank, n, first))
            put(gap - size, first, n)
            rank += n
            left -= n
    return runs


def pack(items: DataFrame, key: str, size: str, capacities: DataFrame, block_rows: int = 50_000) -> DataFrame:
    """``(size_name, container_id, key, piece, start, n)``: every item, or each of its pieces, in one container.

    ``items`` has a unique key and a whole-number size; ``capacities`` (size_name, capacity_tokens).
    Pieces count from 0 and begin at ``start``; an item is cut only if it exceeds the capacity. Items of
    size 0, less or null take no room: piece 0 of container 0. Containers are numbered from 0 for each capacity;
    capacities that are null or below 1 give no rows; of several under one name the least counts.
    """
    spark = items.sparkSession
    stages = Stages(spark, "packing")
    # the list of capacities is a parameter
    caps = capacities.select("size_name", F.col("capacity_tokens").cast("long").alias("cap")).filter("cap > 0").groupBy("size_name").agg(F.min("cap").alias("cap")).collect()
    each = F.array(*[F.struct(F.lit(r["size_name"]).alias("size_name"), F.lit(r["cap"]).cast("long").alias("cap")) for r in caps]) if caps else F.array().cast("array<struct<size_name: string, cap: bigint>>")
    sized = stages.cut(items.select(F.col(key).alias("k"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("len")).distinct())
    one = sized.select("k", "len", F.explode(each).alias("c")).select("k", "len", "c.*")
    cut = one.select("size_name", "cap", "k", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("len") - 1, F.lit(0)) / F.col("cap")))).alias("piece"))
    pieces = cut.select("size_name", "cap", "k", "piece", (F.col("piece") * F.col("cap")).alias("start"), F.least(F.col("cap"), F.col("len") - F.col("piece") * F.col("cap")).alias("n"))
    blocks = max(1, sized.count() // block_rows)
    pieces = pieces.withColumn("b", F.pmod(F.xxhash64("k", "piece"), F.lit(blocks)))
    by_block = stages.cut(pieces.filter("n > 0").groupBy("size_name", "cap", "n", "b").agg(F.count("*").alias("m")))
    before = by_block.select("size_name", "n", "b", (F.sum("m").over(W.partitionBy("size_name", "n").orderBy("b")) - F.col("m")).alias("off"))
    def supersteps(counts: pd.DataFrame) -> pd.DataFrame:
        runs = best_fit({int(n): int(m) for n, m in zip(counts["n"], counts["m"])}, int(counts["cap"].iloc[0]))
        return pd.DataFrame([(counts["size_name"].iloc[0], *r) for r in runs], columns=["size_name", "n", "r0", "many", "c0"])

    # counts by size: at most `capacity` rows for each capacity
    counts = by_block.groupBy("size_name", "cap", "n").agg(F.sum("m").alias("m"))
    runs = stages.cut(counts.groupBy("size_name").applyInPandas(supersteps, "size_name string, n long, r0 long, many long, c0 long"))
    runs = stages.cut(runs.withColumn("rb", F.explode(F.sequence(F.floor(F.col("r0") / BLOCK), F.floor((F.col("r0") + F.col("many") - 1) / BLOCK)))))
    rank = F.row_number().over(W.partitionBy("size_name", "n", "b").orderBy("k", "piece")) - 1
    ranked = pieces.filter("n > 0").withColumn("r", rank).join(before, ["size_name", "n", "b"]).withColumn("r", F.col("r") + F.col("off")).withColumn("rb", F.floor(F.col("r") / BLOCK))
    placed = ranked.join(runs, ["size_name", "n", "rb"]).filter("r >= r0 and r < r0 + many").select("size_name", (F.col("c0") + F.col("r") - F.col("r0")).alias("container_id"), F.col("k").alias(key), F.col("piece").cast("int").alias("piece"), "start", "n")
    empty = pieces.filter("n <= 0").select("size_name", F.lit(0).cast("long").alias("container_id"), F.col("k").alias(key), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n"))
    return placed.unionByName(empty)
