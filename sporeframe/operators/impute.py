"""Filling missing values from records of the same group, with provenance.

Dependencies ``determinant -> target`` are mined from the complete records: for each determinant
value the target values are counted, and a value that all complete records of the determinant value
share is a verified dependency. The dictionaries of verified values fill first, in the order of the
determinants; what no dictionary fills takes the group's most frequent value.

Counts are aggregated by (determinant value, target value) before any row meets its group, so that
a determinant value that holds a third of all rows is a handful of aggregated rows, and the join back
is an ordinary equi-join that the adaptive planner may split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import absent
from .prose import carry


def _complete(df: DataFrame, key: str, determinant: str, target: str) -> DataFrame:
    return (
        df.filter(~absent(df[determinant]) & ~absent(df[target]))
        .select(df[determinant].alias("_d"), df[target].alias("_v"), df[key].alias("_k"))
        .groupBy("_d", "_v")
        .agg(F.count("_k").alias("_n"), F.min("_k").alias("_first"))
    )


def dictionary(df: DataFrame, key: str, determinant: str, target: str) -> DataFrame:
    """For each determinant value: the target value that most keys hold (tie: the one of the smallest key),
    how many keys support it, how many complete keys there are, and whether all agree.

    ``df`` must hold each key once. Null keys aren't counted.
    """
    best = F.max_by(F.struct("_v", "_n"), F.struct("_n", (-F.col("_first")).alias("f")))
    return (
        _complete(df, key, determinant, target)
        .filter("_n > 0")
        .groupBy("_d")
        .agg(best.alias("_b"), F.sum("_n").alias("complete"), F.count("*").alias("values"))
        .select("_d", F.col("_b._v").alias("value"), F.col("_b._n").alias("support"), "complete", (F.col("values") == 1).alias("verified"))
    )


def once(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns, each repeated row once."""
    return df.select(*columns).distinct()


def dependencies(df: DataFrame, key: str, determinants: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Mined dependencies: for each (determinant, target) the determinant values, complete keys, those in
    line with the most frequent value, and the share of determinant values on which all keys agree."""
    rows = once(df, [key, *dict.fromkeys([*determinants, *targets])])
    out = None
    for d in determinants:
        for t in targets:
            if d == t:
                continue
            x = dictionary(rows, key, d, t).agg(
                F.count("*").alias("determinant_values"),
                F.coalesce(F.sum("complete"), F.lit(0)).alias("complete_keys"),
                F.coalesce(F.sum("support"), F.lit(0)).alias("supporting_keys"),
                F.count_if("verified").alias("verified_values"),
            )
            x = x.select(F.lit(d).alias("determinant"), F.lit(t).alias("target"), "*")
            out = x if out is None else out.unionByName(x)
    return out


def fill(df: DataFrame, key: str, targets: Sequence[str], determinants: Sequence[str], group: str, least: int = 1) -> DataFrame:
    """One row ``(key, field_name, item, filled_by, support, complete)`` for each absent target value that
    can be filled.

    ``filled_by`` is ``dependency:<determinant>`` where all complete records (at least ``least``) of a
    determinant value agree, the first such determinant wins, else ``group:<group>`` for the most
    frequent value among the records of the same ``group``. Absent determinant values fill nothing;
    repeated rows count once; tables without complete records give no rows.
    """
    rows = once(df, list(dict.fromkeys([key, *targets, *determinants, group])))
    out = None
    for t in targets:
        need = rows.filter(absent(rows[t])).select(key, *[F.when(~absent(rows[d]), rows[d]).alias(f"_d{i}") for i, d in enumerate([*determinants, group])])
        names = [*determinants, group]
        picks = []
        for i, d in enumerate(names):
            last = i == len(names) - 1
            if last and d in determinants:
                # the group is a determinant too: its dictionary was joined already
                j = determinants.index(d)
                picks.append(F.when(F.col(f"_x{j}.value").isNotNull(), F.struct(F.col(f"_x{j}.value").alias("item"), F.lit(f"group:{d}").alias("filled_by"), F.col(f"_x{j}.support").alias("support"), F.col(f"_x{j}.complete").alias("complete"))))
                continue
            x = dictionary(rows, key, d, t)
            x = x.select(F.col("_d").alias(f"_d{i}"), F.struct("value", "support", "complete", "verified").alias(f"_x{i}"))
            need = need.join(x, f"_d{i}", "left")
            ok = F.col(f"_x{i}.value").isNotNull() & (F.lit(last) | (F.col(f"_x{i}.verified") & (F.col(f"_x{i}.complete") >= least)))
            how = f"group:{d}" if last else f"dependency:{d}"
            picks.append(F.when(ok, F.struct(F.col(f"_x{i}.value").alias("item"), F.lit(how).alias("filled_by"), F.col(f"_x{i}.support").alias("support"), F.col(f"_x{i}.complete").alias("complete"))))
        got = need.withColumn("_p", F.coalesce(*picks)).filter("_p is not null").select(key, F.lit(t).alias("field_name"), "_p.*")
        out = got if out is None else out.unionByName(got)
    return out


def fill_mined(df: DataFrame, key: str, targets: Sequence[str], candidates: Sequence[str], group: str, share: float = 0.5, least: int = 2) -> DataFrame:
    """``fill`` by those of the candidate determinants that mining proves: at least ``share`` of their values have one target value.

    What is mined is a row for each candidate and target, whatever the size of the data; proven determinants
    fill in the order given, where at least ``least`` complete records agree, then the group's most frequent value.
    """
    mined = {(r["determinant"], r["target"]): r for r in dependencies(df, key, candidates, targets).collect()}
    out = None
    for t in targets:
        proven = [d for d in candidates if d != t and (r := mined[(d, t)])["determinant_values"] and r["verified_values"] >= share * r["determinant_values"]]
        got = fill(df, key, [t], proven, group, least)
        out = got if out is None else out.unionByName(got)
    return out


def fill_nearest(df: DataFrame, key: str, target: str, group: str, at: str, value: Column | None = None) -> DataFrame:
    """``(key, field_name, item, filled_by)``: absent values, numbers too, from the nearest record of the group in time.

    The last present value at or before the record's time counts, else the first after it (``before:<group>``,
    ``after:<group>``); equal times go by the key. Records without group, key or time fill nothing and stay
    unfilled. ``value`` says what is present (null if absent), for strings all but fillers. Values are carried
    day by day, so that a group of a third of all rows is many bounded tasks.
    """
    kinds = dict(df.dtypes)
    present = value if value is not None else F.when(~absent(df[target]), df[target]) if kinds[target] == "string" else df[target]
    own = F.when(~absent(df[group]), df[group]) if kinds[group] == "string" else df[group]
    rows = df.select(df[key].alias("_key"), own.alias("_group"), df[at].alias("_at"), present.alias("_value")).dropna(subset=["_key", "_group", "_at"]).distinct()
    timed = kinds[at].startswith("timestamp")
    stamp = F.unix_micros(F.col("_at").cast("timestamp")) if timed else F.col("_at")
    day = F.floor(stamp / (86_400_000_000 if timed else 65_536))
    x = rows.withColumns({"_up": F.struct(stamp.alias("a"), F.col("_key").alias("k")), "_down": F.struct((-stamp).alias("a"), (-F.col("_key")).alias("k")), "_day": day})
    x = carry(x, ["_group"], "_up", F.col("_value"), "_before", F.col("_day"))
    x = carry(x, ["_group"], "_down", F.col("_value"), "_after", -F.col("_day"))
    how = F.when(F.col("_before").isNotNull(), f"before:{group}").otherwise(f"after:{group}")
    got = x.filter(F.col("_value").isNull()).withColumn("item", F.coalesce("_before", "_after")).filter("item is not null")
    return got.select(F.col("_key").alias(key), F.lit(target).alias("field_name"), "item", how.alias("filled_by"))
