"""Order of undated values by learned precedences that run through several values."""

import datetime as dt

from pyspark.sql import functions as F

from sporeframe.llm import survivor

T = dt.datetime(2024, 1, 1)


def survive(spark, steps, groups):
    """The country that survives in each of ``groups`` (first id: [(value, day or None)]), with (earlier, later) ``steps`` learned."""
    rows = []
    for i, pair in enumerate(steps):
        rows += [(1000 + 10 * i + k, f"t{i}", v, T + dt.timedelta(days=k)) for k, v in enumerate(pair)]
    for first, values in groups.items():
        rows += [(first + k, f"g{first}", v, None if d is None else T + dt.timedelta(days=d)) for k, (v, d) in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, g string, c string, at timestamp")
    got = {r.group_id: r.c for r in survivor.survivors(df, ["g"], "id", {"c": survivor.never}, F.lit(1), "at").collect()}
    return {g: got[g] for g in groups}


def test_chains_of_undated_values(spark):
    steps = [("aa", "bb"), ("bb", "cc"), ("cc", "dd"), ("kk", "ll"), ("ll", "mm"), ("mm", "kk"), ("mm", "nn")]
    groups = {
        1: [("bb", None), ("cc", None), ("aa", None)],
        10: [("bb", None), ("aa", None), ("dd", None), ("cc", None)],
        20: [("cc", None), ("bb", None), ("aa", 5)],
        30: [("bb", None), ("aa", None), ("cc", None), ("dd", 5)],
        40: [("kk", None), ("ll", None), ("nn", None), ("mm", None)],
    }
    assert survive(spark, steps, groups) == {1: "cc", 10: "dd", 20: "cc", 30: "dd", 40: "nn"}


def test_frequent_values(spark):
    # "x" has more relations than any group has values
    steps = [("x", f"y{i}") for i in range(12)] + [(f"w{i}", "x") for i in range(12)]
    groups = {1: [("y3", None), ("x", None)], 10: [("w3", 5), ("x", None)], 20: [("x", None), ("w4", None), ("y5", None)]}
    assert survive(spark, steps, groups) == {1: "y3", 10: "x", 20: "y5"}
