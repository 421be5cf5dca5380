"""The best representative of each duplicate group, field by field.

For each field the distinct values of a group compete: complete before incomplete, then higher trust,
then currency. Currency is the time stamp; values without one get their place from precedences learned
on the time-stamped rows: how often value ``a`` was followed by value ``b`` in the history of a group.
``a`` precedes ``b`` where that happened more often than the reverse. In a group, an undated value lies
before the earliest dated value that it precedes, else after the latest dated value that precedes it;
undated values among themselves go by how many undated values of the group precede them, so that the
topologically latest one is the most current. Precedence runs on through undated values; values on a cycle
don't precede each other. Undated values without any learned relation come last.

Values are aggregated by (group, field, value) first. Histories are cut by hour and stitched, so no task
sorts more than an hour of one group; whether a value begins a longer one is found by an equi-join on its
prefixes of those lengths that occur in the group, never by comparing all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.missing import absent, squeeze
from ..session import Stages


def accession_key(c: Column | str) -> Column:
    """An accession without blanks, case and version; null if absent."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~absent(c), F.regexp_replace(F.upper(F.regexp_replace(c, r"(?U)\s+", "")), r"\.\d+$", ""))


def species_incomplete(c: Column) -> Column:
    """Abbreviated genus, or no epithet (rank and qualifier words are none)."""
    return c.rlike(r"(?U)^\s*\p{L}{1,4}\.") | ~c.rlike(r"(?U)^\s*[\p{L}×-]{2,}\.?(\s+(cf|aff|nr|subsp|ssp|var|f)\.?)*\s+(?!(sp|spp|species|cf|aff|nr|gen|indet|nov)\b)\p{L}[\p{L}-]+")


def code_incomplete(c: Column) -> Column:
    """No letter or no digit."""
    return ~(c.rlike(r"\p{L}") & c.rlike(r"\p{N}"))


def never(c: Column) -> Column:
    return F.lit(False)


def _history(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each dated row (keys, value, ts, id) with the value that follows it in its group, if any."""
    order = [F.col("ts"), F.col("id")]
    hour = W.partitionBy(*keys, "hour").orderBy(*order)
    rows = rows.filter("ts is not null").withColumn("hour", F.date_trunc("hour", "ts"))
    inner = rows.withColumn("next", F.lead(F.struct("value")).over(hour))
    first = rows.groupBy(*keys, "hour").agg(F.min_by(F.struct("value"), F.struct("ts", "id")).alias("first"))
    after = first.withColumn("then", F.lead("first").over(W.partitionBy(*keys).orderBy("hour"))).drop("first")
    return inner.join(after, [*keys, "hour"]).select(*keys, "value", F.coalesce("next", "then").alias("next")).filter("next is not null").select(*keys, "value", F.col("next.value").alias("next"))


def precedences(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Learned ``(field, earlier, later, n)``: ``earlier`` was followed by ``later`` n times more often than the reverse.

    ``rows`` has the group keys, field, value, ts and id.
    """
    steps = _history(rows, [*keys, "field"]).filter("value <> next")
    sign = steps.select("field", F.least("value", "next").alias("a"), F.greatest("value", "next").alias("b"), F.when(F.col("value") < F.col("next"), 1).otherwise(-1).alias("s"))
    net = sign.groupBy("field", "a", "b").agg(F.sum("s").alias("s")).filter("s <> 0")
    return net.select("field", F.when(F.col("s") > 0, F.col("a")).otherwise(F.col("b")).alias("earlier"), F.when(F.col("s") > 0, F.col("b")).otherwise(F.col("a")).alias("later"), F.abs("s").alias("n"))


def _beginnings(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The (keys, low) that, case aside, begin a longer value of the same group and field."""
    low = values.select(*keys, "low").distinct()
    lengths = low.groupBy(*keys).agg(F.collect_set(F.length("low")).alias("ls")).filter(F.size("ls") > 1)
    cut = low.join(lengths, list(keys)).select(*keys, "low", F.explode(F.filter("ls", lambda n: n < F.length("low"))).alias("n"))
    return cut.select(*keys, F.substring(F.col("low"), F.lit(1), F.col("n")).alias("low")).distinct()


def _reach(values: DataFrame, known: DataFrame, keys: Sequence[str], stages: Stages) -> DataFrame:
    """(keys, a, b, ta, tb): value ``a`` of a group precedes ``b``, directly or through undated ones, and not the reverse.

    At least one of the two is undated. ``keys`` include the field; ``ta`` and ``tb`` are time stamps. Paths
    double in each round, so the rounds go with the logarithm of the longest chain.
    """
    # relations of no undated value matter to no one
    undated = values.filter("ts is null").select("field", "value").distinct()
    own = lambda c: known.join(undated.withColumnRenamed("value", c), ["field", c], "left_semi").select("field", "earlier", "later")
    known = stages.cut(own("earlier").union(own("later")).distinct().select("field", F.col("earlier").alias("a"), F.col("later").alias("b")))
    side = {c: values.select(*keys, F.col("value").alias(c), F.col("ts").alias(f"t{c}")) for c in "ab"}
    names = [*keys, "a", "b", "ta", "tb"]
    room = values.groupBy(*keys).agg(F.count("*").alias("room"))

    def related(x: str, y: str) -> DataFrame:
        # an undated value meets the fewer of its learned relations and the values of its group
        many = known.groupBy("field", x).agg(F.count("*").alias("many"))
        undated = side[x].filter(f"t{x} is null").join(many, ["field", x]).join(room, list(keys))
        few = undated.filter("many <= room").join(known, ["field", x]).join(side[y], [*keys, y])
        return few.select(*names).union(undated.filter("many > room").join(side[y], list(keys)).join(known, ["field", "a", "b"]).select(*names))

    reach = stages.cut(related("a", "b").union(related("b", "a")).distinct())
    n = reach.count()
    while n:
        on = reach.filter("tb is null").select(*keys, "a", "ta", F.col("b").alias("m"))
        go = reach.filter("ta is null").select(*keys, "b", "tb", F.col("a").alias("m"))
        reach = stages.cut(reach.union(on.join(go, [*keys, "m"]).filter("ta is null or tb is null").select(*names)).distinct())
        n, before = reach.count(), n
        if n == before:
            break
    return reach.join(reach.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")), [*keys, "a", "b"], "left_anti")


def long_form(df: DataFrame, keys: Sequence[str], row_id: str, fields: Sequence[str], trust: Column, at: str) -> DataFrame:
    """One row (keys, id, field, value, trust, ts) for each present value; repeated rows count once."""
    rows = df.select(*keys, F.col(row_id).alias("id"), trust.alias("trust"), F.col(at).alias("ts"), *[F.col(f).alias(f"_{f}") for f in fields]).distinct()
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.trim(F.regexp_replace(f"_{f}", r"(?U)^\s+|\s+$", "")).alias("value")) for f in fields]))
    return rows.select(*keys, "id", "trust", "ts", each.alias("x")).select(*keys, "id", "trust", "ts", "x.*").filter(~absent("value"))


def survivors(df: DataFrame, keys: Sequence[str], row_id: str, fields: Mapping[str, Callable[[Column], Column]], trust: Column, at: str) -> DataFrame:
    """One row ``(group_id, *fields)`` for each group of two or more row ids with the same keys.

    Null keys form no group. ``fields`` maps a column to its test for incomplete values; ``trust`` is a
    number, higher is better; ``at`` a timestamp column, nulls allowed. group_id is the least row id. A
    field is ``''`` where the group has only absent values. Ties go to the value of the least row id.
    Repeated rows count once; further columns don't matter; an empty table gives no rows.
    """
    keys = list(keys)
    df = df.dropna(subset=[*keys, row_id])
    groups = df.groupBy(*keys).agg(F.min(row_id).alias("group_id"), F.max(row_id).alias("_last")).filter("group_id < _last").drop("_last")
    stages = Stages(df.sparkSession, "survivor")
    rows = stages.cut(long_form(df, keys, row_id, list(fields), trust, at))
    gf = [*keys, "field"]
    best = F.max(F.struct("trust", "ts", (-F.col("id")).alias("k")))
    values = rows.groupBy(*gf, "value").agg(best.alias("b")).select(*gf, "value", F.lower("value").alias("low"), "b.*")
    begun = _beginnings(values, gf).withColumn("begins", F.lit(True))
    rule = F.lit(False)
    for f, test in fields.items():
        rule = F.when(F.col("field") == f, F.coalesce(test(F.col("value")), F.lit(False))).otherwise(rule)
    values = stages.cut(values.join(begun, [*gf, "low"], "left").withColumn("complete", ~rule & F.col("begins").isNull()).drop("begins", "low"))

    # a hair before or after the dated neighbour
    tick = F.expr("interval 1 microsecond")
    reach = _reach(values, precedences(rows, keys), gf, stages)
    until = reach.filter("ta is null").groupBy(*gf, F.col("a").alias("value")).agg(F.min("tb").alias("until"))
    since = reach.filter("tb is null").groupBy(*gf, F.col("b").alias("value")).agg(F.max("ta").alias("since"), F.count_if(F.col("ta").isNull()).alias("depth"))
    place = until.join(since, [*gf, "value"], "full").select(*gf, "value", F.coalesce(F.col("until") - tick, F.col("since") + tick).alias("near"), "depth")
    # nor before the place of an undated value that precedes it
    least = reach.filter("ta is null and tb is null").join(place.select(*gf, F.col("value").alias("a"), "near"), [*gf, "a"]).groupBy(*gf, F.col("b").alias("value")).agg(F.max("near").alias("least"))
    values = values.join(place, [*gf, "value"], "left").join(least, [*gf, "value"], "left")
    when = F.coalesce(F.col("ts"), F.greatest("near", "least"))
    order = F.struct("complete", "trust", when.alias("w"), F.coalesce("depth", F.lit(0)).alias("d"), "k", "value")
    best = values.groupBy(*keys).agg(*[F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, order)).alias(f) for f in fields])
    return groups.join(best, keys, "left").select("group_id", *[F.coalesce(f, F.lit("")).alias(f) for f in fields])
