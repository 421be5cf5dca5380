"""Matching specimens of two tables without a common key: inverted-index BM25, mutual nearest, calibrated confidence.

A specimen's voucher holds one or more codes, each a word (collector or herbarium) and a number. What is
indexed are the distinct codes of a table, as the texts of all rows that bear them: the whole code and each
letter pair of its word, bound to the number, so that a misspelt word still shares most of them; genus and
epithet; the country. A voucher that a third of all rows bear is thus one entry with large term frequencies.

Retrieval is BM25 with term frequencies and length norm, and exact: the best score of a query is first
bounded from below by entries with the very same code; terms are then taken by falling upper bound until
what remains can't lift an entry to ``floor`` of the query's own score or to ``near`` of that bound. Only
these essential terms probe the index (species and countries, which many rows share, never do beside a
code); candidates that their found part and the bound of the rest leave a chance get their full score, and
the nearest ones, the runner-up and everything down to
``near`` of the nearest are exact. There is no number of candidates that is cut.

A pair of codes counts if each is the other's nearest, ties included; ``near`` lets a misspelt code stand
beside a correct one of the same specimen in the reverse test. The confidence of a pair is a logistic
function of coverage, score gap, reverse ratio, sameness of the code and agreement of species and country;
it is fitted by Newton steps on sums over the distinct feature values, with labels that follow from exact
codes and species. A pair is a match from a confidence of one half. Pairs are judged between classes, the
distinct (code, species, country); rows meet only in the result.

Rows without a code, and codes whose numbers differ, share no essential term and never match: collectors
number their specimens in a row, so that the next number is another specimen.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.missing import absent
from ..session import Stages

#: Share of the own score that a candidate must reach; share of the nearest's score that counts as near.
FLOOR, NEAR = 0.35, 0.45
#: The usual saturation and length norm of BM25.
K1, B = 1.2, 0.75
FEATURES = ("cov", "gap", "back", "same", "alike", "species", "country")
#: Words beside a collector's name or number that belong to neither.
NOISE = r"\b(leg|coll|no|nr|num|dupl|det|herb|voucher|specimen|isol)\b\.?"


def voucher_codes(c: Column) -> Column:
    """array<struct<word, num>> of the codes in a voucher: a word with the number after it, or before it if none follows."""
    run = r"(?<=(?<![A-Za-z])[lO\d]{1,8})%s(?=[lO\d]{0,8}(?![A-Za-z]))|(?<![A-Za-z])%s(?=[lO\d]{1,8}(?![A-Za-z]))"
    # scanned numbers: a run of digits, l and O of two or more
    x = F.regexp_replace(F.regexp_replace(c, run % ("l", "l"), "1"), run % ("O", "O"), "0")
    x = F.regexp_replace(F.lower(x), r"(?<=\d)[a-z](,\s*[a-z])*\b", " ")
    x = F.regexp_replace(F.regexp_replace(x, NOISE, " "), r"\s+", " ")
    after = F.regexp_extract_all(x, F.lit(r"([\p{L}]{2,}(?:-[a-z](?=[^a-z0-9]*\d))?)[^\p{L}\d]*\d+"), 0)
    before = F.regexp_extract_all(x, F.lit(r"\d+[^\p{L}\d]*\p{L}{2,}"), 0)
    code = lambda s: F.struct(F.regexp_extract(s, r"(\p{L}{2,})", 1).alias("word"), F.regexp_replace(F.regexp_extract(s, r"(\d+)", 1), "^0+(?=.)", "").alias("num"))
    return F.array_distinct(F.transform(F.when(F.size(after) > 0, after).otherwise(before), code))


def species_key(c: Column) -> Column:
    """struct<genus, epithet> in lower case; an abbreviated genus keeps its dot, no epithet is null."""
    x = F.regexp_replace(F.lower(F.trim(c)), r"\b(cf|aff|nr)\.?\s+", "")
    e = F.regexp_extract(x, r"^\S+\s+([a-z-]{3,})", 1)
    g = F.regexp_extract(x, r"^(\S+)", 1)
    return F.when(~absent(c), F.struct(F.when(g != "", g).alias("g"), F.when((e != "") & ~e.isin("spp", "species"), e).alias("e")))


def _agree(a: Column, b: Column) -> Column:
    """Agreement of two species keys: 1 alike (one edit apart counts), 0 unknown, -1 unlike."""
    near = lambda x, y: F.levenshtein(x, y) <= 2
    short = a["g"].contains(".") | b["g"].contains(".")
    genus = F.when(short, F.left(a["g"], F.lit(1)) == F.left(b["g"], F.lit(1))).otherwise(near(a["g"], b["g"]))
    eps = F.when(a["e"].isNull() | b["e"].isNull(), F.lit(True)).otherwise(near(a["e"], b["e"]))
    return F.when(a.isNull() | b.isNull() | a["g"].isNull() | b["g"].isNull(), 0.0).when(genus & eps, 1.0).otherwise(-1.0)


def _terms(word: Column, num: Column) -> Column:
    w = F.concat(F.lit("^"), word, F.lit("$"))
    two = F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.concat(F.substring(w, i, F.lit(2)), F.lit("|"), num))
    return F.array_distinct(F.concat(F.array(F.concat_ws("|", F.concat(F.lit("="), word), num)), two))


def _texts(rows: DataFrame) -> DataFrame:
    """(code, t, tf, n, len): the terms of each distinct code over its n rows (code, sp, country), and their number with repeats.

    Codes are text, ``word|num``; the first of a code's terms is the code itself behind ``=``.
    """
    traits = F.array_compact(F.array(F.when(~F.col("sp.g").contains("."), F.concat(F.lit("genus|"), "sp.g")), F.concat(F.lit("epithet|"), F.col("sp.e")), F.concat(F.lit("country|"), "country")))
    rows = rows.select(F.concat_ws("|", "code.word", "code.num").alias("code"), traits.alias("traits"))
    once = rows.groupBy("code").agg(F.count("*").alias("n"), F.sum(F.size("traits")).alias("more"))
    once = once.withColumn("ts", _terms(F.substring_index("code", "|", 1), F.substring_index("code", "|", -1)))
    once = once.select("code", "n", "ts", (F.col("n") * F.size("ts") + F.col("more")).alias("len"))
    codes = once.select("code", F.explode("ts").alias("t"), F.col("n").alias("tf"), "n", "len")
    seen = rows.select("code", F.explode("traits").alias("t")).groupBy("code", "t").agg(F.count("*").alias("tf"))
    return codes.unionByName(seen.join(once.select("code", "n", "len"), "code"))


def retrieve(left: DataFrame, right: DataFrame, stages: Stages, floor: float = FLOOR, near: float = NEAR) -> DataFrame:
    """(lc, rc, score, lself): all pairs of codes whose score reaches ``floor`` of the left code's own score, or ``near`` of its best.

    Both inputs are rows (code, sp, country). Exact in this sense: a left code's pairs that lie below both
    the floor and ``near`` of its best score may be missing, no others.
    """
    index = stages.cut(_texts(right))
    n, avg = index.filter("t = concat('=', code)").agg(F.count("*"), F.avg("len")).first()
    avg = avg or 1.0
    df = index.groupBy("t").agg(F.count("*").alias("df"))
    rarity = lambda df: F.log(1 + (n - df + 0.5) / (df + 0.5))
    tf = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / avg))
    post = stages.cut(index.join(df, "t").select(F.col("code").alias("rc"), "t", (rarity(F.col("df")) * tf).alias("w")))
    # a term that the index lacks still counts for the own score
    bound = post.groupBy("t").agg(F.max("w").alias("most"))
    asked = _texts(left).select(F.col("code").alias("lc"), "t", (F.col("tf") / F.col("n")).alias("q")).join(bound, "t", "left")
    asked = asked.withColumn("ub", F.col("q") * F.coalesce("most", rarity(F.lit(0.0))))
    asked = stages.cut(asked.select("lc", "t", "q", "ub", F.col("most").isNotNull().alias("known"), F.sum("ub").over(W.partitionBy("lc")).alias("self")))

    known = asked.filter("known")
    score = F.round(F.sum(F.col("q") * F.col("w")), 6)
    same = known.join(post.select(F.col("rc").alias("lc"), "t", "w"), ["lc", "t"])
    least = same.groupBy("lc").agg((score * near).alias("least"))
    ranked = asked.join(least, "lc", "left").withColumn("least", F.greatest(F.col("self") * floor, F.coalesce("least", F.lit(0.0))))
    after = F.col("self") - F.sum("ub").over(W.partitionBy("lc").orderBy(F.desc("ub"), "t").rowsBetween(W.unboundedPreceding, -1))
    probes = ranked.withColumn("after", F.coalesce(after, F.col("self"))).filter("after >= least - 1e-6")
    probes = probes.withColumn("rest", F.min(F.col("after") - F.col("ub")).over(W.partitionBy("lc"))).filter("known").select("lc", "t", "q", "least", "rest")
    # what the probes found and the most that the other terms could add
    pairs = probes.join(post, "t").groupBy("lc", "rc", "least", "rest").agg(F.sum(F.col("q") * F.col("w")).alias("part")).filter("part + rest >= least - 1e-6")
    terms = pairs.select("lc", "rc", "least").join(known.select("lc", "t", "q", "self"), "lc").join(post, ["rc", "t"])
    got = terms.groupBy("lc", "rc", "self", "least").agg(score.alias("score")).filter("score >= least - 1e-6")
    parts = lambda c: F.struct(F.substring_index(c, "|", 1).alias("word"), F.substring_index(c, "|", -1).alias("num")).alias(c)
    return got.select(parts("lc"), parts("rc"), "score", F.col("self").alias("lself"))


def _fit(pairs: DataFrame, steps: int = 12, ridge: float = 1.0) -> list[float]:
    """Weights (bias first) of the logistic model of ``y`` on FEATURES, by Newton steps over grouped sums."""
    names = list(FEATURES)
    # features are rounded, so that the distinct points are few whatever the number of pairs
    points = pairs.groupBy("y", *[F.round(x, 1).alias(x) for x in names]).agg(F.count("*").alias("n")).collect()
    if not points:
        return [0.0] * (len(names) + 1)
    x = np.array([[1.0, *[float(p[f]) for f in names]] for p in points])
    y, n = np.array([float(p["y"]) for p in points]), np.array([float(p["n"]) for p in points])
    n = n / n.sum() * 1000
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (n * (y - p)) - ridge * w)
    return [float(v) for v in w]


def link(docs: DataFrame, supps: DataFrame, countries: DataFrame | None = None, floor: float = FLOOR, near: float = NEAR) -> DataFrame:
    """``(doc_row_id, supp_row_id, confidence)`` for each pair of rows of the same specimen.

    Both tables have row_id, voucher, species and country; ``countries`` (value, country) maps country
    values to canonical names. Rows without any code match nothing. Repeated rows count once; columns
    beyond these don't matter; an empty table gives no pairs. Several rows of one specimen give all pairs.
    """
    stages = Stages(docs.sparkSession, "linkage")

    def side(df: DataFrame) -> DataFrame:
        x = df.select("row_id", voucher_codes(F.col("voucher")).alias("codes"), species_key(F.col("species")).alias("sp"), F.when(~absent("country"), F.col("country")).alias("country")).filter("row_id is not null and size(codes) > 0").distinct()
        if countries is not None:
            x = x.join(countries.select(F.col("value").alias("country"), F.col("country").alias("c")), "country", "left").withColumn("country", F.when(F.col("c") != "unmatched", F.col("c"))).drop("c")
        return stages.cut(x.select("row_id", "sp", "country", F.explode("codes").alias("code")))

    d, s = side(docs), side(supps)
    got = stages.cut(retrieve(s.select("code", "sp", "country"), d.select("code", "sp", "country"), stages, floor, near))
    # forward: the nearest codes and the runner-up; backward: the best score that the partner gets
    top = got.groupBy("lc").agg(F.max("score").alias("b"))
    second = got.join(top, "lc").filter("score < b").groupBy("lc").agg(F.max("score").alias("second"))
    back = got.groupBy("rc").agg(F.max("score").alias("best"))
    c = got.join(top, "lc").join(second, "lc", "left").join(back, "rc")
    first = F.col("score") == F.col("b")
    gap = F.col("score") - F.when(first, F.coalesce("second", floor * F.col("lself"))).otherwise(F.col("b"))
    alike = 1 - F.levenshtein(F.col("lc.word"), F.col("rc.word")) / F.greatest(F.length("lc.word"), F.length("rc.word"))
    c = stages.cut(c.select("lc", "rc", (F.col("score") / F.col("lself")).alias("cov"), (gap / F.col("lself")).alias("gap"), (F.col("score") / F.col("best")).alias("back"), first.alias("first"), (F.col("lc") == F.col("rc")).cast("double").alias("same"), alike.alias("alike")))
    pair = (
        c.join(s.select(F.col("code").alias("lc"), F.col("sp").alias("sp_s"), F.col("country").alias("co_s")).distinct(), "lc")
        .join(d.select(F.col("code").alias("rc"), F.col("sp").alias("sp_d"), F.col("country").alias("co_d")).distinct(), "rc")
        .withColumn("species", _agree(F.col("sp_s"), F.col("sp_d")))
        .withColumn("country", F.when(F.col("co_s").isNull() | F.col("co_d").isNull(), 0.0).when(F.col("co_s") == F.col("co_d"), 1.0).otherwise(-1.0))
    )
    pair = stages.cut(pair)
    mutual = F.col("first") & (F.col("back") >= near)
    # exact codes are matches unless both traits differ; what isn't mutual, or differs in code and beside it, is none
    exact = F.col("same") == 1
    label = F.when(exact & mutual & ((F.col("species") >= 0) | (F.col("country") >= 0)), 1.0).when(~mutual | (~exact & ((F.col("species") < 0) | (F.col("country") < 0) & (F.col("species") == 0) | (F.col("alike") < 0.6))), 0.0)
    w = _fit(pair.withColumn("y", label).filter("y is not null"))
    z = F.lit(w[0])
    for f, v in zip(FEATURES, w[1:]):
        z = z + v * F.col(f)
    good = pair.filter(mutual).withColumn("confidence", F.round(1 / (1 + F.exp(-z)), 4)).filter("confidence >= 0.5")
    good = good.select("lc", "rc", F.struct(F.col("sp_s").alias("sp"), F.col("co_s").alias("country")).alias("ls"), F.struct(F.col("sp_d").alias("sp"), F.col("co_d").alias("country")).alias("rs"), "confidence")
    sides = [F.col("code").alias("lc"), F.struct("sp", "country").alias("ls"), F.col("row_id").alias("supp_row_id")], [F.col("code").alias("rc"), F.struct("sp", "country").alias("rs"), F.col("row_id").alias("doc_row_id")]
    out = good.join(s.select(*sides[0]), ["lc", "ls"]).join(d.select(*sides[1]), ["rc", "rs"])
    return out.groupBy("doc_row_id", "supp_row_id").agg(F.max("confidence").alias("confidence"))
