import random

from sporeframe.operators import impute


def brute(rows):
    rows = sorted(set(rows), key=repr)
    bad = lambda x: x is None or " ".join(x.split()).lower() in ("", "unknown", "na")
    out = set()
    for k, d, v in rows:
        if bad(v) and not bad(d):
            seen = {}
            for k2, d2, v2 in rows:
                if d2 == d and not bad(v2) and k2 is not None:
                    seen.setdefault(v2, set()).add(k2)
            if seen:
                out.add((k, max(seen, key=lambda x: (len(seen[x]), -min(seen[x])))))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", "c", "unknown", None, ""]), rnd.choice(["x", "y", "z", None, "NA", " "])) for i in range(300)]
    rows += rnd.sample(rows, 60)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "k long, d string, v string, _v string")
    got = impute.fill(df, "k", ["v"], ["d"], "d").collect()
    assert {(r.k, r.item) for r in got} == brute(rows)


def test_provenance_ties_and_long_values(spark):
    long = "q" * 100_000
    rows = [(1, "a", None), (2, "a", "x"), (3, "a", "x"), (4, "b", None), (5, "b", "p"), (6, "b", "o"), (7, long, long), (8, long, None), (9, None, None), (10, "lonely", None)]
    got = {r.k: (r.item, r.filled_by) for r in impute.fill(spark.createDataFrame(rows, "k long, d string, v string"), "k", ["v"], ["d"], "d").collect()}
    assert got == {1: ("x", "dependency:d"), 4: ("p", "group:d"), 8: (long, "dependency:d")}


def test_determinants_before_group(spark):
    rows = [(1, "s", "g", None), (2, "s", "h", "dep"), (3, "t", "g", "grp"), (4, "u", "g", None)]
    got = {r.k: (r.item, r.filled_by) for r in impute.fill(spark.createDataFrame(rows, "k long, d string, g string, v string"), "k", ["v"], ["d"], "g").collect()}
    assert got == {1: ("dep", "dependency:d"), 4: ("grp", "group:g")}


def test_empty_and_report(spark):
    empty = spark.createDataFrame([], "k long, d string, v string")
    assert impute.fill(empty, "k", ["v"], ["d"], "d").count() == 0
    r = impute.dependencies(spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "b", "y"), (4, "b", "y")], "k long, d string, v string"), "k", ["d"], ["v"]).first()
    assert (r.determinant_values, r.complete_keys, r.supporting_keys, r.verified_values) == (2, 4, 3, 1)


def test_nearest_in_time(spark):
    rows = [(1, "a", None, 10), (2, "a", 5, 20), (3, "a", None, 30), (4, "a", 7, 40), (4, "a", 7, 40), (5, "b", None, 1), (6, None, None, 5), (7, "a", None, None), (8, "a", None, 20 + 200_000), (9, "n/a", None, 3)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "k long, g string, v int, at long, item string")
    got = {r.k: (r.item, r.filled_by) for r in impute.fill_nearest(df, "k", "v", "g", "at").collect()}
    assert got == {1: (5, "after:g"), 3: (5, "before:g"), 8: (7, "before:g")}
    assert impute.fill_nearest(df.limit(0), "k", "v", "g", "at").count() == 0


def test_mined_determinants(spark):
    # the code decides the place, the colour doesn't; a code seen once proves nothing
    rows = [(i, f"c{i // 3}", "red" if i % 2 else "blue", f"p{i // 3}" if i % 3 else None, "s") for i in range(30)] + [(100, "c99", "red", "rare", "s"), (101, "c99", "red", None, "s"), (102, None, "red", None, "t")]
    df = spark.createDataFrame(rows, "k long, code string, colour string, place string, kind string")
    got = {r.k: (r.item, r.filled_by) for r in impute.fill_mined(df, "k", ["place"], ["colour", "code"], "kind").collect()}
    assert all(got[i] == (f"p{i // 3}", "dependency:code") for i in range(0, 30, 3)) and got[101][1] == "group:kind" and 102 not in got
