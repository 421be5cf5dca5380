import datetime as dt
import math
import random

from pyspark.sql import functions as F

from sporeframe.llm import canonical, components, linkage, packing, queries, survivor
from sporeframe.session import Stages


def union_find(pairs):
    p = {}

    def find(x):
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            if a != b:
                p[max(a, b)] = min(a, b)
    return {x: find(x) for x in p}


def test_groups(spark):
    rnd = random.Random(4)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(i, (i + 1) % 12 + 200) for i in range(200, 212)]
    pairs += [(rnd.randrange(300, 330), rnd.randrange(300, 330)) for _ in range(140)] + [(5, 5), (None, 3), (7, None), (1, 0), (0, 1)]
    df = spark.createDataFrame([(*p, "x") for p in pairs], "a long, b long, group_id string")
    assert {r.id: r.group_id for r in components.groups(df).collect()} == union_find(pairs)


def test_groups_members_and_empty(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 9)], "a long, b long")
    got = {r.id: r.group_id for r in components.groups(df, members=spark.createDataFrame([(1,), (2,), (3,)], "k long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1}
    assert components.groups(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pigeonhole_is_exact(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 9)))
    a, b = sorted({word() for _ in range(150)}), sorted({word() for _ in range(80)})

    def lev(s, t):
        p = list(range(len(t) + 1))
        for i, x in enumerate(s):
            q = [i + 1]
            for j, y in enumerate(t):
                q.append(min(q[-1] + 1, p[j + 1] + 1, p[j] + (x != y)))
            p = q
        return p[-1]

    want = {(s, t, lev(s, t)) for s in a for t in b if lev(s, t) <= 2}
    got = canonical.pigeonhole(spark.createDataFrame([(x,) for x in a], "text string"), spark.createDataFrame([(x,) for x in b], "key string"))
    assert {tuple(r) for r in got.collect()} == want


VARIANTS = [("Brazil", "brazil"), ("Brazil", "br"), ("Brazil", "bra"), ("Georgia", "georgia"), ("Georgia", "ge"), ("United States", "usa"), ("United States", "us"), ("Ireland", "ireland"), ("Ireland", "ie"), ("Zambia", "zambia"), ("Zambia", "zm"), ("Guinea", "guinea"), ("Guinea", "gn"), ("Equatorial Guinea", "equatorial guinea"), ("Equatorial Guinea", "gq"), ("Congo", "congo"), ("Congo", "cg"), ("Mexico", "mexico"), ("Mexico", "mx"), ("France", "france"), ("France", "fr"), ("France", "république française")]
PLACES = [("quobribrio", ["Brazil"]), ("zarpelenz hills", ["France", "Mexico"])]
NAMES = {
    "Brazil": "Brazil", "BRA": "Brazil", "B R A Z I L": "Brazil", "brasilien": "Brazil", "Braz1l": "Brazil", "Brzail": "Brazil", "Western Brazil": "Brazil", "Brazil: Rio, 3 m": "Brazil", "Br: X": "Brazil", "X Valley, Brazil": "Brazil", "“Brazil”": "Brazil",
    "Georgia, USA": "United States", "USA: New Mexico, Draw": "United States", "Rep. of Georgia": "Georgia", "Iceland: X": "unmatched", "Irelnd": "Ireland", "The Gambia": "unmatched", "Guinea (Conakry side)": "Guinea", "Equatoriall Guinea": "Equatorial Guinea", "Northern Rhodesia": "Zambia",
    "Congo, Rep.": "Congo", "RÃ©publique FranÃ§aise": "France", "Quobribrio": "Brazil", "near Quobrribrio": "unmatched", "Quobrribrio": "Brazil", "Zarpelenz Hills": "unmatched", "nowhere at all": "unmatched", "Quobribrio, near X Creek": "Brazil", "x" * 5000: "unmatched",
}


def test_countries(spark):
    v = spark.createDataFrame(VARIANTS, "country string, spelling string")
    ref = canonical.country_reference(spark, v, spark.createDataFrame(PLACES, "locality_norm string, countries array<string>"))
    rows = [(x, 1) for x in [*NAMES, *NAMES, None, "", " n/a "]]
    got = {r.value: r.country for r in canonical.map_countries(spark.createDataFrame(rows, "value string, key int"), "value", ref).collect()}
    wrong = {k: (got.get(k), w) for k, w in NAMES.items() if got.get(k) != w and k != "near Quobrribrio"}
    assert not wrong and len(got) == len(NAMES)
    assert canonical.map_countries(spark.createDataFrame([], "value string"), "value", ref).count() == 0


T = dt.datetime(2024, 1, 1)
FIELDS = {"s": survivor.species_incomplete, "v": survivor.code_incomplete, "c": survivor.never}


def survive(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, g string, s string, v string, c string, t int, at timestamp, value string")
    return {r.group_id: tuple(r)[1:] for r in survivor.survivors(df, ["g"], "id", FIELDS, F.col("t"), "at").collect()}


def test_survivors(spark):
    d = lambda n: T + dt.timedelta(days=n)
    rows = [
        (1, "a", "H. rubosa", "12", "Peru", 3, d(9)), (2, "a", "Hexaphylla rubosa", "K 12", "Peru", 1, d(1)), (2, "a", "Hexaphylla rubosa", "K 12", "Peru", 1, d(1)), (3, "a", "Hexaphylla rub", "K 1", "per", 3, d(2)),
        (4, "b", None, " ", "unknown", 1, d(1)), (5, "b", None, "", None, 2, d(2)),
        (6, "c", "A bcd", "K 1", "x", 1, d(1)), (7, None, "A bcd", "K 1", "x", 1, d(1)), (8, None, "A bcd", "K 1", "x", 1, d(1)),
        (9, "e", "A bcd", "K 1", "x", 2, d(1)), (10, "e", "A bce", "K 2", "y", 2, d(1)),
    ]
    got = survive(spark, rows)
    assert got == {1: ("Hexaphylla rubosa", "K 12", "Peru"), 4: ("", "", ""), 9: ("A bcd", "K 1", "x")}
    assert survive(spark, []) == {}


def test_currency_without_time(spark):
    d = lambda n: T + dt.timedelta(hours=7 * n)
    # everywhere else "old 1" was followed by "new 1"
    rows = [(10 * i + j, f"g{i}", None, v, None, 1, d(j)) for i in range(5) for j, v in enumerate(["old 1", "new 1"])]
    rows += [(900, "u", None, "old 1", None, 1, d(1)), (901, "u", None, "new 1", None, 1, None)]
    rows += [(910, "w", None, "old 1", None, 1, None), (911, "w", None, "new 1", None, 1, None), (912, "w", None, "zz 9", None, 1, None)]
    got = survive(spark, rows)
    assert got[900][1] == "new 1" and got[910][1] == "new 1"


def test_linkage(spark):
    docs = [(1, "Drossner l18a,b", "H. rubosa", "Peru"), (2, "LIORENTE-108", None, None), (3, "Lomax 12 (=JYHB 2015)", "Aaa bbb", "Chile"), (4, None, "Aaa bbb", None), (5, "Lomax 13", "Ccc ddd", None), (1, "Drossner l18a,b", "H. rubosa", "Peru"), (6, "x" * 3000, "", "")]
    supps = [(101, "118 (Drossner)", "Hexaphylla rubosa", "Peru"), (102, "leg. Liorente no. 108", "X y", None), (103, "JYHB 2015", "Aaa bbb", None), (104, "#12 Loax", "Aaa cf. bbb", "Chile"), (105, "Brastow 118", "Hexaphylla rubosa", "Peru"), (106, "", None, None), (107, "K. Lomax 99", "Ccc ddd", None)]
    a, b = (spark.createDataFrame([(*r, "x") for r in t], "row_id long, voucher string, species string, country string, code string") for t in (docs, supps))
    got = {(r.doc_row_id, r.supp_row_id) for r in linkage.link(a, b).collect()}
    assert got == {(1, 101), (2, 102), (3, 103), (3, 104)}
    assert linkage.link(a, b.limit(0)).count() == 0 and linkage.link(a.limit(0), b).count() == 0


def test_short_words(spark):
    docs = [(1, "He 592", "Fomitiporia aa", "China"), (2, "Dai 10756", "Phellinus bb", None), (3, "LE 1234", None, None)]
    supps = [(11, "592 (He)", "Fomitiporia aa", None), (12, "leg. Dai no. 10756", None, "China"), (13, "LE-1234", None, "Peru"), (14, "Dai 10757", "Phellinus bb", "China"), (15, "592", "Fomitiporia aa", "China")]
    a, b = (spark.createDataFrame(t, "row_id long, voucher string, species string, country string") for t in (docs, supps))
    assert {(r.doc_row_id, r.supp_row_id) for r in linkage.link(a, b).collect()} == {(1, 11), (2, 12), (3, 13)}


def test_retrieval_is_exact(spark):
    rnd = random.Random(11)
    words = ["lomax", "lomac", "loma", "brastow", "he", "dai"]

    def rows(n):
        code = lambda: (rnd.choice(words), str(rnd.randrange(1, 5)))
        out = [(code(), rnd.choice([None, ("aa", "xx"), ("bb", "yy"), ("b.", "yy")]), rnd.choice([None, "Peru", "Chile"])) for _ in range(n)]
        return out + [(("he", "1"), ("aa", "xx"), "Peru")] * 30

    left, right = rows(40), rows(60)
    schema = "code struct<word: string, num: string>, sp struct<g: string, e: string>, country string"

    def texts(rows):
        out = {}
        for (w, n), sp, c in rows:
            x = f"^{w}$"
            ts = [f"={w}|{n}", *dict.fromkeys(f"{x[i:i + 2]}|{n}" for i in range(len(x) - 1))]
            ts += [f"genus|{sp[0]}"] if sp and "." not in sp[0] else []
            ts += [f"epithet|{sp[1]}"] if sp else []
            ts += [f"country|{c}"] if c else []
            d, k = out.setdefault((w, n), ({}, [0]))
            k[0] += 1
            for t in ts:
                d[t] = d.get(t, 0) + 1
        return out

    docs = texts(right)
    avg = sum(sum(d.values()) for d, _ in docs.values()) / len(docs)
    df = {}
    for d, _ in docs.values():
        for t in d:
            df[t] = df.get(t, 0) + 1
    idf = lambda n: math.log(1 + (len(docs) - n + 0.5) / (n + 0.5))
    weight = {c: {t: idf(df[t]) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * sum(d.values()) / avg)) for t, f in d.items()} for c, (d, _) in docs.items()}
    want = {}
    for q, (ts, (n,)) in texts(left).items():
        own = sum(f / n * max((w[t] for w in weight.values() if t in w), default=idf(0)) for t, f in ts.items())
        scores = {c: sum(f / n * w.get(t, 0) for t, f in ts.items()) for c, w in weight.items()}
        least = max(linkage.FLOOR * own, linkage.NEAR * scores.get(q, 0))
        want |= {(q, c): round(v, 4) for c, v in scores.items() if v >= least}
    got = linkage.retrieve(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), Stages(spark, "test"))
    assert {(tuple(r.lc), tuple(r.rc)): round(r.score, 4) for r in got.collect()} == want and want


def test_best_fit_is_item_by_item():
    rnd = random.Random(8)
    for cap in (1, 7, 60, 256):
        sizes = [rnd.randrange(1, cap + 1) if rnd.random() < 0.4 else rnd.randrange(1, cap // 3 + 2) for _ in range(400)]
        sizes = [min(s, cap) for s in sizes]
        counts = {s: sizes.count(s) for s in set(sizes)}
        fill, placed = {}, {s: set() for s in counts}
        for s, r, n, c in packing.best_fit(counts, cap):
            for k in range(n):
                fill[c + k] = fill.get(c + k, 0) + s
                placed[s].add(r + k)
        gaps = []
        for s in sorted(sizes, reverse=True):
            fit = [(g, i) for i, g in enumerate(gaps) if g >= s]
            if fit:
                gaps[min(fit)[1]] -= s
            else:
                gaps.append(cap - s)
        assert len(fill) == len(gaps) and max(fill.values()) <= cap and all(len(placed[s]) == n for s, n in counts.items())


def test_pack(spark):
    sizes = [(i, (i * 37) % 90) for i in range(1, 300)] + [(1000, 555), (1001, None), (1002, 0)]
    caps = spark.createDataFrame([("a", 100), ("a", 200), ("b", 64), ("bad", 0), ("none", None)], "size_name string, capacity_tokens int")
    df = spark.createDataFrame([(*s, "q") for s in [*sizes, sizes[0]]], "id long, n int, piece string")
    got = packing.pack(df, "id", "n", caps, block_rows=40).collect()
    for name, cap in (("a", 100), ("b", 64)):
        rows = [r for r in got if r.size_name == name]
        fill = {}
        for r in rows:
            fill[r.container_id] = fill.get(r.container_id, 0) + r.n
        assert max(fill.values()) <= cap
        for i, n in sizes:
            mine = sorted((r.piece, r.start, r.n) for r in rows if r.id == i)
            assert sum(x[2] for x in mine) == (n or 0) and [x[0] for x in mine] == list(range(len(mine)))
            assert len(mine) == max(1, -(-(n or 0) // cap))
    assert {r.size_name for r in got} == {"a", "b"}
    assert packing.pack(df.limit(0), "id", "n", caps).count() == 0


def test_query_columns(spark):
    sf = "/root/testdata/sf0.001"
    want = {"p2_found": ["group_id", "species", "voucher", "country"], "p3_found": ["doc_row_id", "supp_row_id"], "p5_found": ["seq_no", "group_id"], "p9_packed": ["size_name", "container_id", "doc_id", "piece", "start", "n"]}
    for name, columns in want.items():
        df = queries.QUERIES[name](spark, sf)
        assert df.columns == columns
        assert df.count() == df.distinct().count() > 0
