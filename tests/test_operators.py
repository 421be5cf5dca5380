import random

from pyspark.sql import functions as F

from sporeframe.functions import codes as C
from sporeframe.operators import cluster, docrows, frames, matrix, prose, specimens


def union_find(edges):
    p = {}

    def find(x):
        p.setdefault(x, x)
        while p[x] != x:
            x = p[x]
        return x

    for r, v in edges:
        a, b = find(("r", r)), find(("v", v))
        if a != b:
            p[max(a, b)] = min(a, b)
    return {r: find(("r", r))[1] for r, _ in edges}


def test_clusters(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(60), f"c{rnd.randrange(70)}") for _ in range(90)] + [(i, f"chain{i}") for i in range(100, 130)] + [(i + 1, f"chain{i}") for i in range(100, 130)]
    got = {r.r: r.cluster for r in cluster.components(spark.createDataFrame([*edges, (None, "c1"), (5, None)], "r long, v string"), "r", "v").collect()}
    assert got == union_find(edges)
    assert cluster.components(spark.createDataFrame([], "r long, v string"), "r", "v").count() == 0


def test_representative(spark):
    df = spark.createDataFrame([(1, "12"), (1, "ROBLEDO3026"), (1, "CORDROBLEDO3026"), (2, "34")], "c long, v string")
    assert {r.c: r.cluster_key for r in cluster.representative(df, "c", "v").collect()} == {1: "ROBLEDO3026", 2: "34"}


def test_matrix(spark):
    rows = [(1, "K", "A b", "ITS", "X1"), (2, "K", "A c", "ITS", "X2"), (3, "K", None, "LSU", "Y1"), (4, "L", "unknown", None, "Z"), (5, None, "q", "ITS", "W")]
    got = {r.k: r for r in matrix.specimen_matrix(spark.createDataFrame(rows, "n long, k string, s string, m string, a string"), "k", ["s"], "m", "a", "n", ["ITS", "LSU"]).collect()}
    assert (got["K"].s, got["K"].ITS, got["K"].LSU, got["K"].how_multiloci) == ("A b | A c", "X2", "Y1", 2)
    assert (got["L"].s, got["L"].ITS, got["L"].how_multiloci) == ("", None, 0) and len(got) == 2


def test_marker(spark):
    df = spark.createDataFrame([("x large subunit ribosomal RNA; internal transcribed spacer 2",), ("28S gene",), ("nothing",)], "d string")
    assert [r[0] for r in df.select(matrix.marker_of(F.col("d"))).collect()] == ["ITS", "LSU", None]


def test_validation(spark):
    df = spark.createDataFrame([("MUCL 52488", ""), ("MUCL 52488", "CBS 123"), ("[40]", ""), ("KC1.1", ""), (None, ""), ("CBS:123", "CBS 123"), ("K12345.1", "")], "c string, e string")
    got = [tuple(r[0])[:2] for r in df.select(frames.judge_voucher(F.col("c"), F.col("e"), F.lit("KC1.1"))).collect()]
    assert got == [("accepted", "ok"), ("deferred", "voucher_conflict"), ("rejected", "citation_marker"), ("rejected", "own_accession"), ("rejected", "empty"), ("deferred", "already_present"), ("rejected", "looks_like_accession")]
    s = spark.createDataFrame([("F. cupressicola x", "Fomitiporia sp."), ("Fomitiporia cupressicola", "Fomitiporia cupressicola"), ("Wrightoporia sp. KUC1", "Wrightoporia sp. B1")], "c string, e string")
    assert [r[0][0] for r in s.select(frames.judge_species(F.col("c"), F.col("e"), F.lit(True))).collect()] == ["accepted", "deferred", "rejected"]


def test_gaps(spark):
    rows = [(1, "Wrightoporia sp. FL01", "", ""), (2, "Wrightoporia lenta", "CBS 123", "China"), (3, "Polyporaceae", None, ""), (4, "Fomitiporia sp.", "BJFC 9123", None), (5, "Fomitiporia australiensis", "", "Brazil")]
    got = frames.gap_flags(spark.createDataFrame(rows, "i int, s string, v string, c string"), "v", "c", "s").orderBy("i").collect()
    assert [(r.voucher_gap, r.country_gap, r.species_gap, r.embedded_code) for r in got] == [(True, True, True, True), (False, False, False, False), (True, True, True, False), (False, True, True, False), (True, False, False, False)]


def test_consolidation(spark):
    rows = [(1, "CBS123", "A sp.", "", "AB123456", ""), (2, "CBS123", "A robusta", "Mexico", "", "EF777777"), (3, "X9", "B robusta", "Brazil", "CD999999", "")]
    got = {r.k: r for r in frames.first_present(spark.createDataFrame(rows, "i int, k string, s string, g string, its string, tef string"), "k", "i", ["s", "g", "its", "tef"]).collect()}
    assert tuple(got["CBS123"])[1:] == ("A sp.", "Mexico", "AB123456", "EF777777", 2)


def test_unanimous_review_upsert_chunks(spark):
    u = frames.unanimous(spark.createDataFrame([("d", "A"), ("d", "A"), ("e", "A"), ("e", "B"), ("f", None)], "k string, v string"), ["k"], "v")
    assert sorted((r.k, r.status, r.value, r.choices) for r in u.collect()) == [("d", "applied", "A", "A"), ("e", "ambiguous", None, "A|B")]
    a, b = spark.createDataFrame([("s1", "x"), ("s2", "y")], "signature string, c string"), spark.createDataFrame([("s1", "z"), ("s3", "y")], "signature string, c string")
    assert sorted((r.signature, r.change) for r in frames.review(a, b, ["c"]).collect()) == [("s1", "changed"), ("s2", "removed"), ("s3", "added")]
    n = frames.chunks(spark.createDataFrame([(i * 7, str(i)) for i in range(1, 451)], "o long, v string"), "o", "v", 200, block_rows=50)
    assert sorted((r.chunk, r.n, r.first, r.last) for r in n.collect()) == [(0, 200, "1", "200"), (1, 200, "201", "400"), (2, 50, "401", "450")]


def test_prose(spark):
    assert spark.createDataFrame([("see Robledo 1891, 1876 and CBS 5",)], "t string").select(prose.series_codes(F.col("t"))).first()[0] == ["Robledo 1891", "Robledo 1876"]
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["a", "K1", "K2", "b", "K3"])], "d int, i int, x string")
    assert sorted((r.start, r.end, r.n) for r in prose.runs(lines, "d", "i", F.col("x").rlike("^K")).collect()) == [(1, 2, 2), (4, 4, 1)]
    v = spark.createDataFrame([("colombia", "Colombia"), ("peru", "Peru")], "spelling string, country string")
    text = "Typification. COLOMBIA. CESAR: Valledupar, 15 Sep 2012, Palacio 105 (holotype, HUA 185578). Peru; Lima, Soto 77; ibid., Soto 78."
    got = specimens.clause_pairs(spark.createDataFrame([(1, text)], "k int, t string"), "k", "t", v).collect()
    assert {("Palacio 105", "Colombia"), ("Soto 77", "Peru"), ("Soto 78", "Peru")} <= {(r.voucher, r.country) for r in got}
    left, right = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, at int"), spark.createDataFrame([(1, 3, "a"), (1, 5, "b")], "k int, at int, h string")
    assert sorted(map(tuple, prose.asof(left, right, "k", "at", ["h"]).collect()), key=repr) == [(1, 1, None), (1, 5, "b"), (2, 9, None)]


def test_chunks_contained(spark):
    df = spark.createDataFrame([("FLOR 74360", "FLOR 74360"), ("FLOR 74360", "herb. flor no 74360"), ("FLOR 74360", "74360"), ("123", "123")], "a string, b string")
    assert [r[0] for r in df.select(C.chunks_contained(F.col("a"), F.col("b"))).collect()] == [True, True, False, False]


HEAD = ["Species", "Voucher", "Country", "ITS", "LSU"]
KNOWN = frozenset({"china", "french guiana", "brazil"})


def test_docrows_alignment():
    lines = [*HEAD, "Phylloporia crataegi", "Dai 18133", "China", "MH165865", "MG738798", "P. minutispora", "French", "Guiana", "Ipulet 706", "JF712922", "-"]
    got = docrows.rows_of(lines, KNOWN)
    assert [(r["species"], r["voucher"], r["country"], r["method"]) for r in got][0] == ("Phylloporia crataegi", "Dai 18133", "China", "perfect")
    assert got[0]["genes"] == {"ITS": "MH165865", "LSU": "MG738798"} and got[0]["confidence"] == "high"
    assert got[1]["genes"] == {"ITS": "JF712922"}


def test_docrows_forward_fill_and_headers():
    lines = [*HEAD, "Phylloporia crataegi", "Dai 1", "China", "MH165865 MG738798", "- 12 -", "Dai 2", "China", "MH165866", "MG738799", *HEAD, "Dai 3", "Brazil", "MH165867", "-"]
    got = docrows.rows_of(lines, KNOWN)
    assert got[1]["species"] == "Phylloporia crataegi" and got[1]["forward_filled"] and got[1]["confidence"] == "medium"
    assert got[2]["species"] is None and got[2]["voucher"] == "Dai 3"
    assert docrows.rows_of(["Inonotus rheades", "TW 385", "Germany", "AF311019"], KNOWN)[0]["confidence"] == "low"
    assert docrows.rows_of([], KNOWN) == [] and docrows.rows_of([None, ""], KNOWN) == []


def test_docrows_lines_are_joined():
    known = KNOWN | {"french guiana", "united states of america", "papua new guinea", "guinea"}
    cells = docrows.joined_lines(["Fomitiporia", "aethiopica", "MUCL", "51451", "French", "Guiana", "United", "States", "of", "America", "Papua", "New", "Guinea", "ITS", "28S", "Brazil", "cf. x", "KC136220"], known)
    assert cells == ["Fomitiporia aethiopica", "MUCL 51451", "French Guiana", "United States of America", "Papua New Guinea", "ITS", "28S", "Brazil", "cf. x", "KC136220"]
    assert docrows.joined_lines([], known) == []


def test_docrows_every_cell_is_kept():
    want = ["species", "voucher", "country"]
    assert docrows.align(["A bus", "K 1", "Peru"], want, KNOWN) == (dict(zip(want, ["A bus", "K 1", "Peru"])), "perfect", [])
    got, how, rest = docrows.align(["A page line of prose", "another", "Phylloporia crataegi", "Dai 1", "China"], want, KNOWN)
    assert (how, got, rest) == ("typed", {"species": "Phylloporia crataegi", "voucher": "Dai 1", "country": "China"}, ["A page line of prose", "another"])
    assert docrows.align(["Dai 1"], want, KNOWN) == ({"voucher": "Dai 1"}, "typed", [])
    rows = docrows.rows_of([*HEAD, "prose one", "prose two", "Phylloporia crataegi", "Dai 1", "China", "MH165865", "MH165866", "MH165867"], KNOWN)
    assert rows[0]["unplaced"] == ["prose one", "prose two"] and sorted(rows[0]["genes"].values()) == ["MH165865", "MH165866", "MH165867"]


def test_docrows_species_and_specimen_columns():
    assert docrows.settled(["specimen", "voucher", "country"]) == ["species", "voucher", "country"]
    assert docrows.settled(["species", "specimen", "voucher"]) == ["species", "voucher"]
    assert docrows.settled(["species", "specimen"]) == ["species", "voucher"]
    lines = [*HEAD, "Phylloporia crataegi", "Dai 0", "China", "MH165800", "-"]
    for k in range(1, 140):
        lines += [f"Dai {k}", "China", f"MH1658{k:02d}" if k < 100 else f"MH165{k:03d}", "-"]
    rows = docrows.rows_of(lines, KNOWN)
    filled = [r["forward_filled"] for r in rows[1:]]
    assert all(filled[: docrows.BACK // 4 - 1]) and not any(filled[docrows.BACK // 4 + 2 :])


def test_markers(spark):
    names = {"Aus bus beta-tubulin (tub2) gene": "BTUB", "tub2 gene, partial": "BTUB", "betatubulin-like protein": None, "betatubulin": "BTUB", "elongation factor 1-alpha": "TEF1", "EF-1 alpha": "TEF1", "elongation factor G": None, "elongation factor 1-beta": None, "RNA polymerase II subunit": "RPB2", "RNA polymerase II second largest subunit": "RPB2", "RNA polymerase II largest subunit": "RPB1", "ATP synthase subunit 6": "ATP6", "actin gene": "ACT", "ITS region of 28S": "ITS", None: None}
    df = spark.createDataFrame([(n,) for n in names], "d string")
    assert {r.d: r.m for r in df.select("d", matrix.marker_of(F.col("d")).alias("m")).collect()} == names
