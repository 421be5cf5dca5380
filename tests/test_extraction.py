"""Tokens, places and article tables on small cases written by hand."""

import pytest
from pyspark.sql import functions as F

from sporeframe.functions import registry
from sporeframe.functions import tokens as K
from sporeframe.operators import articletables as A
from sporeframe.operators import matrix, places, specimens

# Forms that each predicate must accept (first) or refuse.
TOKENS = {
    "is_accession": (["KC136220", "JX093771.1", "MF977778a", "(JQ087932*)", "U12345"], ["He 592", "KC13622", "ABC123456", ""]),
    "is_accession_or_dash": (["–", "---", "KC136220", "ITS KC136220 x"], ["KC136220 KC136221", "none"]),
    "is_citation": (["[40]", "[2, 5]", "[1-3]"], ["40", "(40)", "[a]"]),
    "is_species": (["Fomitiporia aethiopica", "F. aethiopica", "F aethiopica", 'Pluteus "sp." I', "Inonotus cf. rickii"], ["Mexico", "F. a", "fomitiporia x"]),
    "is_genus": (["Aurificaria"], ["Aur", "aurificaria", "Aurificaria x"]),
    "is_reference": (["Larsson (2011)", "Vellinga et al.", "This study", "al. (2020)", "unpubl."], ["He 592", "Brazil"]),
    "is_voucher": (["MUCL 44806", "LAH:SH148", "Dai 10756", "FP-134784", "# 115977", "83SAMHYP", "IO.14.164"], ["Vellinga 2004", "brazil", "Brazil"]),
    "is_noise": (["12", "MycoKeys 4: 1", "DOI 10.1", "LOMAX ET AL:", "114: 133–175"], ["1234", "TASM:YG G39", "Spores smooth"]),
    "is_gene_head": (["ITS", " rpb2 ", "Accession No"], ["gene"]),
    "is_super_head": (["GenBank accession no.", "Accession number"], ["accession"]),
    "is_no_collector": (["Jan.", "Ibid", "12", ""], ["Robledo"]),
    "is_download": (["http://x/a.XLSX?dl=1", "b.zip"], ["http://x/a.html"]),
}


@pytest.mark.parametrize("name", TOKENS)
def test_tokens(spark, name):
    yes, no = TOKENS[name]
    df = spark.createDataFrame([(x,) for x in [*yes, *no]], "x string")
    got = {r.x: r.y for r in df.select("x", getattr(K, name)(F.col("x")).alias("y")).collect()}
    assert got == dict.fromkeys(yes, True) | dict.fromkeys(no, False)
    assert spark.createDataFrame([(None,)], "x string").select(getattr(K, name)(F.col("x")).alias("y")).first().y is (name == "is_no_collector")


def one(spark, expr, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


def test_cells(spark):
    x = F.col("x")
    assert one(spark, K.type_label(x), "culture from the holotype of X", "Isolate of paratype", "epitype of X", "holotype", None) == ["ex-holotype", "ex-paratype", "epitype", None, None]
    assert one(spark, K.guessed_type(x), "a.XLS", "a.docx", "a.pdf.zip", "a.html", None) == ["excel", "word", "pdf", "unknown", "unknown"]
    assert one(spark, K.codes_of(x), "a, (KC136220); KC136220|jx093771.1", None, "") == [["KC136220", "jx093771.1"], [], []]
    assert one(spark, K.marker_codes([x], F.lit(" GB1 ")), " KC136220 ", "123456", None) == [["KC136220", "GB1"], ["GB1"], ["GB1"]]
    assert one(spark, K.lookup_candidates(x), "KC136220.1", "KC136220", " ", None) == [["KC136220.1", "KC136220"], ["KC136220"], [], []]
    assert one(spark, K.query_genus(x), "Pluteus albus", "F. albus", "(Pluteus) x", "Au", None) == ["Pluteus", None, "Pluteus", None, None]
    assert one(spark, K.is_species_candidate(x, F.lit(None)), "Pluteus albus", "Living twig", "Vellinga 2004", "Justo et al.", "Agaricales x", "Amylocorticiales sp.", None) == [True, False, False, False, False, True, False]
    assert one(spark, specimens.clause_vouchers(x), "Salta, Robledo 1891, 1876, Jan 2004, CORD-C 12; MUCL 44806 and Robledo 1891", "", None)[0] == ["Robledo 1891", "Robledo 1876", "CORD-C 12", "MUCL 44806"]


VARIANTS = [("Brazil", "brasil", 1), ("Brazil", "br", 2), ("Brazil", "bra", 3), ("United States", "usa", 1), ("United States", "us", 2), ("Turkey", "turkiye", 1), ("Turkey", "türkiye", 2), ("Georgia", "georgia", 1), ("United States", "georgia", 0)]


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame(VARIANTS, "country string, spelling string, ord int"), spark.createDataFrame([("salta creek", ["Brazil"]), ("two hills", ["Brazil", "Turkey"])], "locality_norm string, countries array<string>")


def test_countries(spark, dims):
    values = ["Brazil", "BRASIL", "Türkiye", "BR", "br", "USA (MI)", "US (x)", "Salta", "Georgia", None, "", "USA (MI)"]
    df = spark.createDataFrame([(v, 1) for v in values], "x string, country int")
    assert {r.value: (r.country, r.how) for r in places.resolve(df, "x", dims[0]).collect()} == {"Brazil": ("Brazil", "name"), "BRASIL": ("Brazil", "alias"), "Türkiye": ("Turkey", "alias"), "BR": ("Brazil", "code"), "USA (MI)": ("United States", "base"), "US (x)": ("United States", "base"), "Georgia": ("Georgia", "name")} | {"USA (MI)": ("United States", "base")}
    assert {r.value: r.country for r in places.canonical_name(spark.createDataFrame([("br",), ("usa/",), ("x",)], "x string"), "x", dims[0]).collect()} == {"br": "Brazil", "usa/": "United States"}
    assert places.resolve(df.limit(0), "x", dims[0]).count() == 0


def test_localities(spark, dims):
    values = ["Salta Creek", "Two Hills Page 3", "near Turkiye, at Brazil", "Mt. Foo", "BRASIL", None, "Page 1"]
    coded = spark.createDataFrame([("mt. foo", ["Chile"])], "place string, countries array<string>")
    got = {r.value: (r.country, r.choices, r.how) for r in places.detect(spark.createDataFrame([(v,) for v in values], "x string"), "x", *dims, coded).collect()}
    assert got == {"Salta Creek": ("Brazil", ["Brazil"], "cache"), "Two Hills Page 3": (None, ["Brazil", "Turkey"], "cache"), "near Turkiye, at Brazil": ("Turkey", ["Turkey"], "text"), "Mt. Foo": ("Chile", ["Chile"], "geocoder"), "BRASIL": ("Brazil", ["Brazil"], "text")}
    cells = ["Brazil", "Salta Creek", "AJ78 (Brasil)", "KC136220", "Pluteus brasil", "1234", "Two Hills"]
    got = {r.value: r.how for r in places.resolve_extended(spark.createDataFrame([(v,) for v in cells], "x string"), "x", *dims).collect()}
    assert got == {"Brazil": "name", "Salta Creek": "detected"}


def test_registry_country(spark):
    rows = spark.createDataFrame([(1, "K 1"), (2, "K-2"), (3, "K 3"), (4, None), (1, "K 1"), (5, "K 9")], "id long, code string")
    aliases = spark.createDataFrame([("k2", "K2"), ("k2", "Z 5"), ("k2", "A 5"), ("k3", "K3")], "cluster_key string, alias string")
    a = spark.createDataFrame([("Z5", "Peru"), ("K1", None), ("K3", "Chile"), ("K3", "Brazil")], "code string, country string")
    b = spark.createDataFrame([("K1", "Cuba"), ("A-5", "Iran"), ("K3", "Fiji")], "code string, country string")
    got = {r.id: (r.country, r.source, r.matched) for r in places.registry_country(rows, "id", "code", aliases, [("a", a), ("b", b)]).collect()}
    # alias by alias in order, each asked of both sources
    assert got == {1: ("Cuba", "b", "K 1"), 2: ("Iran", "b", "A 5"), 3: ("Brazil", "a", "K 3")}


def test_tables(spark):
    cells = [("t", r, h, v) for r in range(12) for h, v in (("Taxon name", f"Aus bus{r}"), ("Herbarium no.", f"K {r}"), ("X", f"KC13622{r % 10}"), ("Note", "He 525 He 536" if r == 3 else "-"))]
    df = spark.createDataFrame([*cells, cells[0], ("t", 20, "Taxon name", "Aus cus"), ("t", 21, "X", None)], "tab string, r long, header string, value string").distinct()
    types = A.column_types(df, ["tab"])
    assert {r.header: (r.field, r.how) for r in types.collect()} == {"Taxon name": ("species", "header"), "Herbarium no.": ("voucher", "header"), "X": ("accession", "values")}
    got = {r.r: (r.species, r.voucher, r.codes) for r in A.records(df, ["tab"], types).collect()}
    assert len(got) == 12 and got[1] == ("Aus bus1", "K 1", ["accession=KC136221"])
    assert [r.r for r in A.merged_rows(df, ["tab"]).collect()] == [3]
    assert A.sampled(df, ["tab"]).filter("header = 'X'").count() == 10
    assert A.records(df.limit(0), ["tab"], types).count() == 0


def test_fill_down(spark):
    rows = [(1, "Voucher and reference", None, None), (2, "F. apiahyna", None, None), (3, "MUCL 51451", None, "KC1"), (4, None, "K 2", "KC2"), (5, "Aus bus", "K 3", "KC3"), (6, "other", "K 4", "KC4"), (7, "-", None, None)]
    df = spark.createDataFrame([("t", *r) for r in rows], "tab string, r long, species string, voucher string, its string")
    got = {r.r: (r.species, r.voucher, r.filled) for r in A.filled_down(df, ["tab"], "r", "species", "voucher", ["its"], F.floor(F.col("r") / 3)).collect()}
    assert got == {3: ("F. apiahyna", "MUCL 51451", True), 4: ("F. apiahyna", "K 2", True), 5: ("Aus bus", "K 3", False), 6: ("Aus bus", "K 4", True), 7: ("Aus bus", None, True)}


def test_best_header(spark):
    heads = [("d", 1, ["ITS"]), ("d", 2, ["ITS", "LSU"]), ("d", 3, ["rpb2", "tef1"]), ("d", 4, ["its " * 20, "lsu", "ssu"]), ("e", 1, ["colour"]), ("e", 2, ["x", "y"])]
    got = {r.doc: r.n for r in A.best_header(spark.createDataFrame(heads, "doc string, n int, genes array<string>"), ["doc"], "n", "genes").collect()}
    assert got == {"d": 2, "e": 1}


def test_wide_matrix(spark):
    rows = [("k", 1, "ITS", "A1", "AC"), ("k", 2, "ITS", "A2", "GG"), ("k", 3, "NEW", "N1", None), ("l", 4, None, "Z", "T"), (None, 5, "ITS", "Q", "T")]
    df = spark.createDataFrame(rows, "code string, n long, marker string, gbn string, seq string").withColumn("host", F.lit("oak"))
    got = {r.code: r.asDict() for r in matrix.wide_matrix(df, "code", ["host"], "marker", "gbn", "seq", "n", ["ITS", "NEW"]).collect()}
    assert got["k"] == {"code": "k", "host": "oak", "ITS": "A2", "seqITS": "GG", "NEW": "N1", "seqNEW": None, "how_multiloci": 2}
    assert got["l"]["how_multiloci"] == 0 and set(got) == {"k", "l"}


def test_registry_record(spark):
    rows = [("1", "Aus bus", "<i>Oak</i> ", "Holotype K 1", "1", "Legitimate", "Cus", "2"), ("2", "Aus", None, None, None, None, None, None), ("3", "A", "", "", "9", "Invalid", "B", "3")]
    names = ["record_id", "species", "host", "typification", "basionym_record_id", "name_status", "current_name", "current_name_id"]
    got = {r.record_id: r.r for r in spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).select("record_id", registry.record(*map(F.col, names)).alias("r")).collect()}
    assert (got["1"].host, got["1"].basionym, got["1"].status, got["1"].current_name, len(got["1"].types)) == ("Oak", "", "synonym", "Cus", 1)
    assert (got["2"].status, got["2"].types) == ("unresolved", []) and (got["3"].status, got["3"].basionym, got["3"].current_name) == ("invalid", "9", "")
