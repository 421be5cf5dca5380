import json

from pyspark.sql import functions as F

from sporeframe.functions import external as X
from sporeframe.sources import registry


def col(spark, f, *values):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(f(F.col("v")).alias("o")).collect()]


def test_html_types(spark):
    page = "<html><b>Typification Details:</b> <p>Holotype <i>CORD</i>, Urcelay 292</p> Isotype BAFC&nbsp;5</div> Paratype X</html>"
    got = col(spark, X.html_types, page, "<p>nothing</p>", None)
    assert [(t.type_of_type, t.material) for t in got[0]] == [("Holotype", ["CORD", "Urcelay 292"]), ("Isotype", ["BAFC 5"])]
    assert not got[1] and not got[2]


def test_links(spark):
    page = '<a href="/s/Table%20S1.xlsx?x=1">Table S1</a> <a href="/about">About</a> <a href="/s/Table%20S1.xlsx?x=1">again</a> <a class="k" href=\'/f/9\'>Additional file 2</a>'
    got = col(spark, X.supplement_links, page)[0]
    assert [(x.url, x.label) for x in got] == [("/s/Table%20S1.xlsx?x=1", "Table S1"), ("/f/9", "Additional file 2")]
    assert col(spark, X.file_name, "http://a/b/Table%20S1.xlsx?x=1") == ["Table_S1.xlsx"]
    assert col(spark, X.file_type, "a/b.XLSX", "a/b.html", "get?f=x.zip&y") == ["xlsx", None, "zip"]


def test_occurrences(spark):
    df = spark.createDataFrame([("FLOR 74360", "74360", "FLOR", None), ("FLOR 74360", "FLOR-74360", None, None), ("FLOR 74360", "74361", "FLOR", None), ("AB 12", None, None, "old AB no 12")], "c string, a string, b string, o string")
    assert [r[0] for r in df.select(X.occurrence_matches(F.col("c"), [F.col("a"), F.col("b"), F.col("o")])).collect()] == [True, True, False, True]
    c = spark.createDataFrame([(None, None, None, "GB"), ("", "Peru", "x", "GB")], "a string, b string, v string, p string")
    assert [r[0] for r in c.select(X.occurrence_country(F.col("a"), F.col("b"), F.col("v"))).collect()] == [None, "Peru"]
    assert [r[0] for r in c.select(X.occurrence_country(F.col("a"), F.col("b"), F.col("v"), F.col("p"))).collect()] == ["GB", "Peru"]


def test_salvage(spark):
    good = '[{"voucher": "A 1", "country": "Peru"}]'
    got = col(spark, X.salvaged_pairs, good, f"Sure! Here: {good} ok?", '{"voucher": "A 1", "country": "Peru"}, {"voucher": "B', "none")
    assert [[(x.voucher, x.country) for x in g] for g in got] == [[("A 1", "Peru")]] * 3 + [[]]


def test_registry_sources(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"1": {"species": "A b", "types": [{"type_of_type": "Holotype", "material": ["X 1"]}]}, "2": {"species": "A c"}}))
    got = {r.record_id: r for r in registry.read_store(spark, str(tmp_path / "s.json")).collect()}
    assert got["1"].types[0].material == ["X 1"] and got["2"].species == "A c"
    xml = "<r><Name><RECORD_x0020_NUMBER>7</RECORD_x0020_NUMBER><NAME_x0020_OF_x0020_FUNGUS>A b</NAME_x0020_OF_x0020_FUNGUS></Name><Name><RECORD_x0020_NUMBER>8</RECORD_x0020_NUMBER></Name></r>"
    assert [(r.record_number, r.name_of_fungus) for r in registry.parse_names(spark.createDataFrame([(xml,)], "x string"), "x").collect()] == [("7", "A b"), ("8", None)]
    assert registry.changed_since(spark, str(tmp_path / "s.json"), F.current_timestamp() + F.expr("interval 1 day")).count() == 0
    assert registry.changed_since(spark, str(tmp_path / "s.json"), F.lit("2000-01-01").cast("timestamp")).count() == 1


def test_new_aliases(spark):
    known = spark.createDataFrame([("K", "A1"), ("K", "A2")], "cluster_key string, alias string")
    found = spark.createDataFrame([("A1", "B9"), ("A1", "A2"), ("Z1", "Z2")], "existing string, candidate string")
    assert sorted(tuple(r) for r in registry.new_aliases(found, known).collect()) == [("K", "B9"), ("Z1", "Z1"), ("Z1", "Z2")]
