import io
import os
import zipfile
import zlib

from pyspark.sql import functions as F

from sporeframe.sources import flatfile, sinks, tables
from sporeframe.streaming import incremental

RECORD = '''LOCUS       MK1          650 bp    DNA     linear   PLN 01-JAN-2020
DEFINITION  Wrightoporia lenta internal transcribed spacer 1,
            partial sequence.
VERSION     MK1.1
  ORGANISM  Wrightoporia lenta
REFERENCE   1
  TITLE     A title over
            two lines
FEATURES             Location/Qualifiers
     source          1..650
                     /organism="Wrightoporia lenta"
                     /specimen_voucher="FLOR 123"
                     /geo_loc_name="Brazil: Santa
                     Catarina"
                     /note="says ""x"""
                     /environmental_sample
     rRNA            1..650
                     /note="other"
ORIGIN
        1 acgtac gtac
       11 gg
'''


def test_flatfile(spark, tmp_path):
    (tmp_path / "a.gb").write_text(RECORD + "//\nnot a record\n//\n")
    got = flatfile.read_flatfiles(spark, str(tmp_path)).collect()
    ok = [r for r in got if r.corrupt is None]
    assert len(got) == 2 and len(ok) == 1
    r = ok[0]
    assert (r.gbn, r.bp, r.species, r.specimen_voucher, r.geo_loc_name, r.note, r.seq_text) == ("MK1.1", 650, "Wrightoporia lenta", "FLOR 123", "Brazil: Santa Catarina", 'says "x"', "ACGTACGTACGG")
    assert r.title == "A title over two lines" and r.environmental_sample == "environmental_sample" and r.strain is None


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fas").write_text(">a first\nAC\nGT\n>b\nTT\n>a last\nGG\n")
    got = {r.id: (r.description, r.seq_text) for r in flatfile.read_fasta(spark, str(tmp_path)).collect()}
    assert got == {"a": ("last", "GG"), "b": ("", "TT")}


def test_end_to_end_matrix(spark, tmp_path):
    from sporeframe.plans import pipeline

    other = RECORD.replace("MK1", "MK2").replace("internal transcribed spacer 1", "28S ribosomal RNA gene").replace("FLOR 123", "FLOR:123")
    (tmp_path / "a.gb").write_text("//\n".join([RECORD, RECORD, other]) + "//\n")
    got = pipeline.build_matrix(pipeline.records(spark, str(tmp_path))).collect()
    assert len(got) == 1 and (got[0].code, got[0].ITS, got[0].LSU, got[0].how_multiloci) == ("FLOR123", "MK1.1", "MK2.1", 2)


def test_tables(spark, tmp_path):
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(["text", "| Voucher | ITS |", "|---|:--|", "| V1 | AB123456 |", "| V2 |", "| V3 | x | y |", "", "| a |"])], "doc string, n int, l string")
    cells = tables.pipe_tables(lines, "doc", "n", "l")
    assert sorted((r.tab, r.r, r.c, r.value) for r in cells.collect()) == [(0, 0, 0, "Voucher"), (0, 0, 1, "ITS"), (0, 1, 0, "V1"), (0, 1, 1, "AB123456"), (0, 2, 0, "V2"), (0, 2, 1, ""), (0, 3, 0, "V3"), (0, 3, 1, "x | y"), (1, 0, 0, "a")]
    assert [r.is_accession_table for r in tables.classify_tables(cells, "doc").orderBy("tab").collect()] == [True, False]


def test_supplements(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Voucher;País\nV1;Perú\n".encode("cp1252"))
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>7</v></c></row></sheetData></worksheet>'
    strings = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>ITS</t></si></sst>'
    x = io.BytesIO()
    with zipfile.ZipFile(x, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", strings)
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("in.xlsx", x.getvalue())
    (tmp_path / "bad.xlsx").write_bytes(b"no archive")
    got = {(r.file, r.r, r.c, r.value) for r in tables.read_supplements(spark, str(tmp_path)).collect()}
    assert ("a.csv", 1, 1, "Perú") in got and ("b.zip/in.xlsx", 0, 0, "ITS") in got and ("b.zip/in.xlsx", 0, 2, "7") in got
    assert [(r.r, r.value, r.error[:10]) for r in tables.read_supplements(spark, str(tmp_path)).filter("file = 'bad.xlsx'").collect()] == [(None, None, "BadZipFile")]


def test_sinks(spark, tmp_path):
    t = spark.createDataFrame([("a", 1, "g"), ("b", 2, "g"), ("c", 3, "h")], "k string, v int, genus string")
    path = str(tmp_path / "t")
    sinks.upsert_partitioned(t, path, "k", "genus")
    sinks.upsert_partitioned(spark.createDataFrame([("b", 9, "h"), ("d", 4, "i")], "k string, v int, genus string"), path, "k", "genus")
    assert sorted((r.k, r.v, r.genus) for r in spark.read.parquet(path).collect()) == [("a", 1, "g"), ("b", 9, "h"), ("c", 3, "h"), ("d", 4, "i")]


def test_stream(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k string, v int, at int"
    spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 1)], schema).write.parquet(src)
    run = lambda: incremental.upsert_stream(incremental.record_stream(spark, src, schema), out, "k", "at", str(tmp_path / "cp")).awaitTermination()
    run()
    spark.createDataFrame([("b", 5, 3), ("c", 1, 1)], schema).write.mode("append").parquet(src)
    run()
    assert sorted((r.k, r.v) for r in incremental.latest(spark, out, "k", "at").collect()) == [("a", 2), ("b", 5), ("c", 1)]


def test_more_sinks(spark, tmp_path):
    from sporeframe.operators import frames

    at = str(tmp_path)
    t = spark.createDataFrame([("10.1/a", "A & <b>\x01", 1.5), ("10.1/b", None, None)], "doi string, title string, n double")
    sinks.write_xlsx(t, f"{at}/m.xlsx")
    cells = {(r, c): v for _, rows in tables.tables_of("m.xlsx", (tmp_path / "m.xlsx").read_bytes()) for r, row in enumerate(rows) for c, v in enumerate(row)}
    assert cells[(0, 1)] == "title" and cells[(1, 1)] == "A & <b>" and cells[(1, 2)] == "1.5" and cells.get((2, 1), "") == ""
    sinks.write_articles(t, f"{at}/store")
    sinks.write_articles(spark.createDataFrame([("10.1/b", "B", 2.0), ("10.1/c", "C", 3.0), (None, "x", 0.0)], t.schema), f"{at}/store")
    assert {r.doi: r.title for r in spark.read.parquet(f"{at}/store").collect()} == {"10.1/a": "A & <b>\x01", "10.1/b": "B", "10.1/c": "C"}
    assert sinks.append_articles(t, t.limit(1)).count() == 2
    g = frames.gap_flags(spark.createDataFrame([("K 1", "Peru", "Aus bus"), (None, "Peru", "Aus sp. K2")], "v string, c string, s string"), "v", "c", "s")
    sinks.write_gaps(g, f"{at}/gaps", "A/us")
    assert spark.read.option("header", True).csv(f"{at}/gaps/A_us_gaps").count() == 1
    assert {"total_records: 2", "rows_with_any_gap: 1", "genus: A/us"} <= {r.value for r in spark.read.text(f"{at}/gaps/A_us_gaps_summary").collect()}
    changes = spark.createDataFrame([("s", "changed", "c", "a", "b")], "signature string, change string, column string, before string, after string")
    assert sinks.write_review(changes, f"{at}/review") and (tmp_path / "review/changed").exists()
    assert not sinks.write_review(changes.limit(0), f"{at}/review") and not (tmp_path / "review/changed").exists()
    sinks.append_log(t.select("doi"), f"{at}/log")
    sinks.append_log(t.select("doi"), f"{at}/log")
    assert spark.read.option("header", True).csv(f"{at}/log").count() == 4
    sinks.write_labelled(t, f"{at}/labelled")
    sinks.write_set({"a": t, "b": t.limit(1)}, f"{at}/set")
    assert (tmp_path / "labelled").exists() and spark.read.option("header", True).csv(f"{at}/set/b").count() == 1
    m = spark.createDataFrame([("a", {"its": "1"}), ("b", {"lsu": "2", "its": "3"}), ("c", None)], "k string, f map<string,string>")
    assert sinks.with_optional_keys(m, "f").columns == ["k", "its", "lsu"]


def test_remote(spark, tmp_path):
    from sporeframe.sources import remote

    ids = [f"ZZ{i}" for i in range(5)]
    code = f"RECORD = {RECORD!r}\n\n\ndef service(ids):\n    if 'BAD' in ids:\n        raise OSError('no answer')\n    return chr(10).join(RECORD.replace('MK1', i) + '//' for i in ids)\n"
    (tmp_path / "own_service.py").write_text(code)
    spark.sparkContext.addPyFile(str(tmp_path / "own_service.py"))
    assert {r.gbn for r in remote.fetch(spark, ids, "own_service:service", 2).collect()} == {f"ZZ{i}.1" for i in range(5)}
    assert {r.gbn for r in remote.fetch(spark, [*ids[:2], "BAD", *ids[2:]], "own_service:service", 2).collect()} == {"ZZ0.1", "ZZ1.1"}
    index = spark.createDataFrame([("Aus bus", "A1", 900, "x", "2024-01-02"), ("Aus cus", "A2", 9000, "x", "2024-01-02"), ("Aus dus", "A3", 10, "whole genome shotgun", "2024-01-02"), ("Aus eus", "A4", 10, None, "2020-01-02"), ("Bus", "A5", 10, "", "2024-01-02")], "species string, gbn string, bp int, description string, deposited_at string").withColumn("deposited_at", F.to_timestamp("deposited_at"))
    assert [tuple(r) for r in remote.search_genus(index, "aus").collect()] == [("A1", 2), ("A4", 2)]
    assert [r.gbn for r in remote.search_genus(index, "aus", F.lit("2023-01-01").cast("timestamp"), 1).collect()] == ["A1"]
    hits = spark.createDataFrame([("q", 1, "Aus bus", 99.0, 95.0), ("q", 2, "Aus c", 99.0, 99.0), ("q", 3, "Bus b", 90.0, 97.0), ("q", 4, "Cus c", 80.0, 99.0), ("q", 101, "Dus d", 99.0, 99.9)], "q string, rank int, species string, coverage double, identity double")
    assert [(r.place, r.genus) for r in remote.best_hits(hits, "q").orderBy("place").collect()] == [(1, "Aus"), (2, "Bus")]
    answers = spark.createDataFrame([("d", "europepmc", "u2", 200, "application/PDF"), ("d", "unpaywall", "u1", 200, "text/html"), ("d", "crossref", "u3", 200, "application/pdf"), ("e", "unpaywall", "u", 404, "application/pdf")], "doi string, source string, url string, status int, content_type string")
    assert [tuple(r) for r in remote.downloads(answers, answers, ["unpaywall", "europepmc", "crossref"]).collect()] == [("d", "europepmc", "u2")]
    files = spark.createDataFrame([("f", "a.xlsx", 1), ("f", "A.xlsx", 2), ("f", "a.xlsx", 3), ("g", "a", 1)], "folder string, name string, n int")
    assert sorted(r.saved for r in remote.saved_names(files, "folder", "name", "n").collect()) == ["A_dup.xlsx", "a", "a.xlsx", "a_dup2.xlsx"]


def test_inputs_and_folders(spark, tmp_path):
    from sporeframe.sources import remote

    (tmp_path / "input_a.fas").write_text(">s1 x\nAC\ngt\n>s2\nTT\n")
    (tmp_path / "input_b.txt").write_text("Aus\n\n Bus \n")
    (tmp_path / "other.txt").write_text("no")
    assert sorted((r.file, r.kind, r.id, r.text) for r in remote.read_inputs(spark, str(tmp_path)).collect()) == [("input_a.fas", "fasta", "s1", "ACGT"), ("input_a.fas", "fasta", "s2", "TT"), ("input_b.txt", "txt", "Aus", None), ("input_b.txt", "txt", "Bus", None)]
    for g in ("Aus", "Bus"):
        (tmp_path / "gb" / g).mkdir(parents=True)
        (tmp_path / "gb" / g / "r.gb").write_text(RECORD + "//\n")
    assert {r.genus for r in remote.read_genera(spark, str(tmp_path / "gb")).collect()} == {"Aus", "Bus"}
    assert [r.genus for r in remote.read_genera(spark, str(tmp_path / "gb"), "aggregate").collect()] == ["ALL_GENERA"] * 2
    d = lambda rows, s: spark.createDataFrame(rows, s)
    groups, outputs = d([("a",), ("b",), ("c",)], "genus string"), d([("a",), ("b",)], "genus string")
    inputs = d([("b", "2024-05-01 10:00:00"), ("a", "2024-04-30 10:00:00")], "genus string, modified string").withColumn("modified", F.to_timestamp("modified"))
    today = F.lit("2024-05-01").cast("date")
    assert {r.genus for r in remote.to_process(groups, inputs, outputs, today).collect()} == {"b", "c"}
    assert remote.to_process(groups, inputs, outputs, today, True).count() == 3


def pdf(*contents):
    out = b"%PDF-1.4\n"
    for i, (c, deflate) in enumerate(contents):
        data = zlib.compress(c) if deflate else c
        out += b"%d 0 obj\n<< /Length %d %s>>\nstream\n" % (i + 1, len(data), b"/Filter /FlateDecode " if deflate else b"") + data + b"\nendstream\nendobj\n"
    return out + b"%%EOF"


def test_pdf(spark, tmp_path):
    from sporeframe.sources import pdf as P

    a = b"BT /F1 12 Tf 72 700 Td (Table 1 \\(continued\\)) Tj 0 -14 Td [(Fomiti) 20 (poria) -300 (albus)] TJ T* <4B43313336323230> Tj ET"
    b = b"BT 1 0 0 1 72 700 Tm (K\\374hn) Tj 1 0 0 1 120 700 Tm (592) Tj 1 0 0 1 72 680 Tm (next) Tj ET"
    (tmp_path / "a.pdf").write_bytes(pdf((a, True), (b, False), (b"\xff\xd8", False)))
    (tmp_path / "scan.pdf").write_bytes(b"%PDF-1.4 no text")
    got = P.read_pdf_lines(spark, str(tmp_path), lambda raw: ["from another reader"])
    rows = sorted((r.file, r.line_no, r.line) for r in got.collect())
    assert rows == [("a.pdf", 0, "Table 1 (continued)"), ("a.pdf", 1, "Fomitiporia albus"), ("a.pdf", 2, "KC136220"), ("a.pdf", 3, "Kühn 592"), ("a.pdf", 4, "next"), ("scan.pdf", 0, "from another reader")]


def test_stage_tables_are_released(spark):
    from sporeframe.operators import cluster
    from sporeframe.session import release, shared_dir

    at = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(at))
    cluster.components(spark.createDataFrame([(1, "a"), (2, "a")], "r long, v string"), "r", "v").collect()
    assert set(os.listdir(at)) - before
    release(spark)
    assert not set(os.listdir(at)) - before
