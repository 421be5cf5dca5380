"""Article queries on small tables that hold packed lists."""

from sporeframe.plans import articles

ROW = "row_id long, species string, voucher string, country string, gb_its string, gb_lsu string, gb_ssu string, gb_tef1 string, gb_rpb1 string, gb_rpb2 string, gb_beta_tubulin string, source_doi string"


def put(spark, sf, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{sf}/{name}.parquet")


def lists(spark, sf):
    put(spark, sf, "article", [("d2", None, [" ZQ00000001 ", "ZQ00000002.1; ZQ00000003"]), ("d1", None, ['"ZQ00000004","ZQ00000003"', "ZQ00000005 and ZQ00000006", None]), ("d0", None, None)], "doi string, title string, gb_accessions array<string>")
    put(spark, sf, "seq_record", [(i, f"ZQ0000000{i}.2", None) for i in range(1, 9)], "seq_no long, gbn string, title string")


def test_packed_lists(spark, tmp_path):
    sf = str(tmp_path)
    lists(spark, sf)
    put(spark, sf, "gb_table_row", [], ROW)
    want = {1: "d2", 2: "d2", 3: "d1", 4: "d1", 5: "d1", 6: "d1"}
    assert {r.accession: r.doi for r in articles.article_of_accession(spark, sf).collect()} == {f"ZQ0000000{i}": d for i, d in want.items()}
    assert {r.seq_no: (r.value, r.method) for r in articles.doi_cascade(spark, sf).collect()} == {i: (d, "list") for i, d in want.items()}


def test_all_gene_columns(spark, tmp_path):
    sf = str(tmp_path)
    lists(spark, sf)
    rows = [
        (1, "A b", "V 1", "Chile", "zq 00000007.1", "ZQ00000008", "-", "", None, None, "ZQ00000010", "d5"),
        (1, "A b", "V 1", "Chile", "zq 00000007.1", "ZQ00000008", "-", "", None, None, "ZQ00000010", "d5"),
        (2, "A c", "V 2", "Peru", None, " ZQ00000007", "-", "ZQ00000011", "ZQ00000012", "ZQ00000013", None, "d4"),
        (3, "A d", "V 3", "Peru", None, "-", "", None, None, None, None, "d3"),
        (4, "A e", "V 4", "Peru", None, None, None, None, None, None, "ZQ00000008", None),
    ]
    put(spark, sf, "gb_table_row", rows, ROW)
    got = {r.accession: (r.source_doi, r.voucher) for r in articles.article_lookup(spark, sf).collect()}
    assert got == {f"ZQ000000{i:02}": ("d5", "V 1") if i in (8, 10) else ("d4", "V 2") for i in (7, 8, 10, 11, 12, 13)}
    assert {r.source_doi: (r.accessions, r.rows) for r in articles.article_rollup(spark, sf).collect()} == {"d5": (3, 1), "d4": (4, 1), "d3": (0, 1), None: (1, 1)}
    table = {r.seq_no: r.value for r in articles.doi_cascade(spark, sf).collect() if r.method == "table"}
    assert table == {7: "d4", 8: "d5"}


def test_chunks_contained_by_any_number(spark, tmp_path):
    sf = str(tmp_path)
    codes = ["#692 Yulvani", "VVLB 2381 / Mbekuno 291", "Brastow 12", "TZMU-F-2018", "2018", "Brastow", None, "Brastow 55"]
    texts = ["Yulvani 692 (=VVLB 3184)", "Mbekuno 291 (=VVLB 2381)", "BRASTOW 3125", "Phaxton 116:TZMU-F-2018", "Mbekuno 291", None, "Brastow 5 5"]
    put(spark, sf, "supp_record", [(100 + i, v) for i, v in enumerate(codes)] * 2, "row_id long, voucher string")
    put(spark, sf, "doc_row", [(i, w) for i, w in enumerate(texts)] * 2, "row_id long, voucher string")
    got = sorted((r.supp, r.doc) for r in articles.chunks_contained(spark, sf).collect())
    assert got == [(100, 0), (101, 1), (102, 2), (103, 3)]
