"""Document operators keep what stands beyond the expected form."""

from sporeframe.operators import docrows
from sporeframe.plans import documents


def test_surplus_accessions():
    lines = ["Species", "Voucher", "ITS", "LSU", "Inonotus rheades", "TW 385", "AF311019", "AF311020", "-", "AF311021", "AF311022.1", "Inonotus cuticularis", "TW 386", "AF311023", "-"]
    got = docrows.rows_of(lines, frozenset())
    assert got[0]["genes"] == {"ITS": "AF311019", "LSU": "AF311020", "acc3": "AF311021", "acc4": "AF311022.1"}
    assert got[1]["genes"] == {"ITS": "AF311023"}


def test_context_of_every_voucher(spark, tmp_path):
    w = [f"w{i}" for i in range(1, 101)]
    w[9], w[49], w[50], w[59], w[69], w[98] = "(=VVLB", "Palacio", "105,", "TZMU-F-2838;", "Soto77.", "UVTX"
    spark.createDataFrame([(1, "\n".join(w)), (1, "\n".join(w)), (2, "nothing here"), (3, None)], "section_id long, text string").write.parquet(f"{tmp_path}/section_block.parquet")
    got = sorted((r.section_id, r.at, r.context) for r in documents.context_window(spark, str(tmp_path)).collect())
    assert got == [(1, a, " ".join(w[max(0, a - 36) : a + n + 34])) for a, n in ((10, 1), (50, 2), (60, 1), (70, 1), (99, 1))]
