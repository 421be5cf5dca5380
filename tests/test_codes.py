import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sporeframe.functions import codes as C
from sporeframe.functions import registry as R
from sporeframe.functions import text as T
from sporeframe.functions.missing import absent

PYTHON = {
    C.code_key_dictionary: lambda s: re.sub(r"[\s:/-]", "", re.sub(r"\(.*?\)", "", s)).upper(),
    C.code_key_cleanup: lambda s: re.sub(r"[\s:\-_]", "", s.lower()),
    C.code_key_match: lambda s: re.sub(r"[\s:\-_,.;()\[\]{}]", "", s).lower(),
    C.code_key_prose: lambda s: re.sub(r"[\s:/\-.,;()\[\]{}]", "", s).upper(),
    C.code_key_type: lambda s: s.translate(str.maketrans("", "", " -/.:")).upper(),
}


def run(spark, f, values):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(f(F.col("v")).alias("o")).collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("aB1 :/-_.(){}[]é,;\t", max_size=15), min_size=20, max_size=60))
def test_normal_forms_match_python(spark, values):
    for f, py in PYTHON.items():
        assert run(spark, f, values) == [py(v) for v in values]


@pytest.mark.parametrize("i, want", [(0, ("CSIROE7088", "322.7", "CUW_1")), (1, ("csiro(m)e7088", "3/22.7", "cuw1")), (2, ("csirome7088", "3/227", "cuw1")), (3, ("CSIROME7088", "3227", "CUW_1")), (4, ("CSIRO(M)E7088", "3227", "CUW_1"))])
def test_survey_table(spark, i, want):
    assert tuple(run(spark, list(PYTHON)[i], ["CSIRO(M) E7088", "3/22.7", "CUW_1"])) == want


def test_species(spark):
    assert run(spark, C.species_incomplete, ["Wrightoporia sp.", "Wrightoporia sp. FL01", "Polyporaceae", "Polyporales", "Agaricomycetes", "Basidiomycota", None, "Wrightoporia lenta", "Phylloporia spathulata"]) == [True] * 7 + [False] * 2
    e = lambda c: C.embedded_code(c)["code"]
    assert run(spark, e, ["Wrightoporia sp. FL01", "Wrightoporia sp. DIS 229e", "Wrightoporia lenta", "Phylloporia spathulata"]) == ["FL01", "DIS 229e", None, None]
    assert run(spark, lambda c: C.embedded_code(c, compat=True)["code"], ["Phylloporia spathulata"]) == ["athulata"]
    assert run(spark, C.clean_species, ["F. aethiopica Decock et al.", "C. cf. stuckertiana (Speg.) Rajchenb.", "P. sp. I (sect. Hispidoderma)"]) == ["F. aethiopica", "C. cf. stuckertiana", "P. sp. I (sect. Hispidoderma)"]


def test_notes_titles_footnotes(spark):
    assert run(spark, C.note_codes, ["strain also named VPRI22859", "identical sequence found in strain CBS 386.66", "also known as MUCL 49406", "x"]) == [["VPRI22859"], ["CBS 386.66"], ["MUCL 49406"], []]
    assert run(spark, C.title_parts, ["", "Direct Submission", "t1 | t20", "Direct Submission | t"]) == [[], [], ["t1", "t20"], ["t"]]
    assert run(spark, C.footnote_free, ["MUCL 51555a,b", "MUCL 46017a,b (=CRGF 182)"]) == ["MUCL 51555", "MUCL 46017 (=CRGF 182)"]


def test_types(spark):
    f = lambda c: F.to_json(R.typification(c))
    got = run(spark, f, ["Holotype CORD, Urcelay 290", "Typification: not indicated"])
    assert got == ['[{"type_of_type":"Holotype","material":["CORD","Urcelay 290"]}]', '[{"type_of_type":"","material":["not indicated"]}]']


def test_folding_and_absence(spark):
    assert run(spark, T.ascii_fold, ["Türkiye", "ẞ真a", None]) == ["turkiye", "a", None]
    assert run(spark, absent, [None, "", " ", "N/A", "MISSING: not given", "x", "0"]) == [True] * 5 + [False] * 2
