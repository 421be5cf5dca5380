import re
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st

from sporeframe.operators.unpack import STYLES, _Closings, split_values, unpack

CASES = [
    (None, []),
    ("", []),
    ("  \n ", []),
    ("one value", ["one value"]),
    ("a | b", ["a", "b"]),
    ("a||b;;c", ["a", "b", "c"]),
    ("a // b / c", ["a", "b", "c"]),
    ("ITS/LSU study", ["ITS/LSU study"]),
    ("leg. X, 3/22/07; y", ["leg. X, 3/22/07", "y"]),
    ('"a | b"', ["a | b"]),
    ('"a | b" | c', ["a | b", "c"]),
    ('"say ""x"" now" / b', ['say "x" now', "b"]),
    ('has "mixed" reads; b', ['has "mixed" reads', "b"]),
    ('"open; b', ['"open', "b"]),
    ("(1) a (2) b (3) c", ["a", "b", "c"]),
    ("[1] a; x [2] b", ["a", "x", "b"]),
    ("1) a 2) b", ["a", "b"]),
    ("(Denehart; Lomax) Obrusco; b", ["(Denehart; Lomax) Obrusco", "b"]),
    ("a (b; c", ["a (b", "c"]),
    ("a;;;", ["a"]),
    ('"" ; b', ["b"]),
    (r'"a \" b"; c', ['a " b', "c"]),
]


@pytest.mark.parametrize("text, want", CASES)
def test_split(text, want):
    assert split_values(text) == want


@pytest.mark.parametrize("text, want", [("A1; B2", ["A1", "B2"]), ("A1 and B2 and C3", ["A1", "B2", "C3"]), ('"A1","B2"', ["A1", "B2"]), ("A1 B2/C3", ["A1", "B2", "C3"]), (" A1 ", ["A1"]), ("A1\nB2", ["A1", "B2"])])
def test_codes(text, want):
    assert split_values(text, "codes") == want


@given(st.lists(st.text("ab;|/\"() \n,.", min_size=1, max_size=12).map(str.strip).filter(bool), min_size=1, max_size=6), st.sampled_from([" | ", "; ", "\n", " // "]))
def test_quoted_round_trip(values, sep):
    text = sep.join('"' + v.replace('"', '""') + '"' for v in values)
    assert split_values(text) == values


@given(st.text('"“”«;| \\\nab1)2(', max_size=40))
def test_quotes_against_a_plain_walk(text):
    # the value that a quote opens, found by looking at each character in turn
    sep, form = re.compile(STYLES["text"]), ("", ")")
    mark = re.compile(r"\s+2\)\s+")
    for at, c in enumerate(text):
        if c in '"“«' and (c != '"' or text[at - 1 : at] not in ('"', "\\")) and text[max(0, at - 1) : at] != "\\":
            close, out, i, want = {'"': '"', "“": "”", "«": "»"}[c], [], at + 1, None
            while i < len(text):
                if text[i] == "\\" and text[i + 1 : i + 2] in (close, "\\"):
                    out.append(text[i + 1])
                    i += 2
                elif text[i] == close and text[i + 1 : i + 2] == close:
                    out.append(close)
                    i += 2
                elif text[i] == close and (not text[i + 1 :].strip() or sep.match(text, i + 1) or mark.match(text, i + 1)):
                    want = "".join(out), i + 1
                    break
                else:
                    out.append(text[i])
                    i += 1
            assert _Closings(text, close, sep, form).value(at, 2) == want


@pytest.mark.parametrize("part", ['""x;', '"a', '" ', '"a;', '“a; ', '"" ', '1) "x'])
def test_many_quotes_in_linear_time(part):
    t = time.process_time()
    split_values(part * 100_000)
    assert time.process_time() - t < 6


def test_operator(spark):
    rows = [(1, "a; b", "x"), (1, "a; b", "x"), (2, None, "x"), (3, " ", "x"), (4, "one", "x"), (None, "c | c", "x"), (5, "y; " * 5000, "x")]
    got = unpack(spark.createDataFrame(rows, "k long, f string, pos string"), "t.f", "k", "f").collect()
    by = {}
    for r in got:
        by.setdefault(r.row_key, []).append((r.pos, r.item))
    assert sorted(by["1"]) == [(1, "a"), (2, "b")]
    assert sorted(by[None]) == [(1, "c"), (2, "c")]
    assert len(by["5"]) == 5000 and set(by) == {"1", None, "5"}


def test_arrays_and_empty(spark):
    rows = [("d", ["A1", None, "B2; C3", " "]), ("e", ["A1", "B2"]), ("f", None), ("g", [])]
    got = unpack(spark.createDataFrame(rows, "doi string, a array<string>"), "x", "doi", "a", "codes").collect()
    assert sorted((r.row_key, r.pos, r.item) for r in got) == [("d", 1, "A1"), ("d", 2, "B2"), ("d", 3, "C3")]
    assert unpack(spark.createDataFrame([], "k long, f string"), "x", "k", "f").count() == 0
