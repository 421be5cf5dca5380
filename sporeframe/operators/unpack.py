"""Several values packed in one field: a quote-aware finite-state splitter.

The splitter walks a text once. Its state is the kind of the current value (plain or quoted), the
nesting depth of brackets, and the next expected list number. Text is consumed in lexemes (a
delimiter, a quote, a bracket, a list mark or a run of other characters), found by one compiled
expression per delimiter style, so that cost follows the number of lexemes.

Rules

- A quote opens only where a value begins; inside it nothing separates, and a doubled quote or a
  backslash quote stands for the quote itself. It closes before a delimiter, a list mark or the end;
  a quote that never closes is ordinary text.
- Delimiters inside brackets don't separate, unless the brackets aren't balanced.
- ``(1) .. (2) ..``, ``1) .. 2) ..``, ``[1] .. [2] ..`` and ``1. .. 2. ..`` number values if the
  text begins with mark 1 and the marks run on.
- Values are trimmed and lose their marks; empty ones vanish and take no position.

Rows come from the executors' Arrow workers, one output row per value; a null or blank text has none.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Delimiter styles: text that separates values where no quote or bracket holds it.
STYLES = {
    # a slash or several need blanks around, since "ITS/LSU" and dates hold bare ones
    "text": r"\s*(?:\|+|;+|[\n\t\r]+)\s*|\s+/+\s+",
    # identifiers hold none of these characters
    "codes": r"\s*(?:[|;,/&]+|\band\b)\s*|\s+",
}
#: Characters of which each style's delimiters need one; for the filter before the splitter.
HINTS = {"text": r'[|;\n\t\r]|\s/|(?U)^\s*(\(1\)|1\)|\[1\]|1\.\s)', "codes": r"(?U)[|;,/&]|\S\s+\S"}

QUOTES = {'"': '"', "“": "”", "«": "»"}
_OPEN, _CLOSE = "([{", ")]}"
_MARKS = (("(", ")"), ("", ")"), ("[", "]"), ("", "."))
_STARTS = [(re.compile(rf"\s*{re.escape(a)}1{re.escape(b)}\s+"), a, b) for a, b in _MARKS]
_LEX: dict[str, re.Pattern] = {}


def _lexer(style: str) -> re.Pattern:
    if style not in _LEX:
        _LEX[style] = re.compile(rf"(?P<sep>{STYLES[style]})|(?P<q>[\"“«])|(?P<open>[(\[{{])|(?P<close>[)\]}}])|(?P<ws>[^\S\n\r\t]+)|(?P<text>[^\s|;,/&\"“«()\[\]{{}}]+|.)", re.S)
    return _LEX[style]


class _Closings:
    """Where the quotes of one kind close in a text; found in one walk, so that each later question is a search.

    Of a run of quotes each pair stands for a quote; the last of an odd run closes the value if a delimiter,
    a list mark or the end follows.
    """

    def __init__(self, text: str, close: str, sep: re.Pattern, form: tuple[str, str]):
        self.text, self.close, self.sep = text, close, sep
        self.escape = re.compile(rf"\\([\\{close}])|{close}({close})")
        self.mark = re.compile(rf"\s+{re.escape(form[0])}(\d+){re.escape(form[1])}\s+")
        self.last = len(text.rstrip())
        self.plain: list[int] = []
        self.numbered: dict[str, list[int]] = {}
        for m in re.finditer(rf"\\[\\{close}]|{close}+", text):
            if m[0][0] == close and len(m[0]) % 2:
                at = m.end() - 1
                if self._free(at):
                    self.plain.append(at)
                elif n := self.mark.match(text, at + 1):
                    self.numbered.setdefault(n[1], []).append(at)

    def _free(self, at: int) -> bool:
        return at + 1 >= self.last or bool(self.sep.match(self.text, at + 1))

    def value(self, at: int, number: int) -> tuple[str, int] | None:
        """The value quoted from ``at`` and where it ends; None if the quote doesn't close before a delimiter."""
        text, i = self.text, at + 1
        while text[i : i + 1] == self.close:
            i += 1
        end, after = i - 1, self.mark.match(text, i) if number else None
        # an even run's first quote opens, so that its last one stands alone
        if (i - at) % 2 or text[at] != self.close or not (self._free(end) or after and after[1] == str(number)):
            known = [self.plain, self.numbered.get(str(number), [])] if number else [self.plain]
            found = [xs[k] for xs in known if (k := bisect_left(xs, i if text[at] == self.close else at + 1)) < len(xs)]
            if not found:
                return None
            end = min(found)
        return self.escape.sub(lambda m: m[1] or m[2], text[at + 1 : end]), end + 1


def split_values(text: str | None, style: str = "text") -> list[str]:
    """The values of one text in order."""
    if text is None or not text.strip():
        return []
    return _split(text, style, True) or _split(text, style, False) or []


def _split(text: str, style: str, nested: bool) -> list[str] | None:
    """None if brackets were counted and aren't balanced."""
    lex, sep = _lexer(style), re.compile(STYLES[style])
    values: list[str] = []
    buf: list[str] = []
    closings: dict[str, _Closings] = {}
    i, depth, number, mark, blank = 0, 0, 0, None, True
    form = ("", "")
    if style == "text":
        for start, a, b in _STARTS:
            if m := start.match(text):
                form, number, i = (a, b), 2, m.end()
                mark = re.compile(rf"\s+{re.escape(a)}2{re.escape(b)}\s+")
                break

    def end() -> None:
        nonlocal blank
        if not blank:
            values.append("".join(buf).strip())
        buf.clear()
        blank = True

    def quoted() -> tuple[str, int] | None:
        close = QUOTES[text[i]]
        if close not in closings:
            closings[close] = _Closings(text, close, sep, form)
        return closings[close].value(i, number)

    while i < len(text):
        if mark and not depth and (m := mark.match(text, i)):
            end()
            number += 1
            mark = re.compile(rf"\s+{re.escape(form[0])}{number}{re.escape(form[1])}\s+")
            i = m.end()
            continue
        m = lex.match(text, i)
        kind = m.lastgroup
        if kind == "sep":
            if depth:
                buf.append(m[0])
                blank = blank and not m[0].strip()
            else:
                end()
        elif kind == "q" and blank and (q := quoted()):
            buf.clear()
            if q[0].strip():
                values.append(q[0].strip())
            i = q[1]
            continue
        else:
            if nested and kind == "open":
                depth += 1
            elif nested and kind == "close":
                if not depth:
                    if style == "text":
                        return None
                else:
                    depth -= 1
            buf.append(m[0])
            blank = blank and kind == "ws"
        i = m.end()
    if depth:
        return None
    end()
    return values


def _kernel(style: str, least: int, out_key: str, out_name: str, out_pos: str, out_item: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            known: dict[str, list[str]] = {}
            rows: dict[str, list] = {out_name: [], out_key: [], out_pos: [], out_item: []}
            for name, key, parts in zip(b["name"], b["key"], b["parts"]):
                values: list[str] = []
                several = False
                for p in parts:
                    if p is None:
                        continue
                    got = known.get(p)
                    if got is None:
                        got = known[p] = split_values(p, style)
                    several |= len(got) > 1
                    values += got
                if (several or least < 2) and len(values) >= least:
                    n = len(values)
                    rows[out_name] += [name] * n
                    rows[out_key] += [key] * n
                    rows[out_pos] += range(1, n + 1)
                    rows[out_item] += values
            yield pd.DataFrame(rows).astype({out_pos: "int32"})

    return run


def unpack(df: DataFrame, field_name: str, key: str, field: str, style: str = "text", least: int = 2) -> DataFrame:
    """One row ``(field_name, row_key, pos, item)`` for each value of ``field`` (a string or an array of strings).

    Only fields in which some string holds several values appear (``least=1``: all). Positions run
    through the whole field from 1. Null and blank fields, null elements and empty tables give no
    rows; repeated rows count once; a row without a key gives rows with a null key. Other columns
    don't matter. A text of any length is read whole.
    """
    array = dict(df.dtypes)[field].startswith("array")
    col = df[field]
    hint = HINTS[style]
    wanted = F.exists(col, lambda x: F.coalesce(x.rlike(hint), F.lit(False))) if array else col.rlike(hint)
    few = df.filter(wanted) if least > 1 else df.filter(col.isNotNull())
    few = few.select(F.lit(field_name).alias("name"), df[key].cast("string").alias("key"), (col if array else F.array(col)).alias("parts")).distinct()
    run = _kernel(style, least, "row_key", "field_name", "pos", "item")
    return few.mapInPandas(run, "field_name string, row_key string, pos int, item string")
