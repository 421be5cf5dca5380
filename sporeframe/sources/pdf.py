"""Text lines of PDF files with the standard library alone: plain and deflated content streams, simple fonts.

Strings are decoded as Latin text; a new line begins where the text position moves down. Fonts with an own
encoding need a full extractor: files of which no text comes out are left to the next one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ligatures and what they stand for.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
_STREAM = re.compile(rb"<<(?P<dict>(?:[^<>]|<<[^<>]*>>|<[^<>]*>)*)>>\s*stream\r?\n")
_PIECE = re.compile(rb"\((?P<s>(?:\\.|[^\\()])*)\)|<(?P<h>[0-9A-Fa-f\s]*)>|(?P<n>-?\d*\.?\d+)|(?P<op>T[djJDm*L]|['\"]|BT|ET)|(?P<o>[\[\]])", re.S)
_ESCAPE = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}
#: A gap between pieces of a line, in thousandths of the font size, from which it is a blank.
BLANK = 180


def _string(m: re.Match) -> str:
    if m["h"] is not None:
        x = re.sub(rb"\s", b"", m["h"])
        raw = bytes.fromhex((x + b"0" * (len(x) % 2)).decode())
    else:
        raw = re.sub(rb"\\([0-7]{1,3}|.)", lambda e: bytes([int(e[1], 8) & 255]) if e[1][:1].isdigit() else _ESCAPE.get(e[1], e[1]), m["s"], flags=re.S)
    return raw.decode("cp1252", "replace")


def _page(content: bytes) -> list[str]:
    lines: list[str] = []
    line, numbers, text, height = "", [], "", None

    def flush() -> None:
        nonlocal line
        if line.strip():
            lines.append(re.sub(r"\s+", " ", line).strip())
        line = ""

    for m in _PIECE.finditer(content):
        if m["s"] is not None or m["h"] is not None:
            text += _string(m)
        elif m["n"] is not None:
            numbers.append(float(m["n"]))
            # inside an array a large step back is a blank
            if text and numbers[-1] < -BLANK:
                text += " "
        elif m["op"] is not None:
            op = m["op"]
            if op in (b"Td", b"TD") and len(numbers) >= 2 and numbers[-1] or op in (b"T*", b"'", b'"', b"BT"):
                flush()
            elif op == b"Tm" and len(numbers) >= 6:
                if numbers[-1] != height:
                    flush()
                height = numbers[-1]
                line += " " if line else ""
            elif op in (b"Td", b"TD") and line:
                line += " "
            if op in (b"Tj", b"TJ", b"'", b'"'):
                line += text
            text, numbers = "", []
    flush()
    return lines


def lines_of(raw: bytes) -> list[str]:
    """The text lines of a PDF in the order of its streams, with ligatures spelled out; none for what can't be read."""
    out: list[str] = []
    for m in _STREAM.finditer(raw):
        end = raw.find(b"endstream", m.end())
        data = raw[m.end() : end if end >= 0 else len(raw)]
        if b"FlateDecode" in m["dict"]:
            try:
                data = zlib.decompressobj().decompress(data)
            except zlib.error:
                continue
        elif b"/Filter" in m["dict"]:
            continue
        if b"BT" in data and (b"Tj" in data or b"TJ" in data):
            out += _page(data)
    fold = str.maketrans(LIGATURES)
    return [x.translate(fold) for x in out]


def read_pdf_lines(spark: SparkSession, path: str, fallback: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """``(file, line_no, line)`` of all PDFs of a path; files without lines are given to ``fallback``, if there is one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, raw in zip(b["path"], b["content"]):
                got = lines_of(raw) or (fallback(raw) if fallback else [])
                rows += [(name.rpartition("/")[2], i, x) for i, x in enumerate(got)]
            yield pd.DataFrame(rows, columns=["file", "line_no", "line"]).astype({"line_no": "int32"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select(F.col("path"), "content")
    return files.mapInPandas(run, "file string, line_no int, line string")
