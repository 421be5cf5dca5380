"""Tables inside documents: pipe tables, delimited files in unknown encodings, zipped office files."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELLS = "file string, tab int, r int, c int, value string, error string"
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def pipe_tables(lines: DataFrame, doc: str, line_no: str, line: str) -> DataFrame:
    """Cells ``(doc, tab, r, c, value)`` of markdown tables; separator rows vanish, the header is row 0.

    Tables are runs of lines that begin with a bar. Every row has as many cells as the header: short ones are
    padded with empty cells, of long ones the further cells follow in the last column after a bar.
    """
    w = W.partitionBy(doc).orderBy(line_no)
    x = lines.select(doc, line_no, F.trim(line).alias("l")).withColumn("i", F.row_number().over(w)).filter("l like '|%'")
    x = x.withColumn("g", F.col("i") - F.row_number().over(w)).filter(~F.col("l").rlike(r"^\|[\s:|-]+\|?$"))
    x = x.withColumn("tab", F.dense_rank().over(W.partitionBy(doc).orderBy("g")) - 1).withColumn("r", F.row_number().over(W.partitionBy(doc, "g").orderBy(line_no)) - 1)
    cells = F.transform(F.split(F.regexp_replace("l", r"^\||\|$", ""), r"\|"), lambda v: F.trim(v))
    x = x.select(doc, "tab", "r", cells.alias("cells")).withColumn("n", F.max(F.when(F.col("r") == 0, F.size("cells"))).over(W.partitionBy(doc, "tab")))
    last = F.array_join(F.slice("cells", F.col("n"), F.greatest(F.size("cells") - F.col("n") + 1, F.lit(1))), " | ")
    padded = F.concat("cells", F.array_repeat(F.lit(""), F.col("n") - F.size("cells")))
    fit = F.when(F.size("cells") > F.col("n"), F.concat(F.slice("cells", F.lit(1), F.col("n") - 1), F.array(last))).otherwise(padded)
    return x.select(doc, "tab", "r", F.posexplode(fit).alias("c", "value"))


def classify_tables(cells: DataFrame, doc: str) -> DataFrame:
    """``(doc, tab, accessions, is_accession_table, is_transposed)`` by header words and the first ten rows."""
    acc = F.col("value").rlike(r"^[A-Z]{1,2}\d{5,8}(\.\d+)?$")
    key = F.lower("value").rlike(r"\b(its|lsu|ssu|tef1?|rpb[12]|voucher|genbank|accession|specimen)\b")
    g = cells.groupBy(doc, "tab").agg(F.count_if(acc & (F.col("r") <= 10)).alias("accessions"), F.count_if(key & (F.col("r") == 0)).alias("h"), F.count_if(key & (F.col("c") == 0)).alias("k"))
    return g.select(doc, "tab", "accessions", ((F.col("h") > 0) | (F.col("accessions") >= 3)).alias("is_accession_table"), ((F.col("k") >= 2) & (F.col("h") < 2)).alias("is_transposed"))


def _decode(raw: bytes) -> str:
    for enc in ("utf-8-sig", "cp1252", "latin-1"):
        try:
            return raw.decode(enc)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


def _csv(raw: bytes) -> list[list[list[str]]]:
    import csv

    text = _decode(raw)
    first = text.partition("\n")[0]
    return [list(csv.reader(io.StringIO(text), delimiter=max("\t;,", key=first.count)))]


def _xlsx(raw: bytes) -> list[list[list[str]]]:
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_SHEET}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
        out = []
        for n in sorted(x for x in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", x)):
            rows = []
            for row in ElementTree.fromstring(z.read(n)).iter(f"{_SHEET}row"):
                cells: dict[int, str] = {}
                for k, c in enumerate(row.iter(f"{_SHEET}c")):
                    ref = re.match(r"[A-Z]+", c.get("r") or "")
                    at = 0
                    for ch in ref[0] if ref else "":
                        at = at * 26 + ord(ch) - 64
                    v = c.find(f"{_SHEET}v")
                    text = "".join(t.text or "" for t in c.iter(f"{_SHEET}t")) if v is None else v.text or ""
                    cells[at - 1 if ref else k] = shared[int(text)] if c.get("t") == "s" and text else text
                rows.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
            out.append(rows)
        return out


def _docx(raw: bytes) -> list[list[list[str]]]:
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    return [[["".join(t.text or "" for t in c.iter(f"{_WORD}t")) for c in row.iter(f"{_WORD}tc")] for row in tab.iter(f"{_WORD}tr")] for tab in root.iter(f"{_WORD}tbl")]


_READERS = {"csv": _csv, "tsv": _csv, "txt": _csv, "xlsx": _xlsx, "docx": _docx}


def tables_of(name: str, raw: bytes) -> Iterator[tuple[str, list[list[str]] | str]]:
    """(file name, rows) of each table of a file; archives are opened, unknown files have none. A broken file gives its error instead of rows."""
    kind = name.rpartition(".")[2].lower()
    try:
        if kind == "zip":
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                for n in z.namelist():
                    if not n.endswith("/") and n.rpartition(".")[2].lower() in _READERS:
                        yield from tables_of(f"{name}/{n}", z.read(n))
        elif kind in _READERS:
            for t in _READERS[kind](raw):
                yield name, t
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, IndexError) as e:
        yield name, f"{type(e).__name__}: {e}"


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for path, raw in zip(b["path"], b["content"]):
            out: list[tuple] = []
            for k, (f, rows) in enumerate(tables_of(path.rpartition("/")[2], raw)):
                if isinstance(rows, str):
                    out.append((f, k, None, None, None, rows))
                else:
                    out += [(f, k, r, c, v.strip(), None) for r, row in enumerate(rows) for c, v in enumerate(row)]
            yield pd.DataFrame(out, columns=["file", "tab", "r", "c", "value", "error"]).astype({"tab": "Int32", "r": "Int32", "c": "Int32"})


def read_supplements(spark: SparkSession, path: str) -> DataFrame:
    """Cells ``(file, tab, r, c, value, error)`` of all tables of csv, tsv, xlsx, docx and zip files; a broken file is one row with its error."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_cells, CELLS)
