"""Rows of specimen tables from the text lines of a document, where every cell is a line of its own.

One pure function per document, run by Arrow workers over documents: classify the lines, find headers, cut
the stream into rows at accession blocks, align the cells of a row with the header's columns, fill forward.

Neighbouring lines that are one value are joined first: the words of a country's name, an acronym and its
number, a genus and its epithet. Decisions: as many cells as columns is a perfect row; one more joins the two
neighbours that fit best into one column; any other number assigns each cell to the column whose kind it is.
A species that a row lacks is that of the row above, if it stands at most ``BACK`` lines higher. A filled
species lowers the confidence to medium, a row without a header to low. Cells that no column takes are kept
as ``unplaced``, accessions beyond the header's genes as ``accN``: nothing before an accession is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCESSION = re.compile(r"^[A-Z]{1,2}\d{5,8}(?:\.\d+)?[*†‡§a-z]?$")
DASH = re.compile(r"^[-–—]+$")
GENES = ("ITS", "LSU", "NLSU", "28S", "SSU", "18S", "TEF1", "TEF", "EF1", "RPB1", "RPB2", "BTUB", "ACT")
#: Header words and the field that their column holds.
META = (("species", "species"), ("taxon", "species"), ("name", "species"), ("voucher", "voucher"), ("specimen", "voucher"), ("collection", "voucher"), ("strain", "voucher"), ("isolate", "voucher"), ("country", "country"), ("origin", "country"), ("locality", "country"), ("location", "country"), ("host", "host"), ("substrate", "host"), ("reference", "reference"))
SPECIES = re.compile(r"^[A-Z](?:[a-z]+|[a-z]{0,4}\.) (?:(?:cf|aff)\. )?(?:[a-z-]{3,}|sp\.)( .*)?$")
PAGE = re.compile(r"^\W*(?:p|pg|page)?\.?\s*\d{1,4}\W*$|\(continued\)|continued\.$|et al\.$", re.I)
#: Lines that a species is filled down at most.
BACK = 300
GENUS = re.compile(r"^[A-Z][a-z]{3,}$")
EPITHET = re.compile(r"^(?:(?:cf|aff)\. )?[a-z][a-z-]{2,}$|^sp\.(?: \S+)?$")
ACRONYM = re.compile(r"^[A-Z]{2,7}[:-]?$")
NUMBER = re.compile(r"^[A-Za-z]{0,2}\d[\w./-]*$")
FIELDS = ("species", "voucher", "country", "host")
COLUMNS = ("doc_id", "row_no", *FIELDS, "genes", "confidence", "method", "forward_filled", "unplaced")
SCHEMA = "doc_id string, row_no int, species string, voucher string, country string, host string, genes map<string,string>, confidence string, method string, forward_filled boolean, unplaced array<string>"


def tokens(line: str) -> list[str]:
    """A line of several accessions as its parts, any other line whole."""
    parts = line.split()
    return parts if len(parts) > 1 and all(ACCESSION.match(p) or DASH.match(p) for p in parts) else [line]


def joined_lines(cells: list[str], countries: frozenset[str]) -> list[str]:
    """Neighbouring cells that are one value joined, from the left; a country may have up to four parts."""
    out: list[str] = []
    i = 0
    while i < len(cells):
        a, n = cells[i], 1
        if not ACCESSION.match(a):
            if a.lower() not in countries:
                n = next((k for k in (4, 3, 2) if i + k <= len(cells) and " ".join(cells[i : i + k]).lower() in countries), 1)
            if n == 1 and i + 1 < len(cells):
                b = cells[i + 1]
                code = ACRONYM.match(a) and NUMBER.match(b) and a not in GENES and not ACCESSION.match(b)
                if (code or GENUS.match(a) and EPITHET.match(b)) and a.lower() not in countries and not any(header_fields(a)):
                    n = 2
        out.append(" ".join(cells[i : i + n]))
        i += n
    return out


def header_fields(line: str) -> tuple[list[str], list[str]]:
    """Fields and genes that a line names as column heads; empty if it has other words."""
    fields, genes = [], []
    for w in re.split(r"\s{2,}|\t|\s*\|\s*|\s+", line.strip()):
        x = w.strip("().:,").lower()
        if x.upper() in GENES:
            genes.append(x.upper())
        elif f := next((f for k, f in META if x.startswith(k)), None):
            fields.append("specimen" if x.startswith("specimen") else f)
        elif x not in ("no", "no.", "code", "number", "genbank", "accession", "accessions", ""):
            return [], []
    return fields, genes


def settled(fields: list[str]) -> list[str]:
    """Each field once: a specimen column is the voucher, or beside a voucher column the species; a second head of a field is none."""
    other = [x for x in fields if x != "specimen"]
    specimen = "voucher" if "voucher" not in other else "species" if "species" not in other else None
    named = [specimen if x == "specimen" else x for x in fields]
    return [x for i, x in enumerate(named) if x and x not in named[:i]]


def headers(lines: list[str]) -> list[tuple[int, int, list[str], list[str]]]:
    """(begin, end, fields, genes) of header regions: neighbouring head lines with a gene and a field or two genes."""
    out, i = [], 0
    while i < len(lines):
        fields, genes, j = [], [], i
        while j < len(lines):
            f, g = header_fields(lines[j])
            if not f and not g:
                break
            fields += f
            genes += [x for x in g if x not in genes]
            j += 1
        fields = settled(fields)
        if genes and (fields or len(genes) > 1):
            out.append((i, j, fields, genes))
        i = max(j, i + 1)
    return out


def _kind(cell: str, countries: frozenset[str]) -> str:
    x = cell.strip()
    if x.lower() in countries:
        return "country"
    if SPECIES.match(x):
        return "species"
    if re.search(r"\d", x):
        return "voucher"
    return "other"


def align(cells: list[str], fields: list[str], countries: frozenset[str]) -> tuple[dict[str, str], str, list[str]]:
    """Cells to fields, how (perfect, joined, typed), and the cells that no field takes."""
    if len(cells) == len(fields):
        return dict(zip(fields, cells)), "perfect", []
    if len(cells) == len(fields) + 1:
        best = max(range(len(cells) - 1), key=lambda i: sum(_kind(c, countries) == f for c, f in zip([*cells[:i], f"{cells[i]} {cells[i + 1]}", *cells[i + 2 :]], fields)))
        joined = [*cells[:best], f"{cells[best]} {cells[best + 1]}", *cells[best + 2 :]]
        return dict(zip(fields, joined)), "joined", []
    # the cells nearest to the accessions belong to the row, so they choose first
    got: dict[str, str] = {}
    rest: list[str] = []
    for c in reversed(cells):
        k = _kind(c, countries)
        if k in fields and k not in got:
            got[k] = c
        else:
            rest.append(c)
    left = []
    for c in rest:
        if (f := next((f for f in reversed(fields) if f not in got and f not in ("species", "country")), None)) is not None and _kind(c, countries) in ("other", f):
            got[f] = c
        else:
            left.append(c)
    return got, "typed", left[::-1]


def rows_of(lines: Iterable[str], countries: frozenset[str]) -> list[dict]:
    """The table rows of one document in order."""
    cells = joined_lines([t for x in lines if x and x.strip() and not PAGE.match(x.strip()) for t in tokens(x.strip())], countries)
    heads = headers(cells)
    starts = {b: (e, f, g) for b, e, f, g in heads}
    out: list[dict] = []
    fields: list[str] = []
    genes: list[str] = []
    pre: list[str] = []
    above, since = None, 0
    i = 0
    while i < len(cells):
        if i in starts:
            e, fields, genes = starts[i]
            pre, above, i = [], None, e
            continue
        if not (ACCESSION.match(cells[i]) or (DASH.match(cells[i]) and (pre or not fields))):
            pre.append(cells[i])
            i += 1
            continue
        j = i
        while j < len(cells) and j not in starts and (ACCESSION.match(cells[j]) or DASH.match(cells[j])):
            j += 1
        block, i = cells[i:j], j
        want = fields or ["species", "voucher", "country"]
        got, how, rest = align(pre, want, countries) if pre else ({}, "typed", [])
        filled = False
        if got.get("species") and not DASH.match(got["species"]):
            above, since = got["species"], i
        elif "species" in want and above and i - since <= BACK:
            got["species"], filled = above, True
        names = genes if genes else [f"acc{k + 1}" for k in range(len(block))]
        if len(block) != len(names):
            block = [a for a in block if not DASH.match(a)]
            names = [*names, *(f"acc{k + 1}" for k in range(len(names), len(block)))]
        acc = {n: a for n, a in zip(names, block) if not DASH.match(a)}
        if acc:
            level = "low" if not fields else "medium" if filled or how == "typed" else "high"
            out.append({**{f: got.get(f) for f in FIELDS}, "genes": acc, "confidence": level, "method": how, "forward_filled": filled, "unplaced": rest})
        pre = []
    return out


def extract_rows(lines: DataFrame, doc: str, order: str, line: str, countries: Iterable[str]) -> DataFrame:
    """``SCHEMA`` rows of all documents given as lines; ``countries`` is a fixed list of lower-case names.

    A document is one unit of work; documents are spread over tasks. Each is parsed once, however many
    accessions are looked up in the result.
    """
    known = frozenset(countries)
    docs = lines.groupBy(F.col(doc).cast("string").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct(order, line))).alias("ls")).select("doc_id", F.transform("ls", lambda x: x[line]).alias("ls"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [{"doc_id": d, "row_no": k, **r} for d, ls in zip(b["doc_id"], b["ls"]) for k, r in enumerate(rows_of(ls, known))]
            yield pd.DataFrame(out, columns=list(COLUMNS)).astype({"row_no": "int32"})

    return docs.mapInPandas(run, SCHEMA)
