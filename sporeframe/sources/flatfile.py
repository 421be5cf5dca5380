"""Sequence flat files and FASTA: one record per row through the reader's line separator, parsed by Arrow workers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Qualifiers of the source feature that become columns.
QUALIFIERS = ("strain", "specimen_voucher", "isolate", "environmental_sample", "culture_collection", "bio_material", "geo_loc_name", "host", "type_material", "note")
COLUMNS = ("species", "gbn", "description", "bp", "title", "seq_text", *QUALIFIERS)
SCHEMA = ", ".join(f"{c} {'int' if c == 'bp' else 'string'}" for c in COLUMNS) + ", corrupt string"


def _block(record: str, word: str) -> str:
    """A header field with its continuation lines as one text."""
    m = re.search(rf"^{word}[ ]+(.*(?:\n[ ]{{12}}.*)*)", record, re.M)
    return re.sub(r"\s+", " ", m[1]).strip() if m else ""


def parse_record(record: str) -> dict:
    """One flat-file record; ``corrupt`` holds the record if it has no LOCUS line or no length."""
    out: dict = dict.fromkeys((*COLUMNS, "corrupt"))
    locus = re.search(r"^LOCUS\s+(\S+)\s+(\d+) bp", record, re.M)
    if not locus:
        out["corrupt"] = record
        return out
    version = _block(record, "VERSION").split(" ")[0]
    organism = re.search(r"^\s+ORGANISM\s+(.*)", record, re.M)
    title = re.search(r"^\s+TITLE\s+(.*(?:\n[ ]{12}.*)*)", record, re.M)
    out |= {"gbn": version or locus[1], "bp": int(locus[2]), "description": _block(record, "DEFINITION").removesuffix("."), "species": organism[1].strip() if organism else "", "title": re.sub(r"\s+", " ", title[1]).strip() if title else ""}
    feats = record.partition("\nFEATURES")[2].partition("\nORIGIN")[0]
    source = re.split(r"\n {5}(?=\S)", feats)
    source = next((x for x in source if x.lstrip().startswith("source")), "")
    for name, quoted, bare in re.findall(r'/(\w+)(?:="((?:[^"]|"")*)"|=(\S+))?', source):
        if name in QUALIFIERS and out[name] is None:
            out[name] = re.sub(r"\s*\n\s+", " ", quoted).replace('""', '"') or bare or name
    origin = record.partition("\nORIGIN")[2]
    out["seq_text"] = "".join(re.findall(r"[A-Za-z]+", origin.partition("\n")[2])).upper()
    return out


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = pd.DataFrame([parse_record(x) for x in b["value"]], columns=[*COLUMNS, "corrupt"])
        got["bp"] = got["bp"].astype("Int32")
        yield got


def read_flatfiles(spark: SparkSession, path: str) -> DataFrame:
    """Records of all files of a path or pattern; a malformed one is a row with only ``corrupt`` set."""
    raw = spark.read.option("lineSep", "\n//").text(path).filter(F.col("value").rlike(r"\S"))
    return raw.mapInPandas(_parse, SCHEMA)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(id, description, seq_text)``; of repeated ids in a file the last counts."""
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("ord"))
    head = F.regexp_replace(F.substring_index("value", "\n", 1), "^>", "")
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "")
    rows = raw.filter("trim(value) <> ''").select("file", "ord", F.substring_index(head, " ", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S+\s*", "")).alias("description"), F.upper(seq).alias("seq_text"))
    return rows.groupBy("file", "id").agg(F.max_by(F.struct("description", "seq_text"), "ord").alias("r")).select("id", "r.*")


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """One name per non-blank line."""
    return spark.read.text(path).select(F.trim("value").alias("name")).filter("name <> ''")
