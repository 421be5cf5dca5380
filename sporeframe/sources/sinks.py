"""Writers."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Mapping
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Stages, delete_path

#: Names and parts of the workbook format.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACK = "http://schemas.openxmlformats.org/package/2006"
_BOOK = {
    "[Content_Types].xml": f'<?xml version="1.0"?><Types xmlns="{_PACK}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": f'<?xml version="1.0"?><Relationships xmlns="{_PACK}/relationships"><Relationship Id="r1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": f'<?xml version="1.0"?><workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="data" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": f'<?xml version="1.0"?><Relationships xmlns="{_PACK}/relationships"><Relationship Id="r1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
_LEGAL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def write_matrix(df: DataFrame, path: str, form: str = "parquet") -> None:
    """The specimen matrix as parquet, or as tab-separated text with a header."""
    w = df.write.mode("overwrite")
    w.parquet(path) if form == "parquet" else w.option("header", True).option("sep", "\t").csv(path)


def write_dictionary(df: DataFrame, path: str, key: str = "cluster_key", value: str = "aliases") -> None:
    """A code dictionary as JSON lines ``{"key": [aliases]}``, sorted by key."""
    df.select(key, F.to_json(F.create_map(F.col(key), F.col(value))).alias("value")).orderBy(key).select("value").write.mode("overwrite").text(path)


def write_audit(df: DataFrame, path: str) -> None:
    """An audit table with a header even if it is empty."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path) if df.isEmpty() else df.write.mode("overwrite").option("header", True).csv(path)


def upsert_partitioned(new: DataFrame, path: str, key: str, by: str) -> None:
    """Replace or add whole records in a parquet table partitioned by ``by``; untouched partitions stay as they are."""
    spark = new.sparkSession
    try:
        old = spark.read.parquet(path)
    except Exception as e:  # the table doesn't exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        new.write.partitionBy(by).parquet(path)
        return
    touched = old.join(new.select(by).distinct(), by, "left_semi").join(new.select(key), key, "left_anti")
    moved = old.join(new.select(key, F.col(by).alias("_to")), key).filter(F.col(by) != F.col("_to")).select(by).distinct()
    stay = old.join(moved, by, "left_semi").join(new.select(key), key, "left_anti").join(new.select(by).distinct(), by, "left_anti")
    stages = Stages(spark, "upsert")
    rows = stages.cut(new.unionByName(touched).unionByName(stay))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    stages.drop(rows)


def write_xlsx(df: DataFrame, path: str, most: int = 1_000_000) -> None:
    """A table as one sheet of a workbook; streamed row by row, for results that a sheet can hold.

    ``most`` is the sheet's own limit; a longer table is refused, not cut.
    """
    n = df.count()
    if n > most:
        raise ValueError(f"{n} rows don't fit into a sheet of {most}")
    cell = lambda v: "<c/>" if v is None else f"<c><v>{v}</v></c>" if isinstance(v, (int, float)) and not isinstance(v, bool) else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_LEGAL.sub("", str(v)))}</t></is></c>'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in _BOOK.items():
            z.writestr(name, text)
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            f.write(("<row>" + "".join(map(cell, df.columns)) + "</row>").encode())
            for r in df.toLocalIterator():
                f.write(("<row>" + "".join(map(cell, r)) + "</row>").encode())
            f.write(b"</sheetData></worksheet>")


def write_articles(df: DataFrame, path: str, known: DataFrame | None = None) -> None:
    """The article store: parquet keyed by the hash of the doi, spread over its first two digits; ``known`` are appended to, the new row winning."""
    new = df.filter("doi is not null").withColumn("doi_hash", F.md5("doi")).withColumn("part", F.substring("doi_hash", 1, 2))
    upsert_partitioned(new if known is None else append_articles(known, new), path, "doi_hash", "part")


def append_articles(store: DataFrame, new: DataFrame) -> DataFrame:
    """The store with articles that it doesn't hold yet, by doi."""
    return store.unionByName(new.join(store.select("doi"), "doi", "left_anti"), allowMissingColumns=True)


def write_gaps(df: DataFrame, path: str, genus: str) -> None:
    """A gap snapshot: the rows with any gap as csv with their flags, and the counts as one text line each.

    ``df`` has the flags of ``gap_flags``.
    """
    flags = ["voucher_gap", "country_gap", "species_gap", "embedded_code"]
    name = re.sub(r"[^A-Za-z0-9._-]+", "_", genus or "Unknown").strip("_") or "Unknown"
    rows = df.filter(" or ".join(flags))
    rows.withColumnsRenamed({f: f"_{f}" for f in flags}).write.mode("overwrite").option("header", True).csv(f"{path}/{name}_gaps")
    counts = df.agg(F.count("*").alias("total_records"), *[F.count_if(f).alias(f) for f in flags], F.count_if(F.expr(" or ".join(flags))).alias("rows_with_any_gap"))
    lines = F.array(F.concat(F.lit("genus: "), F.lit(genus)), *[F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in counts.columns])
    counts.select(F.explode(lines).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/{name}_gaps_summary")


def write_review(changes: DataFrame, path: str) -> bool:
    """Changed, removed and added cells of ``frames.review`` as csv, with a summary; stale files go if there is no difference. True if there is."""
    spark = changes.sparkSession
    n = {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}
    for kind in ("changed", "removed", "added"):
        if n.get(kind):
            changes.filter(F.col("change") == kind).write.mode("overwrite").option("header", True).csv(f"{path}/{kind}")
        else:
            delete_path(spark, f"{path}/{kind}")
    text = [f"{k}: {n.get(k, 0)}" for k in ("changed", "removed", "added")] + [f"has_differences: {bool(n)}"]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/summary")
    return bool(n)


def write_labelled(df: DataFrame, path: str) -> None:
    """A labelled table, tab-separated with a header."""
    df.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def append_log(entries: DataFrame, path: str, sep: str = ";") -> None:
    """Log entries appended as delimited text with a header in each file."""
    entries.write.mode("append").option("header", True).option("sep", sep).csv(path)


def write_set(tables: Mapping[str, DataFrame], path: str) -> None:
    """Several tables of one experiment, each a csv folder of its name."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def with_optional_keys(df: DataFrame, fields: str, most: int = 1000) -> DataFrame:
    """A map column as columns: the sorted union of its keys. More than ``most`` keys are refused."""
    keys = [r[0] for r in df.select(F.explode(F.map_keys(fields))).distinct().limit(most + 1).collect()]
    if len(keys) > most:
        raise ValueError(f"more than {most} different keys")
    return df.select(*[c for c in df.columns if c != fields], *[F.col(fields)[k].alias(k) for k in sorted(keys)])
