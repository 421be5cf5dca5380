"""What remote services answer, as tables: searches, batched fetches, downloads, inputs of a job.

Nothing here opens a connection. A service is a function from a batch of ids to text that the caller names; it
runs in the executors, one task a batch. Answers that were stored before are joined as lookup tables.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.codes import genus_of
from . import flatfile

#: Ids in a batch, and the services' own limits on ids, names and hits.
BATCH, IDS, NAMES, HITS = 200, 100_000, 50_000, 100


class _Batch(InputPartition):
    def __init__(self, number: int, ids: list[str]):
        self.number, self.ids = number, ids


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.ids = [x for x in options["ids"].split(",") if x]
        self.size = int(options.get("batch", BATCH))
        self.service = options["service"]

    def partitions(self) -> list[_Batch]:
        return [_Batch(i // self.size, self.ids[i : i + self.size]) for i in range(0, len(self.ids), self.size)]

    def read(self, partition: _Batch) -> Iterator[tuple]:
        module, _, name = self.service.partition(":")
        try:
            text = getattr(importlib.import_module(module), name)(partition.ids)
        except Exception as e:  # any failure of a service is an answer
            yield (partition.number, None, f"{type(e).__name__}: {e}")
            return
        for record in text.split("\n//"):
            if record.strip():
                yield (partition.number, record.lstrip("\n"), None)


class RecordSource(DataSource):
    """``spark.read.format("records")`` with ``service`` ("module:function"), ``ids`` (comma-separated) and ``batch``: rows (batch, record, error)."""

    @classmethod
    def name(cls) -> str:
        return "records"

    def schema(self) -> str:
        return "batch int, record string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def fetch(spark: SparkSession, ids: Sequence[str], service: str, batch: int = BATCH) -> DataFrame:
    """Parsed records of the batches before the first that fails, as a sequential fetch would stop there."""
    spark.dataSource.register(RecordSource)
    raw = spark.read.format("records").option("ids", ",".join(ids)).option("service", service).option("batch", batch).load()
    # one row, joined on a constant
    failed = raw.filter("error is not null").agg(F.min("batch").alias("stop")).withColumn("one", F.lit(1))
    good = raw.withColumn("one", F.lit(1)).join(F.broadcast(failed), "one").filter("record is not null and (stop is null or batch < stop)")
    return good.select(F.col("record").alias("value")).mapInPandas(flatfile._parse, flatfile.SCHEMA)


def search_genus(index: DataFrame, genus: str, since: Column | None = None, cap: int = IDS) -> DataFrame:
    """``(gbn, found)``: ids of a genus with 1 to 5000 bases, no whole genomes, released since a date; ``found`` is their number before the cap.

    ``index`` has species, gbn, bp, description and deposited_at. The cap is the service's; ids are taken in order.
    """
    bp = F.col("bp")
    x = index.filter((F.lower(genus_of(F.col("species"))) == genus.lower()) & (bp >= 1) & (bp <= 5000) & ~F.coalesce(F.lower("description").contains("whole genome"), F.lit(False)))
    x = (x.filter(F.col("deposited_at") >= since) if since is not None else x).filter("gbn is not null").select("gbn").distinct()
    found = x.agg(F.count("*").alias("found")).withColumn("one", F.lit(1))
    return x.orderBy("gbn").limit(cap).withColumn("one", F.lit(1)).join(F.broadcast(found), "one").drop("one")


def best_hits(hits: DataFrame, query: str, cap: int = HITS, coverage: float = 85, identity: float = 90, top: int = 3) -> DataFrame:
    """``(query, place, genus, coverage, identity)``: the genera of the best hits above the thresholds, each once.

    ``hits`` (query, rank, species, coverage, identity) are a similarity search's; the first ``cap`` ranks count.
    """
    x = hits.filter((F.col("rank") <= cap) & (F.col("coverage") >= coverage) & (F.col("identity") >= identity)).withColumn("genus", F.substring_index(F.trim("species"), " ", 1))
    best = x.groupBy(query, "genus").agg(F.max(F.struct("identity", "coverage", (-F.col("rank")).alias("r"))).alias("b"))
    w = W.partitionBy(query).orderBy(F.desc("b.identity"), F.desc("b.coverage"), F.desc("b.r"), "genus")
    return best.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= top).select(query, "place", "genus", "b.coverage", "b.identity")


def downloads(wanted: DataFrame, answers: DataFrame, order: Sequence[str], key: str = "doi") -> DataFrame:
    """``(key, source, url)``: the first source in order that answered with status 200 and a pdf.

    ``answers`` (key, source, url, status, content_type), one row for each try.
    """
    good = answers.filter((F.col("status") == 200) & F.lower("content_type").contains("pdf")).withColumn("place", F.array_position(F.lit(list(order)), F.col("source"))).filter("place > 0")
    return wanted.select(key).distinct().join(good, key).groupBy(key).agg(F.min_by(F.struct("source", "url"), F.struct("place", "url")).alias("m")).select(key, "m.*")


def saved_names(files: DataFrame, folder: str, name: str, order: str) -> DataFrame:
    """The files with ``saved``: the name, or with ``_dup`` and ``_dup2``, ``_dup3``.. before the extension where the folder has it already."""
    n = F.row_number().over(W.partitionBy(folder, F.lower(name)).orderBy(order)) - 1
    stem, ext = F.regexp_replace(name, r"\.[^.]*$", ""), F.regexp_extract(name, r"(\.[^.]*)$", 1)
    mark = F.when(n == 0, "").when(n == 1, "_dup").otherwise(F.concat(F.lit("_dup"), n.cast("string")))
    return files.withColumn("saved", F.concat(stem, mark, ext))


def read_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, kind, id, text)`` of the files ``input_*.fas`` (sequences) and ``input_*.txt`` (names) of a folder; others don't count."""
    raw = spark.read.option("pathGlobFilter", "input_*.{fas,txt}").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    fasta = F.filter(F.split(F.concat(F.lit("\n"), F.col("value")), "\n>"), lambda x: F.trim(x) != "")
    seqs = raw.filter(F.col("file").endswith(".fas")).select("file", F.explode(fasta).alias("v"))
    head = F.regexp_extract("v", r"^(\S+)", 1)
    seqs = seqs.select("file", F.lit("fasta").alias("kind"), head.alias("id"), F.upper(F.regexp_replace(F.regexp_replace("v", r"^[^\n]*", ""), r"\s", "")).alias("text"))
    names = raw.filter(F.col("file").endswith(".txt")).select("file", F.explode(F.split("value", r"\r?\n")).alias("v")).select("file", F.lit("txt").alias("kind"), F.trim("v").alias("id"), F.lit(None).cast("string").alias("text")).filter("id <> ''")
    return seqs.union(names)


def read_genera(spark: SparkSession, folder: str, mode: str = "genus", name: str = "ALL_GENERA") -> DataFrame:
    """Flat-file records of a folder of genus folders with their ``genus``.

    ``genus`` keeps each folder's name; ``aggregate`` and ``complex`` read all folders as one group called ``name``.
    """
    raw = spark.read.option("lineSep", "\n//").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{gb,gbk}").text(folder).filter(F.col("value").rlike(r"\S"))
    group = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1) if mode == "genus" else F.lit(name)
    raw = raw.select("value", group.alias("genus"))

    def parse(batches):
        for b in batches:
            for got in flatfile._parse(iter([b])):
                yield got.assign(genus=b["genus"].to_numpy())

    return raw.mapInPandas(parse, flatfile.SCHEMA + ", genus string")


def to_process(groups: DataFrame, inputs: DataFrame, outputs: DataFrame, today: Column, force: bool = False) -> DataFrame:
    """Groups that are to be processed: all if forced, those without output, and those with an input modified today.

    ``groups`` (genus), ``inputs`` (genus, modified), ``outputs`` (genus).
    """
    if force:
        return groups.select("genus").distinct()
    fresh = inputs.filter(F.to_date("modified") == F.to_date(today)).select("genus")
    return groups.select("genus").distinct().join(outputs.select("genus"), "genus", "left_anti").union(groups.join(fresh, "genus", "left_semi").select("genus")).distinct()
