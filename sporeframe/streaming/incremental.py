"""Structured Streaming: records that arrive as files, and windowed counts over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def record_stream(spark: SparkSession, path: str, schema: str, per_trigger: int = 100) -> DataFrame:
    """New parquet files of a folder; the checkpoint of the query remembers which ones were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def upsert_stream(stream: DataFrame, target: str, key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest version of each record: every batch is a version folder that readers merge by ``latest``.

    A batch writes its own folder named by its number, so a repeated batch overwrites itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        last = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
        last.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str, key: str, order: str) -> DataFrame:
    """The merged state of an upsert stream."""
    t = spark.read.parquet(target)
    return t.groupBy(key).agg(F.max_by(F.struct(*[c for c in t.columns if c != "batch"]), F.struct(order, "batch")).alias("r")).select("r.*")


def windowed_counts(events: DataFrame, at: str, kind: str, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Events by tumbling window and kind; later ones than ``late`` are dropped by the watermark. Works on streams and tables."""
    x = events.withWatermark(at, late) if events.isStreaming else events
    return x.groupBy(F.window(at, size), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")
