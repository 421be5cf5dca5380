"""Sessions, table access and durable lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sporeframe")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only a session without that setting that runs in one process (tests, the local bench) gets a
    temporary folder of this machine; on a cluster the missing setting is an error.
    """
    global _own_dir
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    master = conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_dir is None or not os.path.isdir(_own_dir):
        _own_dir = tempfile.mkdtemp(prefix="sporeframe-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return _own_dir


_roots: set[str] = set()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system, if it exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Delete the stage tables of all results so far; to be called when those have been written or read."""
    while _roots:
        delete_path(spark, _roots.pop())


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _roots else None
    if spark is not None:
        try:
            release(spark)
        except Exception:  # the session may be gone already
            return


class Stages:
    """Intermediate tables written to the shared folder, so that lineage ends there.

    A written table survives the loss of any executor, is computed once and, unlike a row-wise
    checkpoint, is compressed and columnar. ``drop`` removes tables that nothing reads any more,
    ``release`` those of whole results, as the end of the program does.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        _roots.add(self.root)

    def cut(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the written table."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            if path := getattr(df, "_stage_path", None):
                delete_path(self.spark, path)
