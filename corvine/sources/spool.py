"""Intermediate tables in the folder that all executors share; cuts lineage and survives lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; only in local mode, where one machine does all, a folder of our own if none is set."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = getattr(spark.sparkContext, "_corvine_dir", None) or "file://" + tempfile.mkdtemp(prefix="corvine-")
        spark.sparkContext._corvine_dir = at
    return at.rstrip("/")


class Spool:
    """Tables written as Parquet and read back. `drop` removes those that nothing will read again; the rest goes
    when the application ends."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}", 0
        self.marked = False

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n}-{name}"

    def keep(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """The table, written and read back. Tables of large rows say how many `rows` a row group may hold: a writer
        holds one, and a reader decodes up to 4,096 rows of one at once; by itself a writer looks at sizes only after
        a hundred rows."""
        at = self.path(name)
        writer = df.write.option("compression", "zstd")
        if rows is not None:
            writer = writer.option("parquet.block.row.count.limit", rows).option("parquet.page.size.row.check.min", 1)
        writer.parquet(at)
        if not self.marked:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
            self.marked = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(folder)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._spooled_at = at
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete(self.spark, t._spooled_at)


def delete(spark: SparkSession, at: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def exists(spark: SparkSession, at: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def replace(spark: SparkSession, new: str, at: str) -> None:
    """Puts the folder `new` in the place `at`. What lay there is set aside first and deleted last, so that a failure
    leaves the one or the other; `settle` finds it."""
    fs, old, to, came = _aside(spark, at, new)
    settle(spark, at)
    if not fs.exists(came):
        raise OSError(f"{new} is not there")
    if fs.exists(to):
        fs.rename(to, old)
    if not fs.rename(came, to):
        raise OSError(f"{new} could not be moved to {at}")
    fs.delete(old, True)


def settle(spark: SparkSession, at: str) -> None:
    """Ends a replacement that was cut off: without a new folder in its place the old one comes back."""
    fs, old, to, _ = _aside(spark, at, at)
    if fs.exists(old):
        if fs.exists(to):
            fs.delete(old, True)
        else:
            fs.rename(old, to)


def _aside(spark: SparkSession, at: str, new: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path
    to = path(at.rstrip("/"))
    fs = to.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, path(to.getParent(), f".{to.getName()}.old"), to, path(new)


def beside(at: str) -> str:
    """A new hidden folder next to the place."""
    parent, _, name = at.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{uuid.uuid4().hex}" if parent else f".{name}.{uuid.uuid4().hex}"
