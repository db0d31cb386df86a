"""Shared Spark helpers: tables of a folder, spooled tables, partition counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import spool
from ..sources.spool import shared_dir

__all__ = ["Spool", "bounded_batches", "fresh", "partitions", "shared_dir", "table"]

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Lowers the session's limit on the bytes of an Arrow batch, so that long texts do not fill Python workers."""
    if int(spark.conf.get(BATCH_BYTES, "67108864b").removesuffix("b")) > most:
        spark.conf.set(BATCH_BYTES, f"{most}b")


class Spool(spool.Spool):
    """Spooled tables of an operator whose Python workers get texts in small batches."""

    def __init__(self, spark: SparkSession, what: str):
        bounded_batches(spark)
        super().__init__(spark, what)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession, rows: int, each: int) -> int:
    """As many partitions as hold about `each` rows, no fewer than the session's cores."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def fresh(name: str, *tables: DataFrame) -> str:
    """The name, with underlines in front until no column of the tables has it in any letter case."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
