"""Landing files as a stream: each micro-batch is merged into a versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables
from ..sources.io import Warehouse


def read_landing(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def windowed_counts(stream: DataFrame, time: str, keys: list[str], width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))


def merge_into(warehouse: Warehouse, name: str, keys: list[str], stream: DataFrame, checkpoint: str):
    """Starts a query that merges each micro-batch into table `name`: new rows replace those of equal keys, of
    several in one batch the greatest. A batch that is tried again makes no second version."""

    def merge(batch: DataFrame, number: int) -> None:
        old = warehouse.read().get(name)
        rest = [c for c in batch.columns if c not in keys]
        fresh = batch.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, "_r.*") if rest else batch.select(*keys).distinct()
        rows = fresh if old is None else tables.combine_first(fresh, old, keys)
        warehouse.write({name: rows}, batch=f"{checkpoint}#{number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
