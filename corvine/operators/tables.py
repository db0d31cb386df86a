"""Order-sensitive building blocks: every one names the column that orders the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.spool import Spool
from .running import running_count


def keep_first(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Like `keep` by one ordinal; a partial aggregation instead of a sort."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), ordinal).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), ordinal).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def last_non_null(df: DataFrame, keys: list[str], ordinal: str, columns: list[str] | None = None) -> DataFrame:
    """For each key the last non-null value of every column; a row may mix columns of several rows."""
    columns = columns or [c for c in df.columns if c not in keys and c != ordinal]
    pick = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*pick)


def spread(df: DataFrame, each: int, *keys: str, rows: int | None = None) -> DataFrame:
    """The rows by the keys, or anyhow, in as many partitions as hold about `each` of them; Spark counts bytes, and few
    bytes can be many rows. What groups by the keys or more needs no further shuffle. Small tables stay as they are.
    The rows are counted if their number is not given."""
    parts = -(-(df.count() if rows is None else rows) // each)
    return df.repartition(parts, *keys) if parts > 1 else df


def single_or_null(value: str, keys: list[str]) -> Column:
    """The group's value if every row has it, else null; a null beside a value gives null."""
    w = W.partitionBy(*keys)
    c = F.col(value)
    return F.when((F.min(c).over(w) == F.max(c).over(w)) & (F.count(c).over(w) == F.count(F.lit(1)).over(w)), F.min(c).over(w))


def numbered(keys: list[str], *order: str | Column) -> Column:
    """Position in the group from 0."""
    return F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1


def row_ids(df: DataFrame, ordinal: str, into: str = "id", buckets: int | None = None) -> DataFrame:
    """Consecutive ids from 0 in the order of `ordinal`, without gathering all rows in one task: in `buckets` ranges,
    else in as many as a shuffle has. A table without rows stays so."""
    return running_count(df, [], [ordinal], into, Spool(df.sparkSession, "ids"), buckets)


def ordered(df: DataFrame, order: list[str], into: str, spool: Spool) -> DataFrame:
    """Adds integers that rise with `order`, though not densely: the rows are sorted in ranges, not in one task. The
    result is spooled, so that every reader sees the same numbers."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(into, F.monotonically_increasing_id())
    return spool.keep(out, "ordered")


def stable_ids(df: DataFrame, key: str, ordinal: str, cache: DataFrame, into: str = "id", fallback: str | None = None) -> DataFrame:
    """Ids that persist between runs: known keys keep theirs, a row's `fallback` key may lend its own, and new keys
    follow the largest known id in the order in which they first appear. `cache` has columns key, id."""
    known = cache.select(F.col("key").alias("_k"), F.col("id").alias("_id"))
    out = df.join(known, df[key] == F.col("_k"), "left").drop("_k")
    if fallback:
        other = cache.select(F.col("key").alias("_k2"), F.col("id").alias("_id2"))
        out = out.join(other, out[fallback] == F.col("_k2"), "left").withColumn("_id", F.coalesce("_id", "_id2")).drop("_k2", "_id2")
    new = out.where(F.col("_id").isNull()).groupBy(F.col(key).alias("_new")).agg(F.min(ordinal).alias("_first"))
    top = cache.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    new = row_ids(new, "_first", "_rank").crossJoin(F.broadcast(top)).select("_new", (F.col("_top") + 1 + F.col("_rank")).alias("_fresh"))
    return out.join(new, out[key] == F.col("_new"), "left").withColumn(into, F.coalesce("_id", "_fresh").cast("bigint")).drop("_id", "_new", "_fresh")


def merged_cache(cache: DataFrame, found: DataFrame) -> DataFrame:
    """The cache with new (key, id) rows; `cache_conflicts` must be empty first."""
    return cache.unionByName(found.select("key", "id").distinct().join(cache.select("key"), "key", "left_anti"))


def cache_conflicts(cache: DataFrame, found: DataFrame) -> DataFrame:
    """Keys whose id differs between the two."""
    return cache.alias("a").join(found.distinct().alias("b"), "key").where("a.id <> b.id").select("key", F.col("a.id").alias("old_id"), F.col("b.id").alias("new_id"))


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns that exist, in the given order."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def combine_first(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer union by key in which the new side's non-null values win."""
    names = [c for c in new.columns if c not in keys] + [c for c in old.columns if c not in keys and c not in new.columns]
    a, b = new.alias("a"), old.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    pick = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys]
    for c in names:
        sides = [F.col(f"{s}.`{c}`") for s, d in (("a", new), ("b", old)) if c in d.columns]
        pick.append(F.coalesce(*sides).alias(c))
    return a.join(b, on, "full_outer").select(*pick)


def positional_join(new: DataFrame, old: DataFrame, keys: list[str], new_order: str, old_order: str, value: str) -> DataFrame:
    """The k-th new row of a key gets the k-th smallest old value of that key."""
    a = new.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(new_order)))
    b = old.where(F.col(value).isNotNull()).withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(old_order))).select(*keys, "_k", F.col(value))
    return a.join(b, [*keys, "_k"], "left").drop("_k")


def exploded_pairs(df: DataFrame, left: str, right: str) -> tuple[DataFrame, DataFrame]:
    """Two list columns exploded side by side, and the rows whose lengths differ (null counts as empty)."""
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    bad = df.where(n(left) != n(right))
    rest = [c for c in df.columns if c not in (left, right)]
    return df.where(n(left) == n(right)).select(*rest, F.inline(F.arrays_zip(left, right))), bad
