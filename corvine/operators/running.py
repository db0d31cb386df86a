"""Running values over groups of any size: a two-phase scan.

A window over one group is one task. Here rows are dealt out by ranges of (keys, order), so a group of a third of all
rows covers many ranges. Each range computes its values on its own; a group that goes on from one range to the next
gets a carry, the scan of what its earlier ranges end with. Such groups have at most two rows a range in that scan.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.spool import Spool


class Value(NamedTuple):
    """`local` gives a row's value from the rows before it in its range, `end` a range's aggregate of a group, `carry`
    the scan of ends (a column of the given name) over earlier ranges, and `join` the value of a row with a carry."""

    local: Callable[[W], Column]
    end: Column
    carry: Callable[[str, W], Column]
    join: Callable[[Column, Column], Column]


def count() -> Value:
    """A row's place in its group, from 0."""
    return Value(lambda w: F.row_number().over(w) - 1, F.count("*"), lambda e, w: F.sum(e).over(w), lambda x, c: (x + F.coalesce(c, F.lit(0))).cast("long"))


def total(column: str) -> Value:
    """The sum of the column over the earlier rows of the group, null if there is none."""
    local = lambda w: F.sum(f"`{column}`").over(w.rowsBetween(W.unboundedPreceding, -1))
    return Value(local, F.sum(f"`{column}`"), lambda e, w: F.sum(e).over(w), lambda x, c: F.when(x.isNull(), c).when(c.isNull(), x).otherwise(x + c))


def latest(column: str, order: list[str]) -> Value:
    """The last non-null value of the column in the earlier rows of the group."""
    local = lambda w: F.last(f"`{column}`", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    place = F.when(F.col(f"`{column}`").isNotNull(), F.struct(*[F.col(f"`{c}`") for c in order]))
    return Value(local, F.max_by(f"`{column}`", place), lambda e, w: F.last(e, ignorenulls=True).over(w), lambda x, c: F.coalesce(x, c))


def running_values(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Value], spool: Spool, ranges: int | None = None) -> DataFrame:
    """Adds columns, all from one scan over the ranges. Rows are dealt and written once, whatever the number of values."""
    dealt = df.repartitionByRange(*[ranges] * (ranges is not None), *keys, *order)
    held = spool.keep(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    ends = held.groupBy("_range", *keys).agg(*[v.end.alias(f"_end{i}") for i, v in enumerate(values.values())])
    wide = ends.groupBy(*keys).agg(F.min("_range").alias("_a"), F.max("_range").alias("_b")).where("_a < _b").drop("_a", "_b")
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    going = ends.alias("l").join(wide.alias("r"), on, "left_semi") if keys else ends
    # at most two rows a range: the group that goes on into it, and the one that goes on behind it
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = going.select("_range", *keys, *[v.carry(f"_end{i}", earlier).alias(f"_carry{i}") for i, v in enumerate(values.values())])
    w = W.partitionBy("_range", *keys).orderBy(*order)
    own = held.withColumns({f"_own{i}": v.local(w) for i, v in enumerate(values.values())})
    on = [F.col("l._range") == F.col("r._range"), *on]
    out = own.alias("l").join(carried.alias("r"), on, "left").select(*[F.col(f"l.`{c}`") for c in own.columns], *[F.col(f"r._carry{i}") for i in range(len(values))])
    out = out.withColumns({into: v.join(F.col(f"_own{i}"), F.col(f"_carry{i}")) for i, (into, v) in enumerate(values.items())})
    return out.drop("_range", *[f"_{x}{i}" for i in range(len(values)) for x in ("own", "carry")])


def running_count(df: DataFrame, keys: list[str], order: list[str], into: str, spool: Spool, ranges: int | None = None) -> DataFrame:
    """A row's place in its group, from 0. Without keys: in the whole table. Ties of `order` are numbered anyhow."""
    return running_values(df, keys, order, {into: count()}, spool, ranges)


def running_sum(df: DataFrame, keys: list[str], order: list[str], column: str, into: str, spool: Spool) -> DataFrame:
    """The sum of the column over the earlier rows of the group, null if there is none."""
    return running_values(df, keys, order, {into: total(column)}, spool)


def running_last(df: DataFrame, keys: list[str], order: list[str], column: str, into: str, spool: Spool) -> DataFrame:
    """The last non-null value of the column in the earlier rows of the group."""
    return running_values(df, keys, order, {into: latest(column, order)}, spool)
