"""Order-dependent merges of sets, many at a time.

An ordered list of merges, each of which is refused if its two sets share a season, gives the same sets when merges
that cannot see each other run together. In a round every set belongs to the first group of merges (a code) that still
has one to decide for it. A group goes through its merges in order: one that touches a set of another group waits, and
so do all later ones of the sets it touches; a merge of sets that share a season is refused for good, as sets only
grow. The first group of all is never held up, so rounds end. Their number is the length of the longest chain of
groups that wait for each other, not the size of a component, and a task holds one group; when few merges are left,
one task decides them all.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.spool import Spool

#: Merges that one task decides; of larger groups it takes those that begin with one text at a time.
MOST = 50_000

OPS = "g string, s struct<phase:int,a:string>, r struct<b:string,e:int,o:long>, x long, y long"


def decide(rows: pd.DataFrame) -> pd.DataFrame:
    """(label, merged) of the sets that merge in this round. Rows: x, y, whether each is the group's own, their
    seasons, in the order of g, s and r."""
    up: dict[int, int] = {}
    seasons: dict[int, set] = {}
    waits: dict[int, bool] = {}

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    order = sorted(range(len(rows)), key=lambda i: (rows["g"].iat[i], *_place(rows["s"].iat[i]), *_place(rows["r"].iat[i])))
    columns = {c: rows[c].tolist() for c in ("x", "y", "own_x", "own_y", "seasons_x", "seasons_y")}
    for i in order:
        ends = []
        for side in "xy":
            label = columns[side][i]
            if label not in up:
                up[label], seasons[label], waits[label] = label, set(columns[f"seasons_{side}"][i]), not columns[f"own_{side}"][i]
            ends.append(find(label))
        a, b = min(ends), max(ends)
        if a == b or seasons[a] & seasons[b]:
            continue
        if waits[a] or waits[b]:
            waits[a] = waits[b] = True
        else:
            up[b] = a
            seasons[a] |= seasons.pop(b)
    moved = [(i, find(i)) for i in up if up[i] != i]
    return pd.DataFrame(moved, columns=["label", "merged"], dtype="int64")


def _place(row) -> tuple:
    return tuple(row.values()) if isinstance(row, dict) else tuple(row)


def merge_apart(sets: DataFrame, ops: DataFrame, spool: Spool, most: int = MOST) -> DataFrame:
    """(label, merged) for every set of `sets(label, seasons)` after the merges `ops` (columns `OPS`) of the sets
    labelled x and y, in the order of g, s and r; a merged set has its smallest label."""
    now = spool.keep(sets.select("label", "seasons"), "sets")
    left = spool.keep(ops.select("g", "s", "r", "x", "y"), "ops")
    whole = spool.keep(sets.select("label", F.col("label").alias("merged")), "merged")
    while True:
        # those of one set, and of sets that share a season, are decided
        side = lambda c: now.select(F.col("label").alias(c), F.col("seasons").alias(f"seasons_{c}"))
        open_ = left.where("x <> y").join(side("x"), "x").join(side("y"), "y").where(~F.arrays_overlap("seasons_x", "seasons_y"))
        open_ = spool.keep(open_, "open")
        n = open_.count()
        if not n:
            break
        if n <= most:  # what is left fits one task, which decides all of it
            last = open_.withColumns({"own_x": F.lit(True), "own_y": F.lit(True)}).groupBy(F.lit(0).alias("key")).applyInPandas(decide, "label long, merged long")
            return whole.join(last.select(F.col("label").alias("merged"), F.col("merged").alias("_to")), "merged", "left").select("label", F.coalesce("_to", "merged").alias("merged"))
        large = open_.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > most).select("g", F.lit(True).alias("large"))
        keyed = open_.join(large, "g", "left").withColumn("key", F.struct("g", F.when(F.col("large"), F.col("s")).alias("s"))).drop("large")
        first = keyed.select(F.explode(F.array("x", "y")).alias("label"), "key").groupBy("label").agg(F.min("key").alias("first"))
        first = spool.keep(first, "first")
        for c in "xy":
            keyed = keyed.join(first.select(F.col("label").alias(c), F.col("first").alias(f"first_{c}")), c)
            keyed = keyed.withColumn(f"own_{c}", F.col("key").eqNullSafe(F.col(f"first_{c}")))
        mine = keyed.where("own_x or own_y").select("key", "g", "s", "r", "x", "y", "own_x", "own_y", "seasons_x", "seasons_y")
        moved = spool.keep(mine.groupBy("key").applyInPandas(decide, "label long, merged long"), "moved")
        name = lambda df, c: df.join(moved.select(F.col("label").alias(c), F.col("merged").alias("_to")), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
        grown = name(now, "label").groupBy("label").agg(F.array_distinct(F.flatten(F.collect_list("seasons"))).alias("seasons"))
        old = (now, left, whole, open_, first, moved)
        now, left, whole = spool.keep(grown, "sets"), spool.keep(name(name(open_.select("g", "s", "r", "x", "y"), "x"), "y"), "ops"), spool.keep(name(whole, "merged"), "merged")
        spool.drop(*old)
    spool.drop(now, left, open_)
    return whole
