"""A similarity join of texts by infix edit distance.

Two texts are alike if the shorter one turns into some part of the longer with at most `most` of its length in edits.
With k edits allowed, one of k + 1 disjoint pieces of the shorter text must occur in the longer unchanged, so pieces
meet the longer texts' substrings of the same length in a shuffle join; a piece that many texts hold is split. What
meets is checked on distinct bigrams, of which k edits destroy 2k at most, and only the rest is verified.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import infix_similarity
from ..sources.spool import Spool

#: Longer texts that meet a piece in one group.
CROWD = 512
#: Pairs that a task compares, and pairs that it lists.
COMPARED, LISTED = 500_000, 4_000_000
#: What Python's `strip` takes away.
BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _substrings(text: Column, size: Column, n: Column) -> Column:
    return F.when(n >= size, F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substring(text, i, size))).otherwise(F.array().cast("array<string>"))


def similar_pairs(texts: DataFrame, keys: list[str], text: str, spool: Spool, most: float = config.MAX_TEXT_DISTANCE, carry: tuple[str, ...] = (), where: str | None = None, crowd: int = CROWD) -> DataFrame:
    """(keys, a, b, distance) of all texts a < b with equal keys that are alike; a row of `texts` is one text of its
    keys. Of texts of one length the smaller is the pattern. Null and blank texts are like none. Columns of `carry`
    come along as x_a and x_b, and pairs for which the condition `where` on them does not hold are not looked at."""
    if not 0 <= most < 1:
        raise ValueError("a share of the shorter text's length")
    shown = F.regexp_replace(F.col(text), BLANKS, "")
    rows = texts.select(*keys, *carry, F.col(text).alias("_raw"), shown.alias("_t")).where("_t <> ''")
    rows = spool.keep(rows.withColumns({"_n": F.char_length("_t"), "_id": F.monotonically_increasing_id()}), "texts")
    limit = F.floor(F.lit(float(most)) * F.col("_n")).cast("int")
    step = F.expr("_n div (_limit + 1)").cast("int")
    short = rows.withColumn("_limit", limit).withColumn("_step", step)
    places = F.sequence(F.lit(0), F.col("_limit"))
    pieces = F.array_distinct(F.transform(places, lambda i: F.substring(F.col("_t"), i * F.col("_step") + 1, F.col("_step"))))
    short = short.select(*keys, "_raw", "_n", "_id", "_step", F.explode(pieces).alias("_piece"))
    # a piece is shorter than 1 / most characters, or the whole text if no edits are allowed
    steps = F.sequence(F.lit(1), F.lit(max(1, math.ceil(1 / most) - 1))) if most > 0 else F.sequence(F.lit(1), F.col("_n"))
    long = rows.select(*keys, "_raw", "_t", "_n", "_id", F.explode(steps).alias("_step"))
    long = long.select(*keys, "_raw", "_n", "_id", "_step", F.explode(F.array_distinct(_substrings(F.col("_t"), F.col("_step"), F.col("_n")))).alias("_piece"))
    on = [*keys, "_step", "_piece"]
    # the few crowded pieces are broadcast or not by their size, which Spark sees once they are counted
    known = long.groupBy(*on).agg(F.count("*").alias("_c")).where(F.col("_c") > crowd).select(*on, F.ceil(F.col("_c") / crowd).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    a = short.join(known, on, "left").select(*on, F.col("_raw").alias("_ra"), F.col("_n").alias("_na"), F.col("_id").alias("_ia"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    b = long.join(known, on, "left").select(*on, F.col("_raw").alias("_rb"), F.col("_n").alias("_nb"), F.col("_id").alias("_ib"), F.pmod(F.xxhash64("_id"), parts).cast("int").alias("_part"))
    shorter = (F.col("_na") < F.col("_nb")) | ((F.col("_na") == F.col("_nb")) & (F.col("_ra") < F.col("_rb")))
    met = a.join(b, [*on, "_part"]).where(shorter).select("_ia", "_ib").distinct()
    side = lambda s: rows.select(F.col("_id").alias(f"_i{s}"), *(keys if s == "a" else []), F.col("_raw").alias(f"_r{s}"), F.col("_t").alias(f"_t{s}"), F.col("_n").alias(f"_n{s}"), *[F.col(c).alias(f"{c}_{'short' if s == 'a' else 'long'}") for c in carry])
    pairs = met.join(side("a"), "_ia").join(side("b"), "_ib")
    first = F.col("_ra") < F.col("_rb")
    ends = {f"{c}_{x}": F.when(first if x == "a" else ~first, F.col(f"{c}_short")).otherwise(F.col(f"{c}_long")) for c in carry for x in "ab"}
    pairs = pairs.withColumns({"a": F.least("_ra", "_rb"), "b": F.greatest("_ra", "_rb"), **ends})
    if where:
        pairs = pairs.where(where)
    two = lambda s: F.array_distinct(_substrings(F.col(f"_t{s}"), F.lit(2), F.col(f"_n{s}")))
    pairs = pairs.where(F.size(F.array_except(two("a"), two("b"))) <= 2 * F.floor(F.lit(float(most)) * F.col("_na")))
    out = pairs.withColumn("distance", infix_similarity(F.col("_ta"), F.col("_tb"), F.lit(float(most))))
    return out.where("distance >= 0").select(*keys, "a", "b", "distance", *ends)


def _shares_piece(x: Column, y: Column, most: float) -> Column:
    """Whether texts can be alike: one of the disjoint pieces of the shorter one occurs in the longer unchanged."""
    a, b = F.regexp_replace(x, BLANKS, ""), F.regexp_replace(y, BLANKS, "")
    swap = F.char_length(a) > F.char_length(b)
    short, long = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)
    limit = F.floor(F.lit(float(most)) * F.char_length(short)).cast("int")
    step = F.floor(F.char_length(short) / (limit + 1)).cast("int")
    return F.exists(F.sequence(F.lit(0), limit), lambda i: F.contains(long, F.substring(short, i * step + 1, step)))


def all_distances(rows: DataFrame, keys: list[str], ident: str, text: str, spool: Spool, most: float = config.MAX_TEXT_DISTANCE) -> DataFrame:
    """(a, b, distance) of all pairs a < b of ids with equal keys, -1 if their texts are not alike. Of texts of one
    length that of a is the pattern. Equal texts of equal keys are one class: classes are compared, those of one
    length both ways, and pairs of members take the distance of their classes."""
    named = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate([*keys, text])]
    distinct = rows.where(" and ".join(f"`{k}` is not null" for k in keys)).select(*keys, text).distinct()
    classes = spool.keep(distinct.withColumn("_class", F.monotonically_increasing_id()), "classes")
    other = classes.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate([*keys, text])], F.col("_class").alias("_o"))
    members = rows.join(other, named).select(F.col("_o").alias("_class"), F.col(ident).alias("_id"))
    members = spool.keep(members, "members")
    spark, inside = rows.sparkSession, lambda df: df.groupBy(*keys).agg(F.count("*").alias("c")).agg(F.sum(F.col("c") * F.col("c"))).first()[0] or 0
    tasks = lambda df, each: max(spark.sparkContext.defaultParallelism, -(-inside(df) // each))
    side = lambda s: classes.select(*keys, F.col(text).alias(f"_t{s}"), F.col("_class").alias(f"_{s}"))
    x, y, size = F.col("_tx"), F.col("_ty"), lambda t: F.char_length(F.regexp_replace(t, BLANKS, ""))
    both = (F.col("_x") < F.col("_y")) & F.coalesce(size(x) == size(y), F.lit(False))
    may = F.coalesce(_shares_piece(x, y, most) | (F.col("_both") & _shares_piece(y, x, most)), F.lit(False))
    met = side("x").repartition(tasks(classes, COMPARED), "_x").join(side("y"), keys).where("_x <= _y").withColumn("_both", both)
    met = met.select("_x", "_y", "_tx", "_ty", "_both", may.alias("_may"))
    # only pairs that can be alike go to Python
    back = [F.when(F.col("_both"), t).otherwise("") for t in (y, x)]
    near = met.where("_may").select("_x", "_y", "_both", infix_similarity(x, y, F.lit(float(most))).alias("_there"), infix_similarity(*back, F.lit(float(most))).alias("_back"))
    near = near.select("_x", "_y", "_there", F.when(F.col("_both"), F.col("_back")).otherwise(F.col("_there")).alias("_back"))
    pairs = near.unionByName(met.where("not _may").select("_x", "_y", F.lit(-1.0).alias("_there"), F.lit(-1.0).alias("_back")))
    a, b = members.select(F.col("_class").alias("_x"), F.col("_id").alias("_a")), members.select(F.col("_class").alias("_y"), F.col("_id").alias("_b"))
    out = pairs.join(a, "_x").repartition(tasks(rows, LISTED), "_x", "_a").join(b, "_y").where("_a < _b or (_x <> _y and _a > _b)")
    return out.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), F.when(F.col("_a") < F.col("_b"), F.col("_there")).otherwise(F.col("_back")).alias("distance"))
