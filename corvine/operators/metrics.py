"""Evaluation metrics and course history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .. import config
from ..functions import scalars as S
from ..sources.spool import Spool
from .running import running_last
from .tables import spread


def histogram_sum(ratings: DataFrame, keys: list[str], rating: str = "rating") -> DataFrame:
    """Element-wise sums of count arrays per key, cut to the key's shortest array: rows (keys, pos, weight)."""
    each = ratings.where(F.col(rating).isNotNull()).select(*keys, F.posexplode_outer(rating).alias("pos", "_w"))
    sums = each.groupBy(*keys, "pos").agg(F.sum("_w").cast("bigint").alias("weight"), F.count("*").alias("_n"))
    # an array counts once, at its first place or as an empty one; places that all arrays have are kept
    arrays = F.sum(F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("_n"))).over(W.partitionBy(*keys))
    return sums.withColumn("_all", arrays).where("pos is not null and _n = _all").drop("_n", "_all")


def weighted_average(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Mean option number (from 1) by weight; null without weight."""
    total = F.sum("weight")
    return sums.groupBy(*keys).agg((F.sum(F.col("weight") * (F.col("pos") + 1)) / F.nullif(total, F.lit(0))).alias("average"))


def tagged_averages(ratings: DataFrame, questions: DataFrame, tag: str) -> DataFrame:
    """(course_id, average) over the ratings (course_id, question_code, rating) whose question has the tag."""
    tags = questions.where(F.col("tag") == tag).select("question_code")
    some = ratings.join(F.broadcast(tags), "question_code", "left_semi")
    return weighted_average(histogram_sum(some, ["course_id"]), ["course_id"])


def category_violations(ratings: DataFrame, questions: DataFrame, tag: str, n: int = 5) -> DataFrame:
    """Courses whose summed histogram has not `n` options, unless all its questions are the one with six."""
    tags = questions.where(F.col("tag") == tag).select("question_code")
    some = ratings.join(F.broadcast(tags), "question_code", "left_semi")
    g = some.groupBy("course_id").agg(F.min(F.size("rating")).alias("options"), F.bool_and(F.col("question_code") == config.SIX_CATEGORY_QUESTION).alias("six"))
    return g.where((F.col("options") != n) & ~F.col("six")).select("course_id", "options")


def history(courses: DataFrame, group: str, season: str, ident: str, enrolled: str, spool: Spool | None = None) -> DataFrame:
    """Adds last_offered_course_id (the smallest id of the nearest earlier season of the group) and
    last_enrollment_course_id (the latest earlier course with enrolment, by season and id, same season included).
    With a spool, groups may have any size: the latest one is a scan over ranges instead of a window over a group."""
    firsts = courses.groupBy(group, season).agg(F.min(ident).alias("_first"))
    before = F.lag("_first").over(W.partitionBy(group).orderBy(season))
    firsts = firsts.select(group, season, before.alias("last_offered_course_id"))
    if spool is not None:
        marked = courses.withColumn("_taken", F.when(F.col(enrolled).isNotNull(), F.col(ident)))
        scanned = running_last(marked, [group], [season, ident], "_taken", "last_enrollment_course_id", spool)
        return scanned.drop("_taken").join(firsts, [group, season], "left")
    frame = W.partitionBy(group).orderBy(season, ident).rowsBetween(W.unboundedPreceding, -1)
    last = F.last(F.when(F.col(enrolled).isNotNull(), F.col(ident)), ignorenulls=True).over(frame)
    return courses.withColumn("last_enrollment_course_id", last).join(firsts, [group, season], "left")


def with_last_enrollment(courses: DataFrame, ident: str, season: str, enrolled: str, professors: DataFrame) -> DataFrame:
    """Adds season, enrolment and same-professors of the last enrolled course. A course without professors has the
    empty set, its predecessor without them has none: then, as without a predecessor, the answer is false."""
    sets = professors.groupBy(F.col("course_id").alias("_c")).agg(F.array_sort(F.collect_set("professor_id")).alias("_profs"))
    old = courses.select(F.col(ident).alias("_id"), F.col(season).alias("last_enrollment_season_code"), F.col(enrolled).alias("last_enrollment"))
    theirs = sets.select(F.col("_c").alias("_c2"), F.col("_profs").alias("_theirs"))
    out = courses.join(old, F.col("last_enrollment_course_id") == F.col("_id"), "left").join(sets, F.col(ident) == F.col("_c"), "left")
    out = out.join(theirs, F.col("last_enrollment_course_id") == F.col("_c2"), "left")
    same = F.coalesce(F.col("_profs") == F.col("_theirs"), F.lit(False))
    return out.withColumn("last_enrollment_same_professors", same).drop("_id", "_c", "_c2", "_profs", "_theirs")


def group_average(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """(group, name, name_n): unweighted mean and number of the non-null values."""
    return rows.groupBy(group).agg(F.avg(value).alias(name), F.count(value).alias(f"{name}_n"))


def professor_ratings(bridge: DataFrame, statistics: DataFrame) -> DataFrame:
    """(professor_id, average_rating, average_rating_n, courses_taught) over the rows of the bridge."""
    rated = bridge.join(statistics.select("course_id", "avg_rating"), "course_id", "left")
    return rated.groupBy("professor_id").agg(F.avg("avg_rating").alias("average_rating"), F.count("avg_rating").alias("average_rating_n"), F.count("*").alias("courses_taught"))


#: Rows of a task that groups a bridge by course, where their number is known.
GROUPED = 500_000


def course_professor_rating(bridge: DataFrame, professors: DataFrame, n: int | None = None) -> DataFrame:
    """With the number `n` of the bridge's rows, a task groups a bounded number of them."""
    rows = bridge.join(professors.select("professor_id", "average_rating"), "professor_id", "left")
    if n is not None:
        rows = spread(rows, GROUPED, "course_id", rows=n)
    return rows.groupBy("course_id").agg(F.avg("average_rating").alias("average_professor_rating"))


def gut_rating(rating: Column, workload: Column) -> Column:
    return rating - workload


def compute_courses(courses: DataFrame, same: DataFrame, professors: DataFrame, bridge: DataFrame, statistics: DataFrame) -> DataFrame:
    """All computed columns of courses, from same(course_id, same_course_id, same_course_and_profs_id)."""
    known = statistics.select("course_id", "enrolled", "avg_rating", "avg_workload")
    out = courses.join(same, "course_id", "left").join(known, "course_id", "left")
    out = with_last_enrollment(history(out, "same_course_id", "season_code", "course_id", "enrolled"), "course_id", "season_code", "enrolled", bridge)
    for group, suffix in (("same_course_id", ""), ("same_course_and_profs_id", "_same_professors")):
        g = out.groupBy(group).agg(*[a for v, n in (("avg_rating", "average_rating"), ("avg_workload", "average_workload")) for a in (F.avg(v).alias(n + suffix), F.count(v).alias(n + suffix + "_n"))])
        out = out.join(g, group, "left")
    out = out.withColumn("average_gut_rating", gut_rating(F.col("average_rating"), F.col("average_workload")))
    return out.join(course_professor_rating(bridge, professors), "course_id", "left").drop("enrolled", "avg_rating", "avg_workload")


def compute_questions(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Questions with their tag, and those that several tags fit."""
    tags = S.question_tags(F.col("question_text"), F.col("question_code"), F.col("is_narrative"))
    out = questions.withColumn("_tags", tags)
    return out.withColumn("tag", F.get("_tags", F.lit(0))).drop("_tags"), out.where(F.size("_tags") > 1).select("question_code", "question_text", F.array_join("_tags", ", ").alias("tags"))


def compute_narratives(narratives: DataFrame) -> DataFrame:
    """Sentiment columns are constant zeros."""
    return narratives.withColumns({f"comment_{k}": F.lit(0.0) for k in ("neg", "neu", "pos", "compound")})
