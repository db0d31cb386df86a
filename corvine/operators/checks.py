"""Integrity assertions: each is a DataFrame of violations, empty if all is well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


class InvariantError(Exception):
    pass


def season_mismatches(listings: DataFrame, courses: DataFrame) -> DataFrame:
    """Listings whose season differs from their course's."""
    a, b = listings.alias("a"), courses.alias("b")
    return a.join(b, F.col("a.course_id") == F.col("b.course_id")).where(F.col("a.season_code") != F.col("b.season_code")).select("a.listing_id", "a.course_id")


def courses_without_listing(courses: DataFrame, listings: DataFrame) -> DataFrame:
    return courses.join(listings, "course_id", "left_anti").select("course_id")


def option_violations(questions: DataFrame) -> DataFrame:
    """Options must be missing exactly for narrative questions."""
    return questions.where(F.col("options").isNull() != F.col("is_narrative")).select("question_code")


def diverging_texts(questions: DataFrame) -> DataFrame:
    """Codes that keep several texts after normalisation, from (question_code, texts)."""
    return questions.where(F.size("texts") > 1)


def mixed_questions(questions: DataFrame) -> DataFrame:
    """Codes used both for narratives and for ratings."""
    return questions.groupBy("question_code").agg(F.count_distinct("is_narrative").alias("n")).where("n <> 1").select("question_code")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-null references without a parent row."""
    refs = child.where(F.col(column).isNotNull()).select(F.col(column).alias("_r"))
    return refs.join(parent.select(F.col(key).alias("_p")), F.col("_r") == F.col("_p"), "left_anti").withColumnRenamed("_r", column)


def without_places(courses: DataFrame) -> DataFrame:
    """One row if no meeting of any course has a place: the places were not delivered."""
    n = F.coalesce(F.sum(F.size(F.filter("meetings", lambda m: F.coalesce(m["location"], F.lit("")) != ""))), F.lit(0))
    return courses.agg(n.alias("located")).where("located = 0")


def foreign_key_orphans(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {f"{c}.{col}": orphans(tables[c], col, tables[p], key) for c, col, p, key in config.FOREIGN_KEYS if c in tables and p in tables}


def assertions(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "listing season equals course season": season_mismatches(tables["listings"], tables["courses"]),
        "every course has a listing": courses_without_listing(tables["courses"], tables["listings"]),
        "options are missing exactly for narratives": option_violations(tables["evaluation_questions"]),
        **{f"{k} refers to a row": v for k, v in foreign_key_orphans(tables).items()},
        **{f"{t} has unique keys": duplicate_keys(tables[t], k) for t, k in config.PRIMARY_KEYS.items() if t in tables},
    }


def enforce(checks: dict[str, DataFrame], sample: int = 5) -> None:
    """Raises with a few of the violations of each failed check."""
    bad = {name: rows for name, df in checks.items() if (rows := df.limit(sample).collect())}
    if bad:
        raise InvariantError("; ".join(f"{k}: {v}" for k, v in bad.items()))
