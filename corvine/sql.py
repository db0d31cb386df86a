"""The catalog's operators as SQL functions: `register(spark)` makes them known to a session.

Scalar rules are SQL functions over built-in ones, which the optimiser inlines. Text distances run on Arrow batches.
Order-sensitive operators are table functions over a partitioned and ordered table argument.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from .functions.text import fold_accents, text_distance

#: name(arguments) returns type, and its body.
SCALARS = {
    "season_term(season string) returns string": "case right(season, 1) when '1' then 'spring' when '2' then 'summer' when '3' then 'fall' end",
    "season_year(season string) returns int": "cast(substring(season, 1, 4) as int)",
    "season_of(day date) returns string": "concat(cast(year(day) as string), case when month(day) <= 5 then '01' when month(day) <= 7 then '02' else '03' end)",
    "is_summer(season string) returns boolean": "endswith(season, '2')",
    "is_discussion(section string, code string) returns boolean": "not rlike(section, '^[0-9]+$') or endswith(code, 'D')",
    "course_id(season string, crns array<bigint>) returns bigint": "(cast(season as bigint) - 200000) * 100000 + array_min(crns)",
    "listing_id(season string, crn bigint) returns bigint": "(cast(season as bigint) - 200000) * 100000 + crn",
}


@F.pandas_udf(T.DoubleType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([text_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.StringType())
def _folded(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else fold_accents(x))


class FirstRows:
    """The first row of each partition: `first_rows(table(t) partition by key order by ordinal)`."""

    def __init__(self):
        self.seen = False

    @staticmethod
    def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(schema=rows.dataType)

    def eval(self, row) -> Iterator[tuple]:
        if not self.seen:
            self.seen = True
            yield tuple(row)

    def terminate(self):
        self.seen = False


class History:
    """Rows with the smallest id of the nearest earlier season and the latest earlier id with enrolment:
    `history(table(t) partition by group order by season, id, 'season', 'id', 'enrolled')`. Holds one row at a time."""

    def __init__(self):
        self._start()

    def _start(self) -> None:
        self.season = self.first = self.before = self.enrolled = None

    @staticmethod
    def analyze(rows: AnalyzeArgument, season: AnalyzeArgument, ident: AnalyzeArgument, enrolled: AnalyzeArgument) -> AnalyzeResult:
        kind = rows.dataType[ident.value].dataType
        return AnalyzeResult(schema=T.StructType([*rows.dataType.fields, T.StructField("last_offered_course_id", kind), T.StructField("last_enrollment_course_id", kind)]))

    def eval(self, row, season: str, ident: str, enrolled: str) -> Iterator[tuple]:
        if self.season is None or row[season] != self.season:
            self.before = self.first
            self.season, self.first = row[season], row[ident]
        yield (*row, self.before, self.enrolled)
        if row[enrolled] is not None:
            self.enrolled = row[ident]

    def terminate(self):
        self._start()


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session's SQL, in place of temporary ones of the same names."""
    for head, body in SCALARS.items():
        spark.sql(f"create or replace temporary function {head} return {body}")
    spark.udf.register("text_distance", _distance)
    spark.udf.register("fold_accents", _folded)
    spark.udtf.register("first_rows", F.udtf(FirstRows))
    spark.udtf.register("history", F.udtf(History))
