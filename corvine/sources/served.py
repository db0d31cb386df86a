"""Courses of a web service as a Spark data source: seasons are planned as partitions, filters go to the service.

`course_source(fetch)` makes a data source class around a function that asks the service: `fetch(request)` gets a dict
with season, and, where the query says so, school and first_year, and gives rows as dicts, one after the other if
they are many. Equalities and IN lists on
season decide which requests are made at all, equalities on school and first_year go along with them; Spark checks
what else a query asks. Each request is one partition: it is made by a task, tried again with it, and runs beside the
others. A request's failure is that of its task.

Load the source anew for each query: Spark 4.1 keeps the requests of a loaded table's last filtered query, and gives
them to a later query on the same DataFrame that has no filters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Columns that a request can name besides the season.
ASKED = ("school", "first_year")


def course_source(fetch: Callable[[dict], Iterable[dict]], columns: str, name: str = "served_courses") -> type[DataSource]:
    """A data source of the rows of `fetch`, of the given columns (a DDL). Options: `seasons`, comma-separated, are all there are."""

    class Request(InputPartition):
        def __init__(self, asked: dict):
            super().__init__(tuple(sorted(asked.items())))

    class Reader(DataSourceReader):
        def __init__(self, seasons: list[str], columns: list[str]):
            self.seasons, self.columns, self.asked = seasons, columns, {}

        def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
            """Takes what requests can say; gives the rest back."""
            for f in filters:
                if isinstance(f, EqualTo) and f.attribute == ("season",):
                    self.seasons = [s for s in self.seasons if s == f.value]
                elif isinstance(f, In) and f.attribute == ("season",):
                    self.seasons = [s for s in self.seasons if s in f.value]
                elif isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in ASKED and f.attribute[0] not in self.asked:
                    self.asked[f.attribute[0]] = f.value
                else:
                    yield f

        def partitions(self) -> list[InputPartition]:
            return [Request({"season": s, **self.asked}) for s in self.seasons]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            if not isinstance(partition, Request):
                return  # no season is left to ask for
            asked = dict(partition.value)
            for row in fetch(asked):
                full = {**asked, **row}
                yield tuple(full.get(c) for c in self.columns)

    class Served(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return columns

        def reader(self, schema: StructType) -> DataSourceReader:
            seasons = [s for s in self.options.get("seasons", "").split(",") if s]
            return Reader(seasons, [f.name for f in schema.fields])

    return Served


def register(spark: SparkSession, source: type[DataSource]) -> None:
    """Makes the source known to `spark.read.format`, with its filters pushed."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(source)


def load(spark: SparkSession, source: type[DataSource], seasons: list[str]) -> DataFrame:
    """The rows of the service, for one query."""
    register(spark, source)
    return spark.read.format(source.name()).option("seasons", ",".join(seasons)).load()
