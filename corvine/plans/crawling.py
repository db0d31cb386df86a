"""The crawl: seasons, course details and evaluation pages of a service to landing files.

The service is a function `fetch(kind, request)` of the caller, with these kinds: `seasons` gives the page with the
list of seasons; `courses` the raw records of a season (and of first-year courses only, if the request says so);
`school` whether a course number of a season is the school's own; `evaluation` a page, or nothing. Calls run in tasks
and are tried again as an error says. What has landed is not asked for again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import crawl, io, served
from ..sources.spool import Spool, exists

Fetch = Callable[[str, dict], object]
SERVED = "season string, first_year boolean, record string"


def crawl_seasons(spark: SparkSession, cfg: io.RunConfig, fetch: Fetch) -> list[str]:
    """Season codes of the service, as landed if there is a cache."""
    at = f"{cfg.data_dir}/season_codes"
    if not (cfg.use_cache and exists(spark, at)):
        page = spark.createDataFrame([(str(crawl.with_retries(fetch)("seasons", {})),)], "html string")
        crawl.extract_codes(page, "html", crawl.SEASON_OPTION, crawl.NO_SEASONS).coalesce(1).write.mode("overwrite").text(at)
    return sorted(r.value for r in spark.read.text(at).collect())  # a few a year


def crawl_classes(spark: SparkSession, cfg: io.RunConfig, fetch: Fetch, seasons: list[str]) -> list[str]:
    """Lands the raw records and the first-year numbers of the seasons that have not landed; returns these."""
    done = io.list_seasons(spark, f"{cfg.data_dir}/raw_courses")
    todo = [s for s in seasons if not (cfg.use_cache and s in done)]
    call = crawl.with_retries(fetch)

    def ask(request: dict) -> list[dict]:
        return [{"record": json.dumps(r)} for r in call("courses", request)]

    source = served.course_source(ask, SERVED, "crawled_courses")
    record = F.from_json("record", io.RAW_COURSE)
    for season in todo:
        rows = served.load(spark, source, seasons).where(F.col("season") == season).select(record.alias("r")).select("r.*")
        io.write_json(Spool(spark, "crawl").keep(rows, "courses"), f"{cfg.data_dir}/raw_courses/{season}.json", ["crn"])
        first = served.load(spark, source, seasons).where((F.col("season") == season) & (F.col("first_year") == F.lit(True))).select(F.get_json_object("record", "$.crn").alias("crn"))
        io.write_json(Spool(spark, "crawl").keep(first.distinct(), "first"), f"{cfg.data_dir}/first_year/{season}.json", ["crn"])
    return todo


def of_school(wanted: DataFrame, fetch: Fetch, at: str, in_flight: int) -> DataFrame:
    """Those of `wanted(season_code, crn)` that are the school's own. Answers are remembered at the path, and only
    numbers without one are asked for; calls that fail leave no answer."""
    spark = wanted.sparkSession
    kind = "season_code string, crn string, own boolean"
    known = spark.read.schema(kind).parquet(at) if exists(spark, at) else spark.createDataFrame([], kind)
    todo = crawl.to_fetch(wanted, known, ["season_code", "crn"])
    answers = crawl.fetch(todo.select("season_code", "crn"), lambda row: "1" if fetch("school", row) else "0", in_flight)
    answers.where("error is null").select("season_code", "crn", (F.col("payload") == "1").alias("own")).write.mode("append").parquet(at)
    return wanted.join(spark.read.schema(kind).parquet(at).where("own").select("season_code", "crn").distinct(), ["season_code", "crn"], "left_semi")


def crawl_evaluations(spark: SparkSession, cfg: io.RunConfig, fetch: Fetch, seasons: list[str], cut: int = 202101) -> DataFrame:
    """Lands the evaluation pages of the seasons' courses that have none yet; returns the calls that failed, which are
    made again in the next run."""
    listed = io.read_json(spark, f"{cfg.data_dir}/raw_courses", io.RAW_COURSE).where(F.col("_season").isin(seasons))
    wanted = listed.select(F.col("_season").alias("season_code"), "crn").where("crn is not null").distinct()
    wanted = of_school(crawl.since(wanted, "season_code", cut), fetch, f"{cfg.data_dir}/school_answers", cfg.fetch_concurrency)
    at = f"{cfg.data_dir}/evaluation_pages"
    kind = "crn string, season string, page string"
    landed = spark.read.schema(kind).parquet(at) if exists(spark, at) else spark.createDataFrame([], kind)
    todo = crawl.gate(wanted, landed.select("crn", F.col("season").alias("season_code")), ["season_code", "crn"])
    pages = crawl.fetch(todo, lambda row: fetch("evaluation", row), cfg.fetch_concurrency)
    pages = Spool(spark, "crawl").keep(pages.withColumnRenamed("season_code", "season"), "pages")
    return crawl.land_pages(pages, at, ["crn", "season"])[1]


def crawl_stage(spark: SparkSession, cfg: io.RunConfig, fetch: Fetch) -> None:
    """What the flags ask for: the list of seasons, course details, evaluation pages. Failed pages are listed in
    `crawl_failures`."""
    seasons = io.resolve_seasons(cfg.seasons, crawl_seasons(spark, cfg, fetch) or None)
    if cfg.crawl_classes:
        crawl_classes(spark, cfg, fetch, seasons)
    if cfg.crawl_evals:
        crawl_evaluations(spark, cfg, fetch, seasons).write.mode("overwrite").parquet(f"{cfg.data_dir}/crawl_failures")
