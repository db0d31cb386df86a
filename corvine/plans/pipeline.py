"""The catalog pipeline: landing files to tables, checks, snapshot, sync and changelog."""

from __future__ import annotations

import datetime
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import html as H
from ..functions import scalars as S
from ..operators import checks, diff, linkage, metrics, tables
from ..sources import io
from ..sources.spool import Spool, exists
from . import crawling, evaluations, parse


def seasons_table(seasons: DataFrame) -> DataFrame:
    c = F.col("season_code")
    return seasons.select("season_code").distinct().select("season_code", S.term(c).alias("term"), S.year(c).alias("year"))


def import_listings(parsed: DataFrame) -> DataFrame:
    """Parsed courses as listings: numbers as integers, sections filled, the season taken from the file's name."""
    return parsed.withColumns(
        {
            "season_code": F.coalesce("_season", "season_code"),
            "crn": F.col("crn").cast("int"),
            "crns": S.int_set(F.col("crns")),
            "primary_crn": F.col("primary_crn").cast("int"),
            "section": S.section(F.col("section")),
            "listing_id": S.listing_id(F.coalesce("_season", "season_code"), F.col("crn").cast("int")),
        }
    )


def transform(spark: SparkSession, data_dir: str, identical: DataFrame | None = None, specs: DataFrame | None = None, email_changes: DataFrame | None = None, name_changes: DataFrame | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All tables from `parsed_courses`, `parsed_evaluations`, `evaluation_summaries` and `id_cache` below the folder,
    in sink columns, and the violations of every invariant."""
    spool = Spool(spark, "catalog")
    parsed = io.read_json(spark, f"{data_dir}/parsed_courses", io.PARSED_COURSE)
    listings = import_listings(parsed)
    if identical is not None:
        listings = linkage.drop_identical(listings, identical)
    listings = spool.keep(listings, "listings")
    bad = {"listings form cliques": linkage.clique_violations(listings)}
    listings, courses = linkage.resolve_cross_listings(listings, "_ordinal")
    listings, courses = spool.keep(listings, "resolved"), spool.keep(courses, "courses")
    people, taught = linkage.resolve_professors(courses, io.read_cache(spark, f"{data_dir}/id_cache/professor_id"), "_ordinal", email_changes, name_changes)
    taught = spool.keep(taught, "taught")
    flags, flagged = linkage.resolve_flags(courses, io.read_cache(spark, f"{data_dir}/id_cache/flag_id"), "_ordinal")
    meetings = linkage.course_meetings(courses)
    where = courses.select(F.posexplode("meetings").alias("_p", "m"), "_ordinal").select("m.location", "m.location_url", (F.col("_ordinal") * 64 + F.col("_p")).alias("_o"))
    locations, buildings, rejects = linkage.resolve_places(where, "_o")
    evals = io.read_json(spark, f"{data_dir}/parsed_evaluations", io.PARSED_EVALUATION)
    summaries = io.read_json(spark, f"{data_dir}/evaluation_summaries", io.SUMMARY)
    found, worse = evaluations.import_evaluations(evals, listings, summaries)
    ratings, questions = found["evaluation_ratings"], spool.keep(found["evaluation_questions"], "questions")
    statistics = found["evaluation_statistics"]
    for tag, name in (("Overall", "avg_rating"), ("Workload", "avg_workload")):
        statistics = statistics.join(metrics.tagged_averages(ratings, questions, tag).withColumnRenamed("average", name), "course_id", "left")
        bad[f"{tag} questions have five options"] = metrics.category_violations(ratings, questions, tag)
    statistics = spool.keep(statistics, "statistics")
    rated = metrics.professor_ratings(taught, statistics)
    people = people.join(rated, "professor_id", "left").withColumn("courses_taught", F.coalesce("courses_taught", F.lit(0)))
    people = spool.keep(people, "professors")
    once = taught.distinct()
    same, odd = linkage.same_courses(courses, listings, once, "_ordinal", spool, specs)
    bad |= odd | {"professors and emails are as many": linkage.uneven_professors(courses)}
    same = linkage.split_by_professors(same, once)
    courses = spool.keep(metrics.compute_courses(courses, same, people, once, statistics), "computed")
    out = {
        "seasons": seasons_table(listings), "courses": courses, "listings": listings, "professors": people, "course_professors": once, "flags": flags, "course_flags": flagged,
        "buildings": buildings, "locations": locations.withColumn("location_id", F.lit(None).cast("long")), "course_meetings": meetings.withColumn("location_id", F.lit(None).cast("long")),
        **found, "evaluation_statistics": statistics, "evaluation_questions": questions,
    }
    out = {t: tables.project(out[t], config.SINK_COLUMNS[t]) for t in config.LOAD_ORDER if t in out}
    bad |= worse | checks.assertions(out) | {"places can be parsed": rejects}
    return out, bad


def rewritten(spark: SparkSession, new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A transform's tables as a first version holds them: places with ids, meetings with these, audit columns."""
    now = F.current_timestamp()
    none = spark.createDataFrame([], "building_code string, room string, location_id long")
    placed = Spool(spark, "places").keep(diff.upsert_ids(new["locations"].drop("location_id"), none, ["building_code", "room"], "location_id"), "locations")
    first = {**new, "locations": placed, "course_meetings": diff.dedup_meetings(diff.resolve_locations(new["course_meetings"], placed))}
    return {t: df if t == "course_meetings" else df.withColumns(dict.fromkeys(config.AUDIT_COLUMNS, now)) for t, df in first.items()}


def sync(spark: SparkSession, new: dict[str, DataFrame], warehouse: io.Warehouse, freeze: bool = False, evaluations: bool = True) -> tuple[int, DataFrame]:
    """Merges a transform's tables into the warehouse as its next version; returns the version and the changelog as
    rows (at, line) to be read in the order of `at`. Without `evaluations` the evaluation tables stay as they are, and
    in a first version they are absent. Key ranges whose digests are equal are not compared, and tables in which
    nothing differs are carried over unread."""
    old, now, spool = warehouse.read(), F.current_timestamp(), Spool(spark, "sync")
    if not evaluations:
        new = {t: df for t, df in new.items() if not t.startswith("evaluation_")}
    if not old:
        return warehouse.write(rewritten(spark, new)), in_order(spark, ["## Summary", "", "First version"])
    bare = {t: df.drop(*config.AUDIT_COLUMNS) for t, df in old.items()}
    # each table is read several times: digests, differences, changelog, merge
    new = {t: df if hasattr(df, "_spooled_at") else spool.keep(df, t) for t, df in new.items()}
    helpers = ("_building_code", "_room")
    odd = {t: x for t in new if t in bare and (x := diff.schema_violations(bare[t], new[t].drop(*helpers)))} | {t: ["table is missing"] for t in new if t not in bare}
    if odd:
        raise checks.InvariantError(f"tables of the two versions differ in shape: {odd}")
    if freeze:
        places, meetings = bare["locations"], diff.freeze_locations(bare["course_meetings"], new["course_meetings"].drop("_building_code", "_room"))
    else:
        places = diff.upsert_ids(new["locations"].drop("location_id"), bare["locations"], ["building_code", "room"], "location_id")
        places = bare["locations"].join(places.select("location_id"), "location_id", "left_anti").unionByName(places.select(*bare["locations"].columns))
        gone = bare["buildings"].select("code").join(new["buildings"].select("code"), "code", "left_anti")
        meetings = diff.resolve_locations(new["course_meetings"], places)
        places, meetings = diff.cascade_delete(gone, places, meetings)
    places, meetings = spool.keep(places, "places"), spool.keep(meetings, "meetings")
    known = spool.keep(new["locations"].select("building_code", "room").join(places, ["building_code", "room"]).select("location_id"), "known")
    new = {**new, "locations": places, "course_meetings": meetings}
    diffs, same = {}, set()
    for t in config.LOAD_ORDER:
        if t in new and t in config.PRIMARY_KEYS and t in bare:
            found, ranges = diff.digest_diff(bare[t], new[t], config.PRIMARY_KEYS[t])
            diffs[t] = spool.keep(found, t) if ranges else found
            same |= set() if ranges else {t}
    log = changelog(bare, new, diffs)
    merged = diff.merge_all(old, new, now, diffs)
    touched = {"courses"} if {t for t in config.JUNCTIONS if t in new} - same else set()
    for t in same - touched - {"locations", "buildings"}:
        merged.pop(t, None)  # carried over by name
    # places that were met again are touched, those of buildings that are gone go
    merged["locations"] = diff.touch_parents(merged["locations"].join(places.select("location_id"), "location_id", "left_semi"), "location_id", known, now)
    merged["course_meetings"] = diff.sync_meetings(bare["course_meetings"], meetings.select(*bare["course_meetings"].columns))
    log = Spool(spark, "log").keep(log, "lines")
    return warehouse.write(merged), log


def in_order(spark: SparkSession, lines: list[str]) -> DataFrame:
    """A few fixed lines as rows (at, line)."""
    return spark.createDataFrame([([0, 0, n], line) for n, line in enumerate(lines)], "at array<long>, line string").select(F.struct(F.col("at")[0].alias("table"), F.col("at")[1].alias("section"), F.lpad(F.col("at")[2].cast("string"), 9, "0").alias("text")).alias("at"), "line")


def changelog(old: dict[str, DataFrame], new: dict[str, DataFrame], diffs: dict[str, DataFrame], link: str = "{season}-{crn}") -> DataFrame:
    """Markdown lines (at, line): a summary, then the changes of each table; junction changes are told with their
    courses. Lines stay on the executors; they are read in the order of `at`."""
    spark = new["courses"].sparkSession
    out = in_order(spark, ["## Summary", "", *(diff.summary_lines(diffs) or ["No changes"]), ""])
    naming = {
        "seasons": lambda a: F.col(f"{a}.season_code"), "listings": lambda a: F.concat_ws(" ", f"{a}.season_code", f"{a}.course_code", f"{a}.section"), "courses": None,
        "professors": lambda a: F.col(f"{a}.name"), "flags": lambda a: F.col(f"{a}.flag_text"), "locations": lambda a: F.concat_ws(" ", f"{a}.building_code", f"{a}.room"), "buildings": lambda a: F.col(f"{a}.code"),
    }
    for number, (name, who) in enumerate(naming.items(), 1):
        if name not in old or name not in new:
            continue
        if name == "courses":
            lines = course_lines(old, new, diffs["courses"], link)
        else:
            computed = config.COMPUTED_COLUMNS.get(name, []) + (["course_id"] if name == "listings" else [])
            lines = diff.change_lines(old[name], new[name], config.PRIMARY_KEYS[name], computed, who)
            if name == "listings":
                lines = lines.where("section = 'Updates'")
        place = F.when(F.col("section") == "Additions", 1).when(F.col("section") == "Removals", 2).otherwise(3).cast("long")
        lines = lines.where("section is not null").withColumn("place", place)
        at = lambda p, text: F.struct(F.lit(number).cast("long").alias("table"), p.alias("section"), text.alias("text"))  # noqa: B023, E731
        # headings stand before the lines of their part: they sort by the empty text
        heads = lines.select("section", "place").distinct()
        title = heads.agg(F.count("*").alias("n")).where("n > 0").select(at(F.lit(0).cast("long"), F.lit("")).alias("at"), F.lit(f"## {name.capitalize()} changes\n").alias("line"))
        heads = heads.select(at(F.col("place"), F.lit("")).alias("at"), F.concat(F.lit("### "), "section", F.lit("\n")).alias("line"))
        out = out.union(title).union(heads).union(lines.select(at(F.col("place"), F.col("line")).alias("at"), "line"))
    return out


def course_lines(old: dict[str, DataFrame], new: dict[str, DataFrame], changes: DataFrame, link: str) -> DataFrame:
    """(section, line) of courses: season, links and title, cross-listing notes, own and linked changes."""
    head = lambda df, side: df.join(diff.listing_links(side["listings"], link), "course_id", "left").select("course_id", F.concat(F.lit("- "), "season_code", F.lit(" "), F.coalesce("links", F.lit("")), F.lit(" "), "title").alias("head"))
    parts = []
    for op, section, side, other in (("added", "Additions", new, old), ("deleted", "Removals", old, new)):
        rows = head(side["courses"].join(changes.where(F.col("op") == op), "course_id", "left_semi"), side)
        notes = diff.cross_listing_notes(changes, side["listings"], other["listings"], op)
        parts.append(rows.join(notes, "course_id", "left").select(F.lit(section).alias("section"), F.concat("head", F.coalesce("note", F.lit(""))).alias("line")))
    both = old["courses"].select("course_id").join(new["courses"].select("course_id"), "course_id")
    own = diff.change_lines(old["courses"], new["courses"], ["course_id"], config.COMPUTED_COLUMNS["courses"], lambda a: F.col(f"{a}.course_id").cast("string")).where("section = 'Updates'")
    own = own.select(F.regexp_extract("line", r"^- (\d+)", 1).cast("long").alias("course_id"), F.regexp_replace("line", r"^- \d+", "").alias("line"))
    for table, names, key, name, title in (("course_professors", "professors", "professor_id", "name", "Professors"), ("course_flags", "flags", "flag_id", "flag_text", "Flags")):
        if table in old and table in new:
            known = tables.combine_first(new[names].select(key, name), old[names].select(key, name), [key])
            own = own.unionByName(diff.junction_lines(old[table], new[table], known, key, name, title, both))
    if "course_meetings" in old and "course_meetings" in new:
        texts = [diff.meeting_text(x["course_meetings"], x["locations"]) for x in (old, new)]
        own = own.unionByName(diff.text_lines(*texts, "Meetings", both))
    merged = own.groupBy("course_id").agg(F.array_join(F.array_sort(F.collect_list("line")), "").alias("lines"))
    updates = head(new["courses"], new).join(merged, "course_id").select(F.lit("Updates").alias("section"), F.concat("head", "lines").alias("line"))
    return parts[0].unionByName(parts[1]).unionByName(updates)


def save_caches(spark: SparkSession, tables_: dict[str, DataFrame], data_dir: str) -> None:
    """Remembers professor and flag ids; a key that would change its id stops the run."""
    for name, found in (("professor_id", linkage.saved_professor_keys(tables_["professors"])), ("flag_id", tables_["flags"].select(F.col("flag_text").alias("key"), F.col("flag_id").alias("id")))):
        at = f"{data_dir}/id_cache/{name}"
        cache = io.read_cache(spark, at)
        checks.enforce({f"{name} cache is stable": tables.cache_conflicts(cache, found)})
        io.write_cache(tables.merged_cache(cache, found), at)


def parse_season(spark: SparkSession, data_dir: str, season: str) -> tuple[DataFrame, DataFrame]:
    """Parsed courses and rejects of a season's raw details, second-source rows and first-year list, as landed."""
    raw = io.read_json(spark, f"{data_dir}/raw_courses/{season}.json", io.RAW_COURSE).drop("_season", "_ordinal")
    more = [f"{data_dir}/{kind}/{season}.json" for kind in ("second_source", "first_year")]
    second = io.read_json(spark, more[0], io.SECOND_SOURCE) if exists(spark, more[0]) else None
    first_year = io.read_json(spark, more[1], "crn string") if exists(spark, more[1]) else None
    return parse.parse_courses(raw, season, second, first_year)


def parse_stage(spark: SparkSession, cfg: io.RunConfig) -> list[str]:
    """Parses the seasons asked for (with the cache, those not parsed yet or whose landed files changed since) and the
    landed evaluation pages; writes records sorted by number, rejects, the ledger of landed files and the list of
    seasons; returns it."""
    raw, done = f"{cfg.data_dir}/raw_courses", io.list_seasons(spark, f"{cfg.data_dir}/parsed_courses")
    landed = io.list_seasons(spark, raw)
    wanted = io.resolve_seasons(cfg.seasons, landed or None)
    ledger = io.read_ledger(spark, f"{cfg.data_dir}/ledger")
    files = Spool(spark, "ledger").keep(io.landed_now(spark, [f"{cfg.data_dir}/{kind}" for kind in ("raw_courses", "second_source", "first_year")], ledger), "files")
    recorded = {r.season for r in ledger.select("season").distinct().collect()}  # a few
    changed = io.changed_seasons(files, ledger) & recorded
    todo = [s for s in wanted if not (cfg.use_cache and s in done and s not in changed)]
    for season in todo:
        parsed, rejects = parse_season(spark, cfg.data_dir, season)
        if cfg.require_locations:
            checks.enforce({f"places of {season} were delivered": checks.without_places(parsed)})
        io.write_json(parsed, f"{cfg.data_dir}/parsed_courses/{season}.json", ["crn"])
        rejects.write.mode("overwrite").parquet(f"{cfg.data_dir}/rejects/{season}")
    pages = f"{cfg.data_dir}/evaluation_pages"
    if exists(spark, pages):
        records = H.parse_evaluations(spark.read.schema("crn string, season string, page string").parquet(pages))
        records = Spool(spark, "evaluations").keep(records, "records")
        extras = F.to_json(F.struct("title", "not_viewable"))
        for season in io.resolve_seasons(cfg.seasons, [r.season for r in records.select("season").distinct().collect()]):  # a few seasons
            own = records.where((F.col("season") == season) & F.col("error").isNull())
            io.write_json(own.select("crn", "season", "enrolled", "responses", "ratings", "narratives", extras.alias("extras")), f"{cfg.data_dir}/parsed_evaluations/{season}.json", ["crn"])
    if todo:
        # seasons that were not parsed keep what the ledger said of them
        fresh = F.col("season").isin(todo) | ~F.col("season").isin(sorted(recorded))
        kept = ledger.where(~F.col("season").isin(todo)).unionByName(files.where(fresh))
        io.write_ledger(kept, f"{cfg.data_dir}/ledger")
        spark.createDataFrame([(",".join(todo),)], "value string").coalesce(1).write.mode("overwrite").text(f"{cfg.data_dir}/updated_seasons")
    return todo


def summarize_stage(spark: SparkSession, cfg: io.RunConfig, complete: Callable[[list[dict]], str]) -> None:
    """Summaries of the seasons asked for: questions that have none yet, of the first `max_courses_per_season` courses
    with such, are summarised, and all of a season's summaries are written again, sorted by number. Every answer is in
    the ledger of calls before it is used, so a task or a run that is tried again asks for nothing twice. Questions
    that the service put off for good are listed in `summary_failures` and asked in the next run; any other error
    stops the run, with the answers so far in the ledger."""
    landed = io.list_seasons(spark, f"{cfg.data_dir}/parsed_evaluations")
    for season in io.resolve_seasons(cfg.seasons, landed or None):
        if season not in landed:
            continue
        at = f"{cfg.data_dir}/evaluation_summaries/{season}.json"
        evals = io.read_json(spark, f"{cfg.data_dir}/parsed_evaluations/{season}.json", io.PARSED_EVALUATION)
        before = io.read_json(spark, at, io.SUMMARY).select("crn", "season", "narrative_summaries")
        asked = evaluations.prompts(evals, before, most_courses=cfg.max_courses_per_season)
        made = evaluations.summarize(asked, complete, cfg.fetch_concurrency, f"{cfg.data_dir}/summary_calls")
        made = Spool(spark, "summaries").keep(made, "made")
        made.where("error is not null").select("season", "crn", "question_code", "error").write.mode("overwrite").parquet(f"{cfg.data_dir}/summary_failures/{season}")
        io.write_json(evaluations.with_summaries(before, made.where("error is null")), at, ["crn"])


RULES = {"identical": "season_code string, keep int, drop int", "email_changes": "old string, new string", "name_changes": "email string, old string, new string", "specs": "spec int, part int, code string, season string"}


def run(spark: SparkSession, cfg: io.RunConfig, complete: Callable[[list[dict]], str] | None = None, fetch: crawling.Fetch | None = None) -> None:
    """The stages that the configuration asks for, in order: crawl, parse, transform, snapshot, sync, summaries. Hand-written
    rules are read from `rules/` below the data folder; without split specs there the default ones hold."""
    if cfg.debug:
        spark.sparkContext.setLogLevel("DEBUG")
    if cfg.save_config:
        io.save_args(cfg, cfg.save_config)
    if cfg.crawl_seasons or cfg.crawl_classes or cfg.crawl_evals:
        if fetch is None:
            raise ValueError("a crawl needs a function that fetches")
        crawling.crawl_stage(spark, cfg, fetch)
    if cfg.parse:
        parse_stage(spark, cfg)
    if cfg.transform:
        rules = {k: io.read_rules(spark, f"{cfg.data_dir}/rules/{k}.json", schema) for k, schema in RULES.items()}
        if rules["specs"] is None:
            rules["specs"] = linkage.split_specs(spark)
        out, bad = transform(spark, cfg.data_dir, **rules)
        checks.enforce(bad)
        held = Spool(spark, "tables")  # the id caches that they were made with are replaced below
        out = {name: held.keep(df, name) for name, df in out.items()}
        listed = out["listings"].select("course_id", "section", "course_code")
        places = out["locations"].join(out["buildings"].select(F.col("code").alias("building_code"), "building_name", "url"), "building_code", "left")
        for name, report in (("sections", linkage.report_sections(listed)), ("names", linkage.report_names(places.withColumnRenamed("building_code", "code")))):
            report.write.mode("overwrite").parquet(f"{cfg.data_dir}/reports/{name}")  # for review, not errors
        if cfg.save_cache:
            save_caches(spark, out, cfg.data_dir)
        if cfg.snapshot_tables:
            io.write_csv(out, f"{cfg.data_dir}/importer_dumps")
        warehouse = io.Warehouse(spark, cfg.warehouse or f"{cfg.data_dir}/warehouse")
        if cfg.sync_db_courses and cfg.rewrite:
            warehouse.write(rewritten(spark, out))
        elif cfg.sync_db_courses:
            _, log = sync(spark, out, warehouse, cfg.freeze_locations, evaluations=False)
            stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H-%M-%SZ")
            log.orderBy("at").select(F.col("line").alias("value")).write.text(f"{cfg.data_dir}/change_log/{stamp}")
        if cfg.sync_db_evals:
            warehouse.write(out, only="evaluation_")
    if cfg.summarize_evals:
        if complete is None:
            raise ValueError("summaries need a function that completes messages")
        summarize_stage(spark, cfg, complete)


def main(argv: list[str] | None = None) -> None:
    cfg = io.parse_args(argv if argv is not None else sys.argv[1:], dict(os.environ))
    run(SparkSession.builder.appName("corvine").getOrCreate(), cfg)


if __name__ == "__main__":
    main()
