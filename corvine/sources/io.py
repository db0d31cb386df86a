"""Landing files, snapshots, versioned tables, id caches and run configuration."""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..operators.running import running_count
from .spool import Spool, beside, exists, replace, settle

MEETING = "array<struct<days_of_week:int,start_time:string,end_time:string,location:string,location_url:string>>"
PARSED_COURSE = (
    "season_code string, requirements string, description string, title string, school string, credits double, extra_info string, professors array<string>,"
    f" professor_emails array<string>, crn string, crns array<string>, primary_crn string, course_code string, subject string, number string, section string, meetings {MEETING},"
    " skills array<string>, areas array<string>, flags array<string>, regnotes string, rp_attr string, classnotes string, final_exam string, course_home_url string, syllabus_url string,"
    " fysem boolean, sysem boolean, colsem boolean"
)
PARSED_EVALUATION = (
    "crn string, season string, enrolled int, responses int, ratings array<struct<question_code:string,question_text:string,options:array<string>,data:array<int>>>,"
    " narratives array<struct<question_code:string,question_text:string,comments:array<string>>>, extras string"
)
SUMMARY = "crn string, season string, narrative_summaries array<struct<question_code:string,question_text:string,summary:string>>"
RAW_COURSE = (
    "crn string, code string, title string, description string, col string, credit_html string, hours string, stat string, instructordetail_html string, xlist string, section string,"
    " meeting_html string, allInGroup array<struct<meets:string,meetingTimes:string>>, yc_attrs string, ci_attrs string, regnotes string, rp_attr string, clssnotes string, final_exam string, resources string"
)
SECOND_SOURCE = "crn string, subjectNumber string, sectionNumber string, primXLst string, termCode string"
CACHE = "key string, id long"


#: Bytes of a part file of `write_json`, and files of which a table of ranks may be broadcast.
PART_BYTES, MOST_FILES = 16 << 20, 100_000
#: Records of a file that its ordinals can tell apart.
PLACES = 1 << 33


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, season, bytes, modified) of the landing files at or below a path, contents unread. A path without files
    has none. The season is the name of the file, or of the folder that `write_json` made of it."""
    settle(spark, path)
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, season string, bytes long, modified timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), _season_of("_metadata.file_path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def _season_of(file: str) -> Column:
    return F.regexp_extract(F.col(file), r"([^/]+)\.json(?:/[^/]*)?$", 1).alias("season")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON array files; no file gives an empty table. Adds `_season` (the name of the file, or of the
    folder that `write_json` made of it) and `_ordinal`. Empty files have no records.

    The ordinal follows season, file name and the place in the file, however many files a season has and however
    Spark deals them out: a file is read by one task in its order, and files are ranked by a scan over ranges.
    """
    settle(spark, path)
    if not exists(spark, path):
        df = spark.createDataFrame([], schema)
        return df.withColumns({"_season": F.lit(None).cast("string"), "_ordinal": F.lit(None).cast("long")})
    df = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    df = df.withColumns({"_file": F.col("_metadata.file_path"), "_place": F.monotonically_increasing_id() % PLACES})
    ranks = running_count(landed_files(spark, path).select("file", "season"), [], ["season", "file"], "_rank", Spool(spark, "files"))
    ranks = ranks.select(F.col("file").alias("_file"), F.col("season").alias("_season"), "_rank")
    if ranks.count() <= MOST_FILES:  # a checked bound; more are joined by a shuffle
        ranks = F.broadcast(ranks)
    out = df.join(ranks, "_file").withColumn("_ordinal", F.col("_rank") * PLACES + F.col("_place"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns[:-2]], "_season", "_ordinal")


LEDGER = "file string, season string, bytes long, modified timestamp, digest string"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The landed files of which parsed seasons were made."""
    settle(spark, path)
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def write_ledger(ledger: DataFrame, path: str) -> None:
    new = beside(path)
    ledger.write.parquet(new)
    replace(ledger.sparkSession, new, path)


def landed_now(spark: SparkSession, paths: list[str], ledger: DataFrame) -> DataFrame:
    """The files that lie at or below the paths, in the ledger's columns. Of files with the size and time that the
    ledger has the digest is taken from there; only the others are read."""
    out = spark.createDataFrame([], LEDGER)
    for path in paths:
        files = landed_files(spark, path)
        known = ledger.select("file", "bytes", "modified", "digest")
        found = files.join(known, ["file", "bytes", "modified"], "left").select("file", "season", "bytes", "modified", "digest")
        out = out.unionByName(found.where("digest is not null"))
        if exists(spark, path):
            read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            read = read.select(F.col("_metadata.file_path").alias("file"), F.sha2("content", 256).alias("digest"))
            out = out.unionByName(found.where("digest is null").drop("digest").join(read, "file").select("file", "season", "bytes", "modified", "digest"))
    return out


def changed_seasons(files: DataFrame, ledger: DataFrame) -> set[str]:
    """Seasons with a file that came, went or has other contents than the ledger says; a few."""
    both = files.select("season", "file", "digest").alias("n").join(ledger.select("season", "file", "digest").alias("o"), "file", "full_outer")
    rows = both.where(~F.col("n.digest").eqNullSafe(F.col("o.digest"))).select(F.coalesce("n.season", "o.season").alias("season")).distinct()
    return {r.season for r in rows.collect()}


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    settle(spark, path)
    return spark.read.schema(CACHE).parquet(path) if exists(spark, path) else spark.createDataFrame([], CACHE)


def write_cache(cache: DataFrame, path: str) -> None:
    """Replaces a cache by one that may have been read from it."""
    new = beside(path)
    cache.write.parquet(new)
    replace(cache.sparkSession, new, path)


def write_json(df: DataFrame, path: str, order: list[str], part_bytes: int = PART_BYTES) -> None:
    """Records as JSON arrays, sorted by `order` within and across the part files, each of about `part_bytes` or one
    longer record. Files are written beside the path and take its place when all are there, so a failure leaves what
    was, and what lay there may have been read for `df`."""

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some, size = [], 0
        for b in batches:
            for x in b["value"]:
                if some and size + len(x) > part_bytes:
                    yield pd.DataFrame({"value": ["[" + ",\n".join(some) + "]"]})
                    some, size = [], 0
                some.append(x)
                size += len(x)
        if some:
            yield pd.DataFrame({"value": ["[" + ",\n".join(some) + "]"]})

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    text = ranged.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    new = beside(path)
    text.mapInPandas(arrays, "value string").write.option("maxRecordsPerFile", 1).text(new)
    replace(df.sparkSession, new, path)


def list_seasons(spark: SparkSession, path: str) -> list[str]:
    """Seasons that have a landing file or folder, without hidden ones."""
    if not exists(spark, path):
        return []
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(at)
    names = [f.getPath().getName() for f in found]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and n[0] not in "._")


def read_rules(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table of hand-written rules (JSON lines), if there is one."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else None


def write_csv(tables: dict[str, DataFrame], path: str) -> None:
    """A snapshot per table; arrays and structs as JSON text."""
    for name, df in tables.items():
        flat = [F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(c) for c in df.columns]
        df.select(*flat).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(f"{path}/{name}")


def without_returns(df: DataFrame) -> DataFrame:
    """All string columns without carriage returns, as bulk loads need them."""
    return df.withColumns({c: F.replace(c, F.lit("\r"), F.lit("")) for c, t in df.dtypes if t == "string"})


class Warehouse:
    """Versioned table sets: a new version is written aside, then a line that names the folder of each of its tables
    is appended, so readers see either all of a version or none of it. Tables that are carried over are named, not
    copied, and what is read is never written to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifests(self) -> list:
        """A row per version, of which there are as many as syncs."""
        at = f"{self.root}/_versions"
        rows = self.spark.read.schema("v int, last_update string, batch string, tables map<string,string>").json(at).collect() if exists(self.spark, at) else []
        return sorted(rows, key=lambda r: r.v)

    def versions(self) -> list[int]:
        return [r.v for r in self._manifests()]

    def batches(self) -> set[str]:
        """The names of the batches that versions were made of."""
        return {r.batch for r in self._manifests() if r.batch}

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables of a version, else of the last."""
        found = [r for r in self._manifests() if version in (None, r.v)]
        return {t: self.spark.read.parquet(f"{self.root}/{found[-1].tables[t]}") for t in config.LOAD_ORDER if t in found[-1].tables} if found else {}

    def missing(self) -> list[str]:
        """Expected tables that the last version lacks."""
        return [t for t in config.LOAD_ORDER if t not in self.read()]

    def write(self, tables: dict[str, DataFrame], only: str = "", batch: str | None = None) -> int:
        """Writes a version of the tables whose names begin with `only`; the others are carried over. A batch that
        is named is written once: a retry gives the version it made."""
        past = self._manifests()
        if batch and (done := [r.v for r in past if r.batch == batch]):
            return done[0]
        new = (past[-1].v if past else 0) + 1
        places = dict(past[-1].tables) if past else {}
        for name, df in tables.items():
            if name.startswith(only):
                places[name] = f"v{new}-{uuid.uuid4().hex[:8]}/{name}"
                without_returns(df).write.parquet(f"{self.root}/{places[name]}")
        line = self.spark.createDataFrame([(new, batch, places)], "v int, batch string, tables map<string,string>")
        line.withColumn("last_update", F.current_timestamp().cast("string")).coalesce(1).write.mode("append").json(f"{self.root}/_versions")
        return new


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.union(one)
    return out


# seasons and run configuration


class InvalidSeasonError(Exception):
    pass


def resolve_seasons(wanted: list[str] | None, known: list[str] | None) -> list[str]:
    """None: all; LATEST_n: the last n; else the listed ones, which must be known if anything is."""
    if wanted is None:
        return sorted(known or [])
    if len(wanted) == 1 and wanted[0].startswith("LATEST_"):
        return sorted(known or [])[-int(wanted[0].removeprefix("LATEST_")) :]
    if known is not None and (bad := [s for s in wanted if s not in known]):
        raise InvalidSeasonError(f"Invalid seasons: {', '.join(bad)}")
    return wanted


FLAGS = ("crawl-seasons", "crawl-classes", "crawl-evals", "transform", "snapshot-tables", "sync-db-courses", "sync-db-evals", "rewrite", "parse", "summarize-evals", "freeze-locations", "use-cache", "save-cache", "require-locations", "release", "debug")


@dataclass
class RunConfig:
    data_dir: str = "data"
    seasons: list[str] | None = None
    crawl_seasons: bool = False
    crawl_classes: bool = False
    crawl_evals: bool = False
    transform: bool = False
    snapshot_tables: bool = False
    sync_db_courses: bool = False
    sync_db_evals: bool = False
    rewrite: bool = False
    parse: bool = False
    summarize_evals: bool = False
    freeze_locations: bool = False
    use_cache: bool = True
    save_cache: bool = True
    require_locations: bool = False
    release: bool = False
    debug: bool = False
    fetch_concurrency: int = 10
    max_courses_per_season: int | None = None
    warehouse: str | None = None
    save_config: str | None = None
    extra: dict = field(default_factory=dict)

    def derived(self) -> RunConfig:
        """A release run takes no cache; snapshots and syncs need a transform."""
        self.use_cache = self.use_cache and not self.release
        self.transform = self.transform or self.snapshot_tables or self.sync_db_courses or self.sync_db_evals
        return self


def typed(name: str, text: str) -> bool | int | list[str] | str | None:
    """A value of the environment in its field's type: switches by the usual words, lists by commas or blanks."""
    kind = str(RunConfig.__dataclass_fields__[name].type)
    if kind == "bool":
        if text.strip().lower() in ("1", "true", "yes", "on"):
            return True
        if text.strip().lower() in ("", "0", "false", "no", "off"):
            return False
        raise ValueError(f"{name.upper()}={text}: neither yes nor no")
    if kind.startswith("int"):
        return int(text) if text.strip() or "None" not in kind else None
    if kind.startswith("list"):
        return [x for x in text.replace(",", " ").split()] or None
    return text


def parse_args(argv: list[str] | None = None, env: dict[str, str] | None = None) -> RunConfig:
    """Command line over configuration file over environment over defaults."""
    p = argparse.ArgumentParser(prog="corvine")
    p.add_argument("--config-file")
    p.add_argument("--seasons", nargs="*")
    p.add_argument("--data-dir")
    p.add_argument("--warehouse")
    p.add_argument("--save-config")
    p.add_argument("--fetch-concurrency", type=int)
    p.add_argument("--max-courses-per-season", type=int)
    for flag in FLAGS:
        p.add_argument(f"--{flag}", action=argparse.BooleanOptionalAction)
    given = {k: v for k, v in vars(p.parse_args(argv)).items() if v is not None}
    loaded: dict = {}
    if at := given.pop("config_file", None):
        text = Path(at).read_text()
        if at.endswith((".yml", ".yaml")):
            import yaml

            loaded = yaml.safe_load(text) or {}
        else:
            loaded = json.loads(text)
    names = {f for f in RunConfig.__dataclass_fields__ if f != "extra"}
    from_env = {k.lower(): typed(k.lower(), v) for k, v in (env or {}).items() if k.lower() in names}
    merged = from_env | {k: v for k, v in loaded.items() if k in names} | given
    return RunConfig(**merged, extra={k: v for k, v in loaded.items() if k not in names}).derived()


def save_args(cfg: RunConfig, path: str) -> None:
    """The configuration as YAML or JSON, by the file's name."""
    kept = {k: v for k, v in vars(cfg).items() if k not in ("extra", "save_config")}
    if path.endswith((".yml", ".yaml")):
        # a JSON value is a YAML value
        Path(path).write_text("".join(f"{k}: {json.dumps(v)}\n" for k, v in kept.items()))
    else:
        Path(path).write_text(json.dumps(kept, indent=2))
