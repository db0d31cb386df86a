"""Ingestion helpers around an injected fetch function: what to fetch, how often to try, and what landed."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class RateLimited(Exception):
    """Raised by a fetch function when the service asks to wait; may carry the seconds."""

    def __init__(self, message: str = "", seconds: float | None = None):
        super().__init__(message)
        self.seconds = seconds


def retry_after(error: Exception) -> float | None:
    """Seconds to wait that an error names, as a field, in a header or in its text."""
    if (given := getattr(error, "seconds", None)) is not None:
        return float(given)
    headers = getattr(error, "headers", None) or getattr(getattr(error, "response", None), "headers", None) or {}
    told = next((str(v) for k, v in dict(headers).items() if k.lower() == "retry-after"), "")
    if re.fullmatch(r"\d+(\.\d+)?", told):
        return float(told)
    found = re.search(r"(?:retry|try again)[^0-9]*(\d+(?:\.\d+)?)\s*s", str(error), re.IGNORECASE)
    return float(found[1]) if found else None


def with_retries(call: Callable, attempts: int = 5, first: float = 2.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """`call` tried again after failures, waiting twice as long each time or as long as the error says."""

    def run(*args):
        for n in range(attempts):
            try:
                return call(*args)
            except Exception as e:
                if n == attempts - 1:
                    raise
                sleep(min(most, retry_after(e) or first * 2**n))
        return None

    return run


def extract_codes(pages: DataFrame, html: str, pattern: str, drop: list[str] = ()) -> DataFrame:
    """Distinct sorted first groups of all matches in pages, such as the season codes of a selection list."""
    found = pages.select(F.explode(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).alias("code")).distinct()
    return found.where(~F.col("code").isin(list(drop))).orderBy("code") if drop else found.orderBy("code")


SEASON_OPTION = r'<option value="(\d{6})"'
#: Codes of the list that are no seasons.
NO_SEASONS = ["999999", "999998"]


def to_fetch(wanted: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted rows that have not landed yet."""
    return wanted.join(landed.select(*keys).distinct(), keys, "left_anti")


def since(rows: DataFrame, season: str, cut: int = 202101) -> DataFrame:
    """Rows of seasons after the cut."""
    return rows.where(F.col(season).cast("int") > cut)


def gate(wanted: DataFrame, landed: DataFrame, keys: list[str], schools: list[str] | None = None, cut: int | None = None) -> DataFrame:
    """What to fetch: rows that have not landed, of the given schools, of seasons after the cut."""
    out = to_fetch(wanted, landed, keys)
    if schools is not None:
        out = out.where(F.col("school").isin(schools))
    return out if cut is None else since(out, "season_code", cut)


def is_login_page(page: Column) -> Column:
    """Whether a landed page is the sign-in form instead of what was asked for."""
    return F.coalesce(F.regexp_like(page, F.lit(r"(?is)<form[^>]*(login|signin)|<title>[^<]*(log ?in|sign ?in)")), F.lit(False))


def land_pages(fetched: DataFrame, path: str, schema_keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Writes fetched pages (keys, payload, error) to the landing folder; returns what lies there, and the rows that
    failed or met the sign-in form and are to be fetched again."""
    good = F.col("error").isNull() & F.col("payload").isNotNull() & ~is_login_page(F.col("payload"))
    fetched.where(good).select(*schema_keys, F.col("payload").alias("page")).write.mode("append").parquet(path)
    why = F.coalesce("error", F.when(is_login_page(F.col("payload")), "sign-in page").otherwise("no page"))
    return fetched.sparkSession.read.parquet(path), fetched.where(~good).select(*schema_keys, why.alias("error"))


def fan_out(courses: DataFrame, call: Callable[[dict], str | None], schema: str, in_flight: int = 10) -> tuple[DataFrame, DataFrame]:
    """Rows of a second source: one call for each distinct (school, subject), its JSON array flattened to rows of
    the schema; and the calls that failed."""
    asked = courses.select("school", "subject").where("school is not null and subject is not null").distinct()
    got = fetch(asked, call, in_flight)
    rows = got.where("error is null").select("school", "subject", F.explode_outer(F.from_json("payload", f"array<struct<{schema}>>")).alias("row"))
    return rows.where("row is not null").select("school", "subject", "row.*"), got.where("error is not null").select("school", "subject", "error")


def fetch(rows: DataFrame, call: Callable[[dict], str | None], in_flight: int = 10, attempts: int = 10) -> DataFrame:
    """`rows` with `payload` and `error` from `call(row)`, at most `in_flight` calls at once."""
    tried = with_retries(call, attempts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    out.append((tried(row), None))
                except Exception as e:
                    out.append((None, repr(e)))
            yield batch.assign(payload=[p for p, _ in out], error=[e for _, e in out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.repartition(in_flight).mapInPandas(run, f"{schema}, payload string, error string")


def updated_seasons(rows: DataFrame) -> DataFrame:
    """One row: the distinct seasons as a comma-separated list."""
    return rows.agg(F.array_join(F.array_sort(F.collect_set("season_code")), ",").alias("seasons"))
