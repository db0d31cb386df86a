import pytest

from corvine.sources import crawl


def test_retries():
    waits, calls = [], []

    def call(x):
        calls.append(x)
        if len(calls) < 3:
            raise crawl.RateLimited("later", 7 if len(calls) == 1 else None)
        return "ok"

    assert crawl.with_retries(call, 5, sleep=waits.append)("a") == "ok" and waits == [7, 4.0]
    with pytest.raises(ValueError):
        crawl.with_retries(lambda: int("x"), 2, sleep=waits.append)()
    assert crawl.retry_after(Exception("Please try again in 1.5s")) == 1.5 and crawl.retry_after(Exception("no")) is None


def test_codes_and_gates(spark):
    pages = spark.createDataFrame([('<option value="202401">a<option value="999999">b<option value="202303">',)], "html string")
    codes = crawl.extract_codes(pages, "html", crawl.SEASON_OPTION, crawl.NO_SEASONS)
    assert [r.code for r in codes.collect()] == ["202303", "202401"]
    rows = spark.createDataFrame([("202303", 1), ("202003", 2), ("202401", 3)], "season_code string, crn int")
    left = crawl.to_fetch(crawl.since(rows, "season_code"), rows.where("crn = 3"), ["season_code", "crn"])
    assert [r.crn for r in left.collect()] == [1]
    assert crawl.updated_seasons(rows).first().seasons == "202003,202303,202401"


def test_fetch(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "crn string")

    def call(row):
        if row["crn"] == "b":
            raise ValueError("gone")
        return "page"

    got = {r.crn: (r.payload, r.error) for r in crawl.fetch(rows, call, 2, attempts=1).collect()}
    assert got["a"] == ("page", None) and "gone" in got["b"][1]
