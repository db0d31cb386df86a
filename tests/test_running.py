"""Scans over ranges against windows, on groups of any size, and the ordered scan of many landing files."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corvine.operators import metrics, running, tables
from corvine.sources import io
from corvine.sources.spool import Spool, beside, replace, settle


@pytest.mark.parametrize("groups", [1, 3, 200])
def test_running_values_equal_windows(spark, groups):
    r = random.Random(groups)
    rows = [(r.randrange(groups) if r.random() < 0.6 else None, i, r.choice([None, i % 7])) for i in range(700)]
    df = spark.createDataFrame(rows, "g long, o long, x long").repartition(4).withColumn("_own", F.lit("clash"))
    df = df.drop("_own")
    spool = Spool(spark, "test")
    w = W.partitionBy("g").orderBy("o")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    want = df.select("o", (F.row_number().over(w) - 1).alias("n"), F.sum("x").over(before).alias("s"), F.last("x", True).over(before).alias("l"))
    got = running.running_count(df, ["g"], ["o"], "n", spool)
    got = running.running_sum(got, ["g"], ["o"], "x", "s", spool)
    got = running.running_last(got, ["g"], ["o"], "x", "l", spool)
    assert sorted(map(tuple, got.select("o", "n", "s", "l").collect())) == sorted(map(tuple, want.collect()))
    assert got.columns == ["g", "o", "x", "n", "s", "l"]


def test_row_ids_are_dense_and_empty_tables_stay(spark):
    df = spark.range(1000).selectExpr("id * id * 1000 as o")
    assert [r.id for r in tables.row_ids(df, "o").orderBy("o").collect()] == list(range(1000))
    assert tables.row_ids(df.limit(0), "o").collect() == []


def test_history_of_one_large_group(spark):
    r = random.Random(1)
    rows = [("g", f"20{r.randrange(10, 20)}01", i, r.choice([None, 5])) for i in range(400)]
    df = spark.createDataFrame(rows, "grp string, season string, id long, enrolled int")
    a = metrics.history(df, "grp", "season", "id", "enrolled")
    b = metrics.history(df, "grp", "season", "id", "enrolled", Spool(spark, "test"))
    assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(a.columns)).collect()))


def test_order_of_a_season_of_unequal_files(spark, tmp_path):
    """Spark packs large files first; the ordinal does not."""
    n, want = 0, []
    for season in ("202002", "202001"):
        folder = tmp_path / "courses" / f"{season}.json"
        folder.mkdir(parents=True)
        for part, size in enumerate((2, 40, 0, 900, 7)):
            rows = [f'{{"crn": "{season}-{part}-{i:04d}", "title": "{"x" * size}"}}' for i in range(size)]
            (folder / f"part-{part:05d}.json").write_text("[" + ",".join(rows) + "]" if rows else "")
            want += [f"{season}-{part}-{i:04d}" for i in range(size)]
            n += size
    (tmp_path / "courses" / "201903.json").write_text('[{"crn": "first"}]')
    back = io.read_json(spark, f"file://{tmp_path}/courses", "crn string, title string")
    got = [r.crn for r in back.orderBy("_ordinal").collect()]
    assert got == sorted([*want, "first"], key=lambda x: ("0", x) if x == "first" else ("1", x))
    first = tables.keep_first(back.where("crn <> 'first'").selectExpr("substr(crn, 1, 6) as s", "crn", "_ordinal"), ["s"], "_ordinal")
    assert sorted(r.crn for r in first.collect()) == ["202001-0-0000", "202002-0-0000"]


def test_write_json_bounds_files_and_replaces_what_it_reads(spark, tmp_path):
    at = f"file://{tmp_path}/season.json"
    rows = spark.range(500).selectExpr("lpad(cast(id as string), 5, '0') as crn", "repeat('y', 50) as title")
    io.write_json(rows, at, ["crn"], 2000)
    files = list((tmp_path / "season.json").glob("part-*"))
    assert len(files) > 15 and all(f.stat().st_size < 2300 for f in files)
    back = io.read_json(spark, at, "crn string, title string")
    io.write_json(back.where("crn < '00100'").select("crn", "title"), at, ["crn"])
    assert io.read_json(spark, at, "crn string, title string").count() == 100
    assert [p.name for p in tmp_path.iterdir()] == ["season.json"]


def test_a_replacement_that_was_cut_off_is_settled(spark, tmp_path):
    at = f"file://{tmp_path}/cache"
    io.write_cache(spark.createDataFrame([("a", 1)], io.CACHE), at)
    (tmp_path / "cache").rename(tmp_path / ".cache.old")  # set aside, and then the writer was lost
    assert [tuple(r) for r in io.read_cache(spark, at).collect()] == [("a", 1)]
    new = beside(at)
    spark.createDataFrame([("b", 2)], io.CACHE).write.parquet(new)
    replace(spark, new, at)
    settle(spark, at)
    assert [tuple(r) for r in io.read_cache(spark, at).collect()] == [("b", 2)] and not list(tmp_path.glob(".cache*"))
    with pytest.raises(OSError):
        replace(spark, f"{at}-absent", at)
    assert io.read_cache(spark, at).count() == 1


def test_several_values_need_one_scan(spark):
    """Rows are written once and shuffled no more often than for one value."""
    r = random.Random(3)
    rows = [(r.randrange(2), i, r.choice([None, i % 7])) for i in range(500)]
    df = spark.createDataFrame(rows, "g long, o long, x long").repartition(4)

    class Counted(Spool):
        kept = 0

        def keep(self, *a, **k):
            self.kept += 1
            return super().keep(*a, **k)

    spool = Counted(spark, "test")
    got = running.running_values(df, ["g"], ["o"], {"n": running.count(), "s": running.total("x"), "l": running.latest("x", ["o"])}, spool)
    w = W.partitionBy("g").orderBy("o")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    want = df.select("g", "o", "x", (F.row_number().over(w) - 1).alias("n"), F.sum("x").over(before).alias("s"), F.last("x", True).over(before).alias("l"))
    assert spool.kept == 1 and got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
