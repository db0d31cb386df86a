import datetime

from pyspark.sql import functions as F

from corvine.operators import checks, diff, metrics, tables

RATING = "course_id long, question_code string, rating array<int>"


def average(spark, rows):
    q = spark.createDataFrame([("Q", "Overall"), ("DR359", "Overall")], "question_code string, tag string")
    r = spark.createDataFrame(rows, RATING)
    return metrics.tagged_averages(r, q, "Overall").first().average, metrics.category_violations(r, q, "Overall").count()


def test_histogram_means(spark):
    assert round(average(spark, [(1, "Q", [1, 2, 3, 4, 5])])[0], 6) == 3.666667
    assert average(spark, [(1, "Q", [1, 0, 0, 0, 0]), (1, "Q", [0, 0, 0, 0, 1])])[0] == 3.0
    assert average(spark, [(1, "Q", [0] * 5)])[0] is None
    assert average(spark, [(1, "DR359", [0, 0, 0, 0, 0, 2])]) == (6.0, 0)
    assert average(spark, [(1, "DR359", [1, 0, 0, 0, 0, 9]), (1, "Q", [0, 0, 0, 0, 1])]) == (3.0, 0)  # the sixth is cut
    assert average(spark, [(1, "Q", [1, 1, 1, 1])])[1] == 1


def test_history(spark):
    rows = [(1, 1, "202001", 5), (2, 1, "202003", None), (3, 1, "202003", 7), (4, 1, "202003", None), (5, 1, "202101", None), (6, 2, "202101", 1)]
    h = metrics.history(spark.createDataFrame(rows, "id long, g long, s string, e int"), "g", "s", "id", "e")
    assert {r.id: (r.last_offered_course_id, r.last_enrollment_course_id) for r in h.collect()} == {1: (None, None), 2: (1, 1), 3: (1, 1), 4: (1, 3), 5: (2, 3), 6: (None, None)}


def test_same_professors_is_false_not_null(spark):
    rows = [(1, 1, "202001", 5), (2, 1, "202003", 6), (3, 1, "202101", 7)]
    h = metrics.history(spark.createDataFrame(rows, "id long, g long, s string, e int"), "g", "s", "id", "e")
    taught = spark.createDataFrame([(2, 9), (3, 9)], "course_id long, professor_id long")
    out = metrics.with_last_enrollment(h, "id", "s", "e", taught)
    assert {r.id: (r.last_enrollment, r.last_enrollment_same_professors) for r in out.collect()} == {1: (None, False), 2: (5, False), 3: (6, True)}
    none = metrics.with_last_enrollment(h, "id", "s", "e", taught.limit(0))
    assert not any(r.last_enrollment_same_professors for r in none.collect())


def test_professor_counts_rows(spark):
    bridge = spark.createDataFrame([(1, 9), (1, 9), (2, 9)], "course_id long, professor_id long")
    r = metrics.professor_ratings(bridge, spark.createDataFrame([(1, 4.0), (2, None)], "course_id long, avg_rating double")).first()
    assert (r.courses_taught, r.average_rating, r.average_rating_n) == (3, 4.0, 2)


def versions(spark):
    old = spark.createDataFrame([(1, "a", 1.0, "x"), (2, None, 2.0, "x"), (3, "c", None, "x"), (4, "d", 4.0, "x")], "k int, name string, avg double, extra string")
    new = spark.createDataFrame([(1, "a", 9.0, "x"), (2, "b", 2.0, "x"), (3, "c", None, "x"), (5, "e", 5.0, "x")], "k int, name string, avg double, extra string")
    return old, new


def test_diff(spark):
    old, new = versions(spark)
    got = {r.k: (r.op, r.columns_changed) for r in diff.table_diff(old, new, ["k"]).collect()}
    assert got == {1: ("changed", ["avg"]), 2: ("changed", ["name"]), 4: ("deleted", []), 5: ("added", [])}
    assert diff.table_diff(old, old, ["k"]).count() == 0
    assert {(r.table_name, r.op, r.n) for r in diff.diff_summary({"t": diff.table_diff(old, new, ["k"])}).collect()} == {("t", "changed", 2), ("t", "deleted", 1), ("t", "added", 1)}


def test_merge_applies_the_diff(spark):
    old, new = versions(spark)
    was, now = datetime.datetime(2020, 1, 1), datetime.datetime(2024, 1, 1)
    stamped = old.withColumn("time_added", F.lit(was)).withColumn("last_updated", F.lit(was))
    out = diff.merge(stamped, new, ["k"], ["avg"], F.lit(now))
    assert sorted(out.drop("time_added", "last_updated").collect(), key=str) == sorted(new.collect(), key=str)
    assert {r.k: (r.time_added, r.last_updated) for r in out.collect()} == {1: (was, was), 2: (was, now), 3: (was, was), 5: (now, now)}
    assert diff.merge(stamped, new, ["k"], ["avg"], F.lit(now), keep_deleted=True).count() == 5


def test_change_lines(spark):
    old, new = versions(spark)
    got = {r.line for r in diff.change_lines(old, new, ["k"], ["avg"], lambda a: F.col(f"{a}.k").cast("string")).collect()}
    assert got == {"- 2\n  - name: N/A → b", "- 4", "- 5"}


def test_locations_and_meetings(spark):
    places = spark.createDataFrame([("A", "1"), ("A", None), ("B", "2")], "building_code string, room string")
    old = spark.createDataFrame([("A", None, 5)], "building_code string, room string, location_id long")
    got = {(r.building_code, r.room): r.location_id for r in diff.upsert_ids(places, old, ["building_code", "room"], "location_id").collect()}
    assert got == {("A", None): 5, ("A", "1"): 6, ("B", "2"): 7}
    kind = "course_id long, start_time string, end_time string, days_of_week int, location_id long"
    m = spark.createDataFrame([(1, "9", "10", 2, None), (1, "9", "10", 2, 7), (2, "9", "10", 4, None), (2, "9", "10", 8, None)], kind)
    assert sorted((r.course_id, r.days_of_week, r.location_id) for r in diff.dedup_meetings(m).collect()) == [(1, 2, 7), (2, 4, None)]
    assert [r.course_id for r in diff.changed_meeting_courses(m.where("location_id = 7"), m.where("location_id = 7")).collect()] == []
    assert sorted(r.course_id for r in diff.changed_meeting_courses(m, m).collect()) == [1, 2]
    frozen = diff.freeze_locations(m.where("location_id = 7"), spark.createDataFrame([(1, "9", "10", 2, None), (1, "9", "10", 4, None)], kind))
    assert sorted((r.days_of_week, r.location_id) for r in frozen.collect()) == [(2, 7), (4, None)]


def test_ids(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("z", 4)], "key string, o long")
    cache = spark.createDataFrame([("a", 10)], "key string, id long")
    got = tables.stable_ids(rows, "key", "o", cache)
    ids = {r.key: r.id for r in got.collect()}
    assert ids == {"a": 10, "b": 11, "z": 12}
    again = tables.stable_ids(rows, "key", "o", tables.merged_cache(cache, got))
    assert {r.key: r.id for r in again.collect()} == ids
    assert tables.cache_conflicts(cache, spark.createDataFrame([("a", 9)], "key string, id long")).count() == 1
    assert [r.id for r in tables.row_ids(spark.range(1000, 1500, 7).withColumnRenamed("id", "o"), "o", "id", 5).orderBy("o").collect()] == list(range(72))


def test_last_non_null_mixes_rows(spark):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "b"), ("k", 3, None, None)], "k string, o int, x string, y string")
    assert tuple(tables.last_non_null(df, ["k"], "o").first()) == ("k", "a", "b")


def test_checks(spark):
    import pytest

    with pytest.raises(checks.InvariantError):
        checks.enforce({"none": spark.range(1)})
    checks.enforce({"none": spark.range(0)})
