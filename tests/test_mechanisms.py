"""Streams with state, the served source, SQL functions, range digests and incremental components."""

import json
import random

import pytest

from corvine import sql
from corvine.operators import diff, graph, tables
from corvine.sources import io, served
from corvine.sources.spool import Spool
from corvine.streaming import stateful

ROW = "code string, o long, name string, size int"


def landed(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("code", "o", "name", "size"), r))) for r in rows) + "\n")


@pytest.mark.parametrize("kind", ["first", "latest"])
def test_streams_equal_the_batch_answer(spark, tmp_path, kind):
    """Two micro-batches, rows that come late, and a restart."""
    folder = tmp_path / "in"
    folder.mkdir()
    batches = [[("A", 5, "x", 1), ("A", 7, None, 2), ("B", 3, "b", None)], [("A", 2, None, 9), ("A", 6, "late", None), ("C", 1, "c", 1)], [("B", 1, "first", 4), ("A", 9, None, 5), ("C", 8, None, None)]]
    w = io.Warehouse(spark, f"file://{tmp_path}/w")
    for n, rows in enumerate(batches):  # each start is a restart from the checkpoint
        landed(folder, f"{n}.json", rows)
        stream = spark.readStream.schema(ROW).json(f"file://{folder}")
        made = stateful.first_rows(stream, ["code"], "o") if kind == "first" else stateful.latest_values(stream, ["code"], "o")
        stateful.publish(w, "buildings", ["code"], made, f"file://{tmp_path}/cp").awaitTermination()
    every = spark.createDataFrame([r for b in batches for r in b], ROW)
    want = tables.keep_first(every, ["code"], "o") if kind == "first" else tables.last_non_null(every, ["code"], "o")
    got = w.read()["buildings"]
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    versions = w.versions()
    stream = spark.readStream.schema(ROW).json(f"file://{folder}")
    made = stateful.first_rows(stream, ["code"], "o") if kind == "first" else stateful.latest_values(stream, ["code"], "o")
    stateful.publish(w, "buildings", ["code"], made, f"file://{tmp_path}/cp").awaitTermination()
    assert w.versions() == versions  # nothing new has landed


def test_served_source_asks_only_for_what_is_wanted(spark, tmp_path, capsys):
    log = tmp_path / "asked"
    log.mkdir()

    def fetch(asked):
        (log / f"{asked['season']}-{asked.get('school')}-{asked.get('first_year')}").write_text("")
        return [{"crn": str(i), "school": "AB"[i % 2], "first_year": i % 3 == 0} for i in range(6) if asked.get("school") in (None, "AB"[i % 2])]

    source = served.course_source(fetch, "season string, school string, first_year boolean, crn string")
    load = lambda: served.load(spark, source, ["1", "2", "3"])
    some = load().where("season in ('1', '3') and school = 'B' and crn <> '1'")
    some.explain("formatted")
    assert "PushedFilters: [In(season, [1,3]), EqualTo(school,B)]" in capsys.readouterr().out
    assert sorted((r.season, r.school, r.crn) for r in some.collect()) == [("1", "B", "3"), ("1", "B", "5"), ("3", "B", "3"), ("3", "B", "5")]
    assert sorted(p.name for p in log.iterdir()) == ["1-B-None", "3-B-None"]
    assert load().where("season = '9'").count() == 0 and load().count() == 18


def test_sql_functions(spark):
    sql.register(spark)
    row = spark.sql("select season_term('202402') as t, season_year('202402') as y, is_discussion('A', 'X 1') as d, is_discussion('01', 'X 1D') as e, text_distance('abcd', 'xabcdx') as z, fold_accents('Zoë') as f, listing_id('202401', 5L) as l").first()
    assert tuple(row) == ("summer", 2024, True, True, 0.0, "Zoe", 240100005)
    spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, None, "n")], "k int, o int, v string").createOrReplaceTempView("corvine_rows")
    got = spark.sql("select * from first_rows(table(corvine_rows) partition by k order by o)").collect()
    assert sorted(map(tuple, got), key=str) == [(1, 1, "a"), (2, None, "n")]


def test_digests_find_every_change_and_compare_little(spark):
    r = random.Random(3)
    rows = [(i, r.choice([None, "x", "y"]), float(i % 7), [i % 3]) for i in range(3000)]
    old = spark.createDataFrame(rows, "k long, a string, b double, c array<int>")
    new = [x for x in rows if x[0] not in (5, 700)] + [(9001, "z", 1.0, None)]
    new = spark.createDataFrame([(k, "changed", b, c) if k in (17, 18) else (k, a, b, [7] if k == 2000 else c) for k, a, b, c in new], old.schema).repartition(7)
    found, ranges = diff.digest_diff(old, new, ["k"])
    order = lambda df: sorted((x.k, x.op, x.columns_changed) for x in df.collect())
    assert order(found) == order(diff.table_diff(old, new, ["k"])) and len(order(found)) == 6 and len(ranges) <= 6
    stored = Spool(spark, "t").keep(diff.range_digests(old, ["k"]), "digests")
    assert order(diff.digest_diff(old, new, ["k"], stored)[0]) == order(found)
    same, none = diff.digest_diff(old, old.repartition(5), ["k"])
    assert same.count() == 0 and none == []
    gone, _ = diff.digest_diff(old, old.limit(0), ["k"])
    assert gone.where("op = 'deleted'").count() == 3000


def test_components_after_edits_contract_only_what_changed(spark):
    r, spool = random.Random(5), Spool(spark, "t")
    edges = {tuple(sorted(r.sample(range(10 * g, 10 * g + 10), 2))) for g in range(40) for _ in range(9)}
    removed = set(r.sample(sorted(edges), 6))
    added = {(3, 57), (401, 402), (120, 121)} - edges
    frame = lambda x: spark.createDataFrame(sorted(x), "a long, b long")
    known = spool.keep(graph.labels(spark.range(400).withColumnRenamed("id", "node"), frame(edges), spool), "known")
    found, now, again = graph.updated_labels(known, frame(edges), frame(added), frame(removed), spool)
    want = graph.labels(spark.range(400).withColumnRenamed("id", "node").union(frame(added).select("a")).union(frame(added).select("b")), frame((edges - removed) | added), spool)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.select("node", "root").collect()))
    assert {tuple(x) for x in now.collect()} == (edges - removed) | added
    assert again.count() < len(edges) / 2


def test_served_pages_are_read_some_rows_at_a_time(spark, sf, monkeypatch):
    """The service hands out rows while it reads."""
    from corvine.plans import mechanism_queries

    asked = {}

    def kept(fetch, *a, **k):
        asked["fetch"] = fetch
        return real(fetch, *a, **k)

    real = served.course_source
    monkeypatch.setattr(mechanism_queries.served, "course_source", kept)
    mechanism_queries.served_pages(spark, sf)
    rows = asked["fetch"]({"season": "202401", "school": "S2"})
    assert iter(rows) is rows
    ids = [r["page_id"] for r in rows]
    assert ids and all(i % 4 == 1 and i % 3 == 2 for i in ids)


def test_components_after_edits_broadcast_nothing(spark, sf, monkeypatch):
    """No table of nodes goes through the driver, whatever its files' size."""
    from corvine.plans import mechanism_queries

    plans = []

    class Seen(Spool):
        def keep(self, df, *a, **k):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return super().keep(df, *a, **k)

    monkeypatch.setattr(mechanism_queries, "Spool", Seen)
    df = mechanism_queries.components_after_edits(spark, sf)
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not any("Broadcast" in p for p in plans)
