import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from corvine.plans import evaluations, parse, pipeline
from corvine.sources import io
from corvine.sources.crawl import RateLimited


def course(crn, crns, code, title, **more):
    base = {
        "season_code": "x", "requirements": "", "description": "d " + title, "title": title, "school": "YC", "credits": 1.0, "extra_info": "ACTIVE", "professors": ["Ann"], "professor_emails": ["a@x"],
        "crn": str(crn), "crns": [str(c) for c in crns], "primary_crn": None, "course_code": code, "subject": code.split()[0], "number": code.split()[1], "section": "1",
        "meetings": [{"days_of_week": 2, "start_time": "9:00", "end_time": "10:00", "location": "WLH 201", "location_url": "u"}, {"days_of_week": 8, "start_time": "9:00", "end_time": "10:00", "location": "WLH 201", "location_url": "u"}],
        "skills": ["WR"], "areas": [], "flags": ["Fun"], "regnotes": None, "rp_attr": None, "classnotes": None, "final_exam": None, "course_home_url": None, "syllabus_url": None, "fysem": False, "sysem": False, "colsem": False,
    }
    return base | more


def evaluation(crn, season, rating):
    return {"crn": str(crn), "season": season, "enrolled": 10, "responses": 5, "extras": {"title": "t"},
            "ratings": [{"question_code": "YC401", "question_text": "What is your overall assessment of this course?", "options": ["1", "2", "3", "4", "5"], "data": rating}],
            "narratives": [{"question_code": "YC409", "question_text": "Summarize", "comments": ["ok", "good course", "fine", "fine"]}]}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    for kind in ("parsed_courses", "parsed_evaluations", "evaluation_summaries"):
        (d / kind).mkdir()
    (d / "parsed_courses/202301.json").write_text(json.dumps([course(10, [10, 11], "AA 1", "Intro"), course(11, [10, 11], "BB 1", "Intro", school="GS")]))
    (d / "parsed_courses/202303.json").write_text(json.dumps([course(20, [20], "AA 1", "Intro", section="")]))
    (d / "parsed_evaluations/202301.json").write_text(json.dumps([evaluation(10, "202301", [0, 0, 0, 0, 2]), evaluation(99, "202301", [1] * 5)]))
    (d / "parsed_evaluations/202303.json").write_text(json.dumps([evaluation(20, "202303", [0, 0, 2, 0, 0])]))
    (d / "evaluation_summaries/202301.json").write_text(json.dumps([{"crn": "10", "season": "202301", "narrative_summaries": [{"question_code": "YC409", "question_text": "q", "summary": "s"}]}, {"crn": "bad", "season": "202301", "narrative_summaries": []}]))
    return d


@pytest.fixture(scope="module")
def tables(spark, landing):
    out, bad = pipeline.transform(spark, f"file://{landing}")
    assert {k: v.collect() for k, v in bad.items() if v.count()} == {}
    return out


def test_transform(spark, tables):
    courses = {c.course_id: c for c in tables["courses"].collect()}
    a, b = courses[230100010], courses[230300020]
    assert (a.same_course_id, b.same_course_id, b.last_offered_course_id, b.last_enrollment) == (230100010, 230100010, 230100010, 10)
    assert (a.average_rating, a.average_rating_n, b.section, b.last_enrollment_same_professors) == (4.0, 2, "0", True)
    assert tables["listings"].count() == 3 and tables["professors"].first().courses_taught == 2
    assert {(m.days_of_week, m._building_code, m._room) for m in tables["course_meetings"].collect()} == {(10, "WLH", "201")}
    assert sorted((n.course_id, n.response_number, n.comment) for n in tables["evaluation_narratives"].collect()) == [(230100010, 0, "good course"), (230100010, 1, "fine"), (230300020, 0, "good course"), (230300020, 1, "fine")]
    assert [tuple(s) for s in tables["evaluation_narrative_summaries"].collect()] == [(230100010, "YC409", "s")]
    assert {q.question_code: q.tag for q in tables["evaluation_questions"].collect()} == {"YC401": "Overall", "YC409": "Summary"}


def test_sync_and_changelog(spark, tables, tmp_path):
    w = io.Warehouse(spark, f"file://{tmp_path}/w")
    version, _ = pipeline.sync(spark, tables, w)
    from pyspark.sql import functions as F

    changed = {**tables, "courses": tables["courses"].where("course_id = 230300020").withColumn("title", F.lit("Renamed")), "listings": tables["listings"].where("course_id = 230300020")}
    changed["course_professors"] = tables["course_professors"].where("course_id < 0")
    second, log = pipeline.sync(spark, changed, w)
    text = "\n".join(r.line for r in log.orderBy("at").collect())
    assert (version, second) == (1, 2) and w.versions() == [1, 2]
    assert "title: Intro → Renamed" in text and "Professors: Ann → N/A" in text and "### Removals" in text
    now = w.read()
    assert now["courses"].count() == 2 and now["listings"].count() == 1  # courses are never deleted
    assert {r.location_id for r in now["course_meetings"].collect()} == {1}
    same, log = pipeline.sync(spark, {t: df.drop("time_added", "last_updated") for t, df in changed.items()}, w)
    assert "- listings" not in "\n".join(r.line for r in log.collect())


def test_rewrite_resolves_places(spark, tables, tmp_path):
    w = io.Warehouse(spark, f"file://{tmp_path}/w")
    w.write(pipeline.rewritten(spark, tables))
    now = w.read()
    assert {r.location_id for r in now["course_meetings"].collect()} == {1} and "_room" not in now["course_meetings"].columns
    assert now["courses"].where("time_added is null").count() == 0


def test_id_caches_are_stable(spark, landing, tables):
    pipeline.save_caches(spark, tables, f"file://{landing}")
    again, _ = pipeline.transform(spark, f"file://{landing}")
    assert again["professors"].select("professor_id", "name").collect() == tables["professors"].select("professor_id", "name").collect()


def test_raw_courses(spark):
    raw = [{"crn": "5", "code": "DRST 001", "title": "T\r", "description": '<p>Hi</p><p class="prerequisites">None</p>', "col": "YC", "credit_html": "", "hours": "2", "stat": "C", "instructordetail_html": "", "xlist": '<a data-action="result-detail" data-key="crn:6">', "section": "01",
            "meeting_html": '<div class="meet">MW 1pm-2pm</div>', "allInGroup": None, "yc_attrs": "Writing Humanities", "ci_attrs": "<a>Flag</a>", "regnotes": "", "rp_attr": "x  y", "clssnotes": None, "final_exam": "", "resources": '<a href="h">HOMEPAGE</a>'}, {"crn": "6", "code": "BAD"}]
    second = spark.createDataFrame([("5", "DRST 001", "01", "MAIN 1", "t"), ("6", "MAIN 1", "01", None, "t")], io.SECOND_SOURCE)
    df = spark.createDataFrame([{k: r.get(k) for k in raw[0]} for r in raw], io.RAW_COURSE)
    out, rejects = parse.parse_courses(df, "202401", second, spark.createDataFrame([("9",)], "crn string"))
    c = out.first()
    assert (c.title, c.credits, c.extra_info, c.crns, c.primary_crn, c.section, c.fysem, c.course_home_url) == ("T", 2.0, "CANCELLED", ["5", "6"], "6", "1", True, "h")
    assert (c.description, c.requirements, c.skills, c.areas, c.flags, c.rp_attr, c.regnotes) == ("Hi", "None", ["WR"], ["Hu"], ["Flag"], "x y", None)
    assert out.count() == 1 and rejects.first().crn == "6"


def test_seasons_and_args(tmp_path):
    known = ["202101", "202102", "202103"]
    assert io.resolve_seasons(None, known) == known and io.resolve_seasons(["LATEST_2"], known) == known[1:]
    assert io.resolve_seasons(["202999"], None) == ["202999"]
    with pytest.raises(io.InvalidSeasonError):
        io.resolve_seasons(["202999"], known)
    (tmp_path / "c.json").write_text('{"data_dir": "from file", "warehouse": "w"}')
    cfg = io.parse_args(["--config-file", str(tmp_path / "c.json"), "--data-dir", "from cli", "--release", "--snapshot-tables"], {"WAREHOUSE": "env", "SAVE_CONFIG": "s"})
    assert (cfg.data_dir, cfg.warehouse, cfg.save_config, cfg.use_cache, cfg.transform) == ("from cli", "w", "s", False, True)


def test_prompts_and_summaries(spark):
    evals = spark.createDataFrame([("1", "s", [("Q", "Why?", ["aaa", "bbb", "ccc"]), ("R", "How?", ["x"])]), ("2", "s", []), ("3", "s", [("Q", "Why?", ["a", "b", "c"])])], "crn string, season string, narratives array<struct<question_code:string,question_text:string,comments:array<string>>>")
    done = spark.createDataFrame([("s", "3", [("Q", "Why?", "said")]), ("s", "9", [])], "season string, crn string, narrative_summaries array<struct<question_code:string,question_text:string,summary:string>>")
    asked = evaluations.prompts(evals, done)
    assert [r.prompt for r in asked.collect()] == ["Evaluation question: Why?\n\nStudent comments (3 total):\naaa\n---\nbbb\n---\nccc"]
    made = evaluations.summarize(asked, lambda m: m[1]["content"][:10])
    assert [(r.crn, r.summary, r.error) for r in made.collect()] == [("1", "Evaluation", None)]
    out = {r.crn: [s.summary for s in r.narrative_summaries] for r in evaluations.with_summaries(done, made).collect()}
    assert out == {"1": ["Evaluation"], "3": ["said"], "9": []}


def test_calls_are_made_once_over_failures_and_runs(spark, tmp_path):
    """A task that fails and is run again, and a second run, ask only for what is not in the ledger."""
    said = [("Q", "Why?", ["aaa", "bbb", "ccc"]), ("R", "How?", ["a", "b", "c"])]
    evals = spark.createDataFrame([(str(i), "s", said) for i in range(6)], "crn string, season string, narratives array<struct<question_code:string,question_text:string,comments:array<string>>>")
    evals = evals.withColumn("narratives", F.transform("narratives", lambda n: n.withField("question_text", F.concat(n.question_text, F.lit(" of "), F.col("crn")))))
    calls = tmp_path / "calls"
    calls.mkdir()
    ledger = f"file://{tmp_path}/ledger"

    def complete(messages, failing=True):
        text = messages[1]["content"]
        number = len(list(calls.iterdir()))
        (calls / f"{number}-{uuid.uuid4().hex}").write_text(text)
        if failing and "Why? of 3" in text:
            raise KeyError("lost")
        if failing and "How? of 2" in text:
            raise RateLimited("later")
        return text[:30]

    asked = evaluations.prompts(evals)
    with pytest.raises(Exception, match="lost"):
        evaluations.summarize(asked, complete, 2, ledger).collect()
    before = [f.read_text() for f in calls.iterdir()]
    made = evaluations.summarize(asked, lambda m: complete(m, False), 2, ledger).collect()
    assert len(made) == 12 and all(r.error is None for r in made)
    after = [f.read_text() for f in calls.iterdir()]
    answered = [t for t in before if "Why? of 3" not in t and "How? of 2" not in t]
    assert all(after.count(t) == 1 for t in answered) and answered
    many = len(after)
    evaluations.summarize(asked, complete, 2, ledger).collect()
    assert len(list(calls.iterdir())) == many
    put_off = evaluations.summarize(asked.where("crn = '2'"), complete, 1).collect()
    assert sorted((r.question_code, r.error is None) for r in put_off) == [("Q", True), ("R", False)]


def test_environment_values_have_types():
    cfg = io.parse_args([], {"RELEASE": "0", "DEBUG": "false", "PARSE": "no", "TRANSFORM": "yes", "SEASONS": "202401,202403", "FETCH_CONCURRENCY": "3", "MAX_COURSES_PER_SEASON": ""})
    assert (cfg.release, cfg.debug, cfg.parse, cfg.transform, cfg.seasons, cfg.fetch_concurrency, cfg.max_courses_per_season) == (False, False, False, True, ["202401", "202403"], 3, None)
    with pytest.raises(ValueError, match="neither"):
        io.parse_args([], {"DEBUG": "perhaps"})


def test_changed_files_are_told_by_the_ledger(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for s in ("202401", "202402", "202403"):
        (raw / f"{s}.json").write_text(f'[{{"crn": "{s}"}}]')
    at, path = f"file://{tmp_path}/ledger", f"file://{raw}"
    assert io.changed_seasons(io.landed_now(spark, [path], io.read_ledger(spark, at)), io.read_ledger(spark, at)) == {"202401", "202402", "202403"}
    io.write_ledger(io.landed_now(spark, [path, f"file://{tmp_path}/absent"], io.read_ledger(spark, at)), at)
    assert io.changed_seasons(io.landed_now(spark, [path], io.read_ledger(spark, at)), io.read_ledger(spark, at)) == set()
    os.utime(raw / "202401.json", (1, 1))  # another time, the same contents
    (raw / "202402.json").write_text('[{"crn": "new"}]')
    (raw / "202403.json").unlink()
    assert io.changed_seasons(io.landed_now(spark, [path], io.read_ledger(spark, at)), io.read_ledger(spark, at)) == {"202402", "202403"}

def test_streaming_merge(spark, tmp_path):
    from corvine.streaming.incremental import merge_into, read_landing

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"code": "A", "building_name": "x"}\n{"code": "B", "building_name": "y"}\n')
    w = io.Warehouse(spark, f"file://{tmp_path}/w")
    for n in range(2):
        stream = read_landing(spark, f"file://{tmp_path}/in", "code string, building_name string")
        merge_into(w, "buildings", ["code"], stream, f"file://{tmp_path}/cp").awaitTermination()
        (tmp_path / "in/b.json").write_text('{"code": "B", "building_name": "z"}\n')
    assert sorted(tuple(r) for r in w.read()["buildings"].collect()) == [("A", "x"), ("B", "z")]


def page(enrolled, comments):
    rows = "".join(f"<tr><td>{n}</td><td>{c}</td></tr>" for n, c in enumerate(comments, 1))
    return (
        f'<div id="courseHeader"><div class="row"><div>x</div><div><span>a</span><span>Title</span></div><div><div class="row"><div>e</div><div>{enrolled}</div></div><div class="row"><div>r</div><div>3</div></div></div></div></div>'
        '<table id="questions"><tbody><tr id="questionRow0"><td>1</td><td class="Question">Summarize this</td><td>YC409</td><td class="Responses"><span class="show-for-print">Narrative</span></td></tr></tbody></table>'
        f'<table id="answers0"><tbody>{rows}</tbody></table>'
    )


def test_run_from_landing_files_to_warehouse(spark, tmp_path):
    raw = {"crn": "5", "code": "AB 101", "title": "Intro", "description": "<p>Hi</p>", "col": "YC", "credit_html": "", "hours": "1", "stat": "A", "instructordetail_html": '<div class="instructor-detail"><div class="instructor-name">Ann</div><div class="instructor-email">a@x</div></div>', "xlist": "", "section": "01",
           "meeting_html": '<div class="meet">MW 1pm-2pm in <a href="u">WLH 201</a></div>', "allInGroup": None, "yc_attrs": "", "ci_attrs": "", "regnotes": "", "rp_attr": "", "clssnotes": None, "final_exam": "", "resources": ""}
    (tmp_path / "raw_courses").mkdir()
    (tmp_path / "rules").mkdir()
    broken = raw | {"crn": "7", "code": "AB 103", "meeting_html": '<div class="meet">MW</div>'}
    (tmp_path / "raw_courses/202401.json").write_text(json.dumps([raw, raw | {"crn": "6", "code": "AB 102", "title": "Other"}, raw | {"crn": "8", "code": "AB 104"}, broken]))
    (tmp_path / "raw_courses/202403.json").write_text(json.dumps([raw]))
    (tmp_path / "rules/identical.json").write_text(json.dumps({"season_code": "202401", "keep": 5, "drop": 8}))
    pages = [("5", "202401", page(12, ["good one", "bad one", "so so"])), ("6", "202401", None)]
    spark.createDataFrame(pages, "crn string, season string, page string").write.parquet(f"file://{tmp_path}/evaluation_pages")
    base = ["--data-dir", f"file://{tmp_path}"]
    asked = []

    def complete(messages):
        asked.append(1)
        return "short"

    with pytest.raises(ValueError, match="function"):
        pipeline.run(spark, io.parse_args([*base, "--summarize-evals", "--seasons", "202401"]))
    pipeline.run(spark, io.parse_args([*base, "--parse", "--seasons", "202401"]))
    assert io.list_seasons(spark, f"file://{tmp_path}/parsed_courses") == ["202401"]
    assert [r.crn for r in spark.read.parquet(f"file://{tmp_path}/rejects/202401").collect()] == ["7"]
    pipeline.run(spark, io.parse_args([*base, "--parse", "--sync-db-courses", "--sync-db-evals", "--summarize-evals", "--save-config", str(tmp_path / "used.yml")]), complete)
    assert spark.read.text(f"file://{tmp_path}/updated_seasons").first().value == "202403"  # the other one was parsed before
    w = io.Warehouse(spark, f"file://{tmp_path}/warehouse")
    now = w.read()
    assert w.missing() == [] and sorted(r.crn for r in now["listings"].collect()) == [5, 5, 6]
    assert {(r.days_of_week, r.location_id) for r in now["course_meetings"].collect()} == {(10, 1)} and now["evaluation_narratives"].count() == 3
    kept = io.read_json(spark, f"file://{tmp_path}/evaluation_summaries", io.SUMMARY).collect()
    assert [(r.crn, r._season, r.narrative_summaries[0].summary) for r in kept] == [("5", "202401", "short")]
    assert "data_dir:" in (tmp_path / "used.yml").read_text()
    (tmp_path / "raw_courses/202403.json").write_text(json.dumps([raw, raw | {"crn": "9", "code": "AB 109", "title": "New"}]))
    pipeline.run(spark, io.parse_args([*base, "--parse"]))
    assert spark.read.text(f"file://{tmp_path}/updated_seasons").first().value == "202403"  # its file changed
    pipeline.run(spark, io.parse_args([*base, "--sync-db-courses"]))
    # the evaluation tables are those of the version before, by name
    assert sorted(r.crn for r in w.read()["listings"].collect()) == [5, 5, 6, 9]
    assert w.read()["evaluation_narrative_summaries"].count() == 0 and len(list((tmp_path / "warehouse").glob("v*/evaluation_narratives"))) == 1
    assert len(list((tmp_path / "warehouse").glob("v*/flags"))) == 1  # nothing differs: not written again
    pipeline.run(spark, io.parse_args([*base, "--sync-db-evals"]))
    log = [r.value for f in sorted((tmp_path / "change_log").iterdir()) for r in spark.read.text(f"file://{f}").collect()]
    assert "## Summary" in log and w.versions() == [1, 2, 3, 4]
    assert w.read()["evaluation_narrative_summaries"].count() == 1
    assert "evaluation_narrative_summaries" not in w.read(1) and w.read(3)["evaluation_narrative_summaries"].count() == 0


def test_run_from_an_empty_folder(spark, tmp_path):
    raw = {"crn": "5", "code": "AB 101", "title": "Intro", "description": "<p>Hi</p>", "col": "YC", "credit_html": "", "hours": "1", "stat": "A", "instructordetail_html": "", "xlist": "", "section": "01",
           "meeting_html": '<div class="meet">MW 1pm-2pm in <a href="u">WLH 201</a></div>', "allInGroup": None, "yc_attrs": "", "ci_attrs": "", "regnotes": "", "rp_attr": "", "clssnotes": None, "final_exam": "", "resources": ""}
    log = tmp_path / "asked"
    log.mkdir()

    def fetch(kind, request):
        (log / uuid.uuid4().hex).write_text(f"{kind} {request.get('season', request.get('season_code'))} {request.get('crn')} {request.get('first_year')}")
        if kind == "seasons":
            return '<option value="999999">all</option><option value="202401">x</option><option value="202403">y</option>'
        if kind == "courses":
            both = [raw, raw | {"crn": "6", "code": "AB 102", "title": "Other"}]
            return both[:1] if request.get("first_year") else both
        if kind == "school":
            return request["crn"] == "5"
        return page(7, ["good one", "bad one", "so so"])

    def asked(kind):
        return sorted(f.read_text() for f in log.iterdir() if f.read_text().startswith(kind))

    base = ["--data-dir", f"file://{tmp_path}/data", "--seasons", "202401"]
    with pytest.raises(ValueError, match="fetches"):
        pipeline.run(spark, io.parse_args([*base, "--crawl-classes"]))
    flags = ["--crawl-classes", "--crawl-evals", "--parse", "--sync-db-courses", "--sync-db-evals"]
    pipeline.run(spark, io.parse_args([*base, *flags]), fetch=fetch)
    now = io.Warehouse(spark, f"file://{tmp_path}/data/warehouse").read()
    assert sorted((r.crn, r.season_code) for r in now["listings"].collect()) == [(5, "202401"), (6, "202401")]
    assert now["evaluation_narratives"].count() == 3
    assert asked("courses") == ["courses 202401 None None", "courses 202401 None True"]
    assert asked("school") == ["school 202401 5 None", "school 202401 6 None"] and asked("evaluation") == ["evaluation 202401 5 None"]
    many = len(list(log.iterdir()))
    pipeline.run(spark, io.parse_args([*base, "--crawl-classes", "--crawl-evals"]), fetch=fetch)
    assert len(list(log.iterdir())) == many  # all of it has landed


def test_versions_share_tables_and_batches_are_written_once(spark, tmp_path):
    w = io.Warehouse(spark, f"file://{tmp_path}/w")
    a = spark.createDataFrame([("A", "x")], "code string, building_name string")
    assert w.write({"buildings": a, "flags": spark.createDataFrame([(1, "f")], "flag_id long, flag_text string")}) == 1
    assert w.write({"buildings": a}, batch="b#0") == 2 and w.write({"buildings": a}, batch="b#0") == 2
    assert len(list((tmp_path / "w").glob("v*/flags"))) == 1 and set(w.read()) == {"buildings", "flags"}
