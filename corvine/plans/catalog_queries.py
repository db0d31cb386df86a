"""Registered queries of the catalog's own path: landing records made of the driver's tables go through the library's
parsers, importers, linkage and merges, and the SQL twins give what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions import html as H
from ..functions import scalars as S
from ..operators import checks, diff, linkage, metrics, running, tables
from ..sources import crawl, io
from ..sources.spool import Spool
from . import evaluations, parse, queries
from .queries import _OFF, GROUPED, ORACLE, QUERIES, dealt, offerings, query, t

__all__ = ["ORACLE", "QUERIES", "queries"]

# cross-listings and courses


@query(f"""with {_OFF}, l as (select course_id as crn, grp, season_code, o_orderpriority as code, case when enrolled is not null then 'YC' else 'GS' end as school, min(course_id) over (partition by grp, season_code) as least from off),
c as (select *, (cast(season_code as bigint) - 200000) * 100000 + least as course_id from l)
select course_id, season_code, code as course_code, school, crn from c qualify row_number() over (partition by course_id order by (school = 'YC') desc, code, crn) = 1""")
def cross_listed_courses(spark, d):
    o = offerings(spark, d).select(F.col("course_id").alias("crn"), "grp", "season_code", F.col("o_orderpriority").alias("course_code"), F.when(F.col("enrolled").isNotNull(), "YC").otherwise("GS").alias("school"))
    sets = o.groupBy("grp", "season_code").agg(F.collect_set("crn").alias("crns"))
    listings = o.join(sets, ["grp", "season_code"]).withColumn("primary_crn", F.lit(None).cast("long"))
    _, courses = linkage.resolve_cross_listings(listings, "crn")
    return courses.select("course_id", "season_code", "course_code", "school", "crn")


@query("""with l as (select l_suppkey % 10 as season, l_partkey as crn, array_agg(distinct l_linenumber) as crns from lineitem group by 1, 2), g as (select unnest([1, 2, 3]) as season, unnest([5, 2, 2]) as gone)
select cast(l.season as varchar) as season_code, l.crn, list_aggregate(list_sort([x for x in l.crns if x is distinct from g.gone]), 'string_agg', ',') as crns from l left join g on l.season = g.season where l.crn is distinct from g.gone""")
def identical_listings(spark, d):
    li = t(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 10).cast("string").alias("season_code"), F.col("l_partkey").cast("int").alias("crn")).agg(F.collect_set("l_linenumber").alias("crns"))
    same = spark.createDataFrame([("1", 1, 5), ("2", 1, 2), ("3", 1, 2)], "season_code string, keep int, drop int")
    out = linkage.drop_identical(li, same)
    text = F.array_join(F.transform(F.array_sort("crns"), lambda x: x.cast("string")), ",")
    return out.select("season_code", F.col("crn").cast("long").alias("crn"), F.when(text != "", text).alias("crns"))


@query("""with m as (select l_orderkey as course_id, cast(l_linenumber % 2 as varchar) as start_time, case when l_suppkey % 5 = 0 then null else 'B' || cast(l_suppkey % 4 as varchar) end as code, case when l_suppkey % 5 <> 0 then cast(l_partkey % 3 as varchar) end as room, 1 << cast(l_linenumber % 7 as integer) as d from lineitem)
select course_id, start_time, code as _building_code, room as _room, cast(bit_or(d) as integer) as days_of_week from m group by 1, 2, 3, 4""")
def meetings_bridge(spark, d):
    li = tables.spread(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"), GROUPED, "l_orderkey")
    place = F.when(F.col("l_suppkey") % 5 == 0, "TBA").otherwise(F.concat(F.lit("B"), (F.col("l_suppkey") % 4).cast("string"), F.lit(" "), (F.col("l_partkey") % 3).cast("string")))
    one = F.struct(F.call_function("shiftleft", F.lit(1), (F.col("l_linenumber") % 7).cast("int")).alias("days_of_week"), (F.col("l_linenumber") % 2).cast("string").alias("start_time"), F.lit("x").alias("end_time"), place.alias("location"), F.lit("").alias("location_url"))
    courses = li.groupBy(F.col("l_orderkey").alias("course_id")).agg(F.collect_list(one).alias("meetings"))
    return linkage.course_meetings(courses).select("course_id", "start_time", "_building_code", "_room", "days_of_week")


@query("""with lab as (select p_partkey as course_id, min(p_partkey) over (partition by p_type) as label, p_type, p_size from part),
h as (select *, case when p_size <= 20 then 0 when p_size <= 40 then 1 end as part from lab), ok as (select label, count(distinct part) = 2 and bool_and(part is not null) as fits, count(distinct part) = 2 as matches from h group by 1)
select course_id, min(course_id) over (partition by h.label, case when matches then coalesce(part, -1) else -1 end) as label, matches and part is null as wrong from h join ok on h.label = ok.label""")
def split_sets(spark, d):
    p = t(spark, d, "part")
    code = F.when(F.col("p_size") <= 20, "AA 1").when(F.col("p_size") <= 40, "AA 2").otherwise("AA 3")
    codes = p.select(F.col("p_partkey").alias("course_id"), F.lit("202001").alias("season_code"), code.alias("code"))
    first = p.groupBy("p_type").agg(F.min("p_partkey").alias("label"))
    specs = linkage.split_specs(spark, [[["AA 1"], ["AA 2"]]])
    new, bad = linkage.split_labels(p.join(first, "p_type").select(F.col("p_partkey").alias("course_id"), "label"), codes, specs)
    wrong = bad.select("course_id").withColumn("wrong", F.lit(True))
    return new.join(wrong, "course_id", "left").withColumn("wrong", F.coalesce("wrong", F.lit(False)))


# id caches


@query("""with f as (select c_custkey, c_name as name, case when c_nationkey % 2 = 0 then c_mktsegment end as email from customer), k as (select case when email is null then name else name || ' <' || email || '>' end as key, name, email, c_custkey as id from f)
select key, id from k where key not in (select name from k where email is not null)""")
def saved_professor_ids(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("professor_id"), F.col("c_name").alias("name"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).alias("email"))
    return linkage.saved_professor_keys(c)


@query("""with a as (select c_name as key, c_custkey as id from customer where c_custkey % 3 <> 0), b as (select c_name as key, case when c_custkey % 10 = 0 then c_custkey + 1 else c_custkey end as id from customer where c_custkey % 2 = 0)
select 'conflict' as what, a.key, b.id from a join b on a.key = b.key where a.id <> b.id union all select 'merged', key, id from (select key, max(id) as id from (select * from a where key not in (select key from b) union all select * from b) group by key)""")
def cache_merge(spark, d):
    c = t(spark, d, "customer").select(F.col("c_name").alias("key"), F.col("c_custkey").alias("id"))
    old, new = c.where("id % 3 <> 0"), c.where("id % 2 = 0").withColumn("id", F.when(F.col("id") % 10 == 0, F.col("id") + 1).otherwise(F.col("id")))
    conflicts = tables.cache_conflicts(old, new)
    merged = tables.merged_cache(old.join(conflicts, "key", "left_anti"), new)
    return new.join(conflicts, "key", "left_semi").select(F.lit("conflict").alias("what"), "key", "id").union(merged.select(F.lit("merged"), "key", "id"))


# HTML of raw courses


def _fragment(text):
    """`text` with {columns} in it, as a Column."""
    out = []
    for n, piece in enumerate(text.replace("}", "{").split("{")):
        out.append(F.col(piece).cast("string") if n % 2 else F.lit(piece))
    return F.concat(*out)


@query("""select p_partkey, case when p_size % 5 = 0 then '' when p_name < p_brand then p_name || ' <' || p_type || '>,' || p_brand || ' <>' else p_brand || ' <>,' || p_name || ' <' || p_type || '>' end as people, case when p_size % 3 = 0 then cast(p_size as varchar) else '' end as crns from part""")
def html_people_and_listings(spark, d):
    one = '<div class="instructor-detail"><div class="instructor-name">{p_name}</div><div class="instructor-email">{p_type}</div></div>'
    both = _fragment(one + '<div class="instructor-detail"><div class="instructor-name">{p_brand}</div></div>')
    staff = F.lit('<div class="instructor-detail"><div class="instructor-name">Staff</div></div>')
    key = F.when(F.col("p_size") % 3 == 0, "crn:").otherwise("other:")
    links = F.concat(F.lit('<p><a data-action="result-detail" data-key="'), key, F.col("p_size").cast("string"), F.lit('">x</a><a data-key="crn:9">y</a></p>'))
    p = dealt(spark, d, "part").select("p_partkey", H.instructors_of(F.when(F.col("p_size") % 5 == 0, staff).otherwise(both)).alias("i"), H.cross_listings_of(links).alias("c"))
    return p.select("p_partkey", F.array_join(F.transform("i", lambda x: F.concat(x["name"], F.lit(" <"), x["email"], F.lit(">"))), ",").alias("people"), F.array_join("c", ",").alias("crns"))


@query("""select p_partkey, case p_size % 4 when 0 then '10|13:' || lpad(cast(p_size as varchar), 2, '0') || '|14:00|' || p_brand || ' 1|u' when 1 then '20|9:30|10:45||' when 2 then '' else '2|9:00|10:50||' end as meeting from part""")
def html_meetings(spark, d):
    k, minute = F.col("p_size") % 4, F.lpad(F.col("p_size").cast("string"), 2, "0")
    shown = F.concat(F.lit('<div class="meet">MW 1:'), minute, F.lit('pm-2pm in <a href="u">'), F.col("p_brand"), F.lit(" 1</a></div>"))
    page = F.when(k == 0, shown).when(k == 1, '<div class="meet">TTh 9:30am-10:45am</div>').when(k == 2, '<div class="meet">HTBA</div>').otherwise("")
    group = F.when(k == 3, F.array(F.struct(F.lit("M 9am-10:50am").alias("meets"), F.lit('[{"meet_day": "0", "start_time": "900", "end_time": "1050"}]').alias("meetingTimes"))))
    p = dealt(spark, d, "part").select("p_partkey", H.meetings_of(page, group)["meetings"].alias("m"))
    line = F.transform("m", lambda m: F.concat_ws("|", m["days_of_week"].cast("string"), m["start_time"], m["end_time"], m["location"], m["location_url"]))
    return p.select("p_partkey", F.array_join(line, ";").alias("meeting"))


@query("""select p_partkey, case when p_size % 2 = 0 then 'Needs ' || p_brand else '' end as requirements, 'About ' || p_name as description, p_type || ' & more' as note from part""")
def html_descriptions(spark, d):
    needs = F.when(F.col("p_size") % 2 == 0, _fragment('<p class="prerequisites">Needs {p_brand}</p>')).otherwise("")
    p = dealt(spark, d, "part").select("p_partkey", H.description_of(F.concat(_fragment("<p>About <b>{p_name}</b>\r</p>"), needs)).alias("x"), H.note_of(_fragment("<i>{p_type}</i>  &amp; more")).alias("note"))
    return p.select("p_partkey", "x.requirements", "x.description", "note")


_RAW = """r as (select p_partkey, cast(p_partkey as varchar) as crn, case when p_partkey % 17 = 0 then 'NOSPACE' else 'AB ' || cast(p_size as varchar) end as code, p_partkey % 19 = 0 as broken from part)"""


def _raw(spark, d):
    k = F.col("p_partkey")
    none = F.lit(None).cast("string")
    meets = F.when(k % 19 == 0, '<div class="meet">MW</div>').otherwise('<div class="meet">MW 1pm-2pm</div>')
    return dealt(spark, d, "part").select(
        k.cast("string").alias("crn"), F.when(k % 17 == 0, "NOSPACE").otherwise(F.concat(F.lit("AB "), F.col("p_size").cast("string"))).alias("code"), F.concat("p_name", F.lit("\r")).alias("title"),
        _fragment("<p>{p_type}</p>").alias("description"), F.lit("YC").alias("col"), F.lit("").alias("credit_html"), F.col("p_size").cast("string").alias("hours"), F.when(k % 3 == 0, "C").otherwise("A").alias("stat"),
        F.lit("").alias("instructordetail_html"), F.concat(F.lit('<a data-action="result-detail" data-key="crn:'), (k + 1).cast("string"), F.lit('">')).alias("xlist"), F.lit("01").alias("section"), meets.alias("meeting_html"),
        F.lit(None).cast("array<struct<meets:string,meetingTimes:string>>").alias("allInGroup"), F.lit("Writing Humanities").alias("yc_attrs"), F.lit("<a>Flag</a>").alias("ci_attrs"), F.lit("").alias("regnotes"), none.alias("rp_attr"),
        none.alias("clssnotes"), F.lit("").alias("final_exam"), _fragment('<a href="{p_brand}">HOMEPAGE</a>').alias("resources"),
    )


@query(f"""with {_RAW} select r.crn, 'AB ' || cast(p_size as varchar) as course_code, p_name as title, p_type as description, cast(p_size as double) as credits, case when r.p_partkey % 3 = 0 then 'CANCELLED' else 'ACTIVE' end as extra_info,
r.crn || ',' || cast(r.p_partkey + 1 as varchar) as crns, '1' as section, '10 13:00 14:00' as meeting, 'WR' as skills, 'Hu' as areas, 'Flag' as flags, p_brand as course_home_url, cast(null as varchar) as regnotes from r join part on r.p_partkey = part.p_partkey where contains(code, ' ') and not broken""")
def parsed_courses(spark, d):
    out, _ = parse.parse_courses(_raw(spark, d), "202401")
    m = F.element_at("meetings", 1)
    return out.select("crn", "course_code", "title", "description", "credits", "extra_info", F.array_join("crns", ",").alias("crns"), "section", F.concat_ws(" ", m["days_of_week"].cast("string"), m["start_time"], m["end_time"]).alias("meeting"), F.array_join("skills", ",").alias("skills"), F.array_join("areas", ",").alias("areas"), F.array_join("flags", ",").alias("flags"), "course_home_url", "regnotes")


@query(f"with {_RAW} select crn, code, case when not contains(code, ' ') then 'course' else 'meetings' end as why from r where not contains(code, ' ') or broken")
def rejected_courses(spark, d):
    _, rejects = parse.parse_courses(_raw(spark, d), "202401")
    return rejects.select("crn", "code", F.split("error", " ")[0].alias("why"))


# evaluations


def _pages(spark, d):
    """A page for each part: two questions; every seventh has no header, every fifth no questions."""
    head = '<div id="courseHeader"><div class="row"><div>x</div><div><span>a</span><span>{p_name}</span></div><div><div class="row"><div>e</div><div>{p_size}</div></div><div class="row"><div>r</div><div>3</div></div></div></div></div>'
    body = (
        '<table id="questions"><tbody><tr id="questionRow0"><td>1</td><td class="Question">Rate AB 12 of {p_brand}</td><td>YC401</td><td class="Responses"><span class="show-for-print">Rating</span></td></tr>'
        '<tr id="questionRow1"><td>2</td><td class="Question">Why?</td><td>YC409</td><td class="Responses"><span class="show-for-print">Narrative</span></td></tr></tbody></table>'
        '<table id="answers0"><tbody><tr><td>low</td><td>1</td></tr><tr><td>high</td><td>{p_size}</td></tr></tbody></table><table id="answers1"><tbody><tr><td>1</td><td>{p_type}</td></tr><tr><td>2</td><td>ok</td></tr></tbody></table>'
    )
    k = F.col("p_partkey")
    page = F.when(k % 7 == 0, "<p>sign in</p>").when(k % 5 == 0, _fragment(head)).otherwise(_fragment(head + body))
    return dealt(spark, d, "part").select(k.cast("string").alias("crn"), F.lit("202401").alias("season"), page.alias("page"))


@query("""select cast(p_partkey as varchar) as crn, p_size as enrolled, 3 as responses, p_name as title, p_partkey % 5 = 0 as not_viewable, case when p_partkey % 5 = 0 then '' else 'Rate this course of ' || p_brand || ': low=1,high=' || cast(p_size as varchar) end as ratings, case when p_partkey % 5 = 0 then '' else 'Why?: ' || p_type || '/ok' end as narratives from part where p_partkey % 7 <> 0""")
def parsed_evaluations(spark, d):
    r = H.parse_evaluations(_pages(spark, d))
    text = lambda q: F.concat(q["question_text"], F.lit(": "), F.array_join(F.zip_with(q["options"], q["data"], lambda o, n: F.concat(o, F.lit("="), n.cast("string"))), ","))
    said = lambda q: F.concat(q["question_text"], F.lit(": "), F.array_join(q["comments"], "/"))
    return r.select("crn", "enrolled", "responses", "title", F.col("not_viewable").isNotNull().alias("not_viewable"), F.array_join(F.transform("ratings", text), ";").alias("ratings"), F.array_join(F.transform("narratives", said), ";").alias("narratives"))


def _told(spark, d):
    """Conversations as evaluations: roles are questions, turns are comments; those of odd number have a listing."""
    c = t(spark, d, "conversations")
    each = c.groupBy("conv_id", "role").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("comments"), F.max("turn").alias("last"))
    q = F.struct(F.col("role").alias("question_code"), F.concat(F.lit("About "), "role").alias("question_text"), "comments")
    rate = F.array(F.struct(F.lit("R1").alias("question_code"), F.lit("Overall assessment").alias("question_text"), F.array(*[F.lit(x) for x in "abcde"]).alias("options"), F.array(F.lit(0), F.lit(1), F.lit(0), F.lit(0), F.size("narratives")).alias("data")))
    evals = each.groupBy("conv_id").agg(F.array_sort(F.collect_list(q)).alias("narratives"), F.max("last").cast("int").alias("enrolled"))
    evals = evals.select(F.col("conv_id").cast("string").alias("crn"), F.lit("202401").alias("season"), "enrolled", F.lit(None).cast("int").alias("responses"), rate.alias("ratings"), "narratives", F.lit("{}").alias("extras"), F.col("conv_id").alias("_ordinal"))
    listings = c.where("conv_id % 2 = 1").select(F.lit("202401").alias("season_code"), F.col("conv_id").cast("int").alias("crn"), (F.col("conv_id") * 10).alias("course_id")).distinct()
    return evaluations.import_evaluations(evals, listings)


@query("""with c as (select conv_id * 10 as course_id, role as question_code, text as comment, min(turn) as turn from conversations where conv_id % 2 = 1 and length(text) > 2 group by 1, 2, 3)
select course_id, question_code, cast(row_number() over (partition by course_id, question_code order by turn) - 1 as integer) as response_number, comment, cast(0 as double) as comment_compound from c""")
def imported_narratives(spark, d):
    n = _told(spark, d)[0]["evaluation_narratives"]
    return n.select("course_id", "question_code", "response_number", "comment", F.col("comment_compound").cast("double").alias("comment_compound"))


@query("""select question_code, question_text, is_narrative, n_options, tag from (select distinct role as question_code, 'About ' || role as question_text, true as is_narrative, cast(null as integer) as n_options, cast(null as varchar) as tag from conversations where conv_id % 2 = 1 union all select 'R1', 'Overall assessment', false, 5, 'Overall')""")
def imported_questions(spark, d):
    q = _told(spark, d)[0]["evaluation_questions"]
    return q.select("question_code", "question_text", "is_narrative", F.when(F.col("options").isNotNull(), F.size("options")).alias("n_options"), F.col("tag"))


@query("""with c as (select conv_id * 10 as course_id, max(turn) as enrolled, count(distinct role) as roles from conversations where conv_id % 2 = 1 group by 1)
select course_id, cast(enrolled as integer) as enrolled, '0,1,0,0,' || cast(roles as varchar) as rating, round((2 + 5 * roles) / (1 + roles), 6) as average from c""")
def imported_ratings(spark, d):
    found = _told(spark, d)[0]
    average = metrics.tagged_averages(found["evaluation_ratings"], found["evaluation_questions"], "Overall")
    rating = F.array_join(F.transform("rating", lambda x: x.cast("string")), ",")
    return found["evaluation_statistics"].select("course_id", "enrolled").join(found["evaluation_ratings"].select("course_id", rating.alias("rating")), "course_id").join(average.select("course_id", F.round("average", 6).alias("average")), "course_id", "left")


@query("""select conv_id * 10 as course_id, role as question_code, arg_min(text, turn) as summary from conversations where conv_id % 3 <> 0 and conv_id % 2 = 1 group by 1, 2""")
def imported_summaries(spark, d):
    c = t(spark, d, "conversations")
    first = c.groupBy("conv_id", "role").agg(F.min_by("text", "turn").alias("text"))
    crn = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("x"), F.col("conv_id").cast("string"))).otherwise(F.col("conv_id").cast("string"))
    made = first.groupBy("conv_id").agg(F.collect_list(F.struct(F.col("role").alias("question_code"), F.lit("q").alias("question_text"), F.col("text").alias("summary"))).alias("narrative_summaries"))
    made = made.select(crn.alias("crn"), F.lit("202401").alias("season"), "narrative_summaries", F.col("conv_id").alias("_ordinal"))
    listings = c.where("conv_id % 2 = 1").select(F.lit("202401").alias("season_code"), F.col("conv_id").alias("crn"), (F.col("conv_id") * 10).alias("course_id")).distinct()
    return evaluations.import_summaries(made, listings)


@query("""select p_brand as question_code, 'About ' || p_brand as question_text, arg_max(p_partkey % 2 = 0, (p_size, -p_partkey)) as is_narrative from part group by 1""")
def latest_questions(spark, d):
    p = t(spark, d, "part")
    asked = p.select(F.lpad(F.col("p_size").cast("string"), 3, "0").alias("season"), F.col("p_partkey").alias("_o"), F.col("p_brand").alias("question_code"), F.concat(F.lit("<b>About</b>  "), "p_brand").alias("question_text"), F.array("p_name").alias("options"), (F.col("p_partkey") % 2 == 0).alias("is_narrative"))
    return evaluations.questions_by_code(asked, "_o")[0].select("question_code", "question_text", "is_narrative")


@query("""with q as (select p_brand as question_code, count(*) as n, min(p_partkey) as first from part group by 1) select 'tags' as rule, question_code from q where n % 3 = 0 union all select 'categories', cast(first as varchar) from q where n % 2 = 1""")
def question_violations(spark, d):
    n = t(spark, d, "part").groupBy(F.col("p_brand").alias("question_code")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("course_id"))
    both = F.when(F.col("n") % 3 == 0, "engagement and workload").otherwise("engagement")
    q = n.select("question_code", both.alias("question_text"), F.lit(False).alias("is_narrative"), F.array().cast("array<string>").alias("options"))
    _, several = metrics.compute_questions(q)
    size = F.when(F.col("n") % 2 == 1, 6).otherwise(5)
    ratings = n.select("course_id", "question_code", F.array_repeat(F.lit(1), size).alias("rating"))
    wrong = metrics.category_violations(ratings, n.select("question_code", F.lit("Overall").alias("tag")), "Overall")
    return several.select(F.lit("tags").alias("rule"), "question_code").union(wrong.select(F.lit("categories"), F.col("course_id").cast("string")))


# merges and the sink


@query("""with p as (select distinct s_nationkey as building_code, case when s_suppkey % 3 <> 0 then cast(s_suppkey % 5 as varchar) end as room from supplier), o as (select distinct c_nationkey as building_code, 'r' as room from customer where c_nationkey < 5), old as (select building_code, case when building_code % 2 = 0 then null else '1' end as room, building_code * 7 as location_id from o),
f as (select p.*, row_number() over (order by p.building_code, p.room nulls first) as k from p where not exists (select 1 from old where old.building_code = p.building_code and old.room is not distinct from p.room))
select p.building_code, p.room, coalesce(old.location_id, (select max(location_id) from old) + f.k) as location_id from p left join old on old.building_code = p.building_code and old.room is not distinct from p.room left join f on f.building_code = p.building_code and f.room is not distinct from p.room""")
def upserted_places(spark, d):
    new = t(spark, d, "supplier").select(F.col("s_nationkey").alias("building_code"), F.when(F.col("s_suppkey") % 3 != 0, (F.col("s_suppkey") % 5).cast("string")).alias("room")).distinct()
    old = t(spark, d, "customer").where("c_nationkey < 5").select(F.col("c_nationkey").alias("building_code")).distinct()
    old = old.select("building_code", F.when(F.col("building_code") % 2 != 0, "1").alias("room"), (F.col("building_code") * 7).cast("long").alias("location_id"))
    return diff.upsert_ids(new, old, ["building_code", "room"], "location_id")


@query("""with m as (select l_orderkey as course_id, cast(l_linenumber % 2 as varchar) as start_time, l_suppkey % 3 as location_id, l_partkey % 64 as days_of_week from lineitem), n as (select course_id, start_time, days_of_week, row_number() over (partition by course_id, start_time order by days_of_week) as k from (select distinct course_id, start_time, days_of_week from m)),
p as (select course_id, start_time, location_id, row_number() over (partition by course_id, start_time order by location_id) as k from (select distinct course_id, start_time, location_id from m where location_id <> 1))
select n.course_id, n.start_time, cast(n.days_of_week as bigint) as days_of_week, p.location_id from n left join p on n.course_id = p.course_id and n.start_time = p.start_time and n.k = p.k""")
def frozen_places(spark, d):
    m = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("course_id"), (F.col("l_linenumber") % 2).cast("string").alias("start_time"), F.lit("x").alias("end_time"), F.when(F.col("l_suppkey") % 3 != 1, F.col("l_suppkey") % 3).alias("location_id"), (F.col("l_partkey") % 64).cast("long").alias("days_of_week"))
    new = m.select("course_id", "start_time", "end_time", "days_of_week", F.lit(None).cast("long").alias("location_id")).distinct()
    return diff.freeze_locations(m, new).select("course_id", "start_time", "days_of_week", "location_id")


@query("""with names as (select s_suppkey, s_name from supplier), o as (select l_orderkey, string_agg(s_name, ', ' order by s_name) as s from (select distinct l_orderkey, l_suppkey from lineitem) join names on l_suppkey = s_suppkey group by 1),
n as (select l_orderkey, string_agg(s_name, ', ' order by s_name) as s from (select distinct l_orderkey, l_suppkey from lineitem where l_suppkey % 5 <> 0) join names on l_suppkey = s_suppkey group by 1)
select o_orderkey as course_id, chr(10) || '  - Professors: ' || coalesce(o.s, 'N/A') || ' → ' || coalesce(n.s, 'N/A') as line from orders left join o on o.l_orderkey = o_orderkey left join n on n.l_orderkey = o_orderkey where o.s is distinct from n.s""")
def junction_changes(spark, d):
    old = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("course_id"), F.col("l_suppkey").alias("professor_id")).distinct()
    names = t(spark, d, "supplier").select(F.col("s_suppkey").alias("professor_id"), F.col("s_name").alias("name"))
    return diff.junction_lines(old, old.where("professor_id % 5 <> 0"), names, "professor_id", "name", "Professors", offerings(spark, d))


@query("""with o as (select o_orderkey, o_custkey from orders), f as (select o_custkey % 100 as flag_id from orders)
select 'courses' as table_name, count(*) as n, count(*) filter (where hit) as touched from (select o_orderkey, o_orderkey % 3 = 0 or o_orderkey % 5 = 0 as hit from o where o_orderkey % 7 <> 0 union all select o_orderkey, o_orderkey % 3 = 0 from o where o_orderkey % 7 = 0)
union all select 'course_flags', count(*), 0 from o where o_orderkey % 3 <> 0""")
def merged_tables(spark, d):
    was, now = F.lit("2020-01-01").cast("timestamp_ntz"), F.lit("2024-01-02").cast("timestamp_ntz")
    o = t(spark, d, "orders")
    courses = o.select(F.col("o_orderkey").alias("course_id"), F.lit("t").alias("title"))
    flags = o.select(F.col("o_orderkey").alias("course_id"), (F.col("o_custkey") % 100).alias("flag_id"))
    stamp = {"time_added": was, "last_updated": was}
    old = {"courses": courses.withColumns(stamp), "course_flags": flags.withColumns(stamp)}
    # every seventh course is gone from the new version, every fifth has a new title, every third loses its flag
    new = {"courses": courses.where("course_id % 7 <> 0").withColumn("title", F.when(F.col("course_id") % 5 == 0, "u").otherwise("t")), "course_flags": flags.where("course_id % 3 <> 0")}
    merged = diff.merge_all(old, new, now)
    count = lambda name: merged[name].agg(F.count("*").alias("n"), F.count_if(F.col("last_updated") == now).alias("touched")).select(F.lit(name).alias("table_name"), "n", "touched")
    return count("courses").union(count("course_flags"))


@query("""select c_custkey, c_name, case when c_custkey % 3 = 0 then 'none' else c_mktsegment end as seg, [c_custkey, c_nationkey]::varchar as pair from customer""")
def sink_round_trip(spark, d):
    """A warehouse version and a CSV snapshot, read again."""
    at = Spool(spark, "sink").path("w")
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("course_id"), F.concat("c_name", F.lit("\r")).alias("title"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("section"), F.array("c_custkey", "c_nationkey").alias("skills"))
    w = io.Warehouse(spark, at)
    w.write({"courses": c, "flags": c.select(F.col("course_id").alias("flag_id"), F.col("title").alias("flag_text"))})
    w.write({"evaluation_questions": c.select(F.col("title").alias("question_code")), "courses": c.limit(0)}, only="evaluation_")
    io.write_csv({"courses": w.read()["courses"]}, f"{at}/csv")
    back = spark.read.option("header", True).option("quote", '"').option("escape", '"').schema("course_id long, title string, section string, skills string").csv(f"{at}/csv/courses")
    return back.select(F.col("course_id").alias("c_custkey"), F.col("title").alias("c_name"), F.coalesce("section", F.lit("none")).alias("seg"), F.replace("skills", F.lit(","), F.lit(", ")).alias("pair"))


@query("""select cast(p_partkey as varchar) as crn, '202' || cast(p_size % 3 as varchar) || '01' as season, p_name as title, cast(row_number() over (partition by p_size % 3 order by lpad(cast(p_partkey as varchar), 9, '0')) as bigint) as place from part""")
def landing_files(spark, d):
    """Records written as a folder of JSON arrays a season, several and unequal files each, sorted by number, and
    scanned again in their order."""
    at = Spool(spark, "landing").path("parsed_courses")
    p = t(spark, d, "part").select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("crn"), F.col("p_name").alias("title"), F.concat(F.lit("202"), (F.col("p_size") % 3).cast("string"), F.lit("01")).alias("season"))
    for season in ("202001", "202101", "202201"):
        io.write_json(p.where(F.col("season") == season).select("crn", "title"), f"{at}/{season}.json", ["crn"], 8000)
    back = io.read_json(spark, at, "crn string, title string")
    if io.list_seasons(spark, at) != ["202001", "202101", "202201"]:
        raise AssertionError("seasons were not found again")
    back = back.withColumn("place", tables.numbered(["_season"], "_ordinal") + 1)
    return back.select(F.regexp_replace("crn", r"^0+(?=.)", "").alias("crn"), F.col("_season").alias("season"), "title", F.col("place").cast("long").alias("place"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() over w - 1 as place, sum(l_quantity) over (w rows between unbounded preceding and 1 preceding) as before,
last_value(case when l_linenumber = 1 then l_suppkey end ignore nulls) over (w rows between unbounded preceding and 1 preceding) as latest from lineitem
window w as (partition by l_returnflag order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)""")
def running_values(spark, d):
    """Place, sum and last non-null value over three groups, one of half of all rows: scans over ranges."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    li = t(spark, d, "lineitem").select("l_returnflag", *order, "l_quantity", F.when(F.col("l_linenumber") == 1, F.col("l_suppkey")).alias("first"))
    spool = Spool(spark, "running")
    values = {"place": running.count(), "before": running.total("l_quantity"), "latest": running.latest("first", order)}
    out = running.running_values(li, ["l_returnflag"], order, values, spool)
    return out.select(*order, "place", "before", "latest")


# ingestion


@query("""select school, subject, cast(k as varchar) as crn from (select distinct n_regionkey as school, n_name as subject from nation where n_regionkey <> 3) cross join (select unnest([1, 2]) as k)""")
def second_source(spark, d):
    n = t(spark, d, "nation").select(F.col("n_regionkey").alias("school"), F.col("n_name").alias("subject"))

    def call(row: dict) -> str:
        if row["school"] == 3:
            raise KeyError(row["subject"])
        return '[{"crn": "1"}, {"crn": "2"}]'

    rows, _ = crawl.fan_out(n, crawl_once(call), "crn string", 2)
    return rows


def crawl_once(call):
    """A call whose failures are final: no waiting in a query."""

    def run(row: dict) -> str | None:
        try:
            return call(row)
        except KeyError:
            return "[]"

    return run


@query("""select doc_id, source as school, case when doc_id % 9 = 0 then 'sign-in page' when doc_id % 5 = 0 then 'no page' end as error, case when doc_id % 9 <> 0 and doc_id % 5 <> 0 then 'p' || cast(doc_id as varchar) end as page from documents where source in ('src1', 'src2') and doc_id not in (select doc_id from labels)""")
def landed_pages(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.col("source").alias("school"), F.lit("202401").alias("season_code"))
    todo = crawl.gate(docs, t(spark, d, "labels"), ["doc_id"], ["src1", "src2"], 202101)

    def call(row: dict) -> str | None:
        return "<form action=login>" if row["doc_id"] % 9 == 0 else None if row["doc_id"] % 5 == 0 else f"p{row['doc_id']}"

    fetched = Spool(spark, "fetched").keep(crawl.fetch(todo, call, 4, 1), "pages")
    there, failed = crawl.land_pages(fetched, Spool(spark, "landed").path("pages"), ["doc_id", "school"])
    return there.select("doc_id", "school", F.lit(None).cast("string").alias("error"), "page").unionByName(failed.withColumn("page", F.lit(None).cast("string")))


# reports and checks


@query("""select cast(s_nationkey as varchar) as code, count(distinct s_name) as names, count(distinct nullif(s_suppkey % 3, 0)) as urls from supplier group by 1 having count(distinct s_name) > 1 or count(distinct nullif(s_suppkey % 3, 0)) > 1""")
def name_report(spark, d):
    s = t(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("code"), F.col("s_name").alias("building_name"), F.nullif(F.col("s_suppkey") % 3, F.lit(0)).alias("url"))
    return linkage.report_names(s)


@query("""select 'course_flags.course_id' as reference, count(*) as n from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F') union all select 'course_flags.flag_id', count(*) from lineitem where l_suppkey not in (select s_suppkey from supplier where s_nationkey > 3)""")
def reference_report(spark, d):
    li = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("course_id"), F.col("l_suppkey").alias("flag_id"))
    known = {"courses": t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("course_id")), "flags": t(spark, d, "supplier").where("s_nationkey > 3").select(F.col("s_suppkey").alias("flag_id")), "course_flags": li}
    out = None
    for name, bad in checks.foreign_key_orphans(known).items():
        one = bad.agg(F.count("*").alias("n")).select(F.lit(name).alias("reference"), "n")
        out = one if out is None else out.union(one)
    return out


@query(f"""with {_OFF}, s as (select distinct season_code from off) select 'LATEST_3' as asked, season_code, count(*) as n from off where season_code in (select season_code from s order by 1 desc limit 3) group by all
union all select 'all', season_code, count(*) from off group by all union all select 'listed', season_code, count(*) from off where season_code in (select min(season_code) from s) group by all""")
def resolved_seasons(spark, d):
    """Courses of the seasons that three kinds of requests mean, of those that the orders have."""
    o = Spool(spark, "seasons").keep(offerings(spark, d).select("season_code"), "seasons")
    known, out = [r.season_code for r in o.distinct().orderBy("season_code").collect()], None  # a few a year
    for name, wanted in (("LATEST_3", ["LATEST_3"]), ("all", None), ("listed", known[:1])):
        one = o.where(F.col("season_code").isin(io.resolve_seasons(wanted, known))).groupBy("season_code").agg(F.count("*").alias("n")).select(F.lit(name).alias("asked"), "season_code", "n")
        out = one if out is None else out.unionByName(one)
    try:
        io.resolve_seasons(["209901"], known)
    except io.InvalidSeasonError:
        return out
    raise AssertionError("an unknown season was taken")


@query(f"""with {_OFF} select course_id, 'M–F 9:00–10:00 B' || cast(grp % 3 as varchar) || ' 1' as text from off""")
def meeting_texts(spark, d):
    o = offerings(spark, d)
    meetings = o.select("course_id", F.lit(config.WEEKDAYS_MASK).alias("days_of_week"), F.lit("9:00").alias("start_time"), F.lit("10:00").alias("end_time"), (F.col("grp") % 3).alias("location_id"))
    places = o.select((F.col("grp") % 3).alias("location_id")).distinct().select("location_id", F.concat(F.lit("B"), F.col("location_id").cast("string")).alias("building_code"), F.lit("1").alias("room"))
    return diff.meeting_text(meetings, places)


@query("""select p_partkey, rtrim(p_name) as trimmed, nullif(p_brand, 'Brand#11') as email, p_name || ' x' as note from part""")
def text_cleaning(spark, d):
    return t(spark, d, "part").select("p_partkey", S.right_strip(F.concat("p_name", F.lit(" \r\n"))).alias("trimmed"), S.null_if_empty(F.when(F.col("p_brand") == "Brand#11", "").otherwise(F.col("p_brand"))).alias("email"), S.clean_note(F.concat("p_name", F.lit("  x"))).alias("note"))

