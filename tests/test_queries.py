import pytest

from corvine.plans import mechanism_queries as Q
from corvine.plans import queries

from .twins import rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_sql(spark, sf, name):
    assert rows_of(Q.QUERIES[name](spark, sf)) == sql_rows(sf, Q.ORACLE[name])


def infix_edits(pattern, text):
    """Least edits between the pattern and any substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def alike(x, y, most=0.25):
    x, y = sorted(((x or "").strip(), (y or "").strip()), key=len)
    if not x:
        return -1.0
    n = infix_edits(x, y)
    return n / len(x) if n <= int(most * len(x)) else -1.0


def test_infix_similar_equals_the_plain_table(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")  # the smallest table has no similar names
    names = {r.p_partkey: r.p_name for r in spark.read.parquet(f"{sf}/part.parquet").collect()}
    got = Q.QUERIES["infix_similar"](spark, sf).collect()
    assert got and all(r.distance == pytest.approx(alike(names[r.a], names[r.b])) for r in got)
    assert {r.distance >= 0 for r in got} == {True, False}


def test_infix_similar_equals_sql_in_both_orders(spark, tmp_path):
    names = ["old bolt", "hot bolt", None, "", " hot bolt ", "old ring", "hot ring x"]
    rows = [(i, n, "Brand#1", 1) for i, n in enumerate(names + names[::-1])] + [(1, "old bolt", "Brand#2", 1), (2, "hot bolt", "Brand#2", 1), (None, "hot bolt", "Brand#1", 1)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert rows_of(Q.QUERIES["infix_similar"](spark, str(tmp_path))) == sql_rows(tmp_path, Q.ORACLE["infix_similar"])


def test_same_courses_equal_a_plain_replay(spark, sf):
    courses, listings, taught = queries._catalog(spark, sf)
    rows = {r.course_id: (r.season_code, r.title.lower(), r.description or "") for r in courses.collect()}
    code = {r.course_id: r.course_code for r in listings.collect()}
    people = {}
    for r in taught.collect():
        people.setdefault(r.course_id, set()).add(r.professor_id)
    label = {i: i for i in rows}
    talks = {i for i in rows if code[i].endswith("D")}

    def merge(a, b, apart=True):
        x, y = label[a], label[b]
        seasons = [{rows[i][0] for i in rows if label[i] == k} for k in (x, y)]
        if x != y and not (apart and seasons[0] & seasons[1]):
            for i in rows:
                label[i] = min(x, y) if label[i] in (x, y) else label[i]

    ids = sorted(set(rows) - talks)
    term = {i: rows[i][0].endswith("2") for i in ids}
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if rows[a][1] == rows[b][1] and term[a] == term[b] and (code[a].split()[0] == code[b].split()[0] or people.get(a, set()) & people.get(b, set())):
                merge(a, b, False)
    for summer in (False, True):
        for c in sorted({code[i] for i in ids}):
            own = [i for i in ids if code[i] == c and term[i] == summer]
            for field in (1, 2):
                texts = {}
                for i in own:
                    texts.setdefault(rows[i][field], []).append(i)
                if len({label[i] for i in own}) > 1 and field == 2:
                    for _, same in sorted(texts.items()):
                        for a, b in zip(same, same[1:]):
                            merge(a, b)
                if len({label[i] for i in own}) > 1:
                    order = sorted(texts)
                    for n, x in enumerate(order):
                        for y in order[n + 1 :]:
                            if label[texts[x][0]] != label[texts[y][0]] and alike(x, y) >= 0:
                                merge(texts[x][0], texts[y][0])
    got = {r.course_id: r.same_course_id for r in Q.QUERIES["same_course_greedy"](spark, sf).collect()}
    assert got == {i: i if i in talks else label[i] for i in rows}
    assert len(set(got.values())) < len(got)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(Q.QUERIES) <= set(e.queries())


@pytest.mark.parametrize("name", ["histogram_sum", "weighted_avg", "meetings_bridge"])
def test_grouped_rows_are_dealt_by_their_number(spark, sf, name, monkeypatch):
    """One shuffle by course, into tasks of a bounded number of rows."""
    from corvine.plans import catalog_queries

    for m in (queries, catalog_queries):
        monkeypatch.setattr(m, "GROUPED", 500)
    df = Q.QUERIES[name](spark, sf)
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    shuffles = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 1 and f", {-(-rows // 500)})" in shuffles[0]
    assert rows_of(df) == sql_rows(sf, Q.ORACLE[name])


def test_ratings_of_professors_are_grouped_by_their_number(spark, sf, monkeypatch):
    from corvine.operators import metrics

    monkeypatch.setattr(metrics, "GROUPED", 500)
    df = queries.course_prof_rating(spark, sf)
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert f", {-(-rows // 500)})" in df._jdf.queryExecution().executedPlan().toString()
    assert rows_of(df) == sql_rows(sf, Q.ORACLE["course_prof_rating"])


@pytest.mark.parametrize("name", ["parsed_evaluations", "html_people_and_listings", "accent_fold"])
def test_rows_for_python_are_dealt_by_their_number(spark, sf, name, monkeypatch):
    monkeypatch.setattr(queries, "READ", 20)
    df = Q.QUERIES[name](spark, sf)
    assert df.rdd.getNumPartitions() >= 5
    assert rows_of(df) == sql_rows(sf, Q.ORACLE[name])
