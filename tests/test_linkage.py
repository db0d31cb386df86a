import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corvine.functions.text import text_distance
from corvine.operators import graph, linkage, merges, similarity
from corvine.sources.io import CACHE
from corvine.sources.spool import Spool

from . import replay

COURSE = "course_id long, season_code string, title string, description string"
LISTING = "course_id long, season_code string, course_code string, section string, o long"
TAUGHT = "course_id long, professor_id long"


def same(spark, courses, listings, taught, specs=None):
    out = linkage.same_courses(spark.createDataFrame(courses, COURSE), spark.createDataFrame(listings, LISTING), spark.createDataFrame(taught, TAUGHT), "o", Spool(spark, "t"), specs)[0]
    return {r.course_id: r.same_course_id for r in out.collect()}


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    up = {n: n for p in pairs for n in p}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in graph.labels(spark.createDataFrame([(n,) for n in up], "node long"), spark.createDataFrame(pairs, "a long, b long"), Spool(spark, "t")).collect()}
    assert got == {n: find(n) for n in up}


def test_linkage_rules(spark):
    courses = [
        (1, "202001", "Intro", "about everything there is"), (2, "202003", "INTRO", "other words entirely"),  # one title and department
        (3, "202101", "Renamed fully", "about everything there is"),  # one code and description
        (4, "202002", "Intro", "summer"), (5, "202201", "Senior Essay", "x"), (6, "202203", "Senior Essay", "y"),  # summer; generic title
        (7, "202203", "Intro", "talk"),  # discussion
        (8, "202401", "Shared", "p"), (9, "202403", "Shared", "q"),  # other departments, one professor
    ]
    listings = [(1, "202001", "AA 1", "1", 1), (2, "202003", "AA 2", "1", 2), (3, "202101", "AA 1", "1", 3), (4, "202002", "AA 1", "1", 4), (5, "202201", "BB 9", "1", 5), (6, "202203", "CC 9", "1", 6), (7, "202203", "AA 1", "01A", 7), (8, "202401", "DD 1", "1", 8), (9, "202403", "EE 1", "1", 9)]
    taught = [(5, 50), (6, 50), (8, 60), (9, 60)]
    assert same(spark, courses, listings, taught) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8}


@pytest.mark.parametrize("seed", range(3))
def test_title_labels_equal_all_links(spark, seed):
    """Classes of codes, then departments, then professors: as if every two courses of a title were compared."""
    r = random.Random(seed)
    n = 120
    data = [(i, r.choice(["a", "b", "c", "senior essay", None]), r.random() < 0.3, sorted({r.randrange(40) for _ in range(r.randint(0, 2))})) for i in r.sample(range(1000), n)]
    codes = [(i, r.choice([f"{d} {k}" for d in ("AA", "BB", "CC", "DD", "EE", "FF", "GG") for k in range(3)] + [None] * 3)) for i, *_ in data for _ in range(1 + (r.random() < 0.05))]
    up = {("c", i): ("c", i) for i, *_ in data}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    def tie(a, b):
        up[find(a)] = find(b)

    summer, title = {i: s for i, _, s, _ in data}, {i: t for i, t, *_ in data}
    roots = {}
    for i, c in codes:
        if c is not None:
            roots.setdefault(i, []).append((summer[i], c))
            tie((summer[i], c), roots[i][0])
    hung = {i: find(x[0]) for i, x in roots.items()}
    deps = {i: {c.split()[0] for _, c in x} for i, x in roots.items()}
    profs = {i: set(x) for i, _, _, x in data}
    label = {i: i for i in title}
    for _ in range(n):
        was = dict(label)
        for a in title:
            for b in title:
                if a < b and title[a] is not None and title[a] == title[b] and summer[a] == summer[b] and label[a] != label[b]:
                    same_codes = a in hung and b in hung and (hung[a] == hung[b] or deps[a] & deps[b])
                    if same_codes or ("senior essay" not in title[a] and profs[a] & profs[b]):
                        lo, hi = sorted((label[a], label[b]))
                        label = {k: lo if v == hi else v for k, v in label.items()}
        if was == label:
            break
    got = linkage.title_labels(spark.createDataFrame(data, "course_id long, title string, summer boolean, prof_ids array<long>"), spark.createDataFrame(codes, "course_id long, code string"), Spool(spark, "t"))
    rows = got.collect()
    assert len(rows) == n and {x.course_id: x.label for x in rows} == label
    assert 1 < len(set(label.values())) < n


def test_many_professors_bring_no_edges_within_a_department(spark, monkeypatch):
    """What is contracted grows with titles and codes, not with courses times professors."""
    data = [(i, f"title {i % 4}", False, list(range(i, i + 30))) for i in range(200)] + [(i, "apart", False, [7, 8]) for i in (301, 302)]
    codes = [(i, "AA 1") for i in range(200)] + [(301, "BB 1"), (302, "CC 1")]
    keep, edges = Spool.keep, []

    def counted(self, df, name, rows=None):
        out = keep(self, df, name, rows)
        if name == "edges":
            edges.append(out.count())
        return out

    monkeypatch.setattr(Spool, "keep", counted)
    out = linkage.title_labels(spark.createDataFrame(data, "course_id long, title string, summer boolean, prof_ids array<long>"), spark.createDataFrame(codes, "course_id long, code string"), Spool(spark, "t"))
    assert {x.course_id: x.label for x in out.collect()} == {i: i % 4 for i in range(200)} | {301: 301, 302: 301}
    assert sum(edges) <= 4


def test_same_season_refuses_a_text_merge(spark):
    courses = [(1, "202001", "Topics in art one", "d" * 40), (2, "202001", "Topics in art two", "d" * 40), (3, "202101", "Topics in art two", "e" * 40)]
    listings = [(i, c[1], f"A{'ABC'[i - 1]} 1" if i < 0 else "AA 1", "1", i) for i, c in enumerate(courses, 1)]
    got = same(spark, courses, listings, [])
    assert got[1] != got[2] and got[2] == got[3]


def test_split_specs(spark):
    courses = [(1, "202001", "Lang", "t"), (2, "202003", "Lang", "t")]
    listings = [(1, "202001", "AA 110", "1", 1), (2, "202003", "AA 120", "1", 2)]
    assert same(spark, courses, listings, []) == {1: 1, 2: 1}
    specs = linkage.split_specs(spark, [[["AA 110", ("AA 5", "202003")], ["AA 120"]]])
    assert same(spark, courses, listings, [], specs) == {1: 1, 2: 2}


def model(members, codes):
    """The order-dependent merges written with plain sets."""
    sets = {}
    for m in members:
        sets.setdefault(m["label"], {m["course_id"]})
        sets[m["label"]].add(m["course_id"])
    parts = list(sets.values())
    by_id = {m["course_id"]: m for m in members}
    home = lambda i: next(p for p in parts if i in p)

    def join(a, b):
        x, y = home(a), home(b)
        if x is not y and not {by_id[i]["season_code"] for i in x} & {by_id[i]["season_code"] for i in y}:
            x |= y
            parts.remove(y)

    for code in sorted({c["code"] for c in codes}):
        ids = [c["course_id"] for c in sorted(codes, key=lambda c: c["ordinal"]) if c["code"] == code]
        for field in ("title", "description"):
            if len({id(home(i)) for i in ids}) == 1:
                break
            texts = {}
            for i in ids:
                texts.setdefault(by_id[i][field], []).append(i)
            keys = sorted(texts)
            if field == "description":
                for k in keys:
                    for a, b in zip(texts[k], texts[k][1:]):
                        join(a, b)
                if len({id(home(i)) for i in ids}) == 1:
                    break
            for n, a in enumerate(keys):
                for b in keys[n + 1 :]:
                    if home(texts[a][0]) is not home(texts[b][0]) and text_distance(a, b) >= 0:
                        join(texts[a][0], texts[b][0])
    return {i: min(home(i)) for i in by_id}


@pytest.mark.parametrize("seed", range(30))
def test_replay_equals_model(seed):
    r = random.Random(seed)
    titles, texts = ["intro to art", "intro to arts", "modern art", "late modern art", "x"], ["long text a", "long text b", "other", ""]
    members, codes = [], []
    for i in range(1, r.randint(3, 14)):
        members.append({"course_id": i, "season_code": str(r.randint(1, 6)), "title": r.choice(titles), "description": r.choice(texts), "label": i if r.random() < 0.8 else 1})
        for c in r.sample(["A 1", "A 2", "B 1"], r.randint(1, 2)):
            codes.append({"course_id": i, "code": c, "course_code": c, "ordinal": len(codes)})
    got = replay.replay_text_merges(pd.DataFrame(members), pd.DataFrame(codes), {}, [], 0.25)
    assert got == model(members, codes)


def replayed(data, codes, titles, changes, exact):
    """The labels by one replay for each of the two terms."""
    label = {r.course_id: r.label for r in titles.collect()}
    rows = {r.course_id: r for r in data.collect()}
    listed = [r for r in codes.collect() if r.course_id in rows]
    out = {}
    for summer in (False, True):
        own = [i for i in rows if rows[i].summer == summer]
        members = [{"course_id": i, "season_code": rows[i].season_code, "title": rows[i].title, "description": rows[i].description, "label": label[i]} for i in own]
        some = [{"course_id": r.course_id, "code": r.code, "course_code": r.course_code, "ordinal": r.ordinal} for r in listed if rows[r.course_id].summer == summer]
        if members:
            out |= replay.replay_text_merges(pd.DataFrame(members), pd.DataFrame(some), changes, exact, 0.25)
    least = {}
    for i, x in out.items():
        least[x] = min(least.get(x, i), i)
    return {i: least[x] for i, x in out.items()}


@pytest.mark.parametrize("most", [2, 50_000])
def test_rounds_of_merges_equal_the_replay(spark, most, monkeypatch):
    titles, texts = ["intro to art", "intro to arts", " modern art", "late modern art", "modern arts", "x", "", None], ["long text a", "long text b", "other", "", None]
    data, codes, labels, n = [], [], [], 0
    for seed in range(60):
        r, ids = random.Random(seed), []
        for _ in range(r.randint(3, 25)):
            n += 1
            ids.append(n)
            data.append((n, str(r.randint(1, 9)), r.choice(titles), r.choice(texts), seed % 7 == 0))
            labels.append((n, n if r.random() < 0.8 else ids[0]))
            codes += [(n, f"{seed:03d} {c}", f"{seed:03d} {c}", len(codes) + i) for i, c in enumerate(r.sample(["A 1", "A 2", "B 1", "C 1", "D 1"], r.randint(1, 3)))]
    changes, exact = {"001 A 1": "001 B 1", "002 Z": "002 A 1", "010 C 1": "010 D 1"}, ["003 A 1"]
    data = spark.createDataFrame(data, "course_id long, season_code string, title string, description string, summer boolean")
    codes = spark.createDataFrame(codes, "course_id long, code string, course_code string, ordinal long")
    titled = spark.createDataFrame(labels, "course_id long, label long")
    monkeypatch.setattr(merges.merge_apart, "__defaults__", (most,))
    got = linkage.text_labels(data, codes, titled, Spool(spark, "t"), changes, exact)
    got = {r.course_id: r.label for r in got.collect()}
    want = replayed(data, codes, titled, changes, exact)
    assert got == want and len(set(want.values())) < len(set(x for _, x in labels)) - 100


def test_one_component_of_all_parts(spark):
    """Every course shares a code with the next one, so all are one component."""
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet").collect()
    r = random.Random(2)
    data = [(p.p_partkey, str(2000 + p.p_partkey % 9), f"{p.p_name} {p.p_type}".lower(), p.p_type, False) for p in parts]
    codes = [(p.p_partkey, f"A {k}", f"A {k}", 2 * i + j) for i, p in enumerate(parts) for j, k in enumerate((i // 9, (i // 9 + 1 + r.randrange(2)) % 23))]
    data = spark.createDataFrame(data, "course_id long, season_code string, title string, description string, summer boolean")
    codes = spark.createDataFrame(codes, "course_id long, code string, course_code string, ordinal long")
    titled = data.selectExpr("course_id", "course_id as label")
    got = {x.course_id: x.label for x in linkage.text_labels(data, codes, titled, Spool(spark, "t"), {}, []).collect()}
    assert got == replayed(data, codes, titled, {}, []) and len(set(got.values())) < len(got)


def test_similar_pairs_equal_all_pairs(spark):
    r = random.Random(4)
    texts = {(g, "".join(r.choice("abcd ") for _ in range(r.randrange(0, 14)))) for g in "xy" for _ in range(60)} | {("x", "\x1c padded\u00a0"), ("x", "padded"), ("y", "é\U0001f600中"), ("y", "é\U0001f600中x")}
    df = spark.createDataFrame([(g, t) for g, t in texts] + [("x", None)], "g string, t string")
    for crowd in (2, 512):
        got = {(p.g, p.a, p.b): p.distance for p in similarity.similar_pairs(df, ["g"], "t", Spool(spark, "t"), crowd=crowd).collect()}
        want = {(g, a, b): d for g, a in texts for h, b in texts if g == h and a < b and (d := text_distance(a, b)) >= 0}
        assert got == want and len(want) > 20
    assert similarity.similar_pairs(df.limit(0), ["g"], "t", Spool(spark, "t")).count() == 0


def test_cliques(spark):
    kind = "season_code string, crn int, crns array<int>"
    good = [("1", 1, [1, 2]), ("1", 2, [2, 1]), ("2", 1, [1])]
    assert linkage.clique_violations(spark.createDataFrame(good, kind)).count() == 0
    for bad in ([("1", 1, [1, 2]), ("1", 2, [2])], [("1", 1, [2]), ("1", 2, [2])], [("1", 1, [1, 9])]):
        assert linkage.clique_violations(spark.createDataFrame(bad, kind)).count() > 0


def test_cross_listings(spark):
    rows = [("202403", 12, [12, 10, 11], "GS", "AA 1", None, 1), ("202403", 10, [12, 10, 11], "YC", "ZZ 1", 10, 2), ("202403", 11, [12, 10, 11], "YC", "CC 1", 10, 3)]
    listings, courses = linkage.resolve_cross_listings(spark.createDataFrame(rows, "season_code string, crn int, crns array<int>, school string, course_code string, primary_crn int, o int"), "o")
    c = courses.first()
    assert (c.course_id, c.course_code, c.primary_crn) == (240300010, "CC 1", None) and listings.count() == 3


def test_professors(spark):
    kind = "course_id long, season_code string, professors array<string>, professor_emails array<string>"
    rows = [(1, "202001", ["Ann", "Bob"], ["", "b@x"]), (2, "202003", ["Ann"], ["a@x"]), (3, "202101", ["Robert"], ["b@x"]), (4, "202103", ["Cy"], [""])]
    cache = spark.createDataFrame([("Ann", 7), ("Cy", 3)], CACHE)
    people, taught = linkage.resolve_professors(spark.createDataFrame(rows, kind), cache, "course_id")
    got = {p.name: (p.professor_id, p.email) for p in people.collect()}
    assert got == {"Ann": (7, "a@x"), "Robert": (8, "b@x"), "Cy": (3, None)}
    assert sorted((t.course_id, t.professor_id) for t in taught.collect()) == [(1, 7), (1, 8), (2, 7), (3, 8), (4, 3)]
    keys = {k.key: k.id for k in linkage.saved_professor_keys(people).collect()}
    assert keys == {"Ann <a@x>": 7, "Robert <b@x>": 8, "Cy": 3}


def test_places_without_room_vanish(spark):
    rows = [("WLH", "u", 1), ("SSS 1", "u1", 2), ("SSS 1 - Old Hall 1", "", 3), ("SSS 1 - New Hall 1", None, 4), ("TBA", "", 5), ("A 1 - B 2", "", 6)]
    locations, buildings, bad = linkage.resolve_places(spark.createDataFrame(rows, "location string, location_url string, o long"), "o")
    assert [tuple(r) for r in locations.collect()] == [("SSS", "1", "New Hall", "")]
    assert [r.code for r in buildings.collect()] == ["SSS"] and bad.count() == 1


def test_primary_numbers_do_not_meet_all_listings_of_a_code(spark):
    """Thousands of listings of one code: answers come from one row a code and section, without pairs."""
    kind = "crn string, code string, section string, primary_code string"
    rows = [(str(i), "A", str(i % 3), "A") for i in range(30)] + [("x", "B", None, "B"), ("y", "C", "9", "A"), ("z", "C", "1", None), ("v", "C", "1", "B"), ("u", None, "1", "none")]
    df = spark.createDataFrame(rows, kind)
    got = {r.crn: r.primary for r in linkage.primary_crn(df).collect()}
    assert got == {str(i): ("0", "1", "11")[i % 3] for i in range(30)} | {"x": "x", "y": None, "z": "z", "v": "x", "u": None}
    many = spark.range(6000).selectExpr("cast(id as string) as crn", "'A' as code", "cast(id % 3 as string) as section", "'A' as primary_code")
    plan = linkage.primary_crn(many)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("OR" in j for j in joins)


def test_all_distances_compare_equal_texts_once(spark, monkeypatch):
    r = random.Random(5)
    words = ["alpha beta gamma", "alpha beta gamna", "beta", "something else", "xalpha beta gamma y", "ab", " "]
    rows = [(i, r.choice("kl"), r.choice(words)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, k string, t string")
    want = {(a, b): text_distance(x, y) for a, k, x in rows for b, m, y in rows if a < b and k == m}
    out = similarity.all_distances(df, ["k"], "id", "t", Spool(spark, "test"))
    got = out.collect()
    assert len(got) == len(want) and {(g.a, g.b): g.distance for g in got} == want
    # copies do not multiply what Python is asked
    asked = spark.sparkContext.accumulator(0)

    def counted(a, b, most):
        @F.udf("double")
        def one(x, y, m):
            asked.add(1)
            return text_distance(x, y, m)

        return one(a, b, most)

    monkeypatch.setattr(similarity, "infix_similarity", counted)
    similarity.all_distances(df, ["k"], "id", "t", Spool(spark, "test")).collect()
    assert 0 < asked.value <= 2 * len(words) ** 2


def test_all_distances_take_the_first_of_equal_length_as_pattern(spark):
    """The distance is not the same both ways; members of two classes meet in both orders."""
    long, odd = "abcde", "aXbcd"
    assert text_distance(long, odd, 0.25) != text_distance(odd, long, 0.25)
    rows = [(1, "k", long), (2, "k", odd), (3, "k", long), (4, "k", " aXbcd "), (5, "k", "abcdef"), (6, "l", odd), (6, "l", odd), (7, "l", long), (7, "k", odd), (None, "k", odd)]
    df = spark.createDataFrame(rows, "id long, k string, t string")
    want = sorted((a, b, text_distance(x, y)) for a, k, x in rows for b, m, y in rows if a and b and a < b and k == m)
    got = similarity.all_distances(df, ["k"], "id", "t", Spool(spark, "test"))
    assert sorted(tuple(g) for g in got.collect()) == want
