import random
import re

import numpy as np
import pytest
import xxhash

from corvine.llm import similar, simhash
from corvine.llm._spark import Spool
from corvine.llm._text import xxh64_spans
from corvine.operators.graph import components


def brute_shingles(t, size=4):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])


def brute_alike(texts, least=0.8, size=5):
    sets = [set(brute_shingles(t, size)) for t in texts]
    return np.array([[bool(a and b) and len(a & b) >= least * len(a | b) - 1e-9 for b in sets] for a in sets])


def brute_print(t, size=4):
    shingles = brute_shingles(t, size)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(x >> i & 1 for x in h) * 2 > len(h)) << i for i in range(64))


def closure(near, names):
    label = np.array(names)
    while True:
        new = np.where(near, label[None], np.iinfo(np.int64).max).min(axis=1)
        if (new == label).all():
            return label.tolist()
        label = new


def test_xxh64():
    r = random.Random(1)
    rows = [bytes(r.randrange(256) for _ in range(r.randint(0, 120))) for _ in range(1500)]
    at = np.cumsum([0, *map(len, rows)])
    got = xxh64_spans(np.frombuffer(b"".join(rows), np.uint8), at[:-1], at[1:], 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(x, 42) for x in rows]


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover(radius):
    masks, r = simhash.covering_masks(radius), random.Random(2)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        differing = sum(1 << i for i in r.sample(range(64), radius))
        assert any(m & differing == 0 for m in masks)


def test_forest_connects_what_links_connect():
    r = random.Random(3)
    seeds = [r.getrandbits(64) for _ in range(5)]
    fps = np.unique(np.array([s ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 8))) for s in seeds for _ in range(60)], np.uint64))
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 4
    edges = simhash.forest(fps, 4)
    want = closure(near, list(range(len(fps))))
    assert len(edges) == len(fps) - len(set(want))
    at = {int(x): i for i, x in enumerate(fps)}
    assert all(near[at[a], at[b]] for a, b in edges)


def test_links_and_components(spark):
    r = random.Random(4)
    seeds = [r.getrandbits(64) for _ in range(20)]
    fps = np.unique(np.array([s ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 7))) for s in seeds for _ in range(30)], np.uint64)).view(np.int64)
    near = np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)[None]) <= 4
    for crowd in (simhash.CROWD, 5):  # the second deals nearly every bucket anew
        edges = simhash.links(spark.createDataFrame([(int(x),) for x in fps], "fp long"), crowd=crowd)
        got = {x.node: x.root for x in components(edges, Spool(spark, "t")).collect()}
        assert [got.get(int(x), int(x)) for x in fps] == closure(near, fps.tolist())


@pytest.mark.parametrize("crowd", [3, 2048])
def test_similar_sets_equal_all_pairs(spark, sf, crowd, monkeypatch):
    """One of each component of the two kinds of links stays; no pair of similarity 0.8 is missed."""
    r = random.Random(6)
    texts = [x.text for x in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [None, "", "lone", "lone word"]
    for _ in range(12):  # chains of copies with more and more words changed
        w = [f"w{r.randrange(4000)}" for _ in range(r.randrange(30, 400))]
        for _ in range(r.randrange(2, 7)):
            texts.append(" ".join(w))
            for _ in range(max(1, len(w) // 90)):
                w[r.randrange(len(w))] = "new"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'kept' as node", "'kept' as `KEY`", "'kept' as sample", "'kept' as sets")
    monkeypatch.setattr(similar.links, "__defaults__", (crowd,))
    out = simhash.deduplicate(docs.repartition(3), size=5, least=0.8).collect()
    prints = np.array([brute_print(t, 5) for t in texts], np.uint64)
    near = brute_alike(texts) | (np.bitwise_count(prints[:, None] ^ prints[None]) <= 4)
    assert sorted(x.doc_id for x in out) == sorted(set(closure(near, list(range(len(texts))))))
    assert all(x.node == x.KEY == x.sample == x.sets == "kept" for x in out)
    assert near.sum() > len(texts) + 60 and simhash.deduplicate(docs.limit(0), size=5, least=0.8).count() == 0


def test_repeated_ids_lose_no_component(spark):
    x, y = "one two three four five six", "an altogether different text of other words"
    docs = spark.createDataFrame([(1, x, 1), (1, y, 2), (3, y, 3), (None, x, 4), (None, "alone", 5)], "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.text) for r in simhash.deduplicate(docs).collect()), key=str)
    assert got == sorted([(1, x), (1, y), (None, "alone")], key=str)
    assert [r.fp for r in simhash.near_duplicates(docs).orderBy("fp").collect()] == [1, 2, 3, 4, 5]


def test_defined_cases(spark):
    rows = [(5, "a b c d e f", "x"), (2, "A b  c\td e f", "x"), (None, "a b c d e f", None), (9, None, "y"), (8, "", "y"), (8, "", "y"), (7, " \n", "y"), (None, "lone words only here", "z"), (3, "quite another text than those", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    of = {(i, t): brute_print(t) for i, t, _ in rows}
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    assert {(i, sign(of[i, t])) for i, t, _ in rows} == {(i, f) for i, f, _ in got}
    assert {(i, c) for i, _, c in got} == {(5, 2), (2, 2), (None, 2), (9, 7), (8, 7), (7, 7), (None, None), (3, 3)}
    kept = simhash.deduplicate(docs)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(2, rows[1][1]), (7, " \n"), (3, rows[8][1]), (None, rows[7][1])], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in simhash.op2_simhash(spark, sf).collect()}
    fps = np.array([brute_print(r.text) for r in docs], np.uint64)
    want = closure(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4, [r.doc_id for r in docs])
    assert all(got[r.doc_id].fingerprint == f"{int(f):016x}" and got[r.doc_id].component_id == c for r, f, c in zip(docs, fps, want))
