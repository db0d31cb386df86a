"""Edit fingerprints against a walk that goes step by step, and near-duplicates against all pairs."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvine.llm import edit_prints as E
from corvine.llm._text import U64, mix


def plain_print(text, table, steps):
    """One step at a time: the place of the walker at each of the first 2n steps."""
    cls = lambda c: (ord(c) ^ ((ord(c) >> 8) * 0x9D & 0xFFFFFFFF)) & (E.CLASSES - 1)
    moves = lambda j, c: table[cls(c) * E.PERIOD + j % E.PERIOD] == 1
    at, walk = 0, []
    for j in range(2 * len(text)):
        walk.append(at)
        if at < len(text) and moves(j, text[at]):
            at += 1
    out = []
    for s in range(E.SLOTS):
        known = [x for x in steps[s].tolist() if x < 2 * len(text)]
        i = walk[known[-1]] if known else 0
        if not text or i == len(text):
            out.append(0)
            continue
        a, b, c = ord(text[i]), ord(text[i - 1]) if i > 0 else 0, ord(text[i - 2]) if i > 1 else 0
        out.append(int(mix(np.array([a | b << 21 | c << 42], U64) ^ mix(np.array([s], U64)))[0] % U64(255)) + 1)
    return out


TEXTS = ["", "a", "ab", "abc", "é中 \U0001f600 \u0000 odd", "x" * 700, "words and more words " * 30, "A" * 3 + "b" * 400]


@pytest.mark.parametrize("n", [8, 90])
def test_prints_equal_those_of_a_plain_walk(n):
    r = random.Random(n)
    texts = (TEXTS * 12)[: n - 4] + ["".join(r.choice("abcdef ") for _ in range(r.randrange(900))) for _ in range(4)]
    walker = E.Walker()
    w = walker.walk(texts)
    got = walker.prints(w)
    for i in [*range(8), *range(n - 4, n)]:
        assert got[i].tolist() == plain_print(texts[i], walker.table, walker.steps)
    new = [E.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1], strict=True)]
    kept = w.length - w.length // 3
    assert (walker.prints(walker.walk(new, w, kept)) == walker.prints(walker.walk(new))).all()


def test_sampled_steps_are_records_of_a_uniform_draw():
    steps = E.Walker().steps
    for n in (10, 1000, 10**6):
        drawn = np.array([x[x < n][-1] for x in steps]) / n
        assert abs(drawn.mean() - 0.5) < 0.09 and drawn.std() > 0.2


def test_likeness_falls_with_edits():
    r, walker = random.Random(3), E.Walker()
    base = "".join(r.choice("abcdefghijklmnop ") for _ in range(4000))
    other = "".join(r.choice("abcdefghijklmnop ") for _ in range(4000))
    near = []
    for texts in (base, base[:2000] + "xyz" + base[2001:], base[:3000] + other[:1000], base[:1500] + other[:2500], other):
        a = walker.prints(walker.walk([base, texts]))
        near.append(float(E.likeness(a[:1], a[1:])[0]))
    assert near[0] == 1 and near[1] > 0.6 and 0.6 < near[2] < 0.9 and 0.25 < near[3] < 0.5 and near[4] < 0.05


def plain_rows(rows):
    walker = E.Walker()
    text = [r[1] or "" for r in rows]
    order = sorted(range(len(rows)), key=lambda i: -rows[i][0])
    out = []
    for k, i in enumerate(order):
        j = order[(k + 1) % len(order)]
        new = E.edited(text[i], text[j])
        a, b, c = walker.prints(walker.walk([text[i], new, text[j]]))
        near = [float(E.likeness(a[None], x[None])[0]) for x in (b, c)]
        out.append((rows[i][0], len(text[i]), hashlib.sha256(new.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), *near))
    return sorted(out)


def test_whole_table_beside_next(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, E.op13_edit_prints(spark, sf).collect()))
    assert got == plain_rows([tuple(r) for r in docs.collect()])
    near, following = (np.array([r[i] for r in got if r[1] > 30]) for i in (5, 6))
    assert (near > 0.4).all() and np.median(following) < 0.03


def test_defined_cases_beside_next(spark):
    rows = [(3, None), (2, ""), (9, "some text of nine"), (7, "x"), (5, "long " * 30_000)]
    for n in range(1, 6):
        docs = spark.createDataFrame(rows[:n], "doc_id long, text string").withColumns({"part": F.lit(1), "kind": F.lit("x"), "following": F.lit("y")})
        assert sorted(map(tuple, E.beside_next(docs.repartition(3)).collect())) == plain_rows(rows[:n])
    assert E.beside_next(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(4, "one text here")] * 50 + [(None, "no id"), (None, None)], "doc_id long, text string")
    got = E.beside_next(same.repartition(7)).collect()
    assert len(got) == 52 and sum(r.near_next == 1 for r in got) >= 49 and sum(r.doc_id is None for r in got) == 2


@pytest.mark.parametrize("crowd", [3, 2048])
def test_near_duplicates_equal_all_pairs(spark, crowd, monkeypatch):
    r = random.Random(8)
    texts = [None, "", "short"]
    for _ in range(25):
        base = "".join(r.choice("abcdefghij ") for _ in range(r.randrange(50, 3000)))
        texts.append(base)
        for _ in range(r.randrange(6)):
            at = r.randrange(len(base) // 2, len(base))
            texts.append(base[:at] + r.choice(["", "x", "yy"]) + base[at:])
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (200, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit("kept"), "node": F.lit("kept"), "Fingerprint": F.lit("gone"), "key": F.lit("kept")})
    monkeypatch.setattr(E.links, "__defaults__", (E.LIKENESS, crowd))
    out = E.near_duplicates(docs.repartition(3))
    walker = E.Walker()
    prints = walker.prints(walker.walk([t for _, t in rows]))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        near = E.likeness(prints, np.broadcast_to(prints[i], prints.shape)) >= E.LIKENESS
        for j in np.flatnonzero(near).tolist():
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    want = sorted((str(d), least[find(i)], prints[i].tobytes()) for i, (d, _) in enumerate(rows))
    got = out.collect()
    assert sorted((str(x.doc_id), x.component_id, bytes(x.fingerprint)) for x in got) == want
    assert all(x.fp == x.node == x.key == "kept" for x in got) and out.columns.count("fingerprint") == 1
    assert E.near_duplicates(docs.limit(0)).count() == 0
