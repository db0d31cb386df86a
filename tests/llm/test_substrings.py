import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corvine.llm import fm_index, repeats, suffix_dedup
from corvine.llm.gsaca import suffix_array
from corvine.llm.repeats import Scheme


def word_brute(texts, length):
    rows = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in rows for i in range(len(w) - length + 1))
    out = []
    for w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g).encode()))
    return out


def byte_brute(texts, length):
    rows = [(t or "").encode() for t in texts]
    seen = Counter(w[i : i + length] for w in rows for i in range(len(w) - length + 1))
    out = []
    for w in rows:
        gone = bytearray(len(w))
        for i in range(len(w) - length + 1):
            if seen[w[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((len(w), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(w, gone) if not g)))
    return out


def texts(seed):
    r = random.Random(seed)
    voc = ["a", "b", "c", "é", "dd"]
    shared = [" ".join(r.choice(voc) for _ in range(30)) for _ in range(5)]
    out = [None, "", " ", "a " * 120, "x" * 300, "x" * 300, "ab" * 90, "\t a b \n"]
    for _ in range(40):
        out.append(" ".join(r.choice([r.choice(shared), " ".join(r.choice(voc) + str(r.randint(0, 30)) for _ in range(r.randint(1, 40)))]) for _ in range(r.randint(0, 5))))
    return out + out[10:14]


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array(seed):
    r = random.Random(seed)
    for _ in range(40):
        t = [r.randint(1, r.choice([1, 2, 3, 9, 50])) for _ in range(r.randint(0, 40))]
        t = (t * 4)[:60] + [0]
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("length,block", [(16, 8), (40, 8), (79, 16), (131, 16), (159, 32), (200, 32), (900, 32)])
def test_sorted_blocks_are_wide_and_ends_are_compared(length, block, monkeypatch):
    """The suffix array has a symbol for each `block` bytes; windows that differ in one byte of an end are told apart."""
    r, scheme, sorted_ = random.Random(length), Scheme("byte", length), []
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text: sorted_.append(len(text)) or suffix_array(text))
    base = bytes(r.randrange(256) for _ in range(length + 70))
    segs, offs = [base], [length // 2]
    for spot in [*range(0, 40), *range(length + 30, length + 70)]:
        segs.append(base[:spot] + bytes([base[spot] ^ 1]) + base[spot + 1 :])
        offs.append(offs[0])
    # cut at the front, so that ends of every size occur
    for cut in range(1, 40):
        segs.append(segs[cut][cut:])
        offs.append(offs[0] - cut)
    keep = [i for i, o in enumerate(offs) if o >= 0]
    segs, offs = [segs[i] for i in keep], [offs[i] for i in keep]
    seg, lo, hi = suffix_dedup.sa_kernel(segs, np.array(offs, np.int64), len(segs), scheme)
    found = {(s, x) for s, a, b in zip(seg.tolist(), lo.tolist(), hi.tolist()) for x in range(a, b)}
    place = lambda s, x: (segs[s][x : x + length], offs[s] - x)
    every = [(s, x) for s in range(len(segs)) for x in range(len(segs[s]) - length + 1)]
    seen = Counter(place(s, x) for s, x in every)
    assert found == {w for w in every if seen[place(*w)] > 1} and found
    assert sum(sorted_) <= sum(map(len, segs)) // block + len(segs) + 1


@pytest.mark.parametrize("unit,length,kernel", [("word", 12, fm_index.fm_kernel), ("byte", 40, suffix_dedup.sa_kernel), ("byte", 131, suffix_dedup.sa_kernel), ("word", 35, fm_index.fm_kernel)])
@pytest.mark.parametrize("seed", range(4))
def test_kernel_on_all_segments_equals_brute_force(unit, length, kernel, seed):
    """Runs, segments and kernel without Spark: each run's flags must be those of its windows."""
    rows, scheme = texts(seed), Scheme(unit, length)
    u = repeats.units(pa.array(rows, pa.string()), scheme)
    row, first, last, place, anchor = repeats.runs(u, scheme)
    raw = u.data.tobytes()
    items = [raw] if unit == "byte" else [raw[a:b] for a, b in zip(u.starts, u.ends)]
    cut = (lambda a, b: raw[a:b]) if unit == "byte" else (lambda a, b: b" ".join(items[a:b]))
    segs = Counter((cut(a, b + length), p - a) for a, b, p in zip(first.tolist(), last.tolist(), place.tolist()))
    keys = list(segs)
    all_ = keys + [k for k in keys if segs[k] > 1]
    seg, lo, hi = kernel([k for k, _ in all_], np.array([o for _, o in all_], np.int64), len(keys), scheme)
    found = {}
    for s, a, b in zip(seg.tolist(), lo.tolist(), hi.tolist()):
        found.setdefault(keys[s], []).append((a, b))
    gone = np.zeros(int(u.before[-1]), bool)
    for a, b, p in zip(first.tolist(), last.tolist(), place.tolist()):
        for x, y in found.get((cut(a, b + length), p - a), []):
            gone[a + x : a + y - 1 + length] = True
    want = (byte_brute if unit == "byte" else word_brute)(rows, length)
    assert [int(gone[a:b].sum()) for a, b in zip(u.before, u.before[1:])] == [w[1] for w in want]


@pytest.mark.parametrize("unit,length,kernel", [("word", 12, fm_index.fm_kernel), ("byte", 40, suffix_dedup.sa_kernel)])
def test_kernel_tells_copies_by_the_index_alone(unit, length, kernel):
    """No counts reach a kernel: a segment is repeated if it lies in the index twice, in any order and neighbourhood."""
    r, scheme = random.Random(1), Scheme(unit, length)
    segs = [b" ".join(str(r.randrange(10**6)).encode() for _ in range(r.randint(14, 24))) for _ in range(30)]
    size = (lambda x: len(x)) if unit == "byte" else (lambda x: len(x.split()))
    again = list(range(0, 30, 3))
    for order in (again, again[::-1]):
        seg, lo, hi = kernel(segs + [segs[i] for i in order], np.zeros(40, np.int64), 30, scheme)
        assert list(zip(seg.tolist(), lo.tolist(), hi.tolist())) == [(i, 0, size(segs[i]) - length + 1) for i in again]
    seg, lo, hi = kernel(segs, np.zeros(30, np.int64), 30, scheme)
    assert not len(seg)


def test_labels_of_rows_that_share_a_hash(monkeypatch):
    r = np.random.default_rng(2)
    keys = [r.integers(0, 3, 200), r.integers(0, 3, 200).astype(np.uint64)]
    want = np.unique(keys[0] * 3 + keys[1].astype(np.int64), return_inverse=True)[1]
    for mix in (suffix_dedup.mix, lambda h: h & np.uint64(0), lambda h: h & np.uint64(3)):
        monkeypatch.setattr(suffix_dedup, "mix", mix)
        label = suffix_dedup._labels(*keys)
        assert len(set(zip(label.tolist(), want.tolist()))) == len(set(want.tolist())) == len(set(label.tolist()))


@pytest.mark.parametrize("depth", [1, 3, 8])
def test_backward_search_within_its_depth(depth):
    r = np.random.default_rng(depth)
    text = np.append(r.integers(1, 4, 400), 0)
    index = fm_index.FMIndex(text, 4, depth)
    for start in range(0, 380, 7):
        pattern = text[start : start + depth]
        lo, hi = np.zeros(1, np.int64), np.full(1, index.n)
        for symbol in pattern[::-1]:
            lo, hi = index.back(np.array([symbol]), lo, hi)
        assert hi[0] - lo[0] == sum((text[i : i + depth] == pattern).all() for i in range(400 - depth + 1))


@pytest.mark.parametrize("crowd", [512, 1])
def test_both_operators(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rows = texts(7)
    df = spark.createDataFrame([(i if i != 3 else None, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, key string").repartition(3)
    order = {t: i for i, t in enumerate(rows)}
    for op, brute, length in ((fm_index.dedup_words, word_brute, 12), (suffix_dedup.dedup_bytes, byte_brute, 40)):
        want = brute(rows, length)
        got = op(df, length=length).collect()
        assert len(got) == len(rows)
        for g in got:
            w = want[order[g.text]]
            assert (g.repeats.n_units, g.repeats.n_removed, bytes(g.repeats.kept)) == (w[0], w[1], w[-1]) and g.key == "x"
            if len(w) == 4:
                assert g.repeats.n_spans == w[2]


def test_queries_equal_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = {r.doc_id: (w[0], w[1], digest(w[2])) for r, w in zip(rows, word_brute([r.text for r in rows], 35))}
    assert {r.doc_id: tuple(r)[1:] for r in fm_index.op7_fm_index(spark, sf).collect()} == want
    want = {r.doc_id: (*w[:3], digest(w[3])) for r, w in zip(rows, byte_brute([r.text for r in rows], 200))}
    assert {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op9_suffix_array(spark, sf).collect()} == want


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fm_index.dedup_words(none).count() == 0 == suffix_dedup.dedup_bytes(none).count()


def test_clean_texts_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, "some  text\n here"), (2, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in fm_index.remove_repeats(df).collect()) == [(1, "some  text\n here"), (2, None)]
