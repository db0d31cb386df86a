import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corvine.llm import decontaminate, lm_score, toxicity


def make(n, seed=0):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        bad = r.random() < 0.3
        sentences = [" ".join(r.choice(words) for _ in range(8)) for _ in range(r.randint(1, 8))]
        if bad:
            at = r.randrange(len(sentences))
            sentences[at] += " " + r.choice(["vile", "scumbag", "awful" + r.choice(words)])
        rows.append((i, ". ".join(sentences) + ".", int(bad)))
    return rows


def plain_score(text, model):
    """Sentence probabilities and score of a text, word by word."""
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    low = re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    probabilities = []
    for sentence in re.split(rb"[\n!.?]", low):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", sentence)
        if words:
            z = model.bias
            for w in words:
                kinds = toxicity.features(pa.array([w], pa.binary()))[0]
                z += sum(weight.get(int(k[0]), 0.0) for k in kinds if k[0])
            probabilities.append(1 / (1 + math.exp(-z)))
    return probabilities, 1 - math.prod(1 - p for p in probabilities)


def test_toxicity_query_equals_plain_scoring(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")  # the smallest tables have too few labels to learn from
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    assert len(model.hashes)
    got = {r.doc_id: r for r in toxicity.op1_toxicity(spark, sf).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        each, score = plain_score(r.text, model)
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-9) and got[r.doc_id].predicted == (score >= 0.7)
        assert got[r.doc_id].n_offending == sum(p >= 0.5 for p in each)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_noisy_or_learns_from_document_labels_and_locates_sentences(spark):
    rows = make(800)
    model = toxicity.train(spark.createDataFrame(rows[:500], "doc_id long, text string, y int"), spark.createDataFrame([(i, y) for i, _, y in rows[:500]], "doc_id long, toxic int"))
    model.prepare()
    held = rows[500:]
    logit, doc, span = model.sentences(pa.array([t for _, t, _ in held]))
    off = np.bincount(doc, -np.logaddexp(0, logit), len(held))
    score = -np.expm1(off)
    y = np.array([y for _, _, y in held])
    assert ((score >= toxicity.THRESHOLD) == y).mean() > 0.95
    for i in np.flatnonzero(logit > 0).tolist():
        text = held[doc[i]][1].encode()[span[i, 0] : span[i, 1]].decode()
        assert re.search("vile|scumbag|awful", text)


def test_the_fit_cannot_be_bettered_by_small_steps(spark):
    rows = make(300, 4)
    f = np.unique(np.concatenate([toxicity.features(pa.array([w]))[0][0] for w in ("vile", "scumbag", "w1", "w2", "w3")]))
    texts, y = pa.array([t for _, t, _ in rows]), np.array([y for _, _, y in rows])
    sizes, numbers, plain = toxicity.bags(texts, f)
    assert [len(x) + n for x, n in zip(sizes, plain)] == [t.count(".") for _, t, _ in rows]
    model = toxicity.fit(sizes, numbers, plain, y, f, np.ones(len(f), bool), rounds=600, rate=0.1, decay=0.05)
    w = dict(zip(model.hashes.tolist(), model.weights.tolist()))

    def loss(weights, bias):
        m = toxicity.Model(f, weights, bias)
        off = [min(max(plain_score(t, m)[1], 1e-12), 1 - 1e-12) for _, t, _ in rows]
        return -sum(math.log(p if k else 1 - p) for p, k in zip(off, y)) + 0.025 * sum(x * x for x in weights)

    at, bias = np.array([w.get(int(h), 0.0) for h in f]), model.bias
    best = loss(at, bias)
    for i in range(len(f)):
        for step in (-0.5, 0.5):
            assert loss(at + step * (np.arange(len(f)) == i), bias) > best - 0.05
    assert min(loss(at, bias - 0.5), loss(at, bias + 0.5)) > best - 0.05


def test_a_word_of_clean_and_toxic_texts_counts(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(6)) + (" vexing" if r.random() < (0.8 if i % 3 == 0 else 0.2) else "") + ".", int(i % 3 == 0)) for i in range(900)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, y int"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert plain_score("vexing", model)[1] > 0.5 > plain_score("alpha beta", model)[1]


def test_toxicity_cases(spark):
    rows = make(600, 1)
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(None, "vile", "s"), (9001, None, "s"), (9002, "", "s"), (9003, "!!! ...", None), (9004, "ok. " * 20000 + "vile scumbag.", "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (777777, 1)], "doc_id long, toxic int")
    out = {r.doc_id: r.toxicity for r in toxicity.score_documents(docs, labels).collect()}
    assert out[9001].score == out[9002].score == out[9003].score == 0.0 and out[9001].sentences == []
    assert out[9004].score > 0.7 and all(0 <= r.score <= 1 for r in out.values())
    none = toxicity.score_documents(docs, labels.limit(0)).where("toxicity.score >= 0.7")
    assert none.count() == 0
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_never_learned(spark):
    rows = make(300, 2)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    fold = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    a = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    b = spark.createDataFrame([(i, 1 - y if fold(i) else y) for i, _, y in rows], "doc_id long, toxic int")
    scores = [{r.doc_id: r.toxicity.score for r in toxicity.score_documents(docs, x).collect()} for x in (a, b)]
    assert scores[0] == scores[1]


def find(t):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


@pytest.mark.parametrize("bound", [128 << 20, 0])
def test_base_scores_are_exact(spark, monkeypatch, bound):
    monkeypatch.setattr(lm_score, "MOST_TABLE", bound)
    monkeypatch.setattr(lm_score, "BLOCK_ROWS", 16)
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("abcdefgh") * r.randint(1, 2) for _ in range(r.randint(0, 30)))) for i in range(80)] + [(100, None), (101, ""), (None, "A b"), (5, "same id"), (102, "zzz unseen Words")]
    scored, model = lm_score.score_documents(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, lm int"))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, t in rows if not held(i) for w in find(t))
    n, v = sum(c.values()), len(c)
    assert (model.total, model.distinct) == (n, v)
    want = sorted((len(find(t)), sum(c[w] > 0 for w in find(t)), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in find(t)), 6)) for _, t in rows)
    got = scored.select("lm.*").collect()
    assert sorted((g.n_tokens, g.n_known, round(g.base_score, 6)) for g in got) == want and all(g.score <= 0 for g in got)


def test_scores_do_not_depend_on_the_path(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_ROWS", 16)
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["a b c", "d e", "f g h a", "b d"]) for _ in range(r.randint(0, 15)))) for i in range(120)] + [(200, None), (201, ""), (202, "zzz unseen Words")]
    docs, got, weights = spark.createDataFrame(rows, "doc_id long, text string"), [], []
    for name, bound in (("MOST_TABLE", 128 << 20), ("MOST_TABLE", 0), ("MOST_FILTER", 0)):
        monkeypatch.setattr(lm_score, "MOST_TABLE", 128 << 20)
        monkeypatch.setattr(lm_score, name, bound)
        scored, model = lm_score.score_documents(docs)
        assert model.small == (bound > 0)
        got.append(sorted((x.doc_id, x.lm.n_tokens, round(x.lm.base_score, 9), round(x.lm.score, 9)) for x in scored.collect()))
        weights.append(model.weights.tolist())
    assert weights[0] == weights[1] == weights[2] and any(weights[0])
    assert got[0] == got[1] == got[2]


def test_query_equals_exact_quantised_counts(spark, sf, monkeypatch):
    """Every score of the whole table by plain counting; bits enough that the filter has no false positives."""
    monkeypatch.setattr(lm_score, "BITS_PER_KEY", 96)
    docs = [(r.doc_id, find(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    training = [w for i, w in docs if not held(i)]
    one, two = Counter(t for w in training for t in w), Counter(p for w in training for p in zip(["start", *w], w))
    n, v = sum(one.values()), len(one)
    quantised = lambda c: 2 ** (math.floor(2 * math.log2(c) + 1e-9) / 2) if c > 1 else c

    def parts(words, own):
        for past, t in zip(["start", *words], words):
            uni, context = (one[t] + 0.5) / (n + 0.5 * (v + 1)), len(training) if past == "start" else one[past]
            seen = min(quantised(two[past, t]), context, one[t]) if context and one[t] else 0
            yield uni, context, max(seen - own, 0) / context / uni if seen else 0.0

    cells = Counter()
    for w in training:
        for _, context, ratio in parts(w, 1):
            cells[context.bit_length(), min(max(math.floor(math.log10(ratio) * 10) + 41, 1), 120) if ratio else 0] += 1
    weights = []
    for b in range(lm_score.BUCKETS):
        own = {k[1]: m for k, m in cells.items() if k[0] == b}
        grid = [0.0, *(1e-4 * (0.999 / 1e-4) ** (i / 199) for i in range(200))]
        gain = lambda g: sum(m * math.log(1 - g + g * (10 ** ((k - 40.5) / 10) if k else 0)) for k, m in own.items())  # noqa: E731, B023
        weights.append(max(grid, key=gain) if own else 0.0)
    got = {r.doc_id: r for r in lm_score.op3_lm_score(spark, sf).collect()}
    for i, w in docs:
        base = sum(math.log10(u) for u, _, _ in parts(w, 0))
        score = sum(math.log10(u) + math.log10(1 - weights[c.bit_length()] + weights[c.bit_length()] * r) for u, c, r in parts(w, 0))
        g = got[i]
        assert (g.n_tokens, g.n_known, g.train_tokens, g.held_out) == (len(w), sum(one[t] > 0 for t in w), n, held(i))
        assert g.base_score == pytest.approx(base, rel=1e-9) and g.score == pytest.approx(score, rel=1e-6)
    out = [got[i] for i, _ in docs if held(i)]
    assert sum(g.score for g in out) > sum(g.base_score for g in out)  # held-out texts are likelier under the model


def test_weights_are_fitted_on_all_training_documents(spark):
    r = random.Random(7)
    rows = [(i, " ".join(r.choice(["a b c", "d e", "f g h a", "b d"]) for _ in range(12))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").where("pmod(xxhash64(doc_id, text), 8) <> 0")
    _, model = lm_score.score_documents(docs)
    whole = lm_score.train(training := docs.where(~lm_score.held_out()))
    whole.tune(training, "text", whole.share())
    assert any(whole.weights) and model.weights.tolist() == whole.weights.tolist()


def test_bigrams_that_occur_once_are_seen(spark):
    # "q r" occurs once, "p q" twice and "q p" never
    rows = [(i, "a b c") for i in range(300) if zlib.crc32(str(i).encode()) % 5 != 1] + [(1000 + i, f"p{i} q{i}") for i in range(40) if zlib.crc32(str(1000 + i).encode()) % 5 != 1] + [(None, "p q"), (None, "p q r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_score.train(docs)
    shared = model.share()
    own = shared.value[1]
    pair = lambda t: lm_score.pair_hash(*reversed(lm_score.tokens(pa.array([t]))[:2]))[1:2]
    once, twice, never = (int(own.levels(pair(t))[0]) for t in ("q r", "p q", "q p"))
    assert once == 1 and twice == 2 and never == 0
    counts = np.arange(0, 5000)
    level = lm_score.stored_level(counts)
    low = lm_score.stored_count(level)
    assert level[:3].tolist() == [0, 1, 2] and (low <= counts + 1e-6).all() and (low[:3] == [0, 1, 2]).all() and (np.diff(level) >= 0).all()
    model.weights = np.full(lm_score.BUCKETS, 0.5)
    ask = spark.createDataFrame([(1, "q r"), (2, "r q")], "doc_id long, text string")
    got = {x.doc_id: x.lm for x in lm_score.score(ask, model, shared).collect()}
    assert got[1].base_score == pytest.approx(got[2].base_score) and got[1].score > got[2].score


def test_filter_keeps_every_level():
    r = np.random.default_rng(1)
    pair = np.unique(r.integers(0, 2**63, 4000).astype(np.uint64) * np.uint64(2))
    counts = r.integers(1, 5000, len(pair))
    level = lm_score.level_of(counts)
    assert (level[counts < 2] == 0).all() and (lm_score.count_of(level)[level > 0] <= counts[level > 0] + 1e-6).all()
    assert (lm_score.count_of(level + 1)[counts >= 2] > counts[counts >= 2]).all()
    part = (pair >> np.uint64(32)).astype(np.int64) * 256 >> 32
    keys = np.bincount(part, level, 256).astype(np.int64)
    lines = np.where(keys > 0, lm_score._lines(keys, 12), 0)
    fields = [lm_score._field(pair[part == p], level[part == p], int(keys[p]), 256, 12) for p in range(256) if keys[p]]
    f = lm_score.Filter(np.cumsum(lines) - lines, lines, np.concatenate(fields))
    assert len(f.bits) == lines.sum() * 8
    found = f.levels(pair)
    assert (found >= level).all() and (found > level).mean() < 0.03
    assert (f.levels(pair + np.uint64(1)) > 0).mean() < 0.03


def test_packs_in_two_levels_hold_the_same_counts(spark, monkeypatch):
    r = random.Random(8)
    docs = spark.createDataFrame([(i, " ".join(f"w{r.randrange(90)}" for _ in range(30))) for i in range(60)], "doc_id long, text string")

    def counted():
        m = lm_score.train(docs)
        words = {}
        for row in m.words.collect():
            words.update(zip(np.frombuffer(row.hashes, np.uint64).tolist(), np.frombuffer(row["values"], "<i8").tolist()))
        return m.ranges, words, m.total, m.distinct

    one = counted()
    monkeypatch.setattr(lm_score, "RANGE_BYTES", 8)
    monkeypatch.setattr(lm_score, "FLUSH", 100)
    two = counted()
    assert one[0] == 256 and two[0] > 256 and one[1:] == two[1:] and len(one[1]) == 91


def test_empty_corpora(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm_score.score_documents(none)[0].count() == 0


def brute(text: str | None, items: list[tuple[str, str | None]], length: int = 10) -> tuple[int, int, int, str, bool]:
    """The contract's columns for one document, by comparing every window."""
    find = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, names = find(text), set(), set()
    for name, item in items:
        own = find(item)
        size = min(length, len(own))
        for k in range(len(own) - size + 1) if own else ():
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[k : k + size]:
                    hit.update(range(i, i + size))
                    names.add(str(name))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_contamination_equals_brute_force(spark, monkeypatch):
    r = random.Random(3)
    voc = "a b c D é".split()
    items = [(i, " ".join(r.choice(voc) for _ in range(r.choice([0, 2, 3, 5, 9, 10, 11, 12, 30])))) for i in range(12)] + [(3, None)]
    docs = [(i, " ".join(r.choice(voc) for _ in range(r.randint(0, 60))) if i else None, "x") for i in range(100)]
    # one block; several in a pass; several passes; short pieces and lanes
    for size, together, piece, lane in ((4 << 20, 16 << 20, 1 << 14, 128), (30, 16 << 20, 1 << 14, 128), (30, 60, 1 << 14, 128), (60, 120, 3, 4)):
        for name, value in {"BLOCK_BYTES": size, "PASS_BYTES": together, "PIECE": piece, "LANE": lane}.items():
            monkeypatch.setattr(decontaminate, name, value)
        found = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string, items string"), spark.createDataFrame(items, "item_id long, text string"))
        for g in found.collect():
            c = g.contamination
            w = brute(g.text, items)
            digest = hashlib.sha256(",".join(c["items"]).encode()).hexdigest()
            assert (c.n_words, sum(s.stop - s.start for s in c.spans), len(c["items"]), digest, bool(c.spans)) == w
            assert all(a.stop < b.start for a, b in zip(c.spans, c.spans[1:]))
            words = [m.span() for m in re.finditer(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (g.text or "").encode())]
            assert [(b.start, b.stop) for b in c.bytes] == [(words[s.start][0], words[s.stop - 1][1]) for s in c.spans]


def test_decontamination_cuts_leaks_only(spark):
    leak = " ".join(f"q{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"before it, {leak.upper()} after  it " + "word " * 30), (2, leak), (3, "clean  text"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: "before it, after  it " + ("word " * 30).strip(), 3: "clean  text", 4: None}
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 4


def test_query_finds_planted_passages(spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in decontaminate.op6_decontaminate(spark, sf).collect()}
    for i in sorted(docs)[:25]:
        assert got[i] == brute(docs[i], items)


def test_automaton_equals_all_windows():
    r = random.Random(5)
    for case in range(40):
        length = r.choice([2, 3, 5])
        items = [" ".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in range(r.randint(0, 6))]
        text = " ".join(r.choice("abcd") for _ in range(r.randint(0, 80)))
        made = decontaminate.Automaton(items, list(range(len(items))), length)
        made = decontaminate.Automaton.load(length, made.shortest, made.dump())
        data, starts, ends, before = decontaminate.normal_words(pa.array([text, "", text]))
        first, stop, place, item = made.match(decontaminate.hash_spans(data, starts, ends), before)
        want = brute(text, list(enumerate(items)), length)
        half = len(text.split())
        assert len({i for a, b in zip(first.tolist(), stop.tolist()) for i in range(a, b) if i < half}) == want[1]
        assert len(set(item[place < half].tolist())) == want[2] == len(set(item[place >= half].tolist()))
