import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as pipe
from corvine.llm import toxicity

from .test_models import plain_score
from .test_near_duplicates import brute_alike, brute_print, closure

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = re.compile("[^\x20\x09-\x0d]+")


def corpus():
    """Clean, toxic, copied, nearly copied, leaking and passage-sharing documents, nulls and repeated ids."""
    r = random.Random(11)
    voc = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru") for b in ("ra", "te", "si", "do", "ba", "nu", "po")]
    text = lambda n: " ".join(r.choice(voc) for _ in range(n))
    items = [(k, text(14)) for k in range(4)] + [(9, "brief item"), (10, None)]
    passage = text(50)
    rows = [(i, ". ".join(text(9) for _ in range(r.randint(2, 14))) + (" vile scumbag." if i % 5 == 0 else ".")) for i in range(250)]
    labels = [(i, int(i % 5 == 0)) for i in range(250)]
    rows += [(1000 + i, text(40) + " " + passage + " " + text(i + 1)) for i in range(5)]
    long = text(120)
    rows += [(1100, long), (1101, long), (1102, long + " end"), (1103, long.upper())]
    rows += [(1200, text(30) + " " + items[0][1].upper() + "! " + text(20)), (1201, items[1][1]), (1202, text(25) + " Brief, item " + text(10))]
    rows += [(1300, None), (1301, ""), (1302, " \n"), (1303, text(30)), (1303, text(31)), (None, text(33))]
    return rows, labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("corpus")
    rows, labels, items = corpus()
    docs = [(i, t, "en", f"s{len(t or '') % 3}", len(t or "")) for i, t in rows]
    for name, data, schema in (("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"), ("labels", [(i, 0, y) for i, y in labels], "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, schema).coalesce(2).write.parquet(f"{at}/{name}.parquet")
    return str(at)


def without_windows(texts, length=35):
    words = [WORDS.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for t, w in zip(texts, words):
        gone = {j for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for j in range(i, i + length)}
        out.append(" ".join(x for j, x in enumerate(w) if j not in gone) if gone else t)
    return out


def without_leaks(text, items):
    """The text without covered spans, or False where more than half of the words are covered."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    at = [m.span() for m in re.finditer(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)]
    words, hit = [low[a:b] for a, b in at], set()
    for _, item in items:
        own = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        size = min(10, len(own))
        for k in range(len(own) - size + 1) if own else ():
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[k : k + size]:
                    hit.update(range(i, i + size))
    if len(hit) > 0.5 * len(words):
        return False
    if not hit:
        return text
    kept, last = [], 0
    for j in sorted(hit):
        if j - 1 not in hit:
            kept.append(text[last : at[j][0]])
        last = at[j][1]
    return " ".join(x.strip(" ") for x in [*kept, text[last:]]).strip(" ")


def packed(rows):
    from tokenizers import Tokenizer

    tok, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        start = 0
        while start < len(ids):
            size = 2048 if len(ids) - start >= 2048 else 1 << ((len(ids) - start).bit_length() - 1)
            out.append((i, start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes()), len(ids)))
            start += size
    return out


def test_run_equals_brute_force(spark, folder):
    assert [n for n, _ in pipe.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"] and pipe.ORACLE_SQL is None
    rows, labels, items = corpus()
    made = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(made, spark.read.parquet(f"{folder}/labels.parquet").where(~toxicity.held_out()))
    now = [(i, t) for i, t in rows if plain_score(t, model)[1] < 0.7]
    assert 180 < len(now) < len(rows) - 40
    prints = np.array([brute_print(t, 5) for _, t in now], np.uint64)
    near = (np.bitwise_count(prints[:, None] ^ prints[None]) <= 4) | brute_alike([t for _, t in now])
    root = closure(near, list(range(len(now))))
    kept = {}
    for k, (i, t) in sorted(enumerate(now), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        kept.setdefault(root[k], (i, t))
    now = list(kept.values())
    now = list(zip([i for i, _ in now], without_windows([t for _, t in now])))
    now = [(i, c) for i, t in now if (c := without_leaks(t, items)) is not False]
    got = pipe.run(spark, folder).collect()
    digest = lambda x: sorted(json.dumps(r) for r in x)
    assert digest((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == digest(packed(now))
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
    ids = {i for i, _ in now}
    assert {1100, 1200, 1202, 1300, 1303} <= ids and not ids & {0, 5, 1101, 1103, 1201}


def test_stages_keep_columns_and_bear_any_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.selectExpr("*", *[f"'kept' as {c}" for c in ("toxicity", "fp", "row", "key", "spans", "found", "repeats", "label", "id", "least")])
    for name, stage in pipe.STAGES[:-1]:
        out = stage(spark, odd, folder)
        assert out.columns == odd.columns, name
        rows = out.collect()
        assert rows and all(r.fp == r.key == r.found == r.toxicity == r.repeats == "kept" for r in rows), name
        assert stage(spark, odd.limit(0), folder).count() == 0, name
    assert pipe.STAGES[-1][1](spark, odd.limit(0), folder).count() == 0
    many = docs.selectExpr("cast(null as bigint) as doc_id", "text", "lang", "source", "n_chars")
    for name, stage in pipe.STAGES:
        assert stage(spark, many, folder).count() > 0, name


def test_sf_run_is_deterministic(spark, sf):
    a, b = (sorted((r.doc_id, r.start, r.ids_crc32) for r in pipe.run(spark, sf).collect()) for _ in range(2))
    assert a == b
    assert {r[0] for r in a} < {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
