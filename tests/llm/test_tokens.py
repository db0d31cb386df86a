import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvine.llm import packing, token_counts
from corvine.llm._text import HashIndex

P = pytest.importorskip("public_tokenizers")
PIECES = ["a", "the", " ", "  ", "\n", "\t", "é", "'s", "'LL", "1", "23", "²", "…", "!!", " ", "\x1c", "\x85", "日本", "aaaaaaaa", "<|endoftext|>", "<|startoftext|>", "_", "Σ", "ΑΣ", "İ", "\r\n", "e", "́", "😀", "​", "'", "S'T", "É.", "Ab,", "ß", "µ", "ª"]


def odd(n):
    r = random.Random(1)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 12))) for _ in range(n)] + ["a" * 3000, "", " ", "\n", "ab" * 900 + " x"]


def library(name, texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(P.path(name)).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library():
    texts = odd(3000)
    counter = token_counts.TokenCounter(P.path("byte_bpe_50k.json"))
    want = list(map(len, library("byte_bpe_50k.json", texts)))
    assert counter.texts(texts) == want == counter.texts(texts)
    assert counter.texts([None, "x"]) == [0, 1]


def test_forgetting_changes_nothing(monkeypatch):
    texts = odd(400)
    want = list(map(len, library("byte_bpe_50k.json", texts)))
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    counter = token_counts.TokenCounter(P.path("byte_bpe_50k.json"))
    assert [counter.texts([t])[0] for t in texts] == want


def test_ids_equal_the_library(monkeypatch):
    texts = odd(3000)
    want = [ids + [1] for ids in library("word_bpe_49k.json", texts)]
    for remembered in (1_500_000, 20):
        monkeypatch.setattr(packing, "REMEMBERED", remembered)
        words = packing.WordIds(P.path("word_bpe_49k.json"))
        for some in (slice(0, 1000), slice(1000, None), slice(0, 50)):
            ids, at = words.rows(pa.array(texts[some]))
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want[some]


def test_decomposition():
    for n in range(1, 3000):
        d = packing.decompose(n, 256)
        assert sum(k for _, k in d) == n and all(a + k == b for (a, k), (b, _) in zip(d, d[1:]))
        assert all(k & (k - 1) == 0 and k <= 256 for _, k in d)


def test_hash_index():
    r = np.random.default_rng(0)
    known = np.unique(r.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2))
    index = HashIndex(known)
    assert (index.find(known) == np.arange(len(known))).all()
    assert (index.find(known + np.uint64(1)) == -1).all()
    assert (HashIndex(known[:0]).find(known) == -1).all()


def test_packing_round_trip(spark):
    rows = [(1, "The cat, the dog.", 5), (1, "The cat, the dog.", 5), (None, None, 6), (3, "", None), (4, " ".join(f"w{i}" for i in range(900)), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = packing.pack(docs, P.path("word_bpe_49k.json"), most=512).collect()
    assert len({r.sequence_id for r in out}) == len(out) and all(r.offset == 0 and len(r.ids) == 4 * r.length for r in out)
    by = {}
    for r in sorted(out, key=lambda r: (r.sequence_id)):
        by.setdefault(r.doc_id, []).append(r)
    ids = lambda t: library("word_bpe_49k.json", [t or ""])[0] + [1]
    assert np.frombuffer(b"".join(r.ids for r in sorted(by[4], key=lambda r: r.start)), "<u4").tolist() == ids(rows[4][1])
    assert [r.length for r in by[None]] == [1] == [r.length for r in by[3]] and len(by[1]) == 2 * len(packing.decompose(len(ids(rows[0][1]))))
    first = next(r for r in out if r.doc_id == 1 and r.start == 0)
    got = packing.digest(packing.pack(docs, P.path("word_bpe_49k.json"), most=512)).where("doc_id = 1 and start = 0").first()
    assert got.ids_crc32 == zlib.crc32(first.ids)


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([("a b", "x")], "text string, n_tokens string")
    assert token_counts.count_tokens(docs, P.path("byte_bpe_50k.json")).first().n_tokens == 2
    none = docs.limit(0)
    assert token_counts.count_tokens(none, P.path("byte_bpe_50k.json")).count() == 0 == packing.pack(none, P.path("word_bpe_49k.json")).count()


def test_queries(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = dict(zip(docs, map(len, library("byte_bpe_50k.json", list(docs.values())))))
    for r in token_counts.op8_token_counts(spark, sf).collect():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), want[r.doc_id], want[r.doc_id] > 512)
    ids = {k: np.array(x + [1], "<u4") for k, x in zip(docs, library("word_bpe_49k.json", list(docs.values())))}
    got = packing.op4_packing(spark, sf).collect()
    assert all(zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id]) for r in got)
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    assert packing.op4_packing(spark, sf).where(F.expr("length & (length - 1)") != 0).count() == 0


def test_vocabularies_of_another_kind(tmp_path):
    """Packing encodes them whole; token counts refuse them."""
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    texts = ["Plain words, twice; plain words.", None, "", "Zoë's  42\n\ttabs"]
    ids, at = packing.WordIds(path).rows(pa.array(texts))
    tok = Tokenizer.from_file(path)
    want = [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.RankMerger(P.path("word_bpe_49k.json"))


@pytest.mark.parametrize("remembered", [1_000_000, 60])
def test_letters_are_asked_once_whatever_marks_follow(remembered, monkeypatch):
    """Words of letters (U+00FF at most) and ASCII marks: the library gets small letters once, and marks once."""
    from string import punctuation

    r = random.Random(5)
    core = ["".join(r.choice("abzAZàÀßÿÞþµªº×÷") for _ in range(r.randint(1, 6))) for _ in range(60)]
    mark = ["", "$$$", "&&&", ".%%%", "...", "'", "'s", "<|", "|>", "_", *punctuation]
    texts = [" ".join(r.choice(core) + r.choice(mark) for _ in range(40)) for _ in range(60)] + ["endoftext|> <|endoftext|> a<|endoftext|> <|ENDOFTEXT|>"]
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    words, asked = packing.WordIds(P.path("word_bpe_49k.json")), []
    encode = words.encode
    words.encode = lambda some, **k: asked.extend(w for line in some for w in line.split()) or encode(some, **k)
    want = [ids + [1] for ids in library("word_bpe_49k.json", texts)]
    for some in (slice(0, 30), slice(30, None), slice(0, 61)):
        ids, at = words.rows(pa.array(texts[some]))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want[some]
    letters = [w for w in asked if w.isalpha()]
    assert len(letters) == len(set(letters)) and not any(w.endswith(("$$$", "&&&")) and w[0].isalpha() and not set("×÷") & set(w) for w in asked)


def test_words_met_again_are_kept(monkeypatch):
    """Of a full memory the words that came again stay; one of a process lasts from task to task."""
    path = P.path("word_bpe_49k.json")
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    words = packing.WordIds(path)
    common = " ".join(f"c{i}" for i in range(20))
    for turn in range(4):
        words.rows(pa.array([common + " " + " ".join(f"{turn}x{i}" for i in range(20))]))
    asked, encode = [], words.encode
    words.encode = lambda some, **k: asked.extend(some) or encode(some, **k)
    words.rows(pa.array([common + " new1"]))
    assert asked == ["new1"]
    assert packing.word_ids(path) is packing.word_ids(path)


def test_vocabulary_with_capitals(tmp_path):
    """Without a step that makes letters small, words of one spelling only are alike; added words may lie in a word."""
    import json

    from tokenizers import Tokenizer

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    texts = ["The cat, THE CAT and the Cat.", "azqzqing Zqzq. zqzq", None]
    for change in ("capitals", "added"):
        other = json.loads(json.dumps(spec))
        if change == "capitals":
            other["normalizer"]["normalizers"] = [x for x in other["normalizer"]["normalizers"] if x["type"] != "Lowercase"]
        else:
            other["added_tokens"].append(other["added_tokens"][0] | {"content": "zqzq", "id": max(spec["model"]["vocab"].values()) + 1})
        path = str(tmp_path / f"{change}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(other, f)
        tok = Tokenizer.from_file(path)
        ids, at = packing.WordIds(path).rows(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
