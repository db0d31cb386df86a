"""Nulls, empty and very long texts, repeated rows and ids, empty tables and clashing names, for every operator."""

import random
import time

import pytest

from corvine.llm import alignment, ball_kmeans, decontaminate, edit_prints, fm_index, lm_score, packing, simhash, suffix_dedup, token_counts, topk, toxicity, warc
from corvine.llm._spark import Spool

public_tokenizers = pytest.importorskip("public_tokenizers")
CLASHES = ("fp", "row", "KEY", "_pieces", "Cuts", "speaks", "digest", "sets", "spans", "found", "pieces", "block", "kind", "part", "label", "id", "least", "root", "node", "a", "b", "no", "n", "anchor", "sid", "text_", "words", "first")


def labels(docs):
    return docs.sparkSession.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")


def items(docs):
    return docs.sparkSession.createDataFrame([(1, "w1 w2 w3"), (None, "w4"), (2, None), (3, "")], "item_id long, text string")


OPERATORS = {
    "toxicity": lambda d: toxicity.score_documents(d, labels(d)),
    "simhash": simhash.near_duplicates,
    "deduplicate": simhash.deduplicate,
    "lm_score": lambda d: lm_score.score_documents(d)[0],
    "packing": lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json")),
    "contamination": lambda d: decontaminate.contamination(d, items(d)),
    "decontaminate": lambda d: decontaminate.decontaminate(d, items(d)),
    "dedup_words": fm_index.dedup_words,
    "remove_repeats": fm_index.remove_repeats,
    "dedup_bytes": suffix_dedup.dedup_bytes,
    "deduplicate_similar": lambda d: simhash.deduplicate(d, size=5, least=0.8),
    "alignment": lambda d: alignment.align_documents(d, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")),
    "edit_prints": edit_prints.near_duplicates,
    "token_counts": lambda d: token_counts.count_tokens(d, public_tokenizers.path("byte_bpe_50k.json")),
}


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(12)
    long = " ".join(f"w{r.randrange(3000)}" for _ in range(900_000))  # 5 MB
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, "plain words of a text"), (5, "plain words of a text"), (5, "other words under the same id"), (None, "words without an id"), (6, "é中 \U0001f600 \u0000 odd"), (7, "!!! ...")]
    df = spark.createDataFrame([(i, t, "kept") for i, t in rows], "doc_id long, text string, extra string")
    return df.selectExpr("*", *[f"'kept' as `{c}`" for c in CLASHES])


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_and_column_is_accounted_for(spark, docs, name):
    out = OPERATORS[name](docs)
    made = {"packing": {"start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset"}}.get(name, set())
    some = [c for c in ("extra", *CLASHES) if c not in made]
    rows = out.select("doc_id", *some).collect()
    assert all(set(r[1:]) == {"kept"} for r in rows)
    want = [1, 2, 3, 4, 5, 5, 5, 6, 7, None]
    if name == "packing":
        assert {r.doc_id for r in rows} == set(want)
    elif name in ("deduplicate", "deduplicate_similar"):  # texts without words are one group, equal texts another
        assert sorted(r.doc_id or 0 for r in rows) == sorted([1, 4, 5, 5, 6, 7, 0])
    else:
        assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, want))
    assert OPERATORS[name](docs.limit(0)).count() == 0


#: Names of each operator's results, and of columns that it makes on its way.
MADE = {
    "toxicity": ["toxicity"], "simhash": ["fingerprint", "component_id"], "deduplicate": ["fp"], "deduplicate_similar": ["sets"], "lm_score": ["lm"],
    "packing": ["start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset", "_pieces"], "contamination": ["found"], "decontaminate": ["spans"],
    "dedup_words": ["repeats"], "remove_repeats": ["repeats"], "dedup_bytes": ["repeats"], "alignment": ["n_a", "n_best", "groups_sha256", "pairs", "place"],
    "edit_prints": ["fingerprint", "component_id"], "token_counts": ["n_tokens"],
}


@pytest.mark.parametrize("case", [str.lower, str.upper, str.title])
@pytest.mark.parametrize("name", OPERATORS)
def test_names_in_any_letter_case(spark, name, case):
    docs = spark.createDataFrame([(1, "some words of one text"), (2, None)], "doc_id long, text string").selectExpr("*", *[f"'x' as `{case(c)}`" for c in MADE[name]])
    out = OPERATORS[name](docs)
    names = [c.lower() for c in out.columns]
    assert out.collect() and len(names) == len(set(names))


def test_a_word_of_millions_of_letters(spark):
    from tokenizers import Tokenizer

    r = random.Random(9)
    text = "".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", k=5_000_000))
    start = time.time()
    got = token_counts.TokenCounter(public_tokenizers.path("byte_bpe_50k.json")).texts([text, text[:100_000] + "the" * 50_000])
    assert time.time() - start < 60  # 10 s on an idle machine
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert got[1] == len(tok.encode(text[:100_000] + "the" * 50_000).ids) and got[0] == len(tok.encode(text).ids)


def test_no_training_documents(spark):
    held = spark.createDataFrame([(i, "some words") for i in range(60)], "doc_id long, text string").where(lm_score.held_out())
    rows = lm_score.score_documents(held)[0].collect()
    assert rows and all(r.lm.n_tokens == 3 and r.lm.n_known == 0 and r.lm.score == r.lm.base_score for r in rows)
    one = spark.createDataFrame([(None, "one text")], "doc_id long, text string")
    assert lm_score.score_documents(one)[0].first().lm.n_known == 3


def test_archives_of_empty_tables_and_long_payloads(spark):
    long = "x" * 3_000_000
    for rows in ([], [(1, "http://a", long), (2, "http://b", long), (2, "http://b", long), (None, None, None)]):
        at = Spool(spark, "cases").path("archives")
        warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as _id", "'y' as payload"), at)
        got = warc.assemble(warc.read_records(spark, at)).collect()
        assert len(got) == len(rows)
        assert sorted(r.response.type for r in got) == ["response", "response", "response", "revisit"][: len(rows)]


def test_vectors_with_clashing_names(spark):
    rows = [(i, [float(i), 1.0], "x", 5) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, block string, pivot int")
    assert topk.top_k(df, k=3).count() == 9 and topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.limit(1)).count() == 0
