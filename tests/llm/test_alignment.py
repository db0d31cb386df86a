"""Alignment against a plain version that encodes whole texts with both libraries and compares all byte ranges."""

import hashlib
from collections import Counter

import pytest

from corvine.llm import alignment

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n", "a", "a▁b", "▁", "two  blanks", " leading", "trailing ", "tab\there", "<|endoftext|> <s> </s> <0x41>", "line\nends\nhere", "a\n\nb", "é中 \U0001f600 \u0000 odd", "no break", "x" * 300, "'s 't don't\n's", "​zero", "Ａｂｃ ﬁ", "1234567 89", "a\r\nb", "a \n b", "a \nb"]


def plain(texts):
    """Per text its result without the sums over links, and its links."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    from corvine.llm.token_counts import byte_symbols

    byte_of = {c: b for b, c in enumerate(byte_symbols())}
    out = []
    for text in texts:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        raw_a = [bytes(byte_of[c] for c in t.id_to_token(i)) for i in a]
        raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            out.append((0, 0, 0, 0, "", []))
            continue
        ends = [[sum(map(len, raw[: i + 1])) for i in range(len(raw))] for raw in (raw_a, raw_b)] if len(text) < 5000 else [list(__import__("itertools").accumulate(map(len, raw))) for raw in (raw_a, raw_b)]
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = i, j
            while i < len(a) and ends[0][i] <= cut:
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
            for p in range(x, i):
                for q in range(y, j):
                    if max(ends[0][p] - len(raw_a[p]), ends[1][q] - len(raw_b[q])) < min(ends[0][p], ends[1][q]):
                        links.append((a[p], b[q]))
        out.append((len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    return out


def with_sums(rows):
    count = Counter(x for r in rows for x in r[5])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(*r[:5], sum(count[x] == most[x[1]] for x in r[5]), sum(count[x] for x in r[5])) for r in rows]


def test_odd_texts_in_every_order():
    aligner, want = alignment.Aligner(A, B), plain(ODD)
    assert aligner.encoder.by_word
    for step in (1, 5, 7):
        some = [i * step % len(ODD) for i in range(len(ODD))]
        got = aligner.texts([ODD[i] for i in some])
        assert list(zip(*[got[c].tolist() if c != "groups_sha256" else got[c] for c in alignment.COUNTS], strict=True)) == [want[i][:5] for i in some]
    aligner.encoder.by_word = False  # the way of other vocabularies
    got = aligner.texts(ODD)
    assert got["groups_sha256"] == [w[4] for w in want] and got["n_links"].tolist() == [w[3] for w in want]
    assert want[5][0] == want[6][0] == 0 and want[7][0] > 0


@pytest.mark.parametrize("block", [1, 30_000, 8 << 20])
def test_operator_on_whole_table(spark, sf, block):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-i, t) for i, t in enumerate(ODD)] + [(None, "a null id"), (-5, "a repeated id")], docs.schema))
    docs = docs.withColumns({"docs": F.lit("kept"), "Pair": F.lit("kept"), "N_A": F.lit("gone"), "block": F.lit(1), "owner": F.lit(2)})
    rows = docs.select("doc_id", "text").collect()
    want = sorted(zip([str(r.doc_id) for r in rows], with_sums(plain([r.text for r in rows])), strict=True))
    out = alignment.align_documents(docs.repartition(3), A, B, block=block)
    got = out.collect()
    assert sorted((str(r.doc_id), (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum)) for r in got) == want
    assert all(r.docs == r.Pair == "kept" and (r.block, r.owner) == (1, 2) for r in got) and "N_A" not in out.columns
    assert alignment.align_documents(docs.limit(0), A, B).count() == 0


def test_groups_column_and_long_texts(spark):
    long = "words of many kinds, " * 100_000 + "x" * 200_000
    rows = spark.createDataFrame([(long,), (None,), ("plain words",), ("a▁",)], "text string")
    got = [r.g for r in rows.select(alignment.align("text", A, B).alias("g")).collect()]
    for groups, want in zip(got, plain([long, None, "plain words", "a▁"]), strict=True):
        shown = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in groups)
        assert (hashlib.sha256(shown.encode()).hexdigest() if groups else "") == want[4]


def test_a_row_group_holds_one_block(spark):
    """Blocks are large rows: readers decode all rows of a row group at once."""
    import glob

    import pyarrow.parquet as pq

    at = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(glob.glob(f"{at}/alignment-*"))
    docs = spark.createDataFrame([(i, f"some words {i} " * 20) for i in range(40)], "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert alignment.align_documents(docs, A, B, block=600).count() == 40
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    (new,) = set(glob.glob(f"{at}/alignment-*")) - before
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{new}/*blocks/*.parquet")]
    assert sum(m.num_rows for m in files) > 5
    assert all(m.row_group(i).num_rows == 1 for m in files for i in range(m.num_row_groups))
