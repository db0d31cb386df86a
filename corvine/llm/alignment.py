"""Alignment of two tokenizers over whole texts.

The texts of a piece of an Arrow batch, each with a blank in front, are laid end to end. The ends of A's and of B's
tokens are counted once over all bytes of the piece; a group ends where both count. Between two neighbouring ends of
either kind lies a part of exactly one A and one B token, so these stretches are the links, and prefix sums over the
bytes give tokens, links, groups and document bounds without a loop over tokens.

How often an id pair is linked is known only over the whole corpus. The links of about `BLOCK` bytes of text become
one packed row: the block's distinct pairs, and per document places in them with counts. Pairs are summed over blocks
by a shuffle, each block asks for each of its pairs once, and the answers meet the block's packed row. A pair that is
in every text is therefore asked once a block. Nothing is broadcast but one row per B id (a bound by the vocabulary).

Most texts have single blanks or line ends between words. In those each word with its mark is encoded on its own and
remembered; that is exact for A by its pattern and for B where no piece has a blank after another character, or a
line end beside one, which is read off its vocabulary. Other texts and vocabularies are encoded whole.

Texts that are null, empty or whose tokens' bytes are not those of blank and text (a U+2581 in it) have no tokens,
groups and links: zeros and an empty digest. Repeated rows count each, repeated ids too. Other columns are passed on;
one named like the result is replaced. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ._spark import Spool, table
from ._text import pieces, ragged
from .token_counts import byte_symbols

#: Bytes of text whose links are one packed row.
BLOCK = 4 << 20
#: Distinct words remembered in each Python worker.
REMEMBERED = 250_000
#: Words that are encoded in one call, behind a word that is dropped.
TOGETHER, GUARD = 64, " a"
COUNTS, SUMS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), ("n_best", "count_sum")
#: A block: its documents, its distinct pairs and how many links hold each; and of each document and pair in it the
#: document's number, the pair's place among the block's, and the number of links.
PACKED = ("docs", "pairs", "every", "owner", "place", "times")


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary of the tokenizers library; special tokens' strings are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.many = getattr(self.library, "encode_batch_fast", self.library.encode_batch)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        before = spec.get("pre_tokenizer") or {}
        self.by_word = not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that have their blank in front."""
        return [e.ids for e in self.many(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a sentencepiece model that puts a blank in front by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        byte = [self.library.is_byte(i) for i in range(len(names))]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(names, byte, strict=True)]
        plain = [p for p, b in zip(names, byte, strict=True) if not b]
        self.blank = names.index("▁") if "▁" in names else None
        # blanks only in front, line ends only alone: then merges never reach from one word to the next
        apart = all("▁" not in p.lstrip("▁") and (p == "\n" or "\n" not in p) for p in plain)
        self.by_word = self.blank is not None and apart and self.library.encode("a b  c Ａ").count(self.blank) == 1

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that have their blank in front, or a line end."""
        out = self.library.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for t, ids in zip(texts, out, strict=True):
            if t[0] != " ":
                if ids[:1] != [self.blank]:
                    raise ValueError("the vocabulary joins a blank and a line end")
                del ids[0]
        return out


class Ragged:
    """Rows of ids laid end to end, to which rows are added."""

    def __init__(self):
        self.ids, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        self.ids, self.size = np.append(self.ids, ids), np.append(self.size, size)
        self.first = np.cumsum(self.size) - self.size

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows end to end, and how many each has."""
        size = self.size[rows]
        row, place = ragged(size)
        return self.ids[self.first[rows][row] + place], size


class Encoder:
    """Both tokenizers' ids of many texts, words remembered between batches."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.by_word = self.a.by_word and self.b.by_word
        self.spelling = []
        for side in (self.a, self.b):
            size = np.fromiter(map(len, side.bytes_of), np.int64, len(side.bytes_of))
            self.spelling.append((np.frombuffer(b"".join(side.bytes_of), np.uint8), np.cumsum(size) - size, size))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.stores, self.good = (Ragged(), Ragged()), np.zeros(0, bool)

    def _coded(self, spoken: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Both sides' ids of the texts end to end, and how many each text has."""
        rows = (self.a.encode(spoken), self.b.encode(spoken)) if spoken else ([], [])
        return [(np.fromiter(chain.from_iterable(r), np.int32), np.fromiter(map(len, r), np.int64, len(r))) for r in rows]

    def _learn(self, words: list[str]) -> None:
        """Words are encoded some at a time, behind one another, and told apart by their bytes; the libraries' cost is
        mostly one of calls. Where bytes differ or no token ends with a word, each is encoded on its own."""
        runs = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        spoken = [[GUARD, *(w if w[0] == "\n" else " " + w for w in run)] for run in runs]
        texts = ["".join(s) for s in spoken]
        coded = self._coded(texts)
        fine = self._same(texts, coded)
        cuts = []
        for (_, _, size), (ids, n) in zip(self.spelling, coded, strict=True):
            ends = np.cumsum(size[ids[np.repeat(fine, n)]])
            lengths = np.fromiter((len(x.encode()) for s, ok in zip(spoken, fine, strict=True) if ok for x in s), np.int64)
            bounds = np.cumsum(lengths)
            at = np.searchsorted(ends, bounds, "right")
            if len(bounds) and (ends[at - 1] != bounds).any():
                fine[:] = False
            cuts.append(np.diff(np.append(0, at)))
        good = [w for run, ok in zip(runs, fine, strict=True) if ok for w in run]
        rest = [w for run, ok in zip(runs, fine, strict=True) if not ok for w in run]
        self._keep(good, [self._unguarded(ids[np.repeat(fine, n)], cut, spoken, fine) for (ids, n), cut in zip(coded, cuts, strict=True)] if good else [], np.ones(len(good), bool))
        alone = [w if w[0] == "\n" else " " + w for w in rest]
        rows = self._coded(alone)
        self._keep(rest, rows, self._same(alone, rows))

    @staticmethod
    def _unguarded(ids: np.ndarray, size: np.ndarray, spoken: list[list[str]], fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(s) for s, ok in zip(spoken, fine, strict=True) if ok])
        word = np.ones(len(size), bool)
        word[np.cumsum(n) - n] = False
        return ids[np.repeat(word, size)], size[word]

    def _keep(self, words: list[str], rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray) -> None:
        if words:
            self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
            for store, r in zip(self.stores, rows, strict=True):
                store.add(*r)
            self.good = np.append(self.good, good)

    def _same(self, texts: list[str], rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Whether the bytes of both sides' tokens are those of the texts."""
        raw = [t.encode() for t in texts]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        data, out = np.frombuffer(b"".join(raw), np.uint8), np.ones(len(raw), bool)
        for (spelled, first, size), (ids, n) in zip(self.spelling, rows, strict=True):
            owner = np.repeat(np.arange(len(raw)), n)
            out &= np.bincount(owner, size[ids], minlength=len(raw)).astype(np.int64) == length
            some = ids[out[owner]]
            token, place = ragged(size[some])
            mine = np.repeat(out, length)
            wrong = np.flatnonzero(mine)[spelled[first[some][token] + place] != data[mine]]
            out[np.searchsorted(np.cumsum(length), wrong, "right")] = False
        return out

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Which texts have tokens; and of A and B the ids of those end to end, and how many each has."""
        good, split, whole = np.zeros(len(texts), bool), [], []
        for i, t in enumerate(texts):
            if not t:
                continue
            words = t.replace("\n", " \n").split(" ")
            if self.by_word and t.split() == t.replace("\n", " ").split(" "):
                split.append((i, words))
            else:
                whole.append(i)
        seen = {w for _, words in split for w in words}
        missing = [w for w in seen if w not in self.known]
        if len(self.known) + len(missing) > REMEMBERED:
            self._forget()
            missing = list(seen)
        for at in range(0, len(missing), 50_000):
            self._learn(missing[at : at + 50_000])
        rows = np.fromiter((self.known[w] for _, words in split for w in words), np.int64, sum(len(w) for _, w in split))
        at = np.fromiter((i for i, _ in split), np.int64, len(split))
        n = np.fromiter((len(w) for _, w in split), np.int64, len(split))
        of_row = np.repeat(np.arange(len(split)), n)
        bad = np.bincount(of_row, ~self.good[rows], minlength=len(split)) > 0 if len(split) else np.zeros(0, bool)
        good[at[~bad]] = True
        spoken = [" " + texts[i] for i in whole]
        flat = self._coded(spoken)
        fine = self._same(spoken, flat)
        of_whole = np.array(whole, np.int64)
        good[of_whole[fine]] = True
        use = ~bad[of_row]
        ids, sizes = [], []
        for store, (some, size) in zip(self.stores, flat, strict=True):
            # words and whole texts in the order of the texts
            mine, n_mine = store.take(rows[use]) if use.any() else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            owner = np.concatenate([np.repeat(at[of_row[use]], n_mine), np.repeat(of_whole[fine], size[fine])])
            joined = np.append(mine, some[np.repeat(fine, size)])
            ids.append(joined[np.argsort(owner, kind="stable")] if len(whole) else joined)
            sizes.append(np.bincount(owner, minlength=len(texts)))
        return good, ids, sizes


def _decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of all numbers up to `most`, left-aligned with zero bytes behind, and how many each has."""
    text = np.char.encode(np.arange(most + 1).astype(str), "ascii")
    return np.pad(text.view(np.uint8).reshape(most + 1, -1), ((0, 0), (0, 1))), np.char.str_len(text)


class Aligner:
    """Groups and links of a piece of a batch."""

    def __init__(self, a_path: str, b_path: str):
        self.encoder = Encoder(a_path, b_path)
        self.length = [size for _, _, size in self.encoder.spelling]
        self.width = len(self.length[1])
        self.pairs = self.width * len(self.length[0])
        self.digits, self.n_digits = _decimals(max(map(len, self.length)))

    def texts(self, texts: list[str | None]) -> dict[str, np.ndarray | list[str]]:
        """Per text: n_a, n_b, n_groups, n_links, groups_sha256; and all links' pairs (id of A times `width` plus id of
        B) with their text's number."""
        _, (a, b), (n_a, n_b) = self.encoder.texts(texts)
        ends_a, ends_b = np.cumsum(self.length[0][a]), np.cumsum(self.length[1][b])
        bounds = np.append(0, ends_a)[np.append(0, np.cumsum(n_a))]  # bytes before each text
        total = int(bounds[-1])
        is_a, is_b = np.bincount(ends_a, minlength=total + 1), np.bincount(ends_b, minlength=total + 1)
        before_a, before_b = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
        cut = np.flatnonzero(is_a & is_b)
        stretch = np.flatnonzero(is_a | is_b)
        pairs = a[before_a[stretch]].astype(np.int64) * self.width + b[before_b[stretch]]
        groups = np.diff(np.searchsorted(cut, bounds, "right"))
        links = np.diff(np.searchsorted(stretch, bounds, "right"))
        sha = self._digests(a, b, ends_a, ends_b, cut, n_a + n_b)
        return {"n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": links, "groups_sha256": sha, "pairs": pairs, "owner": np.repeat(np.arange(len(texts)), links)}

    def _digests(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, cut: np.ndarray, tokens: np.ndarray) -> list[str]:
        """sha256 of `a1,a2|b1;a3|b2,b3` of each text."""
        group_a, group_b = np.searchsorted(cut, ends_a), np.searchsorted(cut, ends_b)
        of_a, of_b = np.bincount(group_a, minlength=len(cut)), np.bincount(group_b, minlength=len(cut))
        # A's ids of a group come before B's
        place_a = np.arange(len(a)) + (np.cumsum(of_b) - of_b)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(of_a)[group_b]
        ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        mark[place_a[np.cumsum(of_a) - 1]] = ord("|")
        mark[place_b[np.cumsum(of_b) - 1]] = ord(";")
        n = self.n_digits[ids]
        shown = self.digits[ids]
        shown[np.arange(len(ids)), n] = mark
        raw = shown[shown > 0].tobytes()
        stop = np.append(0, np.cumsum(n + 1))[np.append(0, np.cumsum(tokens))].tolist()
        return [hashlib.sha256(raw[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(stop, stop[1:], strict=False)]


def align(text: str, a_path: str, b_path: str) -> Column:
    """A column: an array of structs (a array<int>, b array<int>), the groups of each text in order."""

    @arrow_udf("array<struct<a:array<int>,b:array<int>>>")
    def groups(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(a_path, b_path)
        length = [size for _, _, size in encoder.spelling]
        for batch in batches:
            _, ids, sizes = encoder.texts(batch.to_pylist())
            ends = [np.cumsum(length[s][ids[s]]) for s in (0, 1)]
            cut = np.intersect1d(*ends)
            lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.searchsorted(ends[s], cut, "right")).astype(np.int32)), pa.array(ids[s], pa.int32())) for s in (0, 1)]
            bounds = np.append(0, ends[0])[np.append(0, np.cumsum(sizes[0]))]
            yield pa.ListArray.from_arrays(pa.array(np.searchsorted(cut, bounds, "right").astype(np.int32)), pa.StructArray.from_arrays(lists, ["a", "b"]))

    return groups(F.col(text))


def _packing(text: str, a_path: str, b_path: str, block: int):
    """One row per block of documents: the documents with their own counts, the block's distinct pairs, and the
    documents' links as places in them, a document's equal links counted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        task = TaskContext.get().partitionId() << 32
        docs: list[pa.StructArray] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = rows = number = 0

        def row() -> pa.RecordBatch:
            owner, pairs, times = (np.concatenate(x) for x in zip(*held, strict=True))
            distinct, place = np.unique(pairs, return_inverse=True)
            every = np.diff(np.append(0, np.cumsum(times[np.argsort(place, kind="stable")]))[np.append(0, np.cumsum(np.bincount(place, minlength=len(distinct))))])
            packed = (pa.concat_arrays(docs), pa.array(distinct), pa.array(every), *(pa.array(x.astype(np.int32)) for x in (owner, place, times)))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in packed]
            return pa.RecordBatch.from_arrays([pa.array([task + number]), *lists], ["block", *PACKED])

        for batch in batches:
            rest = [c for c in batch.schema.names if c != text]
            for piece in pieces(batch, text):
                got = aligner.texts(piece.column(text).to_pylist())
                counts = [pa.array(got[c], pa.int64()) for c in COUNTS[:4]] + [pa.array(got["groups_sha256"], pa.string())]
                docs.append(pa.StructArray.from_arrays([*(piece.column(c) for c in rest), *counts], [*rest, *COUNTS]))
                base = aligner.pairs
                key, times = np.unique(got["owner"] * base + got["pairs"], return_counts=True)
                held.append((key // base + rows, key % base, times))
                rows += piece.num_rows
                waiting += sum(b.size for b in piece.column(text).buffers() if b) * piece.num_rows // max(1, batch.num_rows)
                if waiting >= block:
                    yield row()
                    docs, held, waiting, rows, number = [], [], 0, 0, number + 1
        if docs:
            yield row()

    return run


def _answered(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's documents with the sums over their links; the answers are of exactly the block's pairs."""
    docs = blocks.column("docs").combine_chunks().flatten()
    owner, place, times = (blocks.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in PACKED[3:])
    order = np.argsort(answers.column("pair").to_numpy())
    cuts = np.searchsorted(owner, np.arange(len(docs) + 1))
    sums = [np.diff(np.append(0, np.cumsum(answers.column(c).to_numpy().astype(np.int64)[order][place] * times))[cuts]) for c in ("best", "count")]
    return pa.Table.from_arrays([*docs.flatten(), *map(pa.array, sums)], names=[*(f.name for f in docs.type), *SUMS])


def link_counts(blocks: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): how many links of all blocks hold a pair, and whether no pair of its B id has more."""
    counts = blocks.select(F.inline(F.arrays_zip("pairs", "every"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("every").alias("count"))
    counts = Spool(blocks.sparkSession, "links").keep(counts, "counts")
    most = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("count").alias("most"))
    # at most one row per id of B's vocabulary
    return counts.join(F.broadcast(most), F.col("pair") % width == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, text: str = "text", block: int = BLOCK) -> DataFrame:
    """`docs` without the text, with the counts of its tokens, groups and links and the digest of its groups."""
    spark = docs.sparkSession
    spool = Spool(spark, "alignment")
    rest = [c for c in docs.columns if c != text and c.lower() not in (*COUNTS, *SUMS)]
    plain = docs.select(F.col(f"`{text}`"), *[F.col(f"`{c}`") for c in rest])
    one = F.struct(*[F.col(f"`{c}`") for c in rest], *[F.lit(0).cast("long").alias(c) for c in COUNTS[:4]], F.lit("").alias(COUNTS[4]))
    doc = plain.select(one.alias("doc")).schema["doc"].dataType
    types = dict.fromkeys(PACKED[1:3], T.LongType()) | dict.fromkeys(PACKED[3:], T.IntegerType()) | {"docs": doc}
    made = T.StructType([T.StructField("block", T.LongType()), *[T.StructField(c, T.ArrayType(types[c])) for c in PACKED]])
    blocks = spool.keep(plain.mapInArrow(_packing(text, a_path, b_path, block), made), "blocks", rows=1)
    asked = blocks.select(F.col("block").alias("of"), F.explode("pairs").alias("pair"))
    answers = asked.join(link_counts(blocks, Pieces(b_path).library.vocab_size()), "pair")
    out = T.StructType([*doc.fields, *[T.StructField(c, T.LongType()) for c in SUMS]])
    return blocks.drop("pairs", "every").groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_answered, out)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), *COUNTS[:4], *SUMS, COUNTS[4])


QUERIES = {"op11_alignment": op11_alignment}
ORACLE: dict[str, str] = {}
