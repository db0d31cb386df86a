"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch are laid end to end in one array of symbol ids. In each round every
sequence finds the lowest rank among its adjacent pairs and merges all occurrences of that pair, left to
right; sequences without a known pair retire. The symbols that survive are the tokens.

Nulls count as empty text (zero tokens). The special token's string inside a text is one token. Repeated rows are
counted each on its own; a word of millions of letters is cut where no token has its two letters side by side; an empty table stays empty; other columns are passed on, one named like the result is
replaced. Vocabularies of another kind are refused, since the pattern is fixed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._spark import bounded_batches, table
from ._text import column_pieces

#: Fixed value: the vocabulary's published pre-token pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Counts of that many distinct words are remembered in each Python worker.
REMEMBERED = 600_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class RankMerger:
    """Merges of a byte-level BPE vocabulary, applied to many sequences at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        before = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec["model"].get("ignore_merges"):
            raise ValueError("the vocabulary is not a byte-level one with the usual pattern")
        self.width = len(vocab) + 1
        self.byte_id = np.array([vocab[c] for c in byte_symbols()], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        key = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made
        # byte pairs that no token has inside: no merge ever reaches across them
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        self.inside = np.zeros(1 << 16, bool)
        for token in vocab:
            raw = [byte_of[c] for c in token if c in byte_of]
            self.inside[[a << 8 | b for a, b in zip(raw, raw[1:], strict=False)]] = True
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.pattern = regex.compile(PATTERN)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each pre-token."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        data = np.frombuffer(b"".join(tokens), np.uint8)
        sym = self.byte_id[data]
        # a sequence is a pre-token's stretch without a pair that cannot merge: long words become many short ones
        token = np.repeat(np.arange(len(tokens)), lengths)
        apart = (token[1:] != token[:-1]) | ~self.inside[data[:-1].astype(np.int64) << 8 | data[1:]]
        seq = np.cumsum(np.append(False, apart)) if len(data) else token
        begin = np.flatnonzero(np.append(True, apart)) if len(data) else token
        owner = token[begin]
        out = np.diff(np.append(begin, len(data)))
        none = np.int64(len(self.keys))
        while len(sym) > 1:
            same = seq[1:] == seq[:-1]
            key = sym[:-1] * self.width + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(same & (self.keys[at] == key), self.ranks[at], none)
            rank = np.append(rank, none)
            first = np.flatnonzero(np.append(True, ~same))
            size = np.diff(np.append(first, len(seq)))
            best = np.repeat(np.minimum.reduceat(rank, first), size)
            live = best < none
            hit = np.flatnonzero(live & (rank == best))
            if not len(hit):
                break
            # of a run of overlapping pairs (a a a) every other one counts, from the left
            run = np.cumsum(np.append(True, np.diff(hit) != 1))
            nth = np.arange(len(hit)) - np.flatnonzero(np.append(True, np.diff(run) != 0))[run - 1]
            hit = hit[nth % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            out -= np.bincount(seq[hit], minlength=len(out))
            live[hit + 1] = False
            sym, seq = sym[live], seq[live]
        return np.bincount(owner, out, len(tokens)).astype(np.int64)


class TokenCounter:
    """Counts tokens of whole texts; word counts are remembered between batches."""

    def __init__(self, path: str):
        self.merger = RankMerger(path)
        self.known: dict[str, int] = {}

    def _learn(self, chunks: list[str]) -> None:
        found = [self.merger.pattern.findall(c) for c in chunks]
        distinct = list({t for f in found for t in f})
        size = dict(zip(distinct, self.merger.counts([t.encode() for t in distinct]).tolist(), strict=True))
        for c, f in zip(chunks, found, strict=True):
            self.known[c] = sum(map(size.__getitem__, f))

    def texts(self, texts: list[str]) -> list[int]:
        """Tokens of each text.

        Where all white space is single blanks or line ends between words, each word with the mark before it
        is tokenised on its own; other texts go through the pattern whole.
        """
        out, plan = [0] * len(texts), []
        for i, t in enumerate(texts):
            if not t:
                continue
            parts = [t]
            if self.merger.split and any(s in t for s in self.merger.special):
                parts = self.merger.split.split(t)
                out[i] = len(parts) // 2
                parts = parts[::2]
            for p in parts:
                if not p:
                    continue
                if p.replace("\n", " ").split(" ") == p.split():
                    chunks = p.replace("\n", " \n").split(" ")
                    plan.append((i, chunks[0], chunks[1:]))
                else:
                    found = self.merger.pattern.findall(p)
                    plan.append((i, found[0], found[1:], None))
        heads, tails, raw = set(), set(), set()
        for job in plan:
            if len(job) == 3:
                heads.add(job[1])
                tails.update(job[2])
            else:
                raw.add(job[1])
                raw.update(job[2])
        # the first word as it is; a later one with its blank, or with the line end it begins with
        tail = {w: w if w[0] == "\n" else " " + w for w in tails}
        want = {*heads, *raw, *tail.values()}
        missing = [c for c in want if c not in self.known]
        if len(self.known) + len(missing) > REMEMBERED:
            self.known.clear()
            missing = list(want)
        for at in range(0, len(missing), 50_000):
            self._learn(missing[at : at + 50_000])
        size = self.known.__getitem__
        of_tail = {w: size(c) for w, c in tail.items()}.__getitem__
        for job in plan:
            out[job[0]] += size(job[1]) + sum(map(size if len(job) == 4 else of_tail, job[2]))
        return out


def token_count(text: Column | str, vocab_path: str) -> Column:
    """A column of token counts."""

    @arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = TokenCounter(vocab_path)
        for batch in batches:
            out: list[int] = []
            for piece in column_pieces(batch, 1 << 21):
                out += counter.texts(piece.to_pylist())
            yield pa.array(out, pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, vocab_path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """`docs` with one more column, the tokens of `text`. Rows stay where they are: no shuffle."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(into, token_count(F.col(text), vocab_path))


#: Documents with more tokens than this are over the limit.
LIMIT = 512


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    out = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))


QUERIES = {"op8_token_counts": op8_token_counts}
ORACLE: dict[str, str] = {}
