"""Packing by power-of-two decomposition.

A document of L tokens (its end token included) is cut into full pieces of `most` tokens and then into the
binary digits of the rest, longest first. Every piece is a sequence of its own whose length is a power of
two: no sequence crosses documents and nothing is padded. Sequences of equal length share a bucket, from
which batches of one shape are drawn.

Nulls count as empty text (one piece: the end token). Repeated rows are packed each on its own. Word ids are
remembered per Python worker, from one task to the next; nothing is shuffled, so neither hot sources nor long
documents matter.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._spark import bounded_batches, fresh, table
from ._text import LOWER, HashIndex, column_pieces, flat, hash_spans, ragged, words

MOST = 2048
END = 1
#: Distinct words, and parts of them, that each Python worker remembers: some 30 MB each.
REMEMBERED, REMEMBERED_PARTS = 700_000, 700_000
#: Bytes of text worked on at once.
STEP = 1 << 20
#: Marks that end a word of plain letters: any number of them are one more word to the pattern below.
MARKS = punctuation.replace("'", "")
CLOSING = np.zeros(256, bool)
CLOSING[list(MARKS.encode())] = True
#: Second bytes of the letters U+0080 to U+00BF and U+00C0 to U+00FF, and of the capitals among the latter.
C2_LETTER, C3_LETTER, C3_CAPITAL = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
C2_LETTER[[0xAA, 0xB5, 0xBA]] = C3_LETTER[0x80:0xC0] = C3_CAPITAL[0x80:0x9F] = True
C3_LETTER[[0x97, 0xB7]] = C3_CAPITAL[0x97] = False
ASCII_LETTER = (LOWER >= 0x61) & (LOWER <= 0x7A)
#: Fixed value: the pattern of vocabularies with word ends. It takes no white space, so no token spans any.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_word(spec: dict) -> bool:
    """Whether a vocabulary's file says that the ids of a text are those of its words: letters are made small, nothing but
    NFC and runs of white space is normalised besides, the pattern is the one above, and merges begin and end with a word."""
    n, p, m = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
    steps = n.get("normalizers", []) if n.get("type") == "Sequence" else [n] if n else []
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    plain = all(x.get("type") in ("NFC", "Lowercase") or x == blanks for x in steps)
    cuts = p.get("pretokenizers", []) if p.get("type") == "Sequence" else []
    split = len(cuts) == 2 and cuts[0] == {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True}
    split = split and cuts[1]["type"] == "ByteLevel" and not cuts[1]["add_prefix_space"] and not cuts[1].get("use_regex", True)
    merges = m.get("type") == "BPE" and m.get("end_of_word_suffix") == "</w>" and not m.get("continuing_subword_prefix") and not m.get("ignore_merges") and not m.get("dropout")
    # an added token must not lie inside a word of letters, or across its end
    apart = lambda t: not t[0].isalpha() or not t.rstrip(MARKS).isalpha()
    added = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] and t["content"].split() == [t["content"]] and apart(t["content"]) for t in spec.get("added_tokens", []))
    small = any(x.get("type") == "Lowercase" for x in steps)
    return bool(plain and small and split and merges and added and not spec.get("truncation"))


class Memory:
    """Token ids under the 64-bit hashes of what they stand for."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.ids = np.zeros(0, "<u4")
        self.hashes, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.met = np.zeros(1, bool)
        self.index = HashIndex(self.hashes)

    def find(self, h: np.ndarray) -> np.ndarray:
        return self.index.find(h)

    def meet(self, at: np.ndarray) -> None:
        """Marks what was found, so that it is kept; places of -1 mark nothing that counts."""
        self.met[at] = True

    def ids_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at places behind one another, and their numbers; there are none at -1."""
        size = np.where(at >= 0, self.size[at], 0) if len(self.size) else np.zeros(len(at), np.int32)
        if not size.any():
            return self.ids[:0], size
        ends = np.cumsum(size, dtype=np.int64)
        return self.ids[np.repeat(self.first[at] - (ends - size), size) + np.arange(ends[-1])], size

    def add(self, h: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        first = (len(self.ids) + np.cumsum(size) - size).astype(np.int32)
        self.ids = np.append(self.ids, ids)
        hashes = np.append(self.hashes, h)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.first, self.size = hashes[order], np.append(self.first, first)[order], np.append(self.size, size).astype(np.int32)[order]
        self.met = np.append(np.append(self.met[:-1], np.zeros(len(h), bool))[order], False)
        self.index = HashIndex(self.hashes)

    def trim(self, most: int) -> None:
        """Of more than `most` keeps those that were met since they came or were last kept, if half as many at most."""
        if len(self.hashes) <= most:
            return
        kept = np.flatnonzero(self.met[:-1])
        h, (ids, size) = self.hashes[kept], self.ids_of(kept)
        self.forget()
        if 0 < len(kept) <= most // 2:
            self.add(h, ids, size)


class WordIds:
    """Token ids of whole texts by the `tokenizers` library, asked once per distinct word.

    This is exact for a vocabulary whose normaliser and pattern drop white space, write letters small and mark
    word ends: no token spans a blank. Other vocabularies are told by their files; their texts are encoded whole.
    ASCII punctuation after plain letters (up to U+00FF) is a word of its own to the pattern, so small letters and
    marks are remembered apart. Letters are asked for many at once and told apart by their end marks. Remembered words
    and parts are found by a 64-bit hash of their bytes; beyond `REMEMBERED` those met only once are forgotten.
    """

    def __init__(self, path: str, end: int = END):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.end = end
        self.words, self.parts = Memory(), Memory()
        with open(path, encoding="utf-8") as f:
            self.by_word = by_word(json.load(f))

    def rows(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, each with the end token, and where each row begins."""
        if not self.by_word:
            ids = [[*e.ids, self.end] for e in self.encode([t or "" for t in column.to_pylist()], add_special_tokens=False)]
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.array([i for x in ids for i in x], "<u4"), np.append(0, np.cumsum(size))
        data, offsets = flat(column)
        starts, ends, before = words(data, offsets)
        h = hash_spans(data, starts, ends, seed=5)
        at = self.words.find(h)
        self.words.meet(at)
        if len(self.words.hashes) > REMEMBERED and (at < 0).any():
            self.words.trim(REMEMBERED)
            at = self.words.find(h)
        lost = np.flatnonzero(at < 0)
        if len(lost):
            _, one = np.unique(h[lost], return_index=True)
            self._learn(data, starts, ends, h, lost[one])
            at = self.words.find(h)
        got, size = self.words.ids_of(at)
        # the end token comes behind each row's last word
        stop = np.append(0, np.cumsum(size, dtype=np.int64))[before]
        return np.insert(got, stop[1:], self.end), stop + np.arange(len(stop))

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, one: np.ndarray) -> None:
        """Asks for the words numbered `one`, a bounded number at a time, and remembers them."""
        small, letter, kind = LOWER[data], ASCII_LETTER[data], np.int32 if len(data) < 1 << 31 else np.int64
        for lead, second in ((0xC2, C2_LETTER), (0xC3, C3_LETTER)):
            at = np.flatnonzero(data[:-1] == lead)
            at = at[second[data[at + 1]]]
            letter[at] = letter[at + 1] = True
            if lead == 0xC3:
                small[at + 1] += 0x20 * C3_CAPITAL[data[at + 1]].astype(np.uint8)
        other = np.zeros(len(data) + 1, kind)
        np.cumsum(~letter, out=other[1:])
        inner = np.arange(len(data), dtype=kind)  # the last byte up to here that is no mark
        inner[CLOSING[data]] = -1
        np.maximum.accumulate(inner, out=inner)
        made = []
        for cut in range(0, len(one), 20_000):
            some = one[cut : cut + 20_000]
            s, e = starts[some], ends[some]
            mid = np.maximum(inner[e - 1] + 1, s)
            plain = (mid > s) & (other[mid] == other[s])
            made.append((h[some[~plain]], *self._ask([data[a:b].tobytes() for a, b in zip(s[~plain].tolist(), e[~plain].tolist(), strict=True)])))
            # letters and marks of a plain word behind one another
            s, mid, e = s[plain], mid[plain], e[plain]
            ids, size = self._parts(small, np.stack([s, mid], axis=1).ravel(), np.stack([mid, e], axis=1).ravel())
            made.append((h[some[plain]], ids, size.reshape(-1, 2).sum(axis=1)))
        self.words.add(*map(np.concatenate, zip(*made, strict=True)))

    def _parts(self, small: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that are letters or marks, and their numbers; an empty part has none."""
        h = hash_spans(small, s, e, seed=7)
        at = self.parts.find(h)
        self.parts.meet(at)
        lost = np.flatnonzero((at < 0) & (e > s))
        if len(lost):
            if len(self.parts.hashes) > REMEMBERED_PARTS:
                self.parts.trim(REMEMBERED_PARTS)
                lost = np.flatnonzero((self.parts.find(h) < 0) & (e > s))
            _, one = np.unique(h[lost], return_index=True)
            lost = lost[one]
            s, e = s[lost], e[lost]
            marks = CLOSING[small[s]]
            some = lost[marks]
            asked = [(h[some], *self._ask([small[a:b].tobytes() for a, b in zip(s[marks].tolist(), e[marks].tolist(), strict=True)]))]
            s, e, some = s[~marks], e[~marks], lost[~marks]
            for cut in range(0, len(s), 5_000):
                asked.append((h[some[cut : cut + 5_000]], *self._ask_letters(small, s[cut : cut + 5_000], e[cut : cut + 5_000])))
            self.parts.add(*map(np.concatenate, zip(*asked, strict=True)))
            at = self.parts.find(h)
        return self.parts.ids_of(at)

    def _ask_letters(self, small: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, asked for 200 to a line."""
        word, nth = ragged(e - s + 1)
        text = small[np.minimum(s[word] + nth, len(small) - 1)]
        last = np.cumsum(e - s + 1) - 1
        text[last] = 0x20
        text[last[199::200]] = 0x0A
        lines = text[:-1].tobytes().decode().split("\n")
        found = self.encode(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(x.ids for x in found), "<u4")
        stop = np.flatnonzero(self.closes[ids]) + 1
        if len(stop) != len(s):
            return self._ask([small[a:b].tobytes() for a, b in zip(s.tolist(), e.tolist(), strict=True)])
        return ids, np.diff(stop, prepend=0)

    def _ask(self, missing: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, each asked for on its own."""
        made, size = [np.zeros(0, "<u4")], []
        for at in range(0, len(missing), 5_000):
            found = self.encode([w.decode() for w in missing[at : at + 5_000]], add_special_tokens=False)
            size += [len(x.ids) for x in found]
            made.append(np.fromiter(chain.from_iterable(x.ids for x in found), "<u4"))
        return np.concatenate(made), np.array(size, np.int64)


@lru_cache(maxsize=1)
def _word_ids(path: str, end: int, version: int) -> WordIds:
    return WordIds(path, end)


def word_ids(path: str, end: int = END) -> WordIds:
    """The ids that this process remembers of the vocabulary, as long as its file stays as it is."""
    return _word_ids(path, end, os.stat(path).st_mtime_ns)


def decompose(length: int, most: int = MOST) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full ones, then the rest's binary digits from the highest."""
    out = [(s, most) for s in range(0, length - length % most, most)]
    start, rest = length - length % most, length % most
    for k in reversed(range(most.bit_length())):
        if rest >> k & 1:
            out.append((start, 1 << k))
            start += 1 << k
    return out


def _digits(most: int) -> np.ndarray:
    """For each rest below `most` its binary digits as powers of two, longest first, then zeros."""
    out = np.zeros((most, max(1, most.bit_length() - 1)), np.int64)
    for n in range(most):
        digits = [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]
        out[n, : len(digits)] = digits
    return out


def pack(docs: DataFrame, vocab_path: str, text: str = "text", most: int = MOST, end: int = END) -> DataFrame:
    """One row per piece: the columns of `docs` without the text, and start, length, ids (binary, little-endian
    unsigned 32-bit), doc_tokens, bucket (the power of two), sequence_id and offset (0: a sequence has one piece).
    Columns of those names in any letter case are replaced. An empty table has no pieces."""
    bounded_batches(docs.sparkSession)
    if most & (most - 1):
        raise ValueError("the longest sequence must be a power of two")

    @arrow_udf("array<struct<start:long,length:long,ids:binary,doc_tokens:long>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of, rest = word_ids(vocab_path, end), _digits(most)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]))
        for batch in batches:
            made = []
            for part in column_pieces(batch, STEP):
                ids, at = ids_of.rows(part)
                n = np.diff(at)
                full = n // most
                pieces = full + (rest[n % most] > 0).sum(axis=1)
                row, nth = ragged(pieces)
                length = np.where(nth < full[row], most, rest[n[row] % most, np.maximum(nth - full[row], 0)])
                ends = np.cumsum(length)
                start = ends - length - at[row]
                # a document's pieces lie behind one another, as their ids do
                raw = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(np.append(0, 4 * ends).astype(np.int32)), pa.py_buffer(ids)])
                rows = pa.StructArray.from_arrays([pa.array(start), pa.array(length), raw, pa.array(n[row])], ["start", "length", "ids", "doc_tokens"])
                made.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(pieces)), pa.int32()), rows))
            yield pa.concat_arrays(made) if made else pa.array([], kind)

    made = ("start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset")
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in made]
    cuts_ = fresh("cuts", docs)
    cuts = docs.select(*keep, cut(F.col(f"`{text}`")).alias(cuts_))
    return (
        cuts.select(*keep, F.inline_outer(cuts_))  # every document has a piece; plain inline would filter, and tokenise twice
        .withColumn("bucket", F.col("length"))
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


def digest(packed: DataFrame) -> DataFrame:
    """The contract's columns of packed documents."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(pack(docs, public_tokenizers.path("word_bpe_49k.json")))


QUERIES = {"op4_packing": op4_packing}
ORACLE: dict[str, str] = {}
