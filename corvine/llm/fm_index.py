"""Substring dedup of words by an FM-index per shard.

A shard's segments are laid end to end; of its Burrows-Wheeler transform a wavelet matrix (bit vectors with rank
directories) is kept. Streamed segments are searched backward, all at once: a search goes on while its interval
holds two occurrences or more, so where it ends gives the matching statistic. Windows of `length` words that
match are reported as runs. See `repeats` for how windows meet in a shard.

Words are maximal runs of bytes other than [\\x20\\x09-\\x0D], unchanged. Null and empty texts have no words; a
repeated row repeats all its windows; an empty table gives an empty table; other columns are passed on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import fresh, table
from ._text import hash_spans, ragged
from .repeats import Scheme, flag_runs, split_segments, without_repeats

WORDS = Scheme("word", 35)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` symbols or more, by prefix doubling; the last symbol is the only
    smallest. Backward search for patterns of up to `depth` symbols needs no more."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:  # the ranks tell the first `step` symbols
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank * (n + 2) + ahead
        order = np.argsort(key)
        sorted_ = key[order]
        new = np.append(0, np.cumsum(sorted_[1:] != sorted_[:-1]))
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= depth:
            return order


class WaveletMatrix:
    """Rank queries over a sequence of small integers, one bit vector per bit of a symbol."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        n = len(seq)
        for level in reversed(range(self.levels)):
            bit = (seq >> level & 1).astype(bool)
            raw = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed = np.packbits(bit, bitorder="little")
            raw[: len(packed)] = packed
            word = raw.view(np.uint64)
            self.bits.append(word)
            self.ones.append(np.append(0, np.cumsum(np.bitwise_count(word).astype(np.int64))).astype(np.int32))
            self.zeros.append(n - int(self.ones[-1][-1]))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where a symbol's occurrences before `at` end in the last, sorted level."""
        at = at.copy()
        for i, (word, ones, zeros) in enumerate(zip(self.bits, self.ones, self.zeros, strict=True)):
            bit = (symbol >> (self.levels - 1 - i) & 1).astype(bool)
            slot = at >> 6
            rank = ones[slot] + np.bitwise_count(word[slot] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(bit, zeros + rank, at - rank)
        return at


class FMIndex:
    """Backward search for patterns of up to `depth` symbols."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        order = suffix_order(text, depth)
        bwt = text[order - 1]
        self.n, self.matrix = len(text), WaveletMatrix(bwt, symbols)
        below = np.append(0, np.cumsum(np.bincount(text, minlength=symbols)))[:-1]
        every = np.arange(symbols)
        self.shift = below - self.matrix.follow(every, np.zeros(symbols, np.int64))

    def back(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        both = self.matrix.follow(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        both += np.concatenate([self.shift[symbol]] * 2)
        return both[: len(symbol)], both[len(symbol) :]


def fm_kernel(segs: list[bytes], offs: np.ndarray, asked: int, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of the first `asked` segments that the index of all segments finds in several places. All
    grams of such a window occur twice, so only stretches of such grams that are long enough for a window are indexed
    and searched."""
    u = split_segments(segs, scheme)
    length, gram = scheme.length, scheme.gram
    every = (np.diff(u.before) - length + 1)[:asked]
    place = np.append(0, np.cumsum(every))
    found = np.zeros(int(place[-1]), bool)
    total = int(u.before[-1])
    _, number, often = np.unique(u.grams(gram), return_inverse=True, return_counts=True)
    twice = np.append(often[number] > 1, np.zeros(gram - 1, bool))
    twice[np.minimum((u.before[1:, None] - np.arange(1, gram)).ravel(), total - 1)] = False  # grams that leave their segment
    of, first, last = flag_runs(twice, u.before[:-1])
    good = last - first >= length - gram + 1
    of, first, last = of[good], first[good], last[good] + gram - 1
    if not len(of):
        return flag_runs(found, place[:-1])
    size = last - first
    stretch, spot = ragged(size)
    _, word = np.unique(hash_spans(u.data, u.starts, u.ends)[u.before[of][stretch] + first[stretch] + spot], return_inverse=True)
    word = word.astype(np.int64) + 2
    before = np.cumsum(size) - size
    text = np.ones(int(size.sum()) + len(size) + 1, np.int64)
    text[np.arange(len(word)) + stretch] = word
    text[-1] = 0
    index = FMIndex(text, int(word.max()) + 1, int(size.max()))
    mine = int(np.searchsorted(of, asked))
    of, first, size = of[:mine], first[:mine], size[:mine]
    flags = _search_all(index, word, before[:mine], size, length)
    row, nth = ragged(size - length + 1)
    found[place[of][row] + first[row] + nth] = flags
    return flag_runs(found, place[:-1])


def _search_all(index: FMIndex, word: np.ndarray, before: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Which windows of the stretches (words from `before` on, `size` of them) occur twice in the index."""
    windows = size - length + 1
    bounds = np.append(0, np.cumsum(windows))
    flags = np.zeros(int(bounds[-1]), bool)
    limit = windows.copy()
    # whole stretches from their ends: the matching statistic of the last word settles its windows
    seg = np.arange(len(size))
    pos, lo, hi = size.copy(), np.zeros(len(size), np.int64), np.full(len(size), index.n)
    while len(seg):
        a, b = index.back(word[before[seg] + pos - 1], lo, hi)
        ok = b - a >= 2
        pos = pos - ok
        over = ~ok | (pos == 0)
        for i, p in zip(seg[over].tolist(), pos[over].tolist(), strict=True):
            if p < windows[i]:
                flags[bounds[i] + p : bounds[i + 1]] = True
                limit[i] = p
            else:
                limit[i] = windows[i] - 1  # what failed lies in the last window
        go = ~over
        seg, pos, lo, hi = seg[go], pos[go], a[go], b[go]
    # the other windows from the left: a search that fails at p rules out every window that reaches over p
    seg = np.flatnonzero(limit > 0)
    start = np.zeros(len(seg), np.int64)
    pos, lo, hi = start + length, np.zeros(len(seg), np.int64), np.full(len(seg), index.n)
    while len(seg):
        a, b = index.back(word[before[seg] + pos - 1], lo, hi)
        ok = b - a >= 2
        pos = pos - ok
        done = ok & (pos == start)
        flags[bounds[seg[done]] + start[done]] = True
        start = np.where(done, start + 1, np.where(ok, start, pos))
        reset = done | ~ok
        pos, lo, hi = np.where(reset, start + length, pos), np.where(reset, 0, a), np.where(reset, index.n, b)
        go = start < limit[seg]
        seg, start, pos, lo, hi = seg[go], start[go], pos[go], lo[go], hi[go]
    return flags


def dedup_words(docs: DataFrame, text: str = "text", length: int = 35, into: str = "repeats") -> DataFrame:
    """`docs` with a struct: n_units (words), n_removed, n_spans, kept (the rest's words joined by one blank)."""
    return without_repeats(docs, text, Scheme("word", length), fm_kernel, into)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 35) -> DataFrame:
    """`docs` with repeated passages cut out of the text; texts without any stay byte for byte."""
    name = fresh("repeats", docs)
    out = dedup_words(docs, text, length, name)
    kept = F.decode(f"{name}.kept", "UTF-8")
    return out.withColumn(text, F.when(F.col(f"{name}.n_removed") > 0, kept).otherwise(F.col(text))).drop(name)


def op7_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("repeats.n_units").alias("n_words"), F.col("repeats.n_removed").alias("n_removed"), F.sha2("repeats.kept", 256).alias("kept_sha256"))


QUERIES = {"op7_fm_index": op7_fm_index}
ORACLE = {
    "op7_fm_index": r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
p as (select rid, words, unnest(range(1, len(words) - 33)) as pos from d where len(words) >= 35),
h as (select rid, pos, md5(array_to_string(words[pos:pos + 34], ' ')) as h from p),
s as (select rid, pos from h where h in (select h from h group by h having count(*) > 1)),
w as (select rid, unnest(words) as word, generate_subscripts(words, 1) as pos from d),
c as (
  select w.rid, w.word, w.pos, max(s.pos) over (partition by w.rid order by w.pos rows between 34 preceding and current row) is not null as gone
  from w left join s on w.rid = s.rid and w.pos = s.pos
),
k as (select rid, count(*) filter (gone) as removed, string_agg(word, ' ' order by pos) filter (not gone) as kept from c group by rid)
select d.doc_id, cast(len(d.words) as bigint) as n_words, cast(coalesce(k.removed, 0) as bigint) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from d left join k on d.rid = k.rid
"""
}
