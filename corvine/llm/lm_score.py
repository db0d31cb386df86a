"""Language-model scoring with a log-frequency Bloom filter.

Word and bigram counts come from every training document. Every bigram is stored with its count quantised, level 1
for once and then half powers of two: the keys (bigram, 1) ... (bigram, level) are set in a Bloom filter, and a
reader probes levels upward until one is missing. The probes of a bigram lie in one block of 64 bytes. A token's
probability mixes the add-half unigram with the quantised bigram estimate (a lower bound of the count, so the
mixture does not exceed one but for the filter's false positives); the weight depends on how often the context was
seen and is fitted on all training documents, with each one's own bigrams taken out.

Counting works on sorted hash arrays: each task packs its distinct hashes by top byte; where the volume of text asks
for more ranges than 256, packs of a top byte are first dealt into bounded groups, merged there and cut into its
ranges. A range's packs are merged in one bounded group; ranges are cut by hash, so no word or bigram is hot.
Unigram counts are exact. The filter has `BITS_PER_KEY` bits for every key at every size. Filter and unigram table
are broadcast while they keep within `MOST_FILTER` and `MOST_TABLE` bytes, fetched range by range; beyond that each
hash range keeps its part, and documents in blocks ask the ranges for the counts and levels of their own words and
bigrams (`answers_by_block`). Both ways give the same weights and scores.

Null texts are empty: their only token is the end. A null doc_id is in the training part. Repeated rows are counted
and scored each on its own. Without training documents, or in an empty table, all counts are zero. Other columns
are passed on; one named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._spark import Spool, fresh, table
from ._text import LOWER, HashIndex, column_pieces, flat, hash_spans, mix, pieces, words

U64 = np.uint64
#: Bytes of the unigram table and of the filter that are broadcast at most.
MOST_TABLE, MOST_FILTER = 128 << 20, 256 << 20
BITS_PER_KEY, PROBES = 12, 6
#: Bits of a block of the filter, which holds all probes of a bigram, those of a level in two of its words.
LINE = 512
#: More than any count's level.
MOST_LEVEL = 128
#: Tokens held before a task packs them, bytes of text scored at once, and bytes of text for each hash range.
FLUSH, STEP, RANGE_BYTES = 2_000_000, 1 << 20, 32 << 20
#: Rows of a document block in the path beyond the bounds.
BLOCK_ROWS = 4096
END, START = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
WORD, PAIR = 0, 1


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each row's tokens (its words and the end), of the token before each, and tokens before each row."""
    data, offsets = flat(column)
    data = LOWER[data]
    starts, ends, before = words(data, offsets)
    n = len(before) - 1
    row = np.repeat(np.arange(n), np.diff(before))
    out = np.full(len(starts) + n, END)
    out[np.arange(len(starts)) + row] = hash_spans(data, starts, ends, seed=3)
    before = before + np.arange(n + 1)
    past = np.empty_like(out)
    past[1:] = out[:-1]
    past[before[:-1]] = START
    return out, past, before


def pair_hash(past: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(past * U64(0x9E3779B97F4A7C15) + token)


def level_of(counts: np.ndarray) -> np.ndarray:
    """Quantised log frequency: 0 below 2, then one more for each factor of sqrt(2)."""
    return np.where(counts >= 2, 2 * np.log2(np.maximum(counts, 1)) + 1e-9 - 1, 0).astype(np.uint8)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The smallest count of a level."""
    return np.where(levels > 0, np.exp2((levels.astype(float) + 1) / 2), 0.0)


def stored_level(counts: np.ndarray) -> np.ndarray:
    """The level in the filter: 1 for once, else one more than `level_of`."""
    return level_of(counts) + (counts > 0).astype(np.uint8)


def stored_count(levels: np.ndarray) -> np.ndarray:
    """The smallest count of a level in the filter."""
    return np.where(levels > 1, count_of(np.maximum(levels, 1) - 1), levels.astype(float))


# packs: sorted hashes of one range, those that occur once first (7 bytes each: the top byte is the range's)


def _pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    many = counts > 1
    low = hashes.view(np.uint8).reshape(-1, 8)[:, :7]
    return np.array([(~many).sum(), many.sum()], "<u4").tobytes() + low[~many].tobytes() + low[many].tobytes() + counts[many].astype("<u4").tobytes()


def _unpack(blob: bytes, top: int) -> tuple[np.ndarray, np.ndarray]:
    once, many = np.frombuffer(blob, "<u4", 2).tolist()
    n = once + many
    raw = np.full((n, 8), top, np.uint8)
    raw[:, :7] = np.frombuffer(blob, np.uint8, 7 * n, 8).reshape(-1, 7)
    counts = np.ones(n, np.int64)
    counts[once:] = np.frombuffer(blob, "<u4", many, 8 + 7 * n)
    return raw.reshape(-1).view(U64), counts


def _merge(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[new], np.add.reduceat(counts[order], new) if len(hashes) else counts


def _ranged(kind: int, hashes: np.ndarray, counts: np.ndarray, ranges: int, first: int, last: int) -> pa.RecordBatch:
    """Packs of sorted hashes for the ranges from `first` to before `last`, of `ranges` equal ones."""
    edges = np.searchsorted(hashes, np.array([((i << 64) + ranges - 1) // ranges for i in range(first, last)], U64)).tolist() + [len(hashes)]
    rows = [(i, _pack(hashes[a:b], counts[a:b])) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False), first) if b > a]
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(rows), pa.int32()), pa.array([r for r, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["kind", "part", "pack"])


def _counting():
    """Texts to packs by kind and top byte."""

    def packs(kind: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        return _ranged(kind, *np.unique(np.concatenate(parts), return_counts=True), 256, 0, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        size = 0
        for batch in batches:
            for part in pieces(batch, "text", STEP):
                token, past, _ = tokens(part.column("text"))
                held[WORD].append(token)
                held[PAIR].append(pair_hash(past, token))
                size += len(token)
                if size >= FLUSH:
                    yield from (packs(k, h) for k, h in enumerate(held))
                    held, size = ([], []), 0
        if size:
            yield from (packs(k, h) for k, h in enumerate(held))

    return run


def _splitting(fine: int):
    """Some packs of a top byte, merged and cut into its `fine` ranges."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        kind, top = key[0].as_py(), key[1].as_py()
        both = [_unpack(x, top) for x in rows.column("pack").to_pylist()]
        merged = _merge(np.concatenate([h for h, _ in both]), np.concatenate([c for _, c in both]))
        return pa.Table.from_batches([_ranged(kind, *merged, 256 * fine, top * fine, (top + 1) * fine)])

    return run


def _merging(fine: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        kind, part = (k.as_py() for k in key)
        both = [_unpack(x, part // fine) for x in rows.column("pack").to_pylist()]
        hashes, counts = _merge(np.concatenate([h for h, _ in both]), np.concatenate([c for _, c in both]))
        total = int(counts.sum())
        if kind == PAIR:
            values = stored_level(counts)
            keys = int(values.sum())
        else:
            values, keys = counts.astype("<i8"), len(hashes)
        return pa.table({"kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int32()), "total": pa.array([total], pa.int64()), "keys": pa.array([keys], pa.int64()), "hashes": pa.array([hashes.tobytes()], pa.binary()), "values": pa.array([values.tobytes()], pa.binary())})

    return run


class Table:
    """Values by hash, from a sorted array of hashes."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        self.index, self.values = HashIndex(hashes), np.append(values, values.dtype.type(0))

    def get(self, keys: np.ndarray) -> np.ndarray:
        return self.values[self.index.find(keys)]


def _lines(keys: np.ndarray | int, bits: float) -> np.ndarray | int:
    """Blocks of the filter for so many keys."""
    return -(-(keys * bits).astype(np.int64) // LINE) + 1 if isinstance(keys, np.ndarray) else -(-int(keys * bits) // LINE) + 1


def _line_of(pair: np.ndarray, ranges: int, lines: np.ndarray | int) -> np.ndarray:
    """The block of a bigram among the `lines` of its range; sorted bigrams ask for blocks in order."""
    inside = (pair >> U64(32)) * U64(ranges) & U64(0xFFFFFFFF)
    return (inside * (lines.astype(U64) if isinstance(lines, np.ndarray) else U64(lines)) >> U64(32)).astype(np.int64)


def _level_key(pair: np.ndarray, level: int) -> np.ndarray:
    return mix(pair ^ U64((level * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF))


def _word_and_mask(key: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """One of a key's two words in its block, and the probes that lie there."""
    word = key & U64(7)
    if half:
        word = (word + U64(1) + ((key >> U64(3)) & U64(3))) & U64(7)
    mask = np.zeros(len(key), U64)
    for i in range(PROBES // 2):
        mask |= U64(1) << ((key >> U64(6 + 6 * i + 6 * half * (PROBES // 2))) & U64(63))
    return word.astype(np.int64), mask


def _field(pair: np.ndarray, level: np.ndarray, keys: int, ranges: int, bits: float) -> np.ndarray:
    """The part of the filter of one range."""
    lines = _lines(keys, bits)
    out = np.zeros(lines * (LINE // 64), U64)
    for j in range(1, int(level.max(initial=0)) + 1):
        some = pair[level >= j]
        key, base = _level_key(some, j), _line_of(some, ranges, lines) * (LINE // 64)
        for half in (0, 1):
            word, mask = _word_and_mask(key, half)
            np.bitwise_or.at(out, base + word, mask)
    return out


def _filter_part(ranges: int, bits: float):
    """A range's stored bigrams to its own stretch of the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, made = [], []
            for part, keys, h, v in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "hashes", "values")), strict=True):
                parts.append(part)
                made.append(_field(np.frombuffer(h, U64), np.frombuffer(v, np.uint8), keys, ranges, bits).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(made, pa.binary())], ["part", "field"])

    return run


class Filter:
    """The log-frequency Bloom filter: for each hash range its first block and how many it has, and the bits."""

    def __init__(self, first: np.ndarray, lines: np.ndarray, bits: np.ndarray):
        self.first, self.lines, self.bits = first, lines, bits

    def levels(self, pair: np.ndarray) -> np.ndarray:
        part = (pair >> U64(32)).astype(np.int64) * len(self.lines) >> 32
        out = np.zeros(len(pair), np.uint8)
        live = np.flatnonzero(self.lines[part] > 0)
        own, pair = part[live], pair[live]
        base = (self.first[own] + _line_of(pair, len(self.lines), self.lines[own])) * (LINE // 64)
        for level in range(1, MOST_LEVEL):
            if not len(live):
                break
            key = _level_key(pair, level)
            for half in (0, 1):
                word, mask = _word_and_mask(key, half)
                hit = np.flatnonzero(self.bits[base + word] & mask == mask)
                live, base, pair, key = live[hit], base[hit], pair[hit], key[hit]
            out[live] = level
        return out

    def get(self, pair: np.ndarray) -> np.ndarray:
        """Levels, asked once for each distinct bigram."""
        some, where = np.unique(pair, return_inverse=True)
        return self.levels(some)[where]


class Scorer:
    """Scores batches of texts given lookups of word counts and bigram levels, and the mixture weights."""

    def __init__(self, total: int, distinct: int, docs: int, weights: np.ndarray):
        self.norm, self.docs, self.weights = total + 0.5 * (distinct + 1), docs, weights

    def parts(self, token: np.ndarray, past: np.ndarray, counts: np.ndarray, levels, own: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unigram probability, context count and ratio of bigram to unigram estimate, per token; `own` occurrences
        are taken off the bigrams."""
        uni = (counts + 0.5) / self.norm
        context = np.empty_like(counts)
        context[1:] = counts[:-1]
        context[past == START] = self.docs
        level = levels(pair_hash(past, token))
        level[(context == 0) | (counts == 0)] = 0  # a pair of an unseen word is a false positive
        ratio = np.zeros(len(token))
        some = np.flatnonzero(level)
        ratio[some] = np.maximum(np.minimum(stored_count(level[some]), np.minimum(context[some], counts[some])) - own, 0) / context[some] / uni[some]
        return uni, context, ratio

    def score(self, column: pa.Array, get, levels) -> pa.StructArray:
        token, past, before = tokens(column)
        counts = get(token).astype(np.int64)
        uni, context, ratio = self.parts(token, past, counts, levels)
        weight = self.weights[bucket_of(context)]
        base, gain = np.log10(uni), np.log10(1 - weight + weight * ratio)
        add = lambda x: np.add.reduceat(x, before[:-1]) if len(x) else x  # noqa: E731  every row has a token
        made = (np.diff(before), add((counts > 0).astype(np.int64)), add(base), add(base + gain))
        return pa.StructArray.from_arrays([pa.array(x) for x in made], ["n_tokens", "n_known", "base_score", "score"])


SCORES = "struct<n_tokens:long,n_known:long,base_score:double,score:double>"
BUCKETS, BINS = 48, 121


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Contexts by the binary order of their count."""
    return np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0)


def fit_weights(ratios: np.ndarray) -> np.ndarray:
    """For each bucket the bigram weight that makes the counted ratios likeliest."""
    center = np.append(0.0, 10.0 ** ((np.arange(1, BINS) - 41 + 0.5) / 10))
    grid = np.append(0.0, np.geomspace(1e-4, 0.999, 200))
    gain = np.log(1 - grid[:, None] + grid[:, None] * center[None, :])
    best = grid[(ratios @ gain.T).argmax(axis=1)]
    return np.where(ratios.sum(axis=1) > 0, best, 0.0)


class Model:
    """Counts by hash range and what is derived from them; `small` tells whether filter and table are broadcast."""

    def __init__(self, counts: DataFrame, ranges: int, docs: int, spool: Spool, bits: float):
        self.spark, self.ranges, self.docs, self.spool = counts.sparkSession, ranges, docs, spool
        sums = {(r.kind, r.part): r for r in counts.select("kind", "part", "total", "keys").collect()}
        self.total = sum(r.total for (k, _), r in sums.items() if k == WORD)
        keys = {kind: np.array([sums[kind, i].keys if (kind, i) in sums else 0 for i in range(ranges)], np.int64) for kind in (WORD, PAIR)}
        self.own_words, self.distinct = keys[WORD], int(keys[WORD].sum())
        self.lines = np.where(keys[PAIR] > 0, _lines(keys[PAIR], bits), 0)
        self.words = counts.where(F.col("kind") == WORD).select("part", F.col("hashes"), "values")
        pairs = counts.where(F.col("kind") == PAIR).where("keys > 0").select("part", "keys", "hashes", "values")
        self.fields = spool.keep(pairs.mapInArrow(_filter_part(ranges, bits), "part int, field binary"), "filter")
        self.weights = np.zeros(BUCKETS)
        # the check of what is broadcast: hashes with counts of 8 bytes, and the filter
        self.small = self.distinct * 16 <= MOST_TABLE and int(self.lines.sum()) * (LINE // 8) <= MOST_FILTER

    def share(self):
        """Broadcasts what a scorer needs, gathered range by range into arrays of known size; beyond the bounds
        nothing is gathered."""
        if not self.small:
            return None
        at = np.cumsum(self.own_words) - self.own_words
        hashes, counts = np.empty(self.distinct, U64), np.empty(self.distinct, np.int64)
        for r in self.words.toLocalIterator():
            place = slice(at[r.part], at[r.part] + self.own_words[r.part])
            hashes[place], counts[place] = np.frombuffer(r.hashes, U64), np.frombuffer(r["values"], "<i8")
        if counts.max(initial=0) < 1 << 32:
            counts = counts.astype(np.uint32)
        first = np.cumsum(self.lines) - self.lines
        bits = np.zeros(int(self.lines.sum()) * (LINE // 64), U64)
        for r in self.fields.toLocalIterator():
            begin = first[r.part] * (LINE // 64)
            bits[begin : begin + len(r.field) // 8] = np.frombuffer(r.field, U64)
        return self.spark.sparkContext.broadcast((Table(hashes, counts), Filter(first, self.lines, bits)))

    def scorer(self) -> Scorer:
        return Scorer(self.total, self.distinct, self.docs, self.weights)

    def tune(self, docs: DataFrame, text: str, shared) -> None:
        """Fits the mixture on training documents: a document's own occurrence is taken off each of its bigrams, so
        one that occurs once counts as unseen."""
        own = self.scorer()

        def add(seen: np.ndarray, get, levels, column: pa.Array) -> None:
            token, past, _ = tokens(column)
            _, context, ratio = own.parts(token, past, get(token).astype(np.int64), levels, 1)
            some = ratio > 0
            place = np.zeros(len(token), np.int64)
            place[some] = np.clip(np.floor(np.log10(ratio[some]) * 10).astype(np.int64) + 41, 1, BINS - 1)
            seen += np.bincount(bucket_of(context) * BINS + place, minlength=len(seen))

        def cells(seen: np.ndarray) -> list[pa.Array]:
            return [pa.array(np.flatnonzero(seen)), pa.array(seen[seen > 0])]

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table_, filter_ = shared.value
            seen = np.zeros(BUCKETS * BINS, np.int64)
            for batch in batches:
                for part in pieces(batch, "text", STEP):
                    add(seen, table_.get, filter_.get, part.column("text"))
            yield pa.RecordBatch.from_arrays(cells(seen), ["cell", "n"])

        def count_block(_: tuple, some: pa.Table, answers: pa.Table) -> pa.Table:
            get, levels = _answered(answers)
            seen = np.zeros(BUCKETS * BINS, np.int64)
            for part in column_pieces(some.column("text").combine_chunks(), STEP):
                add(seen, get, levels, part)
            return pa.table(cells(seen), ["cell", "n"])

        if self.small:
            scored = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(count, "cell long, n long")
        else:
            body = _blocks(docs.select(F.col(text).alias("text")), "text", self.spool)[1]
            scored = body.groupBy("block").cogroup(answers_by_block(body, self).groupBy("block")).applyInArrow(count_block, "cell long, n long")
        ratios = np.zeros(BUCKETS * BINS)
        for r in scored.groupBy("cell").agg(F.sum("n").alias("n")).collect():
            ratios[r.cell] = r.n
        self.weights = fit_weights(ratios.reshape(BUCKETS, BINS))


def train(docs: DataFrame, text: str = "text", bits: float | None = None) -> Model:
    """Counts of all of `docs` and the filter made of them; both are spooled."""
    spool = Spool(docs.sparkSession, "lm")
    body = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = body.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    fine = 1 << (int(size.bytes) // (256 * RANGE_BYTES)).bit_length()
    packs = body.mapInArrow(_counting(), "kind int, part int, pack binary")
    if fine > 1:  # as many deals of a top byte as it has ranges: packs of a deal, and of a range, stay within some RANGE_BYTES
        deal = F.pmod(F.xxhash64("pack"), F.lit(fine)).alias("deal")
        packs = packs.groupBy("kind", "part", deal).applyInArrow(_splitting(fine), "kind int, part int, pack binary")
    schema = "kind int, part int, total long, keys long, hashes binary, values binary"
    counts = spool.keep(packs.groupBy("kind", "part").applyInArrow(_merging(fine), schema), "counts")
    return Model(counts, 256 * fine, size.n, spool, bits or BITS_PER_KEY)


def score(docs: DataFrame, model: Model, shared, text: str = "text", into: str = "lm") -> DataFrame:
    """`docs` with a struct column: n_tokens, n_known, base_score, score."""
    if not model.small:
        return _score_by_block(docs, model, text, into)
    own = model.scorer()

    @arrow_udf(SCORES)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table_, filter_ = shared.value
        for batch in batches:
            made = [own.score(p, table_.get, filter_.get) for p in column_pieces(batch, STEP)]
            yield pa.concat_arrays(made) if made else pa.array([], pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]))

    return docs.withColumn(into, run(F.coalesce(F.col(text), F.lit(""))))


def _blocks(docs: DataFrame, text: str, spool: Spool) -> tuple[DataFrame, DataFrame, str]:
    """`docs` spooled with a row number, of them row number, block and text, and the number's name."""
    row = fresh("row", docs)
    rows = spool.keep(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    return rows, rows.select(F.col(row).alias("row"), F.pmod(F.xxhash64(row), F.lit(blocks)).alias("block"), F.coalesce(F.col(text), F.lit("")).alias("text")), row


def answers_by_block(body: DataFrame, model: Model) -> DataFrame:
    """The counts of each block's distinct words and the levels of its distinct bigrams, fetched from the ranges."""
    ranges = model.ranges

    def ask(key: tuple, some: pa.Table) -> pa.Table:
        column = some.column("text").combine_chunks()
        both: tuple[list, list] = ([], [])
        for p in column_pieces(column, STEP):
            token, past, _ = tokens(p)
            both[WORD].append(np.unique(token))
            both[PAIR].append(np.unique(pair_hash(past, token)))
        kinds, parts, asked = [], [], []
        for kind, x in enumerate(both):
            hashes = np.unique(np.concatenate(x))
            cut = np.searchsorted((hashes >> U64(32)).astype(np.int64) * ranges >> 32, np.arange(ranges + 1))
            full = np.flatnonzero(np.diff(cut)).tolist()
            kinds += [kind] * len(full)
            parts += full
            asked += [hashes[cut[i] : cut[i + 1]].tobytes() for i in full]
        return pa.table({"block": pa.array([key[0].as_py()] * len(parts), pa.int64()), "kind": pa.array(kinds, pa.int32()), "part": pa.array(parts, pa.int32()), "hashes": pa.array(asked, pa.binary())})

    def answer(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
        wanted = [np.frombuffer(h, U64) for h in asked.column("hashes").to_pylist()]
        if not known.num_rows:
            got = [bytes(len(h) * (8 if key[0].as_py() == WORD else 1)) for h in wanted]
        elif key[0].as_py() == WORD:
            table_ = Table(np.frombuffer(known.column("hashes")[0].as_py(), U64), np.frombuffer(known.column("values")[0].as_py(), "<i8"))
            got = [table_.get(h).astype("<i8").tobytes() for h in wanted]
        else:
            bits = np.frombuffer(known.column("values")[0].as_py(), U64)
            lines = np.zeros(ranges, np.int64)
            lines[key[1].as_py()] = len(bits) // (LINE // 64)
            part = Filter(np.zeros(ranges, np.int64), lines, bits)
            got = [part.levels(h).tobytes() for h in wanted]
        return pa.table({"block": asked.column("block"), "kind": asked.column("kind"), "part": asked.column("part"), "hashes": asked.column("hashes"), "values": pa.array(got, pa.binary())})

    asked = body.groupBy("block").applyInArrow(ask, "block long, kind int, part int, hashes binary")
    known = model.words.select(F.lit(WORD).alias("kind"), "part", "hashes", "values").union(model.fields.select(F.lit(PAIR), "part", F.lit(b""), "field"))
    return asked.groupBy("kind", "part").cogroup(known.groupBy("kind", "part")).applyInArrow(answer, "block long, kind int, part int, hashes binary, values binary")


def _answered(answers: pa.Table):
    """The lookups of a block: counts of words and levels of bigrams."""
    answers = answers.sort_by("part")
    out = []
    for kind, type_ in ((WORD, "<i8"), (PAIR, np.uint8)):
        some = answers.filter(pc.equal(answers.column("kind"), kind))
        out.append(Table(np.frombuffer(b"".join(some.column("hashes").to_pylist()), U64), np.frombuffer(b"".join(some.column("values").to_pylist()), type_)).get)
    return out


def _score_by_block(docs: DataFrame, model: Model, text: str, into: str) -> DataFrame:
    """Scores without broadcasts: blocks of documents ask the hash ranges."""
    own = model.scorer()
    rows, body, row = _blocks(docs if into == text else docs.drop(into), text, model.spool)

    def finish(_: tuple, some: pa.Table, answers: pa.Table) -> pa.Table:
        get, levels = _answered(answers)
        column = some.column("text").combine_chunks()
        made = pa.concat_arrays([own.score(p, get, levels) for p in column_pieces(column, STEP)])
        return pa.table({"row": some.column("row"), "lm": made})

    scored = body.groupBy("block").cogroup(answers_by_block(body, model).groupBy("block")).applyInArrow(finish, f"row long, lm {SCORES}")
    return rows.join(scored.select(F.col("row").alias(row), F.col("lm").alias(into)), row).drop(row)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


def score_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", into: str = "lm") -> tuple[DataFrame, Model]:
    """Scores all of `docs` by a model of those not held out."""
    training = docs.where(~held_out(doc_id)).select(doc_id, text)
    model = train(training, text)
    shared = model.share()
    model.tune(training, text, shared)
    return score(docs, model, shared, text, into), model


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, model = score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", held_out().alias("held_out"), "lm.n_tokens", "lm.n_known", F.lit(model.total).cast("long").alias("train_tokens"), "lm.base_score", "lm.score")


QUERIES = {"op3_lm_score": op3_lm_score}
ORACLE: dict[str, str] = {}
