"""Windows of units (words or bytes) that start at more than one place of a corpus: routing and results.

Two equal windows must meet in one index, and no index may hold more than a bounded share of the corpus.
Every window has an anchor, the smallest hashed gram inside it, leftmost of equals; equal windows have equal
anchors at equal places. Consecutive windows with one anchor form a run, and its text is a segment: about two
per window length, so anchors are few. Steps:

1. Count anchors over all documents; one that occurs once has no repeated window.
2. Give each document its repeated anchors; its segments at these are the candidates. Equal segments travel as one
   row with a count, so that copies do not swell a shard.
3. An anchor with many different segments (a common passage in many contexts) is dealt finer: each of its
   windows goes by its own hash, equal windows again one row with a count.
4. Shards of bounded size, dealt by anchor, are indexed and searched by a kernel, which reports the runs of
   windows that occur twice or more. A segment with a count of two or more lies in the index twice: what is
   repeated is found there and nowhere else, the kernel sees no counts. The two operators differ in the kernel only.
5. Reports go back to the documents that hold the segments.

Documents are told by a 128-bit digest of their text; equal texts have equal results. Nothing is collected to
the driver or broadcast. Intermediate tables are spooled to the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._spark import Spool, fresh, partitions
from ._text import SPACE, column_pieces, flat, hash_spans, lanes, mix, pieces, words

#: Positions in a batch take the low bits of the ordering key, the gram's hash the rest; fixed, so that the choice
#: of an anchor depends on a window's content alone.
PLACE_BITS = 31
#: Segments that a shard holds on average.
SHARD = 8192
#: More different segments than this at an anchor are dealt by window: no anchor brings more than another shard.
CROWD = SHARD
#: Crowded anchors (8 bytes each) that are broadcast; more of them are joined by a shuffle.
MOST_CROWDS = 100_000
#: Bytes of text worked on at once.
STEP = 1 << 19


@dataclass(frozen=True)
class Scheme:
    """What a window is: `length` units of words or bytes, anchored at grams of `gram` units.

    Grams are about a quarter of a window, eight words or 32 bytes at most: long enough that chance does not repeat
    them, short enough that anchors are few.
    """

    unit: str
    length: int

    @property
    def gram(self) -> int:
        quarter = 1 << max(0, (self.length // 4).bit_length() - 1)
        return max(8, min(32, quarter)) if self.unit == "byte" else min(8, quarter)


@dataclass
class Units:
    data: np.ndarray
    before: np.ndarray
    starts: np.ndarray | None
    ends: np.ndarray | None

    def grams(self, gram: int) -> np.ndarray:
        """Hashes of all grams, by doubling; the gram's size is a power of two, for bytes eight or more."""
        if self.starts is None:
            h, size = mix(lanes(self.data)[: max(0, len(self.data) - 7)].copy()), 8
        else:
            h, size = hash_spans(self.data, self.starts, self.ends), 1
        while size < gram:
            h = mix(h[:-size] * np.uint64(0x9E3779B97F4A7C15) + h[size:]) if len(h) > size else h[:0]
            size *= 2
        return h


def units(column: pa.Array, scheme: Scheme) -> Units:
    data, offsets = flat(column)
    if scheme.unit == "byte":
        return Units(data, offsets, None, None)
    starts, ends, before = words(data, offsets)
    return Units(data, before, starts, ends)


def runs(u: Units, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first window, last window, place of the anchor and hash of the anchor, for each run of windows."""
    n = int(u.before[-1])
    total, wide = n - scheme.length + 1, scheme.length - scheme.gram + 1
    sizes = np.diff(u.before)
    none = np.zeros(0, np.int64)
    rows = np.flatnonzero(sizes >= scheme.length)
    if total <= 0 or not len(rows):
        return none, none, none, none, none.view(np.uint64)
    grams = u.grams(scheme.gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wide:
        least = np.minimum(least[: size - wide], least[wide - size :])
    inside = np.zeros(total + 1, np.int8)
    np.add.at(inside, u.before[rows], 1)
    np.add.at(inside, u.before[rows] + sizes[rows] - scheme.length + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[:total], dtype=np.int8))
    place = (least[window] & low).astype(np.int64)
    new = np.flatnonzero(np.append(True, np.diff(place) != 0))
    first, last = window[new], window[np.append(new[1:], len(window)) - 1]
    return np.searchsorted(u.before, first, "right") - 1, first, last, place[new], grams[place[new]]


def anchors(text: Column, scheme: Scheme) -> Column:
    """The anchors of a text's runs; one that the text has more than once comes twice."""

    @arrow_udf("array<long>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made = []
            for part in column_pieces(batch, STEP):
                row, _, _, _, anchor = runs(units(part, scheme), scheme)
                order = np.lexsort((anchor, row))
                row, anchor = row[order], anchor[order]
                third = np.zeros(len(row), bool)
                third[2:] = (row[2:] == row[:-2]) & (anchor[2:] == anchor[:-2])
                row, anchor = row[~third], anchor[~third]
                cut = np.searchsorted(row, np.arange(len(part) + 1))
                made.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(anchor.view(np.int64))))
            yield pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.int64()))

    return find(text)


def _joined(u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words behind one another with a blank after each: bytes, and each word's start and end there."""
    size = u.ends - u.starts
    start = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    from_ = np.repeat(u.starts - start, size)
    place = np.arange(len(out))
    body = np.ones(len(out), bool)
    body[start + size] = False
    place = place[body]
    out[place] = u.data[place + from_]
    return out, start, start + size


def _segments(scheme: Scheme) -> Callable:
    """Rows (key, text, wanted anchors) to candidate segments; a segment's text comes once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in pieces(batch, "text", STEP):
                u = units(part.column("text"), scheme)
                row, first, last, place, anchor = runs(u, scheme)
                lists = part.column("anchors")
                want, bounds = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy()
                # (row, anchor) pairs that are wanted
                keep = np.zeros(len(row), bool)
                cut = np.searchsorted(row, np.arange(len(part) + 1))
                for i in range(len(part)):
                    if cut[i] < cut[i + 1]:
                        keep[cut[i] : cut[i + 1]] = np.isin(anchor[cut[i] : cut[i + 1]], want[bounds[i] : bounds[i + 1]])
                row, first, last, place, anchor = (x[keep] for x in (row, first, last, place, anchor))
                if scheme.unit == "byte":
                    raw, a, b = u.data.tobytes(), first, last + scheme.length
                else:
                    data, s, e = _joined(u)
                    raw, a, b = data.tobytes(), s[first], e[last + scheme.length - 1]
                off = place - first
                keys = part.column("key").to_pylist()
                texts, ids = [], []
                for x, y, o in zip(a.tolist(), b.tolist(), off.tolist(), strict=True):
                    seg = raw[x:y]
                    sid = hashlib.blake2b(seg, digest_size=16, salt=o.to_bytes(8, "little")).digest()
                    ids.append(sid)
                    if sid in seen:
                        texts.append(None)
                    else:
                        seen.add(sid)
                        texts.append(seg)
                if len(seen) > 500_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[r] for r in row.tolist()], pa.binary()), pa.array(ids, pa.binary()), pa.array(first - u.before[row]), pa.array(anchor.view(np.int64)), pa.array(off.astype(np.int32)), pa.array(texts, pa.binary())],
                    ["key", "sid", "at", "anchor", "off", "seg"],
                )

    return run


def split_segments(segs: list[bytes], scheme: Scheme) -> Units:
    return units(pa.array(segs, pa.large_binary()), scheme)


def _windows(scheme: Scheme) -> Callable:
    """Segments to their single windows; a window's text comes once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for sid, n, off, seg in zip(*(batch.column(c).to_pylist() for c in ("sid", "n", "off", "seg")), strict=True):
                if scheme.unit == "byte":
                    every = [seg[j : j + scheme.length] for j in range(len(seg) - scheme.length + 1)]
                else:
                    w = seg.split(b" ")
                    every = [b" ".join(w[j : j + scheme.length]) for j in range(len(w) - scheme.length + 1)]
                for j, window in enumerate(every):
                    wid = hashlib.blake2b(window, digest_size=16).digest()
                    for column, value in zip(out, (sid, j, wid, n, off - j, None if wid in seen else window), strict=True):
                        column.append(value)
                    seen.add(wid)
                if len(seen) > 500_000:
                    seen.clear()
            types = (pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], ["sid", "j", "wid", "n", "off", "seg"])

    return run


#: A kernel gets a shard's segments, the anchors' places in them and how many of the segments are asked for: the
#: first so many. It returns for each of their runs of windows that occur at least twice among all segments: the
#: segment's number, its first window and the window after its last.
Kernel = Callable[[list[bytes], np.ndarray, int, Scheme], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _search(kernel: Kernel, scheme: Scheme) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = [b for b in batches if b.num_rows]
        if not shard:
            return
        whole = pa.Table.from_batches(shard).combine_chunks()
        segs, sids, offs = whole.column("seg").to_pylist(), whole.column("sid"), whole.column("off").to_numpy().astype(np.int64)
        again = np.flatnonzero(whole.column("n").to_numpy() >= 2)  # two occurrences tell as much as a thousand
        seg, lo, hi = kernel(segs + [segs[i] for i in again.tolist()], np.append(offs, offs[again]), len(segs), scheme)
        yield pa.RecordBatch.from_arrays([sids.take(pa.array(seg)).combine_chunks(), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["sid", "lo", "hi"])

    return run


def flag_runs(flags: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set flags inside rows that begin at `bounds`: row, first place in it, place after the last."""
    if not len(flags):
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(flags) + 1, bool)
    edge[bounds] = True
    begin = flags & (edge[:-1] | np.append(True, ~flags[:-1]))
    stop = flags & (edge[1:] | np.append(~flags[1:], True))
    a, b = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    row = np.searchsorted(bounds, a, "right") - 1
    return row, a - bounds[row], b - bounds[row]


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def repeated_spans(docs: DataFrame, text: str, scheme: Scheme, kernel: Kernel, spool: Spool) -> DataFrame:
    """(key, spans): for each distinct text with repeated windows its digest and the unit spans they cover, as
    they overlap, in no order."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # 1. which anchors occur twice; the short key only narrows down where to look
    some = spool.keep(docs.select(F.xxhash64(body).alias("k"), anchors(body, scheme).alias("anchors")), "anchors")
    each = some.select("k", F.explode("anchors").alias("anchor"))
    twice = each.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    # 2. candidates
    wanted = each.join(twice, "anchor", "left_semi").distinct().groupBy("k").agg(F.collect_set("anchor").alias("anchors"))
    found = docs.select(F.xxhash64(body).alias("k"), text_key(F.col(text)).alias("key"), body.alias("text")).join(wanted, "k").select("key", "text", "anchors")
    occurring = spool.keep(found.mapInArrow(_segments(scheme), "key binary, sid binary, at long, anchor long, off int, seg binary"), "segments")
    spool.drop(some)
    counted = occurring.groupBy("sid").agg(F.count("*").alias("n"), F.min("anchor").alias("anchor"), F.min("off").alias("off"), F.max("seg").alias("seg"))
    counted = spool.keep(counted, "distinct")
    # 3. crowded anchors
    crowd = spool.keep(counted.groupBy("anchor").agg(F.count("*").alias("c")).where(F.col("c") > CROWD).select("anchor"), "crowd")
    if crowd.count() <= MOST_CROWDS:  # a checked bound: then segments need not move to learn whether their anchor is crowded
        crowd = F.broadcast(crowd)
    alone = counted.join(crowd, "anchor", "left_anti").select("sid", "n", "off", "seg", F.col("anchor").alias("route"))
    split = counted.join(crowd, "anchor", "left_semi").select("sid", "n", "off", "seg")
    single = spool.keep(split.mapInArrow(_windows(scheme), "sid binary, j int, wid binary, n long, off int, seg binary"), "windows")
    window = single.groupBy("wid").agg(F.sum("n").alias("n"), F.min("off").alias("off"), F.max("seg").alias("seg"))
    window = window.select(F.col("wid").alias("sid"), "n", "off", "seg", F.xxhash64("wid").alias("route"))
    # 4. shards
    rows = spool.keep(alone.union(window), "shards")
    shards = partitions(spark, rows.count(), SHARD)
    reports = rows.repartition(shards, "route").mapInArrow(_search(kernel, scheme), "sid binary, lo int, hi int")
    reports = spool.keep(reports, "reports")
    spool.drop(rows, counted)
    # 5. back to the documents
    from_windows = single.select(F.col("sid").alias("parent"), "j", "wid").join(reports, F.col("wid") == reports.sid, "left_semi").select(F.col("parent").alias("sid"), F.col("j").alias("lo"), (F.col("j") + 1).alias("hi"))
    places = occurring.select("key", "sid", "at").distinct()
    hits = places.join(reports.union(from_windows), "sid").select("key", (F.col("at") + F.col("lo")).alias("start"), (F.col("at") + F.col("hi") - 1 + scheme.length).alias("stop"))
    return spool.keep(hits.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")


def cover_of(u: Units, spans: pa.Array) -> np.ndarray:
    """Which units the spans of each row cover."""
    n = int(u.before[-1])
    delta = np.zeros(n + 1, np.int32)
    if isinstance(spans, pa.ChunkedArray):
        spans = spans.combine_chunks()
    size = np.diff(spans.offsets.to_numpy())
    if len(spans) and size.sum():
        lo, hi = spans.offsets[0].as_py(), spans.offsets[-1].as_py()
        rows = np.repeat(np.arange(len(spans)), size)
        values = spans.values.slice(lo, hi - lo)
        np.add.at(delta, u.before[rows] + values.field("start").to_numpy(), 1)
        np.add.at(delta, u.before[rows] + values.field("stop").to_numpy(), -1)
    return np.cumsum(delta[:n]) > 0


SPLIT = "struct<n_units:long,n_removed:long,n_spans:long,kept:binary>"


def strip(text: Column, spans: Column, scheme: Scheme) -> Column:
    """A struct: units, removed units, maximal removed runs, and what is kept (words joined by one blank; bytes
    behind one another)."""

    @arrow_udf(SPLIT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans_ in batches:
            made, at = [], 0
            for part in column_pieces(texts, STEP):
                u = units(part, scheme)
                gone = cover_of(u, spans_.slice(at, len(part)))
                at += len(part)
                rows = np.diff(u.before)
                row = np.repeat(np.arange(len(part)), rows)
                removed = np.bincount(row, gone, len(part)).astype(np.int64)
                begin, _, _ = flag_runs(gone, u.before[:-1][rows > 0])
                where = np.flatnonzero(rows > 0)
                n_spans = np.bincount(where[begin], minlength=len(part)) if len(begin) else np.zeros(len(part), np.int64)
                if scheme.unit == "byte":
                    raw, size = u.data[~gone], rows - removed
                else:
                    data, s, e = _joined(u)
                    keep = np.repeat(~gone, e - s + 1)
                    last = np.flatnonzero(~gone)
                    final = last[np.append(row[last][1:] != row[last][:-1], True)] if len(last) else last
                    keep[e[final]] = False
                    raw = data[keep]
                    size = np.bincount(row, np.where(gone, 0, e - s + 1), len(part)).astype(np.int64)
                    size -= size > 0
                ends = np.append(0, np.cumsum(size))
                kept = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]).cast(pa.binary())
                made.append(pa.StructArray.from_arrays([pa.array(rows.astype(np.int64)), pa.array(removed), pa.array(n_spans.astype(np.int64)), kept], ["n_units", "n_removed", "n_spans", "kept"]))
            yield pa.concat_arrays(made) if made else pa.array([], pa.struct([("n_units", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]))

    return cut(text, spans)


def without_repeats(docs: DataFrame, text: str, scheme: Scheme, kernel: Kernel, into: str) -> DataFrame:
    """`docs` with a struct column of `strip`, which replaces one of its name. All other rows and columns stay,
    whatever their names; a null text counts as empty; an empty table gives an empty table. Repeated rows are
    occurrences of their own, so every window of a repeated row is repeated."""
    spool = Spool(docs.sparkSession, f"repeats-{scheme.unit}")
    spans = repeated_spans(docs.select(text), text, scheme, kernel, spool)
    key, found = fresh("key", docs), fresh("spans", docs)
    keyed = docs.withColumn(key, text_key(F.col(text)))
    spans = spans.select(F.col("key").alias(key), F.col("spans").alias(found))
    empty = F.array().cast("array<struct<start:long,stop:long>>")
    out = keyed.join(spans, key, "left")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = out.withColumn(into, strip(body, F.coalesce(found, empty), scheme))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()], into)
