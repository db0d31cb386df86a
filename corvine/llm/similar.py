"""Links between texts whose sets of word shingles have a Jaccard similarity of `least` or more.

SimHash tells texts apart by an angle: at a similarity of 0.8 some ten of 64 bits differ, too many for covering masks.
Such pairs are found by bands of shingle minima instead: a shingle's hash falls into one of `BINS` bins, each keeps its
smallest hash (an empty bin that of the next one that is not empty), and `BANDS` bands of five bins are the keys. A
pair of similarity 0.8 agrees on some band with a probability above 0.9999. Distinct sets that share a key are compared
by their whole sets; in each bucket a spanning forest of the links is kept. Keys of one set only go no further, so
sets are made and shuffled for the others alone. A bucket of more than `CROWD` sets is dealt anew by other bins.

Texts of fewer words than a shingle are one shingle; texts without words are linked to none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._spark import Spool
from ._text import U64, column_pieces, mix

BINS, BANDS, WIDTH = 128, 25, 5
CROWD = 2048
NONE = U64(0xFFFFFFFFFFFFFFFF)


def _sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct shingle hashes (32 bits) of the texts behind one another, ascending, and each one's text."""
    from .simhash import shingle_hashes

    h, row, n = shingle_hashes(column, size)
    both = np.unique(row.astype(U64) << U64(32) | h >> U64(32))
    return both & U64(0xFFFFFFFF), (both >> U64(32)).astype(np.int64), len(n)


def band_keys(h: np.ndarray, row: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A row of keys for each text that has shingles, and these texts."""
    some, owner = np.unique(row, return_inverse=True)
    mixed = mix(h + (U64(salt + 1) << U64(40)))
    place = owner * BINS + (mixed >> U64(57)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    full, first = np.unique(place[order], return_index=True)
    least = np.full(len(some) * BINS, NONE)
    if len(full):
        least[full] = np.minimum.reduceat(mixed[order], first)
    least = least.reshape(len(some), BINS)
    twice = np.where(np.tile(least, (1, 2)) != NONE, np.arange(2 * BINS), 4 * BINS)
    source = np.minimum.accumulate(twice[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    away = (source - np.arange(BINS)).astype(U64)
    value = mix(np.take_along_axis(least, source % BINS, axis=1) + away * U64(0x9E3779B97F4A7C15))
    keys = np.tile(np.arange(BANDS, dtype=U64) + U64(salt * BANDS), (len(some), 1))
    for k in range(WIDTH):
        keys = mix(keys ^ value[:, k : BANDS * WIDTH : WIDTH])
    return keys, some


def signature(text: str, size: int) -> Column:
    """A struct of the set's digest and its keys; no keys for a text without words."""

    @arrow_udf("struct<digest:long,keys:array<long>>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            digests, keyed, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for piece in column_pieces(batch, 1 << 20):
                h, row, n = _sets(piece, size)
                keys, some = band_keys(h, row, n)
                total = np.append(U64(0), np.cumsum(mix(h.copy())))
                cut = np.searchsorted(row, np.arange(n + 1))
                digests.append(np.diff(total[cut]).view(np.int64))
                keyed.append(keys.ravel().view(np.int64))
                counts.append(np.bincount(some, minlength=n) * BANDS)
            offsets = np.append(0, np.cumsum(np.concatenate(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keyed)))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(digests)), lists], ["digest", "keys"])

    return sign(F.col(text))


def _whole(size: int):
    """The set of a text as binary, and its keys by other bins."""

    @arrow_udf("struct<whole:binary,more:array<long>>")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets, more = [], []
            for piece in column_pieces(batch, 1 << 20):
                h, row, n = _sets(piece, size)
                keys, some = band_keys(h, row, n, 1)
                cut = np.searchsorted(row, np.arange(n + 1))
                raw, of = h.astype("<u4"), dict(zip(some.tolist(), keys.view(np.int64).tolist(), strict=True))
                sets += [raw[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
                more += [of.get(i, []) for i in range(n)]
            yield pa.StructArray.from_arrays([pa.array(sets, pa.binary()), pa.array(more, pa.list_(pa.int64()))], ["whole", "more"])

    return make


def forest(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links; each tree is grown from a seed, against what it has not reached."""
    size = np.array([len(x) for x in sets], np.int64)
    data, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    edges, left = [], np.ones(len(sets), bool)
    while left.sum() > 1:
        seed = int(np.flatnonzero(left)[0])
        left[seed], todo = False, [seed]
        while todo and left.any():
            one = todo.pop()
            some = left[owner]
            data, owner = data[some], owner[some]
            own = sets[one]
            at = np.minimum(np.searchsorted(own, data), len(own) - 1)
            both = np.bincount(owner[own[at] == data], minlength=len(sets))
            near = np.flatnonzero(left & (both >= least * (size + len(own) - both) - 1e-9))
            edges += [(one, x) for x in near.tolist()]
            todo += near.tolist()
            left[near] = False
    return edges


def _linked(least: float):
    def run(rows: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, "<u4") for x in rows.column("whole").to_pylist()]
        pairs = np.array(forest(sets, least), np.int64).reshape(-1, 2)
        node = rows.column("node").to_numpy()
        return pa.table({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]})

    return run


def links(nodes: DataFrame, texts: DataFrame, least: float, size: int, spool: Spool, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) that connect the sets `nodes(node, sample, keys)`; `texts(sample, text)` has a text of each."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    met = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = spool.keep(keyed.join(met, "key"), "met")
    asked = met.select("node").distinct().join(nodes.select("node", "sample"), "node")
    sets = spool.keep(texts.join(asked, "sample").select("node", _whole(size)(F.col("text")).alias("s")).select("node", "s.*"), "sets")
    once = F.array(F.lit(0).cast("long"))
    dealt = met.join(sets, "node").select("key", "node", "whole", F.explode(F.when(F.col("n") > crowd, F.col("more")).otherwise(once)).alias("finer"))
    return dealt.groupBy("key", "finer").applyInArrow(_linked(least), "a long, b long").distinct()
