"""Suffix-array dedup of bytes.

A shard's segments are cut into blocks of 8, 16 or 32 bytes counted from their anchors, and the suffix array of the
block sequences is built by linear grouping (`gsaca`), whose time goes by the number of blocks. A window is its whole
blocks, four of them at least where it is long enough, and less than a block at either end. Windows are equal exactly
if their whole blocks are a common prefix of neighbouring suffixes and the ends are the same bytes, since equal
windows have their anchor at the same place. See `repeats` for how windows meet in a shard.

Null and empty texts have no bytes. Matches never cross documents. A repeated row repeats all its windows; an
empty table gives an empty table; other columns are passed on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import table
from ._text import _TAIL, lanes, mix, ragged
from .gsaca import suffix_array
from .repeats import Scheme, flag_runs, split_segments, without_repeats

#: Bytes of a machine word, and of the smallest block.
LANE = 8


def block_of(length: int) -> int:
    """Bytes of a block: as many as leave every window of `length` bytes four whole blocks, 8 at least and 32 at most."""
    return next((b for b in (32, 16) if (length - b + 1) // b >= 4), LANE)


def sa_kernel(segs: list[bytes], offs: np.ndarray, asked: int, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of the first `asked` segments that the suffix array of all segments finds in several places.
    All whole blocks of such a window occur twice, so only stretches of such blocks that are long enough for a window
    are sorted."""
    u = split_segments(segs, scheme)
    size, base, length = np.diff(u.before), u.before[:-1], scheme.length
    wide = block_of(length)
    windows = size - length + 1
    bounds = np.append(0, np.cumsum(windows))
    seg, j = ragged(windows)
    flags = np.zeros(len(seg), bool)
    # blocks that occur twice, in stretches
    lane = lanes(u.data)
    skip = offs % wide
    blocks = (size - skip) // wide
    row, nth = ragged(blocks)
    ahead = np.cumsum(blocks) - blocks
    at = base[row] + skip[row] + wide * nth
    symbol = _labels(*[lane[at + k] for k in range(0, wide, LANE)])
    of, begin, end = flag_runs(np.bincount(symbol)[symbol] > 1, ahead)
    good = end - begin >= (length - wide + 1) // wide
    begin, end = ahead[of[good]] + begin[good], ahead[of[good]] + end[good]
    if not len(begin):
        return flag_runs(flags[: bounds[asked]], bounds[:asked])
    stretch, nth = ragged(end - begin)
    text = np.ones(len(stretch) + len(begin) + 1, np.int64)
    spot = np.arange(len(stretch)) + stretch
    text[spot] = symbol[begin[stretch] + nth] + 2
    text[-1] = 0
    place, room = np.full(len(row), -1), np.zeros(len(row), np.int64)  # of a block: its place in the text, blocks to its stretch's end
    place[begin[stretch] + nth], room[begin[stretch] + nth] = spot, (end - begin)[stretch] - nth
    order = np.array(suffix_array(text.tolist()), np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    # neighbours in the order that share `blocks` symbols belong to one class
    most = length // wide
    padded = np.append(text, np.zeros(most + 1, np.int64))
    same = np.arange(1, len(order))
    classes = {}
    for k in range(most + 1):
        if k in {(length - e) // wide for e in range(wide)}:
            differs = np.ones(len(order), bool)
            differs[same] = False
            classes[k] = np.cumsum(differs)
        same = same[padded[order[same] + k] == padded[order[same - 1] + k]]
    # windows whose whole blocks lie in one stretch
    head = (offs[seg] - j) % wide
    whole = (length - head) // wide
    block = ahead[seg] + (j + head - skip[seg]) // wide
    some = np.flatnonzero(room[np.minimum(block, len(room) - 1)] >= whole)
    seg, j, head, whole, block = seg[some], j[some], head[some], whole[some], block[some]
    tail, at, group = (length - head) % wide, rank[place[block]], np.zeros(len(some), np.int64)
    for k, number in classes.items():
        own = whole == k
        group[own] = number[at[own]]
    left, right = base[seg] + j, base[seg] + j + head + wide * whole
    ends = [lane[np.minimum(a + k, len(lane) - 1)] & _TAIL[np.clip(n - k, 0, LANE)] for a, n in ((left, head), (right, tail)) for k in range(0, wide, LANE)]
    label = _labels(group * wide + head, *ends)
    flags[some] = np.bincount(label, minlength=1)[label] >= 2
    return flag_runs(flags[: bounds[asked]], bounds[:asked])


def _labels(*keys: np.ndarray) -> np.ndarray:
    """Equal numbers for equal rows of `keys`. Rows are sorted by a hash of all keys, by the keys themselves only if
    two different rows share a hash."""
    hashed = np.zeros(len(keys[0]), np.uint64)
    for key in keys:
        hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + key.view(np.uint64))
    for turn in (np.argsort(hashed), None):
        if turn is None:
            turn = np.lexsort(keys)
        new = np.ones(len(turn), bool)
        new[1:] = np.any([key[turn][1:] != key[turn][:-1] for key in keys], axis=0)
        if np.array_equal(new[1:], np.diff(hashed[turn]) != 0):
            break
    label = np.empty(len(turn), np.int64)
    label[turn] = np.cumsum(new) - 1
    return label


def dedup_bytes(docs: DataFrame, text: str = "text", length: int = 200, into: str = "repeats") -> DataFrame:
    """`docs` with a struct: n_units (bytes), n_removed, n_spans, kept (the remaining bytes)."""
    if length < 2 * LANE:
        raise ValueError("windows must be at least two blocks of 8 bytes long")
    return without_repeats(docs, text, Scheme("byte", length), sa_kernel, into)


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("repeats.n_units").alias("n_bytes"), F.col("repeats.n_removed").alias("n_removed"), F.col("repeats.n_spans").alias("n_spans"), F.sha2("repeats.kept", 256).alias("kept_sha256"))


QUERIES = {"op9_suffix_array": op9_suffix_array}
ORACLE = {
    "op9_suffix_array": """
with d as (select row_number() over () as rid, doc_id, encode(coalesce(text, '')) as raw, octet_length(encode(coalesce(text, ''))) as n from documents),
p as (select rid, raw, unnest(range(1, n - 198)) as pos from d where n >= 200),
h as (select rid, pos, md5_number(raw[pos:pos + 199]) as h from p),
s as (select rid, pos from h where h in (select h from h group by h having count(*) > 1)),
b as (select rid, unnest(range(1, n + 1)) as pos, raw from d where n > 0),
c as (
  select b.rid, b.pos, hex(b.raw[b.pos:b.pos]) as byte, max(s.pos) over (partition by b.rid order by b.pos rows between 199 preceding and current row) is not null as gone
  from b left join s on b.rid = s.rid and b.pos = s.pos where b.rid in (select rid from s)
),
e as (select *, gone and not coalesce(lag(gone) over (partition by rid order by pos), false) as begins from c),
k as (select rid, count(*) filter (gone) as removed, count(*) filter (begins) as spans, string_agg(byte, '' order by pos) filter (not gone) as kept from e group by rid)
select d.doc_id, cast(d.n as bigint) as n_bytes, cast(coalesce(k.removed, 0) as bigint) as n_removed, cast(coalesce(k.spans, 0) as bigint) as n_spans,
       sha256(case when k.rid is null then d.raw else unhex(coalesce(k.kept, '')) end) as kept_sha256
from d left join k on d.rid = k.rid
"""
}
