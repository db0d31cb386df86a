"""Benchmark decontamination by a generalised suffix automaton of normalised test items.

Test items are cut into pieces of bounded size that overlap by a window less one word, and the distinct pieces are
dealt by hash into blocks of about `BLOCK_BYTES`. Executors build one automaton a block, as arrays; automata are
spooled, and as many as fit `PASS_BYTES` of items are broadcast for a pass over the documents. A benchmark beyond
that takes further passes, which return only documents with a hit; the documents are spooled once for them.

Training words are streamed through the automata, which keep the longest match that ends at each word; stretches of
words that all occur in a block go side by side, cut where they are long with a window less one word of overlap. A
match of `length` words or more covers its words; an item shorter than that counts where it occurs whole.

Normalisation: A-Z in lower case, words are maximal runs of letters, digits and bytes above 0x7F.
Nulls have no words. Items without words match nothing; an item with a null id covers words but is not listed;
items of equal id are one item. Repeated rows are judged each on its own; an empty table of documents gives an
empty table, one of items leaves all clean; other columns are passed on, one named like the result is replaced.
In a single pass documents are never shuffled; a hot passage costs each document its own scan.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._spark import Spool, bounded_batches, fresh, table
from ._text import LOWER, column_pieces, flat, hash_spans, ragged, spans

LENGTH = 10
#: UTF-8 bytes of items in a block, and in the blocks of one pass; words of a piece of an item, and of a lane.
BLOCK_BYTES, PASS_BYTES, PIECE, LANE = 4 << 20, 16 << 20, 1 << 14, 128

MEMBER = np.zeros(256, bool)
MEMBER[0x30:0x3A] = MEMBER[0x61:0x7B] = MEMBER[0x80:] = True


def normal_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts, word ends, words before each row."""
    data, offsets = flat(column)
    data = LOWER[data]
    return data, *spans(MEMBER[data], offsets)


class _Growing:
    """A suffix automaton while words are added. Most states have one transition, kept in arrays; the others' are in
    dictionaries."""

    def __init__(self):
        self.word, self.to, self.more = array("q", [-1]), array("q", [-1]), {0: {}}
        self.link, self.len = array("q", [-1]), array("q", [0])

    def go(self, state: int, w: int) -> int:
        if self.word[state] == w:
            return self.to[state]
        more = self.more.get(state)
        return -1 if more is None else more.get(w, -1)

    def _set(self, state: int, w: int, to: int) -> None:
        if self.word[state] in (w, -1) and state:
            self.word[state], self.to[state] = w, to
        else:
            self.more.setdefault(state, {})[w] = to

    def _state(self, length: int, link: int) -> int:
        for a, x in ((self.word, -1), (self.to, -1), (self.link, link), (self.len, length)):
            a.append(x)
        return len(self.len) - 1

    def extend(self, last: int, w: int) -> int:
        """Adds a word behind the state `last`; shared states are kept or cloned, so sequences may overlap."""
        link, length = self.link, self.len
        q = self.go(last, w)
        if q >= 0:
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = self._state(length[last] + 1, 0)
        p = last
        while p >= 0 and (q := self.go(p, w)) < 0:
            self._set(p, w, cur)
            p = link[p]
        if p >= 0:
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._state(self.len[p] + 1, self.link[q])
        self.word[c], self.to[c] = self.word[q], self.to[q]
        if q in self.more:
            self.more[c] = dict(self.more[q])
        self.link[q] = c
        while p >= 0 and self.go(p, w) == q:
            self._set(p, w, c)
            p = self.link[p]
        return c


class Automaton:
    """The suffix automaton of a block as arrays. A state's `hits` are the items that hold its windows."""

    ARRAYS = ("vocab", "word", "to", "keys", "targets", "link", "len", "window", "hit_first", "hit_item", "short", "short_first", "short_size", "short_item")

    def __init__(self, texts: list[str], items: list[int], length: int):
        """`items` are numbers of names, in the order of the texts."""
        data, starts, ends, before = normal_words(pa.array(texts, pa.string()))
        hashes = hash_spans(data, starts, ends)
        self.length, self.vocab = length, np.unique(hashes)
        ids, cut = np.searchsorted(self.vocab, hashes).tolist(), before.tolist()
        made, sequences = _Growing(), [(i, ids[a:b]) for i, a, b in zip(items, cut, cut[1:], strict=False) if b > a]
        for _, seq in sequences:
            last = 0
            for w in seq:
                last = made.extend(last, w)
        self.shortest = min([length, *(len(s) for _, s in sequences)])
        self.word, self.to, self.link, self.len = (np.array(x, np.int32) for x in (made.word, made.to, made.link, made.len))
        more = np.array([(s * len(self.vocab) + w, t) for s, x in made.more.items() for w, t in x.items()], np.int64).reshape(-1, 2)
        more = more[np.argsort(more[:, 0])]
        self.keys, self.targets = more[:, 0].copy(), more[:, 1].astype(np.int32)
        # the state of a match's last `length` words
        self.window = np.arange(len(self.len), dtype=np.int32)
        while True:
            up = self.link[self.window]
            rise = (up > 0) & (self.len[up] >= length)
            if not rise.any():
                break
            self.window[rise] = up[rise]
        # which items hold a window, and which short items end at a state
        hits, whole = [], []
        for item, seq in sequences:
            state = 0
            for n, w in enumerate(seq, 1):
                state = made.go(state, w)
                if n >= length:
                    hits.append((state, item))
            if len(seq) < length:
                whole.append((state, len(seq), item))
        h = np.array(hits, np.int64).reshape(-1, 2)
        h = np.unique(np.column_stack([self.window[h[:, 0]], h[:, 1]]), axis=0)
        self.hit_first, self.hit_item = np.searchsorted(h[:, 0], np.arange(len(self.len) + 1)).astype(np.int32), h[:, 1].astype(np.int32)
        s = np.unique(np.array(whole, np.int64).reshape(-1, 3), axis=0)
        self.short_first = np.searchsorted(s[:, 0], np.arange(len(self.len) + 1)).astype(np.int32)
        self.short_size, self.short_item = s[:, 1].astype(np.int32), s[:, 2].astype(np.int32)
        # the nearest state of the chain, itself included, at which a short item ends
        self.short = np.where(np.diff(self.short_first) > 0, np.arange(len(self.len)), -1).astype(np.int32)
        for state in np.argsort(self.len, kind="stable")[1:].tolist() if len(s) else ():
            if self.short[state] < 0:
                self.short[state] = self.short[self.link[state]]

    def dump(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in self.ARRAYS}

    @classmethod
    def load(cls, length: int, shortest: int, raw: dict[str, bytes]) -> Automaton:
        out = cls.__new__(cls)
        out.length, out.shortest = length, shortest
        for name in cls.ARRAYS:
            setattr(out, name, np.frombuffer(raw[name], {"vocab": np.uint64, "keys": np.int64}.get(name, np.int32)))
        return out

    def _next(self, state: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.where(self.word[state] == w, self.to[state], -1)
        rest = np.flatnonzero(out < 0)
        if len(rest) and len(self.keys):
            key = state[rest].astype(np.int64) * len(self.vocab) + w[rest]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[rest] = np.where(self.keys[at] == key, self.targets[at], -1)
        return out

    def match(self, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the words of several documents: first and last + 1 of each match, then places and items that occur there."""
        none = np.zeros(0, np.int64)
        if not len(self.vocab) or not len(hashes):
            return none, none, none, none
        ids = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        starts, ends, _ = spans(self.vocab[ids] == hashes, before)
        some = ends - starts >= self.shortest
        starts, ends = starts[some], ends[some]
        # lanes, long ones first
        lane, nth = ragged(np.maximum(-(-(ends - starts - self.length + 1) // LANE), 1))
        at = starts[lane] + nth * LANE
        size = np.minimum(at + LANE + self.length - 1, ends[lane]) - at
        order = np.argsort(-size, kind="stable")
        at, size = at[order], size[order]
        state, n = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
        last, got, to = [], [], []
        for i in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -i, "left"))  # lanes longer than i
            todo, w = np.arange(live), ids[at[:live] + i]
            while len(todo):
                went = self._next(state[todo], w[todo])
                good = went >= 0
                state[todo[good]] = went[good]
                n[todo[good]] += 1
                todo = todo[~good]
                todo = todo[state[todo] > 0]
                state[todo] = self.link[state[todo]]
                n[todo] = self.len[state[todo]]
            hit = np.flatnonzero((n[:live] >= self.length) | (self.short[state[:live]] >= 0))
            last.append(at[hit] + i + 1)
            got.append(n[hit])
            to.append(state[hit])
        if not last:
            return none, none, none, none
        last, got, to = (np.concatenate(x) for x in (last, got, to))
        full = got >= self.length
        first, stop = [last[full] - got[full]], [last[full]]
        window = self.window[to[full]]
        k, j = ragged(self.hit_first[window + 1] - self.hit_first[window])
        place, item = [last[full][k] - 1], [self.hit_item[self.hit_first[window][k] + j]]
        up = self.short[to]
        while (on := np.flatnonzero(up >= 0)).size:
            last, got, up = last[on], got[on], up[on]
            k, j = ragged(self.short_first[up + 1] - self.short_first[up])
            entry = self.short_first[up][k] + j
            own = self.short_size[entry] <= got[k]  # the chain's first state may be longer than the match
            k, entry = k[own], entry[own]
            first.append(last[k] - self.short_size[entry])
            stop.append(last[k])
            place.append(last[k] - 1)
            item.append(self.short_item[entry])
            up = self.short[self.link[up]]
        return np.concatenate(first), np.concatenate(stop), np.concatenate(place), np.concatenate(item)


def _cutting(length: int):
    """Items to pieces of at most `PIECE` windows; one without words goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends, before = normal_words(batch.column("text"))
            row, at, stop = [], [], []
            for i, (a, b) in enumerate(zip(before.tolist(), before[1:].tolist(), strict=False)):
                for k in range(a, max(b - length, a) + 1, PIECE) if b > a else ():
                    row.append(i)
                    at.append(int(starts[k]))
                    stop.append(int(ends[min(k + PIECE + length - 1, b) - 1]))
            raw = data.tobytes()
            texts = pa.array([raw[a:b] for a, b in zip(at, stop, strict=True)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(row, pa.int64())), texts], ["item", "text"])

    return run


def _building(length: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        names = rows.column("item").combine_chunks().dictionary_encode()
        numbers = names.indices.fill_null(len(names.dictionary)).to_pylist()  # a null id is the last number
        made = Automaton(rows.column("text").to_pylist(), numbers, length)
        raw = made.dump()
        head = {"block": pa.array([key[0].as_py()], pa.int32()), "shortest": pa.array([made.shortest], pa.int32()), "names": pa.array([names.dictionary.to_pylist()], pa.list_(pa.string()))}
        return pa.table(head | {k: pa.array([v], pa.binary()) for k, v in raw.items()})

    return run


def automata(items: DataFrame, item_id: str, text: str, length: int, spool: Spool) -> tuple[DataFrame, list[list[int]]]:
    """Spooled automata of the blocks, and the blocks of each pass."""
    bare = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    pieces = spool.keep(bare.mapInArrow(_cutting(length), "item string, text string").distinct(), "items")
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)).cast("int"))
    schema = "block int, shortest int, names array<string>, " + ", ".join(f"{name} binary" for name in Automaton.ARRAYS)
    made = spool.keep(dealt.groupBy("block").applyInArrow(_building(length), schema), "automata")
    each = max(1, PASS_BYTES // BLOCK_BYTES)
    return made, [list(range(a, min(a + each, count))) for a in range(0, count, each)]


SPAN = "array<struct<start:long,stop:long>>"
SPANS = f"struct<n_words:long,spans:{SPAN},bytes:{SPAN},items:array<string>>"
_PAIRS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_RESULT = pa.struct([("n_words", pa.int64()), ("spans", _PAIRS), ("bytes", _PAIRS), ("items", pa.list_(pa.string()))])


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", length: int = LENGTH, into: str = "contamination") -> DataFrame:
    """`docs` with a struct column: n_words, covered word spans, the same as byte spans, and the sorted ids of
    the items that occur."""
    spark = docs.sparkSession
    bounded_batches(spark)
    spool = Spool(spark, "decontaminate")
    made, passes = automata(items, item_id, item_text, length, spool)

    def found(blocks: list[int]) -> Column:
        # at most PASS_BYTES of items
        shared = spark.sparkContext.broadcast([(r.shortest, r.names, {k: bytes(r[k]) for k in Automaton.ARRAYS}) for r in made.where(F.col("block").isin(blocks)).collect()])
        return _contaminated(F.col(text), shared, length)

    out = docs.withColumn(into, found(passes[0]))
    if len(passes) == 1:
        return out
    row, past = fresh("row", out), fresh("past", out)
    out = spool.keep(out.withColumn(row, F.monotonically_increasing_id()), "documents")
    more = None
    for blocks in passes[1:]:
        hit = spool.keep(out.select(row, found(blocks).alias(past)).where(F.size(f"{past}.spans") > 0), "hits")
        more = hit if more is None else more.unionByName(hit)
    more = more.groupBy(row).agg(F.collect_list(past).alias(past))  # one of each pass at most
    joined = out.join(more, row, "left")
    return joined.withColumn(into, F.when(F.col(past).isNotNull(), _united(F.col(into), F.col(past))).otherwise(F.col(into))).select(*(c for c in out.columns if c != row))


def _united(first: Column, more: Column) -> Column:
    """Findings of several passes as one: spans that touch grow together."""
    both = F.concat(F.array(first), more)
    pairs = F.array_sort(F.flatten(F.transform(both, lambda x: F.transform(F.arrays_zip(x["spans"].alias("w"), x["bytes"].alias("b")), lambda p: F.struct(p["w"]["start"].alias("ws"), p["w"]["stop"].alias("we"), p["b"]["start"].alias("bs"), p["b"]["stop"].alias("be"))))))

    def fold(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["ws"].alias("ws"), F.greatest(last["we"], x["we"]).alias("we"), last["bs"].alias("bs"), F.greatest(last["be"], x["be"]).alias("be"))
        return F.when((F.size(done) > 0) & (x["ws"] <= last["we"]), F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(done, F.array(x)))

    merged = F.aggregate(pairs, F.slice(pairs, 1, 0), fold)
    pick = lambda a, b: F.transform(merged, lambda x: F.struct(x[a].alias("start"), x[b].alias("stop")))
    names = F.array_sort(F.array_distinct(F.flatten(F.transform(both, lambda x: x["items"]))))
    return F.struct(first["n_words"].alias("n_words"), pick("ws", "we").alias("spans"), pick("bs", "be").alias("bytes"), names.alias("items"))


def _contaminated(text: Column, shared, length: int) -> Column:
    @arrow_udf(SPANS)
    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        blocks = [(names, Automaton.load(length, shortest, raw)) for shortest, names, raw in shared.value]
        for column in batches:
            made = []
            for part in column_pieces(column, 1 << 21):
                data, starts, ends, before = normal_words(part)
                hashes = hash_spans(data, starts, ends)
                edge = np.zeros(len(starts) + 1, np.int64)
                listed: list[set] = [set() for _ in range(len(part))]
                for names, automaton in blocks:
                    first, stop, place, item = automaton.match(hashes, before)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, stop, -1)
                    some = item < len(names)
                    row = np.searchsorted(before, place[some], "right") - 1
                    for r, i in np.unique(np.column_stack([row, item[some]]), axis=0).tolist():
                        listed[r].add(names[i])
                a, b, rows = spans(np.cumsum(edge)[:-1] > 0, before)
                _, offsets = flat(part)
                row, cut = np.searchsorted(before, a, "right") - 1, pa.array(rows, pa.int32())
                pair = lambda x, y: pa.ListArray.from_arrays(cut, pa.StructArray.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["start", "stop"]))  # noqa: B023, E731
                by_byte = pair(starts[a] - offsets[row], ends[b - 1] - offsets[row]) if len(a) else pair(a, b)
                names = pa.array([sorted(x) for x in listed], pa.list_(pa.string()))
                made.append(pa.StructArray.from_arrays([pa.array(np.diff(before), pa.int64()), pair(a - before[row], b - before[row]), by_byte, names], ["n_words", "spans", "bytes", "items"]))
            yield pa.concat_arrays(made) if made else pa.array([], _RESULT)

    return work.asNondeterministic()(text)  # so that no filter on the result makes it run twice


def without_spans(text: Column, cuts: Column) -> Column:
    """The text without the given byte spans, and without the blanks that a cut leaves doubled at its place."""

    @arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans_ in batches:
            out = []
            for t, s in zip(texts.to_pylist(), spans_.to_pylist(), strict=True):
                if t and s:
                    raw, kept, last = t.encode(), [], 0
                    for x in s:
                        kept.append(raw[last : x["start"]])
                        last = x["stop"]
                    kept.append(raw[last:])
                    t = b" ".join(k.strip(b" ") for k in kept).strip(b" ").decode()
                out.append(t)
            yield pa.array(out, pa.string())

    return cut(text, cuts)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", longest: int | None = None, coverage: float = 0.5, **names: str) -> DataFrame:
    """`docs` without what was leaked: covered spans are cut out of the text (those of `longest` words or more, if
    it is given), and documents of which more than `coverage` of the words are covered go. Clean documents stay as
    they are."""
    into = fresh("found", docs)
    found = contamination(docs, items, text, into=into, **names)
    hit = F.aggregate(f"{into}.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    found = found.where(hit <= coverage * F.col(f"{into}.n_words"))
    cuts = F.transform(
        F.filter(F.arrays_zip(F.col(f"{into}.spans").alias("w"), F.col(f"{into}.bytes").alias("b")), lambda x: x["w"]["stop"] - x["w"]["start"] >= F.lit(longest or 1)),
        lambda x: x["b"],
    )
    return found.withColumn(text, F.when(F.size(cuts) > 0, without_spans(F.col(text), cuts)).otherwise(F.col(text))).drop(into)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        F.aggregate("contamination.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("n_hit"),
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ","), 256).alias("items_sha256"),
        (F.size("contamination.spans") > 0).alias("contaminated"),
    )


QUERIES = {"op6_decontaminate": op6_decontaminate}
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words"""
ORACLE = {
    "op6_decontaminate": f"""
with b as (select cast(item_id as varchar) as item, {_WORDS} from benchmark),
i as (select item, words, least(10, len(words)) as size, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as pos from b where len(words) > 0),
m as (select distinct item, size, array_to_string(words[pos:pos + size - 1], ' ') as win from i),
d as (select row_number() over () as rid, doc_id, {_WORDS} from documents),
p as (select d.rid, d.words, z.size, unnest(range(1, len(d.words) - z.size + 2)) as pos from d, (select distinct size from m) z where len(d.words) >= z.size),
h as (select p.rid, p.pos, p.size, m.item from p join m on p.size = m.size and array_to_string(p.words[p.pos:p.pos + p.size - 1], ' ') = m.win),
c as (select rid, count(distinct word) as n_hit from (select rid, unnest(range(pos, pos + size)) as word from h) group by rid),
n as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct rid, item from h where item is not null) group by rid)
select d.doc_id, cast(len(d.words) as bigint) as n_words, cast(coalesce(c.n_hit, 0) as bigint) as n_hit, cast(coalesce(n.n_items, 0) as bigint) as n_items,
       sha256(coalesce(n.items, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from d left join c on d.rid = c.rid left join n on d.rid = n.rid
"""
}
