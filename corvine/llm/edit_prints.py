"""Document fingerprints by a randomised edit embedding, bit-sampled, with banding and verification.

A walker goes over the characters of a text. At each step it writes down where it stands and moves on if a random bit
of (step, character) says so; the bits are shared by all texts. Two texts that differ by few edits soon walk in step
again, so the number of steps at which their walks differ grows with their edit distance: edits become Hamming
distance. The bits repeat after `PERIOD` steps, which only matters to texts that are shifted by exactly so much.

The fingerprint samples the walk at `SLOTS` steps. A slot's step is the one of smallest random rank among the first
2n of a text of n characters (a walk takes about two steps a character), so texts of unlike lengths agree on as many
steps as the ratio of their lengths. A sampled step gives 8 bits of a hash of the three characters up to where the
walker stands; 0 where the text has ended. Unlike texts agree in about one slot of a hundred. The likeness of two
fingerprints is the share of equal slots among those that are not 0 in both, 1 if there are none.

Near-duplicates: fingerprints that differ in at most d slots agree on one whole band of d + 1 at least, so links of the
wanted likeness among distinct fingerprints are found without loss; each is verified by all slots.

Walks are made for all texts of a batch in step, the last long ones character by character: time and memory grow with
the text. Null texts count as empty: all slots 0. Repeated rows are rows of their own. An empty table stays empty.
Other columns are passed on; those named like the result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from ..operators.graph import components
from ._spark import Spool, fresh, table
from ._text import U64, column_pieces, mix, pieces, ragged

SLOTS, PERIOD, CLASSES, SEED = 128, 1 << 14, 256, 17
#: Texts that walk in step; fewer go one by one.
IN_STEP = 48
#: Bytes of text that are fingerprinted together.
PIECE = 4 << 20
LIKENESS = 0.8
#: Distinct fingerprints of a bucket that meet in one group; a larger bucket is dealt anew.
CROWD = 2048


def walk_table(seed: int = SEED) -> np.ndarray:
    """For a class of characters and a step: the steps until the walker has moved on. Classes end to end."""
    words = mix(np.arange(CLASSES * PERIOD // 64, dtype=U64) + (U64(seed) << U64(40)))
    moves = np.unpackbits(words.view(np.uint8)).reshape(CLASSES, PERIOD)
    moves[:, -1] = 1
    step = np.where(moves > 0, np.arange(PERIOD), 2 * PERIOD)
    nearest = np.minimum.accumulate(step[:, ::-1], axis=1)[:, ::-1]
    return np.minimum(nearest - np.arange(PERIOD) + 1, 255).astype(np.uint8).ravel()


def sampled_steps(slots: int = SLOTS, seed: int = SEED, most: int = 1 << 44) -> np.ndarray:
    """For each slot the steps that have the smallest rank up to there, ascending; the one before 2n is sampled."""
    out = np.full((slots, 96), np.iinfo(np.int64).max)
    with np.errstate(over="ignore"):
        chance = (mix(np.arange(slots * 192, dtype=U64) + (U64(seed + 1) << U64(40))) >> U64(11)).astype(float).reshape(slots, 192) / 2.0**53
    for s in range(slots):
        at, least, i = 0, 1.0, 0
        while at < most and i < 96:
            out[s, i] = at
            least *= max(chance[s, 2 * i], 1e-9)
            # the next step whose uniform rank is below `least`
            at += 1 + int(np.log(max(1 - chance[s, 2 * i + 1], 1e-300)) / np.log1p(-min(least, 1 - 1e-12)))
            i += 1
    return out


@dataclass
class Walked:
    """Texts end to end: code points, first place and length of each, the step at which each place is entered, and
    the step after the end."""

    points: np.ndarray
    first: np.ndarray
    length: np.ndarray
    entered: np.ndarray
    left: np.ndarray


class Walker:
    def __init__(self, seed: int = SEED):
        self.table, self.steps = walk_table(seed), sampled_steps(SLOTS, seed)
        self.plain = self.table.tobytes()

    def walk(self, texts: list[str | None], before: Walked | None = None, kept: np.ndarray | None = None) -> Walked:
        """Walks of the texts; the first `kept` characters of each are those of the walks `before`."""
        points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.fromiter((len(t or "") for t in texts), np.int64, len(texts))
        first = np.cumsum(length) - length
        entered = np.empty(len(points), np.int64)
        start, done = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        if before is not None:
            row, place = ragged(kept)
            entered[first[row] + place] = before.entered[before.first[row] + place]
            done = kept
            start = before.left.copy()
            more = np.flatnonzero(kept < before.length)
            start[more] = before.entered[before.first[more] + kept[more]]
        classes = ((points ^ (points >> 8) * np.uint32(0x9D)) & np.uint32(CLASSES - 1)).astype(np.int32) * PERIOD
        left = self._go(classes, first + done, length - done, start, entered)
        return Walked(points, first, length, entered, left)

    def _go(self, classes: np.ndarray, first: np.ndarray, length: np.ndarray, start: np.ndarray, entered: np.ndarray) -> np.ndarray:
        order = np.argsort(-length, kind="stable")
        size, at, step = length[order], first[order], start[order]
        together = int(size[IN_STEP - 1]) if len(size) >= IN_STEP else 0
        live = len(size)
        for i in range(together):
            while size[live - 1] <= i:
                live -= 1
            here, now = at[:live], step[:live]
            entered[here] = now
            now += self.table[classes[here] + (now & (PERIOD - 1))]
            here += 1
        table, last = self.plain, PERIOD - 1
        for k in range(int(np.searchsorted(-size, -together, "left"))):
            now = int(step[k])
            for cut in range(int(first[order[k]]) + together, int(first[order[k]] + size[k]), 1 << 20):
                end, steps = min(cut + (1 << 20), int(first[order[k]] + size[k])), []
                for c in classes[cut:end].tolist():
                    steps.append(now)
                    now += table[c + (now & last)]
                entered[cut:end] = steps
            step[k] = now
        out = np.empty(len(size), np.int64)
        out[order] = step
        return out

    def prints(self, w: Walked) -> np.ndarray:
        """A row of `SLOTS` bytes for each text."""
        out = np.zeros((len(w.length), SLOTS), np.uint8)
        if not len(w.points):
            return out
        stride = np.maximum(w.left, 2 * w.length) + 1
        base = np.cumsum(stride) - stride
        line = w.entered + np.repeat(base, w.length)
        padded = np.append(np.zeros(2, np.uint32), w.points).astype(U64)
        salt = mix(np.arange(SLOTS, dtype=U64))
        for s in range(SLOTS):
            step = self.steps[s][np.maximum(np.searchsorted(self.steps[s], 2 * w.length, "left") - 1, 0)]
            some = np.flatnonzero((w.length > 0) & (step < w.left))
            at = np.searchsorted(line, base[some] + step[some], "right") - 1
            gone = at - w.first[some]
            h = padded[at + 2] | np.where(gone > 0, padded[at + 1], U64(0)) << U64(21) | np.where(gone > 1, padded[at], U64(0)) << U64(42)
            out[some, s] = mix(h ^ salt[s]) % U64(255) + U64(1)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots of rows of fingerprints."""
    told = ((a != 0) | (b != 0)).sum(axis=1)
    return np.where(told > 0, ((a == b) & (a != 0)).sum(axis=1) / np.maximum(told, 1), 1.0)


def edit_print(text: Column | str, seed: int = SEED) -> Column:
    """The fingerprint of a text, as binary."""

    @arrow_udf("binary")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        walker = Walker(seed)
        for batch in batches:
            out: list[bytes] = []
            for piece in column_pieces(batch, PIECE):
                out += [r.tobytes() for r in walker.prints(walker.walk(piece.to_pylist()))]
            yield pa.array(out, pa.binary())

    return fingerprint(text)


# near-duplicates


def bands(fp: Column, apart: int, seed: int = 0) -> Column:
    """An array of (no, key): apart + 1 bands, of which fingerprints that differ in `apart` slots share one at least.
    Another seed cuts the slots into other bands."""
    slots = np.argsort(mix(np.arange(SLOTS, dtype=U64) + (U64(seed + 99) << U64(40))), kind="stable") if seed else np.arange(SLOTS)
    cut = np.array_split(slots, apart + 1)
    key = lambda some: F.xxhash64(F.concat(*[F.substring(fp, int(i) + 1, 1) for i in some]))
    return F.array(*[F.struct(F.lit(i).alias("no"), key(some).alias("key")) for i, some in enumerate(cut)])


def _forest(fps: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among the rows, each tree grown from a seed, in blocks."""
    edges, left = [], np.arange(len(fps))
    while len(left) > 1:
        todo, left = [left[:1]], left[1:]
        while todo and len(left):
            some = todo.pop()
            for one in some.tolist():
                near = likeness(fps[left], np.broadcast_to(fps[one], (len(left), SLOTS))) >= least
                if near.any():
                    edges += [(one, x) for x in left[near].tolist()]
                    todo.append(left[near])
                    left = left[~near]
                    if not len(left):
                        break
    return edges


def _linked(least: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        fps = np.frombuffer(b"".join(rows.column("fp").to_pylist()), np.uint8).reshape(-1, SLOTS)
        node, pairs = rows.column("node").to_numpy(), np.array(_forest(fps, least), np.int64).reshape(-1, 2)
        return pa.table({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]})

    return run


def links(nodes: DataFrame, least: float = LIKENESS, crowd: int = CROWD) -> DataFrame:
    """Spanning edges (a, b) of the buckets of `nodes(node, fp)`, distinct fingerprints. A bucket of more than `crowd`
    is dealt anew by other bands, under which every pair of the likeness meets again."""
    spool = Spool(nodes.sparkSession, "edit-links")
    apart = int((1 - least) * SLOTS + 1e-9)
    keyed = nodes.select("node", "fp", F.inline(bands(F.col("fp"), apart)))
    size = keyed.groupBy("no", "key").agg(F.count("*").alias("n")).where("n > 1")
    # buckets of one fingerprint have no links: only the others' rows carry fingerprints through a shuffle
    met = keyed.select("node", "no", "key").join(spool.keep(size, "buckets"), ["no", "key"]).join(nodes, "node")
    one = F.array(F.struct(F.lit(-1).alias("no"), F.lit(0).cast("long").alias("key")))
    finer = met.select("no", "key", "node", "fp", F.explode(F.when(F.col("n") > crowd, bands(F.col("fp"), apart, 1)).otherwise(one)).alias("t"))
    finer = finer.select("no", "key", F.col("t.no").alias("no2"), F.col("t.key").alias("key2"), "node", "fp")
    return finer.groupBy("no", "key", "no2", "key2").applyInArrow(_linked(least), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: float = LIKENESS, seed: int = SEED) -> DataFrame:
    """`docs` without the text, with its fingerprint (binary) and component_id: the smallest doc_id that links of the
    likeness `least` or more lead to."""
    spark = docs.sparkSession
    spool = Spool(spark, "edit-prints")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in ("fingerprint", "component_id")]
    prints = spool.keep(docs.select(*rest, edit_print(F.col(f"`{text}`"), seed).alias("fingerprint")), "prints")
    nodes = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(f"`{doc_id}`").alias("least"))
    nodes = spool.keep(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = components(links(nodes.select("node", "fp"), least), spool).withColumnRenamed("node", "of")
    labelled = nodes.join(roots, nodes.node == roots.of, "left").select("fp", F.coalesce("root", "node").alias("root"), "least")
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    fp = fresh("fp", prints)
    known = labelled.join(smallest, "root").select(F.col("fp").alias(fp), "component_id")
    return prints.join(known, prints.fingerprint == known[fp], "left").drop(fp)


# each text beside an edited one and the next


def edited(text: str, following: str) -> str:
    """The text whose last third is replaced by as much of the following text's beginning."""
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


class Comparer:
    """Fingerprints of texts, of their edited texts and of the texts that follow."""

    def __init__(self, seed: int = SEED):
        self.walker = Walker(seed)

    def rows(self, ids: list, texts: list[str]) -> list[tuple]:
        """A row for each text but the last, which only follows."""
        w = self.walker.walk(texts)
        own = self.walker.prints(w)
        mine, new = texts[:-1], [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        length = w.length[:-1]
        other = self.walker.prints(self.walker.walk(new, _but_last(w), length - length // 3))
        near, following = likeness(own[:-1], other), likeness(own[:-1], own[1:])
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in new]
        return [(i, len(t), s, a.tobytes().hex(), b.tobytes().hex(), x, y) for i, t, s, a, b, x, y in zip(ids, mine, sha, own, other, near.tolist(), following.tolist(), strict=False)]


def _but_last(w: Walked) -> Walked:
    """The walks but the last."""
    return Walked(w.points, w.first[:-1], w.length[:-1], w.entered, w.left[:-1])


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _batch(rows: list[tuple], more: dict[str, pa.Array]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(TYPES)]
    return pa.RecordBatch.from_arrays([*columns, *more.values()], [*RESULT, *more])


def _in_order(seed: int):
    """Sorted rows of one range. Its last row, whose successor is elsewhere, and its first text are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparer, part = Comparer(seed), TaskContext.get().partitionId()
        ids: list = []
        texts: list[str] = []

        def out(rows: list[tuple], kind: int, text: str | None) -> pa.RecordBatch:
            n = len(rows)
            return _batch(rows, {"part": pa.array([part] * n, pa.int32()), "kind": pa.array([kind] * n, pa.int32()), "text": pa.array([text] * n, pa.string())})

        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                if not texts and piece.num_rows:
                    yield out([(None,) * 7], 2, piece.column("text")[0].as_py() or "")
                ids += piece.column("doc_id").to_pylist()
                texts += [t or "" for t in piece.column("text").to_pylist()]
                if len(texts) > 1:
                    yield out(comparer.rows(ids, texts), 0, None)
                    ids, texts = ids[-1:], texts[-1:]
        if texts:
            yield out([(ids[0], *(None,) * 6)], 1, texts[0])

    return run


def _across(seed: int):
    """Last rows of ranges with the first text of the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparer = Comparer(seed)
        for batch in batches:
            rows = [r for i, a, b in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True) for r in comparer.rows([i], [a, b])]
            yield _batch(rows, {})

    return run


def beside_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to both that and the next document's, by
    descending doc_id (null ids last, texts of one id by their hash); after the last comes the first. Texts are
    shuffled once, by ranges, which also split equal ids; of each range two texts are passed on."""
    spark = docs.sparkSession
    spool = Spool(spark, "beside-next")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(f"`{text}`", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    held = spool.keep(ranged.mapInArrow(_in_order(seed), f"{SCHEMA}, part int, kind int, text string"), "ranges")
    heads = held.where("kind = 2").select("part", F.col("text").alias("following"))
    # as many rows as there are ranges
    w = Window.orderBy("part")
    after = heads.select(F.col("part").alias("before"), F.coalesce(F.lead("part").over(w), F.min("part").over(w)).alias("part"))
    last = held.where("kind = 1").select("doc_id", "text", F.col("part").alias("before"))
    across = last.join(after, "before").join(heads, "part").select("doc_id", "text", "following")
    return held.where("kind = 0").select(*RESULT).union(across.mapInArrow(_across(seed), SCHEMA))


def op13_edit_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return beside_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op13_edit_prints": op13_edit_prints}
ORACLE: dict[str, str] = {}
