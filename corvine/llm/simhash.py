"""SimHash near-duplicates by covering locality-sensitive hashing.

Every document gets a 64-bit SimHash of its word shingles. Each bit position draws a vector of radius + 1 bits;
for every non-zero vector v there is a table whose mask holds the positions with odd inner product. At most
`radius` differing positions always leave some v orthogonal to all of them, so a pair within the radius agrees
on the whole mask of some table: no pair is missed. Distinct fingerprints are the nodes; in each bucket links
are checked by their differing bits and only a spanning forest of them is kept, so a bucket of n fingerprints
yields fewer than n edges. Equal fingerprints are one node from the start.

Nulls and texts without words have fingerprint zero and are linked like any other. A null doc_id takes part; a
component's id is its smallest non-null doc_id. Repeated rows stay rows of their own, repeated ids too; an empty
table has no components; other columns are passed on whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..operators.graph import components, labels
from . import similar
from ._spark import Spool, fresh, table
from ._text import LOWER, SPACE, column_pieces, flat, words, xxh64_spans

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a bucket that meet in one group; a larger bucket is dealt anew.
CROWD = 2048
#: Crowded buckets (some 20 bytes each) that are broadcast; more of them are joined by a shuffle.
MOST_CROWDS = 100_000

#: For each byte value, a 64-bit integer whose eight bytes are its bits.
_BYTE_BITS = np.array([sum((v >> i & 1) << (8 * i) for i in range(8)) for v in range(256)], np.uint64)


def shingle_hashes(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """XXH64 of all shingles of the texts, behind one another, the text of each, and how many each text has."""
    data, offsets = flat(column)
    data = LOWER[data]
    starts, ends, before = words(data, offsets)
    n_words = np.diff(before)
    # words joined by one blank: each word's bytes and a blank behind it
    keep = ~SPACE[data]
    gap = ends[ends < len(data)]
    gap = gap[SPACE[data[gap]]]
    keep[gap] = True
    data[gap] = 0x20
    place = np.cumsum(keep) - keep
    joined = data[keep]
    starts, ends = place[starts], place[ends - 1] + 1 if len(ends) else ends
    shingles = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    first = np.cumsum(shingles) - shingles
    row = np.repeat(np.arange(len(n_words)), shingles)
    a = before[row] + np.arange(len(row)) - first[row]
    b = a + np.minimum(size, n_words[row]) - 1
    return xxh64_spans(joined, starts[a], ends[b], SEED) if len(a) else np.zeros(0, np.uint64), row, shingles


def fingerprints(column: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """SimHash of each text: bit set where over half of the shingles' XXH64 have it."""
    h, row, shingles = shingle_hashes(column, size)
    # bit counts: eight packed byte counters per byte of h, summed over at most 255 shingles at a time
    out = np.zeros(len(shingles), np.uint64)
    if not len(h):
        return out
    cut = np.arange(len(row)) - (np.cumsum(shingles) - shingles)[row]
    block = np.flatnonzero(cut % 255 == 0)
    owner = row[block]
    new = np.flatnonzero(np.append(True, np.diff(owner) != 0))
    raw = h.view(np.uint8).reshape(-1, 8)
    rows = owner[new]
    half = shingles[rows]
    for byte in range(8):
        packed = np.add.reduceat(_BYTE_BITS[raw[:, byte]], block)
        count = np.add.reduceat(packed.view(np.uint8).reshape(-1, 8).astype(np.int64), new, axis=0)
        set_ = count * 2 > half[:, None]
        out[rows] |= np.packbits(set_, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * byte)
    return out


def simhash(text: Column | str, size: int = SHINGLE) -> Column:
    """The fingerprint as a signed long with the same bits."""

    @arrow_udf("long")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            some = [fingerprints(p, size) for p in column_pieces(batch, 1 << 21)]
            yield pa.array(np.concatenate(some).view(np.int64) if some else [], pa.int64())

    return fingerprint(text)


def covering_masks(radius: int, bits: int = 64, seed: int = 7) -> list[int]:
    """2^(radius+1) - 1 masks such that any `radius` positions are all outside at least one of them.

    The vectors are dealt evenly over the positions so that all masks are about as large.
    """
    vectors = list(range(1 << (radius + 1))) * (bits >> (radius + 1) or 1)
    vectors += [x % (1 << (radius + 1)) for x in range(bits - len(vectors))]
    random.Random(seed).shuffle(vectors)
    return [sum(((v & vectors[i]).bit_count() & 1) << i for i in range(bits)) for v in range(1, 1 << (radius + 1))]


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints, in blocks of bounded memory.

    Grows each tree from a seed: a reached fingerprint is compared with those not yet reached only.
    """
    edges: list[tuple[int, int]] = []
    left = fps
    while len(left) > 1:
        todo, left = [left[:1]], left[1:]
        while todo and len(left):
            some = todo.pop()
            step = max(1, (1 << 22) // len(left))
            for at in range(0, len(some), step):
                part = some[at : at + step]
                near = np.bitwise_count(part[:, None] ^ left[None, :]) <= radius
                hit = near.any(axis=0)
                if hit.any():
                    to = left[hit]
                    edges += zip(part[near[:, hit].argmax(axis=0)].tolist(), to.tolist(), strict=True)
                    todo.append(to)
                    left = left[~hit]
                    if not len(left):
                        break
                    step = max(1, (1 << 22) // len(left))
    return edges


def _bucket_edges(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket, the columns before the fingerprint; a bucket may go on in the next batch."""
        kept: list[np.ndarray] = []

        def emit(both: np.ndarray) -> pa.RecordBatch:
            fp = both[-1].copy().view(np.uint64)
            at = np.append(np.flatnonzero(np.append(True, (np.diff(both[:-1]) != 0).any(axis=0))), len(fp))
            size = np.diff(at)
            a, b = [], []
            two = at[:-1][size == 2]
            near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius
            a.append(fp[two][near])
            b.append(fp[two + 1][near])
            for i in np.flatnonzero(size > 2).tolist():
                if pairs := forest(fp[at[i] : at[i + 1]], radius):
                    x, y = np.array(pairs, np.uint64).T
                    a.append(x)
                    b.append(y)
            a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            last = kept[-1][:-1, -1:]
            if (kept[0][:-1, :1] == last).all():
                continue  # all of one bucket so far
            both = np.concatenate(kept, axis=1)
            tail = np.flatnonzero((both[:-1] != last).any(axis=0))[-1] + 1
            yield emit(both[:, :tail])
            kept = [both[:, tail:]]
        if kept:
            yield emit(np.concatenate(kept, axis=1))

    return run


def links(nodes: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Spanning edges (a, b) of the buckets of distinct fingerprints `nodes(fp)`; together they connect exactly
    the fingerprints that chains of links connect. A bucket of more than `crowd` fingerprints is dealt anew by
    masks of another seed, under which every pair within the radius meets again."""

    def dealt(seed: int) -> Column:
        signed = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius, seed=seed)]
        return F.array(*[F.struct(F.lit(i).alias("no"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])

    keyed = nodes.select("fp", F.explode(dealt(7)).alias("t")).select("t.no", "t.key", "fp")
    crowded = keyed.groupBy("no", "key").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("no", "key", F.lit(True).alias("crowded"))
    crowded = Spool(nodes.sparkSession, "links").keep(crowded, "crowded")
    if crowded.count() <= MOST_CROWDS:  # a checked bound: then no row moves to learn whether its bucket is crowded
        crowded = F.broadcast(crowded)
    once = F.array(F.struct(F.lit(-1).alias("no"), F.lit(0).cast("long").alias("key")))
    finer = keyed.join(crowded, ["no", "key"], "left").select("no", "key", "fp", F.explode(F.when(F.col("crowded"), dealt(8)).otherwise(once)).alias("t"))
    finer = finer.select("no", "key", F.col("t.no").alias("no2"), F.col("t.key").alias("key2"), "fp")
    order = ("no", "key", "no2", "key2")
    return finer.repartition(*order).sortWithinPartitions(*order).mapInArrow(_bucket_edges(radius), "a long, b long")


def _components(prints: DataFrame, doc_id: str, fp: str, radius: int, spool: Spool) -> DataFrame:
    """(fp, root, least) of each distinct fingerprint: its component and its smallest non-null id."""
    least = spool.keep(prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("least")), "nodes")
    roots = components(links(least.select("fp"), radius), spool)
    return least.join(roots, least.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """`docs` without the text, with fingerprint (long) and component_id. Columns of those names are replaced."""
    spool = Spool(docs.sparkSession, "simhash")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in ("fingerprint", "component_id")]
    prints = spool.keep(docs.select(*rest, simhash(F.col(text), size).alias("fingerprint")), "prints")
    labelled = _components(prints, doc_id, "fingerprint", radius, spool)
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    fp = fresh("fp", prints)
    known = labelled.join(smallest, "root").select(F.col("fp").alias(fp), "component_id")
    return prints.join(known, prints.fingerprint == known[fp], "left").drop(fp)


def _kept(of_node: DataFrame, roots: DataFrame, node: str, row: str) -> DataFrame:
    return of_node.join(roots, node).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, size: int = SHINGLE, least: float | None = None) -> DataFrame:
    """One row of each component: that with the smallest doc_id, null ids last. Rows that share the id too, by
    repetition or because different texts have one id, leave one of them. `docs` is spooled with its fingerprints,
    so that rows are told apart by a number that stays. With `least`, texts whose sets of shingles have that Jaccard
    similarity or more are linked as well, of which a fingerprint's radius catches few below 0.95 (see `similar`)."""
    spool = Spool(docs.sparkSession, "dedup")
    fp, row, sets = fresh("fp", docs), fresh("row", docs), fresh("sets", docs)
    made = {fp: simhash(F.col(f"`{text}`"), size), row: F.monotonically_increasing_id()}
    if least is not None:
        made[sets] = similar.signature(f"`{text}`", size)
    rows = spool.keep(docs.withColumns(made), "rows")
    first = F.min(F.struct(F.col(f"`{doc_id}`").isNull().alias("nameless"), F.col(f"`{doc_id}`").alias("id"), F.col(row).alias("row")))
    if least is None:
        of_print = spool.keep(rows.groupBy(F.col(fp).alias("fp")).agg(first.alias("first"), F.min(f"`{doc_id}`").alias("least")), "prints")
        labelled = _components(of_print.select("fp", "least"), "least", "fp", radius, spool).select("fp", "root")
        kept = _kept(of_print, labelled, "fp", row)
    else:
        nodes = rows.groupBy(F.col(fp).alias("fp"), F.col(f"{sets}.digest").alias("digest")).agg(first.alias("first"), F.min(row).alias("sample"), F.min(f"{sets}.keys").alias("keys"))
        nodes = spool.keep(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        # a node speaks for its fingerprint, and the others of that fingerprint hang on it
        speaks = spool.keep(nodes.groupBy("fp").agg(F.min("node").alias("node")), "speaks")
        near = links(speaks.select("fp"), radius)
        name = lambda c: speaks.select(F.col("fp").alias(c), F.col("node").alias(f"n{c}"))
        edges = near.join(name("a"), "a").join(name("b"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
        hung = nodes.select("fp", F.col("node").alias("a")).join(speaks.select("fp", F.col("node").alias("b")), "fp").select("a", "b")
        alike = similar.links(nodes.select("node", "sample", "keys"), rows.select(F.col(row).alias("sample"), F.col(f"`{text}`").alias("text")), least, size, spool)
        roots = labels(nodes.select("node"), edges.union(hung).union(alike), spool)
        kept = _kept(nodes.select("node", "first"), roots, "node", row)
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash": op2_simhash}
ORACLE: dict[str, str] = {}
