"""Exact top-k inner products by best-first search in M-trees.

Vectors become integers floor(scale * x). Inner products turn into distances by one more coordinate that gives
all rows of a block the same norm: |q - x|^2 = |q|^2 + M^2 - 2 <q, x>. Rows are dealt into blocks by their nearest
pivot, large groups into several blocks; each block is one M-tree of paged nodes whose entries keep a pivot, a
covering radius and the distance to the parent's pivot. It is built once and spooled.

A batch of queries goes through a tree together: pages are taken in the order of the batch's lowest bound, and a
query takes part in a page only while its own bound allows. Entries whose stored distances already show, by the
triangle inequality, that no query of the batch can gain are passed over without a computation; the others of a
page are one matrix product. Scores are exact integers, and bounds give way for rounding, so ties are kept.

Queries are the rows whose id is divisible by `every`, against all rows. Each first searches the block of its
nearest pivot; the k-th score found there then decides, by the blocks' pivots and radii, which other blocks it
meets. Blocks answer with k rows a query at most, which meet in one group a query. Where vectors do not cluster
every block is met: the work is queries times rows.

Vectors that are null or hold null or non-finite components, and rows with a null id, take no part. Inner products
are of vectors of equal length: a query meets the candidates of its own length, empty ones score 0. Repeated rows
are candidates of their own, except that a query never meets rows with its own id; several different vectors
under one query id give one answer, the best of all. Components so large that an inner product might not fit 64
bits are refused with an error. Other columns do not matter; an empty table has no answers.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._spark import Spool, table

SCALE, K, EVERY = 64, 20, 20
#: Rows of a block, and entries of a page.
BLOCK, PAGE = 8192, 128
#: Blocks that a table has at least, and pivots that are broadcast at most (more rows a pivot beyond that).
LEAST_BLOCKS, MOST_PIVOTS = 16, 4096
#: Queries that meet a block at once, and distances that a worker computes at once when it routes.
QUERY_ROWS, CELLS = 4096, 1 << 22


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * (points @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


class MTree:
    """A bulk-loaded M-tree over integer points; leaves hold rows, inner pages hold children."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, seed: int = 11):
        self.ids, self.vectors = ids, vectors.astype(float)
        norms = (self.vectors**2).sum(axis=1)
        self.most = float(norms.max(initial=0))
        self.points = np.column_stack([self.vectors, np.sqrt(self.most - norms)])
        self.pages: list[tuple] = []  # (rows or children, distances to the parent's pivot, pivots, radii); leaves have no pivots
        self.rng, self.page = np.random.default_rng(seed), page
        self.pivot = self.points.mean(axis=0)
        self.root = self._build(np.arange(len(ids)), self.pivot)
        self.radius = float(_distances(self.points, self.pivot[None])[:, 0].max())
        self.computed = 0  # inner products of queries and rows

    def _build(self, rows: np.ndarray, pivot: np.ndarray) -> int:
        if len(rows) <= self.page:
            far = _distances(self.points[rows], pivot[None])[:, 0]
            order = np.argsort(far, kind="stable")
            self.pages.append((rows[order], far[order], None, None))
            return len(self.pages) - 1
        fan = min(self.page // 4, -(-len(rows) // (self.page // 2)))
        own, centers = self._split(rows, fan)
        children, pivots, radii = [], [], []
        for c in range(fan):
            some = rows[own == c]
            if len(some):
                children.append(self._build(some, centers[c]))
                pivots.append(centers[c])
                radii.append(_distances(self.points[some], centers[c][None])[:, 0].max())
        pivots = np.array(pivots)
        self.pages.append((np.array(children), _distances(pivots, pivot[None])[:, 0], pivots, np.array(radii)))
        return len(self.pages) - 1

    def _split(self, rows: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows by their nearest of `fan` centers, after three rounds of means; copies of one point are cut evenly."""
        points = self.points[rows]
        centers = points[self.rng.choice(len(rows), fan, replace=False)]
        for last in (False, False, False, True):
            own = np.empty(len(rows), np.int64)
            norm = (centers**2).sum(axis=1)
            for at in range(0, len(rows), 65536):
                own[at : at + 65536] = (norm - 2 * points[at : at + 65536] @ centers.T).argmin(axis=1)
            if not last:
                order = np.argsort(own, kind="stable")
                full, first = np.unique(own[order], return_index=True)
                centers[full] = np.add.reduceat(points[order], first) / np.diff(np.append(first, len(rows)))[:, None]
        if len(full) == 1:
            own = np.arange(len(rows)) * fan // len(rows)
            centers[:] = centers[full]
        return own, centers

    def dump(self) -> bytes:
        out = io.BytesIO()
        flat = {f"{i}-{j}": x for i, p in enumerate(self.pages) for j, x in enumerate(p) if x is not None}
        np.savez(out, ids=self.ids, vectors=self.vectors, points=self.points, pivot=self.pivot, head=np.array([self.most, self.radius, self.root, len(self.pages)]), **flat)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> MTree:
        tree, got = cls.__new__(cls), np.load(io.BytesIO(raw))
        tree.ids, tree.vectors, tree.points, tree.pivot = (got[x] for x in ("ids", "vectors", "points", "pivot"))
        tree.most, tree.radius, tree.root, n = float(got["head"][0]), float(got["head"][1]), int(got["head"][2]), int(got["head"][3])
        tree.pages = [tuple(got[f"{i}-{j}"] if f"{i}-{j}" in got else None for j in range(4)) for i in range(n)]
        tree.computed = 0
        return tree

    def search(self, asked: np.ndarray, wanted: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's number, row, score) of each query's k best rows, of those that score `least` or more.

        A distance d stands for the score (|q|^2 + most - d^2) / 2.
        """
        queries = wanted.astype(float)
        norms = (queries**2).sum(axis=1)
        points = np.column_stack([queries, np.zeros(len(queries))])
        total = norms + self.most
        slack = np.sqrt(1e-12 * (1 + 4 * total))  # covers the rounding of a distance
        none = np.iinfo(np.int64).min
        kth = np.full(len(queries), none) if least is None else least.copy()
        top_score, top_row = np.full((len(queries), k), none), np.full((len(queries), k), -1)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def reach_of(q: np.ndarray) -> np.ndarray:
            return np.where(kth[q] == none, np.inf, np.sqrt(np.maximum(total[q] - 2.0 * kth[q], 0))) + 2 * slack[q]

        reach = reach_of(np.arange(len(queries)))

        def merge() -> None:
            """Folds what was found into the best k, ties to the smaller id."""
            q, row, score = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            some = np.unique(q)
            had = top_row[some] >= 0
            q = np.concatenate([q, np.repeat(some, k)[had.ravel()]])
            row, score = np.concatenate([row, top_row[some][had]]), np.concatenate([score, top_score[some][had]])
            order = np.lexsort((self.ids[row], -score, q))
            q, row, score = q[order], row[order], score[order]
            first = np.flatnonzero(np.append(True, np.diff(q) != 0))
            nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
            good = nth < k
            top_score[some], top_row[some] = none, -1
            top_score[q[good], nth[good]], top_row[q[good], nth[good]] = score[good], row[good]
            kth[some] = np.maximum(kth[some], top_score[some, k - 1])
            reach[some] = reach_of(some)

        every = np.arange(len(queries))
        start = _distances(points, self.pivot[None])[:, 0]
        heap: list[tuple] = [(0.0, 0, self.root, every, start, np.zeros(len(queries)))]
        pushed = waiting = 0
        while heap:
            _, _, number, q, to_pivot, bound = heapq.heappop(heap)
            live = bound <= reach[q]
            if not live.any():
                continue
            q, to_pivot, bound = q[live], to_pivot[live], bound[live]
            entries, far, pivots, radii = self.pages[number]
            near = np.abs(to_pivot[:, None] - far) - (0 if pivots is None else radii) <= reach[q][:, None]
            some = np.flatnonzero(near.any(axis=0))
            if not len(some):
                continue
            if pivots is None:
                rows = entries[some]
                score = np.rint(queries[q] @ self.vectors[rows].T).astype(np.int64) if self.most * norms.max() < 2.0**104 else wanted[q] @ self.vectors[rows].T.astype(np.int64)
                self.computed += score.size
                good = (score >= kth[q][:, None]) & (self.ids[rows] != asked[q][:, None])
                a, b = np.nonzero(good)
                held.append((q[a], rows[b], score[a, b]))
                waiting += len(a)
                if waiting >= 2 * k * len(queries) or (waiting and (kth[q] == none).any()):
                    merge()
                    waiting = 0
            else:
                d = _distances(points[q], pivots[some])
                low = np.maximum(d - radii[some] - slack[q][:, None], bound[:, None])
                go = near[:, some] & (low <= reach[q][:, None])
                for j in np.flatnonzero(go.any(axis=0)).tolist():
                    x = go[:, j]
                    pushed += 1
                    heapq.heappush(heap, (float(low[x, j].min()), pushed, int(entries[some[j]]), q[x], d[x, j], low[x, j]))
        if held:
            merge()
        q, nth = np.nonzero(top_row >= 0)
        return q, top_row[q, nth], top_score[q, nth]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _steps(dims: np.ndarray, wide: dict[int, int]) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of one length, so many at once that `CELLS` distances to the pivots or blocks of that length hold them."""
    for dim in np.unique(dims).tolist():
        some = np.flatnonzero(dims == dim)
        each = max(1, CELLS // max(1, wide[dim]))
        for at in range(0, len(some), each):
            yield dim, some[at : at + each]


def _dealt(shared):
    """Rows to their nearest pivot; the number counts pivots over all lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            own = np.zeros(len(dims), np.int32)
            for dim, some in _steps(dims, {d: len(x[1]) for d, x in pivots.items()}):
                first, centers = pivots[dim]
                points = _matrix(batch.column("v").take(pa.array(some)), dim).astype(float)
                own[some] = first + ((centers**2).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "pivot"])

    return run


def _planting(key: tuple, rows: pa.Table) -> pa.Table:
    dim = rows.column("dim")[0].as_py()
    vectors = _matrix(rows.column("v"), dim)
    if (most := np.abs(vectors).max(initial=0)) and dim * float(most) ** 2 >= 2.0**62:
        raise ValueError("components are too large for exact 64-bit inner products")
    tree = MTree(rows.column("vec_id").to_numpy(), vectors)
    raw = pa.array([tree.dump()], pa.binary())
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([dim], pa.int32()), "rows": pa.array([len(vectors)], pa.int64()), "center": pa.array([tree.pivot.tolist()], pa.list_(pa.float64())), "radius": [tree.radius], "most": [tree.most], "tree": raw})


def _routed(shared, at_home: bool):
    """Queries to the blocks they must meet: the nearest one of their pivot, or all others within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = shared.value
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            if not at_home:
                least, met = batch.column("least").to_numpy(zero_copy_only=False), batch.column("block").to_numpy()
            row, to = [], []
            for dim, some in _steps(dims, {d: len(x[0]) for d, x in router.items()}):
                blocks, of_pivot, centers, radii, most = router[dim]
                points = _matrix(batch.column("v").take(pa.array(some)), dim).astype(float)
                total = (points**2).sum(axis=1)[:, None] + most
                low = _distances(np.column_stack([points, np.zeros(len(points))]), centers) - radii - np.sqrt(1e-12 * (1 + 4 * total))
                if at_home:
                    own = of_pivot == batch.column("pivot").to_numpy()[some][:, None]
                    a, b = np.arange(len(some)), np.where(own, low, np.inf).argmin(axis=1)
                else:
                    score = least[some]
                    known = ~np.isnan(score)[:, None]
                    reach = np.sqrt(np.maximum(total - 2 * np.where(known, score[:, None], 0), 0)) + 2 * np.sqrt(1e-12 * (1 + 4 * total))
                    go = ~known | (low <= reach)
                    go &= blocks != met[some][:, None]
                    a, b = np.nonzero(go)
                row.append(some[a])
                to.append(blocks[b])
            row, to = np.concatenate(row or [np.zeros(0, np.int64)]), np.concatenate(to or [np.zeros(0)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(row)).columns, pa.array(to)], [*batch.schema.names, "block" if at_home else "to"])

    return run


def _searching(k: int):
    def run(_: tuple, trees: pa.Table, queries: pa.Table) -> pa.Table:
        if not trees.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        tree = MTree.load(trees.column("tree")[0].as_py())
        asked = queries.column("vec_id").to_numpy()
        wanted = _matrix(queries.column("v"), queries.column("dim")[0].as_py())
        least = queries.column("least").fill_null(np.iinfo(np.int64).min).to_numpy()
        q, row, score = tree.search(asked, wanted, k, least)
        return pa.table({"query_id": asked[q], "vec_id": tree.ids[row], "score": score})

    return run


FOUND = "query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best candidates, ties to the smaller id."""
    spark = vectors.sparkSession
    sc, spool = spark.sparkContext, Spool(spark, "topk")
    whole = F.col(embedding).isNotNull() & F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    ints = F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    rows = vectors.where(F.col(vec_id).isNotNull() & whole).select(F.col(vec_id).cast("long").alias("vec_id"), ints.alias("v"), F.size(embedding).alias("dim"), F.monotonically_increasing_id().alias("row"))
    rows = spool.keep(rows, "vectors")
    sizes = {r.dim: r.n for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # pivots: for each length the rows of smallest hash, out of a share that surely holds enough
    number = {d: max(1, min(MOST_PIVOTS, n // 64, max(LEAST_BLOCKS, -(-n // block)))) for d, n in sizes.items()}
    share = max(1, sum(sizes.values()) // (64 * sum(number.values())))
    some = rows.where(F.pmod(F.xxhash64("row"), F.lit(share)) == 0) if len(sizes) == 1 else rows
    nth = Window.partitionBy("dim").orderBy(F.xxhash64("row"), "row")
    drawn = some.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= max(number.values())).select("dim", "nth", "v").collect()
    pivots, first = {}, 0
    for dim in sorted(sizes):
        chosen = [r.v for r in drawn if r.dim == dim and r.nth <= number[dim]]
        centers = np.array(chosen, float).reshape(len(chosen), dim)
        pivots[dim] = (first, centers)
        first += len(centers)
    near = spool.keep(rows.mapInArrow(_dealt(sc.broadcast(pivots)), "vec_id long, v array<long>, dim int, row long, pivot int"), "dealt")
    # blocks: a pivot with many rows has several
    load = {r.pivot: r.n for r in near.groupBy("pivot").agg(F.count("*").alias("n")).collect()}
    cut = {p: -(-n // block) for p, n in load.items()}
    base, at = {}, 0
    for p in sorted(cut):
        base[p], at = at, at + cut[p]
    deal = spark.createDataFrame([(p, base[p], cut[p]) for p in sorted(cut)], "pivot int, base int, cut int")
    # at most MOST_PIVOTS rows for each length of vectors
    data = near.join(F.broadcast(deal), "pivot").withColumn("block", (F.col("base") + F.pmod(F.xxhash64("row"), F.col("cut"))).cast("int"))
    planted = data.select("block", "dim", "vec_id", "v").groupBy("block").applyInArrow(_planting, "block int, dim int, rows long, center array<double>, radius double, most double, tree binary")
    trees = spool.keep(planted, "trees")
    # the router: a pivot a block
    of_block = np.concatenate([np.full(cut[p], p) for p in sorted(cut)])
    router: dict[int, list] = {}
    for r in trees.select("block", "dim", "center", "radius", "most").collect():
        router.setdefault(r.dim, []).append(r)
    shared = sc.broadcast({d: (np.array([r.block for r in x]), of_block[[r.block for r in x]], np.array([r.center for r in x]), np.array([r.radius for r in x]), np.array([r.most for r in x])) for d, x in router.items()})
    # queries: each goes to its home block first
    asked = near.where(F.col("vec_id") % every == 0).groupBy("vec_id", "dim", "v").agg(F.min("pivot").alias("pivot"))
    asked = asked.select("vec_id", "v", "dim", "pivot")
    schema = "vec_id long, v array<long>, dim int, pivot int, block int"

    def answers(sent: DataFrame) -> DataFrame:
        """What blocks answer; the queries of a block are cut into parts of bounded size, each with the block's tree.
        A tree goes only to parts that have queries."""
        met = sent.groupBy("block").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
        part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")).cast("int")
        cut = sent.join(met, "block").withColumn("part", part).drop("parts")
        each = trees.select("block", "tree").join(met, "block").select("block", "tree", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        return each.groupBy("block", "part").cogroup(cut.groupBy("block", "part")).applyInArrow(_searching(k), FOUND)

    home = spool.keep(asked.mapInArrow(_routed(shared, True), schema), "asked")
    at_home = spool.keep(answers(home.withColumn("least", F.lit(None).cast("long"))), "home")
    kth = at_home.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    seeded = home.join(kth, "vec_id", "left").select("vec_id", "v", "dim", "pivot", "block", F.col("least").cast("double").alias("least"))
    away = seeded.mapInArrow(_routed(shared, False), f"{schema}, least double, to int")
    away = spool.keep(away.select("vec_id", "v", "dim", F.col("least").cast("long").alias("least"), F.col("to").alias("block")), "away")
    found = at_home.union(answers(away))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ORACLE = {
    "op10_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id as vec_id, cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) as bigint) as score
  from (select distinct * from v where vec_id % 20 = 0) q join v c on len(q.v) = len(c.v) and q.vec_id <> c.vec_id
),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""
}
QUERIES = {"op10_topk": op10_topk}
