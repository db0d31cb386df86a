"""Exact k-means on integer vectors, clusters as balls.

Vectors become integers floor(scale * x), and every distance, mean and comparison below is an exact integer, so the
result equals that of the plain algorithm. After its members are assigned a cluster is a ball: centroid and radius.
For the next round the driver, which holds the k centroids only, bounds each ball's new radius by the old one plus
the centroid's move and finds the neighbour centroids, those nearer than twice that radius, sorted by distance. A
member nearer to its centroid than half the way to the nearest neighbour is in the stable core and stays without a
comparison; the annulus in which another member lies tells how many of the nearest neighbours it is compared with.
Members of a ball that did not move, with neighbours that did not move either, are not looked at.

The table is read once a round: tasks give sums, counts and largest distances a cluster, which fold by a shuffle of
at most k rows a task. A row's cluster is a function of the centroids of all rounds so far; tasks replay the rounds
since the table was last spooled (`REPLAY` at most), so vectors are rewritten once in so many rounds. Nothing of a
vector's size but the k centroids reaches the driver or is broadcast.

Vectors that are null, hold null or non-finite components or have another length than `dim` take no part. The first
centroids are the vectors whose ids have the smallest sha256 (null ids last; rows with one id by their vectors), fewer
than k if there are fewer vectors; ties of distances go to the smaller number; empty clusters keep their centroid.
Repeated rows count each. An empty table stays empty. Other columns are passed on, those named like the result are
replaced. Components of 2^26 and more after scaling are refused with an error, as distances might not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import Spool, fresh, table

SCALE, DIM, K, ROUNDS, SEED = 256, 64, 40, 5, 2
#: Rounds that are replayed on reading before the table is spooled with its clusters.
REPLAY = 4
MOST = 1 << 26


@dataclass
class Balls:
    """The centroids of a round, and for each the neighbours that its members may move to."""

    centers: np.ndarray  # k x dim, integers
    near: list[np.ndarray] | None = None  # numbers of the neighbours, nearest first; None: all, nothing is assigned yet
    gaps: list[np.ndarray] | None = None  # squared distances to them
    still: np.ndarray | None = None  # balls whose members keep cluster and distance


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a and b; in doubles where all sums are below 2^53, else in longs."""
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0), 1)
    if 4 * a.shape[1] * float(most) ** 2 < 2.0**53:
        x, y = a.astype(float), b.astype(float)
        return np.rint((x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1) - 2 * (x @ y.T)).astype(np.int64)
    return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T)


def next_balls(old: np.ndarray, new: np.ndarray, radius2: np.ndarray) -> Balls:
    """Neighbours of the new centroids; `radius2` holds the squared radii around the old ones, -1 for empty balls."""
    moved = ((new - old) ** 2).sum(axis=1)
    apart = exact_distances(new, new)
    reach = np.where(radius2 < 0, -1.0, 2 * (np.sqrt(np.maximum(radius2, 0)) + np.sqrt(moved)) * (1 + 1e-9) + 1e-6)
    near, gaps, still = [], [], np.zeros(len(new), bool)
    for i in range(len(new)):
        some = np.flatnonzero((np.sqrt(apart[i]) <= reach[i]) & (np.arange(len(new)) != i))
        some = some[np.argsort(apart[i, some], kind="stable")]
        near.append(some)
        gaps.append(apart[i, some])
        still[i] = not moved[i] and not moved[some].any()
    return Balls(new, near, gaps, still)


def assign(points: np.ndarray, balls: Balls, own: np.ndarray | None, distance: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Each row's cluster and squared distance in the next round, and how many distances were computed."""
    if balls.near is None:
        every = exact_distances(points, balls.centers)
        own = every.argmin(axis=1)  # the first of equal ones
        return own, every[np.arange(len(points)), own], every.size
    own, distance = own.copy(), distance.copy()
    go = np.flatnonzero(~balls.still[own])
    distance[go] = ((points[go] - balls.centers[own[go]]) ** 2).sum(axis=1)
    computed = len(go)
    go = go[np.argsort(own[go], kind="stable")]
    cuts = np.searchsorted(own[go], np.arange(len(balls.centers) + 1))
    for i in range(len(balls.centers)):
        rows = go[cuts[i] : cuts[i + 1]]
        if not len(rows) or not len(balls.near[i]):
            continue
        # the annulus: neighbours within twice the row's distance; none for the stable core
        ring = np.searchsorted(balls.gaps[i], 4 * distance[rows], "right")
        rows, ring = rows[ring > 0], ring[ring > 0]
        if not len(rows):
            continue
        order = np.argsort(ring, kind="stable")
        for part in np.array_split(order, min(4, len(order))):  # rows of like annuli share a product
            some, k = rows[part], int(ring[part].max())
            to = balls.near[i][:k]
            d = exact_distances(points[some], balls.centers[to])
            computed += d.size
            best = d.min(axis=1)
            number = np.where(d == best[:, None], to, len(balls.centers)).min(axis=1)
            better = (best < distance[some]) | ((best == distance[some]) & (number < i))
            own[some[better]], distance[some[better]] = number[better], best[better]
    return own, distance, computed


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _replayed(batch: pa.RecordBatch, history: list[Balls], v: str, cluster: str, far: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = _matrix(batch.column(v), history[0].centers.shape[1])
    own, distance = (batch.column(x).to_numpy(zero_copy_only=False) for x in (cluster, far)) if cluster in batch.schema.names else (None, None)
    for balls in history:
        own, distance, _ = assign(points, balls, own, distance)
    return points, own, distance


def _sums(shared, names: tuple[str, str, str]):
    """Per task: each cluster's rows, sums and largest distance, under the rounds of `shared`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = shared.value
        k, dim = history[0].centers.shape
        count, total, most = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), np.full(k, -1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            points, own, distance = _replayed(batch, history, *names)
            order = np.argsort(own, kind="stable")
            full, first = np.unique(own[order], return_index=True)
            total[full] += np.add.reduceat(points[order], first)
            count += np.bincount(own, minlength=k)
            np.maximum.at(most, own, distance)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), pa.array(most[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "most", "total"])

    return run


def _assigned(shared, names: tuple[str, str, str]):
    """The rows with their clusters and distances; an old pair of these columns is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = distance = np.zeros(0, np.int64)
            if batch.num_rows:
                _, own, distance = _replayed(batch, shared.value, *names)
            rest = [x for x in batch.schema.names if x not in names[1:]]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in rest), pa.array(own, pa.int64()), pa.array(distance, pa.int64())], [*rest, *names[1:]])

    return run


def integers(embedding: str, scale: int = SCALE, dim: int = DIM) -> tuple[Column, Column]:
    """Whether a vector takes part, and its integers."""
    whole = F.col(embedding).isNotNull() & (F.size(embedding) == dim)
    whole &= F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    refused = F.raise_error(F.lit("components are too large for exact 64-bit distances")).cast("long")
    scaled = lambda x: F.lit(scale) * x.cast("double")
    return whole, F.transform(embedding, lambda x: F.when(F.abs(scaled(x)) < MOST, F.floor(scaled(x)).cast("long")).otherwise(refused))


def cluster_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, seed: int = SEED, replay: int = REPLAY) -> tuple[DataFrame, list[list[int]]]:
    """The vectors that take part, without `embedding`, with cluster and distance; and the final centroids."""
    spark = vectors.sparkSession
    spool = Spool(spark, "kmeans")
    v, whole, ints = fresh("v", vectors), *integers(f"`{embedding}`", scale, dim)
    rest = [F.col(f"`{c}`") for c in vectors.columns if c != embedding and c.lower() not in ("cluster", "distance")]
    held = spool.keep(vectors.where(whole).select(*rest, ints.alias(v)), "vectors")
    cluster, far = "cluster", "distance"
    schema = f"{held.select(*[f'`{c}`' for c in held.columns])._jdf.schema().toDDL()}, cluster long, distance long"
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{vec_id}`").cast("string")), 256)
    first = held.orderBy(drawn.asc_nulls_last(), F.col(v)).limit(k).select(v).collect()  # k rows
    if not first:
        return spark.createDataFrame([], schema).drop(v), []
    centers = np.array([r[0] for r in first], np.int64).reshape(len(first), dim)
    history = [Balls(centers)]
    names = (v, cluster, far)
    for _ in range(rounds):
        if len(history) > replay:
            past = spark.sparkContext.broadcast(history[:-1])
            before, held = held, spool.keep(held.mapInArrow(_assigned(past, names), schema), "assigned")
            spool.drop(before)
            history = history[-1:]
        shared = spark.sparkContext.broadcast(history)
        # k rows a task, folded by cluster and place; k x dim numbers reach the driver
        parts = held.select(*[f"`{c}`" for c in names if c in held.columns]).mapInArrow(_sums(shared, names), "cluster long, n long, most long, total array<long>")
        sums = F.array(*[F.sum(F.col("total")[i]) for i in range(dim)])
        new, radius2 = centers.copy(), np.full(len(centers), -1, np.int64)
        for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("most").alias("most"), sums.alias("total")).collect():
            new[r.cluster] = [t // r.n for t in r.total]
            radius2[r.cluster] = r.most
        history = [*history, next_balls(centers, new, radius2)]
        centers = new
    shared = spark.sparkContext.broadcast(history)
    out = spool.keep(held.mapInArrow(_assigned(shared, names), schema).drop(v), "clusters")
    spool.drop(held)
    return out, centers.tolist()


def summary(clustered: DataFrame, centers: list[list[int]]) -> DataFrame:
    """Per cluster: its inertia, all clusters' inertia, and the digest of its centroid. k rows at most."""
    spark = clustered.sparkSession
    rows = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centers)]
    digests = spark.createDataFrame(rows, "cluster long, centroid_sha256 string")
    each = clustered.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = each.agg(F.sum("cluster_inertia").alias("inertia"))
    # at most k rows, and one
    return each.join(F.broadcast(digests), "cluster").crossJoin(F.broadcast(total))


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered, centers = cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    out = clustered.join(F.broadcast(summary(clustered, centers)), "cluster")  # at most K rows
    return out.select("vec_id", F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _twin() -> str:
    """Plain k-means: every vector is compared with every centroid in each round."""
    out = f"""
with recursive v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(embedding) = {DIM} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
c0 as materialized (
  select row_number() over (order by sha256('{SEED}:' || cast(vec_id as varchar)) nulls last, v) - 1 as c, v as center from v qualify c < {K}
)"""
    for t in range(ROUNDS + 1):
        out += f""",
d{t} as materialized (
  select r, c, cast(list_sum(list_transform(list_zip(v, center), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as d from v, c{t}
),
a{t} as materialized (select r, c, d from d{t} qualify row_number() over (partition by r order by d, c) = 1)"""
        if t < ROUNDS:
            out += f""",
s{t} as materialized (
  select c, i, sum(x) as s, count(*) as n
  from (select a.c, unnest(v.v) as x, generate_subscripts(v.v, 1) as i from v join a{t} a using (r)) group by c, i
),
m{t} as materialized (select c, list(cast((s - ((s % n + n) % n)) // n as bigint) order by i) as center from s{t} group by c),
c{t + 1} as materialized (select c0.c, coalesce(m{t}.center, p.center) as center from c0 join c{t} p using (c) left join m{t} using (c))"""
    return (
        out
        + f"""
select vec_id, cast(a.c as integer) as cluster, d as distance, cast(sum(d) over (partition by a.c) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia, sha256(list_aggregate(center, 'string_agg', ',')) as centroid_sha256
from v join a{ROUNDS} a using (r) join c{ROUNDS} c on a.c = c.c
"""
    )


QUERIES = {"op12_ball_kmeans": op12_ball_kmeans}
ORACLE = {"op12_ball_kmeans": _twin()}
