"""Ball k-means against plain k-means, round by round, and its defined cases."""

import numpy as np
import pytest

from corvine.llm import ball_kmeans as B


def plain(points, centers, rounds):
    for t in range(rounds + 1):
        d = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        if t < rounds:
            centers = np.array([points[own == c].sum(axis=0) // (own == c).sum() if (own == c).any() else centers[c] for c in range(len(centers))])
    return own, d[np.arange(len(points)), own], centers


@pytest.mark.parametrize("spread", [1, 4, 60, 3000])
def test_balls_give_the_plain_assignment_with_fewer_distances(spread):
    r = np.random.default_rng(spread)
    points = r.integers(-1000, 1000, (8, 6))[r.integers(0, 8, 3000)] + r.integers(-spread, spread + 1, (3000, 6))
    points[:6] = points[0]  # repeated rows, and equal centroids among the first
    centers, rounds, computed = points[:24].copy(), 6, 0
    balls, own, far = B.Balls(centers), None, None
    for t in range(rounds + 1):
        own, far, n = B.assign(points, balls, own, far)
        computed += n
        if t < rounds:
            new = np.array([points[own == c].sum(axis=0) // (own == c).sum() if (own == c).any() else centers[c] for c in range(24)])
            most = np.array([far[own == c].max(initial=-1) for c in range(24)])
            balls, centers = B.next_balls(centers, new, most), new
    want = plain(points, points[:24].copy(), rounds)
    assert (own == want[0]).all() and (far == want[1]).all() and (centers == want[2]).all()
    if spread < 3000:
        assert computed < 0.6 * (rounds + 1) * 3000 * 24


def test_large_components_are_exact():
    a = np.array([[1 << 25, -(1 << 25)] * 32])
    assert B.exact_distances(a, -a)[0, 0] == 64 << 52


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("replay", [1, 4])
def test_operator_with_replays_and_clashing_names(spark, replay):
    r = np.random.default_rng(5)
    points = r.integers(-300, 300, (200, 4))
    rows = [(i, (p / 4).tolist()) for i, p in enumerate(points)]
    out, centers = B.cluster_vectors(vectors(spark, rows).selectExpr("*", "'kept' as v", "'x' as `Cluster`", "7 as _v").repartition(5), k=7, rounds=5, scale=4, dim=4, replay=replay)
    import hashlib

    drawn = sorted(range(200), key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())[:7]
    own, far, want = plain(points, points[drawn], 5)
    got = sorted((x.vec_id, x.cluster, x.distance, x.v, x._v) for x in out.collect())
    assert centers == want.tolist()
    assert got == [(i, int(own[i]), int(far[i]), "kept", 7) for i in range(200)]


def test_vectors_that_take_no_part_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf]), (7, [0.5, 1.0]), (7, [0.5, 1.0]), (None, [9.0, 9.0]), (7, [8.0, 9.0])]
    out, centers = B.cluster_vectors(vectors(spark, rows), k=3, dim=2, scale=2)
    # of the rows with id 7 the smaller vectors come first; the null id is never among the first three
    assert sorted((str(x.vec_id), x.cluster, x.distance) for x in out.collect()) == [("7", 0, 0), ("7", 0, 0), ("7", 2, 1), ("None", 2, 1)]
    assert centers == [[1, 2], [1, 2], [17, 18]]
    empty, none = B.cluster_vectors(vectors(spark, rows[:6]), k=3, dim=2)
    assert empty.count() == 0 and none == [] and empty.columns == ["vec_id", "cluster", "distance"]
    assert B.summary(empty, none).count() == 0
    with pytest.raises(Exception, match="too large"):
        B.cluster_vectors(vectors(spark, [(1, [1e30, 1.0])]), dim=2)
