import hashlib
import io

import numpy as np
import pytest

from corvine.llm import decontaminate, fm_index, suffix_dedup, topk, warc
from corvine.llm._spark import Spool

from ..twins import rows_of, sql_rows


@pytest.mark.parametrize("module,name", [(warc, "op5_warc"), (topk, "op10_topk"), (decontaminate, "op6_decontaminate"), (fm_index, "op7_fm_index"), (suffix_dedup, "op9_suffix_array")])
def test_query_equals_sql(spark, sf, module, name):
    assert rows_of(module.QUERIES[name](spark, sf)) == sql_rows(sf, module.ORACLE[name])


def test_archives_round_trip(spark):
    big = "é" * 600 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a.example/x?y", big), (7, "b\r\nc", big), (7, "again", big), (None, None, big), (2, "http://s", "small"), (3, "http://s", "small"), (4, "http://n", None), (5, "http://e", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    at = Spool(spark, "warc").path("a")
    warc.write_archives(pages, at, per_file=3)
    recs = warc.read_records(spark, at)
    assert sorted(r.type for r in recs.collect()).count("request") == len(rows)
    caps = warc.assemble(recs).collect()
    assert len(caps) == len(rows) and all(c.request and c.response and c.metadata for c in caps)
    got = sorted((c.metadata.block.decode().split()[1:2] or ["~"]) + [c.response.type, c.response.refers or "~"] for c in caps)
    assert got == sorted([["1", "revisit", "<urn:capture:7>"], ["7", "response", "~"], ["7", "response", "~"], ["~", "revisit", "<urn:capture:7>"], ["2", "response", "~"], ["3", "response", "~"], ["4", "response", "~"], ["5", "response", "~"]])
    body = {c.metadata.block.decode().split()[1]: bytes(c.response.block).split(b"\r\n\r\n", 1)[1] for c in caps if c.response.type == "response" and c.metadata.block != b"page_id: \r\n"}
    assert body["7"] == big.encode() and body["2"] == b"small" and body["4"] == b""
    digest = next(c.response.digest for c in caps if c.response.block.endswith(big.encode()))
    assert digest == "sha1:" + hashlib.sha1(big.encode()).hexdigest()


def test_broken_archives_are_told():
    with pytest.raises(ValueError):
        list(warc.parse_archive(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))
    with pytest.raises(ValueError):
        list(warc.parse_archive(io.BytesIO(b"nonsense\r\n")))
    assert list(warc.parse_archive(io.BytesIO(b""))) == []


def brute(asked, queries, ids, points, k):
    out = {}
    for n, (q, v) in enumerate(zip(asked, queries)):
        rows = sorted((-int(p @ v), int(i)) for i, p in zip(ids, points) if i != q)
        out[n] = [(i, -s) for s, i in rows[:k]]
    return out


def clustered(n, dim, seed=3, spread=0.05):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(20, dim))
    return np.floor(64 * (centers[r.integers(0, 20, n)] + spread * r.normal(size=(n, dim)))).astype(np.int64)


@pytest.mark.parametrize("points", [clustered(700, 5), np.random.default_rng(1).integers(-9, 10, (600, 3)), np.tile([3, 4], (500, 1)), np.zeros((40, 0), np.int64)])
@pytest.mark.parametrize("page", [8, 128])
def test_batched_search_equals_brute_force(points, page):
    ids = np.random.default_rng(2).permutation(len(points))
    tree = topk.MTree.load(topk.MTree(ids, points, page=page).dump())
    asked, queries = ids[::9], points[::9]
    q, row, score = tree.search(asked, queries, 7)
    got = {n: [(int(ids[r]), int(s)) for r, s in zip(row[q == n], score[q == n])] for n in range(len(asked))}
    want = brute(asked, queries, ids, points, 7)
    assert got == want
    # a known score prunes, and rows that tie with it stay
    least = np.array([want[n][-1][1] for n in range(len(asked))])
    q, row, score = tree.search(asked, queries, 7, least)
    assert {n: [(int(ids[r]), int(s)) for r, s in zip(row[q == n], score[q == n])] for n in range(len(asked))} == want


def test_clusters_spare_computations():
    points = clustered(4000, 32)
    tree = topk.MTree(np.arange(4000), points)
    tree.search(np.arange(0, 4000, 20), points[::20], 20)
    assert tree.computed < 0.5 * 200 * 4000


def test_several_blocks_equal_brute_force(spark):
    points = clustered(1500, 6).tolist()
    rows = [(i, [x / 64 for x in v]) for i, v in enumerate(points)] + [(2000 + i, [1.0, 2.0]) for i in range(300)]
    got = {}
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, block=50).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    by = [(i, np.array(v)) for i, v in enumerate(points)]
    ids, all_ = np.array([i for i, _ in by]), np.array([v for _, v in by])
    want = brute(ids[::20], all_[::20], ids, all_, 5)
    assert all(got[20 * n] == w for n, w in want.items())
    flat = [i for i in range(2000, 2300)]
    assert all(got[q] == [(i, 5 * 64 * 64) for i in flat if i != q][:5] for q in flat if q % 20 == 0)
    assert len(got) == 75 + 15


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0], "x"), (3, [2.0, 2.0], "x"), (4, [2.0, 2.0], "y"), (5, None, None), (6, [1.0, None], "x"), (7, [float("nan"), 1.0], "x"), (8, [float("inf"), 1.0], "x"), (None, [9.0, 9.0], "x"), (20, [-1.0, 0.5], "x"), (20, [-1.0, 0.5], "x"), (40, [1.0, 1.0, 1.0], "x"), (41, [0.5, 0.0, 0.0], "x"), (60, [], "x"), (61, [], "x")]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string"), k=2).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 3, 24576), (0, 2, 4, 24576), (20, 1, 0, 0), (20, 2, 3, -4096), (40, 1, 41, 2048), (60, 1, 61, 0)]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    with pytest.raises(Exception, match="too large"):
        topk.top_k(spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")).collect()


def test_sql_twin_on_uneven_and_empty_vectors(spark, tmp_path):
    rows = [(i, [float(i % 7), 1.0][: i % 3]) for i in range(200)] + [(300, None), (320, [None])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert rows_of(topk.op10_topk(spark, str(tmp_path))) == sql_rows(tmp_path, topk.ORACLE["op10_topk"])


def test_archives_of_others_with_long_heads(spark, tmp_path):
    import gzip

    def record(kind, ident, block, http=True):
        head = [f"WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ident}>", f"Content-Length: {len(block)}"]
        head += ["Content-Type: application/http; msgtype=response"] if http else []
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    long = b"HTTP/1.1 200 OK\r\n" + b"".join(b"X-Header-%d: %s\r\n" % (i, b"v" * 90) for i in range(45)) + b"\r\n"
    assert len(long) > 4096
    bodies = {"a": (long, b"body\n\nof a\r\n\r\nmore"), "b": (b"HTTP/1.0 200 OK\nA: b\n\n", b"\r\n\r\n"), "c": (b"", b"no head at all"), "d": (long, b"")}
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(b"".join(record("response", k, h + x) for k, (h, x) in bodies.items()) + record("metadata", "m", b"k: v\r\n\r\n", False)))
    rows = {r.id: r for r in warc.read_records(spark, f"file://{tmp_path}").collect()}
    for k, (head, body) in bodies.items():
        r = rows[f"<{k}>"]
        assert r.head == len(head) and bytes(r.block)[r.head :] == body, k
    assert rows["<m>"].head == 0


def test_large_payloads_are_laid_out_apart(spark, tmp_path):
    rows = [(i, "http://a", "x" * (700_000 if i % 50 == 0 else 10)) for i in range(200)]
    pages = spark.createDataFrame([(i, u, h + str(i)) for i, u, h in rows], "page_id long, url string, html string")
    at = f"file://{tmp_path}/out"
    warc.write_archives(pages.repartition(2), at)
    got = warc.assemble(warc.read_records(spark, at)).collect()
    assert len(got) == 200 and {int(r.metadata.block.decode().split()[1]) for r in got} == set(range(200))
