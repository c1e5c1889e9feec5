"""Exact and approximate vector search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelftrack.llm import collision_search, knn_join
from shelftrack.llm import queries as registered


def clusters(n, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dims))
    return centres[rng.integers(0, 6, n)] + 0.4 * rng.standard_normal((n, dims))


def brute(queries, data, k, names):
    rows = []
    for q in queries:
        scores = [(-float(np.dot(data[q], x)), n) for n, x in zip(names, data, strict=True) if n != names[q]]
        rows += [(names[q], i + 1, n, -s) for i, (s, n) in enumerate(sorted(scores)[:k])]
    return rows


@pytest.mark.parametrize("pivots,rows,queries", [(1, 50, 7), (8, 64, 16), (64, 8192, 512)])
def test_exact(spark, monkeypatch, pivots, rows, queries):
    monkeypatch.setattr(knn_join, "GROUP_ROWS", rows)
    monkeypatch.setattr(knn_join, "GROUP_QUERIES", queries)
    whole = np.floor(8 * clusters(400)).astype(int)
    whole[50:200] = whole[50]  # one vector that a large share of rows have
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(whole)], "vec_id long, vector array<long>")
    got = knn_join.top_products(data.filter("vec_id % 20 = 0"), data, 7, pivots)
    wanted = brute(range(0, 400, 20), whole, 7, range(400))
    assert sorted(tuple(r) for r in got.collect()) == sorted((q, i, n, int(s)) for q, i, n, s in wanted)


def test_exact_edges(spark):
    schema = "vec_id long, vector array<long>"
    rows = [(0, [3, 1]), (1, [3, 1]), (2, [1]), (3, None), (None, [9, 9]), (4, []), (1, [3, 1]), (5, [1 << 28, 0])]
    data = spark.createDataFrame(rows, schema)
    got = knn_join.top_products(data.filter("vec_id in (0, 1)"), data, 20).collect()
    assert [tuple(r)[2:] for r in sorted(got) if r.query_id == 0] == [(5, 3 << 28), (1, 10), (1, 10), (2, 3), (4, 0)]
    assert [r.vec_id for r in sorted(got) if r.query_id == 1] == [5, 0, 2, 4]
    assert knn_join.top_products(data.limit(0), data, 3).count() == 0
    assert knn_join.top_products(data, data.limit(0), 3).count() == 0


def test_exact_repeated_id(spark):
    """Ids of many equal rows, more than the query asks for."""
    whole = np.floor(8 * np.random.default_rng(5).standard_normal((220, 16))).astype(int)
    names = np.concatenate([np.repeat(np.arange(0, 400, 20), 30), 20 * np.arange(200) + 1])
    whole = np.concatenate([np.repeat(whole[:20], 30, axis=0), whole[20:]])
    data = spark.createDataFrame([(int(n), v.tolist()) for n, v in zip(names, whole, strict=True)], "vec_id long, vector array<long>")
    asked = data.filter("vec_id % 20 = 0")
    own = {r.vec_id: r.vector for r in asked.groupBy("vec_id").agg(F.min("vector").alias("vector")).collect()}
    got, wanted = knn_join.top_products(asked, data, 4).collect(), []
    for q, vector in own.items():
        scores = sorted((-int(np.dot(vector, x)), int(n)) for n, x in zip(names, whole, strict=True) if n != q)
        wanted += [(q, i + 1, n, -s) for i, (s, n) in enumerate(scores[:4])]
    assert sorted(tuple(r) for r in got) == sorted(wanted)


@pytest.mark.parametrize("block", [128, 4096])
def test_recall(spark, monkeypatch, block):
    monkeypatch.setattr(collision_search, "BLOCK_ROWS", block)
    vectors = clusters(1000, 32) * np.random.default_rng(3).uniform(0.5, 2, (1000, 1))
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, vector array<double>")
    got = collision_search.nearest_products(data.filter("vec_id % 20 = 0"), data, 20).collect()
    wanted = brute(range(0, 1000, 20), vectors, 20, range(1000))
    hits = {(r.query_id, r.vec_id) for r in got} & {(q, n) for q, _, n, _ in wanted}
    assert len(got) == len(wanted) and len(hits) >= 0.9 * len(wanted)
    for r in got:
        assert r.score == pytest.approx(float(vectors[r.query_id] @ vectors[r.vec_id]), rel=1e-12)
    assert all(a.score >= b.score for a, b in zip(sorted(got), sorted(got)[1:], strict=False) if a.query_id == b.query_id)


def test_collision_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, None), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [2.0])]
    data = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = collision_search.nearest_products(data.filter("vec_id % 20 = 0"), data, 20).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 6, 2.0), (0, 2, 1, 1.0), (0, 3, 20, 1.0), (20, 1, 6, 2.0), (20, 2, 0, 1.0), (20, 3, 1, 1.0)]
    assert collision_search.nearest_products(data, data.limit(0), 5).count() == 0


def test_queries_take_odd_vectors(spark, tmp_path):
    rows = [(0, [0.5, -0.25], 1), (1, [0.26, 1.0], 2), (2, [None, 1.0], 3), (3, None, 4), (4, [float("inf"), 0.0], 5)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [tuple(r) for r in registered.op1(spark, str(tmp_path)).collect()] == [(0, 1, 1, 32 * 16 - 16 * 64)]
    assert [(r.query_id, r.vec_id) for r in registered.op6(spark, str(tmp_path)).collect()] == [(0, 1)]


def test_whole_numbers_beyond_doubles(spark):
    big = (1 << 30) + 1
    data = spark.createDataFrame([(0, [big, 1]), (1, [big, 2]), (2, [big, 1])], "vec_id long, vector array<long>")
    got = knn_join.top_products(data.filter(F.col("vec_id") == 0), data, 2).collect()
    assert [(r.vec_id, r.score) for r in sorted(got)] == [(1, big * big + 2), (2, big * big + 1)]
