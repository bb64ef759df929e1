import math

import numpy as np
import pytest

from docsmith.llm import topk


def brute(vectors, k, every):
    """vectors: (id, components) rows."""
    rows = [(i, v, [math.floor(256 * x) for x in x_]) for i, (v, x_) in enumerate(vectors)
            if x_ is not None and all(x is not None and math.isfinite(x) for x in x_)]
    out = []
    for i, v, q in rows:
        if v is None or v % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, c)), w is None, w or 0)
                        for j, w, c in rows if j != i)
        out += [(v, r + 1, None if none else w, -s) for r, (s, none, w) in enumerate(scored[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("scale", [1, 1e5, 1e12])
@pytest.mark.parametrize("size", [1, 2, 40, 300])
def test_bounds_keep_every_winner(scale, size):
    rng = np.random.default_rng(size)
    v = (rng.normal(size=(size, 6)) * 20 * scale).astype(np.int64)
    v[size // 2:] = v[:size - size // 2]  # ties
    q = v[::3]
    own = np.arange(size)[::3]
    qi, vi, scores = topk.no_random_access(q, v, own, 4)
    for a in range(len(q)):
        exact = [(-int(sum(int(x) * int(y) for x, y in zip(q[a], v[b]))), b)
                 for b in range(size) if b != own[a]]
        got = dict(zip(vi[qi == a].tolist(), scores[qi == a].tolist()))
        assert own[a] not in got
        best = sorted(exact)
        for s, b in exact:
            if best and s <= best[min(4, len(best)) - 1][0]:
                assert got[b] == -s


def test_query(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.normal(size=5)]) for i in range(230)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (None, rows[50][1]), (50, rows[50][1]), (100, None),
             (150, [1.0, None, 0.0, 0.0, 0.0]), (200, [float("nan")] * 5), (250, [float("inf")] * 5),
             (350, [0.5]), (400, []), (-50, [0.1] * 5)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<float>, b int, uid string")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]  # as floats
    got = topk.top_k(spark, df, k=5, block=50, query_block=3).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 5, 50)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(spark, df).collect()] == [(0, 1, 1, 131072)]
    assert topk.top_k(spark, df.limit(1)).count() == 0
    assert topk.top_k(spark, df.limit(0)).count() == 0


def test_reading_of_dense_vectors_stops_before_the_end():
    rng = np.random.default_rng(5)
    v = rng.integers(-256, 256, (2000, 32))
    own = np.arange(0, 2000, 50)
    qi, vi, scores = topk.no_random_access(v[own], v, own, 5)
    assert 5 * len(own) < len(qi) <= 0.05 * len(own) * len(v)  # at the end just the 5 best are open
    exact = v[own] @ v.T
    exact[np.arange(len(own)), own] = -(1 << 40)
    for i in range(len(own)):
        assert sorted(scores[qi == i])[-5:] == sorted(exact[i])[-5:]


def test_very_large_components_saturate(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 1e300])],
                               "vec_id long, embedding array<double>")
    edge = math.isqrt((1 << 62) // 2)
    assert [tuple(r) for r in topk.top_k(spark, df).orderBy("rank").collect()] == [
        (0, 1, 1, edge * edge), (0, 2, 3, 256 * edge), (0, 3, 2, -edge * edge)]
