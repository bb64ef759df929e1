import math

import numpy as np
import pytest

from docsmith.llm import hnsw


def brute(rows, k, every):
    """All candidates of every query, best first: (query, score, id, place)."""
    usable = [(i, j, v) for j, (i, v) in enumerate(rows) if v and any(v)
              and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, j, q in usable:
        if i is not None and i % every == 0:
            scored = sorted((-float(np.dot(*_same(q, v))), w is None, w or 0)
                            for w, l, v in usable if l != j)
            out.setdefault(i, []).append([(None if none else w, -s) for s, none, w in scored[:k]])
    return out


def _same(a, b):
    n = max(len(a), len(b))
    return np.pad(a, (0, n - len(a))), np.pad(b, (0, n - len(b)))


def recall(rows, got, k, every):
    want = brute(rows, k, every)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q, lists in want.items():
        for ids in lists[:1]:
            have = {x for _, x, _ in found.get(q, [])}
            hits += len({x for x, _ in ids} & have)
            total += len({x for x, _ in ids})
    return hits / total


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, k1 string, shard int, score int")


@pytest.mark.parametrize("lengths", ["equal", "uneven"])
def test_recall_over_shards(spark, lengths):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(3000, 24))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if lengths == "uneven":
        v *= rng.lognormal(size=(3000, 1))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = hnsw.nearest(spark, frame(spark, rows), k=20, every=50, shard_rows=800,
                       query_block=25).collect()
    assert recall(rows, got, 20, 50) >= 0.95
    assert len(got) == 60 * 20
    for r in got:   # scores are exact, whatever was found
        assert r.score == pytest.approx(float(v[r.query_id] @ v[r.vec_id]), rel=1e-12)
        assert r.query_id != r.vec_id


def test_small_tables_are_exact(spark):
    """Ties, repeated rows, ids and vectors that differ, and rows that take no part."""
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 5)]) for i in range(90)]
    rows = [(i, v if any(v) else [1.0] * 5) for i, v in rows]
    rows += [(200 + i, rows[4][1]) for i in range(60)]     # one vector over and over
    rows += [(None, rows[4][1]), (None, rows[5][1]), (10, None), (20, [0.0] * 5), (30, []),
             (40, [None] * 5), (50, [float("nan")] * 5), (60, [float("inf")] * 5), (95, [2.0]), (-5, [3.0] * 5)]
    got = {}
    for r in hnsw.nearest(spark, frame(spark, rows, "float").repartition(4), k=7, every=5,
                          shard_rows=1000).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows, 7, 5)
    assert sorted(got) == sorted(want)
    for q, lists in want.items():
        assert len(lists) == 1
        assert [(i, s) for _, i, s in sorted(got[q])] == lists[0]


def test_repeated_rows_are_candidates_of_each_other(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [1.0, 1.0])]
    got = sorted(tuple(r) for r in hnsw.nearest(spark, frame(spark, rows), k=5, every=5).collect())
    one = [(0, 1, 0, 1.0), (0, 2, 7, 1.0), (0, 3, 0, 0.0)]
    other = [(0, 1, 7, 1.0), (0, 2, 0, 0.0), (0, 3, 0, 0.0)]
    assert got == sorted(one + one + other)


def test_few_rows(spark):
    df = frame(spark, [(0, [1.0, 2.0]), (3, [2.0, 1.0])])
    assert [tuple(r) for r in hnsw.nearest(spark, df).collect()] == [(0, 1, 3, 4.0)]
    assert hnsw.nearest(spark, df.limit(1)).count() == 0
    assert hnsw.nearest(spark, df.limit(0)).count() == 0
    assert hnsw.nearest(spark, df.filter("vec_id = 3")).count() == 0   # no query


def test_very_long_and_very_large_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=3000) * 1e150]) for i in range(40)]
    got = hnsw.nearest(spark, frame(spark, rows), k=3, every=20).collect()
    assert recall(rows, got, 3, 20) == 1
    huge = hnsw.nearest(spark, frame(spark, [(0, [1e200, 1.0]), (1, [1e200, 2.0])]), k=3).collect()
    assert [tuple(r) for r in huge] == [(0, 1, 1, math.inf)]


def test_graph_shape():
    """Layers shrink by the degree; every node can be reached and has links."""
    v = hnsw.lifted(np.random.default_rng(0).normal(size=(2000, 8)))
    layers = hnsw.build_graph(v, degree=8)
    assert [len(x) for x in layers] == [2000, 250, 31, 3]
    assert [x.shape[1] for x in layers] == [16, 8, 8, 8]
    for links in layers:
        reached, edge = {0}, [0]
        while edge:
            edge = [y for x in edge for y in links[x].tolist() if y >= 0 and y not in reached]
            reached.update(edge)
        assert len(reached) >= 0.99 * len(links)
        for i, own in enumerate(links.tolist()):
            own = [x for x in own if x >= 0]
            assert own and i not in own and len(own) == len(set(own))
    back = hnsw._layers(np.array([len(x) for x in layers], np.int64).tobytes(),
                        b"".join(x.tobytes() for x in layers))
    assert all((x == y).all() for x, y in zip(layers, back))
