import collections
import hashlib
import random

import numpy as np

from docsmith.llm import mixing, sharding
from llm_fixtures import documents  # noqa: F401


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "b", "c", "d", "é", None, "Z", "tiny"])
        n = rng.randint(0, 30) if source != "tiny" else 1
        rows.append((i, "w " * n, source))
    rows += [(1, "x y z", "a")] * 5 + [(None, "x y", "b"), (7, None, "a"), (8, "", "only empty")]
    return rows


def test_targets_and_taken(spark, documents):
    rows = corpus()
    docs = documents(rows, "size target bucket uid")
    got = mixing.schedule(spark, docs).collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    taken = collections.Counter()
    largest = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.repeats <= 3 and len(r.positions) == r.repeats
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
        taken[r.source] += r.size * r.repeats
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 or taken[s] <= 3 * sizes[s] == want[s]
    again = mixing.schedule(spark, docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_positions_follow_the_integrated_schedule(spark, documents):
    docs = documents([(i, "w", "a" if i % 2 else "b") for i in range(2000)])
    rows = mixing.schedule(spark, docs, weights=(1, 1), slopes=(-0.6, 0.6)).collect()
    for source, slope in (("a", -0.6), ("b", 0.6)):
        at = np.array([p for r in rows if r.source == source for p in r.positions])
        for t in (0.25, 0.5, 0.75):
            assert abs((at <= t).mean() - (t + slope * (t * t - t))) < 0.01


def test_mix_emits_the_copies_in_order(spark, documents):
    docs = documents(corpus(), "at row _in positions")
    plan = mixing.schedule(spark, docs).collect()
    out = mixing.mix(spark, docs)
    assert out.schema.names == docs.schema.names
    want = collections.Counter()
    for r in plan:
        if r.repeats:
            want[r.doc_id, r.source] += r.repeats
    assert collections.Counter((r.doc_id, r.source) for r in out.collect()) == want
    assert mixing.mix(spark, docs.limit(0)).count() == 0
    assert mixing.mix(spark, documents([None, ""])).count() == 0


def test_hypergeometric_draws():
    rng = np.random.default_rng(0)
    small = [sharding.draw_hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(small) - 6) < 0.15
    # the sampler for large populations, held against numpy's at a size that both take
    limit, sharding._NUMPY_LIMIT = sharding._NUMPY_LIMIT, 0
    try:
        own = [sharding.draw_hypergeometric(rng, 3000, 7000, 500) for _ in range(4000)]
        huge = [sharding.draw_hypergeometric(rng, 10 ** 11, 7 * 10 ** 11, 10 ** 8) for _ in range(5)]
    finally:
        sharding._NUMPY_LIMIT = limit
    ref = rng.hypergeometric(3000, 7000, 500, 4000)
    assert abs(np.mean(own) - 150) < 1 and abs(np.std(own) - np.std(ref)) < 0.6
    assert all(abs(x - 12.5e6) < 6 * 3500 for x in huge)
    for good, bad, n in ((0, 5, 3), (5, 0, 3), (5, 5, 0), (5, 5, 10)):
        assert sharding.draw_hypergeometric(rng, good, bad, n) == min(good, n) * (good > 0)


def test_matrix_sums():
    sizes = [0, 5, 100, 1, 0, 37]
    m = sharding.communication_matrix(sizes, 8, 1)
    assert m.sum(axis=1).tolist() == sizes
    assert sorted(m.sum(axis=0).tolist()) == [17] * 1 + [18] * 7


def test_shards_are_exact_and_uniform(spark, documents):
    docs = documents([(i, "same" if i % 3 else f"t{i}", "s") for i in range(803)]
                     + [(None, None, None)] * 3, "shard slot copy k1")
    out = sharding.shard(spark, docs, shards=8, partitions=16)
    rows = out.collect()
    assert len(rows) == 806
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert sorted(map(len, by.values())) == [100, 100, 101, 101, 101, 101, 101, 101]
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    again = sharding.shard(spark, docs, shards=8, partitions=16).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    other = sharding.shard(spark, docs, shards=8, partitions=16, seed=5).collect()
    assert sorted(map(str, rows)) != sorted(map(str, other))
    assert sharding.shard(spark, docs.limit(0)).count() == 0


def test_every_row_is_equally_likely_in_every_shard(spark, documents):
    docs = documents([(i, f"t{i}", "s") for i in range(24)]).select("doc_id", "text")
    count = collections.Counter()
    for seed in range(12):
        for r in sharding.shard(spark, docs, shards=2, partitions=4, seed=seed).collect():
            count[r.doc_id] += r.shard
    assert 2.0 < np.std([count[i] for i in range(24)]) ** 2 < 5.0 or 0.8 < np.std(
        [count[i] for i in range(24)]) < 2.6


def test_a_long_document_at_the_cut_hides_no_others(spark, documents):
    key = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    ids = sorted(range(300), key=key)
    # the very long document is the third of source "a", whose target ends inside it
    rows = [(i, "w " * (4000 if n == 2 else 7), "a") for n, i in enumerate(ids)]
    rows += [(1000, "w " * 2100, "b")]
    got = mixing.schedule(spark, documents(rows), weights=(1, 5), slopes=(0.0,)).collect()
    r = [x for x in got if x.source == "a"]
    assert r[0].target == 299 * 7 + 4000 + 2100 - 3 * 2100
    last = [x for x in r if x.repeats]
    assert abs(sum(x.size for x in last) - r[0].target) <= 3.5
    assert len({x.positions[0] for x in last}) == len(last)


def test_shards_do_not_depend_on_the_files(spark, tmp_path):
    """A third of the rows are copies; blocks of a few rows number them."""
    from docsmith.llm.common import numbered
    df = spark.createDataFrame([(i if i % 3 else 0, "x" if i % 3 == 0 else str(i)) for i in range(600)],
                               "doc_id long, text string")
    df.repartition(5).write.parquet(str(tmp_path / "five"))
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    found = []
    for name, size in (("five", "128m"), ("one", "1k")):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        read = spark.read.parquet(str(tmp_path / name))
        found.append(sorted(map(tuple, sharding.shard(spark, read, 8, partitions=16).collect())))
        copies = numbered(read, ["doc_id", "text"], block=7).filter("doc_id = 0").select("copy").collect()
        assert sorted(r["copy"] for r in copies) == list(range(1, 201))
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1]


def test_the_sql_follows_the_operator(spark, documents):
    """Long documents at every cut, repeated rows, null ids, texts and sources."""
    import duckdb
    from docsmith.llm.oracle import MIX
    rng = random.Random(8)
    rows = corpus() + [(i, "w " * int(rng.paretovariate(0.8)), rng.choice("abcd")) for i in range(500, 900)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = collections.Counter((d, s, z, round(t, 6), k) for d, s, z, t, k in con.execute(MIX).fetchall())
    got = mixing.schedule(spark, documents(rows)).collect()
    assert collections.Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.size * r.repeats)
                               for r in got) == want
