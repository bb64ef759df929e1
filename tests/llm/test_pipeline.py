import collections
import hashlib

import numpy as np
import pytest

import corpus_pipeline
from docsmith.llm import oracle, queries
from docsmith.llm.common import release_staged, table
from llm_fixtures import documents  # noqa: F401

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """(docs in, rows out) of every stage over the whole table."""
    from docsmith.llm.common import staged
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = staged(spark, stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_columns(stages):
    for name, (docs, after) in list(stages.items())[:-1]:
        assert [(f.name, f.dataType) for f in after.schema] == [(f.name, f.dataType) for f in docs.schema]


def test_quality_stage_keeps_good_documents(spark, stages):
    docs, after = stages["quality"]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    labels = table(spark, SF, "labels").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id in kept for r in labels if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_near_duplicate_stage_leaves_one_of_each_group(stages):
    from test_simhash import brute_components, brute_fingerprint
    docs, after = stages["near-duplicates"]
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = [brute_fingerprint(r.text) for r in rows]
    want = {}
    for r, c in zip(rows, brute_components(prints, 2)):
        want[c] = min(want.get(c, 1 << 60), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(want.values())


def test_personal_data_stage(stages):
    from test_pii import brute
    docs, after = stages["personal-data"]
    before = {r.doc_id: r for r in docs.collect()}
    for r in after.collect():
        old = before.pop(r.doc_id)
        assert r.n_chars == len(r.text)
        if not brute(old.text):
            assert r.text == old.text
        else:
            assert r.text != old.text and not brute(r.text)
    assert not before


def test_mixing_and_packing_stages(stages):
    docs, after = stages["mixing"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    copies = collections.Counter(r.doc_id for r in after.collect())
    assert max(copies.values()) <= 3 and set(copies) <= set(texts)
    _, pieces = stages["packing"]
    rows = pieces.collect()
    starts = collections.Counter(r.doc_id for r in rows if r.start == 0)
    assert starts == copies


def test_run_equals_the_stages(spark, stages):
    def content(df):
        return sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in df.collect())
    assert content(corpus_pipeline.run(spark, SF)) == content(stages["packing"][1])


def test_every_operator_has_its_query():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(oracle.ORACLE) <= set(names)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(oracle.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    digest = lambda rows: hashlib.sha256(str(sorted(map(tuple, rows))).encode()).hexdigest()
    assert digest(got.select(*columns).collect()) == digest(
        want.project(", ".join(columns)).fetchall())


def test_release(spark, documents):
    from docsmith.llm.common import _STAGED, staged
    _STAGED.clear()
    staged(spark, documents(["a"]), "release")
    assert release_staged(spark) == 1 and not _STAGED
