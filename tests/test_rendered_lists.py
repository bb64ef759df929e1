"""Text of the lists of a folded chain: made once per set of keys, not per document."""

import json

import pytest

from docsmith.functions.lists import as_text
from docsmith.plans import documents, shape

DOCS = ("movie", "game")


def _catalogue(make_cat):
    # 1 and 4 have the same filters; 2 an unknown one; 3 a filter without sites; 5 no filter
    found = [(1, 7), (1, 8), (1, 8), (2, 6), (3, 9), (4, 8), (4, 7)]
    return make_cat(
        movie=[(i, 'm "{,}', 1) for i in range(1, 6)], game=[(i, "g", 1, 1) for i in range(1, 6)],
        content_filters=[(7, "G"), (8, "F"), (9, "H")],
        site_content_filter_exclusions=[(f, k, s) for k in (3, 4) for f, s in ((7, 10), (7, 2), (8, 2), (8, 30))],
        content_filters_medias=[(i, doc, f) for doc in DOCS for i, f in found])


@pytest.mark.parametrize("broadcast", ["64MB", "-1"])
@pytest.mark.parametrize("doc", DOCS)
def test_rendered_documents_equal_those_of_lists(spark, make_cat, doc, broadcast):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, broadcast)
    try:
        cat = _catalogue(make_cat)
        plain = documents.build(cat, doc)
        for got, want in ((documents.as_json(cat, doc), shape.as_json(plain)),
                          (documents.comparable(cat, doc), shape.comparable(plain.df))):
            assert got.dtypes == want.dtypes
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        texts = {json.loads(r["doc"])["id"]: json.loads(r["doc"]) for r in documents.as_json(cat, doc).collect()}
    finally:
        spark.conf.set(key, old)
    sites = [2, 10, 30] if doc == "movie" else ["2", "10", "30"]
    assert [texts[i]["site_exclusion_id"] for i in range(1, 6)] == [sites, None, None, sites, None]


def test_documents_meet_lists_as_text(spark, make_cat):
    for render in (as_text, shape.json_text):
        d = documents.build(_catalogue(make_cat), "movie", render=render)
        assert d.rendered == ("site_exclusion_id[]",)
        assert d.df.schema["site_exclusion_id"].dataType.simpleString() == "string"
        assert d.df.schema["content_segments"].dataType.simpleString() == "array<string>"


def test_conformance_counts_one_type_at_a_time(spark, make_cat, monkeypatch):
    """The report counts documents with a value; it carries no list of sites to them, and the
    types do not share one plan, with the broadcasts and shuffles of all."""
    from docsmith.plans.schema import conformance_report
    asked = []
    build = documents.build
    monkeypatch.setattr(documents, "build", lambda cat, doc, **kw: asked.append(kw["render"]) or build(cat, doc, **kw))
    rep = conformance_report(spark, _catalogue(make_cat), DOCS)
    found = {(r["doc"], r["field"]): r["n_docs_with_value"] for r in rep.collect()}
    assert all(found[doc, f] == n for doc in DOCS
               for f, n in (("site_exclusion_id", 2), ("content_segments", 3), ("_id", 5), ("languages", 0)))
    lists = spark.createDataFrame([([1, 2, 3],), (None,)], "x array<int>")
    assert [r[0] for r in lists.select(asked[0]("x")).collect()] == [[1], None]
    assert len(asked) == 2 and "Union" not in rep._jdf.queryExecution().optimizedPlan().toString()
