"""Branches staged for several types: rows that no document shows, and what is shuffled."""

import pytest

from docsmith.operators import assemble, branch
from docsmith.operators.assemble import assemble as build
from docsmith.params import REBUILD_ORDER, Params
from docsmith.plans import documents, shape, shared
from docsmith.plans.specs import spec_for

P = Params()


def _catalogue(make_cat):
    # 1 and 2 are movies and albums, 1 also a song of album 2; 3 is neither, whatever the relations say
    # of it; a movie comes twice, one has no id
    return make_cat(
        movie=[(1, "m", 1), (2, "n", 1), (2, "n", 1), (None, "o", 1)], music_album=[(1, "a", 1, 1, 1), (2, "b", 1, 1, 1)],
        music=[(1, 2, "s"), (3, 1, "t")], book=[(1, "b", 1)], game=[(2, "g", 1, 1)], software=[(3, "p", 1)],
        media_geo_restrict=[(i, k, "active", "t", c, None) for i in (1, 2, 3) for k in (1, 2, 3, 4) for c in ("US", "CA")],
        content_filters=[(7, "G"), (8, "F")], site_content_filter_exclusions=[(7, 3, 10), (8, 3, 30), (7, 2, 5), (8, 1, 4)],
        content_filters_medias=[(i, t, f) for i in (1, 2, 2, 3, None) for t in ("movie", "music", "book")
                                for f in (7, 8, None)],
        media_language=[(i, "movie", 1) for i in (1, 3)], ma_language=[(1, "E")])


def _stage(spark, cat, root, monkeypatch, few=True):
    monkeypatch.setattr(shared, "RELATION_BYTES", 0)
    if not few:
        monkeypatch.setattr(assemble, "LISTS_BYTES", 0)
    return shared.stage_shared(spark, cat, [spec_for(d, P) for d in REBUILD_ORDER], str(root), P)


@pytest.mark.parametrize("few", [True, False])
def test_rows_of_other_items_are_not_staged(spark, make_cat, tmp_path, monkeypatch, few):
    staged = _stage(spark, _catalogue(make_cat), tmp_path / "s", monkeypatch, few)
    for name in ("restrict", "filters", "languages"):
        path, schema = staged[name]
        rows = spark.read.schema(schema).parquet(path).where("__kind = 3").collect()
        want = {1, 2, 3} - ({2} if name == "languages" else set()) - ({3} if few else set())
        assert sorted(r[f"__k_{name}"] for r in rows) == sorted(want), name


@pytest.mark.parametrize("doc", ["movie", "song"])
def test_documents_are_those_built_alone(spark, make_cat, tmp_path, monkeypatch, doc):
    cat = _catalogue(make_cat)
    want = sorted(map(str, documents.comparable(cat, doc).collect()))
    staged = _stage(spark, cat, tmp_path / "s", monkeypatch)
    spec = spec_for(doc, P)
    got = shape.comparable(build(cat, spec, prebuilt=shared.prebuilt_for(spark, staged, spec, P)).df)
    assert sorted(map(str, got.collect())) == want


def test_entries_are_not_shuffled(make_cat):
    """Rows go to their item before they are exploded; equal ones are one before that."""
    b = next(x for x in spec_for("movie", P).branches if x.name == "filters")
    df = branch.build_branch(_catalogue(make_cat), b)
    above, below = df._jdf.queryExecution().executedPlan().toString().split("Generate explode")
    assert "Exchange" not in above and "HashAggregate" in below and "Exchange" in below
