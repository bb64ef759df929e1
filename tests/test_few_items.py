"""Relations that are much larger than their root: rows of other items are not shuffled."""

import re

import pytest

from docsmith.operators import assemble as module
from docsmith.plans import documents


def _catalogue(make_cat):
    # 1 and 2 are movies; 3 is not, whatever the relations say of it
    return make_cat(
        movie=[(1, "m", 1), (2, "n", 1)],
        movie_actors=[(1, 5), (1, 6), (2, 5), (3, 5), (3, 7)], actors=[(5, "A"), (6, "B"), (7, "C")],
        media_geo_restrict=[(1, 3, "active", "t", "US", None), (3, 3, "active", "t", "CA", None)],
        content_filters=[(7, "G"), (8, "F")], site_content_filter_exclusions=[(7, 3, 10), (8, 3, 30)],
        content_filters_medias=[(1, "movie", 7), (2, "movie", 7), (3, "movie", 8)],
        scores=[(1, 1, 2.0), (3, 1, 4.0), (3, 1, 5.0)])


def _rows(cat):
    df = documents.build(cat, "movie", keep_rows=True).df
    return sorted(map(str, df.collect())), df


@pytest.mark.parametrize("few", [True, False])
def test_rows_of_other_items_are_not_shuffled(spark, make_cat, monkeypatch, few):
    want, _ = _rows(_catalogue(make_cat))
    monkeypatch.setattr(module, "RELATION_BYTES", 0)
    if not few:
        monkeypatch.setattr(module, "LISTS_BYTES", 0)
    got, df = _rows(_catalogue(make_cat))
    assert got == want and len(got) == 2
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("Join LeftSemi", plan)) >= (8 if few else 0)
    assert few or "Join LeftSemi" not in plan


def test_null_and_repeated_ids_of_the_root(spark, make_cat, monkeypatch):
    cat = _catalogue(make_cat)
    roots = cat["movie"].unionByName(cat["movie"].limit(1)).unionByName(
        cat["movie"].limit(1).selectExpr("CAST(NULL AS BIGINT) AS id", "title", "licensor_id"))
    want, _ = _rows(cat.with_table("movie", roots))
    monkeypatch.setattr(module, "RELATION_BYTES", 0)
    assert _rows(cat.with_table("movie", roots))[0] == want
