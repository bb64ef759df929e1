"""Lists of a folded chain: built per set of keys, not per item."""

import pytest

from docsmith.operators.branch import build_branch, key_sets, united_lists
from docsmith.plans import documents
from docsmith.plans.specs import spec_for
from docsmith.sources.catalogue import NO_CASE


def _catalogue(make_cat):
    # 1 and 4 have the same filters; 2 an unknown one; 3 a filter without sites; 5 no filter
    return make_cat(
        movie=[(i, "m", 1) for i in range(1, 6)],
        content_filters=[(7, "G"), (8, "F"), (9, "H")],
        site_content_filter_exclusions=[(7, 3, 10), (7, 3, 2), (8, 3, 2), (8, 3, 30), (8, 3, 30), (8, 1, 99)],
        content_filters_medias=[(1, "movie", 7), (1, "movie", 8), (1, "movie", 8), (2, "movie", 6),
                                (3, "movie", 9), (4, "movie", 8), (4, "movie", 7), (4, "book", 9)])


EXPECTED = {1: (["F", "G"], [2, 10, 30], 8), 2: (None, None, 1), 3: (["H"], None, 1),
            4: (["F", "G"], [2, 10, 30], 5), 5: (None, None, 1)}


@pytest.mark.parametrize("broadcast", ["64MB", "-1"])
def test_lists_of_equal_sets(spark, make_cat, broadcast):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, broadcast)
    try:
        df = documents.build(_catalogue(make_cat), "movie", keep_rows=True).df
        rows = {r["id"]: (r["content_segments"], r["site_exclusion_id"], r["__joined_rows"]) for r in df.collect()}
    finally:
        spark.conf.set(key, old)
    assert rows == EXPECTED


def test_values_of_a_folded_table_are_not_kept_by_item(spark, make_cat):
    """1 and 4 share one list; the items' own rows hold no set of sites."""
    cat = _catalogue(make_cat)
    b = next(x for x in spec_for("movie").branches if x.name == "filters")
    items = {r["__k_filters"]: r["__set_filters"] for r in build_branch(cat, b).collect()}
    assert items == {1: [7, 8], 2: None, 3: [9], 4: [7, 8]}
    lists = [(r["__set_filters"], r["site_exclusion_id"]) for r in united_lists(cat, b).collect()]
    assert sorted(lists) == [([7, 8], [2, 10, 30]), ([9], None)]
    assert "collect_set" not in build_branch(cat, b)._jdf.queryExecution().optimizedPlan().toString()


def test_key_sets_are_shuffled_once_by_item(spark, make_cat):
    """The sets alone are those that the items carry, without the steps that count rows."""
    cat = _catalogue(make_cat)
    b = next(x for x in spec_for("movie").branches if x.name == "filters")
    for c in (cat, cat.collated(NO_CASE)):
        items = {tuple(r["__set_filters"]) for r in build_branch(c, b).collect() if r["__set_filters"]}
        sets = key_sets(c, b)
        assert sorted(tuple(r["__set_filters"]) for r in sets.collect()) == sorted(items) == [(7, 8), (9,)]
    plan = key_sets(cat, b)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Aggregate") == 2
