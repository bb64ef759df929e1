"""Plan checks: what reaches the scans, how often a table is read, no
row-at-a-time Python in the plan."""

import re

from conftest import SF001
from docsmith.plans import documents, shape
from docsmith.sources.catalogue import Catalogue


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_range_reaches_bridge_scans(spark):
    cat = Catalogue.from_adapter(spark, SF001)
    df = shape.nested(documents.build(cat, "book", id_range=(1000, 2000)))
    text = _formatted(df)
    # root (orders) and the bridges keyed by the book id (lineitem) are all
    # read with the range pushed into the parquet scan
    pushed = [ln for ln in text.splitlines() if ln.strip().startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(o_orderkey,1000)" in ln and "LessThan(o_orderkey,2000)" in ln
               for ln in pushed)
    li = [ln for ln in pushed if "GreaterThanOrEqual(l_orderkey,1000)" in ln and "LessThan(l_orderkey,2000)" in ln]
    assert len(li) == 6  # authors, artists, genres, filters, languages, scores
    assert any("GreaterThanOrEqual(user_id,1000)" in ln for ln in pushed)  # restrictions


def test_scores_read_once(spark):
    from docsmith.queries import q_score_pivot
    text = _formatted(q_score_pivot(spark, SF001))
    # the score table is lineitem-backed: one lineitem scan for all devices
    scans = set(re.findall(r"^\((\d+)\) Scan parquet", text, flags=re.M))
    assert len(scans) == 2  # orders (root) + lineitem (scores), not one per device


def test_no_python_udfs(spark):
    cat = Catalogue.from_adapter(spark, SF001)
    for doc in ("book", "album", "movie", "game", "software", "song"):
        plan = _plan(shape.nested(documents.build(cat, doc)))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, doc


def test_no_cartesian_products(spark):
    cat = Catalogue.from_adapter(spark, SF001)
    for doc in ("book", "album", "movie", "game", "software", "song"):
        plan = _plan(shape.nested(documents.build(cat, doc)))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, doc


def test_root_shuffled_once_for_id_keyed_branches(spark):
    # with broadcasts disabled, every id-keyed branch meets the root in a
    # sort-merge join on co-partitioned inputs: one exchange per input, no
    # re-shuffle of the growing document between joins
    cat = Catalogue.from_adapter(spark, SF001)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = documents.build(cat, "movie").df
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    root_ids = set(re.findall(r"SortMergeJoin \[(id#\d+L)\]", text))
    assert len(root_ids) == 1
    rid = root_ids.pop()
    smj = text.count(f"SortMergeJoin [{rid}]")
    root_exchanges = text.count(f"Exchange hashpartitioning({rid},")
    assert smj == 10            # 5 people/genre branches, video, restrict, filters, languages, scores
    assert root_exchanges == 1  # the document is never re-shuffled between the joins


def test_hot_album_is_split(spark, make_cat):
    # album-keyed relations meet the album first; the songs are joined to it once,
    # and AQE splits the album that holds a third of them
    n = 60000
    cat = make_cat(music_album=[(i, "alb" * 30, 1, 1, 1) for i in range(2000)])
    songs = spark.range(n).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 2000 END AS album_id",
        "concat('title ', sha2(string(id), 512), sha2(string(id + 1), 512)) AS title")
    cat = cat.with_table("music", songs.repartition(12))
    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        df = documents.build(cat, "song").df
        assert len(df.collect()) == n  # the final, adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert len(re.findall(r"Exchange hashpartitioning\(album_id", plan)) <= 1


def test_no_sets_of_sets(spark):
    """Lists of a folded chain are gathered by value: a hot item never holds the sets
    of all its filters."""
    from docsmith.operators.branch import build_branch
    from docsmith.plans.specs import spec_for
    cat = Catalogue.from_adapter(spark, SF001)
    for doc in ("book", "game"):
        b = next(x for x in spec_for(doc).branches if x.name == "filters")
        text = _formatted(build_branch(cat, b))
        values = build_branch(cat, b)._jdf.queryExecution().optimizedPlan().toString()
        # the only sets are those of a filter's sites, by filter
        assert all("site_id" in x for x in re.findall(r"collect_set\(([^,)]*)", values)), values
        assert "explode(" in text


def test_restrictions_read_once(spark):
    """The fixture's restriction table is a union of two scans of events."""
    cat = Catalogue.from_adapter(spark, SF001)
    for doc in ("book", "album", "movie", "game", "software", "song"):
        text = _formatted(documents.build(cat, doc).df)
        assert len(re.findall(r"Location: InMemoryFileIndex \[[^\]]*events\.parquet", text)) == 2, doc
