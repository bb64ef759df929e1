"""Properties over the real (adapter) catalogue at sf0.001."""

from pyspark.sql import functions as F

from conftest import SF0001
from docsmith.params import Options
from docsmith.plans import documents, shape
from docsmith.sources import ranges
from docsmith.sources.catalogue import Catalogue


def _cat(spark):
    return Catalogue.from_adapter(spark, SF0001)


def test_segment_union_equals_whole(spark):
    cat = _cat(spark)
    whole = shape.comparable(documents.build(cat, "book").df)
    n = ranges.probe_max_id(cat["book"])
    parts = None
    for lo, hi in ranges.segment_bounds(n, 400):
        p = shape.comparable(documents.build(cat, "book", id_range=(lo, hi)).df)
        parts = p if parts is None else parts.unionByName(p)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_ids_unique_for_every_type(spark):
    cat = _cat(spark)
    for doc in ("book", "album", "movie", "game", "software", "song"):
        df = documents.build(cat, doc).df
        assert df.count() == df.select("_id").distinct().count(), doc
        assert df.where(F.col("_id").isNull()).count() == 0, doc


def test_clean_dates_within_exact_and_length(spark):
    cat = _cat(spark)
    ex = documents.build(cat, "book", keep_rows=True).df.select(
        "_id", F.col("restrict_date").alias("e"), "__joined_rows")
    cl = documents.build(cat, "book", options=Options(dates="clean")).df.select(
        "_id", F.col("restrict_date").alias("c"))
    rows = ex.join(cl, "_id").collect()
    checked = 0
    for r in rows:
        e, c = dict(r["e"] or []), dict(r["c"] or [])
        assert set(c) == set(e)
        if c:
            # each restriction row repeats once per combination of the others
            factor = {e[d] // c[d] for d in c}
            assert len(factor) == 1 and all(e[d] == c[d] * max(factor) for d in c)
            assert r["__joined_rows"] % max(factor) == 0
            checked += 1
    assert checked > 0


def test_independent_of_partitioning(spark):
    cat = _cat(spark)
    a = shape.comparable(documents.build(cat, "album").df)
    shuffled = Catalogue.from_frames(spark, {n: cat[n].repartition(7) for n in cat.names()})
    b = shape.comparable(documents.build(shuffled, "album").df)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
