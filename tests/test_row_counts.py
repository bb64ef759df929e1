"""Branches of which a document shows no value, dimensions that are small, and shuffles that end
with the job that made them."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from docsmith.operators import branch as module
from docsmith.operators.assemble import ROWS
from docsmith.params import Params
from docsmith.plans.shared import stage_shared
from docsmith.plans.specs import spec_for
from docsmith.queries import _subset
from docsmith.session import RELEASE, shuffles_released
from docsmith.sinks.writer import write_documents


def _catalogue(make_cat):
    # author 5 has two rows, 9 none; filter 7 two sites, 8 none, 9 dangles; a line comes twice
    return make_cat(
        book=[(1, "b", 1), (2, "c", 2), (3, "d", None)], licensors=[("book", 1, "active", 1), ("book", 1, "x", 0)],
        book_authors=[(1, 5), (1, 6), (1, 9), (2, 5), (2, 5), (None, 5)], author=[(5, "A"), (5, "B"), (6, "C")],
        book_artists=[(1, 5), (1, None)], artists=[(5, "A"), (None, "N"), (None, "M")],
        book_genres=[(2, 4)], genre_book=[(4, "G"), (4, "G"), (4, "H")],
        content_filters=[(7, "G"), (8, "F")], site_content_filter_exclusions=[(7, 1, 10), (7, 1, 11), (7, 3, 12)],
        content_filters_medias=[(1, "book", 7), (1, "book", 7), (1, "book", 8), (2, "book", 9), (2, "movie", 7)],
        media_language=[(2, "book", 1), (2, "book", 2)], ma_language=[(1, "E"), (1, "F")],
        media_geo_restrict=[(1, 1, "active", "t", "US", None), (1, 1, "active", "t", "US", None)])


@pytest.mark.parametrize("large", [True, False])
def test_counts_are_those_of_the_branches(make_cat, monkeypatch, large):
    if large:
        monkeypatch.setattr(module, "RELATION_BYTES", 0)
    cat = _catalogue(make_cat)
    for b in spec_for("book", Params()).branches:
        if b.kind == "scores":
            continue
        want = module.build_branch(cat, b).select(module.key_col(b), module.n_col(b)).collect()
        got = module.build_counts(cat, b).collect()
        assert sorted(got) == sorted(want), b.name


def test_values_that_no_document_shows_are_not_built(make_cat):
    df = _subset(_catalogue(make_cat), "book", ["media_id"], None, keep_rows=True)
    # 1: authors 2 + 1 + 1, artists 2, filters 2 + 2 + 1, restrictions 2, licensors 2
    # 2: authors 4, genres 3, filters 1, languages 2 + 1
    assert sorted((r["media_id"], int(r[ROWS])) for r in df.collect()) == [
        (1, 4 * 2 * 5 * 2 * 2), (2, 4 * 3 * 1 * 3), (3, 1)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "collect_" not in plan


def test_small_dimensions_are_broadcast(spark, make_cat, monkeypatch):
    b = next(x for x in spec_for("book", Params()).branches if x.name == "filters")
    cat = _catalogue(make_cat)
    want = sorted(map(str, module.build_branch(cat, b).collect()))
    monkeypatch.setattr(module, "RELATION_BYTES", 0)
    for most in (module.DIMENSION_BYTES, 0):
        monkeypatch.setattr(module, "DIMENSION_BYTES", most)
        df = module.build_branch(_catalogue(make_cat), b)
        assert sorted(map(str, df.collect())) == want
        hints = df._jdf.queryExecution().optimizedPlan().toString().count("rightHint=(strategy=broadcast)")
        assert hints == (2 if most else 0)


def _shuffles(spark) -> set:
    """The shuffle files of this session."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {x for d in folders for x in glob.glob(os.path.join(d.getPath(), "*", "shuffle_*"))}


def test_writes_leave_no_shuffles(spark, tmp_path):
    before = _shuffles(spark)
    write_documents(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), str(tmp_path / "d"))
    until = time.time() + 20
    while _shuffles(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffles(spark) - before
    assert spark.conf.get(RELEASE) == "false"   # only for the write
    with_owner = spark.conf.get(RELEASE)
    with shuffles_released(spark):
        assert spark.conf.get(RELEASE) == "true"
    assert spark.conf.get(RELEASE) == with_owner


def test_branches_are_staged_with_their_shuffles_released(spark, make_cat, tmp_path, monkeypatch):
    """One after another, each under the setting."""
    seen, given = [], DataFrameWriter.parquet

    def parquet(self, path, *a, **kw):
        seen.append((os.path.basename(path), spark.conf.get(RELEASE), threading.current_thread().name))
        return given(self, path, *a, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    p = Params()
    stage_shared(spark, _catalogue(make_cat), [spec_for(d, p) for d in ("book", "movie")], str(tmp_path / "s"), p)
    here = threading.current_thread().name
    assert seen == [(x, "true", here) for x in ("restrict", "filters", "__set_filters", "languages")]
