"""Bucketed tables: rows reach the writer in the order of their key."""

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from docsmith.sources.catalogue import Catalogue
from docsmith.sources.layout import bucket_catalogue


def test_rows_are_sorted_by_key_before_the_writer_sorts_by_bucket(spark, make_cat, tmp_path, monkeypatch):
    plans, given = [], DataFrameWriter.saveAsTable

    def save(self, name, *a, **kw):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return given(self, name, *a, **kw)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", save)
    rows = [(i * 37 % 101, 5) for i in range(300)] + [(None, 5), (7, None)]
    made = make_cat(movie_actors=rows, actors=[(5, "A")])
    cat = Catalogue.from_frames(spark, {n: made[n] for n in ("movie_actors", "actors")})
    got = bucket_catalogue(spark, cat, "docsmith_test_order", str(tmp_path), 4)
    try:
        above, below = next(p for p in plans if "RepartitionByExpression" in p).split("Sort [movie_id")
        assert "CollectMetrics" in above and "RepartitionByExpression" in below
        assert sorted(map(str, got["movie_actors"].collect())) == sorted(map(str, cat["movie_actors"].collect()))
        assert got["actors"].count() == 1
        files = got["movie_actors"].select("movie_id", F.input_file_name().alias("f"),
                                           F.monotonically_increasing_id().alias("n")).orderBy("f", "n").collect()
        for f in {r["f"] for r in files}:
            ids = [r["movie_id"] for r in files if r["f"] == f]
            assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
        spec = {r["col_name"]: r["data_type"] for r in
                spark.sql("DESCRIBE EXTENDED docsmith_test_order.movie_actors").collect()}
        assert (spec["Num Buckets"], spec["Sort Columns"]) == ("4", "[`movie_id`]")
    finally:
        spark.sql("DROP DATABASE docsmith_test_order CASCADE")


def test_order_survives_to_the_write(spark, tmp_path):
    """Spark leaves out a sort under the writer's own, but not one under observe()."""
    from pyspark.sql import Observation
    df = spark.range(100).repartition(2, "id").sortWithinPartitions("id")
    for frame, kept in ((df, 0), (df.observe(Observation(), F.count(F.lit(1)).alias("n")), 1)):
        plan = frame.sortWithinPartitions((F.col("id") % 2), "id")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Sort [") == 1 + kept
