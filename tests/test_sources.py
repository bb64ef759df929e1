"""Sources: JDBC predicates, adapter text, a skewed key."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from docsmith.params import Params
from docsmith.plans import documents
from docsmith.sources import ranges
from docsmith.sources.adapter import ADAPTER_SQL, base_tables_of, oracle_ctes, spark_text
from docsmith.sources.catalogue import Catalogue, tables_of
from docsmith.sources.layout import item_keys


def database(**tables):
    """``ask`` of an in-process database that holds one key column per table."""
    con = duckdb.connect()
    for name, keys in tables.items():
        con.execute(f"CREATE TABLE {name} AS SELECT unnest({list(keys)!r}::BIGINT[]) AS k")

    def ask(sql):
        asked.append(sql)
        return con.execute(sql).fetchall()
    asked = []
    return con, ask, asked


def rows_of_ranges(con, table, parts):
    return [con.execute(f"SELECT count(*) FROM {table} WHERE {p}").fetchone()[0] for p in parts]


@pytest.mark.parametrize("keys", [
    range(10_000),                                              # even
    [*range(100), *range(10 ** 12, 10 ** 12 + 9_900)],          # two far clusters
    [int(1.002 ** i) for i in range(10_000)],                   # ever thinner
    [7] * 5_000 + list(range(5_000)),                           # one key of half the rows
    [-5, -4, 3], [9] * 50, [],
], ids=["even", "clusters", "thin", "hot", "few", "one", "none"])
def test_equi_depth_ranges(keys):
    con, ask, asked = database(t=keys)
    n, hot = len(keys), max(Counter(keys).values(), default=0)
    cuts = ranges.equi_depth_cuts(ask, "t", "k", 8)
    parts = ranges.cut_ranges(cuts, "k")
    con.execute("INSERT INTO t VALUES (NULL), (-1000), (99999999999999)")   # rows after the histogram
    found = rows_of_ranges(con, "t", parts)
    assert sum(found) == n + 3                                  # each row in exactly one range
    if n >= 8:
        assert max(found) <= max(2 * -(-n // 8), hot + n // 8) + 3
        assert len(parts) <= 17
    assert len(asked) < 60
    assert ranges.equi_depth_cuts(ask, "t", "k", 1) == []


def test_histogram_sql_has_bounded_cells():
    sql = ranges.histogram_sql("t", "k", 10, 5, 105)
    con, ask, _ = database(t=[4, 5, 14, 15, 104, 105])
    assert sorted(ask(sql)) == [(0, 2), (1, 1), (9, 1)]


def test_jdbc_reads_in_ranges_of_the_item_key():
    con, ask, _ = database()
    calls = []

    class Rows(list):
        collect = lambda self: self

    class Reader:
        def jdbc(self, url, table, predicates=None, properties=None):
            calls.append((table, predicates, properties))
            return Rows(ask(f"SELECT * FROM {table}") if table.startswith("(") else [])
    spark = type("S", (), {"read": Reader()})()
    for name, key in item_keys().items():
        con.execute(f"CREATE TABLE {name} AS SELECT range % 100 AS {key} FROM range(1000)")
    cat = Catalogue.from_jdbc(spark, "jdbc:none://nowhere", {"user": "u"}, partitions=4)
    assert not calls  # nothing connects until a table is used
    bridges = [n for n in cat.names() if n in item_keys()]
    assert {"music_song_artists", "music_genres", "music_files", "book_authors"} <= set(bridges)
    for name in bridges:
        calls.clear()
        cat[name]
        table, parts, props = calls[-1]
        assert table == name and len(parts) >= 4, name       # no bridge in one partition
        assert rows_of_ranges(con, name, parts) and sum(rows_of_ranges(con, name, parts)) == 1000
        assert props == {"user": "u", "fetchsize": "100"}
    calls.clear()
    cat["author"]  # no item key: one connection
    assert calls[0][1] is None


def test_tables_have_their_configured_names(spark, make_cat, tmp_path):
    p = Params().with_(score_tables={k: f"score_{k}" for k in Params().score_tables},
                       geo_restrict_table="geo_v4")
    names = tables_of(params=p)
    assert {"score_book", "score_music", "geo_v4"} <= set(names) and "scores" not in names
    assert set(tables_of(["book"])) < set(tables_of()) and "movie" not in tables_of(["book"])
    keys = item_keys(params=p)
    assert keys["geo_v4"] == "media_id" and keys["score_book"] == "id"
    cat = Catalogue.from_jdbc(None, "jdbc:none://nowhere", {}, params=p)
    assert "geo_v4" in cat and "score_game" in cat and "media_geo_restrict" not in cat
    # a document over files of those names
    own = make_cat(book=[(1, "t", 1)], scores=[(1, 1, 5.0)],
                   media_geo_restrict=[(1, 1, "active", "click", "US", None)])
    for name in tables_of(["book"]):
        own[name].write.parquet(str(tmp_path / {"scores": "score_book", "media_geo_restrict": "geo_v4"}
                                    .get(name, name)))
    cat = Catalogue.from_parquet(spark, str(tmp_path), params=p)
    b = documents.build(cat, "book", params=p).df.first()
    assert b["sorting_score_pc"] == 5.0 and b["restrict_country_code"] == ["US"]


def test_adapter_text():
    sql = ADAPTER_SQL["music_files"]
    assert base_tables_of(sql) == ["lineitem"]
    assert "{lineitem}" in spark_text(sql) and "AS region" in spark_text(sql)
    assert oracle_ctes(["book"]).startswith("WITH book AS (SELECT")
    assert "CROSS JOIN" not in " ".join(ADAPTER_SQL.values())


def test_hot_key(make_cat):
    # one book holds a third of all bridge rows; lists and counts stay exact
    n = 3000
    authors = [(1, i % 50) for i in range(n)] + [(b, b % 50) for b in range(2, 2 * n + 2)]
    cat = make_cat(book=[(b, "t", 1) for b in range(1, 2 * n + 2)], book_authors=authors,
                   author=[(i, f"A{i:02d}") for i in range(50)],
                   book_genres=[(1, 7), (1, 8)], genre_book=[(7, "g7"), (8, "g8")])
    df = documents.build(cat, "book", keep_rows=True).df
    hot = df.where(F.col("media_id") == 1).first()
    assert hot["people_author"] == [f"A{i:02d}" for i in range(50)]
    assert hot["__joined_rows"] == n * 2
    assert df.count() == 2 * n + 1


def test_bucketed_catalogue_removes_shuffles(spark, tmp_path):
    import re
    from conftest import SF0001
    from docsmith.plans import shape
    from docsmith.sources.layout import bucket_catalogue, item_keys
    keys = item_keys()
    assert keys["book"] == "id" and keys["book_authors"] == "book_id" and keys["music"] == "album_id"
    cat = Catalogue.from_adapter(spark, SF0001)
    bcat = bucket_catalogue(spark, cat, "docsmith_test_bucketed", str(tmp_path), 4)

    def exchanges(c):
        df = documents.build(c, "movie").df
        df.write.format("noop").mode("overwrite").save()  # final (adaptive) plan
        return len(re.findall(r"Exchange hashpartitioning",
                              df._jdf.queryExecution().executedPlan().toString()))

    assert exchanges(bcat) < exchanges(cat) // 2
    files = [f for f in (tmp_path / "movie_actors").iterdir() if f.name.startswith("part-")]
    assert len(files) == 4  # one per bucket
    a = shape.comparable(documents.build(cat, "movie").df)
    b = shape.comparable(documents.build(bcat, "movie").df)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
