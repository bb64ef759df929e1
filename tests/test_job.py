"""Job: name dispatch, versioned write, switch, segments, schema checks."""

import os

import pytest

from conftest import SF0001
from docsmith.job import rebuild, resolve_docs
from docsmith.params import REBUILD_ORDER
from docsmith.plans import documents, shape
from docsmith.plans.schema import (conformance_report, declared_paths, declared_schema,
                                   find_duplicate_labels)
from docsmith.sinks.writer import current_version, read_current
from docsmith.sources.catalogue import Catalogue


def test_resolve_docs():
    assert resolve_docs("all") == list(REBUILD_ORDER)
    assert resolve_docs(["song", "book"]) == ["book", "song"]  # fixed job order
    with pytest.raises(ValueError):
        resolve_docs(["bookz"])
    with pytest.raises(ValueError):
        resolve_docs([])


def test_rebuild_versions_and_switch(spark, tmp_path):
    cat = Catalogue.from_adapter(spark, SF0001)
    out = rebuild(spark, cat, ["book"], str(tmp_path), version="v1")
    assert current_version(spark, os.path.join(str(tmp_path), "book")) == "v1"
    first = read_current(spark, os.path.join(str(tmp_path), "book"))
    assert first.count() == cat["book"].count()
    rebuild(spark, cat, ["book"], str(tmp_path), version="v2")
    assert current_version(spark, os.path.join(str(tmp_path), "book")) == "v2"
    assert os.path.isdir(out["book"]["path"])  # the old version is still there
    nested = read_current(spark, os.path.join(str(tmp_path), "book"))
    assert "people" in nested.columns and "restrict" in nested.columns


def test_segmented_rebuild_equals_whole(spark, tmp_path):
    cat = Catalogue.from_adapter(spark, SF0001)
    seg = rebuild(spark, cat, ["movie"], str(tmp_path / "seg"), segment_size=50, version="s")
    whole = rebuild(spark, cat, ["movie"], str(tmp_path / "whole"), version="w")
    a = spark.read.parquet(seg["movie"]["path"])
    b = spark.read.parquet(whole["movie"]["path"])
    assert a.count() == b.count() == cat["movie"].count()
    assert a.where("segment <> id div 50").count() == 0
    assert a.drop("segment").select(*b.columns).exceptAll(b).count() == 0


def test_empty_root_is_rebuilt(spark, make_cat, tmp_path):
    out = rebuild(spark, make_cat(), ["book"], str(tmp_path), segment_size=10)
    assert out["book"]["version"] == current_version(spark, os.path.join(str(tmp_path), "book"))


def test_a_failure_before_the_switch_leaves_the_old_version(spark, make_cat, tmp_path, monkeypatch):
    import docsmith.job as job
    target = os.path.join(str(tmp_path), "book")
    rebuild(spark, make_cat(book=[(1, "a", 1)]), ["book"], str(tmp_path), version="v1")

    def killed(*a, **k):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(job, "switch_current", killed)
        with pytest.raises(KeyboardInterrupt):
            rebuild(spark, make_cat(book=[(2, "b", 1)]), ["book"], str(tmp_path), version="v2")
    assert current_version(spark, target) == "v1"
    assert [r["id"] for r in read_current(spark, target).collect()] == [1]


def test_retention_and_missing_target(spark, make_cat, tmp_path):
    target = os.path.join(str(tmp_path), "book")
    assert current_version(spark, target) is None
    with pytest.raises(FileNotFoundError):
        read_current(spark, target)
    cat = make_cat(book=[(1, "a", 1)])
    for v in ("v1", "v2", "v3"):
        rebuild(spark, cat, ["book"], str(tmp_path), version=v, retain=2)
    assert sorted(x for x in os.listdir(target) if x.startswith("v=")) == ["v=v2", "v=v3"]
    assert current_version(spark, target) == "v3"


def test_connector_without_a_path(spark, make_cat, monkeypatch):
    import docsmith.job as job
    seen = []
    monkeypatch.setattr(job, "write_to_connector",
                        lambda df, fmt, options, writers=None: seen.append((df.count(), fmt, options, writers)))
    rebuild(spark, make_cat(book=[(1, "a", 1)]), ["book"], None, fmt="search", version="v9",
            sink_options={"index": "{doc}-{version}"}, writers=3)
    assert seen == [(1, "search", {"index": "book-v9"}, 3)]
    with pytest.raises(job.DuplicateDocumentKey):
        rebuild(spark, make_cat(book=[(1, "a", 1), (1, "b", 1)]), ["book"], None, fmt="search")
    # a source without a path, for real
    write = __import__("docsmith.sinks.writer", fromlist=["x"]).write_to_connector
    write(spark.range(3), "noop", {}, mode="overwrite", writers=2)


def test_mapping_is_written_with_the_documents(spark, make_cat, tmp_path):
    cat = make_cat(movie=[(1, "m", 1)], movie_actors=[(1, 2)], actors=[(2, "A")])
    out = rebuild(spark, cat, ["movie"], str(tmp_path))
    schema = spark.read.parquet(out["movie"]["path"]).schema
    actor = schema["people"].dataType["actor"]
    assert actor.metadata["mapping"]["position_offset_gap"] == 100
    assert schema["people"].metadata["mapping"]["type"] == "nested"


def test_command_line(tmp_path):
    from docsmith.job import catalogue_of, pairs, parser
    a = parser().parse_args(["book", "--catalogue", "jdbc:x://h/db", "--jdbc", "user=u", "--jdbc",
                             "partitions=8", "--option", "case_insensitive=true", "--option", "dates=clean",
                             "--sink-option", "index=i-{doc}", "--writers", "4", "--retain", "3"])
    assert pairs(a.option) == {"case_insensitive": True, "dates": "clean"}
    assert a.target is None and a.writers == 4 and a.retain == 3 and not a.share
    cat = catalogue_of(None, a.catalogue, pairs(a.jdbc))  # nothing connects yet
    assert "book" in cat
    with pytest.raises(ValueError):
        catalogue_of(None, "csv:/x")
    from docsmith.params import Params
    f = tmp_path / "params.json"
    f.write_text('{"media_ids": {"book": 9}, "devices": [["tv", 7]], "geo_restrict_table": "g"}')
    p = Params.from_json(str(f))
    assert p.media_id("book") == 9 and p.devices == (("tv", 7),) and p.segment_size == 1000
    f.write_text('{"media_id": 1}')
    with pytest.raises(ValueError):
        Params.from_json(str(f))


def test_shared_rebuild_equals_separate(spark, tmp_path):
    from docsmith.plans import shape
    cat = Catalogue.from_adapter(spark, SF0001)
    out = rebuild(spark, cat, ["book", "song"], str(tmp_path), version="s", share=True)
    for doc in ("book", "song"):
        written = spark.read.parquet(out[doc]["path"])
        alone = shape.nested(documents.build(cat, doc))
        assert written.exceptAll(alone).count() == 0 and alone.exceptAll(written).count() == 0, doc


def test_json_sink(spark, tmp_path):
    cat = Catalogue.from_adapter(spark, SF0001)
    out = rebuild(spark, cat, ["game"], str(tmp_path), fmt="json", batch_size=100)
    files = [f for f in os.listdir(out["game"]["path"]) if f.endswith(".json")]
    assert len(files) >= cat["game"].count() // 100
    assert spark.read.json(out["game"]["path"]).count() == cat["game"].count()


def test_declared_schema_and_conformance(spark):
    assert declared_paths("software") == ["people.software_type", "languages"]
    s = declared_schema("movie")
    actor = s["people"].dataType["actor"]
    assert actor.metadata["mapping"]["position_offset_gap"] == 100
    cat = Catalogue.from_adapter(spark, SF0001)
    rep = {(r["doc"], r["field"]): r for r in conformance_report(spark, cat, ["software", "book"]).collect()}
    # the software document writes softwareType, the mapping declares software_type
    assert rep[("software", "people.software_type")]["emitted"] is False
    assert rep[("software", "people.softwareType")]["declared"] is False
    assert rep[("book", "people.author")]["declared"] and rep[("book", "people.author")]["emitted"]
    assert rep[("book", "_id")]["n_docs_with_value"] == cat["book"].count()
    assert rep[("book", "people.author")]["type_conforms"] is True
    # the type ids of games are declared, and emitted, as text; numbers would be found
    from docsmith.plans.schema import nonconforming, type_conforms
    from pyspark.sql.types import ArrayType, LongType
    assert not type_conforms("game", "game_type", ArrayType(LongType()))
    assert nonconforming(documents.build(cat, "game")) == []
    assert nonconforming(documents.build(cat, "software")) == [
        "people.software_type: declared, not emitted"]


def test_duplicate_labels_found():
    # labels of the original song statement: one restriction subquery was
    # labelled as the date list, and the album id was emitted as id besides m.*
    original = ["episode_id", "id", "media_id", "id", "album_id", "title", "data_source_provider_name",
                "media_type", "album_title", "_id", "restrict.date[]", "restrict.country_code[]",
                "restrict.date[]", "people.artist[]", "genre[]", "restrict.song.contry_code[]"]
    assert find_duplicate_labels(original) == ["id", "restrict.date[]"]
    from docsmith.plans.specs import spec_for
    labels = [f[0] if isinstance(f, tuple) else f for f in spec_for("song").fields]
    assert not find_duplicate_labels(labels)  # ours has none


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == Catalogue.from_adapter(spark, SF0001)["book"].count()
    assert set(e.oracle_sql()) <= set(e.queries())


def test_cli(spark, tmp_path, capsys):
    from docsmith.job import main
    main(["book", "--catalogue", f"adapter:{SF0001}", "--target", str(tmp_path),
          "--option", "dates=clean"])
    out = capsys.readouterr().out.split()
    assert out[0] == "book" and os.path.isdir(out[2])
    with pytest.raises(ValueError):
        main(["bookz", "--catalogue", f"adapter:{SF0001}", "--target", str(tmp_path)])
