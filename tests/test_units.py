"""Small units: options, media-type mapping, label tree, keys."""

import pytest
from pyspark.sql import functions as F

from docsmith.operators.branch import Kinds
from docsmith.params import Options, Params
from docsmith.plans.model import flat_name
from docsmith.plans.shape import label_tree
from docsmith.plans.specs import FIELDS, fields_for, spec_for


def test_options_validated():
    with pytest.raises(ValueError):
        Options(dates="all")
    with pytest.raises(ValueError):
        Options(song_match="title")


def test_label_tree_and_flat_names():
    tree = label_tree(["_id", "restrict.type", "restrict.song.country_code[]", "people.author[]"])
    assert tree == {"_id": "_id", "restrict": {"type": "restrict_type",
                                               "song": {"country_code": "restrict_song_country_code"}},
                    "people": {"author": "people_author"}}
    assert flat_name("sorting_score.pc") == "sorting_score_pc"
    with pytest.raises(ValueError):
        label_tree(["a", "a.b"])


def test_fields_for_resolves_constants_and_devices():
    p = Params()
    f = fields_for("book", p, "book")
    assert ("episode_id", 0) in f and ("media_type", "book") in f and ("media_id", "@id") in f
    assert [x for x in f if isinstance(x, str) and x.startswith("sorting_score.")] == [
        "sorting_score.pc", "sorting_score.mobile", "sorting_score.tablet", "sorting_score.mac",
        "sorting_score.console"]
    assert "episode_id" not in FIELDS["movie"]  # the movie document has none
    legacy = spec_for("song", p, Options(legacy_labels=True))
    assert "restrict.song.contry_code[]" in legacy.fields


def test_kinds_mapping(spark):
    k = Kinds(Params(), ["book", "music"])
    df = spark.createDataFrame([("book",), ("music",), ("game",)], "t string")
    got = [r[0] for r in df.select(k.to_id(F.col("t"), "name")).collect()]
    assert got == [1, 2, None]
    back = [r[0] for r in spark.createDataFrame([(1,), (2,)], "k int").select(
        k.from_id(F.col("k"), "name")).collect()]
    assert back == ["book", "music"]


def test_params_are_parameters():
    p = Params().with_(media_ids={"book": 11, "music": 12, "movie": 13, "game": 14, "software": 15})
    spec = spec_for("book", p)
    assert spec.key_parts[0] == ("lit", "11")
    restrict = next(b for b in spec.branches if b.name == "restrict")
    assert ("media_type", 11) in restrict.where
