"""Registered queries: one per operator of the job, each over the whole
catalogue derived from the driver's tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the corresponding SQL in ``oracle.py`` (lists as comparable text).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.lists import as_text
from .operators.assemble import ROWS, assemble
from .params import REBUILD_ORDER, Options, Params
from .plans import shape
from .plans.model import flat_name
from .plans.specs import spec_for
from .sources import ranges
from .sources.catalogue import Catalogue

P = Params()


def _cat(spark: SparkSession, sf_dir: str) -> Catalogue:
    return Catalogue.from_adapter(spark, sf_dir)


def _subset(cat: Catalogue, doc: str, labels: list[str], branches: list[str] | None = None,
            options: Options | None = None, keep_rows: bool = False, params: Params = P) -> DataFrame:
    """Selected fields of a document type, planned with only the branches
    they need (``branches=None`` keeps all, e.g. for the join multiplicity)."""
    spec = spec_for(doc, params, options)
    fields = tuple(f for f in spec.fields if (f[0] if isinstance(f, tuple) else f) in labels)
    bs = spec.branches if branches is None else tuple(b for b in spec.branches if b.name in branches)
    spec = replace(spec, fields=fields, branches=bs)
    d = assemble(cat, spec, options, keep_rows=keep_rows, render=as_text)
    return shape.comparable(d.df)


def _doc(doc: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .plans import documents
        return documents.comparable(_cat(spark, sf_dir), doc)
    return q


def q_max_id(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    parts = [cat[t].agg(ranges.max_id(cat[t]).alias("max_id")).select(F.lit(t).alias("root"), "max_id")
             for t in ("book", "music_album", "music", "movie", "game", "software")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_segments(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return ranges.segments_frame(spark, cat["book"], P.segment_size)


def q_range_scan(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return ranges.with_segment(cat["book"], P.segment_size)


def q_range_max(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return (ranges.with_segment(cat["book"], P.segment_size)
            .groupBy("segment").agg(F.max("id").alias("max_id")))


def q_segment_union(spark, sf_dir):
    """Documents with the segment that the original's range statements would have
    read them in: one plan for all segments."""
    d = _subset(_cat(spark, sf_dir), "book", [
        "media_id", "licensor_status", "is_public", "restrict.type", "content_segments[]",
        "restrict.country_code[]", "restrict.date[]", "people.author[]", "people.artist[]", "genre[]",
        "site_exclusion_id[]", "languages[]"])
    return ranges.with_segment(d.withColumnRenamed("media_id", "id"), P.segment_size) \
        .drop("lower", "upper")


def q_keys_concat(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return cat["book"].select("id", _key_col("book"))


def _key_col(doc):
    from .functions.keys import doc_key
    spec = spec_for(doc, P)
    return doc_key(spec.key_parts, spec.key_style).alias("_id")


def q_keys_concat_ws(spark, sf_dir):
    return _subset(_cat(spark, sf_dir), "song", ["*", "_id"], []).select("id", "album_id", "_id")


def q_constants_rename(spark, sf_dir):
    return _subset(_cat(spark, sf_dir), "book", ["episode_id", "*", "media_type", "media_id"], [])


def _by_id(df: DataFrame, cols: list[str], key: str = "media_id") -> DataFrame:
    return df.select(F.col(key).alias("id"), *cols)


def q_lookup_licensor(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "book", ["media_id", "licensor_status", "is_public"], ["licensor"])
    return _by_id(d, ["licensor_status", "is_public"])


def q_branch_mn(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "book", ["media_id", "people.author[]"], ["authors"])
    return _by_id(d, ["people_author"])


def q_branch_1n_count(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "album", ["media_id", "song_count"], ["songs"])
    return _by_id(d, ["song_count"])


def q_branch_chain(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "movie", ["media_id", "content_segments[]", "site_exclusion_id[]"],
                ["filters"], keep_rows=True)
    return _by_id(d, ["content_segments", "site_exclusion_id", F.col(ROWS).cast("long").alias("n_rows")])


def q_branch_two_roles(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "software",
                ["media_id", "people.softwareType[]", "software_platform[]"], ["types", "platforms"])
    return _by_id(d, ["people_softwareType", "software_platform"])


def q_list_ordered_distinct(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "book", ["media_id", "restrict.country_code[]"], ["restrict"])
    return _by_id(d, ["restrict_country_code"])


def q_list_exact(spark, sf_dir):
    # every fan-out branch stays in the plan: the multiplicity needs their counts
    d = _subset(_cat(spark, sf_dir), "book", ["media_id", "restrict.date[]"], None,
                options=Options(dates="exact"))
    return _by_id(d, ["restrict_date"])


def q_list_clean(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "book", ["media_id", "restrict.date[]"], ["restrict"],
                options=Options(dates="clean"))
    return _by_id(d, ["restrict_date"])


def q_any_value_min(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "book", ["media_id", "restrict.type"], ["restrict"])
    return _by_id(d, ["restrict_type"])


def q_flag_exists(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "game", ["media_id", "is_yummy"], ["yummy"])
    return _by_id(d, ["is_yummy"])


def q_root_value_text(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "software", ["media_id", "category"], [])
    return _by_id(d, ["category"])


def q_score_pivot(spark, sf_dir):
    labels = ["media_id"] + [f"sorting_score.{n}" for n, _ in P.devices]
    d = _subset(_cat(spark, sf_dir), "book", labels, ["scores"])
    return _by_id(d, [flat_name(x) for x in labels[1:]])


def q_inner_song_album(spark, sf_dir):
    return _subset(_cat(spark, sf_dir), "song", ["*", "album_title"], []).select(
        "id", "album_id", "album_title")


def q_subquery_album_lists(spark, sf_dir):
    return _subset(_cat(spark, sf_dir), "song", ["*", "people.artist[]", "genre[]"],
                   ["artists", "genres"]).select("id", "people_artist", "genre")


def q_subquery_distinct_scalar(spark, sf_dir):
    return _subset(_cat(spark, sf_dir), "song", ["*", "restrict.song.country_code[]"],
                   ["ca_file"]).select("id", "restrict_song_country_code")


def q_song_legacy_rows(spark, sf_dir):
    """Songs repeated by a score table that has several rows for one (id, device)."""
    params = P.with_(score_tables={**P.score_tables, "music": "raw_scores"})
    d = _subset(_cat(spark, sf_dir), "song", ["*"], [], options=Options(legacy_rows=True),
                params=params)
    return d.groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"))


def q_fanout(spark, sf_dir):
    d = _subset(_cat(spark, sf_dir), "book", ["media_id"], None, keep_rows=True)
    return _by_id(d, [F.col(ROWS).cast("long").alias("n_rows")])


def _shared_doc(doc: str):
    """A document built from branches staged once for all six types (the
    multi-type rebuild path); must equal the document built alone."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .job import staging_root
        from .plans.shared import prebuilt_for, stage_shared
        cat = _cat(spark, sf_dir)
        specs = [spec_for(d, P) for d in REBUILD_ORDER]
        staged = stage_shared(spark, cat, specs, staging_root(spark, "shared"), P)
        spec = spec_for(doc, P)
        d = assemble(cat, spec, prebuilt=prebuilt_for(spark, staged, spec, P), render=as_text)
        return shape.comparable(d.df)
    return q


def q_doc_song_by_id(spark, sf_dir):
    """Songs with artists and genres matched on the song id (the corrected
    reading of the original's album-keyed subqueries)."""
    from .plans import documents
    return documents.comparable(_cat(spark, sf_dir), "song", options=Options(song_match="id"))


def q_bucketed_doc_movie(spark, sf_dir):
    """Movies over the catalogue rewritten bucketed by item key (the layout
    for repeated rebuilds); must equal the movies over the plain catalogue."""
    import uuid
    from .job import staging_root
    from .plans import documents
    from .sources.layout import bucket_catalogue
    db = f"docsmith_{uuid.uuid4().hex[:8]}"
    bcat = bucket_catalogue(spark, _cat(spark, sf_dir), db, staging_root(spark, "bucketed"),
                            int(spark.conf.get("spark.sql.shuffle.partitions")))
    return documents.comparable(bcat, "movie")


def _nested_doc(doc: str):
    """The document as it is indexed: nested structs and arrays.  Its JSON text is
    compared with DuckDB's, so arrays and objects are, too."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .plans import documents
        return documents.as_json(_cat(spark, sf_dir), doc)
    return q


def q_case_insensitive(spark, sf_dir):
    """Lists, constants and countries without regard to case, over a catalogue whose
    rows spell them in two ways."""
    cat = _cat(spark, sf_dir)
    odd = F.col("media_id") % 2 == 1
    cat = cat.with_table("media_geo_restrict", cat["media_geo_restrict"]
                         .withColumn("status", F.when(odd, F.initcap("status")).otherwise(F.col("status")))
                         .withColumn("country_code", F.when(F.col("restrict_type") == "click",
                                                            F.lower("country_code"))
                                     .otherwise(F.col("country_code"))))
    cat = cat.with_table("media_language", cat["media_language"].withColumn(
        "media_type", F.when(odd, F.upper("media_type")).otherwise(F.col("media_type"))))
    d = _subset(cat, "book", ["media_id", "restrict.country_code[]", "languages[]"],
                ["restrict", "languages"], options=Options(case_insensitive=True))
    return _by_id(d, ["restrict_country_code", "languages"])


def q_conformance(spark, sf_dir):
    from .plans.schema import conformance_report
    return conformance_report(spark, _cat(spark, sf_dir))


def q_rebuild_all(spark, sf_dir):
    from .job import rebuild, staging_root
    cat = _cat(spark, sf_dir)
    target = staging_root(spark, "rebuild_all")
    result = rebuild(spark, cat, list(REBUILD_ORDER), target, fmt="parquet")
    rows = [(doc, info["path"]) for doc, info in result.items()]
    parts = [spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_docs"))
             .select(F.lit(doc).alias("doc"), "n_docs") for doc, path in rows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES = {
    "max_id": q_max_id,
    "segments": q_segments,
    "range_scan": q_range_scan,
    "range_max": q_range_max,
    "segment_union": q_segment_union,
    "keys_concat": q_keys_concat,
    "keys_concat_ws": q_keys_concat_ws,
    "constants_rename": q_constants_rename,
    "lookup_licensor": q_lookup_licensor,
    "branch_mn": q_branch_mn,
    "branch_1n_count": q_branch_1n_count,
    "branch_chain": q_branch_chain,
    "branch_two_roles": q_branch_two_roles,
    "list_ordered_distinct": q_list_ordered_distinct,
    "list_exact": q_list_exact,
    "list_clean": q_list_clean,
    "any_value_min": q_any_value_min,
    "flag_exists": q_flag_exists,
    "root_value_text": q_root_value_text,
    "score_pivot": q_score_pivot,
    "inner_song_album": q_inner_song_album,
    "subquery_album_lists": q_subquery_album_lists,
    "subquery_distinct_scalar": q_subquery_distinct_scalar,
    "song_legacy_rows": q_song_legacy_rows,
    "fanout": q_fanout,
    "doc_book": _doc("book"),
    "doc_album": _doc("album"),
    "doc_movie": _doc("movie"),
    "doc_game": _doc("game"),
    "doc_software": _doc("software"),
    "doc_song": _doc("song"),
    "shared_doc_book": _shared_doc("book"),
    "shared_doc_game": _shared_doc("game"),
    "shared_doc_song": _shared_doc("song"),
    "shared_doc_album": _shared_doc("album"),
    "doc_song_by_id": q_doc_song_by_id,
    "bucketed_doc_movie": q_bucketed_doc_movie,
    **{f"doc_{d}_nested": _nested_doc(d) for d in REBUILD_ORDER},
    "case_insensitive": q_case_insensitive,
    "conformance": q_conformance,
    "rebuild_all": q_rebuild_all,
}
