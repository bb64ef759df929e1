"""The six document specifications.

Each spec states which root table a document type reads, which relations
(branches) feed which field, and how the key is formed.  Field labels use
the document notation: ``a.b`` is a nested object path, a trailing ``[]``
marks a list.
"""

from __future__ import annotations

from dataclasses import replace

from ..params import Options, Params
from .model import Branch, DocSpec, Join, Out, RootJoin


# The field labels of each document type, in output order.
# "*" stands for the root columns passed through; "sorting_score.*" for one
# score per configured device.  "restrict.song.country_code[]" is spelled
# "restrict.song.contry_code[]" under Options(legacy_labels=True).
FIELDS = {
    "book": ("episode_id", "*", "_id", "media_type", "media_id", "licensor_status", "is_public",
             "restrict.type", "content_segments[]", "restrict.country_code[]", "restrict.date[]",
             "people.author[]", "people.artist[]", "genre[]", "site_exclusion_id[]", "languages[]",
             "sorting_score.*"),
    "album": ("episode_id", "_id", "labelName[]", "song_count", "licensor_status", "is_public",
              "restrict.type", "restrict.country_code[]", "restrict.date[]", "media_type", "media_id",
              "*", "people.artist[]", "genre[]", "data_source_provider_name", "content_segments[]",
              "site_exclusion_id[]", "languages[]", "sorting_score.*"),
    "movie": ("*", "_id", "licensor_status", "restrict.type", "is_public", "restrict.country_code[]",
              "restrict.date[]", "media_type", "media_id", "people.actor[]", "people.director[]",
              "people.producer[]", "people.writer[]", "genre[]", "content_segments[]", "languages[]",
              "site_exclusion_id[]", "brightcove_id", "non_drm_brightcove_id", "sorting_score.*"),
    "game": ("episode_id", "_id", "licensor_status", "is_public", "restrict.type",
             "restrict.country_code[]", "restrict.date[]", "media_type", "media_id", "*",
             "people.developer[]", "category.name[]", "category.os[]", "genre[]", "game_type[]",
             "game_type_name[]", "content_segments[]", "site_exclusion_id[]", "is_yummy",
             "languages[]", "sorting_score.*"),
    "software": ("episode_id", "_id", "licensor_status", "is_public", "restrict.type",
                 "restrict.country_code[]", "restrict.date[]", "media_type", "media_id", "*",
                 "category", "people.softwareType[]", "software_platform[]", "genre[]",
                 "content_segments[]", "site_exclusion_id[]", "languages[]", "sorting_score.*"),
    "song": ("episode_id", "media_id", "*", "data_source_provider_name", "media_type",
             "album_title", "_id", "restrict.type", "restrict.country_code[]", "restrict.date[]",
             "people.artist[]", "genre[]", "restrict.song.country_code[]"),
}


def fields_for(doc: str, p: Params, kind: str, sources: dict | None = None,
               renames: dict | None = None) -> tuple:
    """The spec ``fields`` of a document type: labels, with the constant and
    renamed ones resolved (``episode_id`` 0, ``media_type`` the type name,
    ``media_id`` the root id unless ``sources`` says otherwise)."""
    src = {"episode_id": 0, "media_type": p.media_name(kind), "media_id": "@id"}
    src.update(sources or {})
    out = []
    for label in FIELDS[doc]:
        label = (renames or {}).get(label, label)
        if label == "sorting_score.*":
            out += [f"sorting_score.{n}" for n, _ in p.devices]
        elif label in src:
            out.append((label, src[label]))
        else:
            out.append(label)
    return tuple(out)


# ---- branches shared by several document types -----------------------------

def restriction(p: Params, kind: str, key: str = "media_id", root_ref: str = "id",
                fanout: bool = True, dates_mode: str = "doc") -> Branch:
    return Branch(
        name="restrict", table=p.geo_restrict_table, key=key, root_ref=root_ref,
        where=(("status", "active"), ("media_type", p.media_id(kind))),
        kind="restriction", type_ref="restrict_type", country_ref="country_code",
        date_ref="date_start", fanout=fanout, dates_mode=dates_mode,
        kind_cols=(("media_type", "id"),))


def content_filters(p: Params, kind: str, site_ids_as_text: bool) -> Branch:
    return Branch(
        name="filters", table="content_filters_medias", key="media_id",
        where=(("media_type", p.media_name(kind)),),
        joins=(
            Join("content_filters", (("filter_id", "id"),)),
            # chained on the filter actually found: a dangling filter id has no
            # site exclusions.  Folded per filter, so the (filter rows x sites)
            # product is never materialised.
            Join("site_content_filter_exclusions", (("content_filters.id", "content_filter_id"),),
                 where=(("media_type_id", p.media_id(kind)),), fold=True,
                 kind_cols=(("media_type_id", "id"),)),
        ),
        kind_cols=(("media_type", "name"),),
        outs=(Out("content_segments[]", "content_filters.name"),
              Out("site_exclusion_id[]", "site_content_filter_exclusions.site_id",
                  "distinct_text" if site_ids_as_text else "distinct")))


def languages(p: Params, kind: str) -> Branch:
    return Branch(
        name="languages", table="media_language", key="media_id",
        where=(("media_type", p.media_name(kind)),),
        joins=(Join("ma_language", (("language_id", "id"),)),),
        outs=(Out("languages[]", "ma_language.name"),),
        kind_cols=(("media_type", "name"),))


def licensor(p: Params, media_name: str) -> Branch:
    # N:1 lookup, folded to one row per licensor id so that a duplicate
    # licensor can never repeat a document; its row count still enters the
    # join multiplicity.
    return Branch(
        name="licensor", table="licensors", key="id", root_ref="licensor_id",
        where=(("media_type", media_name),),
        outs=(Out("licensor_status", "status", "any"), Out("is_public", "is_public", "any")))


def scores(p: Params, kind: str) -> Branch:
    return Branch(
        name="scores", table=p.score_tables[kind], key="id", kind="scores",
        devices=tuple(p.devices), value_ref="total_score", device_ref="device_type_id",
        fanout=False)


def people(name: str, bridge: str, key: str, ref_col: str, dim: str,
           label: str, how: str = "left") -> Branch:
    return Branch(
        name=name, table=bridge, key=key,
        joins=(Join(dim, ((ref_col, "id"),), how=how),),
        outs=(Out(label, f"{dim}.name"),))


def subquery(b: Branch, root_ref: str) -> Branch:
    """A correlated subquery of a row-level (ungrouped) document: matched on
    ``root_ref`` and never multiplying rows."""
    return replace(b, root_ref=root_ref, fanout=False)




def _key(p: Params, kind: str, *cols: str) -> tuple:
    return (("lit", str(p.media_id(kind))),) + tuple(("col", c) for c in cols)


# ---- documents ---------------------------------------------------------------

def book(p: Params, o: Options) -> DocSpec:
    return DocSpec(
        doc="book", root="book", kind="book", key_parts=_key(p, "book", "id"),
        fields=fields_for("book", p, "book"),
        branches=(
            licensor(p, p.media_name("book")),
            people("authors", "book_authors", "book_id", "author_id", "author", "people.author[]"),
            people("artists", "book_artists", "book_id", "artist_id", "artists", "people.artist[]"),
            people("genres", "book_genres", "book_id", "genre_id", "genre_book", "genre[]"),
            restriction(p, "book"),
            content_filters(p, "book", site_ids_as_text=False),
            languages(p, "book"),
            scores(p, "book"),
        ))


def album(p: Params, o: Options) -> DocSpec:
    lic_name = "" if o.legacy_licensor else (p.album_licensor_media_name or p.media_name("music"))
    return DocSpec(
        doc="album", root="music_album", kind="music", key_parts=_key(p, "music", "id"),
        fields=fields_for("album", p, "music"),
        branches=(
            licensor(p, lic_name),
            Branch(name="provider", table="data_source_provider", key="id",
                   root_ref="data_source_provider_id",
                   outs=(Out("data_source_provider_name", "name", "any"),)),
            Branch(name="label", table="music_label", key="id", root_ref="label_id",
                   outs=(Out("labelName[]", "name", "any_list"),)),
            people("artists", "music_album_artists", "album_id", "artist_id", "music_artist",
                   "people.artist[]"),
            people("genres", "music_album_genres", "album_id", "genre_id", "genre_music",
                   "genre[]"),
            Branch(name="songs", table="music", key="album_id",
                   outs=(Out("song_count", "id", "count_distinct"),)),
            restriction(p, "music"),
            content_filters(p, "music", site_ids_as_text=False),
            languages(p, "music"),
            scores(p, "music"),
        ))


def movie(p: Params, o: Options) -> DocSpec:
    return DocSpec(
        doc="movie", root="movie", kind="movie", key_parts=_key(p, "movie", "id"),
        fields=fields_for("movie", p, "movie"),
        branches=(
            licensor(p, p.media_name("movie")),
            people("actors", "movie_actors", "movie_id", "actor_id", "actors", "people.actor[]"),
            people("directors", "movie_directors", "movie_id", "director_id", "directors",
                   "people.director[]"),
            people("producers", "movie_producers", "movie_id", "producer_id", "producers",
                   "people.producer[]"),
            people("writers", "movie_writers", "movie_id", "writer_id", "writers",
                   "people.writer[]"),
            people("genres", "movie_genres", "movie_id", "genre_id", "genre_movie", "genre[]"),
            Branch(name="video", table="brightcove", key="id",
                   where=(("status", "active"),),
                   outs=(Out("brightcove_id", "brightcove_id", "any"),
                         Out("non_drm_brightcove_id", "non_drm_brightcove_id", "any"))),
            restriction(p, "movie"),
            content_filters(p, "movie", site_ids_as_text=False),
            languages(p, "movie"),
            scores(p, "movie"),
        ))


def game(p: Params, o: Options) -> DocSpec:
    return DocSpec(
        doc="game", root="game", kind="game", key_parts=_key(p, "game", "id"),
        fields=fields_for("game", p, "game"),
        branches=(
            licensor(p, p.media_name("game")),
            Branch(name="developer", table="developer", key="id", root_ref="developer_id",
                   outs=(Out("people.developer[]", "name"),)),
            people("genres", "game_genres", "game_id", "genre_id", "genre", "genre[]"),
            # the flag counts a category row even when its fields are NULL
            Branch(name="yummy", table="game_yummy", key="game_id", kind="list",
                   exists_label="is_yummy",
                   outs=(Out("category.name[]", "CategoryName"), Out("category.os[]", "OS"))),
            Branch(name="types", table="game_types", key="game_id",
                   joins=(Join("types", (("type_id", "id"),)),),
                   outs=(Out("game_type[]", "type_id", "distinct_text"),
                         Out("game_type_name[]", "types.name"))),
            restriction(p, "game"),
            content_filters(p, "game", site_ids_as_text=True),
            languages(p, "game"),
            scores(p, "game"),
        ))


def software(p: Params, o: Options) -> DocSpec:
    return DocSpec(
        doc="software", root="software", kind="software", key_parts=_key(p, "software", "id"),
        fields=fields_for("software", p, "software"),
        text_fields=(("category", "platform"),),
        branches=(
            licensor(p, p.media_name("software")),
            # one dimension table under two roles
            people("types", "software_types", "software_id", "type_id", "software_type",
                   "people.softwareType[]"),
            people("platforms", "software_software_type", "software_id", "software_type_id",
                   "software_type", "software_platform[]"),
            people("genres", "software_software_category", "software_id",
                   "software_category_id", "software_category", "genre[]"),
            restriction(p, "software"),
            content_filters(p, "software", site_ids_as_text=True),
            languages(p, "software"),
            scores(p, "software"),
        ))


def song(p: Params, o: Options) -> DocSpec:
    match = "__album_id" if o.song_match == "album_id" else "id"
    ca_label = "restrict.song.contry_code[]" if o.legacy_labels else "restrict.song.country_code[]"
    legacy = None
    if o.legacy_rows:
        legacy = Branch(name="dup_scores", table=p.score_tables["music"], key="id",
                        root_ref="__album_id", where=(("device_type_id", p.default_device_id),))
    return DocSpec(
        doc="song", root="music", kind="music", key_style="concat_ws",
        key_parts=_key(p, "music", "__album_id", "id"),
        grouped=False,
        fields=fields_for("song", p, "music",
                          {"media_id": "@__album_id", "data_source_provider_name": "@__provider_name",
                           "album_title": "@__album_title"},
                          {"restrict.song.country_code[]": ca_label}),
        root_joins=(
            RootJoin("music_album", (("album_id", "id"),),
                     (("id", "__album_id"), ("title", "__album_title"),
                      ("data_source_provider_id", "__provider_id"))),
        ),
        branches=(
            Branch(name="provider", table="data_source_provider", key="id",
                   root_ref="__provider_id", fanout=False,
                   outs=(Out("__provider_name", "name", "any"),)),
            restriction(p, "music", root_ref="__album_id", fanout=False, dates_mode="clean"),
            subquery(people("artists", "music_song_artists", "music_id", "artist_id", "music_artist",
                   "people.artist[]", how="inner"), match),
            subquery(people("genres", "music_genres", "music_id", "genre_id", "genre_music",
                   "genre[]", how="inner"), match),
            Branch(name="ca_file", table="music_files", key="music_id",
                   where=(("region", "CA"),), fanout=False,
                   outs=(Out(ca_label, "region"),)),
        ),
        legacy_dup=legacy)


SPECS = {"book": book, "album": album, "movie": movie, "game": game, "software": software,
         "song": song}


def spec_for(doc: str, params: Params | None = None, options: Options | None = None) -> DocSpec:
    if doc not in SPECS:
        raise KeyError(f"unknown document type {doc!r}; one of {sorted(SPECS)}")
    return SPECS[doc](params or Params(), options or Options())
