"""Independent SQL for every registered query (DuckDB dialect).

Every relation of an item is a CTE of its own: one row per item with its number
of joined rows and its values.  A document is the root with those relations, and
a date's multiplicity is the product of their row counts; the many-way product
itself is only formed by the naive plan, which the tests hold against this SQL.

Lists are rendered as comma-joined text: distinct lists sorted (numbers
numerically), countries by first date (ties by code, undated last), dates as
``date x times``.  Nested documents are rendered as JSON.
"""

from __future__ import annotations

from .plans.model import flat_name
from .plans.schema import declared_paths
from .plans.specs import FIELDS
from .sources.adapter import oracle_ctes

W = oracle_ctes()
# The default parameters of the job.
DEVICES = (("pc", 1), ("mobile", 2), ("tablet", 3), ("mac", 4), ("console", 5))
TYPES = {"book": 1, "music": 2, "movie": 3, "game": 4, "software": 5}
ROOTS = {
    "book": ("book", "book", "id title licensor_id"),
    "movie": ("movie", "movie", "id title licensor_id"),
    "game": ("game", "game", "id title developer_id licensor_id"),
    "software": ("software", "software", "id platform licensor_id"),
    "album": ("music_album", "music", "id title label_id licensor_id data_source_provider_id"),
    "song": ("music", "music", "id album_id title"),
}


def values(expr: str, text: bool = False) -> str:
    """Sorted distinct values of a group as a list; NULL when there are none."""
    found = f"list_sort(list_distinct(list({expr})))"
    found = f"CASE WHEN len({found}) > 0 THEN {found} END"
    return f"CAST({found} AS VARCHAR[])" if text else found


def relation(cte: str, rows: str, key: str, **columns: str) -> str:
    """One row per ``key``: k, n (rows) and the aggregates in ``columns``."""
    n = columns.pop("n", "count(*)")
    outs = "".join(f", {sql} AS {label}" for label, sql in columns.items())
    return f"{cte} AS (SELECT {key} AS k, {n} AS n{outs} FROM {rows} WHERE {key} IS NOT NULL GROUP BY 1)"


def people(cte: str, bridge: str, key: str, ref: str, dim: str, inner: bool = False) -> str:
    join = "JOIN" if inner else "LEFT JOIN"
    return relation(cte, f"(SELECT b.*, x.name FROM {bridge} b {join} {dim} x ON x.id = b.{ref})", key,
                    names=values("name"))


def lookup(cte: str, table: str, where: str = "true", **columns: str) -> str:
    """All values of one row, the smallest of its id (NULLs last)."""
    order = ", ".join(f"{c} NULLS LAST" for c in columns.values())
    return relation(cte, f"(SELECT * FROM {table} WHERE {where})", "id",
                    **{label: f"first({c} ORDER BY {order})" for label, c in columns.items()})


def shared(kind: str, site_text: bool = False) -> list[str]:
    t = TYPES[kind]
    return [
        f"active AS (SELECT * FROM media_geo_restrict WHERE status = 'active' AND media_type = {t})",
        "by_date AS (SELECT media_id, CAST(date_start AS VARCHAR) AS d, count(*) AS times FROM active "
        "GROUP BY ALL)",
        "by_country AS (SELECT media_id, country_code AS c, min(date_start) AS f FROM active "
        "WHERE country_code IS NOT NULL GROUP BY ALL)",
        relation("restricts", "active", "media_id", restrict_type="min(restrict_type)"),
        relation("dates", "(SELECT * FROM by_date WHERE d IS NOT NULL)", "media_id",
                 pairs="list({'date': d, 'times': times} ORDER BY d)"),
        relation("countries", "by_country", "media_id", codes="list(c ORDER BY f NULLS LAST, c)"),
        f"sites AS (SELECT content_filter_id AS f, count(*) AS n, list(site_id) AS ids "
        f"FROM site_content_filter_exclusions WHERE media_type_id = {t} GROUP BY 1)",
        relation("filters", "(SELECT b.media_id, x.name, s.n AS m, s.ids FROM content_filters_medias b "
                 "LEFT JOIN content_filters x ON x.id = b.filter_id LEFT JOIN sites s ON s.f = x.id "
                 f"WHERE b.media_type = '{kind}')", "media_id", n="sum(coalesce(m, 1))",
                 names=values("name"), sites=flat_values("ids", site_text)),
        people("languages", f"(SELECT * FROM media_language WHERE media_type = '{kind}')", "media_id",
               "language_id", "ma_language"),
        lookup("licensor", "licensors", f"media_type = '{kind}'", status="status", is_public="is_public"),
        relation("score", "scores", "id", **{
            name: f"max(total_score) FILTER (device_type_id = {d})" for name, d in DEVICES}),
    ]


def flat_values(expr: str, text: bool) -> str:
    found = f"list_sort(list_distinct(flatten(list({expr}) FILTER ({expr} IS NOT NULL))))"
    found = f"CASE WHEN len({found}) > 0 THEN {found} END"
    return f"CAST({found} AS VARCHAR[])" if text else found


# Per document: its own relations (name -> SQL), the root column that each is
# matched with (id if not named), and the source of every label that is not shared.
def own_relations(doc: str) -> tuple[list[str], dict[str, str], dict[str, str]]:
    if doc == "book":
        return ([people("authors", "book_authors", "book_id", "author_id", "author"),
                 people("draws", "book_artists", "book_id", "artist_id", "artists"),
                 people("kinds", "book_genres", "book_id", "genre_id", "genre_book")], {},
                {"people.author[]": "authors.names", "people.artist[]": "draws.names",
                 "genre[]": "kinds.names"})
    if doc == "movie":
        jobs = {"actor": "actors", "director": "directors", "producer": "producers", "writer": "writers"}
        rels = [people(f"r_{job}", f"movie_{dim}", "movie_id", f"{job}_id", dim)
                for job, dim in jobs.items()]
        return (rels + [people("kinds", "movie_genres", "movie_id", "genre_id", "genre_movie"),
                        lookup("video", "brightcove", "status = 'active'", a="brightcove_id",
                               b="non_drm_brightcove_id")], {},
                {f"people.{job}[]": f"r_{job}.names" for job in jobs}
                | {"genre[]": "kinds.names", "brightcove_id": "video.a",
                   "non_drm_brightcove_id": "video.b"})
    if doc == "game":
        return ([relation("maker", "developer", "id", names=values("name")),
                 people("kinds", "game_genres", "game_id", "genre_id", "genre"),
                 relation("yummy", "game_yummy", "game_id", cats=values("CategoryName"),
                          systems=values("OS")),
                 relation("gametypes", "(SELECT b.*, x.name FROM game_types b LEFT JOIN types x "
                          "ON x.id = b.type_id)", "game_id", ids=values("type_id", True),
                          names=values("name"))], {"maker": "developer_id"},
                {"people.developer[]": "maker.names", "category.name[]": "yummy.cats",
                 "category.os[]": "yummy.systems", "genre[]": "kinds.names",
                 "game_type[]": "gametypes.ids", "game_type_name[]": "gametypes.names",
                 "is_yummy": "CASE WHEN yummy.k IS NULL THEN 0 ELSE 1 END"})
    if doc == "software":
        return ([people("roles", "software_types", "software_id", "type_id", "software_type"),
                 people("platforms", "software_software_type", "software_id", "software_type_id",
                        "software_type"),
                 people("kinds", "software_software_category", "software_id", "software_category_id",
                        "software_category")], {},
                {"people.softwareType[]": "roles.names", "software_platform[]": "platforms.names",
                 "genre[]": "kinds.names", "category": "CAST(m.platform AS VARCHAR)"})
    if doc == "album":
        return ([people("draws", "music_album_artists", "album_id", "artist_id", "music_artist"),
                 people("kinds", "music_album_genres", "album_id", "genre_id", "genre_music"),
                 lookup("provider", "data_source_provider", name="name"),
                 lookup("maker", "music_label", name="name"),
                 relation("songs", "music", "album_id", different="count(DISTINCT id)")],
                {"provider": "data_source_provider_id", "maker": "label_id"},
                {"people.artist[]": "draws.names", "genre[]": "kinds.names",
                 "data_source_provider_name": "provider.name",
                 "labelName[]": "CASE WHEN maker.name IS NOT NULL THEN [maker.name] END",
                 "song_count": "coalesce(songs.different, 0)"})
    raise KeyError(doc)


def document(doc: str) -> tuple[str, list[tuple[str, str]]]:
    """(CTEs ending in ``doc``, a table with one column c0, c1, ... per label;
    the labels with the kind of their column)."""
    table, kind, columns = ROOTS[doc]
    rels, matched, sources = own_relations(doc)
    parts = shared(kind, site_text=doc in ("game", "software")) + rels
    counted = [r.split(" AS ", 1)[0] for r in rels] + ["filters", "languages", "licensor"]
    times = " * ".join(f"CAST(coalesce({r}.n, 1) AS HUGEINT)" for r in counted)
    labels = []
    for label in FIELDS[doc]:
        if label == "*":
            labels += columns.split()
        elif label == "sorting_score.*":
            labels += [f"sorting_score.{n}" for n, _ in DEVICES]
        else:
            labels.append(label)
    known = {
        "episode_id": "0", "_id": f"'{TYPES[kind]}-' || CAST(m.id AS VARCHAR)",
        "media_type": f"'{kind}'", "media_id": "m.id", "licensor_status": "licensor.status",
        "is_public": "licensor.is_public", "restrict.type": "restricts.restrict_type",
        "content_segments[]": "filters.names", "site_exclusion_id[]": "filters.sites",
        "languages[]": "languages.names", "restrict.country_code[]": "countries.codes",
        "restrict.date[]": f"list_transform(dates.pairs, lambda p: {{'date': p.date, "
                           f"'times': CAST(p.times AS HUGEINT) * {times}}})",
        **{f"sorting_score.{n}": f"score.{n}" for n, _ in DEVICES},
        **{c: f"m.{c}" for c in columns.split()}, **sources}
    used = ["restricts", "dates", "countries", "filters", "languages", "licensor", "score"]
    used += [r for r in counted if r not in used]
    match = {"licensor": "licensor_id", **matched}
    joins = " ".join(f"LEFT JOIN {r} ON {r}.k = m.{match.get(r, 'id')}" for r in used)
    cols = ", ".join(f"{known[label]} AS c{i}" for i, label in enumerate(labels))
    total = f"coalesce(restricts.n, 1) * {times} AS n_rows"
    return ",\n".join([W, *parts, f"doc AS (SELECT {cols}, {total} FROM {table} m {joins})"]), labels


def song(by_song: bool = False) -> tuple[str, list[str]]:
    parts = shared("music") + [
        people("draws", "music_song_artists", "music_id", "artist_id", "music_artist", inner=True),
        people("kinds", "music_genres", "music_id", "genre_id", "genre_music", inner=True),
        relation("ca", "(SELECT * FROM music_files WHERE region = 'CA')", "music_id",
                 regions=values("region"))]
    labels = [x for label in FIELDS["song"] for x in (ROOTS["song"][2].split() if label == "*" else [label])]
    known = {
        "episode_id": "0", "media_id": "a.id", "data_source_provider_name": "p.name",
        "media_type": "'music'", "album_title": "a.title",
        "_id": "concat_ws('-', '2', CAST(a.id AS VARCHAR), CAST(m.id AS VARCHAR))",
        "restrict.type": "restricts.restrict_type", "restrict.country_code[]": "countries.codes",
        "restrict.date[]": "list_transform(dates.pairs, lambda p: {'date': p.date, "
                           "'times': CAST(p.times AS BIGINT)})",
        "people.artist[]": "draws.names", "genre[]": "kinds.names",
        "restrict.song.country_code[]": "ca.regions", "id": "m.id", "album_id": "m.album_id",
        "title": "m.title"}
    item = "m.id" if by_song else "a.id"
    cols = ", ".join(f"{known[label]} AS c{i}" for i, label in enumerate(labels))
    body = (f"doc AS (SELECT {cols} FROM music m JOIN music_album a ON a.id = m.album_id "
            "LEFT JOIN data_source_provider p ON p.id = a.data_source_provider_id "
            "LEFT JOIN restricts ON restricts.k = a.id LEFT JOIN dates ON dates.k = a.id "
            "LEFT JOIN countries ON countries.k = a.id "
            f"LEFT JOIN draws ON draws.k = {item} LEFT JOIN kinds ON kinds.k = {item} "
            "LEFT JOIN ca ON ca.k = m.id)")
    return ",\n".join([W, *parts, body]), labels


def _doc(doc: str, by_song: bool = False) -> tuple[str, list[str]]:
    return song(by_song) if doc == "song" else document(doc)


def _flat(label: str, i: int) -> str:
    if label == "restrict.date[]":
        return (f"array_to_string(list_transform(c{i}, lambda p: p.date || ' x ' || "
                f"CAST(p.times AS VARCHAR)), ',')")
    return f"array_to_string(c{i}, ',')" if label.endswith("[]") else f"c{i}"


def flat(doc: str, only: dict[str, str] | None = None, more: str = "", by_song: bool = False) -> str:
    """The comparable form; ``only`` names the labels wanted and their columns."""
    ctes, labels = _doc(doc, by_song)
    wanted = only or {label: flat_name(label) for label in labels}
    cols = ", ".join(f"{_flat(label, labels.index(label))} AS {name}" for label, name in wanted.items())
    return f"{ctes}\nSELECT {cols}{more} FROM doc"


def nested(doc: str) -> str:
    ctes, labels = _doc(doc)
    tree: dict = {}
    for i, label in enumerate(labels):
        *path, leaf = label.replace("[]", "").split(".")
        node = tree
        for p in path:
            node = node.setdefault(p, {})
        node[leaf] = f"c{i}"

    def literal(node: dict) -> str:
        return "{" + ", ".join(f"'{k}': {literal(v) if isinstance(v, dict) else v}"
                               for k, v in node.items()) + "}"
    key = f"c{labels.index('_id')}"
    return f"{ctes}\nSELECT {key} AS _id, CAST(to_json({literal(tree)}) AS VARCHAR) AS doc FROM doc"


def conformance(docs=("book", "movie", "game", "software", "album", "song")) -> str:
    parts = []
    for doc in docs:
        ctes, labels = _doc(doc)
        emitted = {label.replace("[]", ""): i for i, label in enumerate(labels)}
        declared = set(declared_paths(doc))
        rows = ", ".join(
            f"('{path}', {path in declared}, {path in emitted}, "
            + (f"(SELECT bool_and(typeof(c{emitted[path]}) IN ('VARCHAR', 'VARCHAR[]')) FROM doc), "
               if path in emitted and path in declared else "CAST(NULL AS BOOLEAN), ")
            + (f"(SELECT count(c{emitted[path]}) FROM doc)" if path in emitted else "0") + ")"
            for path in sorted(set(emitted) | declared))
        parts.append(f"SELECT '{doc}' AS doc, * FROM ({ctes} SELECT * FROM (VALUES {rows}) "
                     f"v(field, declared, emitted, type_conforms, n_docs_with_value))")
    return " UNION ALL ".join(parts)


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["max_id"] = W + "\n" + " UNION ALL ".join(
        f"SELECT '{t}' AS root, max(id) AS max_id FROM {t}" for t, _, _ in ROOTS.values())
    q["segments"] = f"""{W},
      s AS (SELECT range AS segment FROM range(0, (SELECT max(id) FROM book) // 1000 + 1)),
      c AS (SELECT id // 1000 AS segment, count(*) AS n FROM book WHERE id >= 0 GROUP BY 1)
      SELECT segment, segment * 1000 AS lower, (segment + 1) * 1000 AS upper,
             coalesce(n, 0) AS n_rows FROM s LEFT JOIN c USING (segment)"""
    q["range_scan"] = f"""{W} SELECT id, title, licensor_id, id // 1000 AS segment,
      (id // 1000) * 1000 AS lower, (id // 1000 + 1) * 1000 AS upper FROM book WHERE id >= 0"""
    q["range_max"] = f"""{W} SELECT id // 1000 AS segment, max(id) AS max_id FROM book
      WHERE id >= 0 GROUP BY 1"""
    whole = {label: flat_name(label) for label in FIELDS["book"]
             if label not in ("*", "episode_id", "_id", "media_type", "media_id", "sorting_score.*")}
    book_id = {"media_id": "id"}
    q["segment_union"] = flat("book", book_id | whole,
                              f", c{_doc('book')[1].index('media_id')} // 1000 AS segment")
    q["keys_concat"] = flat("book", {"id": "id", "_id": "_id"})
    q["keys_concat_ws"] = flat("song", {"id": "id", "album_id": "album_id", "_id": "_id"})
    q["constants_rename"] = flat("book", {x: x for x in (
        "episode_id", "id", "title", "licensor_id", "media_type", "media_id")})

    def part(doc: str, *labels: str, more: str = "", key: str = "media_id") -> str:
        return flat(doc, {key: "id"} | {label: flat_name(label) for label in labels}, more)

    q["lookup_licensor"] = part("book", "licensor_status", "is_public")
    q["branch_mn"] = part("book", "people.author[]")
    q["branch_1n_count"] = part("album", "song_count")
    q["branch_two_roles"] = part("software", "people.softwareType[]", "software_platform[]")
    q["list_ordered_distinct"] = part("book", "restrict.country_code[]")
    q["list_exact"] = part("book", "restrict.date[]")
    q["any_value_min"] = part("book", "restrict.type")
    q["flag_exists"] = part("game", "is_yummy")
    q["root_value_text"] = part("software", "category")
    q["score_pivot"] = part("book", *[f"sorting_score.{n}" for n, _ in DEVICES])
    q["fanout"] = part("book", more=", n_rows")
    q["inner_song_album"] = part("song", "album_id", "album_title", key="id")
    q["subquery_album_lists"] = part("song", "people.artist[]", "genre[]", key="id")
    q["subquery_distinct_scalar"] = part("song", "restrict.song.country_code[]", key="id")
    q["branch_chain"] = ",\n".join([W, *shared("movie")]) + """
      SELECT m.id, array_to_string(f.names, ',') AS content_segments,
        array_to_string(f.sites, ',') AS site_exclusion_id, coalesce(f.n, 1) AS n_rows
      FROM movie m LEFT JOIN filters f ON f.k = m.id"""
    q["list_clean"] = ",\n".join([W, *shared("book")]) + """
      SELECT m.id, array_to_string(list_transform(d.pairs, lambda p: p.date || ' x ' ||
        CAST(p.times AS VARCHAR)), ',') AS restrict_date FROM book m LEFT JOIN dates d ON d.k = m.id"""
    q["song_legacy_rows"] = f"""{W}, r AS (SELECT id, count(*) AS n FROM raw_scores
        WHERE device_type_id = 1 GROUP BY id)
      SELECT m.id, coalesce(r.n, 1) AS n_rows FROM music m SEMI JOIN music_album a ON a.id = m.album_id
      LEFT JOIN r ON r.id = m.album_id"""
    q["case_insensitive"] = f"""{W},
      g AS (SELECT media_id, date_start, CASE WHEN restrict_type = 'click' THEN lower(country_code)
          ELSE country_code END AS c FROM media_geo_restrict
        WHERE lower(status) = 'active' AND media_type = 1),
      c AS (SELECT media_id, lower(c) AS folded, min(c) AS c, min(date_start) AS f FROM g
        WHERE c IS NOT NULL GROUP BY ALL),
      cc AS (SELECT media_id, string_agg(c, ',' ORDER BY f NULLS LAST, c) AS codes FROM c GROUP BY 1),
      l AS (SELECT media_id, string_agg(DISTINCT name, ',' ORDER BY name) AS names
        FROM (SELECT * FROM media_language WHERE lower(media_type) = 'book') b
        LEFT JOIN ma_language x ON x.id = language_id GROUP BY 1)
      SELECT m.id, cc.codes AS restrict_country_code, l.names AS languages
      FROM book m LEFT JOIN cc ON cc.media_id = m.id LEFT JOIN l ON l.media_id = m.id"""
    for doc in ROOTS:
        q[f"doc_{doc}"] = flat(doc)
        q[f"doc_{doc}_nested"] = nested(doc)
    q["doc_song_by_id"] = flat("song", by_song=True)
    q["bucketed_doc_movie"] = q["doc_movie"]
    for doc in ("book", "game", "song", "album"):
        q[f"shared_doc_{doc}"] = q[f"doc_{doc}"]
    q["conformance"] = conformance()
    q["rebuild_all"] = W + "\n" + " UNION ALL ".join(
        f"SELECT '{doc}' AS doc, count(*) AS n_docs FROM {table}" + (
            " SEMI JOIN music_album a ON a.id = music.album_id" if doc == "song" else "")
        for doc, (table, _, _) in ROOTS.items())
    return q
