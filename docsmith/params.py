"""Job parameters.

The original job reads every name and id from a configuration file that is
not part of its repository, so nothing here is a constant of the job: all of
it is a parameter with a stand-in default.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace


# Fixed stand-in values (the original configuration is not published).
# Media-type ids: book=1, music=2, movie=3, game=4, software=5.
# Media-type names: book, music, movie, game, software.
# Device ids: pc=1, mobile=2, tablet=3, mac=4, console=5; default device pc.
# Segment size (ids per range statement): 1000.
DEFAULT_MEDIA_IDS = {"book": 1, "music": 2, "movie": 3, "game": 4, "software": 5}
DEFAULT_MEDIA_NAMES = {"book": "book", "music": "music", "movie": "movie",
                       "game": "game", "software": "software"}
DEFAULT_DEVICES = (("pc", 1), ("mobile", 2), ("tablet", 3), ("mac", 4), ("console", 5))
DEFAULT_DEVICE_ID = 1
DEFAULT_SEGMENT_SIZE = 1000

# The six document types, the root table of each, and the media kind whose
# id/name the shared tables use for it.  Songs and albums are both "music".
DOCUMENT_ROOTS = {
    "book": ("book", "book"),
    "movie": ("movie", "movie"),
    "game": ("game", "game"),
    "software": ("software", "software"),
    "album": ("music_album", "music"),
    "song": ("music", "music"),
}
# Rebuild order of the full job.
REBUILD_ORDER = ("book", "movie", "game", "software", "album", "song")


@dataclass(frozen=True)
class Params:
    media_ids: dict = field(default_factory=lambda: dict(DEFAULT_MEDIA_IDS))
    media_names: dict = field(default_factory=lambda: dict(DEFAULT_MEDIA_NAMES))
    devices: tuple = DEFAULT_DEVICES
    default_device_id: int = DEFAULT_DEVICE_ID
    segment_size: int = DEFAULT_SEGMENT_SIZE
    # Score table per media kind; the test catalogue has one shared table.
    score_tables: dict = field(default_factory=lambda: {
        "book": "scores", "music": "scores", "movie": "scores",
        "game": "scores", "software": "scores"})
    geo_restrict_table: str = "media_geo_restrict"
    # Media name the album licensor join compares with.  None means the music
    # name; the original compared with a setting used nowhere else.
    album_licensor_media_name: str | None = None

    def media_id(self, kind: str) -> int:
        return int(self.media_ids[kind])

    def media_name(self, kind: str) -> str:
        return str(self.media_names[kind])

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    @classmethod
    def from_json(cls, path: str) -> "Params":
        """Parameters from a JSON file; what it leaves out keeps its default."""
        with open(path) as f:
            given = json.load(f)
        unknown = sorted(set(given) - {x.name for x in fields(cls)})
        if unknown:
            raise ValueError(f"unknown parameters {unknown}")
        if "devices" in given:
            given["devices"] = tuple((str(n), int(d)) for n, d in given["devices"])
        return cls(**given)


@dataclass(frozen=True)
class Options:
    """Behaviour switches: corrected by default, original behaviour on request."""

    # "exact": a date counts once per combination of the other joined relations,
    # as in the original many-way join.  "clean": once per restriction row.
    dates: str = "exact"
    # Songs: match artists/genres on the album id (original) or the song id.
    song_match: str = "album_id"
    # Songs: the original spelled the label "contry_code".
    legacy_labels: bool = False
    # Songs: keep the score join that selects nothing but can repeat a song.
    legacy_rows: bool = False
    # Albums: reproduce the licensor join that never matched.
    legacy_licensor: bool = False
    # Case-insensitive lists, constants and countries (MySQL's usual collation).
    case_insensitive: bool = False
    # A root column with the name of a computed field is replaced by it; by
    # default it is an error.
    override: bool = False

    def __post_init__(self):
        if self.dates not in ("exact", "clean"):
            raise ValueError(f"dates must be 'exact' or 'clean', not {self.dates!r}")
        if self.song_match not in ("album_id", "id"):
            raise ValueError(f"song_match must be 'album_id' or 'id', not {self.song_match!r}")
