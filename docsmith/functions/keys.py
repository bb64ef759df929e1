"""Document keys.

``concat``: ``<media type id>-<id>``; NULL when a part is NULL, like SQL
``CONCAT``.  ``concat_ws``: parts joined with ``-``, NULL parts skipped,
like ``CONCAT_WS`` (songs: ``<media type id>-<album id>-<song id>``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "-"


def _part(p) -> Column:
    kind, value = p
    return F.lit(str(value)) if kind == "lit" else F.col(value).cast("string")


def doc_key(parts, style: str = "concat") -> Column:
    cols = [_part(p) for p in parts]
    if style == "concat_ws":
        return F.concat_ws(SEPARATOR, *cols)
    if style != "concat":
        raise ValueError(f"unknown key style {style!r}")
    seq = []
    for i, c in enumerate(cols):
        if i:
            seq.append(F.lit(SEPARATOR))
        seq.append(c)
    return F.concat(*seq)
