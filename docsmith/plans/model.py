"""Declarative description of a document.

A document is a root table plus *branches*.  A branch is a relation reached
from the root through one key (a bridge table and the dimensions it points
to, a 1:N child table, or an N:1 lookup).  Each branch is aggregated to one
row per key before it meets the root, so the cost of a document grows with
the sum of its relations, not with their product.

References inside a branch are ``"column"`` for the branch table and
``"table.column"`` for a joined one; no table occurs twice in a branch.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Join:
    """Left (or inner) join of another table into a branch."""
    table: str
    on: tuple            # ((left reference, right col), ...)
    where: tuple = ()    # ((right col, constant), ...) applied to the right side
    how: str = "left"
    # fold=True: the right side has 0..n rows per join key.  It is first
    # aggregated to one row per key (value sets + row count), so the join
    # never multiplies rows; the count re-enters only as a weight.
    fold: bool = False
    # ((col, "id" | "name"), ...): right-side columns holding the media type;
    # their constants in ``where`` belong to one type (see ``Branch.kind_cols``)
    kind_cols: tuple = ()


@dataclass(frozen=True)
class Out:
    """One document field computed by a branch.

    agg: ``distinct`` sorted distinct list; ``distinct_text`` the same with the
    values rendered as text; ``count_distinct``; ``any`` one value of a column
    that is constant per key (deterministically the smallest); ``any_list``
    that value as a one-element list."""
    label: str
    ref: str
    agg: str = "distinct"


@dataclass(frozen=True)
class Branch:
    name: str
    table: str
    key: str                      # branch column matched against the root
    root_ref: str = "id"          # root column it is matched with
    where: tuple = ()             # ((col, constant), ...) on the branch table
    joins: tuple = ()
    outs: tuple = ()
    fanout: bool = True           # counts in the original join multiplicity
    kind: str = "list"            # list | restriction | scores
    exists_label: str | None = None
    # restriction branches: field references
    type_ref: str | None = None
    country_ref: str | None = None
    date_ref: str | None = None
    # restriction branch label prefix and date mode ("doc" = per options)
    dates_mode: str = "doc"
    # score branches: ((device name, device id), ...) and the value column
    devices: tuple = ()
    value_ref: str | None = None
    device_ref: str | None = None
    label_prefix: str = "sorting_score"
    # ((col, "id" | "name"), ...): branch-table columns holding the media type.
    # A branch with kind columns can be built once for all types, keyed by
    # (type, key), and shared by the documents of every type.
    kind_cols: tuple = ()


@dataclass(frozen=True)
class RootJoin:
    """Inner/left join that widens the root itself (songs: the album)."""
    table: str
    on: tuple                     # ((root col, right col), ...)
    select: tuple                 # ((right col, new root col), ...)
    how: str = "inner"


@dataclass(frozen=True)
class DocSpec:
    doc: str                      # book, album, movie, game, software, song
    root: str                     # root table
    kind: str                     # media kind for ids/names (book, music, ...)
    key_parts: tuple              # _id parts: constants (str) and root columns
    key_style: str = "concat"     # concat (NULL if a part is NULL) | concat_ws
    fields: tuple = ()            # ordered (label, source) pairs; see assemble
    branches: tuple = ()
    root_joins: tuple = ()
    text_fields: tuple = ()       # ((label, root col), ...): a root value as text
    grouped: bool = True          # False: no GROUP BY in the original (songs)
    legacy_dup: Branch | None = None   # join kept only for its row multiplication


def flat_name(label: str) -> str:
    """Flat column name of a document label: ``people.author[]`` -> ``people_author``."""
    return label.replace("[]", "").replace(".", "_")
