"""Document shapes.

* ``nested``: dotted labels become nested structs (any depth), ``[]``
  labels are arrays - the document as it is indexed;
* flat (``Document.df``): one column per label (``people.author[]`` -> ``people_author``),
  lists kept as arrays;
* ``comparable``: flat, lists rendered as comma-joined text in list order,
  for engine-to-engine comparison only (a comma inside a value is not
  escaped there; the nested form never splits a value).
"""

from __future__ import annotations

import json
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.lists import as_text
from ..operators.assemble import Document
from .model import flat_name


def _path(label: str) -> list[str]:
    return label.replace("[]", "").split(".")


def label_tree(labels) -> dict:
    """Ordered tree of label paths; leaves hold the flat column name."""
    tree: dict = {}
    for lab in labels:
        parts = _path(lab)
        node = tree
        for p in parts[:-1]:
            nxt = node.setdefault(p, {})
            if not isinstance(nxt, dict):
                raise ValueError(f"label {lab!r} nests under the value {p!r}")
            node = nxt
        if parts[-1] in node:
            raise ValueError(f"label {lab!r} occurs twice")
        node[parts[-1]] = flat_name(lab)
    return tree


def _build(node: dict):
    cols = []
    for name, sub in node.items():
        if isinstance(sub, dict):
            cols.append(F.struct(*_build(sub)).alias(name))
        else:
            cols.append(F.col(sub).alias(name))
    return cols


def nested(doc: Document) -> DataFrame:
    return doc.df.select(*_build(label_tree(doc.labels)))


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, ArrayType):
            pairs = isinstance(f.dataType.elementType, StructType)
            cols.append(as_text(F.col(f.name), pairs).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def json_text(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def as_json(doc: Document) -> DataFrame:
    """``_id`` and the nested document as JSON text; NULL fields are kept.  Lists that were
    rendered with ``json_text`` go into it as they are."""
    whole = _object(label_tree(doc.labels), {flat_name(x) for x in doc.rendered})
    return doc.df.select(F.col("_id"), whole.alias("doc"))


def _object(node: dict, rendered: set) -> Column:
    """The JSON text of an object: fields between rendered ones by one ``to_json``."""
    def ready(sub) -> bool:
        return any(map(ready, sub.values())) if isinstance(sub, dict) else sub in rendered

    if not ready(node):
        return json_text(F.struct(*_build(node)))
    parts: list[Column] = []   # of one concat, which copies a long text once
    for alone, fields in groupby(node.items(), key=lambda f: ready(f[1])):
        if not alone:
            text = json_text(F.struct(*_build(dict(fields))))
            inner = F.substring(text, F.lit(2), F.length(text) - F.lit(2))   # without its braces
            parts += [F.lit("," if parts else "{"), inner]
            continue
        for name, sub in fields:
            value = _object(sub, rendered) if isinstance(sub, dict) else F.coalesce(F.col(sub), F.lit("null"))
            name = json.dumps(name, ensure_ascii=False)
            parts += [F.lit(f"{',' if parts else '{'}{name}:"), value]
    return F.concat(*parts, F.lit("}"))
