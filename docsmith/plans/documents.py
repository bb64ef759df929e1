"""Public entry points for building documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.lists import as_text
from ..operators.assemble import Document, assemble
from ..params import Options, Params
from ..sources.catalogue import Catalogue
from . import shape
from .specs import spec_for


def build(cat: Catalogue, doc: str, params: Params | None = None, options: Options | None = None,
          id_range: tuple | None = None, prebuilt: dict | None = None,
          keep_rows: bool = False, render=None) -> Document:
    """Plan the documents of one type (lazy; nothing runs until an action)."""
    spec = spec_for(doc, params, options)
    return assemble(cat, spec, options, id_range=id_range, prebuilt=prebuilt, keep_rows=keep_rows,
                    render=render)


def nested(cat: Catalogue, doc: str, **kw) -> DataFrame:
    return shape.nested(build(cat, doc, **kw))


def comparable(cat: Catalogue, doc: str, **kw) -> DataFrame:
    return shape.comparable(build(cat, doc, render=as_text, **kw).df)


def as_json(cat: Catalogue, doc: str, **kw) -> DataFrame:
    return shape.as_json(build(cat, doc, render=shape.json_text, **kw))
