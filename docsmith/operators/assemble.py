"""Assemble a document: root + aggregated branches, all joined on their key.

Plan shape: every branch is an aggregate keyed by the join key, so the root
meets each of them in a left join on an already hash-partitioned input; the
joins on the item id reuse one partitioning of the root.  N:1 lookups (keyed
by a different root column) are joined first, while the root is still
narrow; below the broadcast threshold AQE turns them into broadcast joins.

The list that a folded chain takes from its last table depends on the set of keys
an item has there.  Items carry that set through the joins; the lists, one per
different set, are joined last.  They are asked for their size first, because a
broadcast that Spark only finds out about at run time would come after the
documents were shuffled for them.  A shape that shows them as text has them rendered
before that join, once per set: documents are many, and each list is long.

Non-distinct date lists need the multiplicity of the original many-way join:
for item r it is the product, over all other fan-out branches, of their row
counts (1 when empty).  Dates are (date, times) pairs, which carry it without
an entry per joined row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.keys import doc_key
from ..functions.lists import multiset, ordered_values, product
from ..params import Options
from ..plans.model import Branch, DocSpec, flat_name
from ..sources.catalogue import NO_CASE, Catalogue, plain
from ..sources.ranges import in_range
from .branch import (RELATION_BYTES, build_branch, build_counts, countries_col, dates_col, estimate, folded_out,
                     is_lookup, key_col, n_col, set_col, type_col, united_lists, united_values)
from .lookup import checked

ROWS = "__joined_rows"


class LabelCollision(ValueError):
    pass


@dataclass
class Document:
    spec: DocSpec
    df: DataFrame          # flat columns named by flat labels, lists as arrays
    labels: list           # document labels, in output order
    root_columns: list     # the pass-through root columns
    lookups: list          # the N:1 lookups
    full: DataFrame        # df with the row count of every lookup
    rendered: tuple = ()   # labels whose column holds what ``render`` made of their list


def observed(document: Document, observation: Observation) -> Document:
    """The document whose next action also fills ``observation``: the number of
    documents (``n``), of documents with a value per field (``f0``, ``f1``, ... in the
    order of the labels), with a NULL key (``no_key``) and, per lookup, of those whose
    key had several rows (``r0``, ...)."""
    df = document.full
    names = [flat_name(x) for x in document.labels]
    counts = [F.count(F.col(f"`{n}`")).alias(f"f{i}") for i, n in enumerate(names)]
    repeated = [F.count(F.when(F.col(f"__n_{x}") > 1, 1)).alias(f"r{i}")
                for i, x in enumerate(document.lookups)]
    no_key = F.count(F.when(F.col("_id").isNull(), 1)).alias("no_key")
    df = df.observe(observation, F.count(F.lit(1)).alias("n"), no_key, *counts, *repeated)
    return replace(document, df=df.select(*[F.col(f"`{c}`") for c in document.df.columns]))


# A full rebuild reads ids from 0, as the original's segment loop did.  There is
# no upper bound: rows that arrive after a probe must not be lost.
FULL_RANGE = (0, None)


def _factor(b: Branch) -> Column:
    return F.coalesce(F.col(n_col(b)), F.lit(1).cast("long"))


#: Lists of key sets are broadcast up to this many bytes, at so many a value.
LISTS_BYTES, VALUE_BYTES = 64 * 1024 * 1024, 32


def _few_items(cat: Catalogue, b: Branch, root: DataFrame, asked: dict) -> DataFrame | None:
    """The root's ids, if the branch reads a large relation and they are few enough for a
    broadcast: rows of other items, which no document would show, are then not shuffled.
    ``asked`` holds their number once it was asked for."""
    if b.root_ref != "id":
        return None
    if estimate(cat[b.table]) < RELATION_BYTES:
        return None
    items = root.select(F.col("id").alias("__item"))
    return items if items_are_few(cat, items, asked) else None


def items_are_few(cat: Catalogue, items: DataFrame, asked: dict, name="items") -> bool:
    """Whether the items are few enough for a broadcast (never, where the session broadcasts
    nothing).  ``asked`` holds their number by ``name`` once it was asked for."""
    if cat.spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    if name not in asked:
        asked[name] = items.count()
    return asked[name] * VALUE_BYTES <= LISTS_BYTES


def _few(cat: Catalogue, b: Branch, staged: DataFrame | None, items: DataFrame | None,
         render: Callable[[Column], Column] | None = None) -> bool:
    """Whether the lists of a branch's key sets are small enough for a broadcast (none
    is, where the session broadcasts nothing).  Staged lists are counted, those of a
    catalogue asked for once.  Rendered lists are as large as their text."""
    if cat.spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    if staged is not None:
        size = F.greatest(F.size("__list"), F.lit(0)) * F.lit(VALUE_BYTES) if render is None \
            else F.coalesce(F.octet_length(render(F.col("__list"))), F.lit(0))
        found = staged.agg(F.sum((F.size("__of") * F.lit(VALUE_BYTES) + size).cast("long"))).first()[0]
        return (found or 0) <= LISTS_BYTES
    if items is not None:   # its range belongs to this document
        members, values, text = united_values(cat, b, items)
    else:
        if b not in cat.measured:
            cat.measured[b] = united_values(cat, b)
        members, values, text = cat.measured[b]
    return members * VALUE_BYTES + (values * VALUE_BYTES if render is None else text) <= LISTS_BYTES


def _shows(b: Branch, spec: DocSpec) -> bool:
    """Whether a document shows a value of the branch, more than the number of its rows."""
    if b.kind == "scores":
        return True
    read = {f[0] if isinstance(f, tuple) else f for f in spec.fields}
    read |= {f[1][1:] for f in spec.fields if isinstance(f, tuple) and isinstance(f[1], str)}
    own = RESTRICT if b.kind == "restriction" else [o.label for o in b.outs]
    return not read.isdisjoint(own)


RESTRICT = ("restrict.type", "restrict.country_code[]", "restrict.date[]")

CHANGED = "rows came to a table while its documents were built"


def assemble(cat: Catalogue, spec: DocSpec, options: Options | None = None,
             id_range: tuple | None = None, prebuilt: dict | None = None,
             keep_rows: bool = False, render: Callable[[Column], Column] | None = None) -> Document:
    """``render`` turns the lists of key sets into what is asked of them, at most their text
    (one that is a NULL stays one); ``Document.rendered`` names their labels."""
    o = options or Options()
    prebuilt = prebuilt or {}
    if o.case_insensitive:
        cat = cat.collated(NO_CASE)
    root = cat[spec.root]
    root_cols = list(root.columns)
    root = root.where(in_range("id", *(id_range or FULL_RANGE)))
    if o.override:
        # a computed field replaces a root column of its name
        computed = {flat_name(f[0] if isinstance(f, tuple) else f).lower()
                    for f in spec.fields if f != "*"}
        root_cols = [c for c in root_cols if c == "id" or c.lower() not in computed]

    ids, asked = root, {}

    def items_of(b: Branch) -> DataFrame | None:
        return None if spec.root_joins else _few_items(cat, b, ids, asked)

    def with_branches(df: DataFrame, branches) -> DataFrame:
        for b in branches:
            agg = prebuilt.get(b.name)
            if agg is None:
                build = build_branch if _shows(b, spec) else build_counts
                agg = build(cat, b, items=items_of(b))
            own = {c: f"__f_{c}" for c in agg.columns if not c.startswith("__")}
            agg = agg.withColumnsRenamed(own)
            df = df.join(agg, F.col(b.root_ref) == F.col(key_col(b)), "left").drop(key_col(b))
        return df

    # Branches keyed by a column of a joined table meet that table, one row per
    # key, before the root does: the root (songs of a hot album) is then joined
    # once, in a join that AQE can split.  The others follow: N:1 lookups while
    # the root is narrow, then the id-keyed branches, which share one exchange.
    left = list(spec.branches)
    for rj in spec.root_joins:
        right = cat[rj.table].select(
            *[F.col(rc).alias(f"__on_{rc}") for _, rc in rj.on],
            *[F.col(src).alias(new) for src, new in rj.select])
        theirs = [b for b in left if b.root_ref in {new for _, new in rj.select}]
        left = [b for b in left if b not in theirs]
        right = with_branches(right, sorted(theirs, key=lambda b: b.root_ref))
        cond = reduce(lambda a, c: a & c, [F.col(lc) == F.col(f"__on_{rc}") for lc, rc in rj.on])
        root = root.join(right, cond, rj.how).drop(*[f"__on_{rc}" for _, rc in rj.on])
    root = with_branches(root, sorted(left, key=lambda b: b.root_ref == "id"))

    if spec.legacy_dup is not None:
        # kept only for the rows it repeats: selects nothing
        d = spec.legacy_dup
        dup = cat[d.table]
        for c, v in d.where:
            dup = dup.where(F.col(c) == F.lit(v))
        dup = dup.select(F.col(d.key).alias("__dup_k"))
        root = root.join(dup, F.col(d.root_ref) == F.col("__dup_k"), "left").drop("__dup_k")

    named = {f[0] if isinstance(f, tuple) else f for f in spec.fields}
    rendered = []
    for b in spec.branches:
        united = folded_out(b)
        if united is None or united.label not in named:
            continue
        name = flat_name(united.label)
        lists = prebuilt.get(set_col(b))
        items = items_of(b) if lists is None else None
        if lists is None:
            lists = united_lists(cat, b, items=items)
        lists = lists.select(F.col(set_col(b)).alias("__of"), F.col(name).alias("__list"))
        few = _few(cat, b, lists if set_col(b) in prebuilt else None, items, render)
        if render is not None:
            lists = lists.withColumn("__list", render(F.col("__list")))
            rendered.append(united.label)
        if few:
            lists = F.broadcast(lists)
        # a set without a list came after the lists were read
        lost = F.col(set_col(b)).isNotNull() & F.col("__of").isNull()
        root = root.join(lists, F.col(set_col(b)) == F.col("__of"), "left").withColumn(
            f"__f_{name}", F.when(lost, F.raise_error(F.lit(CHANGED))).otherwise(F.col("__list"))) \
            .drop("__of", "__list", set_col(b))

    fan = [b for b in spec.branches if b.fanout]
    exprs: dict[str, Column] = {}
    for b in spec.branches:
        for out in b.outs:
            if out is folded_out(b) and out.label not in named:
                continue
            c = F.col(f"__f_{flat_name(out.label)}") if not out.label.startswith("__") \
                else F.col(out.label)
            # a count over no rows is 0, not NULL
            exprs[out.label] = F.coalesce(c, F.lit(0).cast("long")) if out.agg == "count_distinct" else c
        if b.exists_label:
            exprs[b.exists_label] = F.when(F.col(n_col(b)).isNull(), F.lit(0)).otherwise(F.lit(1))
        if b.kind == "scores":
            for name, _ in b.devices:
                lab = f"{b.label_prefix}.{name}"
                exprs[lab] = checked(b, F.col(f"__f_{flat_name(lab)}"))
        if b.kind == "restriction":
            mode = o.dates if (b.dates_mode == "doc" and spec.grouped) else "clean"
            times = product([_factor(x) for x in fan if x is not b]) if mode == "exact" else None
            exprs |= dict(zip(RESTRICT, (F.col(type_col(b)), ordered_values(F.col(countries_col(b))),
                                         multiset(F.col(dates_col(b)), times))))

    labels, cols = [], []
    for f in spec.fields:
        if f == "*":
            for c in root_cols:
                labels.append(c)
                cols.append(F.col(c))
            continue
        if isinstance(f, tuple):
            label, val = f
            e = F.col(val[1:]) if isinstance(val, str) and val.startswith("@") else F.lit(val)
        elif f == "_id":
            label, e = f, doc_key(spec.key_parts, spec.key_style)
        elif f in dict(spec.text_fields):
            label, e = f, F.col(dict(spec.text_fields)[f]).cast("string")
        else:
            label, e = f, exprs[f]
        labels.append(label)
        cols.append(e)

    names = [flat_name(lab) for lab in labels]
    lower = [n.lower() for n in names]  # Spark, like the target, ignores case
    dupes = sorted({n for n in names if lower.count(n.lower()) > 1})
    if dupes:
        raise LabelCollision(f"{spec.doc}: duplicate output fields {dupes}")
    if o.case_insensitive:   # documents hold plain text
        kinds = root.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).schema.fields
        cols = [plain(c) if isinstance(f.dataType, StringType) else c for c, f in zip(cols, kinds)]
    out = [c.alias(n) for c, n in zip(cols, names)]
    if keep_rows:
        out.append(product([_factor(b) for b in fan]).alias(ROWS))
    lookups = [b.name for b in spec.branches if is_lookup(b)]
    full = root.select(*out, *[F.col(n_col(b)) for b in spec.branches if b.name in lookups])
    return Document(spec, full.drop(*[n_col(b) for b in spec.branches if b.name in lookups]), labels,
                    root_cols, lookups, full, tuple(rendered))
