"""Branch operator: a relation of the root, aggregated to one row per key.

Output columns of ``build_branch``:

* ``__k_<name>``  the key (matched against ``root_ref`` of the root);
* ``__n_<name>``  joined rows behind the key, dangling dimension rows and
  the multiplication inside a join chain included - the factor this branch
  contributed to the original many-way join;
* one column per ``Out`` (named by the flat label); for the list of a folded
  table ``__set_<name>`` instead, the sorted keys whose values it unites (see
  ``united_lists``); or for restriction branches ``__dates_<name>`` (date text, rows), ``__countries_<name>`` (country,
  first date) and ``__type_<name>``.

Every aggregation below is partial (map-side) first, so a key that holds a
large share of the rows is combined before the shuffle.  Lists stay
distinct sets (or compressed ``(value, times)`` pairs) until they are emitted.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.lists import finish_distinct, spelled
from ..plans.model import Branch, Join, Out, flat_name
from ..sources.catalogue import Catalogue, plain


OWN = "own"  # prefix of the branch table's own columns


def table_of(ref: str) -> str:
    return ref.rpartition(".")[0] or OWN


def col_name(ref: str) -> str:
    return f"{table_of(ref)}__{ref.rpartition('.')[2]}"


def key_col(b: Branch) -> str:
    return f"__k_{b.name}"


def n_col(b: Branch) -> str:
    return f"__n_{b.name}"


def set_col(b: Branch) -> str:
    return f"__set_{b.name}"


def dates_col(b: Branch) -> str:
    return f"__dates_{b.name}"


def countries_col(b: Branch) -> str:
    return f"__countries_{b.name}"


def type_col(b: Branch) -> str:
    return f"__type_{b.name}"


def _refs(b: Branch) -> list[str]:
    refs = [b.key] + [c for c, _ in b.where]
    for j in b.joins:
        refs += [left for left, _ in j.on]
        refs += [f"{j.table}.{r}" for _, r in j.on]
        refs += [f"{j.table}.{c}" for c, _ in j.where]
    refs += [o.ref for o in b.outs]
    refs += [r for r in (b.type_ref, b.country_ref, b.date_ref, b.value_ref, b.device_ref) if r]
    return refs


def _needed(b: Branch) -> dict[str, list[str]]:
    need: dict[str, list[str]] = {}
    for r in _refs(b):
        table, col = table_of(r), r.rpartition(".")[2]
        need.setdefault(table, [])
        if col not in need[table]:
            need[table].append(col)
    return need


KIND = "__kind"


class Kinds:
    """Media-type ids and names, for branches built once for several types.

    In shared mode the media-type constants of a branch are dropped; each
    row carries its type id in ``__kind`` instead, which joins on the other
    tables' media-type columns and becomes part of the group key."""

    def __init__(self, params, kinds):
        self.ids = {k: params.media_id(k) for k in kinds}
        self.names = {k: params.media_name(k) for k in kinds}

    # equalities, not map lookups: they follow the collation of the column
    def to_id(self, col: Column, form: str) -> Column:
        if form == "id":
            return F.when(col.cast("int").isin(list(self.ids.values())), col.cast("int"))
        return F.coalesce(*[F.when(col == F.lit(self.names[k]), F.lit(self.ids[k])) for k in self.ids])

    def from_id(self, kind: Column, form: str) -> Column:
        if form == "id":
            return kind
        return F.coalesce(*[F.when(kind == F.lit(self.ids[k]), F.lit(self.names[k])) for k in self.ids])


def _table(cat: Catalogue, table: str, prefix: str, where: tuple, cols: list[str],
           skip: set = frozenset()) -> DataFrame:
    df = cat[table]
    for c, v in where:
        if c not in skip:
            df = df.where(F.col(c) == F.lit(v))
    return df.select([F.col(c).alias(f"{prefix}__{c}") for c in cols])


def of_items(rows: DataFrame, key: str, items: DataFrame | None) -> DataFrame:
    """``rows`` whose key is among ``items`` (one column, few enough for a broadcast),
    so that no others are shuffled; all rows without ``items``."""
    if items is None:
        return rows
    return rows.join(F.broadcast(items), F.col(key) == F.col(items.columns[0]), "left_semi")


def of_kinds(rows: DataFrame, key: str, items: dict[int, DataFrame] | None) -> DataFrame:
    """``rows`` without those of a kind in ``items`` whose key is not among its items (one
    column, few enough for a broadcast); rows of other kinds stay."""
    for kind, ids in (items or {}).items():
        own, ids = F.col(KIND) == F.lit(kind), ids.select(F.col(ids.columns[0]).alias("__item")).distinct()
        rows = rows.join(F.broadcast(ids), own & (F.col(key) == F.col("__item")), "left") \
            .where(~own | F.col("__item").isNotNull()).drop("__item")
    return rows


#: Relations from this size on (by Catalyst's estimate) are worth a question before their shuffle.
RELATION_BYTES = 16 * 1024 * 1024

#: A dimension is broadcast up to this many bytes: its text, and so many a row beside it.
DIMENSION_BYTES, ROW_BYTES = 64 * 1024 * 1024, 32


def estimate(df: DataFrame) -> int:
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def _broadcast_small(cat: Catalogue, b: Branch, j: Join, right: DataFrame) -> tuple[DataFrame, bool]:
    """``right``, the other side of join ``j`` of branch ``b``, marked for a broadcast if it is
    small; whether it is.  Spark would find out at run time, after the rows of the branch
    were shuffled for the join.  Only large relations are worth the question, and the
    session's own limit needs none."""
    limit = cat.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-") or estimate(cat[b.table]) < RELATION_BYTES:
        return right, False
    asked = ("small", j, tuple(right.columns))
    if asked not in cat.measured:
        text = [F.sum(F.octet_length(F.col(f.name))) for f in right.schema.fields if isinstance(f.dataType, StringType)]
        row = right.agg(F.count(F.lit(1)), *text).first()
        cat.measured[asked] = row[0] * ROW_BYTES + sum(x or 0 for x in row[1:])
    small = cat.measured[asked] <= DIMENSION_BYTES
    return (F.broadcast(right) if small else right), small


def joined_rows(cat: Catalogue, b: Branch, fold: bool = False, kinds: Kinds | None = None,
                items: DataFrame | dict | None = None, counted: bool = False) -> DataFrame:
    """The branch's rows before aggregation: the branch table (filtered on
    its constants) joined with its dimensions, one row per joined row.

    With ``fold``, joins marked ``fold`` meet a right side already reduced to one
    row per key, its row count; its values are left to ``united_lists``.  Equal
    rows of the branch table are one row before a join that shuffles them.
    ``__w`` is the number of joined rows that a row stands for.

    With ``counted``, no value is needed but ``__w``: the last joins of all chains
    are folded, those on the left without the keys that leave the number of rows as it is.

    With ``kinds``, the media-type constants are replaced by a ``__kind``
    column (see ``Kinds``), and ``items`` are by kind."""
    need = _needed(replace(b, outs=(), type_ref=None, country_ref=None, date_ref=None) if counted else b)
    if kinds is not None:
        if not b.kind_cols:
            raise ValueError(f"branch {b.name!r} has no media-type column to share on")
        for table, kc in [(OWN, b.kind_cols)] + [(j.table, j.kind_cols) for j in b.joins]:
            for c, _ in kc:
                need.setdefault(table, [])
                if c not in need[table]:
                    need[table].append(c)
    skip = {c for c, _ in b.kind_cols} if kinds is not None else set()
    df = _table(cat, b.table, OWN, b.where, need[OWN], skip)
    df = df.where(F.col(col_name(b.key)).isNotNull())
    if kinds is None:
        df = of_items(df, col_name(b.key), items)
    else:
        c, form = b.kind_cols[0]
        df = df.withColumn(KIND, kinds.to_id(F.col(f"{OWN}__{c}"), form)).where(
            F.col(KIND).isNotNull())
        df = of_kinds(df, col_name(b.key), items)
    inner = {table_of(left) for j in b.joins for left, _ in j.on}   # tables that a later join needs
    rights, shuffled = {}, False
    for j in b.joins:
        jskip = {c for c, _ in j.kind_cols} if kinds is not None else set()
        right = _table(cat, j.table, j.table, j.where, need.get(j.table, []), jskip)
        if j.table not in inner if counted else fold and j.fold:
            keys = [f"{j.table}__{r}" for _, r in j.on] + [f"{j.table}__{c}" for c in jskip]
            right = right.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"__jn_{j.table}"))
            if counted and j.how == "left":
                right = right.where(F.col(f"__jn_{j.table}") > 1)
        rights[j.table], small = _broadcast_small(cat, b, j, right)
        shuffled = shuffled or not small
    if fold and shuffled:
        later = {col_name(r) for j in b.joins for r, _ in j.on} | {col_name(o.ref) for o in b.outs}
        held = [c for c in df.columns if c == KIND or c == col_name(b.key) or c in later]
        df = df.groupBy(*held).agg(F.count(F.lit(1)).alias("__rows"))
    weight = F.col("__rows") if fold and shuffled else F.lit(1).cast("long")
    folded: set = set()
    for j in b.joins:
        right = rights[j.table]
        for left, _ in j.on:
            if table_of(left) in folded:
                raise ValueError(f"branch {b.name!r}: cannot join on folded table {left!r}")
        conds = [F.col(col_name(left)) == F.col(f"{j.table}__{r}") for left, r in j.on]
        if kinds is not None:
            conds += [F.col(f"{j.table}__{c}") == kinds.from_id(F.col(KIND), form)
                      for c, form in j.kind_cols]
        cond = reduce(lambda a, c: a & c, conds)
        if f"__jn_{j.table}" in right.columns:
            weight = weight * F.coalesce(F.col(f"__jn_{j.table}"), F.lit(1).cast("long"))
            folded.add(j.table)
        df = df.join(right, cond, j.how)
    if fold or counted:
        df = df.withColumn("__w", weight)
    return df


def build_counts(cat: Catalogue, b: Branch, items: DataFrame | None = None) -> DataFrame:
    """``build_branch`` without its values, for documents that show none of them: the
    key and the number of joined rows behind it."""
    rows = joined_rows(cat, b, items=items, counted=True)
    return rows.groupBy(F.col(col_name(b.key)).alias(key_col(b))).agg(F.sum("__w").alias(n_col(b)))


def _collated(df: DataFrame, c: str) -> bool:
    return _is_collated(df.schema[c].dataType)


def folded_tables(b: Branch) -> set:
    return {j.table for j in b.joins if j.fold}


def folded_out(b: Branch) -> Out | None:
    """The list whose values come from the folded table of a chain."""
    inside = [o for o in b.outs if table_of(o.ref) in folded_tables(b)]
    if len(inside) > 1 or (folded_tables(b) and any(len(j.on) != 1 for j in b.joins if j.fold)):
        raise ValueError(f"branch {b.name!r}: a folded chain has one list from the folded table, "
                         f"which is joined on one column")
    return inside[0] if inside else None


LISTS = ("distinct", "distinct_text")
LOOKUP = ("any", "any_list")


def is_lookup(b: Branch) -> bool:
    """A branch whose values come from the one row of its key."""
    return bool(b.outs) and all(o.agg in LOOKUP for o in b.outs)


def build_branch(cat: Catalogue, b: Branch, kinds: Kinds | None = None,
                 items: DataFrame | dict | None = None) -> DataFrame:
    """One row per key (per (``__kind``, key) with ``kinds``), of the keys in ``items``
    if they are given (by kind, with ``kinds``)."""
    if b.kind == "restriction":
        return _build_restriction(cat, b, kinds, items)
    if b.kind == "scores":
        from .lookup import score_pivot
        return score_pivot(cat, b, items)
    extra = [KIND] if kinds is not None else []
    k = F.col(col_name(b.key)).alias(key_col(b))
    if is_lookup(b):
        return _build_lookup(joined_rows(cat, b, kinds=kinds, items=items), b, [*extra, k])
    only_count_distinct = len(b.outs) == 1 and b.outs[0].agg == "count_distinct"
    if only_count_distinct:
        # Two-level form of COUNT(DISTINCT): (key, value) pairs first, so a hot
        # key never holds its distinct values in one in-memory set.
        rows = joined_rows(cat, b, kinds=kinds, items=items)
        o = b.outs[0]
        v = F.col(col_name(o.ref))
        pairs = rows.groupBy(*extra, k, v.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
        return pairs.groupBy(*extra, key_col(b)).agg(
            F.sum("__c").alias(n_col(b)),
            F.count("__v").alias(flat_name(o.label)))
    if [o.label for o in b.outs if o.agg not in LISTS]:
        raise ValueError(f"branch {b.name!r}: {[o.agg for o in b.outs]} do not go together")
    folded = bool(folded_tables(b))
    rows = joined_rows(cat, b, fold=folded, kinds=kinds, items=items)
    if folded or any(_collated(rows, col_name(o.ref)) for o in b.outs):
        return _build_expanded(rows, b, extra, folded)
    agg = rows.groupBy(*extra, k).agg(F.count(F.lit(1)).alias(n_col(b)), *[
        F.collect_set(col_name(o.ref)).alias(flat_name(o.label)) for o in b.outs])
    return agg.select(*extra, key_col(b), n_col(b), *[
        finish_distinct(F.col(flat_name(o.label)), o.agg == "distinct_text").alias(flat_name(o.label))
        for o in b.outs])


def _build_lookup(rows: DataFrame, b: Branch, keys: list) -> DataFrame:
    """N:1 lookup: all values from one row, the smallest of its key (NULLs last), so
    that a key with several rows never mixes them.  ``n`` says how many there were."""
    order = [x for o in b.outs for x in (F.col(col_name(o.ref)).isNull(), plain(F.col(col_name(o.ref)))
                                         if _collated(rows, col_name(o.ref)) else F.col(col_name(o.ref)))]
    row = F.struct(*[x.alias(f"x{i}") for i, x in enumerate(order)])
    agg = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_col(b)), F.min(row).alias("__row"))
    outs = []
    for i, o in enumerate(b.outs):
        v = F.col("__row").getField(f"x{2 * i + 1}")
        outs.append((v if o.agg == "any" else F.when(v.isNotNull(), F.array(v))).alias(flat_name(o.label)))
    return agg.select(*[c for c in agg.columns if c not in (n_col(b), "__row")], n_col(b), *outs)


def _build_expanded(rows: DataFrame, b: Branch, extra: list[str], folded: bool) -> DataFrame:
    """Several lists, or lists of collated text, as one stream of (key, list, value)
    entries: the aggregate by entry spreads a hot key over its values, and only its
    distinct values, which the document carries, meet at the key.  The list of a
    folded table is that of the keys it is joined on: its values, however many, are
    neither exploded nor shuffled by item."""
    united = folded_out(b) if folded else None
    on = {col_name(o.ref): col_name(j.on[0][0]) for o in b.outs if o is united
          for j in b.joins if j.table == table_of(o.ref)}
    columns = [on.get(col_name(o.ref), col_name(o.ref)) for o in b.outs]
    weight = F.col("__w") if folded else F.lit(1).cast("long")
    if not any(_collated(rows, c) for c in [*columns, col_name(b.key)]):
        # equal rows are one, wherever they are, and only then go to their item: what follows
        # needs no shuffle of its entries, which are more and wider than the rows
        held = list(dict.fromkeys([*extra, col_name(b.key), *columns]))
        rows = rows.groupBy(*held).agg(F.sum(weight).alias("__w")).repartition(*extra, col_name(b.key))
        weight = F.col("__w")
    each, kinds = _entries(rows, b, columns, extra, weight)
    spelling = {i for i, kind in enumerate(kinds) if _is_collated(kind)}
    once = each.groupBy(*extra, key_col(b), *[c for c in each.columns if c == "list" or c.startswith("v")]) \
        .agg(F.sum("w").alias("w"), *[F.min(plain(F.col(f"v{i}"))).alias(f"s{i}") for i in sorted(spelling)])
    aggs, outs = [F.sum("w").alias(n_col(b))], []
    for i, o in enumerate(b.outs):
        name = set_col(b) if o is united else flat_name(o.label)
        # every value once: entries of one list have no value of another
        value = F.col(f"v{i}")
        if i in spelling:
            value = F.when(value.isNotNull(), F.struct(value.alias("k"), F.col(f"s{i}").alias("v")))
        aggs.append(F.collect_list(value).alias(name))
        c = F.col(name)
        as_text = o.agg == "distinct_text" and o is not united
        outs.append((spelled(c) if i in spelling else finish_distinct(c, as_text)).alias(name))
    return once.groupBy(*extra, key_col(b)).agg(*aggs).select(*extra, key_col(b), n_col(b), *outs)


def _entries(rows: DataFrame, b: Branch, columns: list[str], extra: list[str],
             weight: Column) -> tuple[DataFrame, list]:
    """One entry per row and list; the first list's entries carry the row count."""
    kinds = [rows.schema[c].dataType for c in columns]
    none = F.lit(0).cast("long")
    entries = [F.struct(F.lit(i).alias("list"), (weight if i == 0 else none).alias("w"), *[
        (F.col(c) if i == j else F.lit(None)).cast(kinds[j]).alias(f"v{j}")
        for j in range(len(kinds))]) for i, c in enumerate(columns)]
    each = rows.select(*extra, F.col(col_name(b.key)).alias(key_col(b)), F.explode(F.array(*entries)).alias("e"))
    return each.select(*extra, key_col(b), "e.*"), kinds


def key_sets(cat: Catalogue, b: Branch, kinds: Kinds | None = None,
             items: DataFrame | None = None) -> DataFrame:
    """The different ``__set_<name>`` of a folded chain, per ``__kind`` with ``kinds``.
    They need no row counts, so the rows are shuffled once, as sets by item."""
    on = next(j.on[0][0] for j in b.joins if j.table == table_of(folded_out(b).ref))
    narrow = build_branch(cat, replace(b, joins=tuple(j for j in b.joins if not j.fold),
                                       outs=(Out(set_col(b), on),)), kinds, items)
    extra = [KIND] if kinds is not None else []
    return narrow.where(F.col(set_col(b)).isNotNull()).select(*extra, set_col(b)).distinct()


def _members(cat: Catalogue, b: Branch, sets: DataFrame, kinds: Kinds | None) -> tuple[DataFrame, DataFrame, Column]:
    """The sets by member (``e``), the folded table, and what joins them."""
    j = next(x for x in b.joins if x.table == table_of(folded_out(b).ref))
    skip = {c for c, _ in j.kind_cols} if kinds is not None else set()
    value = folded_out(b).ref.rpartition(".")[2]
    cols = list(dict.fromkeys([j.on[0][1], value, *skip]))
    right = _table(cat, j.table, j.table, j.where, cols, skip)
    key = f"{j.table}__{j.on[0][1]}"
    member = F.col("e")
    if _collated(right, key):
        member = F.collate(member, right.schema[key].dataType.collation)
    conds = [member == F.col(key)]
    if kinds is not None:
        conds += [F.col(f"{j.table}__{c}") == kinds.from_id(F.col(KIND), form) for c, form in j.kind_cols]
    return (sets.withColumn("e", F.explode(set_col(b))), right,
            reduce(lambda a, c: a & c, conds))


def united_lists(cat: Catalogue, b: Branch, kinds: Kinds | None = None, sets: DataFrame | None = None,
                 items: DataFrame | None = None) -> DataFrame:
    """Per set of keys the list that their values in the folded table make together,
    built once for all items with that set."""
    o = folded_out(b)
    extra = [KIND] if kinds is not None else []
    each, right, cond = _members(cat, b, key_sets(cat, b, kinds, items) if sets is None else sets, kinds)
    value, name = F.col(col_name(o.ref)), flat_name(o.label)
    found = each.join(right.distinct(), cond, "left")
    # a collated value has no set; its spellings do
    found = found.select(*extra, set_col(b), (plain(value) if _collated(right, col_name(o.ref)) else value)
                         .alias("v")).distinct()
    return found.groupBy(*extra, set_col(b)).agg(F.collect_list("v").alias(name)).select(
        *extra, set_col(b), finish_distinct(F.col(name), o.agg == "distinct_text").alias(name))


#: What a list's text has beside each value: quotes and a comma.
QUOTED = 3


def united_values(cat: Catalogue, b: Branch, items: DataFrame | None = None) -> tuple[int, int, int]:
    """How many members the sets of keys have, and how many values, and bytes of text, their
    lists at most."""
    each, right, cond = _members(cat, b, key_sets(cat, b, items=items), None)
    j = next(x for x in b.joins if x.table == table_of(folded_out(b).ref))
    size = F.octet_length(F.col(col_name(folded_out(b).ref)).cast("string")) + F.lit(QUOTED)
    counts = right.distinct().groupBy(f"{j.table}__{j.on[0][1]}").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("t"))
    row = each.join(counts, cond, "left").agg(F.count(F.lit(1)).alias("e"), F.sum("n").alias("n"),
                                              F.sum("t").alias("t")).first()
    return row["e"], row["n"] or 0, row["t"] or 0


def _is_collated(kind) -> bool:
    return isinstance(kind, StringType) and kind != StringType()


def _build_restriction(cat: Catalogue, b: Branch, kinds: Kinds | None = None,
                       items: DataFrame | dict | None = None) -> DataFrame:
    """Restriction rows (1:N), one row per key: dates with their number of rows,
    countries with their first date, the type and the row count.

    The rows are one stream of (key, tag, value) entries, tag 0 a date, 1 a country,
    2 a type, equal ones folded on the map side: it spreads a hot key over its values,
    and only those, which the document carries, meet at the key."""
    rows = joined_rows(cat, b, kinds=kinds, items=items)
    extra = [KIND] if kinds is not None else []
    keys = [*extra, key_col(b)]
    country, kind = col_name(b.country_ref), col_name(b.type_ref)
    found = rows.select(*extra, F.col(col_name(b.key)).alias(key_col(b)),
                        F.col(col_name(b.date_ref)).alias("o"),
                        plain(F.col(country)).alias("c"), plain(F.col(kind)).alias("t"))
    no_text, no_date = F.lit(None).cast("string"), F.lit(None).cast(found.schema["o"].dataType)

    def entry(tag: int, day: Column, text: Column, first: Column, n: Column) -> Column:
        return F.struct(F.lit(tag).alias("tag"), day.alias("day"), text.alias("text"),
                        first.alias("first"), n.alias("n"))

    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    # a missing field makes no entry of the other list; entry 0 counts its row all the same
    each = found.select(*keys, F.explode(F.array(
        entry(0, F.col("o"), no_text, no_date, one),
        entry(1, no_date, F.col("c"), F.col("o"), none),
        entry(2, no_date, F.col("t"), no_date, none))).alias("e")).where(
        (F.col("e.tag") == 0) | F.col("e.text").isNotNull())
    text = F.col("e.text")
    folded = _is_collated(rows.schema[country].dataType)
    once = each.groupBy(*keys, F.col("e.tag").alias("tag"), F.col("e.day").alias("day"),
                        (F.collate(text, rows.schema[country].dataType.collation) if folded else text).alias("text")).agg(
        F.sum("e.n").alias("n"), F.min("e.first").alias("first"),
        *([F.min(text).alias("spelling")] if folded else []))
    value = F.col("spelling") if folded else F.col("text")
    tag = F.col("tag")
    return once.groupBy(*keys).agg(
        F.sum("n").alias(n_col(b)),
        F.min(F.when(tag == 2, value)).alias(type_col(b)),
        F.collect_list(F.when((tag == 0) & F.col("day").isNotNull(), F.struct(
            F.col("day").cast("string").alias("date"), F.col("n").alias("times")))).alias(dates_col(b)),
        # sort key of a country: those without any date come last
        F.collect_list(F.when(tag == 1, F.struct(F.col("first").isNull().alias("undated"),
                                                 F.col("first").alias("o"), value.alias("v"))))
        .alias(countries_col(b)))
