"""Baseline plan: the original query shape on Spark.

Every relation is left-joined to the root row by row, the combined rows are
grouped once per item, and each device score is its own lookup.  Work per
item is the *product* of its relation sizes.  ``bench.py`` uses it as the
reference point for the branch plan (``operators/assemble.py``), and the tests
hold it against the same DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import doc_key
from ..functions.lists import null_if_empty
from ..operators.branch import col_name, joined_rows, key_col
from ..params import Options
from ..plans.model import flat_name
from ..sources.catalogue import Catalogue
from .specs import spec_for


def naive_document(cat: Catalogue, doc: str, options: Options | None = None) -> DataFrame:
    o = options or Options()
    spec = spec_for(doc, None, o)
    if not spec.grouped:
        raise ValueError("the naive plan is defined for the grouped document types")
    root = cat[spec.root]
    root_cols = list(root.columns)
    df = root
    aggs = []
    for b in spec.branches:
        if b.kind == "scores":
            continue
        rows = joined_rows(cat, b).withColumnRenamed(col_name(b.key), key_col(b))
        rows = rows.select(*[F.col(c).alias(f"{b.name}__{c}") for c in rows.columns])
        df = df.join(rows, F.col(b.root_ref) == F.col(f"{b.name}__{key_col(b)}"), "left")
        pre = f"{b.name}__"
        for out in b.outs:
            c = F.col(pre + col_name(out.ref))
            name = flat_name(out.label)
            if out.agg in ("distinct", "distinct_text"):
                aggs.append(null_if_empty(F.array_sort(F.collect_set(c))).alias(name))
            elif out.agg == "count_distinct":
                aggs.append(F.countDistinct(c).alias(name))
            else:
                aggs.append(F.min(c).alias(name))
        if b.exists_label:
            aggs.append(F.max(F.col(f"{pre}{key_col(b)}")).alias("__exists_" + b.name))
        if b.kind == "restriction":
            d, t, v = (F.col(pre + col_name(r)) for r in (b.date_ref, b.type_ref, b.country_ref))
            aggs += [F.min(t).alias("restrict_type"),
                     null_if_empty(F.array_sort(F.collect_list(d.cast("string")))).alias("restrict_date"),
                     F.collect_set(F.when(v.isNotNull(), F.struct(d.alias("o"), v.alias("v"))))
                     .alias("__pairs")]
    g = df.groupBy(*root_cols).agg(*aggs)
    # one lookup per device, as the correlated subqueries
    score_branch = next((b for b in spec.branches if b.kind == "scores"), None)
    if score_branch is not None:
        dev, val = score_branch.device_ref, score_branch.value_ref
        for name, d in score_branch.devices:
            s = cat[score_branch.table].where(F.col(dev) == d).select(
                F.col("id").alias(f"__s{d}"), F.col(val).alias(flat_name(f"sorting_score.{name}")))
            g = g.join(s, F.col("id") == F.col(f"__s{d}"), "left").drop(f"__s{d}")
    extra = [doc_key(spec.key_parts, spec.key_style).alias("_id")]
    if "__pairs" in g.columns:
        # a country's pairs by date, those without one last; its first place ranks it
        ranked = F.array_sort(F.transform("__pairs", lambda p: F.struct(
            p["o"].isNull().alias("undated"), p["o"].alias("o"), p["v"].alias("v"))))
        extra.append(null_if_empty(F.array_distinct(F.transform(ranked, lambda p: p["v"])))
                     .alias("restrict_country_code"))
    return g.select("*", *extra).drop("__pairs")
