"""Per-device scores: one pivot instead of one correlated lookup per device.

The original read each device's score with its own correlated scalar
subquery, i.e. one scan of the score table per device.  Here the table is
read once and folded to one row per item with a conditional aggregate per
device.  A scalar subquery fails when it finds a second row, but it only looks
at the rows of documents: duplicates are counted here, and ``checked`` raises
the error after the join, for an item that is in the root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.model import Branch
from ..sources.catalogue import Catalogue

DUPLICATE_SCORE = "more than one score row for one (id, device_type_id)"


def score_label(b: Branch, device_name: str) -> str:
    return f"{b.label_prefix}.{device_name}"


def duplicate_col(b: Branch) -> str:
    return f"__dup_{b.name}"


def score_pivot(cat: Catalogue, b: Branch, items: DataFrame | None = None) -> DataFrame:
    from .branch import col_name, key_col, n_col, of_items  # local: avoid an import cycle
    from ..plans.model import flat_name

    scores = cat[b.table]
    for c, v in b.where:
        scores = scores.where(F.col(c) == F.lit(v))
    key = b.key
    dev, val = b.device_ref, b.value_ref
    device_ids = [d for _, d in b.devices]
    # Only the listed devices are read (pushed to the scan as an IN filter).
    scores = scores.where(F.col(key).isNotNull() & F.col(dev).isin(device_ids))
    scores = of_items(scores, key, items)
    aggs = []
    for name, d in b.devices:
        hit = F.col(dev) == F.lit(d)
        aggs.append(F.max(F.when(hit, F.col(val))).alias(f"__v{d}"))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"__c{d}"))
    agg = scores.groupBy(F.col(key).alias(key_col(b))).agg(*aggs)
    most = F.greatest(*[F.col(f"__c{d}") for _, d in b.devices], F.lit(0))
    outs = [F.col(f"__v{d}").alias(flat_name(score_label(b, name))) for name, d in b.devices]
    return agg.select(key_col(b), F.lit(None).cast("long").alias(n_col(b)),
                      (most > 1).alias(duplicate_col(b)), *outs)


def checked(b: Branch, score: Column) -> Column:
    """The score of a document, or an error if one of its scores is not unique."""
    return F.when(F.col(duplicate_col(b)), F.raise_error(F.lit(DUPLICATE_SCORE))).otherwise(score)
