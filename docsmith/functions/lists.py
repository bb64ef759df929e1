"""List semantics of the documents, as JVM-side Spark expressions.

* distinct list: NULLs skipped, duplicates removed, NULL (not empty) when
  nothing is left; sorted, because the original order was unspecified;
* ordered distinct list: each value ranked by its smallest sort key, ties
  broken by the value;
* multiset list: ``(date, times)`` pairs, never expanded, exact to 38 digits.

All of them aggregate with partial (map-side) aggregation, so a key that
holds a large share of the rows is combined on the map side before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Counts of joined rows: products of row counts pass 64 bits.
WIDE = "decimal(38,0)"


def null_if_empty(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def finish_distinct(collected: Column, as_text: bool = False) -> Column:
    """Sorted distinct list, NULL when empty; ``as_text`` renders numbers as text
    after they are sorted as numbers."""
    ordered = F.array_sort(collected)
    return null_if_empty(F.transform(ordered, lambda x: x.cast("string")) if as_text else ordered)


def spelled(entries: Column) -> Column:
    """The list of a group of ``(k, v)`` entries, ``k`` collated and ``v`` its
    spelling: in the order of the collation."""
    return null_if_empty(F.transform(F.array_sort(entries), lambda x: x.getField("v")))


def ordered_values(entries: Column, value_field: str = "v") -> Column:
    """The values of an array of sort keys that end in the value, one entry per
    value, in the order of the keys."""
    return null_if_empty(F.transform(F.array_sort(entries), lambda p: p.getField(value_field)))


def product(factors: list[Column]) -> Column:
    """Exact product of row counts, up to 38 digits; NULL beyond."""
    out = F.lit(1).cast(WIDE)
    for f in factors:
        out = F.try_multiply(out, f.cast(WIDE))
    return out


def multiset(pairs: Column, times: Column | None = None) -> Column:
    """``(date, times)`` pairs sorted by date, each multiplied by ``times``; NULL
    when empty.  The pairs are never expanded: their number is that of the
    distinct dates, whatever the multiplicity, which is exact up to 38 digits
    (``times`` is NULL beyond)."""
    factor = F.lit(1).cast(WIDE) if times is None else times
    # the factor is computed once per document, not once per date
    held = F.transform(F.array(F.struct(F.array_sort(pairs).alias("pairs"), factor.alias("factor"))),
                       lambda h: F.transform(h.getField("pairs"), lambda p: F.struct(
                           p.getField("date").alias("date"),
                           F.try_multiply(p.getField("times").cast(WIDE), h.getField("factor"))
                           .alias("times"))))
    return null_if_empty(held[0])


def as_text(arr: Column, pairs: bool = False, sep: str = ",") -> Column:
    """Comparable text form of a list: elements joined in list order; pairs as
    ``date x times``."""
    if pairs:
        return F.array_join(F.transform(arr, lambda p: F.concat_ws(
            " x ", p.getField("date"), p.getField("times").cast("string"))), sep)
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)
