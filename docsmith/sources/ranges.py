"""Key ranges: max-id probe, segmentation, range scans.

The original job probed the largest id of a root table and then issued one
statement per half-open range ``[k*L, (k+1)*L)`` for ``k = 0 .. floor(max/L)``
(so negative ids are never read and an empty table yields no statement).
On Spark the range is a plain predicate on the root scan; Catalyst infers the
same predicate for every relation joined on the root key and pushes it into
their scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def max_id(df: DataFrame, key: str = "id") -> Column:
    """Aggregate expression: the largest key (NULL for an empty table)."""
    return F.max(F.col(key))


def probe_max_id(df: DataFrame, key: str = "id"):
    """Driver-side probe of the largest key; one scalar, as the original job."""
    return df.agg(F.max(F.col(key)).alias("m")).first()["m"]


def segment_count(max_key, size: int) -> int:
    """Number of half-open segments from 0 that cover ``max_key``."""
    if size <= 0:
        raise ValueError("segment size must be positive")
    if max_key is None or max_key < 0:
        return 0
    return int(max_key) // size + 1


def segment_bounds(max_key, size: int) -> list[tuple[int, int]]:
    return [(k * size, (k + 1) * size) for k in range(segment_count(max_key, size))]


def in_range(col: Column | str, lower: int, upper: int | None) -> Column:
    """``lower <= col < upper``; no upper bound when ``upper`` is None."""
    c = F.col(col) if isinstance(col, str) else col
    cond = c >= F.lit(lower)
    return cond if upper is None else cond & (c < F.lit(upper))


def range_filter(df: DataFrame, lower: int, upper: int, key: str = "id") -> DataFrame:
    """Rows with ``lower <= key < upper``."""
    return df.where(in_range(key, lower, upper))


def segment_of(key: str, size: int) -> Column:
    # integral division (no detour through double); keys are >= 0 here
    return F.expr(f"CAST(`{key}` AS BIGINT) div {int(size)}")


def with_segment(df: DataFrame, size: int, key: str = "id") -> DataFrame:
    """One scan, every row tagged with its segment; negative keys excluded,
    which is exactly the union of all range statements."""
    return (df.where(F.col(key) >= 0)
              .withColumn("segment", segment_of(key, size))
              .withColumn("lower", F.col("segment") * F.lit(size))
              .withColumn("upper", (F.col("segment") + 1) * F.lit(size)))


def segments_frame(spark: SparkSession, df: DataFrame, size: int, key: str = "id") -> DataFrame:
    """segment, lower, upper, n_rows for every segment the original job would
    issue (empty ones included).  The segment list is generated distributed
    with ``spark.range``; only the max id passes through the driver."""
    n = segment_count(probe_max_id(df, key), size)
    segs = spark.range(0, n).withColumnRenamed("id", "segment")
    counts = (df.where(F.col(key) >= 0)
                .groupBy(segment_of(key, size).alias("segment"))
                .agg(F.count(F.lit(1)).alias("n_rows")))
    return (segs.join(counts, "segment", "left")
                .select("segment",
                        (F.col("segment") * size).alias("lower"),
                        ((F.col("segment") + 1) * size).alias("upper"),
                        F.coalesce(F.col("n_rows"), F.lit(0)).cast("long").alias("n_rows")))


# ---- equi-depth ranges, asked of a database ---------------------------------

#: Cells of a histogram per range wanted, and rounds of refining heavy cells.
CELLS, ROUNDS = 8, 12


def histogram_sql(table: str, key: str, width: int, lower: int, upper: int) -> str:
    """Rows per cell of ``width`` keys from ``lower`` up to ``upper``."""
    cell = f"FLOOR(({key} - {lower}) / {width})" if width > 1 else f"({key} - {lower})"
    return (f"SELECT {cell} AS cell, COUNT(*) AS n FROM {table} "
            f"WHERE {key} >= {lower} AND {key} < {upper} GROUP BY {cell}")


def equi_depth_cuts(ask, table: str, key: str, partitions: int) -> list[int]:
    """Keys that cut a table into about ``partitions`` ranges of equal row counts, by
    histograms that the database computes.  ``ask(sql)`` returns rows of one
    statement.  A cell that holds more than a range's share is asked for again in
    finer cells, until it is a single key, which no range can split.  At most
    ``CELLS`` cells per range and round reach the driver."""
    low, high, rows = ask(f"SELECT MIN({key}) AS low, MAX({key}) AS high, COUNT({key}) AS n FROM {table}")[0]
    if not rows or partitions < 2:
        return []
    low, high = int(low), int(high)
    share = -(-int(rows) // partitions)
    done: list[tuple[int, int, int]] = []          # (first key, end, rows)
    todo = [(low, high + 1, int(rows))]
    for _ in range(ROUNDS):
        heavy = [c for c in todo if c[2] > share // 2 and c[1] - c[0] > 1]
        done += [c for c in todo if c not in heavy]
        todo = []
        for first, end, n in heavy:
            # as many cells as the rows deserve
            cells = max(2, CELLS * -(-n // share))
            width = max(1, -(-(end - first) // cells))
            for cell, count in ask(histogram_sql(table, key, width, first, end)):
                at = first + int(cell) * width
                todo.append((at, min(at + width, end), int(count)))
        if not todo:
            break
    cuts, held = [], 0
    for first, _, n in sorted(done + todo):
        if held and held + n > share:
            cuts.append(first)
            held = 0
        held += n
    return cuts


def cut_ranges(cuts: list[int], key: str) -> list[str]:
    """WHERE predicates between the cuts that cover a whole table: the first takes
    NULL and all smaller keys, the last is open, so rows that arrive after the
    histogram are read, too."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *middle, f"{key} >= {cuts[-1]}"]
