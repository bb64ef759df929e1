"""Mixing sources to target weights along a time-varying curriculum.

Targets: every source weighs something and the mix has as many words as the
input.  A target stops at ``cap`` times its source's size; the excess is dealt to
the others by weight until none is above.  That is one water level: with sources
in order of cap / weight, the first level that the next cap does not cut.

Curriculum: the share of a source at training time t in [0, 1] follows
``1 + slope * (2 t - 1)``; integrated, ``t + slope * (t^2 - t)`` of its demand is
due by time t.  A document whose words end the first u of its source's demand is
trained at the time that inverts this integral.  Documents follow in the order
of a hash, epoch after epoch; the last, partial epoch takes whole documents up
to the remaining demand.  Behind a document that does not fit it goes on with the
documents that still do, until none does; what is open then goes to the document
nearest to it in size.  No document is taken more than ``cap`` times.  The mix is
the copies, range-sorted by position.

Scale: cumulative demand is a two-level prefix sum (``buckets`` hash ranges per
source, then documents inside a range), so a source with a third of the rows is
spread over as many tasks as any other.  Only one row per source is ever put in
one order.

Edge cases: null text has size 0; a null source is a source and comes last;
sources of size 0 have target 0; repeated rows are documents of their own; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import field, packed, staged, text_or_empty, unpacked, word_count

WEIGHTS = (5, 2, 1)
SLOPES = (-0.6, 0.0, 0.6)
CAP = 3
#: Hash ranges of a source: the first hexadecimal digits of the order key.
BUCKET_DIGITS = 3


def _cycle(values, position: Column) -> Column:
    """The values, repeating, by position from 1."""
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.pmod(position - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, cap: int = CAP) -> DataFrame:
    """Per ``source``: source_size, weight, slope, target.  ``sizes`` has one row
    per source, so the unpartitioned orders below hold sources, not documents."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("n", F.row_number().over(by_name))
    ranked = ranked.select("source", "source_size", _cycle(weights, F.col("n")).alias("weight"),
                           _cycle(slopes, F.col("n")).alias("slope"))
    level = W.orderBy(F.col("source_size") * cap / F.col("weight"),
                      F.col("source").asc_nulls_last())
    before = level.rowsBetween(W.unboundedPreceding, -1)
    after = level.rowsBetween(0, W.unboundedFollowing)
    whole = level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cut = F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))
    here = (F.sum("source_size").over(whole) - cut).cast("double") / F.sum("weight").over(after)
    levels = ranked.withColumn("here", here) \
        .withColumn("holds", F.col("here") <= F.col("source_size") * cap / F.col("weight"))
    levels = levels.withColumn("place", F.row_number().over(level)).withColumn("level", F.min(
        F.when(F.col("holds"), F.struct("place", "here"))).over(whole))
    return levels.select("source", "source_size", "weight", "slope", F.least(
        F.col("level.here") * F.col("weight"),
        (F.col("source_size") * cap).cast("double")).alias("target"))


def position(share: Column, slope: Column) -> Column:
    """The time t at which ``share`` of the demand is due: t + slope (t^2 - t) = share."""
    b = 1 - slope
    root = (-b + F.sqrt(b * b + 4 * slope * share)) / (2 * slope)
    return F.when(slope == 0, share).otherwise(F.least(F.greatest(root, F.lit(0.0)), F.lit(1.0)))


def _filled(spark: SparkSession, placed: DataFrame, gaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``placed`` and ``gaps`` after the last epoch went on behind its cuts: pass by
    pass a prefix of the documents no larger than the gap, until none is left."""
    taken = None
    small = placed.filter(~F.col("extra") & (F.col("size") > 0)).select(
        "uid", "source", "size", "order_key", "text_key", "target", "source_size", "epochs",
        F.substring("order_key", 1, BUCKET_DIGITS).alias("bucket"))
    while True:
        g, s = gaps.alias("g"), small.alias("s")
        small = staged(spark, s.join(g, F.col("s.source").eqNullSafe(F.col("g.source")))
                       .filter(F.col("size") <= F.col("gap")).select("s.*", "gap"), "mix-small")
        if small.isEmpty():
            break
        earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        inside = W.partitionBy("source", "bucket").orderBy("order_key", "text_key", "size") \
            .rowsBetween(W.unboundedPreceding, -1)
        starts = small.groupBy("source", "bucket").agg(F.sum("size").alias("words")).withColumn(
            "first", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        offset = small.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        o, b = offset.alias("o"), starts.alias("b")
        dealt = staged(spark, o.join(b, F.col("o.source").eqNullSafe(F.col("b.source"))
                                     & (F.col("o.bucket") == F.col("b.bucket")))
                       .select("o.*", (F.col("first") + F.col("inner")).alias("ahead"))
                       .withColumn("fits", F.col("ahead") + F.col("size") <= F.col("gap")), "mix-dealt")
        fits = dealt.filter("fits").select("uid", (
            F.col("target") - F.col("epochs") * F.col("source_size") - F.col("gap")
            + F.col("ahead")).alias("at"))
        taken = fits if taken is None else taken.unionByName(fits)
        gaps = staged(spark, dealt.groupBy("source", "gap").agg(F.sum(
            F.when(F.col("fits"), F.col("size")).otherwise(0)).alias("words"))
            .select("source", (F.col("gap") - F.col("words")).alias("left"))
            .alias("n").join(gaps.alias("g"), F.col("n.source").eqNullSafe(F.col("g.source")), "right")
            .select("g.source", F.coalesce("left", "gap").alias("gap")), "mix-gaps")
        small = dealt.filter("NOT fits").drop("gap", "inner", "ahead", "fits")
    if taken is not None:
        placed = staged(spark, placed.join(taken, "uid", "left").withColumn(
            "extra", F.col("extra") | F.col("at").isNotNull()).withColumn(
            "late", F.coalesce("at", F.col("late").cast("double"))).drop("at"), "mix-filled")
    return placed, gaps


def schedule(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, cap: int = CAP,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target,
    repeats (0 to ``cap``), positions (training time of each copy)."""
    text = text_or_empty(text_col)
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    sized = staged(spark, docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        word_count(text).alias("size"), F.md5(ident.cast("binary")).alias("order_key"),
        F.md5(text.cast("binary")).alias("text_key"),
        F.monotonically_increasing_id().alias("uid"), *carry), "mix-sizes")
    targets = staged(spark, source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, slopes, cap),
        "mix-targets")
    keyed = sized.withColumn("bucket", F.substring("order_key", 1, BUCKET_DIGITS))
    ranges = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = staged(spark, ranges.withColumn(
        "first", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words"), "mix-starts")
    starts = starts.join(targets, starts["source"].eqNullSafe(targets["source"])) \
        .drop(targets["source"])
    inside = W.partitionBy("source", "bucket").orderBy("order_key", "text_key", "size") \
        .rowsBetween(W.unboundedPreceding, -1)
    offset = keyed.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    s, o = starts.alias("s"), offset.alias("o")
    placed = o.join(s, F.col("o.source").eqNullSafe(F.col("s.source"))
                    & (F.col("o.bucket") == F.col("s.bucket"))) \
        .select("o.id", "o.source", "o.size", "source_size", "target", "slope", "order_key",
                "text_key", "uid",
                (F.col("first") + F.col("inner")).alias("before"),
                *[F.col(f"o.{c}") for c in carry])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))) \
        .otherwise(0)
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    placed = staged(spark, placed.withColumn("epochs", epochs).withColumn(
        "extra", (F.col("size") > 0) & (F.col("before") + F.col("size") <= rest)), "mix-placed")
    # what the whole documents of the last epoch leave open goes to the document nearest in size
    gaps = staged(spark, placed.groupBy("source", "target", "source_size", "epochs").agg(
        F.sum(F.when(F.col("extra"), F.col("size")).otherwise(0)).alias("extra_words"))
        .select("source", (rest - F.col("extra_words")).alias("gap")), "mix-gaps")
    placed, gaps = _filled(spark, placed.withColumn("late", F.col("before")), gaps)
    open_ = placed.filter(~F.col("extra")).alias("o").join(
        gaps.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source"))) \
        .withColumn("miss", F.abs(F.col("size") - F.col("gap"))) \
        .filter((F.col("size") > 0) & (F.col("miss") < F.col("gap")))
    nearest = staged(spark, open_.groupBy("o.source").agg(
        F.min(F.struct("miss", "order_key", "text_key", "uid")).alias("best")).select("best.uid"),
        "mix-nearest")
    placed = placed.join(nearest.withColumn("fills", F.lit(True)), "uid", "left")
    placed = placed.withColumn("repeats", F.least(
        F.col("epochs") + F.when(F.col("extra") | F.col("fills"), 1).otherwise(0),
        F.lit(cap)).cast("int"))
    due = F.transform(F.sequence(F.lit(0), F.col("repeats") - 1), lambda e: position(
        F.least((e * F.col("source_size") + F.when(e < F.col("epochs"), F.col("before")).otherwise(
            F.col("late")) + F.col("size") / 2) / F.col("target"),
                F.lit(1.0)), F.col("slope")))
    return placed.withColumn("positions", F.when(
        (F.col("repeats") > 0) & (F.col("target") > 0), due)
        .otherwise(F.array().cast("array<double>"))) \
        .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "repeats",
                "positions", *carry)


def copies(plan: DataFrame) -> DataFrame:
    """The copies that the mix takes, one row each: its ``row`` and training position."""
    return plan.select("row", F.explode("positions").alias("at"))


def in_order(mixed: DataFrame) -> DataFrame:
    """The mix range-sorted by training position."""
    return mixed.repartitionByRange("at", "row").sortWithinPartitions("at", "row")


def mixed_counts(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, cap: int = CAP,
                 id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target and ``copies``, how
    often the written order of the mix has it."""
    numbered = docs.select(id_col, text_col, source_col).withColumn("row", F.monotonically_increasing_id())
    plan = staged(spark, schedule(spark, numbered, weights, slopes, cap, id_col, text_col, source_col,
                                  ("row",)), "mix-plan")
    order = staged(spark, in_order(copies(plan)), "mix-order")
    found = order.groupBy("row").agg(F.count("at").alias("copies"))
    return plan.join(found, "row", "left").select(
        id_col, "size", "source_size", "target", F.coalesce("copies", F.lit(0).cast("long")).alias("copies"))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, cap: int = CAP,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The copies that the mix takes, with the columns of ``docs``, range-sorted by
    training position.  Documents without words (size 0) take no part."""
    numbered = staged(spark, packed(docs).withColumn("row", F.monotonically_increasing_id()),
                      "mix-docs")
    plan = schedule(spark, numbered.select(
        "row", field(id_col).alias("id"), field(text_col).alias("text"),
        field(source_col).alias("source")), weights, slopes, cap, "id", "text", "source", ("row",))
    return in_order(numbered.join(copies(plan), "row")).select(*unpacked(docs.columns))
