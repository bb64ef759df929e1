"""Uniform sharding by a hypergeometric communication matrix.

Rows are dealt by a hash of their content to source partitions.  The number of
rows that each partition sends to each shard is drawn exactly from the
multivariate hypergeometric law, whose column sums are the shard sizes (at most
one row apart).  Every partition permutes its rows and cuts the permutation by
its row of the matrix; after the exchange every shard permutes what it received.
That is a uniform shuffle with exact shard sizes: each assignment of rows to
shards with those sizes is equally likely.

Scale: only the partition sizes, ``partitions`` numbers whatever the input,
reach the driver.  The local permutation is one sort per source partition.  The
second permutation orders a shard by random keys: the keys are cut into
``partitions`` ranges, ranges are counted, and every range is ranked by itself,
so no task ever holds a shard.

The draw depends only on ``seed``, the contents and the counts, so reruns and
recomputed tasks agree, however the input is split into files.  Rows of equal
content are numbered and interchangeable.  Null
columns are part of the content; an empty table gives an empty result; every
column of the input is kept, but for those named like the result's.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import numbered, packed, row_key, staged, unpacked

PARTITIONS = 1024
#: numpy's sampler takes populations below this; larger ones are drawn here.
_NUMPY_LIMIT = 1_000_000_000


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Number of good items among ``sample`` drawn without replacement."""
    if good == 0 or sample == 0:
        return 0
    if bad == 0:
        return sample
    if good + bad < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, sample))
    # inversion over the law's bulk, from the ratios of neighbouring terms
    total = good + bad
    low, high = max(0, sample - bad), min(sample, good)
    mean = sample * good / total
    spread = (mean * (bad / total) * (total - sample) / max(1, total - 1)) ** 0.5
    first = max(low, int(mean - 14 * spread) - 14)
    last = min(high, int(mean + 14 * spread) + 14)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(sample - k) - np.log(k + 1) \
        - np.log(bad - sample + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each source partition sends to each shard."""
    rng = np.random.default_rng(seed)
    total = sum(sizes)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = np.zeros((len(sizes), shards), dtype=np.int64)
    for p, size in enumerate(sizes):
        left, others = size, sum(room)
        for s in range(shards):
            others -= room[s]
            matrix[p, s] = draw_hypergeometric(rng, room[s], others, left)
            left -= int(matrix[p, s])
        room = [r - int(c) for r, c in zip(room, matrix[p])]
    return matrix


def _random(seed: int, stage: str):
    """A random key per row from its content and its number among equal rows."""
    return F.xxhash64(F.lit(f"{stage}-{seed}"), "k1", "k2", "copy")


def shard(spark: SparkSession, rows: DataFrame, shards: int = 8, seed: int = 0,
          partitions: int = PARTITIONS) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, gapless in its shard)."""
    named = packed(rows).select("_in", *row_key(rows.columns))
    # equal rows are told apart by a number among them
    named = staged(spark, numbered(staged(spark, named, "shard-rows"), ["k1", "k2"]), "shard-numbered")
    dealt = named.withColumn("_p", F.pmod(_random(seed, "deal"), F.lit(partitions)).cast("int"))
    counts = {r["_p"]: r["count"] for r in dealt.groupBy("_p").count().collect()}  # <= partitions
    matrix = communication_matrix([counts.get(p, 0) for p in range(partitions)], shards, seed)
    ends = spark.createDataFrame(
        [(p, [int(x) for x in np.cumsum(matrix[p])]) for p in range(partitions)],
        "_p int, ends array<long>")
    order = W.partitionBy("_p").orderBy(_random(seed, "permute"), "k1", "k2", "copy")
    ranked = dealt.withColumn("_rank", F.row_number().over(order))
    sent = ranked.join(F.broadcast(ends), "_p").withColumn(  # `partitions` rows
        "shard", F.size(F.filter("ends", lambda e: e < F.col("_rank"))).cast("int"))
    sent = staged(spark, sent.drop("ends", "_rank", "_p")
                  .withColumn("_key", _random(seed, "again")), "shard-sent")
    ranged = sent.withColumn("_p", F.pmod(F.shiftrightunsigned("_key", 16), F.lit(partitions))
                             .cast("int"))
    sizes = ranged.groupBy("shard", "_p").count()
    before = W.partitionBy("shard").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("shard", "_p", F.coalesce(F.sum("count").over(before), F.lit(0))
                          .alias("first"))
    inside = W.partitionBy("shard", "_p").orderBy("_key", "k1", "k2", "copy")
    slots = ranged.withColumn("_rank", F.row_number().over(inside)).join(
        F.broadcast(starts), ["shard", "_p"])  # at most shards * partitions rows
    return slots.withColumn("slot", (F.col("first") + F.col("_rank") - 1).cast("long")) \
        .select(*unpacked([c for c in rows.columns if c not in ("shard", "slot")]), "shard", "slot")
