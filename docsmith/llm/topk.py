"""Exact top-k inner products by no-random-access aggregation.

Every dimension of a block of vectors is one sorted list.  A query reads the
lists of its nonzero weights sequentially from their best end: descending where
the weight is positive, ascending where it is negative.  After a depth r, a list
value that was not yet seen lies between the list's last end and the value at
depth r; that gives every vector a lower and an upper bound of its score.
Reading stops when few vectors have an upper bound that reaches the k-th best
lower bound: no outsider can qualify, not even in a tie.  For those left, the
lists are read to the end, which resolves their scores exactly.

The bounds are computed for a whole block of queries at once: with hi(r) and
lo(r) the list values at depth r, the upper bound of vector v is
``max(v, hi(r)) . q+  +  min(v, lo(r)) . q-`` and the lower bound replaces each
value not seen by the list's far end.  Components are integers; the products
run in the narrowest type that holds every sum exactly.

Scale: candidates are dealt by a hash into blocks of about ``block`` vectors and
queries into blocks of about ``query_block``; every pair of blocks is one group
of bounded size.  Each block returns its k best per query, and the best of those
are the result.

Edge cases: integer components saturate where ``width`` products of them would pass
2^62 (2^28 for 64 components); null vectors and vectors with null or non-finite components take no
part; a shorter vector has zeros at its end; only the query's own row is left
out, so a repeated row is a candidate; a null id is never a query and comes last
in ties; fewer than k candidates give fewer rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import python_workers, staged

BLOCK, QUERY_BLOCK = 8192, 1024
#: Depths at which the bounds are compared, as parts of a list.
DEPTHS = (0.25, 0.5, 0.7, 0.8, 0.9, 0.95)
#: Scores held at once by one step of a task.
_CELLS = 1 << 22
#: Reading ends early when this part of the pairs or less is still open.
_OPEN = 0.05


def _exact_type(q: np.ndarray, v: np.ndarray):
    most = int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th best of each row."""
    k = min(k, scores.shape[1])
    if scores.dtype == object:
        return np.sort(scores, axis=1)[:, -k]
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]


def no_random_access(q: np.ndarray, v: np.ndarray, own: np.ndarray, k: int
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of all pairs that can be among a query's k best.
    ``own[i]`` is the vector that query i may not have, or -1."""
    kind = _exact_type(q, v)
    n = len(v)
    plus = np.maximum(q, 0).astype(kind).T
    minus = np.minimum(q, 0).astype(kind).T
    lists = np.sort(v, axis=0).astype(kind)
    v = v.astype(kind)
    banned = np.nonzero(own >= 0)[0]
    least = -(1 << 62) if kind is object else -np.inf
    for depth in (*DEPTHS, 1.0):
        r = max(1, int(n * depth))
        hi, lo = lists[n - r], lists[r - 1]
        upper = np.maximum(v, hi) @ plus + np.minimum(v, lo) @ minus
        lower = np.where(v >= hi, v, lists[0]) @ plus + np.where(v <= lo, v, lists[-1]) @ minus
        upper, lower = upper.T, lower.T
        upper[banned, own[banned]] = least
        lower[banned, own[banned]] = least
        open_ = (upper >= _kth(lower, k)[:, None]) & (upper > least)
        if open_.mean() <= _OPEN:
            break
    qi, vi = np.nonzero(open_)
    scores = np.empty(len(qi), dtype=np.int64 if kind is not object else object)
    for a in range(0, len(qi), 1 << 18):
        part = slice(a, a + (1 << 18))
        scores[part] = ((v[vi[part]] * (plus.T[qi[part]] + minus.T[qi[part]])).sum(axis=1))
    return qi, vi, scores


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, x in enumerate(vectors):
        out[i, :len(x)] = x
    return out


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    if len(queries) and len(rows):
        width = max(queries["q"].map(len).max(), rows["v"].map(len).max(), 1)
        v, q = _matrix(rows["v"], width), _matrix(queries["q"], width)
        place = {u: i for i, u in enumerate(rows["uid"])}
        own = np.array([place.get(u, -1) for u in queries["query_uid"]])
        ids = rows["id"].to_numpy()
        step = max(1, _CELLS // len(rows))
        for a in range(0, len(q), step):
            qi, vi, scores = no_random_access(q[a:a + step], v, own[a:a + step], k)
            part = pd.DataFrame({"query_uid": queries["query_uid"].to_numpy()[a + qi],
                                 "query_id": queries["query_id"].to_numpy()[a + qi],
                                 "vec_id": ids[vi], "score": scores, "uid": vi})
            part = part.sort_values(["score", "vec_id", "uid"], ascending=[False, True, True],
                                    na_position="last")
            found.append(part.groupby("query_uid", sort=False).head(k))
    found = [x for x in found if len(x)]
    if not found:
        return pd.DataFrame(columns=["query_uid", "query_id", "vec_id", "score"])
    out = pd.concat(found).drop(columns="uid")
    out["vec_id"] = out["vec_id"].astype("Int64")
    return out


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame | None = None, k: int = 5,
          scale: int = 256, every: int = 50, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score.  Queries are the rows whose id is divisible
    by ``every``."""
    python_workers(spark, 10_000)  # vectors are short
    ints = F.transform(F.col(vector_col),
                       lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    usable = F.col(vector_col).isNotNull() & F.forall(
        F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x)
        & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = staged(spark, vectors.filter(usable).select(
        F.col(id_col).cast("long").alias("id"), ints.alias("v"),
        F.monotonically_increasing_id().alias("uid")), "topk-vectors")
    # other names, so the two sides of the cogroup share no column
    asked = rows.filter(F.col("id") % every == 0).select(
        F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("uid").alias("query_uid"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, m = size["n"], asked.count()
    # every score fits a long
    edge = F.lit(math.isqrt((1 << 62) // max(1, size["width"] or 1)))
    def bounded(c):  # noqa: E306
        return F.transform(c, lambda x: F.greatest(-edge, F.least(edge, x)))
    rows, asked = rows.withColumn("v", bounded("v")), asked.withColumn("q", bounded("q"))
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-m // query_block))
    dealt = rows.withColumn("b", F.pmod(F.xxhash64("uid"), F.lit(blocks))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<long>")))
    spread = asked.withColumn("qb", F.pmod(F.xxhash64("query_uid", F.lit("q")), F.lit(query_blocks))) \
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return _best(q, c, k)

    near = spread.groupBy("qb", "b").cogroup(dealt.groupBy("qb", "b")).applyInPandas(
        best, "query_uid long, query_id long, vec_id long, score long")
    order = W.partitionBy("query_uid").orderBy(F.col("score").desc(),
                                               F.col("vec_id").asc_nulls_last())
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
