"""Centroid clustering (k-means on integers) with Orchard's search.

Every centroid keeps the list of the others in ascending distance from it.  A
vector starts at one centroid and reads that centroid's list; whenever it meets a
closer centroid (or one as close with a smaller number) it goes on with that
centroid's list from its head, passing over those it has already measured.  It
stops at the first entry strictly beyond twice its current distance: by the
triangle inequality no later one can be closer, and none on the border is missed,
so ties are decided exactly.  All distances are integers (squared; "beyond twice"
is beyond four times).  A task runs the search for all vectors of a batch at once:
one step of every vector that is still reading.

Scale: the vectors are staged once as integers; each round is one pass over them
in which every batch returns one row per centroid (count, component sums), so a
round shuffles ``batches x k`` small rows however the vectors cluster.  Only the
``k`` centroids (k x width integers) reach the driver, and each round's tasks get
them.  Rounds depend on nothing but the staged vectors and those centroids.

Edge cases: vectors null, of another length, or with null or non-finite components
are left out; ``floor(scale * x)`` saturates at +-2^27 (|x| of 2^19 at scale 256),
within which every distance fits a long; equal hashes (a repeated id) are
ordered by their vectors; a null id starts no centroid but its vector is assigned;
fewer vectors than ``k`` give fewer centroids; equal centroids leave all but the
smallest number empty, and empty ones stay where they are; where no vector has an
id there is no centroid and no row; a sum of distances
beyond a long is null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm.common import python_workers, staged


def largest(width: int) -> int:
    """The largest component: ``width`` squared differences of twice it fit a long."""
    return math.isqrt((1 << 62) // width) // 2


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, reach): row c lists the other centroids in ascending distance from c
    (ties: smaller number); a vector reads an entry if its squared distance from c
    is at least ``reach``, a quarter of the entry's (rounded up, and so exact)."""
    gaps = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    order = np.array([[j for j in np.lexsort((np.arange(len(gaps)), row)) if j != i]
                      for i, row in enumerate(gaps)], dtype=np.int64).reshape(len(gaps), -1)
    return order, -(-np.take_along_axis(gaps, order, axis=1) // 4)


def orchard(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray, reach: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance) of every vector."""
    n, others = len(vectors), order.shape[1]
    current = np.zeros(n, np.int64)
    distance = ((vectors - centroids[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, len(centroids)), bool)
    visited[:, 0] = True
    place = np.zeros(n, np.int64)
    reading = np.arange(n if others else 0)
    while len(reading):
        at, here = place[reading], current[reading]
        within = reach[here, at] <= distance[reading]
        reading, at, here = reading[within], at[within], here[within]
        met = order[here, at]
        place[reading] += 1
        new = ~visited[reading, met]
        row, met = reading[new], met[new]
        visited[row, met] = True
        far = ((vectors[row] - centroids[met]) ** 2).sum(axis=1)
        closer = (far < distance[row]) | ((far == distance[row]) & (met < current[row]))
        row = row[closer]
        current[row], distance[row], place[row] = met[closer], far[closer], 0
        reading = reading[place[reading] < others]
    return current, distance


def _batch_vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(-1, width)


def _assigned(centroids: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, reach = neighbour_lists(centroids)
        for batch in batches:
            cluster, distance = orchard(_batch_vectors(batch, width), centroids, order, reach)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                names=["id", "cluster", "distance"])
    return run


def _summed(centroids: np.ndarray, width: int):
    """Per batch and centroid: the number of its vectors and their sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, reach = neighbour_lists(centroids)
        for batch in batches:
            vectors = _batch_vectors(batch, width)
            cluster, _ = orchard(vectors, centroids, order, reach)
            by = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[by], return_index=True)
            if not len(found):
                continue
            sums = np.add.reduceat(vectors[by], first, axis=0)
            counts = np.diff(np.append(first, len(by)))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1) * width, pa.int32()), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(counts, pa.int64()), lists],
                names=["cluster", "n", "sums"])
    return run


def integer_vector(column: Column, scale: int, width: int) -> Column:
    """``floor(scale * x)`` of every component, saturating."""
    # clipped before it is floored: floor gives a long
    edge = F.lit(float(largest(width)))
    return F.transform(column, lambda x: F.floor(F.greatest(-edge, F.least(
        edge, F.lit(float(scale)) * x))).cast("int"))


def usable(column: Column, width: int) -> Column:
    return column.isNotNull() & (F.size(column) == width) & F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def first_centroids(rows: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest SHA-256 of ``salt:id``."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    best = rows.filter(F.col("id").isNotNull()).withColumn("key", key) \
        .orderBy("key", "v").select("v").limit(k).collect()   # k rows
    return np.array([r["v"] for r in best], dtype=np.int64)


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def moved(spark: SparkSession, rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes floor(sum / count) of its vectors."""
    width = centroids.shape[1]
    parts = rows.select("v").mapInArrow(_summed(centroids, width),
                                        "cluster int, n long, sums array<long>")
    wide = "decimal(38,0)"
    sums = parts.select("cluster", "n", F.posexplode("sums").alias("place", "x")) \
        .groupBy("cluster", "place").agg(F.sum(F.col("x").cast(wide)).alias("total"),
                                         F.sum("n").alias("n")).collect()   # k x width rows
    out = centroids.copy()
    for r in sums:
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out


def cluster(spark: SparkSession, vectors: DataFrame, k: int = 40, rounds: int = 5,
            scale: int = 256, width: int = 64, salt: str = "2", id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector, staged, and the final centroids."""
    python_workers(spark, 10_000)  # vectors are short
    given = vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("x"))
    rows = staged(spark, given.filter(usable(F.col("x"), width)).select(
        "id", integer_vector(F.col("x"), scale, width).alias("v")), "kmeans-vectors")
    centroids = first_centroids(rows, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], "id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = moved(spark, rows, centroids)
    found = rows.mapInArrow(_assigned(centroids, width), "id long, cluster int, distance long")
    return staged(spark, found, "kmeans-found"), centroids


def clustered(spark: SparkSession, vectors: DataFrame, **options) -> DataFrame:
    """Every vector with its cluster, its squared distance, the sums of the
    distances over its cluster and over all, and its centroid's digest."""
    found, centroids = cluster(spark, vectors, **options)
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(wide.alias("own"))
    total = sums.agg(F.sum("own").alias("all_"))
    digests = spark.createDataFrame(
        [(i, centroid_digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    # one row per cluster: bounded by k
    notes = sums.join(digests, "cluster").crossJoin(total).select(
        "cluster", F.expr("try_cast(own AS bigint)").alias("cluster_inertia"),
        F.expr("try_cast(all_ AS bigint)").alias("inertia"), "centroid_sha256")
    return found.join(F.broadcast(notes), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256")
