"""Approximate nearest neighbours by largest inner product: one hierarchical
navigable small-world graph per shard, the results of the shards merged.

Vectors of equal content are one node (a vector that a third of all rows share
would otherwise fill every neighbour list of its surroundings), dealt by a hash
of their content into shards of about ``shard_rows``.  A shard's graph is built by
one task and stored as flat arrays: the vectors, and per layer the members and a
``members x degree`` table of neighbours (-1: none).  Layers are built from the top
down; nodes enter in batches, which search the layer for all their members at
once.  Links are chosen by the usual rule: a candidate stays if it is nearer to
the node than to every neighbour chosen before it.

Largest inner product becomes nearest neighbour by one more component that gives
all vectors of a shard the same length (0 for a query).  Graphs are walked in
single precision; every vector that the walk ends with is scored again in double
precision on the original components.  Each shard returns its ``k + 1`` best
vectors per query vector, the best of those over all shards are joined with
their rows (at most ``k + 1`` a vector can matter), and the query's own row goes.

Scale: every block of queries meets every shard, as rows of two staged tables
that meet in a cogroup of bounded size (a shard and at most ``query_block``
queries).  With queries a fixed part of the rows this is quadratic in the table;
the larger a shard, the less of it, up to the memory of a task.  Nothing but two
row counts and a width reaches the driver.

Edge cases: vectors null, empty, zero, or with null or non-finite components take
no part; a shorter vector has zeros at its end; a null id is never a query and
comes last in ties; repeated rows are candidates of each other; fewer than k
candidates give fewer rows; an empty table gives an empty result; other columns
are ignored.  Products of double components may overflow; their score is then
infinite or NaN and comes where Spark sorts it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import python_workers, staged

SHARD_ROWS, QUERY_BLOCK = 8192, 2048
#: Bytes of one shard's vectors; longer vectors make smaller shards.
SHARD_BYTES = 64 << 20
#: Neighbours of a node (twice as many on the lowest layer), and the breadth of
#: the walk while building and while searching.
DEGREE, BUILD_WIDTH, SEARCH_WIDTH = 16, 64, 160
#: Nodes expanded per step of a walk.
_EXPAND = 4
_NO_ID = (1 << 63) - 1


def together(vectors: np.ndarray) -> int:
    """Nodes that enter, or queries that walk, at once: what bounds a task's memory."""
    n, width = vectors.shape
    return max(8, min(512, (1 << 16) // max(1, width), (1 << 24) // max(1, n)))


def walk(vectors: np.ndarray, links: np.ndarray, start: np.ndarray, q: np.ndarray,
         width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search for all rows of ``q`` at once.  ``links`` is the flat
    neighbour table over node numbers, ``start`` the entry nodes of each query.
    Returns (nodes, similarities), best first, -1 where there are fewer."""
    m = len(q)
    nodes = np.full((m, width), -1, np.int64)
    sims = np.full((m, width), -np.inf, np.float32)
    done = np.ones((m, width), bool)
    first = start.shape[1]
    nodes[:, :first] = start
    sims[:, :first] = np.einsum("msd,md->ms", vectors[start], q)
    done[:, :first] = False
    order = np.argsort(-sims, axis=1, kind="stable")
    nodes, sims, done = (np.take_along_axis(x, order, 1) for x in (nodes, sims, done))
    # the place at which a query saw a node first; 0: not yet
    seen = np.zeros((m, len(vectors)), np.int32)
    seen[np.arange(m)[:, None], start] = 1
    alive = np.arange(m)
    while len(alive):
        pick = np.argsort(done[alive], axis=1, kind="stable")[:, :_EXPAND]
        skip = np.take_along_axis(done[alive], pick, 1)
        done[alive[:, None], pick] = True
        near = links[np.take_along_axis(nodes[alive], pick, 1)]
        near[skip] = -1
        near = near.reshape(len(alive), -1)
        r, c = np.nonzero(near >= 0)
        node = near[r, c].astype(np.int64)
        row = alive[r]
        new = seen[row, node] == 0
        r, c, node, row = r[new], c[new], node[new], row[new]
        seen[row, node] = c + 2
        once = seen[row, node] == c + 2   # two expanded nodes may share a neighbour
        r, c, node, row = r[once], c[once], node[once], row[once]
        found = np.full(near.shape, -np.inf, np.float32)
        found[r, c] = np.einsum("kd,kd->k", vectors[node], q[row])
        all_sims = np.concatenate([sims[alive], found], axis=1)
        all_nodes = np.concatenate([nodes[alive], near], axis=1)
        all_done = np.concatenate([done[alive], found == -np.inf], axis=1)
        best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        best = np.take_along_axis(
            best, np.argsort(-np.take_along_axis(all_sims, best, 1), axis=1, kind="stable"), 1)
        sims[alive] = np.take_along_axis(all_sims, best, 1)
        kept = np.take_along_axis(all_nodes, best, 1)
        kept[sims[alive] == -np.inf] = -1
        nodes[alive] = kept
        done[alive] = np.take_along_axis(all_done, best, 1)
        alive = alive[~done[alive].all(axis=1)]
    return nodes, sims


def choose(vectors: np.ndarray, own: np.ndarray, nodes: np.ndarray, sims: np.ndarray,
           degree: int) -> np.ndarray:
    """Up to ``degree`` neighbours for each row among its candidates: those nearer
    to the row's node than to any chosen one, then the nearest of the others."""
    sims = np.where((nodes >= 0) & (nodes != own[:, None]), sims, -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")
    nodes, sims = np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1)
    real = sims > -np.inf
    v = vectors[np.where(real, nodes, 0)]
    between = v @ v.transpose(0, 2, 1)
    chosen = np.zeros(nodes.shape, bool)
    closest = np.full(nodes.shape, -np.inf, np.float32)   # to the chosen ones
    for i in range(nodes.shape[1]):
        take = real[:, i] & (sims[:, i] > closest[:, i]) & (chosen.sum(axis=1) < degree)
        chosen[:, i] = take
        closest = np.where(take[:, None], np.maximum(closest, between[:, i]), closest)
    order = np.argsort(np.where(chosen, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :degree]
    out = np.where(np.take_along_axis(real, order, 1), np.take_along_axis(nodes, order, 1), -1)
    if out.shape[1] < degree:
        out = np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)
    return out


def link_back(vectors: np.ndarray, links: np.ndarray, batch: np.ndarray) -> None:
    """The neighbours of a batch link back to it; a full list is chosen anew."""
    degree = links.shape[1]
    target = links[batch].ravel()
    source = np.repeat(batch, degree)
    source, target = source[target >= 0], target[target >= 0]
    sims = np.einsum("kd,kd->k", vectors[source], vectors[target])
    order = np.lexsort((-sims, target))
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    keep = place < degree          # of many at once, a list takes its nearest
    source, target, place = source[keep], target[keep], place[keep]
    nodes, row = np.unique(target, return_inverse=True)
    new = np.full((len(nodes), degree), -1, np.int64)
    new[row, place] = source
    old = links[nodes].astype(np.int64)
    new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
    both = np.concatenate([old, new], axis=1)
    size = together(vectors)
    for a in range(0, len(nodes), size):
        part, own = both[a:a + size], nodes[a:a + size]
        near = np.einsum("bcd,bd->bc", vectors[np.maximum(part, 0)], vectors[own])
        links[own] = choose(vectors, own, part, near, degree)


def levels(n: int, degree: int) -> list[int]:
    """Members of each layer, the lowest (all) first.  The nodes stand in the order
    of a hash, so a layer is its first members: a random part of the one below."""
    sizes = [n]
    while sizes[-1] > 2 * degree:
        sizes.append(max(1, sizes[-1] // degree))
    return sizes


def descend(vectors: np.ndarray, layers: list[np.ndarray], q: np.ndarray, down_to: int
            ) -> np.ndarray:
    """Entry nodes for the layer ``down_to``, by a narrow walk of those above it."""
    start = np.zeros((len(q), 1), np.int64)
    for layer in range(len(layers) - 1, down_to, -1):
        members = len(layers[layer])
        nodes, _ = walk(vectors[:members], layers[layer], start, q, 4)
        start = nodes[:, :1]
    return start


def build_graph(vectors: np.ndarray, degree: int = DEGREE, width: int = BUILD_WIDTH
                ) -> list[np.ndarray]:
    """The flat neighbour tables of all layers, the lowest first."""
    sizes = levels(len(vectors), degree)
    layers = [np.full((n, degree * (2 if i == 0 else 1)), -1, np.int32)
              for i, n in enumerate(sizes)]
    for layer in range(len(sizes) - 1, -1, -1):
        links, inside = layers[layer], 0
        while inside < sizes[layer]:
            step = min(together(vectors), max(2 * degree, inside), sizes[layer] - inside)
            batch = np.arange(inside, inside + step)
            q = vectors[batch]
            nodes = np.broadcast_to(batch, (step, step))
            sims = q @ q.T
            if step > width:   # neighbours that enter with a node
                best = np.argpartition(-sims, width, axis=1)[:, :width]
                nodes, sims = best + inside, np.take_along_axis(sims, best, 1)
            if inside:
                # the members of the layer above enter first, from the first node
                above = sizes[layer + 1] if layer + 1 < len(sizes) else inside
                start = descend(vectors, layers, q, layer) if inside >= above \
                    else np.zeros((step, 1), np.int64)
                known, near = walk(vectors[:inside], links, start, q, width)
                nodes = np.concatenate([known, nodes], axis=1)
                sims = np.concatenate([near, sims], axis=1)
                if nodes.shape[1] > width:
                    best = np.argpartition(-sims, width, axis=1)[:, :width]
                    nodes = np.take_along_axis(nodes, best, 1)
                    sims = np.take_along_axis(sims, best, 1)
            links[batch, :degree] = choose(vectors, batch, nodes, sims, degree)
            link_back(vectors, links, batch)
            inside += step
    return layers


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision whose products order as the inner products
    with a query do: scaled to at most 1, one more component up to 1."""
    top = np.abs(vectors).max(initial=0) or 1.0
    v = vectors / top
    lengths = np.sqrt((v * v).sum(axis=1))
    v = v / lengths.max(initial=1e-300)
    rest = np.sqrt(np.maximum(0.0, 1.0 - (v * v).sum(axis=1)))
    return np.concatenate([v, rest[:, None]], axis=1).astype(np.float32)


def search_graph(vectors: np.ndarray, graph: np.ndarray, layers: list[np.ndarray], q: np.ndarray,
                 width: int) -> np.ndarray:
    """Nodes (-1: none) that the walk of each query ends with."""
    top = np.abs(q).max(axis=1, keepdims=True, initial=0)
    unit = q / np.where(top > 0, top, 1.0)
    unit = np.pad(unit, ((0, 0), (0, 1))).astype(np.float32)
    out, size = [], together(graph)
    for a in range(0, len(q), size):
        part = unit[a:a + size]
        out.append(walk(graph, layers[0], descend(graph, layers, part, 0), part,
                        min(width, max(1, len(vectors))))[0])
    return np.concatenate(out)


def _stacked(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, x in enumerate(vectors):
        out[i, :len(x)] = x
    return out


def _index(rows: pd.DataFrame, width: int) -> pd.DataFrame:
    """One shard as one row of flat arrays."""
    rows = rows.sort_values(["k1", "k2"])   # the content's hash: a random order that reruns keep
    vectors = _stacked(rows["v"], width)
    layers = build_graph(lifted(vectors))
    return pd.DataFrame([{
        "shard": rows["shard"].iloc[0], "members": len(rows), "width": width,
        "k1": rows["k1"].to_numpy().tobytes(), "k2": rows["k2"].to_numpy().tobytes(),
        "first_id": rows["first_id"].to_numpy().tobytes(), "vectors": vectors.tobytes(),
        "sizes": np.array([len(x) for x in layers], np.int64).tobytes(),
        "neighbours": b"".join(x.tobytes() for x in layers)}])


INDEX_SCHEMA = ("shard long, members long, width long, k1 binary, k2 binary, first_id binary, "
                "vectors binary, sizes binary, neighbours binary")
FOUND_SCHEMA = "qk1 long, qk2 long, k1 long, k2 long, first_id long, score double"


def _layers(sizes: bytes, neighbours: bytes) -> list[np.ndarray]:
    sizes = np.frombuffer(sizes, np.int64)
    flat = np.frombuffer(neighbours, np.int32)
    degree = len(flat) // int(2 * sizes[0] + sizes[1:].sum())
    out, at = [], 0
    for i, n in enumerate(sizes):
        wide = degree * (2 if i == 0 else 1)
        out.append(flat[at:at + n * wide].reshape(n, wide))
        at += n * wide
    return out


def _search(index: pd.DataFrame, queries: pd.DataFrame, k: int, breadth: int) -> pd.DataFrame:
    """The best ``k`` vectors of a shard for each query vector of a block."""
    if not len(index) or not len(queries):
        return pd.DataFrame(columns=["qk1", "qk2", "k1", "k2", "first_id", "score"])
    shard = index.iloc[0]
    n, width = int(shard["members"]), int(shard["width"])
    vectors = np.frombuffer(shard["vectors"]).reshape(n, width)
    q = _stacked(queries["q"], width)
    nodes = search_graph(vectors, lifted(vectors), _layers(shard["sizes"], shard["neighbours"]),
                         q, breadth)
    row, col = np.nonzero(nodes >= 0)
    node = nodes[row, col]
    with np.errstate(over="ignore", invalid="ignore"):
        score = np.einsum("kd,kd->k", vectors[node], q[row])
    names = {c: np.frombuffer(shard[c], np.int64)[node] for c in ("k1", "k2", "first_id")}
    found = pd.DataFrame({"qk1": queries["qk1"].to_numpy()[row], "qk2": queries["qk2"].to_numpy()[row],
                          **names, "score": score, "row": row})
    found = found.sort_values(["score", "first_id"], ascending=[False, True], na_position="first")
    return found.groupby("row", sort=False).head(k).drop(columns="row")


def nearest(spark: SparkSession, vectors: DataFrame, k: int = 20, every: int = 20,
            id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
            query_block: int = QUERY_BLOCK, breadth: int = SEARCH_WIDTH) -> DataFrame:
    """query_id, rank, vec_id, score.  Queries are the rows whose id is divisible
    by ``every``."""
    python_workers(spark, 10_000)  # vectors are short
    given = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = F.col("v").isNotNull() & F.exists("v", lambda x: x != 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = staged(spark, vectors.select(F.col(id_col).cast("long").alias("id"), given.alias("v"))
                  .filter(usable)
                  .select("id", "v", F.xxhash64("v").alias("k1"),
                          F.xxhash64(F.lit("second"), "v").alias("k2"),
                          (F.col("id") % every == 0).alias("asked")), "ann-rows")

    # a vector's smallest ids are all that can be among the k nearest of a row
    by_id = W.partitionBy("k1", "k2").orderBy(F.col("id").asc_nulls_last())
    least = rows.withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= k + 1)
    nodes = staged(spark, least.groupBy("k1", "k2").agg(
        F.first("v").alias("v"),
        F.array_sort(F.collect_list(F.struct(F.col("id").isNull().alias("none"), "id"))).alias("rows"),
    ).withColumn("first_id", F.coalesce(F.col("rows")[0]["id"], F.lit(_NO_ID))), "ann-nodes")
    asked = staged(spark, rows.filter("asked").groupBy(
        F.col("k1").alias("qk1"), F.col("k2").alias("qk2")).agg(F.first("v").alias("q")), "ann-asked")

    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    width = size["width"] or 1
    per_shard = max(2, min(shard_rows, SHARD_BYTES // (8 * width)))
    shards = max(1, -(-size["n"] // per_shard))
    blocks = max(1, -(-asked.count() // query_block))

    index = staged(spark, nodes.select(
        F.pmod(F.xxhash64("k1", F.lit("shard")), F.lit(shards)).cast("long").alias("shard"),
        "k1", "k2", "first_id", "v").groupBy("shard").applyInPandas(
            lambda rows: _index(rows, width), INDEX_SCHEMA), "ann-index")

    def every_one(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    left = index.withColumn("block", every_one(blocks))
    # other names, so the two sides of the cogroup share no column
    right = asked.withColumn("at", F.pmod(F.xxhash64("qk1", F.lit("block")), F.lit(blocks))
                             .cast("long")).withColumn("in_shard", every_one(shards))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("in_shard", "at")).applyInPandas(
        lambda i, q: _search(i, q, k + 1, breadth), FOUND_SCHEMA)

    best = W.partitionBy("qk1", "qk2").orderBy(F.col("score").desc(), "first_id")
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
    # vectors to rows: the k + 1 best rows of each query vector, in order
    found = found.join(nodes.select("k1", "k2", "rows"), ["k1", "k2"]).select(
        "qk1", "qk2", "score", ((F.col("k1") == F.col("qk1")) & (F.col("k2") == F.col("qk2"))
                                ).alias("same"), F.explode("rows").alias("row"))
    order = W.partitionBy("qk1", "qk2").orderBy(F.col("score").desc(), F.col("row.none"),
                                                F.col("row.id"))
    lists = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1) \
        .groupBy("qk1", "qk2").agg(F.array_sort(F.collect_list(
            F.struct("r", F.col("row.id").alias("id"), "score", "same"))).alias("near"))
    # each query row leaves out itself: one occurrence of its id with its own vector
    # is in the list, or the list is full without it
    queries = rows.filter("asked").select(F.col("id").alias("query_id"), F.col("k1").alias("qk1"),
                                          F.col("k2").alias("qk2"))
    own = F.array_position(F.transform("near", lambda x: F.coalesce(
        x["same"] & (x["id"] == F.col("query_id")), F.lit(False))), True)
    others = F.filter("near", lambda x, i: i + 1 != F.col("own"))
    return queries.join(lists, ["qk1", "qk2"]).withColumn("own", F.coalesce(own, F.lit(0))) \
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "x")) \
        .select("query_id", (F.col("place") + 1).cast("int").alias("rank"),
                F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
