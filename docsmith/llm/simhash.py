"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: ASCII letters lower-cased, words, ``shingle``-word shingles with
repeats, XXH64 (seed 42) of each; a bit is 1 if it is set in over half of the
hashes.  A text with fewer words has its whole sequence as one shingle; a text
with none has fingerprint zero and links like any other.

Linking (at most ``radius`` differing bits): every bit position i gets a nonzero
vector m(i) of ``radius + 1`` bits, and every nonzero vector v of that length
gives the mask of the positions with <m(i), v> = 1 (mod 2).  The vectors of
``radius`` differing positions span at most ``radius`` dimensions, so some v is
orthogonal to all of them: its mask avoids every differing bit, and the pair
shares the masked key of that table.  No pair within the radius is missed.

Only distinct fingerprints enter the tables.  In a bucket of several
fingerprints pairs are not enumerated: each member lists the values that it can
reach by flipping at most ``radius / 2`` of the bits outside the mask, and
members that meet in such a value are linked.  Two fingerprints meet if and only
if they differ in ``radius`` bits or fewer (radius 2: one flip from each side;
an odd last bit is given to one side only), so the links are exact, linear in
the bucket's size, and need no cap.

Edge cases: null or empty text has fingerprint 0; null ``doc_id`` takes part but
never names a component (unless all of it is null); repeated rows share their
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm.common import field, packed, row_key, python_workers, staged, unpacked

BITS = 64
SEED = 42
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Hashes whose bits are counted at once: bounds the memory of a long text.
_CHUNK = 1 << 16


def shingle_hashes(text: str, shingle: int) -> list[int]:
    tokens = _WORD.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER))
    if not tokens:
        return []
    joined = b" ".join(tokens)
    if len(tokens) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = (np.cumsum([len(t) + 1 for t in tokens]) - 1).tolist()
    starts = [0] + [e + 1 for e in ends[:-1]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    hashes = shingle_hashes(text or "", shingle)
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[i:i + _CHUNK], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(ones.view("<u8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))
    return compute(text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def masks(radius: int) -> list[int]:
    """The covering masks: one per nonzero vector of ``radius + 1`` bits."""
    width = radius + 1
    vectors = [1 + i % ((1 << width) - 1) for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") % 2)
            for v in range(1, 1 << width)]


def _flips(mask: int, flips: int) -> list[int]:
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [sum(1 << i for i in chosen)
            for k in range(flips + 1) for chosen in combinations(free, k)]


def links(spark: SparkSession, prints: DataFrame, radius: int) -> DataFrame:
    """Star links (a, b) between distinct fingerprints ``fp``: their components
    are those of all pairs at most ``radius`` bits apart."""
    if radius == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    near, far = radius // 2, radius - radius // 2
    tables = masks(radius)
    keyed = prints.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in tables])).alias("t", "key"))
    shared = staged(spark, keyed.groupBy("t", "key").agg(F.count("*").alias("n"))
                    .filter("n > 1").drop("n"), "simhash-buckets")
    members = keyed.join(shared, ["t", "key"])
    near_flips = F.array(*[F.array(*[F.lit(_signed(x)) for x in _flips(m, near)]) for m in tables])
    reach = members.select("t", "fp", F.explode(F.element_at(near_flips, F.col("t") + 1)).alias("x"))
    reach = reach.select("t", "fp", F.col("fp").bitwiseXOR(F.col("x")).alias("z"))
    if far == near:  # symmetric: everyone that reaches z is linked
        groups = reach.groupBy("t", "z").agg(F.collect_set("fp").alias("m")).filter("size(m) > 1")
        return groups.select(F.array_min("m").alias("a"), F.explode("m").alias("b")) \
            .filter("a <> b").distinct()
    far_flips = F.array(*[F.array(*[F.lit(_signed(x)) for x in _flips(m, far)]) for m in tables])
    wide = members.select("t", F.col("fp").alias("b"),
                          F.explode(F.element_at(far_flips, F.col("t") + 1)).alias("x"))
    wide = wide.select("t", "b", F.col("b").bitwiseXOR(F.col("x")).alias("z"))
    return reach.select("t", F.col("fp").alias("a"), "z").join(wide, ["t", "z"]) \
        .filter("a <> b").select("a", "b").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over the edges (a, b), by
    alternating large-star and small-star rounds.  Every round is staged, so no
    lineage grows; hot nodes are joined against a staged aggregate, which AQE
    can split."""
    edges = staged(spark, edges.select("a", "b").filter("a <> b").distinct(), "cc-edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(spark, both.groupBy("a").agg(F.min("b").alias("m"))
                       .select("a", F.least("a", "m").alias("m")), "cc-large")
        large = staged(spark, both.filter("b > a").join(least, "a")
                       .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "cc-edges")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
            .filter("a <> b")
        least = staged(spark, down.groupBy("a").agg(F.min("b").alias("m")), "cc-small")
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .filter("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        edges = staged(spark, small.distinct(), "cc-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
    # at the fixed point every edge is (node, root)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def simhash_components(spark: SparkSession, docs: DataFrame, shingle: int = 3, radius: int = 2,
                       id_col: str = "doc_id", text_col: str = "text",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (signed long), ``root`` (the
    component's own fingerprint), ``component_id`` (smallest id of the component)
    and the columns named in ``keep``."""
    python_workers(spark)
    prints = staged(spark, docs.select(
        F.col(id_col).alias("id"), *keep,
        fingerprint_column(F.col(text_col), shingle).alias("fp")), "simhash-prints")
    distinct = staged(spark, prints.groupBy("fp").agg(F.min("id").alias("least_id")),
                      "simhash-distinct")
    roots = staged(spark, components(spark, links(spark, distinct.select("fp"), radius)),
                   "simhash-roots")
    # only linked fingerprints have a root; the others are their own component
    linked = roots.select(F.col("node").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct())
    rooted = staged(spark, distinct.join(linked, "fp", "left")
                    .select("fp", "least_id", F.coalesce("root", "fp").alias("root")),
                    "simhash-rooted")
    least = staged(spark, rooted.groupBy("root").agg(F.min("least_id").alias("component_id")),
                   "simhash-least")
    named = staged(spark, rooted.join(least, "root"), "simhash-named")
    return prints.join(named.select("fp", "root", "component_id"), "fp") \
        .select(F.col("id").alias(id_col), "fp", "root", "component_id", *keep)


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = 3, radius: int = 2,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of its
    smallest id (ties, and components without any id: smallest content hash; of
    fully equal rows, one)."""
    keyed = packed(docs).select("_in", *row_key(docs.columns))
    found = simhash_components(
        spark, keyed.select("k1", "k2", field(id_col).alias("id"), field(text_col).alias("text")),
        shingle, radius, "id", "text", keep=("k1", "k2"))
    rows = found.groupBy("root", "k1", "k2", "id").agg(F.count("*").alias("n"))
    best = rows.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2", "n")).alias("row"))
    chosen = staged(spark, best.select("row.k1", "row.k2", "row.n"), "simhash-chosen")
    # most rows are unique; only repeated ones need to be merged into one
    once = keyed.join(chosen.filter("n = 1").select("k1", "k2"), ["k1", "k2"], "left_semi")
    repeated = keyed.join(chosen.filter("n > 1").select("k1", "k2"), ["k1", "k2"], "left_semi") \
        .dropDuplicates(["k1", "k2"])
    return once.unionByName(repeated).select(*unpacked(docs.columns))
