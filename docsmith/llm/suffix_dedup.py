"""Removal of repeated byte strings by prefix-free parsing.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else in the corpus, in the same text or another.

Parsing: a rolling hash is taken of every ``trigger`` bytes.  The trigger of a
string of ``length`` bytes is its smallest hash (the leftmost of equal ones), so
it depends on the string alone, and equal strings have equal triggers at equal
places.  Consecutive strings with one trigger form a phrase: the bytes that they
cover.  Phrases overlap by ``length - 1`` bytes, so each string lies in exactly
one phrase, and a text is parsed into about ``2 n / length`` phrases.

Dictionary and parse: the dictionary holds the distinct phrases by trigger, with
their number of occurrences; the parse is the list of a text's phrases.  Only
three cases are left, and for highly repetitive text the first two are nearly all:

1. a trigger that occurs once: none of its strings is repeated;
2. a phrase that occurs twice or more: all of its strings are repeated;
3. a phrase that occurs once beside other phrases of its trigger: it shares at
   most some strings with them.  The trigger's dictionary phrases are cut into
   their strings, which are counted; only here is work done per position, and
   once per distinct phrase, not per occurrence.

The suffix order of the corpus is needed only as far as ``length`` bytes and only
to tell equal from different, so dictionary strings and parse phrases are put in
classes by 128-bit hashes instead of being ranked; README says why.

Scale: every step is an aggregate with partial sums on hashes, or a join of hash
rows that AQE can split.  Texts are shuffled by a hash of their content, once
for the phrases of case 3 and once to cut.  A text is parsed in segments, so
memory is bounded for any text.

Edge cases: null text is empty; texts shorter than ``length`` keep all; results
depend on the texts alone, so repeated rows and null ids are fine; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm.common import content_key, python_workers, staged, text_or_empty

LENGTH, TRIGGER = 400, 64
_PLACE_BITS = 20
#: Bytes parsed at once; places inside fit the low bits of a key.
SEGMENT = (1 << _PLACE_BITS) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64, kept per worker."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = 1 << max(12, (n - 1).bit_length())
        known = np.ones(size, dtype=np.uint64)
        known[1:] = base % (1 << 64)
        known = np.multiply.accumulate(known)
        _POWERS[base] = known
    return known[:n]


def rolling_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """A mixed polynomial hash of every ``width`` consecutive bytes."""
    n = len(raw)
    terms = (raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n)
    sums = np.cumsum(terms, dtype=np.uint64)
    spans = sums[width - 1:].copy()
    spans[1:] -= sums[:n - width]
    spans *= _powers(pow(_BASE, -1, 1 << 64), n - width + 1)
    spans ^= spans >> np.uint64(32)
    spans *= _MIX
    spans ^= spans >> np.uint64(29)
    return spans


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def phrases(raw: np.ndarray, length: int, trigger: int) -> tuple[np.ndarray, ...]:
    """(first, last, place, hash): the starts of the first and last string of each
    phrase of a text of at least ``length`` bytes, its trigger's place and hash."""
    n = len(raw)
    firsts, lasts, places, hashes = [], [], [], []
    step = SEGMENT - length + 1
    for base in range(0, n - length + 1, step):
        part = raw[base:base + SEGMENT]
        hashed = rolling_hashes(part, trigger)
        place = np.arange(len(hashed), dtype=np.uint64)
        keys = (hashed >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | place
        least = _sliding_min(keys, length - trigger + 1) & np.uint64(SEGMENT)
        first = np.concatenate([[0], np.nonzero(least[1:] != least[:-1])[0] + 1])
        last = np.concatenate([first[1:] - 1, [len(least) - 1]])
        firsts.append(first + base)
        lasts.append(last + base)
        at = least[first].astype(np.int64)
        places.append(at + base)
        hashes.append(hashed[at])
    return tuple(map(np.concatenate, (firsts, lasts, places, hashes)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _digest(data: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(data))


def _digest2(data: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(data)
    return _signed(d >> 64), _signed(d & ((1 << 64) - 1))


def _frame(columns: str, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns.split())


def parse(texts: DataFrame, length: int, trigger: int) -> DataFrame:
    """The parse of every text (k1, k2, text): one row per phrase with its place in
    the text, its trigger's hash ``t`` and its own hash ``f``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"]):
                data = text.encode("utf-8", "surrogatepass")
                first, last, place, hashed = phrases(np.frombuffer(data, np.uint8), length, trigger)
                own = [_digest(data[a:b + length])
                       for a, b in zip(first.tolist(), last.tolist())]
                parts.append(pd.DataFrame({
                    "k1": k1, "k2": k2, "first": first, "last": last, "place": place,
                    "t": hashed.view(np.int64), "f": np.array(own, dtype=np.int64)}))
            if parts:
                yield pd.concat(parts)

    return texts.mapInPandas(run, "k1 long, k2 long, first long, last long, place long, t long, "
                                  "f long")


#: Strings of a phrase are compared in nodes of so many neighbours first.
NODE = 16


def cut_nodes(phrase_bytes: DataFrame, length: int) -> DataFrame:
    """Nodes of the phrases (t, f, n, back, size, bytes).  A string is named by
    the distance of its start to the trigger; a node is an aligned range of
    ``NODE`` distances.  (c1, c2) is the class of what all strings of the node
    contain, ``cover`` that of what the phrase's strings in it cover."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t, f, n, back, data in zip(batch["t"], batch["f"], batch["n"], batch["back"],
                                           batch["bytes"]):
                # distances run from `back` at the first byte down to `near`
                near = back - (len(data) - length)
                for node in range(near // NODE, back // NODE + 1):
                    low, high = max(near, node * NODE), min(back, node * NODE + NODE - 1)
                    cover = data[back - high:back - low + length]
                    core = data[back - min(back, node * NODE):
                                max(0, back - (node * NODE + NODE - 1) + length)]
                    c1, c2 = _digest2(b"%d %d " % (t, node) + core)
                    rows.append((t, f, n, low, high, c1, c2,
                                 _digest(b"%d %d " % (low, high) + cover)))
            yield _frame("t f n low high c1 c2 cover", rows)

    return phrase_bytes.select("t", "f", "n", "back", "bytes").mapInPandas(
        run, "t long, f long, n long, low long, high long, c1 long, c2 long, cover long")


def cut_strings(nodes: DataFrame, length: int) -> DataFrame:
    """The single strings of some nodes (t, f, low, high, back, bytes): distance
    and hash of each, with the trigger."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t, f, low, high, back, data in zip(batch["t"], batch["f"], batch["low"],
                                                   batch["high"], batch["back"], batch["bytes"]):
                for d in range(low, high + 1):
                    rows.append((t, f, d, _digest(data[back - d:back - d + length])))
            yield _frame("t f d s", rows)

    return nodes.select("t", "f", "low", "high", "back", "bytes").mapInPandas(
        run, "t long, f long, d long, s long")


#: Buckets of the broadcast filter on texts (an upper bound of its rows).
BUCKETS = 1 << 20


def _texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Each distinct text of ``docs`` (k1, k2, text) that is named in ``keys``."""
    buckets = keys.select(F.pmod("k1", F.lit(BUCKETS)).cast("int").alias("b")).distinct()
    near = docs.withColumn("b", F.pmod("k1", F.lit(BUCKETS)).cast("int")) \
        .join(F.broadcast(buckets), "b", "left_semi").drop("b")
    return near.groupBy("k1", "k2").agg(F.first("text").alias("text"))


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH,
                   trigger: int = TRIGGER) -> DataFrame:
    """(k1, k2, first, last): starts of repeated strings, as ranges, in the texts
    of ``docs`` (k1, k2, text)."""
    parsed = staged(spark, parse(docs, length, trigger), "pfp-parse")
    triggers = parsed.groupBy("t").agg(F.count("*").alias("c"), F.min("f").alias("a"),
                                       F.max("f").alias("b")).filter("c > 1")
    triggers = staged(spark, triggers.select("t", (F.col("a") != F.col("b")).alias("mixed")),
                      "pfp-triggers")
    open_ = staged(spark, parsed.join(triggers, "t"), "pfp-open")
    whole = open_.filter("not mixed").select("k1", "k2", "first", "last")
    mixed = open_.filter("mixed")

    # the dictionary of the triggers with several phrases, with one place of each
    words = staged(spark, mixed.groupBy("t", "f").agg(
        F.count("*").alias("n"),
        F.min(F.struct("k1", "k2", "first", "last", "place")).alias("at"))
        .select("t", "f", "n", "at.*"), "pfp-dictionary")
    often = words.filter("n > 1").select("t", "f")
    whole = whole.unionByName(mixed.join(staged(spark, often, "pfp-often"), ["t", "f"])
                              .select("k1", "k2", "first", "last"))
    wanted = words.groupBy("k1", "k2").agg(F.collect_list(F.struct(
        "t", "f", "n", "first", "last", "place")).alias("wanted"))  # phrases of one text
    wanted = staged(spark, wanted, "pfp-wanted")
    cut = F.explode("wanted").alias("w")
    raw = _texts_of(docs, wanted).join(wanted, ["k1", "k2"]).select(
        F.encode("text", "UTF-8").alias("raw"), cut)
    phrase_bytes = staged(spark, raw.select(
        "w.t", "w.f", "w.n", (F.col("w.place") - F.col("w.first")).alias("back"),
        F.substring("raw", (F.col("w.first") + 1).cast("int"),
                    (F.col("w.last") - F.col("w.first") + length).cast("int")).alias("bytes")),
        "pfp-phrases")

    nodes = staged(spark, cut_nodes(phrase_bytes, length), "pfp-nodes")
    covers = staged(spark, nodes.groupBy("c1", "c2", "cover").agg(
        F.count("*").alias("same"), F.max("n").alias("most"),
        F.min(F.struct("t", "f", "low", "high")).alias("one")), "pfp-covers")
    cores = staged(spark, covers.groupBy("c1", "c2").agg(F.count("*").alias("kinds"))
                   .filter("kinds > 1").select("c1", "c2"), "pfp-cores")
    # a node whose cover is found elsewhere is repeated as a whole
    again = staged(spark, covers.filter("same > 1 or most > 1").select("c1", "c2", "cover"),
                   "pfp-again")
    rare = nodes.filter("n = 1")
    found = rare.join(again, ["c1", "c2", "cover"]).select("t", "f", "low", "high")
    # others are compared string by string with the node's other covers
    split = covers.join(cores, ["c1", "c2"]).select(
        "one.*", (F.greatest("same", "most") == 1).alias("open"))
    split = split.join(phrase_bytes, ["t", "f"])
    strings = staged(spark, cut_strings(split, length), "pfp-strings")
    shared = staged(spark, strings.groupBy("t", "d", "s").agg(F.count("*").alias("c"))
                    .filter("c > 1").select("t", "d", "s"), "pfp-shared")
    single = strings.join(shared, ["t", "d", "s"]).select(
        "t", "f", F.col("d").alias("low"), F.col("d").alias("high"))
    parts = staged(spark, found.unionByName(single), "pfp-parts")
    # those phrases occur once: their place is the dictionary's
    rare_words = words.filter("n = 1").select("t", "f", "k1", "k2", "place")
    some = parts.join(rare_words, ["t", "f"]).select(
        "k1", "k2", (F.col("place") - F.col("high")).alias("first"),
        (F.col("place") - F.col("low")).alias("last"))
    return whole.unionByName(some).distinct()


def keep_rest(text: str, ranges: list, length: int) -> tuple[int, int, str]:
    """(removed bytes, removed runs, SHA-256 of the rest)."""
    data = text.encode("utf-8", "surrogatepass")
    kept, at, removed, runs = hashlib.sha256(), 0, 0, 0
    for first, last in sorted(ranges):
        end = last + length
        if first > at or runs == 0:
            kept.update(data[at:first])
            runs += 1
            removed += end - first
            at = end
        elif end > at:
            removed += end - at
            at = end
    kept.update(data[at:])
    return removed, runs, kept.hexdigest()


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH,
                   trigger: int = TRIGGER, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256."""
    python_workers(spark)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    texts = texts.select("id", "text", *content_key(F.col("text")))
    base = staged(spark, texts.select("id", "k1", "k2", F.octet_length("text").alias("n_bytes"),
                                      F.sha2(F.encode("text", "UTF-8"), 256).alias("whole_sha256")),
                  "pfp-texts")
    long_ = texts.filter(F.octet_length("text") >= length).select("k1", "k2", "text")
    spans = staged(spark, repeated_spans(spark, long_, length, trigger), "pfp-spans")
    lists = staged(spark, spans.groupBy("k1", "k2").agg(  # ranges of one text
        F.collect_list(F.struct("first", "last")).alias("ranges")), "pfp-ranges")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k1, k2, *keep_rest(text, [(r["first"], r["last"]) for r in ranges], length))
                    for k1, k2, text, ranges in zip(batch["k1"], batch["k2"], batch["text"],
                                                    batch["ranges"])]
            yield _frame("k1 k2 n_removed n_spans kept_sha256", rows)

    cleaned = staged(spark, _texts_of(long_, lists).join(lists, ["k1", "k2"]).mapInPandas(
        cut, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string"), "pfp-kept")
    return base.join(cleaned, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.col("n_bytes").cast("long").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
