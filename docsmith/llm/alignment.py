"""Cross-tokenizer alignment: divide and conquer at shared cuts.

Two tokenizers cut the same bytes of a document.  A byte offset where a token of
both ends is a shared cut.  An interval of the text that starts and ends at shared
cuts is split at the shared cut nearest its middle, found by bisection: the end of
an A token near the middle is looked up among the ends of B, then its neighbours
on either side in turn.  Both halves recurse; an interval without a shared cut
inside is a leaf, one group of tokens of A and of B that have the same bytes.  All
intervals of a block of documents recurse together, a level at a time.  Inside a
group, A and B tokens whose bytes overlap are linked.

Corpus counts: the number of documents that hold an id pair linked.  Documents are
aligned in blocks of about ``block_bytes`` of text; a block returns each of its
pairs once, with its number of documents, and every document's links as places in
that list.  So what is counted and joined over the corpus are pairs of blocks, not
links; the counts go back to their blocks, and each block scores its documents.

Scale: alignment is one pass over the text, staged, with bounded memory per task
(a block, or one longer document).  Counting is a partial aggregate by pair; a
pair of every block has one row per block, which a join can split.  Nothing is
collected or broadcast.  The tokenizers' tables are read by each worker.

Edge cases: null and empty texts, and texts whose tokens do not spell a space and
the text (in UTF-8) for both tokenizers, have no tokens: zeros and an empty
digest, and hold no pair; special tokens written in a text are plain text; every
row is a document, also repeated rows and rows with a null id; ties for the
highest count are all best; a very long text is a block of its own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsmith.llm.common import python_workers, staged
from docsmith.llm.packing import encoder, public_vocabulary

#: Text that is aligned together.
BLOCK_BYTES = 4 << 20
#: Bytes of text whose ids are Python objects at a time (at least a text).
_ENCODED_BYTES = 256 << 10
#: Pairs of a block in one row.
_PAIRS = 4096
#: Neighbours of the middle that are looked up one by one, before windows.
_TRIES = 12

ALIGNED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, links array<int>, first int, pairs array<long>, docs array<int>")
SCORED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, ranks_path: str, pattern: str, model_path: str):
        import sentencepiece
        self.a = encoder(ranks_path, pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.a_bytes = [self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab)]
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                        else piece.replace("▁", " ").encode()
                        for i, piece in ((i, self.b.id_to_piece(i))
                                         for i in range(self.b.get_piece_size()))]
        self.a_sizes = [len(x) for x in self.a_bytes]
        self.a_len = np.array(self.a_sizes)
        self.b_len = np.array([len(x) for x in self.b_bytes])
        # ids as text with what follows them: another of the side, or the side's end
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        self.written = [b"%d%s" % (i, end) for n, ends in ((n_a, b",|"), (n_b, b",;"))
                        for end in (ends[:1], ends[1:]) for i in range(n)]
        self.b_written = 2 * n_a

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of both sides of each text; none where either does not spell it."""
        a = [self.a.encode_ordinary(" " + text) if text else [] for text in texts]
        b = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(texts):
            want = (" " + text).encode() if text else b""
            # a byte-level BPE spells every text: its length tells
            if b"".join(map(self.b_bytes.__getitem__, b[i])) != want \
                    or sum(map(self.a_sizes.__getitem__, a[i])) != len(want):
                a[i], b[i] = [], []
        return a, b


@lru_cache(maxsize=2)
def tokenizers(ranks_path: str, pattern: str, model_path: str) -> Tokenizers:
    return Tokenizers(ranks_path, pattern, model_path)


def _nearest_shared(ends_a: np.ndarray, ends_b: np.ndarray, lo: int, hi: int, middle: int) -> int:
    """The A end in [lo, hi) nearest to place ``middle`` that B shares, or -1: windows
    that double until one holds a shared end."""
    width = 2 * _TRIES
    while True:
        a, b = max(lo, middle - width), min(hi, middle + width)
        place = np.searchsorted(ends_b, ends_a[a:b])
        shared = np.nonzero(ends_b[place] == ends_a[a:b])[0]
        if len(shared):
            return a + int(shared[np.abs(shared + a - middle).argmin()])
        if a == lo and b == hi:
            return -1
        width *= 2


def split(ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """Leaf groups: the place after each group's last token of A and of B, in order.
    ``ends_*`` are the ascending byte ends of a block's tokens, ``docs_*`` the place
    after each document's last token; every document has tokens of both sides."""
    a_lo, a_hi = np.append(0, docs_a[:-1]), docs_a
    b_lo, b_hi = np.append(0, docs_b[:-1]), docs_b
    leaves_a, leaves_b = [], []
    while len(a_lo):
        whole = (a_hi - a_lo == 1) | (b_hi - b_lo == 1)   # nothing inside on one side
        leaves_a.append(a_hi[whole])
        leaves_b.append(b_hi[whole])
        a_lo, a_hi, b_lo, b_hi = (x[~whole] for x in (a_lo, a_hi, b_lo, b_hi))
        if not len(a_lo):
            break
        start = np.where(a_lo > 0, ends_a[a_lo - 1], 0)
        last = a_hi - 1            # the interval's own end is no cut inside it
        middle = np.minimum(np.searchsorted(ends_a, (start + ends_a[last]) // 2), last - 1)
        middle = np.maximum(middle, a_lo)
        cut = np.full(len(a_lo), -1)
        left = np.arange(len(a_lo))
        for i in range(_TRIES):
            off = (i + 1) // 2 if i % 2 else -(i // 2)
            at = middle[left] + off
            inside = (at >= a_lo[left]) & (at < last[left])
            row, at = left[inside], at[inside]
            end = ends_a[at]
            hit = ends_b[np.searchsorted(ends_b, end)] == end
            cut[row[hit]] = at[hit]
            off = i // 2 + 1
            more = (cut[left] < 0) & ((middle[left] - off >= a_lo[left])
                                      | (middle[left] + off < last[left]))
            left = left[more]
            if not len(left):
                break
        for row in left:
            cut[row] = _nearest_shared(ends_a, ends_b, a_lo[row], last[row], middle[row])
        leaf = cut < 0
        leaves_a.append(a_hi[leaf])
        leaves_b.append(b_hi[leaf])
        a_lo, a_hi, b_lo, b_hi, cut = (x[~leaf] for x in (a_lo, a_hi, b_lo, b_hi, cut))
        mid_a = cut + 1
        mid_b = np.searchsorted(ends_b, ends_a[cut]) + 1
        # halves side by side: intervals stay in the order of the text, which keeps
        # the bisections of a level close together in memory
        a_lo, a_hi = np.stack([a_lo, mid_a], 1).ravel(), np.stack([mid_a, a_hi], 1).ravel()
        b_lo, b_hi = np.stack([b_lo, mid_b], 1).ravel(), np.stack([mid_b, b_hi], 1).ravel()
    return np.sort(np.concatenate(leaves_a)), np.sort(np.concatenate(leaves_b))


def written_groups(t: Tokenizers, ids_a: np.ndarray, ids_b: np.ndarray, groups_a: np.ndarray,
                   groups_b: np.ndarray) -> np.ndarray:
    """Places in ``t.written`` of a block's tokens, group by group, A before B."""
    out = np.empty(len(ids_a) + len(ids_b), np.int64)
    first_a, first_b = np.append(0, groups_a)[:-1], np.append(0, groups_b)[:-1]
    end_a, end_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    end_a[groups_a - 1], end_b[groups_b - 1] = True, True
    out[np.arange(len(ids_a)) + np.repeat(first_b, groups_a - first_a)] = \
        ids_a + len(t.a_bytes) * end_a
    out[np.arange(len(ids_b)) + np.repeat(groups_a, groups_b - first_b)] = \
        t.b_written + ids_b + len(t.b_bytes) * end_b
    return out


def _flat(lists: list) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def encoded(t: Tokenizers, texts: list[str], some: int = _ENCODED_BYTES
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The number of A and B ids of each text, then all A and all B ids.  Texts are
    encoded about ``some`` bytes at a time: as lists, the ids of a block would take
    several times the memory of its arrays."""
    parts, first, size = [], 0, 0
    for i, text in enumerate(texts, 1):
        size += 4 + len(text)
        if size >= some or i == len(texts):
            a, b = t.encode(texts[first:i])
            parts.append((np.fromiter(map(len, a), np.int64), np.fromiter(map(len, b), np.int64),
                          _flat(a), _flat(b)))
            first, size = i, 0
    none = np.empty(0, np.int64)
    return tuple(np.concatenate([none, *x]) for x in zip(*parts)) if parts else (none,) * 4


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _list_array(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()),
                                    pa.array(values, kind))


def align_block(t: Tokenizers, block: int, doc_ids: pa.Array, texts: list[str]
                ) -> Iterator[pa.RecordBatch]:
    """The rows of a block: its documents, then its pairs."""
    n_a, n_b, ids_a, ids_b = encoded(t, texts)
    ends_a, ends_b = t.a_len[ids_a].cumsum(), t.b_len[ids_b].cumsum()
    has = n_a > 0
    docs_a, docs_b = n_a.cumsum(), n_b.cumsum()
    groups_a, groups_b = split(ends_a, ends_b, docs_a[has], docs_b[has]) if has.any() else \
        (np.empty(0, np.int64),) * 2
    upto = np.searchsorted(groups_a, docs_a, side="right")
    n_groups = np.diff(np.append(0, upto))
    n_links = np.where(has, n_a + n_b - n_groups, 0)

    codes = written_groups(t, ids_a, ids_b, groups_a, groups_b)
    tokens = np.append(0, (n_a + n_b).cumsum()).tolist()
    digests = [hashlib.sha256(b"".join(map(t.written.__getitem__, codes[s:e].tolist()))[:-1]).hexdigest()
               if e > s else "" for s, e in zip(tokens, tokens[1:])]
    del codes

    # between two neighbouring ends of either side lie one token of A and one of B
    ends = distinct(np.concatenate([ends_a, ends_b]))
    links = ids_a[np.searchsorted(ends_a, ends)] << 32 | ids_b[np.searchsorted(ends_b, ends)] \
        if len(ends) else np.empty(0, np.int64)
    pairs = distinct(links)
    place = np.searchsorted(pairs, links)
    held = distinct(np.repeat(np.arange(len(texts)), n_links) * max(1, len(pairs)) + place)
    docs = np.bincount(held % max(1, len(pairs)), minlength=len(pairs))

    n, link_ends = len(texts), n_links.cumsum()
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                        ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                        ("groups_sha256", pa.string()), ("links", pa.list_(pa.int32())),
                        ("first", pa.int32()), ("pairs", pa.list_(pa.int64())),
                        ("docs", pa.list_(pa.int32()))])

    def rows(count: int, **columns) -> pa.RecordBatch:
        full = [columns.get(f.name, pa.nulls(count, f.type)) for f in schema]
        return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(full, schema)],
                                          schema=schema)

    same = pa.array(np.full(n, block))
    yield rows(n, block=same, doc_id=doc_ids, n_a=pa.array(n_a), n_b=pa.array(n_b),
               n_groups=pa.array(n_groups), n_links=pa.array(n_links),
               groups_sha256=pa.array(digests), links=_list_array(place, link_ends, pa.int32()))
    first = np.arange(0, len(pairs), _PAIRS)
    upto = np.minimum(first + _PAIRS, len(pairs))
    if len(first):
        yield rows(len(first), block=pa.array(np.full(len(first), block)), first=pa.array(first),
                   pairs=_list_array(pairs, upto, pa.int64()),
                   docs=_list_array(docs, upto, pa.int32()))


def _blocks(paths: tuple, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*paths)
        block = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(doc)
                texts.append(text)
                size += 4 + len(text)
                if size >= block_bytes:
                    yield from align_block(t, block, pa.array(ids, pa.int64()), texts)
                    block += 1
                    ids, texts, size = [], [], 0
        if ids:
            yield from align_block(t, block, pa.array(ids, pa.int64()), texts)
    return run


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with the counts of its pairs."""
    n = len(counts)
    place = counts.column("place").to_numpy()
    count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    count[place] = counts.column("count").to_numpy()
    best[place] = counts.column("best").to_numpy()
    docs = docs.combine_chunks()
    links = np.concatenate([x.flatten().to_numpy() for x in docs.column("links").chunks]
                           or [np.empty(0, np.int32)])
    upto = np.append(0, docs.column("n_links").to_numpy().cumsum())

    def sums(of: np.ndarray) -> pa.Array:
        total = np.append(0, of[links].cumsum())
        return pa.array(total[upto[1:]] - total[upto[:-1]])

    columns = {"n_best": sums(best), "count_sum": sums(count)}
    names = [x.split()[0] for x in SCORED.split(", ")]
    return pa.table({c: columns[c] if c in columns else docs.column(c) for c in names})


def align(spark: SparkSession, docs: DataFrame, vocabulary: tuple[str, str] | None = None,
          model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    python_workers(spark)
    if model_path is None:
        import public_tokenizers
        model_path = public_tokenizers.path("piece_bpe_32k.model")
    paths = (*(vocabulary or public_vocabulary()), model_path)
    texts = docs.select(F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = staged(spark, texts.mapInArrow(_blocks(paths, block_bytes), ALIGNED), "align-blocks")

    pairs = rows.filter(F.col("pairs").isNotNull()).select(
        "block", "first", F.posexplode(F.arrays_zip("pairs", "docs")).alias("i", "x")).select(
        "block", (F.col("first") + F.col("i")).alias("place"), F.col("x.pairs").alias("pair"),
        F.col("x.docs").cast("long").alias("docs"))
    of_a = W.partitionBy("a")   # at most as many rows as B has ids
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count")) \
        .withColumn("a", F.shiftright("pair", 32)) \
        .withColumn("best", (F.col("count") == F.max("count").over(of_a)).cast("long")).drop("a")
    look = pairs.join(counts, "pair").select(F.col("block").alias("of_block"), "place", "count", "best")
    aligned = rows.filter(F.col("pairs").isNull()).drop("first", "pairs", "docs")
    return aligned.groupBy("block").cogroup(look.groupBy("of_block")).applyInArrow(_scored, SCORED)
