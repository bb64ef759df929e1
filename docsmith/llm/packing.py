"""Cost-balanced packing of token sequences.

Documents are tokenised once (ids of the public byte-level BPE, plus one id 0 at
the end) and cut at multiples of the sequence capacity: full pieces are
sequences of their own, and the rest of a document, shorter than a sequence, is
one piece.  A sequence costs ``linear * tokens + quadratic * sum(length^2)``
(attention is within a document's piece).  Pieces are assigned in descending
order of cost to the sequence of the lowest cost that still has room; a piece
that fits nowhere opens a sequence.

Scale: pieces are dealt by a hash of their content into packing groups whose
number follows the measured token count, so every group has about
``group_tokens`` tokens whatever the sources or copies look like, and each group
is packed by one task.  A group starts with as many sequences as its tokens
need, which is what balances the costs.  Padding beyond the last sequences of a
group is not affected by the number of groups.

The result depends on the contents alone, not on how the input is split into files.

Edge cases: null text is empty and still has its id 0; a special token written in a
text is that token; ties in cost go to the sequence opened first; a very long text
is encoded whole and cut; every row is packed, also repeated rows and rows with a null id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm.common import numbered, python_workers, staged, text_or_empty

END_ID = 0
#: Tokens that one task packs; bounds its memory.
GROUP_TOKENS = 16 << 20
# The special tokens of the public byte-level BPE.
SPECIAL_TOKENS = {"<|endoftext|>": 50256}
_ENCODERS: dict[str, object] = {}


def encoder(ranks_path: str, pattern: str):
    """The byte-level BPE, once per Python worker.  tiktoken and tokenizers give
    the same ids for one vocabulary (tests compare them); tiktoken is 4 to 5
    times as fast.  ``encode_ordinary`` takes special tokens in a text as plain
    text, ``encode_with_special`` as themselves."""
    if ranks_path not in _ENCODERS:
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[ranks_path] = tiktoken.Encoding(
            "byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL_TOKENS)
    return _ENCODERS[ranks_path]


def encode_with_special(bpe, text: str) -> list[int]:
    """Ids as the public tokenizer gives them without adding any: a special token
    that stands in the text is itself."""
    if any(x in text for x in SPECIAL_TOKENS):
        return bpe.encode(text, allowed_special="all")
    return bpe.encode_ordinary(text)


def public_vocabulary() -> tuple[str, str]:
    """Place of the byte-level vocabulary, and its pretokenisation pattern."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def cut_pieces(docs: DataFrame, capacity: int, ranks_path: str, pattern: str,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(ranks_path, pattern)
        for batch in batches:
            rows = []
            for doc, present, text in zip(batch["id"], batch["present"], batch["text"]):
                ids = np.array([*encode_with_special(bpe, text), END_ID], dtype="<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    rows.append((doc, present, start, len(piece), zlib.crc32(piece.tobytes()),
                                 len(ids)))
            yield pd.DataFrame(rows, columns=["id", "present", "start", "length", "ids_crc32",
                                              "doc_tokens"])

    rows = docs.select(F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("id"),
                       F.col(id_col).isNotNull().alias("present"),
                       text_or_empty(text_col).alias("text"))
    pieces = rows.mapInPandas(
        cut, "id long, present boolean, start long, length long, ids_crc32 long, doc_tokens long")
    return pieces.withColumn("id", F.when(F.col("present"), F.col("id"))).drop("present")


def assign(lengths: np.ndarray, capacity: int, linear: float,
           quadratic: float) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; ``lengths`` in descending order."""
    n = len(lengths)
    sequence, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    full = int((lengths >= capacity).sum())
    sequence[:full], offset[:full] = np.arange(full), 0
    opened = full + -(-int(lengths[full:].sum()) // capacity)
    # open sequences by free room, each a heap by cost; least[r] is its lowest cost
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
    heaps[capacity] = [(0.0, s) for s in range(full, opened)]
    least = np.full(capacity + 1, np.inf)
    if opened > full:
        least[capacity] = 0.0
    for i in range(full, n):
        length = int(lengths[i])
        room = length + int(least[length:].argmin())
        if heaps[room]:
            cost, s = heappop(heaps[room])
            least[room] = heaps[room][0][0] if heaps[room] else np.inf
        else:
            cost, s, room = 0.0, opened, capacity
            opened += 1
        sequence[i], offset[i] = s, capacity - room
        left = room - length
        if left:
            heappush(heaps[left], (cost + linear * length + quadratic * length * length, s))
            least[left] = heaps[left][0][0]
    return sequence, offset


def pack(spark: SparkSession, docs: DataFrame, capacity: int = 1024, linear: float = 1.0,
         quadratic: float = 1.0 / 1024, group_tokens: int = GROUP_TOKENS,
         vocabulary: tuple[str, str] | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence_id and offset."""
    python_workers(spark)
    ranks_path, pattern = vocabulary or public_vocabulary()
    pieces = staged(spark, cut_pieces(docs, capacity, ranks_path, pattern, id_col, text_col),
                    "pack-pieces")
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(tokens / group_tokens))
    # its number among equal pieces spreads copies
    key = F.pmod(F.xxhash64("id", "start", "ids_crc32", "copy"), F.lit(groups)).cast("long")

    def place(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["length", "id", "start", "ids_crc32"], kind="stable",
                                  ascending=[False, True, True, True], na_position="last")
        sequence, offset = assign(batch["length"].to_numpy(), capacity, linear, quadratic)
        return batch.assign(sequence_id=sequence + (batch["g"].to_numpy() << 32), offset=offset)

    placed = numbered(pieces, ["id", "start", "ids_crc32", "length", "doc_tokens"]) \
        .withColumn("g", key).drop("copy").groupBy("g").applyInPandas(
        place, "id long, start long, length long, ids_crc32 long, doc_tokens long, g long, "
               "sequence_id long, offset long")
    return placed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
                         "sequence_id", "offset")
