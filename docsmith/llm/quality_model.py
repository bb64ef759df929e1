"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of every whole text are computed once and staged.  The trees are
fitted on the driver from a bounded sample of labelled rows (``MAX_LABELLED``,
those of the smallest id hash): features are cut into quantile bins, and each
level of a tree finds its splits from per-bin sums of gradients and Hessians.
All trees are flattened into arrays of one shape (complete trees, children of
node i at 2 i + 1 and 2 i + 2); a batch of rows goes down all trees at once by
indexing.

Labels are learned only from rows that are not held out: crc32 of the id as text
modulo 4 is not 2.  Ids, languages, sources and labels are never inputs.

Edge cases: null text is empty and is scored like one; a null id is neither held
out nor labelled; several labels of an id are averaged; without any label every
score is 0.5; repeated rows are scored each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm.common import python_workers, staged, text_or_empty

MAX_LABELLED = 50_000
THRESHOLD = 0.7
FEATURES = (
    "log_words", "word_bytes", "short_words", "long_words", "distinct_words", "top_word",
    "distinct_trigrams", "log_lines", "line_words", "distinct_lines", "upper", "digits", "spaces",
    "wide_bytes", "symbols", "pipes", "bangs", "stops", "commas", "quotes", "other_marks")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _bytes_of(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), dtype=np.uint8)


_SYMBOLS, _QUOTES = _bytes_of("#*$%&<>"), _bytes_of("\"'`")
_OTHER = _bytes_of("()[]{}@/\\^_~+=:;?-")


def statistics(text: str) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    seen = np.bincount(raw, minlength=256)
    tokens = _WORD.findall(text)
    n, size = max(1, len(tokens)), max(1, len(raw))
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    number: dict[str, int] = {}
    codes = np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int64, len(tokens))
    top = int(np.bincount(codes).max()) if len(codes) else 0
    trigrams = 1.0
    if len(codes) > 2:
        base = len(number) + 1
        mixed = (codes[:-2].astype(np.uint64) * np.uint64(base) + codes[1:-1].astype(np.uint64)) \
            * np.uint64(base) + codes[2:].astype(np.uint64)
        trigrams = len(np.unique(mixed)) / len(mixed)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    return [
        np.log1p(len(tokens)), lengths.sum() / n, (lengths <= 3).sum() / n,
        (lengths >= 14).sum() / n, len(number) / n, top / n, trigrams, np.log1p(len(lines)),
        len(tokens) / max(1, len(lines)), len(set(lines)) / max(1, len(lines)),
        seen[65:91].sum() / size, seen[48:58].sum() / size, (seen[32] + seen[9:14].sum()) / size,
        seen[128:].sum() / size, seen[_SYMBOLS].sum() / n, seen[124] / n, seen[33] / n,
        seen[46] / n, seen[44] / n, seen[_QUOTES].sum() / n, seen[_OTHER].sum() / n]


def with_statistics(docs: DataFrame, id_col: str, text_col: str,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    @F.pandas_udf("array<float>")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(statistics(t), dtype=np.float32) for t in texts])

    return docs.select(F.col(id_col).alias("id"), *keep,
                       compute(text_or_empty(text_col)).alias("x"))


@dataclass
class Trees:
    """Flattened trees: arrays of (trees, nodes); ``value`` of (trees, leaves)."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        trees, nodes = self.feature.shape
        at = np.zeros((len(x), trees), dtype=np.int64)
        tree = np.arange(trees)[None, :]
        rows = np.arange(len(x))[:, None]
        for _ in range((nodes + 1).bit_length() - 1):
            right = x[rows, self.feature[tree, at]] > self.cut[tree, at]
            at = 2 * at + 1 + right
        return self.base + self.value[tree, at - nodes].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15,
        bins: int = 64, ridge: float = 1.0, min_weight: float = 1.0) -> Trees:
    """Gradient boosting of the logistic loss; ``y`` between 0 and 1."""
    nodes, leaves = (1 << depth) - 1, 1 << depth
    feature = np.zeros((rounds, nodes), dtype=np.int64)
    cut = np.full((rounds, nodes), np.inf)
    value = np.zeros((rounds, leaves))
    if not len(y):
        return Trees(feature, cut, value, 0.0)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    x = x.astype(np.float64)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
             for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    score = np.full(len(y), base)
    for t in range(rounds):
        p = 1.0 / (1.0 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            gain = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cells = (at - first) * (bins + 1) + binned[:, f]
                shape = (width, bins + 1)
                g = np.bincount(cells, grad, width * (bins + 1)).reshape(shape).cumsum(axis=1)
                h = np.bincount(cells, hess, width * (bins + 1)).reshape(shape).cumsum(axis=1)
                left_g, left_h = g[:, :len(e)], h[:, :len(e)]
                all_g, all_h = g[:, -1:], h[:, -1:]
                better = left_g ** 2 / (left_h + ridge) \
                    + (all_g - left_g) ** 2 / (all_h - left_h + ridge) \
                    - all_g ** 2 / (all_h + ridge)
                better[(left_h < min_weight) | (all_h - left_h < min_weight)] = -1
                best = better.argmax(axis=1)
                top = better[np.arange(width), best]
                for i in np.nonzero(top > gain)[0]:
                    gain[i] = top[i]
                    feature[t, first + i], cut[t, first + i] = f, e[best[i]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > cut[t, at])
        leaf = at - nodes
        g = np.bincount(leaf, grad, leaves)
        h = np.bincount(leaf, hess, leaves)
        value[t] = -rate * g / (h + ridge)
        score += value[t][leaf]
    return Trees(feature, cut, value, base)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality",
          label_id: str = "doc_id", max_labelled: int = MAX_LABELLED) -> Trees:
    """Fit on at most ``max_labelled`` labelled rows of ``stats`` (id, x) that are
    not held out."""
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(label_id).isNotNull()) \
        .groupBy(F.col(label_id).alias("id")).agg(F.avg(label_col).alias("y"))
    marked = marked.filter(~held_out("id"))
    rows = stats.join(marked, "id").select("x", "y", F.xxhash64("id").alias("h"), "id") \
        .orderBy("h", "id").limit(max_labelled).select("x", "y").toPandas()  # bounded
    x = np.stack(rows["x"].to_numpy()) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit(x, rows["y"].to_numpy(dtype=np.float64))


def with_scores(stats: DataFrame, trees: Trees) -> DataFrame:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(trees.score(np.stack(x.to_numpy()).astype(np.float64))
                            if len(x) else [], dtype="float64")

    return stats.withColumn("score", score("x")).drop("x")


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame,
             threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED,
             id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted."""
    python_workers(spark)
    stats = staged(spark, with_statistics(docs, id_col, text_col, keep), "quality-statistics")
    trees = train(stats, labels, max_labelled=max_labelled)
    scored = with_scores(stats, trees).withColumnRenamed("id", id_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), *keep)


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame,
              threshold: float = THRESHOLD, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts.  The text is scored where
    it lies, so nothing is shuffled back to it."""
    python_workers(spark)
    stats = staged(spark, with_statistics(docs, id_col, text_col), "quality-statistics")
    trees = train(stats, labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(trees.score(np.array([np.asarray(statistics(t), dtype=np.float32)
                                               for t in texts], dtype=np.float64)
                                     .reshape(-1, len(FEATURES))))

    return docs.filter(score(text_or_empty(text_col)) >= threshold)
