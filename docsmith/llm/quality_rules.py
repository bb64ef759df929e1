"""Quality rules with risk-controlled thresholds; DataFrame functions only.

Statistics of whole texts give one value per rule.  On labelled holdout rows, the
share of good documents that a rule would reject is its risk.  In every stratum
(language) a rule's cutoffs are tested from the loosest to the strictest: the
hypothesis "this cutoff rejects more than ``risk / rules`` of the good documents"
is refused if the exact binomial tail P(X <= k) at that risk is at most
``error / (rules * strata)``, with k of n good holdout documents rejected.  The
strictest cutoff before the first failure is used; without one, the rule rejects
nothing.  A stratum with so few good documents that no cutoff could pass even if it
rejected none of them takes the cutoffs of the pool of all strata, tested in the
same way in its place, up to the first that rejects more than ``risk / rules`` of
the stratum's own good documents; there the risk is controlled for the pool.
Bonferroni over rules and strata and the fixed order within a rule
control the family-wise error: with probability 1 - error, no tested stratum and
not the pool lose more than ``risk`` of their good documents to all rules together.

Scale: the text is read once, into a few numbers per document.  The test counts
are one aggregate per stratum with partial sums.  Repeated word windows are found
inside a text by sorting the hashes of its windows, without a shuffle.

Edge cases: null text has no words; a null stratum is a stratum of its own; a
document with several labels is good if all are 1; without labels no rule
rejects; repeated rows are counted and kept each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm.common import staged, text_or_empty, words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
RISK, ERROR = 0.02, 0.05


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose ``value`` is beyond the cutoff (a value that does
    not exist is not); ``cutoffs`` run from the loosest to the strictest."""

    name: str
    value: str
    cutoffs: tuple[float, ...]
    above: bool = True

    def rejects(self, cutoff: Column) -> Column:
        value = F.expr(self.value)
        return F.coalesce(value > cutoff if self.above else value < cutoff, F.lit(False))


RULES = (
    Rule("symbols", "try_divide(n_symbols, n_words)", (2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1)),
    Rule("repeated_words", "try_divide(n_repeat_words, n_words)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    Rule("repeated_lines", "try_divide(n_dup_lines, n_lines)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    Rule("short_words", "try_divide(word_chars, n_words)", (2.0, 2.5, 3.0, 3.5, 4.0), above=False),
    Rule("long_words", "try_divide(word_chars, n_words)", (14.0, 12.0, 10.0, 9.0, 8.0, 7.0)),
)


def _repeat_words() -> Column:
    """Words in 3-word windows that are found twice or more; needs the columns
    ``w`` (words) and ``g`` (hash and place of each window, sorted)."""
    twice = F.filter("g", lambda x, i: F.get("g", i - 1)["h"].eqNullSafe(x["h"])
                     | F.get("g", i + 1)["h"].eqNullSafe(x["h"]))
    covered = F.flatten(F.transform(twice, lambda x: F.array(
        x["p"], x["p"] + 1, x["p"] + 2)))
    return F.size(F.array_distinct(covered))


def with_statistics(docs: DataFrame, text_col: str = "text",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns in ``keep`` and the statistics of the whole text (long)."""
    text = text_or_empty(text_col)
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    base = docs.select(*keep, text.alias("t"))
    parts = base.select(*keep, words(F.col("t")).alias("w"), lines.alias("l"),
                        F.length(F.translate("t", SPACES, "")).alias("word_chars"),
                        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).alias("n_symbols"))
    windows = F.transform(F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    hashed = parts.select(*keep, "w", "l", "word_chars", "n_symbols", windows.alias("h"))
    # texts without a repeated window, the common case, need no sort of places
    places = F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p")))))
    sorted_ = hashed.select(*keep, F.size("w").alias("n_words"), "l", "word_chars", "n_symbols",
                            places.alias("g"))
    return sorted_.select(
        *keep, F.col("n_words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size("l").cast("long").alias("n_lines"),
        F.when(F.col("g").isNull(), 0).otherwise(_repeat_words()).cast("long")
        .alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of Binomial(n, p), exact, summed in logarithms."""
    start = F.struct((n * F.log(F.lit(1 - p))).alias("term"), (n * F.log(F.lit(1 - p))).alias("sum"))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p)))
        high, low = F.greatest(state["sum"], term), F.least(state["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    upto = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.least(F.aggregate(upto, start, step, lambda s: F.exp(s["sum"])), F.lit(1.0))


def thresholds(spark: SparkSession, stats: DataFrame, stratum: str, rules: tuple[Rule, ...] = RULES,
               risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Per stratum: one column per rule with its cutoff (null: the rule rejects
    nothing).  ``stats`` has the column ``good`` (boolean or null: no label)."""
    counts = staged(spark, stats.filter("good").groupBy(F.col(stratum).alias("stratum")).agg(
        F.count("*").alias("n"),
        *[F.sum(r.rejects(F.lit(c)).cast("long")).alias(f"k_{r.name}_{i}")
          for r in rules for i, c in enumerate(r.cutoffs)]), "rules-counts")
    # at k over the mean the tail is near a half or more: never significant
    share = risk / len(rules)
    strata = max(1, counts.count())
    level = error / len(rules) / strata
    ks = [f"k_{r.name}_{i}" for r in rules for i, _ in enumerate(r.cutoffs)]
    # too small for zero rejections to pass: the pool is one test in place of one stratum or more
    small = F.pow(F.lit(1 - share), F.col("n")) > level
    pool = counts.agg(F.sum("n").alias("n_pool"), *[F.sum(k).alias(f"pool_{k}") for k in ks])
    counts = counts.crossJoin(F.broadcast(pool)).select(
        "stratum", F.when(small, F.col("n_pool")).otherwise(F.col("n")).alias("n"),
        *[F.when(small, F.when(F.col(k) <= F.col("n") * share, F.col(f"pool_{k}"))
                 .otherwise(F.col("n_pool"))).otherwise(F.col(k)).alias(k) for k in ks])
    tests = counts.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
                 F.col(f"k_{r.name}_{i}").alias("k"))
        for r in rules for i, c in enumerate(r.cutoffs)])).alias("test")).select(
            "stratum", "n", "test.*")
    tail = F.when(F.col("k") > F.col("n") * share + 1, 1.0).otherwise(
        binomial_tail(F.col("k"), F.col("n"), share))
    judged = tests.withColumn("safe", tail <= F.lit(level))
    # the first failure ends a rule's fixed order
    ends = judged.groupBy("stratum", "rule").agg(
        F.coalesce(F.min(F.when(~F.col("safe"), F.col("step"))), F.lit(1 << 30)).alias("end"),
        F.collect_list(F.struct("step", "cutoff")).alias("steps"))  # a rule's cutoffs
    chosen = ends.select("stratum", "rule", F.array_max(
        F.filter("steps", lambda s: s["step"] < F.col("end")))["cutoff"].alias("cutoff"))
    return chosen.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{r.name}")
        for r in rules])


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, stratum: str = "lang",
          rules: tuple[Rule, ...] = RULES, risk: float = RISK, error: float = ERROR,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, stratum, statistics, base_failed, the
    cutoffs, ``rejected_by`` (names of rules) and ``kept``."""
    ids = docs.select(F.col(id_col).alias("id"), F.col(stratum).alias("stratum"),
                      F.col(text_col).alias("text"))
    stats = staged(spark, with_statistics(ids, "text", ("id", "stratum")), "rules-statistics")
    marked = staged(spark, labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
                    .groupBy(F.col("doc_id").alias("id"))
                    .agg((F.min("quality") == 1).alias("good")), "rules-labels")
    cuts = staged(spark, thresholds(spark, stats.join(marked, "id"), "stratum", rules, risk, error),
                  "rules-cutoffs")
    s, c = stats.alias("s"), cuts.alias("c")
    joined = s.join(c, F.col("s.stratum").eqNullSafe(F.col("c.stratum")), "left").drop(cuts["stratum"])
    rejected = F.array_compact(F.array(*[
        F.when(r.rejects(F.col(f"cut_{r.name}")), F.lit(r.name)) for r in rules]))
    out = joined.withColumn("base_failed", base_failed()).withColumn("rejected_by", rejected)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)) \
        .withColumnRenamed("id", id_col)
