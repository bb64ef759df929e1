"""Information-theoretic sanitisation of personal data; DataFrame functions only.

Base spans are found in the whole text by pattern and checked (address parts,
card check digits, number of digits).  Their values are the protected entities.
Corpus co-occurrence then estimates what a term tells about an entity.  A line is
one context, and equal lines count once.  For a term t that stands within
``window`` words of an entity e:

    PMI(t; e) = log2(p(t, e) / (p(t) p(e)))         what t reveals of e
    IC(e) - PMI(t; e) = -log2 p(e | t)              what stays uncertain about e

A term discloses e if it reveals ``min_bits`` or more and leaves at most
``residual_bits`` uncertain, from ``support`` contexts beside e on: a single one
is no co-occurrence, any word of the corpus that occurs once would disclose its
neighbour.  Terms have three characters, or two with one of a CJK script.  Every
occurrence of a disclosing term, in any document, becomes a span of kind ``term``
and is removed; base spans are generalised to their kind.

Positions: the pieces between matches (split) and the matches (extract all) of
one pattern alternate, so a fold over both gives code-point positions.  Matches
start at the first character of a run of the kind's characters or where the last
match ended, which is what leftmost non-overlapping search finds, without trying
every character of a long run; repetitions are possessive, so long texts need no
backtracking.

Scale: two passes over the text.  The first stages the spans and the lines with
entities, the second counts candidate terms, after a sample of the
lines has excluded terms with too many contexts (its count is a lower bound of the
exact one): tokens are first filtered against the hash buckets of the candidates (at most ``BUCKETS`` numbers are broadcast,
whatever the corpus holds), so only those go through a shuffle.  Texts are
shuffled only where they contain a disclosing term.

Edge cases: null text is empty and stays null when sanitised; results depend on
the text alone, so repeated rows and null or repeated ids get equal results; an
empty table gives an empty result; other columns are kept (sanitise) or ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsmith.llm.common import content_key, field, packed, staged, text_or_empty

_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: kind, pattern, characters without which there is no match.
KINDS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
     "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", ""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)
TERM = "term"
TOKEN = r"[\p{L}\p{N}]++"
NOT_TOKEN = r"[^\p{L}\p{N}]++"
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string>>"
#: Upper bound of the broadcast filters.
BUCKETS = 1 << 18
WINDOW, SUPPORT, MIN_BITS, RESIDUAL_BITS = 8, 2, 8.0, 0.5
CJK = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"
#: One of so many lines is in the sample.
SAMPLE = 16


def _valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(f"^{_PART}[.]{_PART}[.]{_PART}[.]{_PART}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def found(text: Column, pattern: str, kind: str, number: int,
          valid: Callable[[Column], Column]) -> Column:
    """Spans of the valid matches, as an array of ``SPAN``."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    none = F.array().cast(SPAN)

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["hit"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind_no"),
                                end.alias("end"), F.lit(kind).alias("kind")))
        good = piece["hit"].isNotNull() & valid(piece["hit"])
        return F.struct(end.alias("at"), F.when(good, F.concat(state["spans"], span))
                        .otherwise(state["spans"]).alias("spans"))

    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("spans")), step,
                       lambda s: s["spans"])


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind."""
    each = []
    for number, (kind, pattern, needs) in enumerate(KINDS):
        spans = found(text, pattern, kind, number, lambda hit, k=kind: _valid(k, hit))
        may = text.contains(needs) if needs else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
        each.append(F.when(may, spans).otherwise(F.array().cast(SPAN)))
    return F.array_sort(F.concat(*each))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _bucket(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def analyse(spark: SparkSession, docs: DataFrame, text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """First pass, staged: ``keep``, the text's key, its base spans, the keys of its
    lines and the lines that hold a span."""
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"@|[0-9][ .-]?[0-9]"))
    base = docs.select(*keep, text_or_empty(text_col).alias("t"))
    spans = base.select(*keep, "t", base_spans(F.col("t")).alias("spans"))
    return staged(spark, spans.select(
        *keep, *content_key(F.col("t")), "spans", F.array_distinct(F.transform(
            F.split("t", "\n"), lambda x: F.xxhash64(x))).alias("line_keys"),
        F.when(F.size("spans") > 0, lines).alias("lines")), "pii-base")


def entity_terms(base: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (entity, line, term): terms within ``window`` words of an entity
    in one line, not beyond the next entity."""
    lines = base.select(F.explode("lines").alias("line")).select(
        F.xxhash64("line").alias("line_key"), "line").dropDuplicates(["line_key"])
    spans = lines.select("line_key", "line", base_spans(F.col("line")).alias("spans"))
    each = spans.select("line_key", "line", "spans", F.posexplode("spans").alias("i", "s"))

    def part(start: Column, end: Column) -> Column:
        return F.split(F.lower(F.substring("line", start + 1, F.greatest(end - start, F.lit(0)))),
                       NOT_TOKEN)

    before = F.coalesce(F.get("spans", F.col("i") - 1)["end"], F.lit(0))
    after = F.coalesce(F.get("spans", F.col("i") + 1)["start"], F.length("line"))
    terms = F.concat(F.slice(F.reverse(part(before, F.col("s.start"))), 1, window),
                     F.slice(part(F.col("s.end"), after), 1, window))
    entity = F.concat_ws(":", "s.kind", F.lower(F.substring(
        "line", F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))))
    return each.select("line_key", entity.alias("entity"), F.explode(F.array_distinct(F.filter(
        terms, lambda t: (F.length(t) >= 3) | ((F.length(t) == 2) & t.rlike(CJK))))).alias("term")) \
        .distinct()


def _uncertain(c_te: Column, c: Column) -> Column:
    """Bits that a term with ``c_te`` of ``c`` contexts beside an entity leaves open."""
    return -F.log2(c_te / c)


def _hits(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """(k1, k2, line_key, term): the occurrences of the pairs' terms in ``lines``."""
    terms = pairs.select("term").distinct()
    buckets = terms.select(_bucket(F.col("term")).alias("b")).distinct()
    tokens = lines.select("k1", "k2", "line_key", F.explode(
        F.array_distinct(F.split(F.lower("line"), NOT_TOKEN))).alias("term"))
    near = tokens.withColumn("b", _bucket(F.col("term"))) \
        .join(F.broadcast(buckets), "b", "left_semi").drop("b")
    return near.join(terms, "term", "left_semi")


def _counted(hits: DataFrame) -> DataFrame:
    return hits.select("term", "line_key").distinct().groupBy("term").agg(F.count("*").alias("c_t"))


def disclosing_texts(spark: SparkSession, docs: DataFrame, base: DataFrame, text_col: str = "text",
                     window: int = WINDOW, support: int = SUPPORT, min_bits: float = MIN_BITS,
                     residual_bits: float = RESIDUAL_BITS) -> DataFrame | None:
    """(k1, k2, terms): the disclosing terms of each text that has any, staged;
    None if no term has enough support."""
    near = staged(spark, entity_terms(base, window), "pii-near")
    of_entity = near.select("entity", "line_key").distinct().groupBy("entity") \
        .agg(F.count("*").alias("c_e"))
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("c_te")) \
        .filter(F.col("c_te") >= support)
    # a term stands on at least the lines counted here, whatever the rest of the
    # corpus holds: terms that stand beside many entities need no corpus count
    of_lines = near.select("term", "line_key").distinct().groupBy("term") \
        .agg(F.count("*").alias("c_n"))
    pairs = staged(spark, pairs, "pii-pairs").join(of_lines, "term") \
        .filter(_uncertain(F.col("c_te"), F.col("c_n")) <= residual_bits)
    pairs = staged(spark, pairs.join(of_entity, "entity"), "pii-candidates")
    if pairs.isEmpty():
        return None
    lines = docs.select(text_or_empty(text_col).alias("t")).select(
        *content_key(F.col("t")), F.explode(F.split("t", "\n")).alias("line"))
    lines = lines.withColumn("line_key", F.xxhash64("line"))
    few = _counted(_hits(lines.filter(F.pmod("line_key", F.lit(SAMPLE)) == 0), pairs))
    pairs = staged(spark, pairs.join(few, "term", "left").filter(
        F.col("c_t").isNull() | (_uncertain(F.col("c_te"), F.col("c_t")) <= residual_bits))
        .drop("c_t"), "pii-rare")
    if pairs.isEmpty():
        return None
    hits = staged(spark, _hits(lines, pairs), "pii-hits")
    of_term = _counted(hits)
    n = base.select(F.explode("line_keys").alias("line_key")).distinct().count()
    told = pairs.join(of_term, "term").filter(
        (F.log2(F.lit(float(n)) * F.col("c_te") / (F.col("c_t") * F.col("c_e"))) >= min_bits)
        & (_uncertain(F.col("c_te"), F.col("c_t")) <= residual_bits))
    told = staged(spark, told.select("term").distinct(), "pii-told")
    return staged(spark, hits.join(told, "term").select("k1", "k2", "term").distinct()
                  .groupBy("k1", "k2").agg(F.collect_list("term").alias("terms")), "pii-texts")


def _near(docs: DataFrame, texts: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` (with k1) whose text may be (left_semi) or is not
    (left_anti) among ``texts``."""
    buckets = texts.select(F.pmod("k1", F.lit(BUCKETS)).alias("b")).distinct()
    return docs.withColumn("b", F.pmod("k1", F.lit(BUCKETS))) \
        .join(F.broadcast(buckets), "b", how).drop("b")


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    spans = found(text, TOKEN, TERM, len(KINDS), lambda t: F.array_contains(terms, F.lower(t)))
    return F.filter(spans, lambda s: ~F.exists(
        base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def find(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         **thresholds) -> DataFrame:
    """One row per row of ``docs``: id, ``spans`` (base) and ``term_spans``."""
    base = analyse(spark, docs, text_col, (id_col,))
    none = F.array().cast(SPAN)
    texts = disclosing_texts(spark, docs, base, text_col, **thresholds)
    if texts is None:
        return base.select(id_col, "spans", none.alias("term_spans"))
    keyed = docs.select(text_or_empty(text_col).alias("t")).select("t", *content_key(F.col("t")))
    marked = _near(keyed, texts, "left_semi").join(texts, ["k1", "k2"])
    marked = marked.withColumn("spans", base_spans(F.col("t"))).select(
        "k1", "k2", _term_spans(F.col("t"), F.col("terms"), F.col("spans")).alias("term_spans"))
    marked = staged(spark, marked.dropDuplicates(["k1", "k2"]), "pii-terms")
    return base.join(marked, ["k1", "k2"], "left").select(
        id_col, "spans", F.coalesce("term_spans", none).alias("term_spans"))


def replaced(text: Column, spans: Column) -> Column:
    """The text with every span replaced: base spans by their kind, terms removed;
    overlapping spans become one."""
    def step(state: Column, s: Column) -> Column:
        mark = F.when(s["kind"] == TERM, F.lit("[...]")).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        parts = F.when(s["start"] >= state["at"], F.concat(state["parts"], F.array(gap, mark))) \
            .otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        rest = F.substring(text, state["at"] + 1, F.length(text))
        return F.array_join(F.concat(state["parts"], F.array(rest)), "")

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))


def sanitise(spark: SparkSession, docs: DataFrame, text_col: str = "text",
             chars_col: str = "n_chars", **thresholds) -> DataFrame:
    """``docs`` with personal data generalised and disclosing terms removed; where
    there is a column ``n_chars`` it follows the new text."""
    base = analyse(spark, docs, text_col)
    texts = disclosing_texts(spark, docs, base, text_col, **thresholds)
    text = text_or_empty(field(text_col))
    keyed = packed(docs).select("_in", *content_key(text))

    def finish(rows: DataFrame) -> DataFrame:
        out = rows.withColumn("clean", F.when(field(text_col).isNotNull(),
                                              replaced(text, F.col("spans"))))
        new = {text_col: F.col("clean")}
        if chars_col in docs.columns:
            new[chars_col] = F.length("clean").cast(docs.schema[chars_col].dataType)
        return out.select(*[new.get(c, field(c)).alias(c) for c in docs.columns])

    plain = keyed if texts is None else _near(keyed, texts, "left_anti")
    plain = finish(plain.withColumn("spans", base_spans(text)))
    if texts is None:
        return plain
    told = _near(keyed, texts, "left_semi").join(texts, ["k1", "k2"], "left") \
        .withColumn("spans", base_spans(text))
    terms = F.coalesce("terms", F.array().cast("array<string>"))
    told = told.withColumn("spans", F.array_sort(F.concat(
        "spans", _term_spans(text, terms, F.col("spans")))))
    return plain.unionByName(finish(told))
