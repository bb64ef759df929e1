import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from docsmith.llm import pii
from llm_fixtures import documents  # noqa: F401

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


CHECK = {"email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
         "card": lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m)),
         "phone": lambda m: 10 <= len(digits(m)) <= 15}


def brute(text):
    spans = [(m.start(), n, m.end(), kind) for n, (kind, rule) in enumerate(
        (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)))
        for m in rule.finditer(text or "") if CHECK[kind](m.group())]
    return sorted(spans)


TEXTS = [
    None, "", "nothing here", "a@b.c", "x.y+z%q@mail-1.example.co.uk, a@b a@b.c_d@e.f g@h..i",
    "@a.b a@@b.c a@b.c@d.e é@x.org 🙂a@b.cd 🙂", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0004",
    "00000000255.1.1.1 1.2.3 1..2.3.4 9999.1.2.3.4", "4111111111111111 4111 1111-1111 1111",
    "4111  1111111111111 4111111111111112 12345678901234567890 3782 822463 10005",
    "+1 (377) 555-0271 +12 +1234567890123456 +1)))2 +44 20 7946 0958.", "++1 555 555 0000 +1-2+3",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4", "9" * 3000 + "@" + "a." * 800 + "b", "a." * 4000, "+1" + "(" * 4000,
    "5555555555554444\n5555 5555 5555 4444x", "Ünïcödé 🙂🙂 the.94@mail8.example.com!!!",
]


def test_base_spans_equal_a_plain_search(documents, spark):
    rows = pii.find(spark, documents(TEXTS, "t spans k1 lines")).collect()
    for r in rows:
        got = [(s.start, s.kind_no, s.end, s.kind) for s in r.spans]
        assert got == brute(TEXTS[r.doc_id]), TEXTS[r.doc_id]
    line = spark.createDataFrame([(TEXTS[4],)], "t string").select(
        F.sha2(pii.written(pii.base_spans(F.col("t"))), 256)).first()[0]
    want = ",".join(f"{k}:{a}:{b}" for a, _, b, k in brute(TEXTS[4]))
    assert line == hashlib.sha256(want.encode()).hexdigest()


def corpus():
    rows = [f"Line {i}: agent Nightjar wrote to jo@corp.example about item{i} and the plan" for i in range(9)]
    rows += [f"Only the plan number {i} and the rest" for i in range(300)]
    rows += ["Copy: Magpie met ann@x.org"] * 50  # equal lines are one context
    rows += ["Here nightjar appears without the address", "Rook! jo@corp.example", None, ""]
    return rows


def brute_terms(texts, window=8, support=5, min_bits=8.0, residual=0.5):
    lines = {x for t in texts for x in (t or "").split("\n")}
    n = sum(len((t or "").split("\n")) for t in texts)
    near, of_entity, of_term = {}, {}, {}
    for line in lines:
        for t in {x for x in re.split(r"[\W_]+", line.lower())}:
            of_term[t] = of_term.get(t, 0) + 1
        spans = brute(line)
        for i, (a, _, b, kind) in enumerate(spans):
            entity = f"{kind}:{line[a:b].lower()}"
            start = spans[i - 1][2] if i else 0
            end = spans[i + 1][0] if i + 1 < len(spans) else len(line)
            words = re.split(r"[\W_]+", line[start:a].lower())[::-1][:window] \
                + re.split(r"[\W_]+", line[b:end].lower())[:window]
            of_entity.setdefault(entity, set()).add(line)
            for t in words:
                if len(t) >= 3 and not re.search("[0-9]", t):
                    near.setdefault((entity, t), set()).add(line)
    told = set()
    for (entity, t), found in near.items():
        c = len(found)
        if c >= support and math.log2(n * c / (of_term[t] * len(of_entity[entity]))) >= min_bits - 1e-9 \
                and -math.log2(c / of_term[t]) <= residual:
            told.add(t)
    return told


@pytest.mark.parametrize("bits", [3.0, 4.5])
def test_disclosing_terms(documents, spark, bits):
    texts = corpus()
    told = brute_terms(texts, min_bits=bits)
    assert "nightjar" in told and "plan" not in told and "magpie" not in told
    for r in pii.find(spark, documents(texts), min_bits=bits).collect():
        text = texts[r.doc_id] or ""
        base = brute(text)
        want = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text) if m.group().lower() in told
                and not any(a < m.end() and m.start() < b for a, _, b, _ in base)]
        assert [(s.start, s.end) for s in r.term_spans] == want


def test_sanitised_documents(documents, spark):
    texts = corpus() + ["card 4111111111111111 end", "+1 (377) 555-0271"]
    docs = documents(texts, "k1 spans terms b")
    out = pii.sanitise(spark, docs, min_bits=4.0)
    assert out.schema.names == docs.schema.names
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(texts)
    assert "[EMAIL]" in rows[0].text and "Nightjar" not in rows[0].text and "the plan" in rows[0].text
    assert rows[9].text == texts[9] and rows[9].n_chars == len(texts[9])
    assert rows[len(texts) - 2].text == "card [CARD] end" and rows[len(texts) - 1].text == "[PHONE]"
    assert "nightjar" not in rows[texts.index("Here nightjar appears without the address")].text
    assert rows[texts.index(None)].text is None and rows[texts.index("")].text == ""


def test_empty_table_and_native_plan(documents, spark):
    docs = documents(["a@b.c x"])
    assert pii.find(spark, docs.limit(0)).count() == 0
    assert pii.sanitise(spark, docs.limit(0)).count() == 0
    plan = pii.sanitise(spark, docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_names_on_few_lines_are_found(documents, spark):
    names = {"nightjar": 2, "magpie": 3, "rookery": 4, "jackdaw": 5, "jdoe42": 2, "王芳": 2, "onceonly": 1}
    texts = [f"filler number{i} text" for i in range(3000)]
    for k, (name, n) in enumerate(names.items()):
        texts += [f"{name} has p{k}@corp.example in text{k}x{j}" for j in range(n)]
    texts += ["Magpie alone, not beside an address", "JDOE42 alone"]
    found = {}
    for r in pii.find(spark, documents(texts)).collect():
        for s in r.term_spans:
            term = texts[r.doc_id][s.start:s.end].lower()
            found[term] = found.get(term, 0) + 1
    # a third context without the address leaves 0.58 bits of two; magpie's fourth 0.42 of three
    assert found == {"nightjar": 2, "magpie": 4, "rookery": 4, "jackdaw": 5, "王芳": 2}


def test_copies_do_not_change_what_a_term_reveals(documents, spark):
    texts = [f"Nightjar has jo@corp.example in text{i}" for i in range(5)] \
        + [f"filler number{i} text" for i in range(300)]
    n, pair = len(set(texts)), 5
    assert math.log2(n / pair) < 8 < math.log2(40 * n / pair)
    for copies, bits in ((40, 8.0), (1, 8.0), (40, 5.5)):
        told = {texts[r.doc_id % len(texts)][s.start:s.end] for r in pii.find(
            spark, documents(texts * copies), min_bits=bits).collect() for s in r.term_spans}
        assert ("Nightjar" in told) == (math.log2(n / pair) >= bits)
