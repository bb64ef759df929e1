import hashlib
import random

import pytest

from docsmith.llm import suffix_dedup as S
from llm_fixtures import documents  # noqa: F401


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rest = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def compare(spark, documents, texts, length, trigger):
    df = documents(texts, "k1 t f first ranges raw")
    rows = S.remove_repeats(spark, df, length, trigger).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    want = brute(texts, length)
    assert [got[i] for i in range(len(texts))] == want


def test_planted_repeats(spark, documents):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passages = [fresh(30) for _ in range(5)]
    long_ = fresh(300)
    texts = [None, "", "short", "a" * 900, "ab" * 400, "xyz" * 200 + fresh(20), long_, long_]
    for _ in range(60):
        parts = [fresh(rng.randint(0, 40)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        texts.append(" ".join(parts))
    for _ in range(25):  # near copies, edited at one to three places
        t = list(long_)
        for _ in range(rng.randint(1, 3)):
            t[rng.randrange(len(t))] = "Q"
        texts.append("".join(t))
    texts.append(passages[0] + passages[1] + passages[0])
    compare(spark, documents, texts, 100, 16)


def test_two_letter_texts(spark, documents):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for _ in range(50)]
    compare(spark, documents, texts, 12, 4)


def test_segments_of_long_texts(spark, documents, monkeypatch):
    import numpy as np
    monkeypatch.setattr(S, "SEGMENT", (1 << 10) - 1)
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    first, last, place, hashed = S.phrases(raw, 50, 8)
    covered = [p for a, b in zip(first, last) for p in range(a, b + 1)]
    assert covered == list(range(len(raw) - 49))
    assert ((place >= last) & (place + 8 <= first + 50)).all()


def test_same_string_same_trigger():
    import numpy as np
    rng = np.random.default_rng(4)
    for size in (2, 3, 200):
        core = rng.integers(0, size, 60).astype(np.uint8)
        found = set()
        for _ in range(20):
            left = rng.integers(0, size, rng.integers(0, 90)).astype(np.uint8)
            raw = np.concatenate([left, core, rng.integers(0, size, 70).astype(np.uint8)])
            first, last, place, hashed = S.phrases(raw, 60, 10)
            i = int(np.nonzero((first <= len(left)) & (last >= len(left)))[0][0])
            found.add((int(place[i]) - len(left), int(hashed[i])))
        assert len(found) == 1


@pytest.mark.parametrize("rows", [[], ["one text only " * 40]])
def test_tiny_tables(spark, documents, rows):
    if rows:
        compare(spark, documents, rows, 100, 16)
    else:
        assert S.remove_repeats(spark, documents(["x"]).limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark, documents):
    t = "".join(random.Random(1).choice("abcdef ") for _ in range(500))
    df = documents([(None, t, "s"), (None, t, "s"), (4, None, "s")])
    rows = S.remove_repeats(spark, df).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in rows) == [(0, 0, 0), (500, 500, 1), (500, 500, 1)]


def test_passages_of_over_fifty_words_above_and_below_400_bytes(spark, documents):
    """The contract's length decides, not the number of words."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    fresh = lambda n: " ".join(word() for _ in range(n))
    passages = [fresh(n) for n in range(51, 75)]
    texts = [f"{fresh(40)} {p} {fresh(40)}" for p in passages for _ in range(3)] + [fresh(150) for _ in range(20)]
    df = documents(texts)
    rows = {r.doc_id: r for r in S.remove_repeats(spark, df, 400).collect()}
    assert [(rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans, rows[i].kept_sha256)
            for i in range(len(texts))] == brute(texts, 400)
    # with its neighbouring spaces a passage is two bytes longer
    caught = [all(rows[3 * i + j].n_removed > 0 for j in range(3)) for i in range(len(passages))]
    assert caught == [len(p.encode()) + 2 >= 400 for p in passages] and 0 < sum(caught) < len(caught)
    assert all(rows[i].n_removed == 0 for i in range(3 * len(passages), len(texts)))
