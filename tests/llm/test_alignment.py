import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import public_tokenizers
from docsmith.llm import alignment
from docsmith.llm.packing import public_vocabulary
from llm_fixtures import documents  # noqa: F401

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def byte_of():
    """The characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute(texts, both):
    """Per text: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), from token
    spans compared one by one."""
    a_tok, b_tok = both
    chars = byte_of()
    rows = []
    for text in texts:
        ids_a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b_tok.encode(text) if text else []
        a = [bytes(chars[c] for c in a_tok.id_to_token(i)) for i in ids_a]
        b = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in ((i, b_tok.id_to_piece(i)) for i in ids_b)]
        want = (" " + (text or "")).encode()
        if not text or b"".join(a) != want or b"".join(b) != want:
            rows.append(None)
            continue
        span_a, span_b, at = [], [], 0
        for x in a:
            span_a.append((at, at := at + len(x)))
        at = 0
        for x in b:
            span_b.append((at, at := at + len(x)))
        cuts = {e for _, e in span_a} & {e for _, e in span_b}
        groups, ga, gb, j = [], [], [], 0
        for i, (_, end) in zip(ids_a, span_a):
            ga.append(i)
            if end in cuts:
                while True:
                    gb.append(ids_b[j])
                    j += 1
                    if span_b[j - 1][1] == end:
                        break
                groups.append((ga, gb))
                ga, gb = [], []
        links, lo = [], 0
        for i, (s, e) in zip(ids_a, span_a):
            while span_b[lo][1] <= s:
                lo += 1
            for k in range(lo, len(span_b)):
                if span_b[k][0] >= e:
                    break
                links.append((i, ids_b[k]))
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((ids_a, ids_b, groups, links, hashlib.sha256(written.encode()).hexdigest()))
    count = Counter(p for r in rows if r for p in set(r[3]))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (len(r[0]), len(r[1]), len(r[2]), len(r[3]), sum(count[p] == top[p[0]] for p in r[3]),
             sum(count[p] for p in r[3]), r[4]) for r in rows]


WORDS = ("the of Straße naïve 日本語 処理 data-pipeline 12345 3.14 foo_bar <|endoftext|> <s> </s> <unk> "
         "Ünïcödé 😀 👩‍👩‍👧 don't I'll ▁ \t \n\n   x\u0000y é supercalifragilistic").split(" ")
TEXTS = ["", None, " ", "a", "\n", "▁", "a▁b", "<|endoftext|>", "<s>hi</s>", "日本語のテキスト", "😀" * 40,
         "the the the", "the the the", " leading", "trailing ", "a" * 3000, "x y " * 500, "\x00", "<0x41>"]


def got(df):
    return [tuple(r)[1:] for r in sorted(df.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
        .collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("block_bytes", [1, 2000, 1 << 22])
def test_equals_comparing_spans(spark, documents, both, block_bytes):  # noqa: F811
    r = random.Random(3)
    texts = TEXTS + ["".join(r.choice([" ", "", "  ", "\n"]) + r.choice(WORDS)
                             for _ in range(r.randrange(1, 60))) for _ in range(80)]
    df = documents(texts, "block pair links a place count best n_a first").repartition(3)
    assert got(alignment.align(spark, df, block_bytes=block_bytes)) == brute(texts, both)


def test_empty_table_and_null_ids(spark, documents, both):  # noqa: F811
    assert alignment.align(spark, documents([""]).limit(0)).count() == 0
    df = spark.createDataFrame([(None, "the cat"), (None, "the cat"), (5, None)],
                               "doc_id long, text string")
    want = brute(["the cat", "the cat"], both)
    rows = [tuple(r) for r in alignment.align(spark, df).collect()]
    assert sorted(rows, key=str)[-2:] == [
        (None, *want[0][:4], want[0][4], want[0][5], want[0][6])] * 2
    assert (5, 0, 0, 0, 0, 0, 0, "") in rows


def test_long_interval_without_a_shared_cut():
    """Ends of A are even, those of B odd, but for one far from the middle and the last."""
    ends_a = np.arange(2, 4002, 2)
    ends_b = np.append(np.arange(1, 3999, 2), [3998, 4000])
    ends_b.sort()
    a, b = alignment.split(ends_a, ends_b, np.array([len(ends_a)]), np.array([len(ends_b)]))
    assert ends_a[a - 1].tolist() == ends_b[b - 1].tolist() == [3998, 4000]


def test_split_finds_all_shared_ends():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        end = lambda: np.append(np.nonzero(rng.random(n) < rng.random())[0] + 1, n + 1)
        x, y = end(), end()
        a, b = alignment.split(x, y, np.array([len(x)]), np.array([len(y)]))
        assert x[a - 1].tolist() == y[b - 1].tolist() == np.intersect1d(x, y).tolist()


def test_one_long_text(spark, documents, both):  # noqa: F811
    text = " ".join(WORDS[i * 7 % len(WORDS)] + str(i) for i in range(40_000)).replace("▁", "")
    assert got(alignment.align(spark, documents([text, "the"]))) == brute([text, "the"], both)


def test_vocabularies_are_the_same(both):
    ranks, pattern = public_vocabulary()
    t = alignment.tokenizers(ranks, pattern, MODEL)
    chars = byte_of()
    assert all(bytes(chars[c] for c in both[0].id_to_token(i)) == x for i, x in enumerate(t.a_bytes))


def test_ids_of_a_block_are_lists_only_in_parts():
    """A block's texts reach the tokenizers in parts; where they are cut changes nothing."""
    class Counting:
        def __init__(self):
            self.sizes = []

        def encode(self, texts):
            self.sizes.append(sum(4 + len(x) for x in texts))
            return [[len(x)] * (len(x) // 2) for x in texts], [list(map(ord, x)) for x in texts]

    texts = ["ab" * n for n in (0, 3, 500, 1, 0, 90, 2000, 7)] * 5
    whole, parts = Counting(), Counting()
    want = alignment.encoded(whole, texts, 1 << 30)
    got = alignment.encoded(parts, texts, 1000)
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(want, got))
    assert len(whole.sizes) == 1 and max(parts.sizes) < 1000 + 4004
    assert [len(x) for x in alignment.encoded(Counting(), [], 10)] == [0, 0, 0, 0]
    many = Counting()
    alignment.encoded(many, ["x" * 2000] * 1000)
    assert max(many.sizes) <= alignment.BLOCK_BYTES / 8
