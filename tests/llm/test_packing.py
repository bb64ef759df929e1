import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docsmith.llm import packing
from llm_fixtures import documents  # noqa: F401


def ids_by_tokenizers(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text, add_special_tokens=False).ids


def test_encoder_equals_tokenizers():
    bpe = packing.encoder(*packing.public_vocabulary())
    for text in ("", " ", "a  b\n\nc", "L'été  déjà 123 4567", "<|endoftext|> x", "日本語 🙂\t",
                 "x" * 5000, "   y", "it's we'll", "a  <|endoftext|><|endoftext|>  b", "<|endoftext|",
                 "end <|endoftext|>", "\n\n<|endoftext|>\n"):
        assert packing.encode_with_special(bpe, text) == ids_by_tokenizers(text)


def check(rows, texts, capacity):
    for doc, text in texts.items():
        ids = ids_by_tokenizers(text or "") + [0]
        pieces = sorted((r.start, r) for r in rows if r.doc_id == doc)
        at = 0
        for start, r in pieces:
            assert start == at
            piece = np.array(ids[start:start + r.length], "<u4")
            assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
            assert r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_every_id_lies_in_one_piece(documents, spark):
    texts = {i: t for i, t in enumerate(
        [None, "", "one", "word " * 700, "another text " * 40, "same", "z" * 30000])}
    df = documents(list(texts.values()), "length g offset start")
    rows = packing.pack(spark, df, capacity=64).collect()
    check(rows, texts, 64)
    again = packing.pack(spark, df, capacity=64).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_null_and_repeated_ids_keep_all_rows(documents, spark):
    df = documents([(None, "a b", "s"), (1, "a b", "s"), (1, "a b", "s"), (1, None, "s")])
    rows = packing.pack(spark, df, capacity=8).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [
        (False, 1), (False, 3), (False, 3), (True, 3)]
    assert packing.pack(spark, df.limit(0), capacity=8).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_assign_fills_the_cheapest_sequence_with_room(lengths):
    lengths = sorted(lengths, reverse=True)
    sequence, offset = packing.assign(np.array(lengths, dtype=np.int64), 16, 1.0, 1 / 16)
    full = sum(x >= 16 for x in lengths)
    opened = full + -(-sum(lengths[full:]) // 16)
    used, cost = {s: 0 for s in range(full, opened)}, {s: 0.0 for s in range(full, opened)}
    for length, s, o in zip(lengths, sequence, offset):
        if length < 16:
            room = [c for c in used if used[c] + length <= 16]
            if room:
                assert s in room and cost[s] == min(cost[c] for c in room)
            else:
                assert s not in used
        assert o == used.get(s, 0)
        used[s] = used.get(s, 0) + length
        cost[s] = cost.get(s, 0.0) + length + length * length / 16
        assert used[s] <= 16


def test_little_padding(spark, documents):
    rng = np.random.default_rng(3)
    texts = ["ab " * int(n) for n in rng.integers(1, 900, 600)]
    rows = packing.pack(spark, documents(texts), capacity=1024).collect()
    tokens = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) * 1024 <= tokens * 1.06


def test_result_does_not_depend_on_the_files(documents, spark, tmp_path):
    texts = [f"text {i % 9} " * (i % 40) for i in range(300)] + ["<|endoftext|> copy"] * 60
    df = documents([(i if i < 330 else 7, t, "s") for i, t in enumerate(texts)])
    df.repartition(5).write.parquet(str(tmp_path / "five"))
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    found = []
    for name, size in (("five", "128m"), ("one", "2k")):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        found.append(sorted(map(tuple, packing.pack(
            spark, spark.read.parquet(str(tmp_path / name)), capacity=64, group_tokens=2000).collect())))
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1]
