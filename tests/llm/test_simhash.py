import random
import re

import xxhash

from docsmith.llm import simhash
from llm_fixtures import documents  # noqa: F401


def brute_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or (
        [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(prints))]


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    for radius in (1, 2, 3):
        tables = simhash.masks(radius)
        assert len(tables) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            flips = sum(1 << i for i in rng.sample(range(64), rng.randint(0, radius)))
            assert any(not flips & m for m in tables)


def test_fingerprints(documents, spark):
    texts = ["", None, "One", "one two", "A b C", "É b c d e É", "x " * 5000, " \t\n a\x0bb\x0cc\rd"]
    got = {r.doc_id: r for r in simhash.simhash_components(spark, documents(texts)).collect()}
    for i, t in enumerate(texts):
        assert got[i].fp % (1 << 64) == brute_fingerprint(t)
    assert got[0].component_id == got[1].component_id == 0


def test_links_of_made_fingerprints_equal_all_pairs(spark):
    rng = random.Random(7)
    for radius in (0, 1, 2, 3):
        prints = [rng.getrandbits(64) for _ in range(30)]
        for _ in range(300):  # chains and clouds near earlier ones
            p = rng.choice(prints)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            prints.append(p)
        prints = sorted(set(prints))
        df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
        found = simhash.components(spark, simhash.links(spark, df, radius)).collect()
        root = {p: simhash._signed(p) for p in prints}
        root |= {r.node % (1 << 64): r.root for r in found}
        got, want = {}, {}
        for p, c in zip(prints, brute_components(prints, radius)):
            got.setdefault(root[p], set()).add(p)
            want.setdefault(c, set()).add(p)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_document_of_each_group_stays(documents, spark):
    base = " ".join(f"w{i}" for i in range(400))
    near = base + " tail"
    rows = [(5, base, "a"), (3, base, "a"), (3, base, "a"), (9, near, "b"), (None, base, None),
            (1, "alone here now", "a"), (7, None, "a"), (8, "", "a"), (None, "no id one two", "a"),
            (None, "no id one two", "a")]
    docs = documents(rows, "k1 fp id root _in")
    out = simhash.drop_near_duplicates(spark, docs)
    assert out.columns == docs.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect())
    apart = bin(brute_fingerprint(base) ^ brute_fingerprint(near)).count("1") > 2
    assert kept == sorted([(False, 3, base), (False, 1, "alone here now"), (False, 7, ""),
                           (True, 0, "no id one two")] + [(False, 9, near)] * apart)


def test_empty_table(documents, spark):
    docs = documents(["a"]).limit(0)
    assert simhash.simhash_components(spark, docs).count() == 0
    assert simhash.drop_near_duplicates(spark, docs).count() == 0
