import random

import pytest
import xxhash

from churnloom.llm import components, simhash

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    low = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")
    words = [w.decode() for w in low.encode().split()]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                parent[root(a)] = root(b)
    smallest = {}
    for a, (i, _) in enumerate(prints):
        r = root(a)
        if i is not None:
            smallest[r] = min(i, smallest.get(r, i))
    return sorted(((i, f"{p:016x}", smallest.get(root(a))) for a, (i, p) in enumerate(prints)), key=str)


def texts(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 40, 400]))]
        rows.append((10 * i, " ".join(base)))
        for j in range(rng.randrange(4)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(words)
            rows.append((10 * i + j + 1, "\t ".join(near)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "É é Ä"), (904, "é É ä"), (None, "null key"), (None, None), (5, "again"), (5, "again")]
    return rows


def test_fingerprint_against_definition():
    for _, t in texts(5):
        assert simhash.fingerprint(None if t is None else t.encode()) == plain_fingerprint(t)
    long = " ".join(str(i % 977) for i in range(50_000))
    assert simhash.fingerprint(long.encode()) == plain_fingerprint(long)


def test_components_against_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA + ", fp string")
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == brute(rows)


@pytest.mark.parametrize("segment_bits", [4, 8])
def test_every_close_pair_is_linked(spark, segment_bits):
    rng = random.Random(1)
    prints = {0, 2**64 - 1, 1 << 63, (1 << 63) | 1}
    for _ in range(150):
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(3):
            prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
            prints.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {(r["u"], r["v"]) for r in simhash.links(df, segment_bits=segment_bits).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert got == want


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "u long, v long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_one_of_each_keeps_columns_and_one_row(spark):
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "y"), (None, "a b c d", "z"), (9, None, "n"), (8, "", "e"), (None, "only null", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = sorted(((r["doc_id"], r["text"], r["component"]) for r in simhash.one_of_each(df).collect()), key=str)
    assert got == sorted([(1, "a b c d", "y"), (8, "", "e"), (None, "only null", "k")], key=str)
    assert simhash.one_of_each(df).columns == df.columns


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.one_of_each(df).collect() == []


def test_hot_fingerprints_join_like_others(spark):
    prints = spark.createDataFrame([(i, i % 3) for i in range(30)], "key long, fp long")
    named = spark.createDataFrame([(0, 10, 0), (1, 10, 1), (2, 10, 2)], "fp long, n long, component_id long")
    for hot in (5, 100):
        assert simhash.attach_classes(prints, named, hot).count() == 30
