import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnloom.llm import substring_dedup

SCHEMA = "doc_id long, text string, n_words string"


def brute(rows, size):
    docs = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t, _ in rows]
    seen = Counter(tuple(w[k : k + size]) for _, w in docs for k in range(len(w) - size + 1))
    out = []
    for i, w in docs:
        gone = {j for k in range(len(w) - size + 1) if seen[tuple(w[k : k + size])] > 1 for j in range(k, k + size)}
        out.append((i, " ".join(x for j, x in enumerate(w) if j not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def rows(size):
    rng = random.Random(6)
    words = [f"x{i}é" for i in range(400)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    shared = [text(size + k) for k in range(4)]
    out = []
    for i in range(60):
        parts = text(rng.randrange(3 * size))
        if rng.random() < 0.6:
            parts += rng.choice(shared) + text(rng.randrange(size))
        out.append((i, "  ".join(parts), "o"))
    own = text(size)
    out += [(100, " ".join(own + ["a"] + own), "o"), (101, " ".join(["z"] * (3 * size)), "o"), (102, " ".join(text(size)), "o"), (103, "\n".join(text(size - 1)), "o")]
    out += [(104, None, "o"), (105, "", "o"), (106, " \t", "o"), (None, out[0][1], "o"), out[1], out[1], (107, " ".join(["a b"] * 3000), "o")]
    return out


@pytest.mark.parametrize("size,bits", [(35, 28), (3, 28), (5, 16)])
def test_against_brute_force(spark, size, bits):
    data = rows(size)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = substring_dedup.remove_repeats(df, window=size, max_width_bits=bits)
    assert sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got.collect()), key=str) == brute(data, size)


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_WINDOWS", 50)
    data = rows(5)
    got = substring_dedup.remove_repeats(spark.createDataFrame(data, SCHEMA).repartition(7), window=5)
    assert sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got.collect()), key=str) == brute(data, 5)


def test_sketch_never_undercounts(spark):
    data = rows(4)
    df = spark.createDataFrame(data, SCHEMA)
    a, b = substring_dedup.sketch(df, "text", 4, 16)
    counts = Counter(tuple((t or "").split()[k : k + 4]) for _, t, _ in data for k in range(len((t or "").split()) - 3))
    assert any(n > 1 for n in counts.values())
    for window, n in counts.items():
        words = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in window], np.uint64)
        first, second = substring_dedup._cells(substring_dedup.window_hashes(words, 4)[0], 16)
        if n > 1:
            assert substring_dedup._bit(a, first)[0] and substring_dedup._bit(b, second)[0]


def test_anchors_are_window_minima():
    words = np.random.default_rng(1).integers(0, 2**63, 60).astype(np.uint64)
    for size in (3, 5, 6, 20, 35, 60):
        runs = substring_dedup.window_hashes(words, min(5, size))[0]
        wide = size - min(5, size) + 1
        want = [runs[i : i + wide].min() for i in range(60 - size + 1)]
        assert substring_dedup.anchors(words, size).tolist() == want


def test_plan_keeps_every_shard_under_the_limit():
    loads = np.random.default_rng(2).integers(0, 60, 1000)
    loads[[3, 500]] = 100, 12_345
    first, parts, shards = substring_dedup.plan_shards(loads, 100)
    assert parts.tolist() == [124 if k == 500 else 1 for k in range(1000)]
    planned = np.zeros(shards, np.int64)
    for f, p, n in zip(first, parts, loads):
        planned[f : f + p] += -(-n // p)
    assert planned.max() <= 100 and first.min() == 0 and shards <= 124 + 2 * loads.sum() // 100


def test_a_phrase_in_many_texts_is_spread(spark, monkeypatch):
    """A short line in every text: its windows all differ and share its anchor, so one shard would get all of them."""
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.getrandbits(60)}" for _ in range(n)]
    hash5 = lambda line: int(substring_dedup.window_hashes(np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in line], np.uint64), 5)[0][0])
    line = min((fresh(5) for _ in range(3000)), key=hash5)
    data = [(i, " ".join(fresh(34) + line + fresh(34)), "o") for i in range(300)] + [(900, " ".join(line * 9), "o"), (901, " ".join(line * 9), "o")]
    # A full sketch lets all windows through.
    monkeypatch.setattr(substring_dedup, "MIN_WIDTH_BITS", 8)
    monkeypatch.setattr(substring_dedup, "SHARD_WINDOWS", 500)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    dealt = substring_dedup.dealt_windows(df, "text", 35, 8).where("hashes IS NOT NULL").groupBy("shard").agg(F.sum(F.length("hashes") / 12).alias("n")).collect()
    assert sum(r["n"] for r in dealt) > 300 * 39 * 0.9
    # Parts of one anchor are dealt by hash, so they differ a little.
    assert max(r["n"] for r in dealt) <= 1.2 * 2 * 500
    got = substring_dedup.remove_repeats(df, max_width_bits=8)
    assert sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got.collect()), key=str) == brute(data, 35)


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
