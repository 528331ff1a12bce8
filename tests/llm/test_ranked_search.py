import math
import random
import re

import numpy as np
import pytest

from churnloom.llm import ranked_search

DOCS = "doc_id long, text string, score string"
ITEMS = "item_id long, text string, rank string"
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(lower)


def plain(docs, items, k=10):
    held = [(i, words(t)) for i, t, _ in docs if words(t)]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t, _ in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, ts in asked.items():
        scores = []
        for i, w in held:
            m = 10 + 90 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in ts if t in w)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def run(spark, docs, items, **more):
    got = ranked_search.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def corpus(n=250, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60))), "x") for i in range(n)]
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=8)), "y") for i in range(12)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    docs += [(1000 + i, "W3, w5! w9\x00w3", "copy") for i in range(40)]
    docs += [(2000, None, "x"), (2001, "", "x"), (2002, " .,;", "x"), (None, "w3 w5 w9 w3", "no key"), docs[7], docs[7], (2003, "w1 " * 20000 + "Ünï-w3", "long")]
    items += [(50, "w3 w5 w9", ""), (51, None, ""), (52, "--", ""), (53, "nowhere", ""), (None, "w7", ""), (54, "w1", ""), (54, "w2", ""), items[0], (55, "ÜNÏ ünï", "")]
    want = plain(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, shard_postings=60, block_terms=9) == want


def test_empty_tables(spark):
    docs, items = corpus(20)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None, "")], items) == []


def test_term_in_every_document(spark):
    docs = [(i, "same", "") for i in range(30)]
    assert run(spark, docs, [(1, "same", "")]) == plain(docs, [(1, "same", "")])


@pytest.mark.parametrize("opened", [1, 16])
def test_intervals_are_pruned_and_exact(opened):
    rng = np.random.default_rng(2)
    n, vocabulary = 4000, 300
    lists, counts, lengths = [], [], []
    for _ in range(n):
        t = np.unique((vocabulary * rng.random(rng.integers(3, 40)) ** 3).astype(np.int32))
        lists.append(t)
        counts.append(rng.integers(1, 4, len(t)).astype(np.int32))
        lengths.append(int(counts[-1].sum()) * 2)
    weights = np.arange(vocabulary) * 20 + 7
    shard = ranked_search.Shard(list(range(n)), lengths, lists, counts, weights, n, sum(lengths), 10)
    wanted = np.array([2, 40, 200, 290])
    best, scored = shard.search(wanted, 10, [], opened)
    m = [10 + 90 * x * n // sum(lengths) for x in lengths]
    scores = [sum(int(weights[t]) * (10**9 * int(f) // (1000 * int(f) + 8 * m[i])) for t, f in zip(lists[i], counts[i]) if t in wanted) for i in range(n)]
    want = sorted((-s, False, i) for i, s in enumerate(scores) if s > 0)[:10]
    assert best == want and scored < n / 4
