import math
import random

import numpy as np
from pyspark.sql import functions as F

from churnloom.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k=10):
    fine = sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in fine]
    out = []
    for qi, q in whole:
        if qi % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in whole if i != qi and len(v) == len(q))
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in topk_search.top_k(df, F.col("vec_id") % 100 == 0, **more).collect())


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], "s") for i in range(600)]
    rows += [(700 + i, [0.5] * 8, "tie") for i in range(30)]
    rows += [(800, None, "s"), (900, [1.0, None], "s"), (1000, [float("nan")] * 8, "s"), (1100, [float("inf")] * 8, "s"), (None, [1.0] * 8, "s")]
    rows += [(1200, [1.0, 2.0], "other length"), (1201, [3.0, 4.0], "s"), (1300, [], "empty"), (1301, [], "empty"), rows[0], rows[5]]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, block_rows=37, query_rows=2, bits=3) == want


def test_large_values_stay_exact():
    x = np.array([[2.0**40, 3.0], [2.0**40, 5.0], [1.0, 1.0]])
    q = np.array([[2.0**21, 1.0]])
    _, ids, scores = topk_search.search_block(np.array([9]), q, np.array([0, 1, 2]), x, 2, 4)
    assert ids.tolist() == [1, 0] and scores.tolist() == [2**61 + 5, 2**61 + 3]


def test_few_candidates_and_empty_table(spark):
    assert run(spark, [(0, [1.0], ""), (1, [2.0], "")]) == [(0, 1, 1, 1024 * 2048)]
    assert run(spark, [(0, [1.0], "")]) == []
    assert run(spark, []) == []


def test_queries_in_rounds_and_blocks_of_any_kind(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) * (1000.0 if i % 7 == 0 else 1.0) for _ in range(6)], "s") for i in range(800)]
    monkeypatch.setattr(topk_search, "ROUND_BYTES", 150)
    monkeypatch.setattr(topk_search, "TASK_BLOCKS", 3)
    assert run(spark, rows, block_rows=40, query_rows=3) == brute(rows)


def test_queries_are_not_repeated_for_every_block(spark):
    df = spark.createDataFrame([(i, [float(i % 13), 1.0], "s") for i in range(300)], SCHEMA)
    plan = topk_search.top_k(df, F.col("vec_id") % 100 == 0, block_rows=10)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_a_block_below_the_kth_best_is_not_read(monkeypatch):
    x = np.array([[10.0, 1.0], [9.0, 2.0], [8.0, 3.0]])
    best = topk_search._nothing(1)
    topk_search._improve(np.array([9]), np.array([[1.0, 0.0]]), np.array([0, 1, 2]), x, 2, 6, best)
    assert best[0][0].tolist() == [0, 1] and best[0][1].tolist() == [10, 9]
    monkeypatch.setattr(topk_search, "_exact_scores", None)
    topk_search._improve(np.array([9]), np.array([[1.0, 0.0]]), np.array([3, 4]), x[:2] - 8, 2, 6, best)
    assert best[0][0].tolist() == [0, 1]
