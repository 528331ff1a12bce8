import math
import random

import numpy as np
import pytest

from churnloom.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """The rounds in Python integers, with every distance computed."""
    kept = [(i, [max(-(2**53), min(2**53, math.floor(scale * x))) for x in v], g) for i, v, g, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    smallest = {}
    for i, v, _ in kept:
        smallest[i] = min(v, smallest.get(i, v))
    order = sorted(smallest, key=lambda i: (i is None, i or 0))[:entries]
    dim = len(kept[0][1]) if kept else 0
    spans = [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]
    books = [[smallest[i][a:z] for i in order] for a, z in spans]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, z) in enumerate(spans):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(v[a:z], books[p])[1], []).append(v[a:z])
            for j, g in groups.items():
                books[p][j] = [sum(col) // len(g) for col in zip(*g)]
    coded = []
    for i, v, g in kept:
        found = [near(v[a:z], b) for (a, z), b in zip(spans, books)]
        coded.append((i, g, [j for _, j in found], min(2**63 - 1, sum(d for d, _ in found))))
    totals = {}
    for _, g, _, e in coded:
        totals[g] = totals.get(g, 0) + e
    return sorted((repr((i, g, code, e, min(2**63 - 1, totals[g]))) for i, g, code, e in coded)), books


def check(spark, rows, schema=SCHEMA, **more):
    got, books = vector_codes.compress(spark.createDataFrame(rows, schema).repartition(3), **more)
    want, want_books = plain(rows, **more)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want
    for book, other in zip(next(iter(books.values()), []), want_books):
        assert book.entries.tolist() == other
    return got


def test_against_all_distances(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)], i % 3, "x") for i in range(150)]
    rows += [(200 + i, [0.25] * 16, None, "tie") for i in range(20)]
    rows += [(300, None, 1, "x"), (301, [None] * 16, 1, "x"), (302, [float("nan")] * 16, 1, "x"), (303, [float("-inf")] * 16, 1, "x"), (None, [0.5] * 16, 2, "no key")]
    got = check(spark, rows + rows[:4])
    assert got.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_uneven_parts_few_rows_large_values(spark):
    check(spark, [(3, [1.0, -2.0, 3.0, 4.5, 0.1], 1, ""), (1, [0.0] * 5, 1, ""), (2, [9.0, 9.0, 9.0, 9.0, -9.0], None, "")], parts=3, entries=2)
    check(spark, [(1, [1e300, -1e300], 1, ""), (2, [1e9, 2e9], 1, ""), (3, [-1e12, 5.0], 1, ""), (4, [3e13, 3e13], 1, "")], parts=1, entries=3, rounds=2)
    check(spark, [(1, [], 1, ""), (2, [], 2, "")])


def test_empty_tables_and_lengths_of_their_own(spark):
    assert check(spark, []).collect() == []
    assert check(spark, [(1, None, 1, "")]).collect() == []
    rows = [(1, [1.0, 2.0], 1, ""), (2, [3.0, 4.0], 1, ""), (3, [1.0, 2.0, 3.0], 1, "")]
    got, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), parts=1)
    assert sorted(books) == [2, 3] and len(books[2][0].entries) == 2 and len(books[3][0].entries) == 1
    assert [r["error"] for r in got.collect()] == [0, 0, 0]


def test_encode_keeps_columns_and_gives_null_codes(spark):
    _, books = vector_codes.compress(spark.createDataFrame([(1, [1.0, 2.0], 1, "")], SCHEMA), parts=2)
    rows = [(7, [1.0, 2.0], 4, "old"), (8, None, 4, "old"), (9, [1.0], 4, "old"), (9, [None, 1.0], 4, "old")]
    got = vector_codes.encode(spark.createDataFrame(rows, SCHEMA), books)
    assert got.columns == ["vec_id", "embedding", "label", "code", "error"]
    assert [(r["vec_id"], r["code"], r["error"]) for r in got.orderBy("vec_id", "embedding").collect()] == [(7, [0, 0], 0), (8, None, None), (9, None, None), (9, None, None)]


@pytest.mark.parametrize("spread", [3, 40, 10_000])
def test_sum_order_search_prunes_and_is_exact(spread):
    rng = np.random.default_rng(1)
    entries = rng.integers(-spread, spread, (64, 6))
    x = rng.integers(-spread, spread, (500, 6))
    which, d, computed = vector_codes.nearest_entry(x, vector_codes.Book.of(entries))
    all_d = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert which.tolist() == all_d.argmin(axis=1).tolist() and d.tolist() == all_d.min(axis=1).tolist()
    assert computed < all_d.size


def test_order_and_partitions_do_not_matter(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    one, a = vector_codes.compress(df.repartition(1))
    many, b = vector_codes.compress(df.repartition(7).orderBy("label"))
    assert list(vector_codes.components(a)) == list(vector_codes.components(b))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
