"""Whole-table order helpers against plain Python on small frames with ties and a hot group."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnloom.operators import ordered, quantiles, skew


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        group = "hot" if i % 3 == 0 else f"g{i % 40}"
        value = 5.0 if i % 3 == 1 else round(rng.gauss(0, 3), 1)
        rows.append((i, group, value if i % 29 else None))
    return spark.createDataFrame(rows, "k long, g string, v double").repartition(5).cache()


def linear(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
    return low + (high - low) * (at - int(at))


@pytest.mark.parametrize("small", [10, 1_000_000])
def test_quantiles_exact_on_both_paths(frame, small):
    values = [r.v for r in frame.collect() if r.v is not None]
    got = quantiles.quantiles(frame, ["v"], [0, 0.1, 0.25, 0.5, 0.9, 1], small_group=small)["v"]
    for p, x in got.items():
        assert x == pytest.approx(linear(values, p), abs=1e-12)


@pytest.mark.parametrize("small", [8, 1_000_000])
def test_grouped_quantiles(frame, small):
    got = {(r.g, r.prob): r.value for r in quantiles.quantile_table(frame, ["v"], [0.5, 0.8], ["g"], small).collect()}
    groups = {}
    for r in frame.collect():
        if r.v is not None:
            groups.setdefault(r.g, []).append(r.v)
    assert len(got) == 2 * len(groups)
    for (g, p), x in got.items():
        assert x == pytest.approx(linear(groups[g], p), abs=1e-12)


@pytest.fixture(params=[0, 100_000])
def one_task_rows(request, monkeypatch):
    monkeypatch.setattr(ordered, "ONE_TASK_ROWS", request.param)


def test_average_rank(frame, one_task_rows):
    rows = [r for r in frame.collect() if r.v is not None]
    values = [r.v for r in rows]
    ranked = ordered.with_average_rank(frame, "v", "rk", percent=True)
    got = {r.k: r.rk for r in ranked.collect()}
    assert len(got) == 1500
    for r in rows[:200]:
        expected = (sum(x < r.v for x in values) + (sum(x == r.v for x in values) + 1) / 2) / len(values)
        assert got[r.k] == pytest.approx(expected)
    assert all(got[i] is None for i in range(0, 1500, 29))


def test_average_rank_within_groups(frame, one_task_rows):
    got = {(r.g, r.v): r.avg_rank for r in ordered.average_ranks(frame, "v", ["g"]).collect()}
    rows = [r for r in frame.collect() if r.v is not None]
    for (g, v), rank in list(got.items())[::7]:
        inside = [r.v for r in rows if r.g == g]
        assert rank == sum(x < v for x in inside) + (sum(x == v for x in inside) + 1) / 2


def test_positions(frame):
    got = [r.k for r in ordered.positions(frame, ["g", "k"]).orderBy("position").collect()]
    assert got == [r.k for r in sorted(frame.collect(), key=lambda r: (r.g, r.k))]


@pytest.mark.parametrize("limit", [50, 10_000])
def test_rank_within_splits_hot_groups(frame, limit):
    order = [F.col("v").desc_nulls_last(), F.col("k").asc()]
    plain = frame.withColumn("e", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    expected = {r.k: r.e for r in plain.collect()}
    assert {r.k: r.rk for r in ordered.rank_within(frame, ["g"], order, "rk", limit).collect()} == expected


@pytest.mark.parametrize("by", [(), ("g",)])
def test_moving_window_across_blocks(frame, by):
    def build(w):
        return {"s": F.sum("v").over(w.rowsBetween(-4, 0)), "l": F.lag("v", 3).over(w)}

    plain = frame
    window = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))).orderBy("k")
    for name, column in build(window).items():
        plain = plain.withColumn(name, column)
    expected = {r.k: (None if r.s is None else round(r.s, 9), r.l) for r in plain.collect()}
    got = ordered.moving(frame, ["k"], 5, build, block_rows=17, by=by)
    assert {r.k: (None if r.s is None else round(r.s, 9), r.l) for r in got.collect()} == expected


def test_attach_every_path(frame):
    stats = frame.groupBy("g").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    expected = {r.k: r.m for r in frame.join(stats, "g").collect()}
    for broadcast_rows, hot_rows in [(1000, 1000), (30, 400), (0, 10**9)]:
        got = skew.attach(frame, stats, ["g"], "n", broadcast_rows=broadcast_rows, hot_rows=hot_rows)
        assert {r.k: r.m for r in got.collect()} == expected


def test_mode_prefers_lowest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert quantiles.mode_table(df, ["x"]).first().mode == "a"
    kept = quantiles.mode_table(df, ["x"], keep_null=True).first()
    assert kept.mode is None and kept.mode_rows == 3


def test_quantiles_of_one_hot_group_among_many(spark):
    hot, many = 50_000, 300_000
    rows = spark.range(hot + many).select(
        F.when(F.col("id") >= hot, F.col("id").cast("string")).otherwise(F.when(F.col("id") % 2 == 0, "hot")).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("v"),
    )
    table = quantiles.quantile_table(rows, ["v"], [0.25, 0.5], ["g"], small_group=10_000)
    assert table.count() == 2 * (many + 2)
    for g in ("hot", None):
        values = sorted(r.v for r in rows.where(F.col("g").eqNullSafe(F.lit(g))).collect())
        got = {r.prob: r.value for r in table.where(F.col("g").eqNullSafe(F.lit(g))).collect()}
        for p in (0.25, 0.5):
            place = (len(values) - 1) * p
            low, high = values[math.floor(place)], values[math.ceil(place)]
            assert got[p] == pytest.approx(low + (high - low) * (place - math.floor(place)))
    alone = table.join(rows.where(F.col("g").try_cast("long") >= hot), "g").where(F.abs(F.col("value") - F.col("v")) > 1e-9)
    assert alone.isEmpty()
