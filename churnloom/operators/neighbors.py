"""Exact nearest neighbours without comparing all pairs.

Distinct donor points are cut by medians into boxes of a few hundred points. A task takes queries that lie near one another and
visits the boxes by falling nearness, until no box is as near as their k-th neighbours so far. Donors go to all tasks, a bounded
part of them at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import count_rows, num
from ..session import materialize

#: Points of a box, boxes that are searched at once, and bytes of donors that all tasks hold at once.
BOX_POINTS = 256
BOXES = 4
ROUND_BYTES = 64_000_000
#: Queries that a task takes, where there are more tasks than cores.
TASK_QUERIES = 50_000


class Boxes:
    """Points cut at medians of their widest column into ``2 ** levels`` boxes of equal numbers."""

    def __init__(self, x: np.ndarray, n: np.ndarray, v: np.ndarray, wanted: int):
        levels = max(0, min(math.ceil(math.log2(max(wanted, 1))), int(math.log2(max(len(x), 1)))))
        order, ends = np.arange(len(x)), [0, len(x)]
        self.cuts: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(levels):
            columns, values, cut = [], [], [0]
            for a, b in zip(ends, ends[1:]):
                part = x[order[a:b]]
                column = int(np.argmax(np.ptp(part, axis=0)))
                middle = (b - a) // 2
                split = np.argpartition(part[:, column], middle)
                columns.append(column)
                values.append(part[split[middle], column])
                order[a:b] = order[a:b][split]
                cut += [a + middle, b]
            ends = cut
            self.cuts.append((np.array(columns), np.array(values)))
        self.x, self.n, self.v = x[order], n[order], v[order]
        self.ends = np.array(ends)
        self.low = np.minimum.reduceat(self.x, self.ends[:-1], axis=0) if len(x) else x[:0]
        self.high = np.maximum.reduceat(self.x, self.ends[:-1], axis=0) if len(x) else x[:0]

    def home(self, q: np.ndarray) -> np.ndarray:
        """The box whose side of every cut a point is on."""
        box = np.zeros(len(q), dtype=np.int64)
        for columns, values in self.cuts:
            box = 2 * box + (q[np.arange(len(q)), columns[box]] >= values[box])
        return box

    def squares(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each box."""
        out = np.zeros((len(q), len(self.low)))
        for j in range(q.shape[1]):
            gap = np.maximum(np.maximum(self.low[:, j] - q[:, j, None], q[:, j, None] - self.high[:, j]), 0.0)
            out += gap * gap
        return out

    def nearest(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(distance, point number) of the k nearest points of each query, by distance, mean value and number; -1 where there are fewer."""
        far, which = np.full((len(q), k), np.inf), np.full((len(q), k), -1)
        least = self.squares(q)
        at = least.min(axis=0)
        order = np.argsort(at, kind="stable")
        # Rounding of the matrix product stays far below this slack.
        slack = 1e-11 * (1.0 + float((q * q).sum(axis=1).max(initial=0)) + float(np.maximum(self.low**2, self.high**2).sum(axis=1).max(initial=0)))
        for i in range(0, len(order), BOXES):
            limit = far[:, -1] ** 2 * (1 + 1e-9) + slack
            boxes = order[i : i + BOXES]
            if at[boxes[0]] > limit.max():
                break
            rows = np.flatnonzero((least[:, boxes] <= limit[:, None]).any(axis=1))
            if not len(rows):
                continue
            points = np.concatenate([np.arange(self.ends[b], self.ends[b + 1]) for b in boxes])
            p, mine = self.x[points], q[rows]
            square = (mine * mine).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2.0 * (mine @ p.T)
            r, c = np.nonzero(square <= limit[rows][:, None])
            if not len(r):
                continue
            found = np.zeros(len(r))
            # Column by column, so that a distance does not depend on how rows lie in memory.
            for j in range(q.shape[1]):
                gap = mine[r, j] - p[c, j]
                found += gap * gap
            found = np.sqrt(found)
            hit = np.unique(r)
            r = np.concatenate([np.repeat(hit, k), r])
            d = np.concatenate([far[rows[hit]].ravel(), found])
            w = np.concatenate([which[rows[hit]].ravel(), points[c]])
            best = np.lexsort((self.n[w], self.v[w], d, r))
            r = r[best]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            first = place < k
            far[rows[r[first]], place[first]], which[rows[r[first]], place[first]] = d[best][first], w[best][first]
        return far, which


def nearest(
    queries: DataFrame,
    key: str,
    donors: DataFrame,
    value: str | Column,
    columns: Sequence[str],
    k: int,
    block: int = 256,
    pivots: int | None = None,
) -> DataFrame:
    """Per query key: ``neighbors``, an array of (distance, value, n) sorted by distance that covers k donors.

    Equal donor points count as one entry with their number ``n`` and mean value. A task searches ``block`` queries at once in
    boxes of donors, ``pivots`` of them if given.
    """
    names = [f"x{i}" for i in range(len(columns))]
    coordinates = [num(c).alias(n) for c, n in zip(columns, names)]
    target = num(value).alias("v")
    spark = queries.sparkSession
    points = materialize(
        donors.select(*coordinates, target).dropna().groupBy(*names).agg(count_rows().alias("n"), F.avg("v").alias("v")), "donors"
    )
    total = points.count()
    if total == 0:
        raise ValueError("no complete donors")
    asked = materialize(queries.select(F.col(key).alias("key"), *coordinates).dropna(subset=names), "asked")
    rounds = max(1, -(-total * 8 * (len(names) + 2) // ROUND_BYTES))
    tasks = max(min(4 * spark.sparkContext.defaultParallelism, -(-(size := asked.count()) // block)), -(-size // TASK_QUERIES), 1)
    kind = dict(asked.dtypes)["key"]

    def numbers(table: pa.Table | pa.RecordBatch) -> np.ndarray:
        return np.column_stack([table.column(n).to_numpy() for n in names])

    def search(r: int) -> DataFrame:
        some = points.where(F.pmod(F.xxhash64(*names), F.lit(rounds)) == r).toArrow()
        x = numbers(some)
        told = spark.sparkContext.broadcast(Boxes(x, some.column("n").to_numpy(), some.column("v").to_numpy(), pivots or -(-len(x) // BOX_POINTS)))

        @F.pandas_udf("bigint")
        def home(*xs: pd.Series) -> pd.Series:
            return pd.Series(told.value.home(np.column_stack(xs)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            boxes = told.value
            for batch in batches:
                q = numbers(batch)
                for start in range(0, len(q), block):
                    far, which = boxes.nearest(q[start : start + block], k)
                    row, place = np.nonzero(which >= 0)
                    w = which[row, place]
                    keys = batch.column("key").take(pa.array(row + start))
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(far[row, place]), pa.array(boxes.v[w]), pa.array(boxes.n[w])], names=["key", "distance", "value", "n"]
                    )

        # Queries of one box and its neighbours meet in one task, one after the other.
        near = asked.withColumn("_home", home(*names)).repartitionByRange(tasks, "_home", *names).sortWithinPartitions("_home").drop("_home")
        return near.mapInArrow(run, f"key {kind}, distance double, value double, n bigint")

    found = reduce(DataFrame.union, [search(r) for r in range(rounds)])
    entry = F.struct("distance", "value", "n")
    return found.groupBy("key").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("neighbors")).withColumnRenamed("key", key)


def mean_of_neighbors(neighbors: Column, k: int, by_distance: bool = False) -> Column:
    """Mean value of the k nearest donors; weighted by inverse distance if asked (exact matches then decide alone)."""
    start = F.struct(F.lit(0.0).alias("used"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("total"))
    exact = F.exists(neighbors, lambda x: x["distance"] == 0)

    def add(acc: Column, x: Column) -> Column:
        take = F.least(x["n"].cast("double"), F.greatest(F.lit(float(k)) - acc["used"], F.lit(0.0)))
        if by_distance:
            w = F.when(exact, F.when(x["distance"] == 0, take).otherwise(0.0)).otherwise(take / F.greatest(x["distance"], F.lit(1e-300)))
        else:
            w = take
        return F.struct(
            (acc["used"] + take).alias("used"), (acc["weight"] + w).alias("weight"), (acc["total"] + w * x["value"]).alias("total")
        )

    return F.aggregate(neighbors, start, add, lambda acc: acc["total"] / acc["weight"])
