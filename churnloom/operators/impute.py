"""Model-based imputation: nearest neighbours and chained regressions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import count_rows, num
from ..session import materialize
from .linear import fit
from .quantiles import quantiles
from .skew import attach


#: Rows with gaps that are compared with a batch of donors at once, donors of a batch, and rows with gaps that all tasks hold at once.
GAP_ROWS = 500
DONOR_ROWS = 4_000
ROUND_ROWS = 200_000
#: Donors that a task takes, where there are more tasks than cores.
TASK_DONORS = 500_000


class _Pattern:
    """Rows that miss the same columns, and the k nearest donors so far of each missing cell."""

    def __init__(self, keys: list, x: np.ndarray, k: int):
        self.keys, self.x = keys, x
        self.own = np.flatnonzero(~np.isnan(x[0]))
        self.missing = np.flatnonzero(np.isnan(x[0]))
        empty = lambda fill, kind: {j: np.full((len(x), k), fill, kind) for j in self.missing}
        self.far, self.value, self.name = empty(np.inf, float), empty(np.nan, float), empty("", "U1")


def _patterns(keys: list, x: np.ndarray, k: int) -> list[_Pattern]:
    """Rows with gaps by their null pattern; rows without any value have no neighbours."""
    kinds, which = np.unique(np.isnan(x), axis=0, return_inverse=True)
    which = which.ravel()
    groups = [np.flatnonzero(which == i) for i, kind in enumerate(kinds) if not kind.all()]
    return [_Pattern([keys[i] for i in g], x[g], k) for g in groups]


def _keep_nearest(p: _Pattern, j: int, row: np.ndarray, far: np.ndarray, name: np.ndarray, value: np.ndarray, k: int) -> None:
    """Takes found donors (one entry each) into the k nearest of their rows; ties go to the smaller name."""
    hit = np.unique(row)
    entries = [
        np.concatenate([np.repeat(hit, k), row]), np.concatenate([p.far[j][hit].ravel(), far]),
        np.concatenate([p.name[j][hit].ravel(), name]), np.concatenate([p.value[j][hit].ravel(), value]),
    ]
    order = np.lexsort((entries[3], entries[2], entries[1], entries[0]))
    row = entries[0][order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    first = place < k
    row, place, order = row[first], place[first], order[first]
    if entries[2].dtype.itemsize > p.name[j].dtype.itemsize:
        p.name[j] = p.name[j].astype(entries[2].dtype)
    for table, new in ((p.far, entries[1]), (p.name, entries[2]), (p.value, entries[3])):
        table[j][row, place] = new[order]


def _meet(p: _Pattern, names: np.ndarray, x: np.ndarray, center: np.ndarray, k: int) -> None:
    """Compares the rows of a pattern with a batch of donors.

    Distances run over the columns that a row and a donor share, scaled up to all columns; one matrix product gives the squares
    of all pairs. It rounds, so pairs near or below the k-th best so far are measured again value by value.
    """
    known = ~np.isnan(x[:, p.own])
    some = known.any(axis=1)
    names, x, known = names[some], x[some], known[some]
    if not len(x):
        return
    width = x.shape[1]
    scale = width / known.sum(axis=1)
    x0 = np.nan_to_num(x[:, p.own] - center[p.own])
    right = np.hstack([known, x0, x0**2]) * scale[:, None]
    able = ~np.isnan(x)
    for start in range(0, len(p.x), GAP_ROWS):
        raw = p.x[start : start + GAP_ROWS, p.own]
        q = raw - center[p.own]
        square = np.hstack([q**2, -2 * q, np.ones_like(q)]) @ right.T
        slack = 1e-6 * (1.0 + np.sqrt(max((q**2).max(initial=0), (x0**2).max(initial=0))))
        for j in p.missing:
            bound = p.far[j][start : start + GAP_ROWS, -1]
            open_ = np.isinf(bound)
            mine = square if able[:, j].all() else np.where(able[:, j], square, np.inf)
            if open_.any() and len(x) > k:
                # No k donors yet: the batch's own k-th square bounds them.
                bound = np.where(open_, np.sqrt(np.maximum(np.partition(mine, k - 1, axis=1)[:, k - 1], 0.0)), bound)
            row, donor = np.nonzero((mine <= ((bound * (1 + 1e-6) + slack) ** 2)[:, None]) & np.isfinite(mine))
            # Equal donors can all be near: they are taken in slices.
            for part in range(0, len(row), 1_000_000):
                r, d = row[part : part + 1_000_000], donor[part : part + 1_000_000]
                far = np.sqrt(np.nansum((x[d][:, p.own] - raw[r]) ** 2, axis=1) * scale[d])
                _keep_nearest(p, j, r + start, far, names[d], x[d, j], k)


def knn_impute(df: DataFrame, key: str, columns: Sequence[str], k: int = 5, donors: DataFrame | None = None) -> DataFrame:
    """Nulls become the mean of the k nearest rows that have the value.

    Distances are Euclidean over the columns that both rows have, scaled up to all columns; ties go to the smaller key as
    text. Donors are all rows, or those of ``donors``. Where no donor shares a column with the row, the
    donors' column mean is used. Rows with gaps go to all tasks, at most ``ROUND_ROWS`` at once; a task compares them with its
    donors batch by batch, whatever the null patterns are, and returns k donors per missing cell.
    """
    columns = list(columns)
    spark = df.sparkSession
    cells = F.array(*[num(c) for c in columns]).alias("x")
    gaps = F.exists("x", lambda v: v.isNull())
    asked = materialize(df.select(F.col(key).alias("key"), cells).where(gaps), "gaps")
    given = materialize((df if donors is None else donors).select(F.col(key).alias("key"), cells).where(F.exists("x", lambda v: v.isNotNull())), "donors")
    means = given.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(columns))], count_rows().alias("n")).first()
    center = np.array([m if (m := means[f"m{i}"]) is not None else 0.0 for i in range(len(columns))])
    kind = df.schema[key].dataType
    rounds = max(1, -(-asked.count() // ROUND_ROWS))
    tasks = max(min(2 * spark.sparkContext.defaultParallelism, -(-means["n"] // DONOR_ROWS)), -(-means["n"] // TASK_DONORS), 1)
    dealt = given.repartition(tasks)

    def rows_of(keys: pa.Array, x: pa.Array) -> tuple[list, np.ndarray]:
        return keys.to_pylist(), x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(keys), len(columns))

    def search(r: int) -> DataFrame:
        mine = asked.where(F.pmod(F.xxhash64("key", "x"), F.lit(rounds)) == r).toArrow().combine_chunks()
        told = spark.sparkContext.broadcast(rows_of(*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in mine.columns)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            patterns = _patterns(*told.value, k)
            for batch in batches:
                for start in range(0, batch.num_rows, DONOR_ROWS):
                    keys, x = rows_of(*batch.slice(start, DONOR_ROWS).columns)
                    names = np.array([str(v) for v in keys])
                    for p in patterns:
                        _meet(p, names, x, center, k)
            for p in patterns:
                for j in p.missing:
                    found = np.isfinite(p.far[j])
                    for start in range(0, len(found), 50_000):
                        part = slice(start, start + 50_000)
                        at = np.repeat(np.arange(len(found))[part], found[part].sum(axis=1))
                        columns_ = [
                            pa.array([p.keys[i] for i in at], dealt_key), pa.array([columns[j]] * len(at), pa.string()), pa.array(p.far[j][part][found[part]]),
                            pa.array(p.name[j][part][found[part]].tolist(), pa.string()), pa.array(p.value[j][part][found[part]]),
                        ]
                        yield pa.RecordBatch.from_arrays(columns_, names=["key", "column", "distance", "donor", "value"])

        dealt_key = mine.schema.field("key").type
        return dealt.mapInArrow(run, f"key {kind.simpleString()}, column string, distance double, donor string, value double")

    near = reduce(DataFrame.union, [search(r) for r in range(rounds)])
    order = Window.partitionBy("key", "column").orderBy("distance", "donor", "value")
    chosen = near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
    wide = chosen.groupBy("key").agg(*[F.avg(F.when(F.col("column") == c, F.col("value"))).alias(f"_f_{i}") for i, c in enumerate(columns)])
    out = attach(df, wide.withColumnRenamed("key", key), [key])
    return out.withColumns({c: F.coalesce(num(c), F.col(f"_f_{i}"), F.lit(means[f"m{i}"])) for i, c in enumerate(columns)}).drop(*[f"_f_{i}" for i in range(len(columns))])


def mice_impute(
    df: DataFrame, columns: Sequence[str], rounds: int = 30, tolerance: float = 5e-3, fit_on: Column | None = None
) -> tuple[DataFrame, int]:
    """Chained linear regressions from a median start until the largest change is small; also the rounds used.

    With ``fit_on`` medians and regressions are learned on those rows only, and fill the others too.
    Each step needs only cross-products. Every round is written out, so plans stay short and a lost
    executor repeats one round at most.
    """
    columns = list(columns)
    learn = F.lit(True) if fit_on is None else fit_on
    start = quantiles(df.where(learn), columns, [0.5])
    original = {c: F.col(f"_o_{c}") for c in columns}
    state = df.withColumns({f"_o_{c}": num(c) for c in columns})
    state = materialize(state.withColumns({c: F.coalesce(original[c], F.lit(start[c][0.5])) for c in columns}), "mice0")
    sizes = state.agg(
        count_rows().alias("n"), *[F.count(f"_o_{c}").alias(f"n_{c}") for c in columns], *[F.count(F.when(learn, F.col(f"_o_{c}"))).alias(f"l_{c}") for c in columns],
        *[F.max(F.when(learn, F.abs(f"_o_{c}"))).alias(f"size_{c}") for c in columns],
    ).first()
    gaps = sorted((c for c in columns if sizes[f"l_{c}"] and sizes[f"n_{c}"] < sizes["n"]), key=lambda c: -sizes[f"n_{c}"])
    limit = tolerance * max((sizes[f"size_{c}"] or 0.0) for c in columns)
    used = 0
    for used in range(1, rounds + 1 if gaps else 1):
        # Earlier columns of the round feed later ones; ``_b_`` keeps the values before the round.
        new = state.withColumns({f"_b_{c}": F.col(c) for c in gaps})
        for c in gaps:
            model = fit(new.where(learn), [o for o in columns if o != c], original[c])
            new = new.withColumn(c, F.coalesce(original[c], model.predicted()))
        state = materialize(new, "mice")
        change = state.agg(F.max(F.greatest(*[F.abs(F.col(c) - F.col(f"_b_{c}")) for c in gaps], F.lit(0.0)))).first()[0]
        state = state.drop(*[f"_b_{c}" for c in gaps])
        if change is not None and change < limit:
            break
    return state.drop(*[f"_o_{c}" for c in columns]), used
