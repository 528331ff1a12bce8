"""Penalised least squares (ridge, lasso, elastic net) for any number of penalties from the same two scans.

The rows are aggregated into means and centred cross-products once; every penalty is then coordinate descent on the
correlation matrix, whose size is that of the design. A third scan scores held-out rows under all models together.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import count_rows, num
from ..session import materialize
from .linear import Gram
from .newton import DESIGN, Design, design, matrix
from .scoring import regression_columns

_STILL = 1e-13
_CONSTANT = 1e-12


@dataclass(frozen=True)
class Penalty:
    """``strength`` beside the mean of half the squared errors; ``mix`` of it is on absolute values, the rest on half the squares.

    Both are in units of the standardised columns and target, as in ``pyspark.ml``; the intercept goes free.
    """

    strength: float = 0.0
    mix: float = 0.0


@dataclass(frozen=True)
class Solved:
    """Coefficients by design column, and by how much the conditions of an optimum are missed (standardised units)."""

    coefficients: np.ndarray
    intercept: float
    violation: float
    rounds: int


def moments(rows: DataFrame, width: int, label: str = "label", fills: Sequence[float] | None = None) -> Gram:
    """Centred cross-products of the design's columns and the label, in two scans; missing cells read as ``fills`` (0).

    Rows without a label, or with one that is not finite, are left out; no rows raise.
    """
    known = np.zeros(width) if fills is None else np.array(fills, float)
    rows = rows.where(F.col(label).isNotNull() & (F.abs(F.col(label)) < F.lit(float("inf"))))
    cells = [F.coalesce(F.col(DESIGN)[i], F.lit(float(known[i]))) for i in range(width)]
    first = rows.agg(count_rows().alias("n"), F.avg(label).alias("y"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(cells)]).first()
    if not first["n"]:
        raise ValueError("no rows with a target")
    center = np.array([first[f"m{i}"] for i in range(width)] + [first["y"]])
    size = (width + 1) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if batch.num_rows:
                raw = matrix(batch.column(0), width)
                both = np.hstack([np.where(np.isnan(raw), known, raw), batch.column(1).to_numpy(zero_copy_only=False)[:, None]]) - center
                total += both.T @ both
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int64()), pa.array(total.ravel(), pa.float64())], names=["place", "value"])

    sums = rows.select(DESIGN, F.col(label).cast("double")).mapInArrow(run, "place long, value double")
    got = sums.groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    flat = np.zeros(size)
    flat[got["place"].to_numpy()] = got["value"].to_numpy()
    m = flat.reshape(width + 1, width + 1)
    return Gram([str(i) for i in range(width)], first["n"], center[:-1], m[:-1, :-1], float(center[-1]), m[:-1, -1], float(m[-1, -1]))


def _descend(r: np.ndarray, xy: np.ndarray, l1: float, l2: float, start: np.ndarray, most: int) -> tuple[np.ndarray, int]:
    """Least of b'Rb/2 - xy'b + l1 |b| + l2 b'b/2, one coordinate after another until none moves."""
    b = start.copy()
    left = xy - r @ b
    for rounds in range(1, most + 1):
        moved = 0.0
        for j in range(len(b)):
            pull = left[j] + r[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (r[j, j] + l2)
            if new != b[j]:
                left -= r[:, j] * (new - b[j])
                moved = max(moved, abs(new - b[j]))
                b[j] = new
        if moved <= _STILL:
            break
    return b, rounds


def solve(g: Gram, penalties: Sequence[Penalty], most: int = 20_000) -> list[Solved]:
    """The model of each penalty, from the cross-products alone; stronger penalties of a mix start the weaker ones.

    Without a penalty, collinear columns share their effect (the solution of least norm). Constant columns get 0, and a
    constant target gives coefficients of 0.
    """
    spread, y_spread = np.sqrt(np.clip(np.diag(g.xx), 0, None) / g.n), float(np.sqrt(max(g.yy, 0.0) / g.n))
    on = np.flatnonzero(spread > _CONSTANT * np.maximum(np.abs(g.mean), 1.0))
    flat = not len(on) or y_spread <= _CONSTANT * max(abs(g.y_mean), 1.0)
    out: list[Solved | None] = [None] * len(penalties)
    if not flat:
        r = g.xx[np.ix_(on, on)] / np.outer(spread[on], spread[on]) / g.n
        xy = g.xy[on] / spread[on] / y_spread / g.n
    warm: dict[float, np.ndarray] = {}
    for i in sorted(range(len(penalties)), key=lambda i: -penalties[i].strength):
        p = penalties[i]
        if p.strength < 0 or not 0 <= p.mix <= 1:
            raise ValueError("a penalty needs a strength of 0 or more and a mix from 0 to 1")
        full = np.zeros(len(spread))
        if flat:
            out[i] = Solved(full, g.y_mean, 0.0, 0)
            continue
        l1, l2 = p.strength * p.mix / y_spread, p.strength * (1 - p.mix) / y_spread
        if l1 == 0:
            b, rounds = np.linalg.pinv(r + l2 * np.eye(len(on)), rcond=1e-12, hermitian=True) @ xy, 1
        else:
            b, rounds = _descend(r, xy, l1, l2, warm.get(p.mix, np.zeros(len(on))), most)
        warm[p.mix] = b
        slope = xy - r @ b - l2 * b
        missed = np.where(b != 0, np.abs(slope - l1 * np.sign(b)), np.maximum(np.abs(slope) - l1, 0))
        full[on] = b * y_spread / spread[on]
        out[i] = Solved(full, float(g.y_mean - full @ g.mean), float(missed.max()), rounds)
    return out


def path(df: DataFrame, target: str, features: Sequence[str], penalties: Mapping[str, Penalty]) -> DataFrame:
    """One row per model and column: ``model``, ``feature``, ``coefficient``, and the model's ``intercept`` and ``violation``.

    Text columns have a 0/1 column per level, named ``column=level``. Missing numbers read as the column's median and
    missing levels as its most frequent one. Rows without a target are left out.
    """
    d, fills = _designed(df, target, features)
    names = [f if f not in d.levels else f"{f}={v}" for f in d.slots for v in (d.levels.get(f) or [""])[: len(d.slots[f])]]
    rows = []
    for name, m in zip(penalties, solve(moments(d.rows, d.width, d.label, fills), list(penalties.values()))):
        rows += [(name, f, float(b), m.intercept, m.violation) for f, b in zip(names, m.coefficients)]
    return df.sparkSession.createDataFrame(rows, "model string, feature string, coefficient double, intercept double, violation double")


def _designed(df: DataFrame, target: str, features: Sequence[str], levels=None) -> tuple[Design, tuple[float, ...]]:
    from .models import feature_kinds

    numeric, text = feature_kinds(df, features)
    d = design(df.withColumn("_target", num(target)), numeric, text, label="_target", levels=levels)
    return d, d.fills(d.rows)


def score(rows: DataFrame, width: int, models: Sequence[Solved], fills: Sequence[float], keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns and ``_p``, the predictions of all models in their order, in one scan."""
    known = np.array(fills, float)
    weights = np.stack([m.coefficients for m in models], axis=1) if width else np.zeros((0, len(models)))
    base = np.array([m.intercept for m in models])
    source = rows.select(*keep, DESIGN)
    schema = rows.select(*keep, F.array(F.lit(0.0)).alias("_p")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = matrix(batch.column(len(keep)), width) if width else np.zeros((batch.num_rows, 0))
            p = np.where(np.isnan(raw), known, raw) @ weights + base
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(base))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.ListArray.from_arrays(ends, pa.array(p.ravel()))], names=schema.names)

    return source.mapInArrow(run, schema)


def train_path(df: DataFrame, key: str, target: str, features: Sequence[str], penalties: Mapping[str, Penalty], test_size: float = 0.25, seed: int = 42) -> tuple[DataFrame, dict[str, Solved]]:
    """Held-out errors of all models, one row each, and the models; the split and the errors are those of ``train_regressor``."""
    from .models import split_by_key

    data = materialize(df.select(*dict.fromkeys([key, *features]), num(target).alias("label")).where(F.col("label").isNotNull()), "path")
    train, test = split_by_key(data, key, test_size, seed)
    d, fills = _designed(train, "label", features)
    models = dict(zip(penalties, solve(moments(d.rows, d.width, d.label, fills), list(penalties.values()))))
    held = design(test.withColumn("_target", F.col("label")), [f for f in d.slots if f not in d.levels], list(d.levels), label="_target", levels=d.levels)
    scored = score(held.rows, d.width, list(models.values()), fills, ["_target"])
    found = scored.agg(*[F.struct(*regression_columns(F.col("_target"), F.col("_p")[i])).alias(f"m{i}") for i in range(len(models))])
    return found.select(F.explode(F.array(*[F.struct(F.lit(name).alias("model"), f"m{i}.*") for i, name in enumerate(models)])).alias("m")).select("m.*"), models
