"""Many logistic models fitted at once by Newton steps.

A pass over the rows returns the log-likelihood, gradient and Hessian of every model of the stack (replicates with
their own row weights, nested column sets, folds, penalties) from one aggregation; the small systems are solved on
the driver. Passes follow the slowest model, not the number of models.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import num
from ..session import materialize
from .clean import MAX_LEVELS, fill_values, levels_of

DESIGN = "_x"
_DONE = 1e-13


@dataclass(frozen=True)
class Design:
    """Rows with their label and a number array ``_x`` (null where missing); which places a feature takes."""

    rows: DataFrame
    slots: dict[str, tuple[int, ...]]
    levels: dict[str, list[str]]
    label: str = "label"

    @property
    def width(self) -> int:
        return sum(map(len, self.slots.values()))

    def columns(self, features: Sequence[str]) -> tuple[int, ...]:
        return tuple(i for f in features for i in self.slots[f])

    def fills(self, part: DataFrame, strategy: str = "median") -> tuple[float, ...]:
        """What stands for missing values, learned on ``part``: medians (or means), and the most frequent level."""
        numbers = [f for f in self.slots if f not in self.levels]
        known = fill_values(part, numbers, list(self.levels), strategy)
        out = np.zeros(self.width)
        for f, places in self.slots.items():
            if f in self.levels:
                for i, level in zip(places, self.levels[f]):
                    out[i] = float(known.get(f) == level)
            else:
                out[places[0]] = float(known.get(f, 0.0) or 0.0)
        return tuple(out.tolist())


def design(
    df: DataFrame, numeric: Sequence[str], text: Sequence[str], keep: Sequence[str] = (), label: str = "label",
    levels: Mapping[str, list[str]] | None = None, **extra: Column,
) -> Design:
    """The design of numeric columns and of one 0/1 place per level of the text columns, written once.

    ``keep`` columns and ``extra`` expressions go along; rows without a label are left out. ``levels`` are those of another
    design, else the levels of ``df``; others give zeros. A text column of too many levels raises, as each level is a place.
    """
    levels = dict(levels) if levels is not None else {t: [str(v) for v in levels_of(df, t, MAX_LEVELS)] for t in text}
    cells, slots = [], {}
    for n in numeric:
        slots[n] = (len(cells),)
        value = num(n)
        cells.append(F.when(~F.isnan(value), value))
    for t in text:
        slots[t] = tuple(range(len(cells), len(cells) + len(levels[t])))
        cells += [(F.col(t).cast("string") == v).cast("double") for v in levels[t]]
    named = dict.fromkeys([*keep, *numeric, *text])
    rows = df.select(*named, num(label).alias(label), F.array(*cells).cast("array<double>").alias(DESIGN), *[e.alias(n) for n, e in extra.items()])
    return Design(materialize(rows.where(F.col(label).isNotNull()), "design"), slots, levels, label)


@dataclass(frozen=True)
class Candidate:
    """One model: its entry of the weight array (none: weight 1), its design columns (none: all), L2 penalty and fills.

    The penalty is that of ``pyspark.ml``: ``l2 / 2`` times the squared coefficients in units of the columns' weighted
    standard deviations, beside the mean loss; the intercept goes free.
    """

    weight: int | None = None
    columns: tuple[int, ...] | None = None
    l2: float = 0.0
    fills: tuple[float, ...] | None = None


@dataclass(frozen=True)
class Fitted:
    """Coefficients over all design columns (0 for those not used) and what the fit saw; ``ok`` is false for one class.

    ``frame`` holds the column moments, so that a later fit of the same rows can start here.
    """

    coefficients: np.ndarray
    intercept: float
    log_likelihood: float
    rows: int
    weight: float
    passes: int
    ok: bool
    fills: tuple[float, ...] | None
    frame: tuple[np.ndarray, ...] = ()


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a column of number arrays of one length, NaN where missing."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), width)


def _sigmoid(score: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(score, -700, 700)))


def _sweep(rows: DataFrame, label: str, weights: str | None, models: Sequence[Candidate], at: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Per model: rows, weight, weighted positives, squared weights, log-likelihood, gradient and Hessian at ``at``."""
    width = len(center)
    size = 5 + (width + 1) + (width + 1) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), size))
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, y = matrix(batch.column(0), width), batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            w_all = np.stack(batch.column(2).to_numpy(zero_copy_only=False)).astype(float) if weights else None
            seen: dict[tuple | None, np.ndarray] = {}
            for i, m in enumerate(models):
                if m.fills not in seen:
                    filled = np.where(np.isnan(raw), 0.0 if m.fills is None else np.array(m.fills), raw)
                    seen[m.fills] = np.hstack([(filled - center) / scale, np.ones((len(y), 1))])
                z, yy = seen[m.fills], y
                w = np.ones(len(y)) if m.weight is None else w_all[:, m.weight]
                if m.weight is not None and (w == 0).any():
                    live = w != 0
                    z, yy, w = z[live], y[live], w[live]
                score = z @ at[i]
                p = _sigmoid(score)
                t = total[i]
                t[:5] += len(w), w.sum(), w @ yy, w @ w, w @ (yy * score - np.logaddexp(0.0, score))
                t[5 : 6 + width] += (w * (yy - p)) @ z
                t[6 + width :] += ((z * (w * p * (1 - p))[:, None]).T @ z).ravel()
        flat = np.arange(len(models) * size)
        yield pa.RecordBatch.from_arrays([pa.array(flat, pa.int64()), pa.array(total.ravel(), pa.float64())], names=["place", "value"])

    source = rows.select(DESIGN, label, *([weights] if weights else []))
    sums = source.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(len(models) * size)
    got = sums.toPandas()
    out[got["place"].to_numpy()] = got["value"].to_numpy()
    return out.reshape(len(models), size)


def fit_stack(
    rows: DataFrame, width: int, candidates: Sequence[Candidate], label: str = "label", weights: str | None = None,
    max_passes: int = 30, start: Sequence[Fitted] | None = None,
) -> list[Fitted]:
    """Weighted, penalised logistic fits of all ``candidates``; ``rows`` has ``_x``, the label and an array of weights.

    Columns without variation under a model's weights get coefficient 0; of collinear columns without a penalty the
    solution of least norm is taken. A step that lowers the objective is halved. Models that have converged leave the
    later passes. ``start`` gives earlier fits of the same rows, weights and fills with at least the same columns.
    """
    if start is not None:
        center, scale = start[0].frame[:2]
    else:
        cells = [F.col(DESIGN)[i] for i in range(width)]
        first = rows.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(cells)], *[F.stddev_samp(x).alias(f"s{i}") for i, x in enumerate(cells)]).first()
        center = np.array([first[f"m{i}"] or 0.0 for i in range(width)])
        scale = np.array([first[f"s{i}"] or 1.0 for i in range(width)])
    n = len(candidates)
    at = np.zeros((n, width + 1))
    allowed = np.zeros((n, width), bool)
    for i, m in enumerate(candidates):
        allowed[i, list(range(width) if m.columns is None else m.columns)] = True
    spread, info = np.zeros((n, width)), np.zeros((n, 4))
    fitted: dict[int, tuple[float, int, bool]] = {}
    held: dict[int, tuple[np.ndarray, float]] = {}
    live = list(range(n))
    passes = 0
    if start is not None:
        for i, given in enumerate(start):
            spread[i] = np.where(allowed[i], given.frame[2], 0.0)
            info[i] = given.frame[3]
            on = spread[i] > 0
            at[i, :-1] = np.where(on, given.coefficients * scale, 0.0)
            at[i, -1] = given.intercept + given.coefficients[on] @ center[on]
    while live and passes < max_passes:
        passes += 1
        sums = _sweep(rows, label, weights, [candidates[i] for i in live], at[live], center, scale)
        again = []
        for i, t in zip(live, sums):
            seen, total, positive, squares, ll = t[:5]
            gradient, hessian = t[5 : 6 + width], t[6 + width :].reshape(width + 1, width + 1)
            if passes == 1 and start is None:
                info[i] = seen, total, positive, squares
                if not 0 < positive < total:
                    fitted[i] = (float("nan"), passes, False)
                    continue
                # At zero every row has p (1 - p) = 1/4, so the Hessian holds the weighted moments.
                mean, second = 4 * hessian[-1, :-1] / total, 4 * np.diag(hessian)[:-1] / total
                free = total - squares / total
                spread[i] = np.sqrt(np.clip((second - mean**2) * (total / free if free > 0 else 0.0), 0, None))
                spread[i][~allowed[i] | (spread[i] < 1e-9)] = 0.0
            penalty = candidates[i].l2 * total * np.append(spread[i] ** 2, 0.0)
            value = ll - 0.5 * penalty @ at[i] ** 2
            if i in held and value < held[i][1] - 1e-10 * abs(held[i][1]):
                at[i] = (at[i] + held[i][0]) / 2
                again.append(i)
                continue
            used = np.append(np.flatnonzero(spread[i] > 0), width)
            unit = np.append(spread[i], 1.0)[used]
            g = (gradient - penalty * at[i])[used] / unit
            h = (hessian + np.diag(penalty))[np.ix_(used, used)] / np.outer(unit, unit)
            values, vectors = np.linalg.eigh(h)
            good = values > 1e-12 * max(values[-1], 1e-300)
            step = vectors[:, good] @ ((vectors[:, good].T @ g) / values[good])
            held[i] = (at[i].copy(), value)
            at[i, used] += step / unit
            gain = float(g @ step)
            if gain <= _DONE * total:
                fitted[i] = (float(ll + 0.5 * gain), passes, True)
            else:
                again.append(i)
        live = again
    for i in live:
        fitted[i] = (held[i][1] if i in held else float("nan"), passes, i in held)
    out = []
    for i, m in enumerate(candidates):
        ll, taken, ok = fitted[i]
        b = np.where(spread[i] > 0, at[i, :-1] / scale, 0.0)
        out.append(Fitted(b, float(at[i, -1] - b @ center), ll, int(info[i, 0]), float(info[i, 1]), taken, ok, m.fills, (center, scale, spread[i], info[i])))
    return out


def score_stack(rows: DataFrame, keep: Sequence[str], fits: Sequence[Fitted], name: str = "scores") -> DataFrame:
    """The ``keep`` columns and an array with each model's probability, in one pass without a shuffle."""
    width = len(fits[0].coefficients)
    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    names = [*keep, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = matrix(batch.column(len(keep)), width)
            scores = np.empty((len(raw), len(fits)))
            seen: dict[tuple | None, np.ndarray] = {}
            for i, f in enumerate(fits):
                if f.fills not in seen:
                    seen[f.fills] = np.where(np.isnan(raw), 0.0 if f.fills is None else np.array(f.fills), raw)
                scores[:, i] = _sigmoid(seen[f.fills] @ f.coefficients + f.intercept)
            places = pa.array(np.arange(len(raw) + 1) * len(fits), pa.int32())
            lists = pa.ListArray.from_arrays(places, pa.array(scores.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], lists], names=names)

    return rows.select(*keep, DESIGN).mapInArrow(run, schema)


def long_scores(scored: DataFrame, keep: Sequence[str], names: Mapping[int, object], name: str = "scores", group: str = "model") -> DataFrame:
    """One row per row and named model: ``keep``, the model's name and its ``p``."""
    picked = F.array(*[F.struct(F.lit(v).alias(group), F.col(name)[i].alias("p")) for i, v in names.items()])
    return scored.select(*keep, F.inline(picked))
