"""Outliers, imputation and feature transforms."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    OneHotEncoder,
    RobustScaler,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip, num, numeric_columns, rnd, rounded, share, text_columns
from ..session import materialize
from .describe import corrected_kurtosis, corrected_skewness
from .ordered import group_moving, moving, with_codes
from .quality import rows_of
from .quantiles import bin_of, distinct_edges, mode_table, quantiles


MAX_LEVELS = 10_000
_GRID_ROWS = pa.schema(
    [("place", pa.int32()), ("n", pa.int64()), ("j", pa.float64()), *[(n, pa.list_(pa.float64())) for n in ("rows", "mean", "square")]]
)


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> dict[str, tuple[float, float]]:
    q = quantiles(df, columns, [0.25, 0.75])
    out = {}
    for c in columns:
        low, high = q[c][0.25], q[c][0.75]
        if low is not None:
            out[c] = (low - factor * (high - low), high + factor * (high - low))
    return out


def outliers_iqr(df: DataFrame, columns: Sequence[str] | None = None, factor: float = 1.5) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    bounds = iqr_bounds(df, columns, factor)
    used = [c for c in columns if c in bounds]
    outside = {c: (num(c) < bounds[c][0]) | (num(c) > bounds[c][1]) for c in used}
    wide = df.agg(
        *[F.count_if(outside[c]).alias(f"outliers__{i}") for i, c in enumerate(used)],
        *[rnd(F.count_if(outside[c]) / F.count(num(c)) * 100, 2).alias(f"pct_outliers__{i}") for i, c in enumerate(used)],
        *[F.lit(rounded(bounds[c][0], 4)).alias(f"lower__{i}") for i, c in enumerate(used)],
        *[F.lit(rounded(bounds[c][1], 4)).alias(f"upper__{i}") for i, c in enumerate(used)],
    )
    return rows_of(wide, used, ["lower", "upper", "outliers", "pct_outliers"]).orderBy(F.desc("pct_outliers"), "column_name")


def apply_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(num(c), low, high) for c, (low, high) in bounds.items()})


def clip_iqr(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    return apply_bounds(df, iqr_bounds(df, columns, factor))


def handle_outliers(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "clip_iqr",
    iqr_factor: float = 1.5,
    limits: tuple[float, float] = (0.01, 0.01),
) -> tuple[DataFrame, DataFrame]:
    """Treated rows and a report. ``remove_iqr`` works column by column on the surviving rows."""
    if method not in ("clip_iqr", "remove_iqr", "winsorize"):
        raise ValueError("method must be clip_iqr, remove_iqr or winsorize")
    rows = []
    if method == "remove_iqr":
        for c in columns:
            low, high = iqr_bounds(df, [c], iqr_factor)[c]
            keep = num(c).between(low, high) | num(c).isNull()
            rows.append((c, rounded(low, 4), rounded(high, 4), df.agg(share(~keep).alias("p")).first()[0], method))
            df = df.where(keep)
        out = df
    else:
        bounds = iqr_bounds(df, columns, iqr_factor)
        pct = df.agg(*[share((num(c) < bounds[c][0]) | (num(c) > bounds[c][1])).alias(c) for c in columns]).first()
        if method == "winsorize":
            q = quantiles(df, columns, [limits[0], 1 - limits[1]])
            bounds = {c: (q[c][limits[0]], q[c][1 - limits[1]]) for c in columns}
        rows = [(c, rounded(bounds[c][0], 4), rounded(bounds[c][1], 4), pct[c], method) for c in columns]
        out = apply_bounds(df, bounds)
    report = df.sparkSession.createDataFrame(
        rows, "column_name string, lower double, upper double, pct_outliers double, method string"
    )
    return out, report


def outlier_action(pct_outliers: Column) -> Column:
    """Below 0.5% winsorize, to 5% transform, beyond that investigate."""
    return F.when(pct_outliers < 0.5, "winsorize").when(pct_outliers <= 5, "transform").otherwise("investigate")


def fill_values(
    df: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    strategy: str = "median",
    category_strategy: str = "mode",
    constant: str = "desconocido",
) -> dict[str, Any]:
    """Fill value per column from one pass: median or mean, and mode or a constant."""
    fills: dict[str, Any] = {}
    if numeric:
        if strategy == "median":
            fills.update({c: q[0.5] for c, q in quantiles(df, numeric, [0.5]).items()})
        else:
            fills.update(df.agg(*[F.avg(num(c)).alias(c) for c in numeric]).first().asDict())
    if categorical:
        modes = {}
        if category_strategy == "mode":
            modes = {r["column_name"]: r["mode"] for r in mode_table(df, categorical).collect()}
        fills.update({c: modes.get(c) or constant for c in categorical})
    return {c: v for c, v in fills.items() if v is not None}


def fill_nulls(df: DataFrame, rules: Mapping[str, Any] | None = None, fit_on: DataFrame | None = None, **how) -> DataFrame:
    """Explicit values for the columns in ``rules``; the others by type. ``fit_on`` avoids learning from test rows.

    Columns without nulls keep their type and cost nothing.
    """
    rules = dict(rules or {})
    free = [c for c in numeric_columns(df) + text_columns(df) if c not in rules]
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in free]).first() if free else {}
    numeric = [c for c in numeric_columns(df) if c in free and missing[c]]
    categorical = [c for c in text_columns(df) if c in free and missing[c]]
    fills = {**fill_values(fit_on if fit_on is not None else df, numeric, categorical, **how), **rules}
    return df.withColumns(
        {c: F.coalesce(num(c) if c in numeric else F.col(c), F.lit(float(v) if c in numeric else v)) for c, v in fills.items()}
    )


def null_change(before: DataFrame, after: DataFrame, columns: Sequence[str], strategy: str) -> DataFrame:
    def total(df: DataFrame, name: str) -> DataFrame:
        nulls = sum((F.col(c).isNull().cast("bigint") for c in columns), F.lit(0))
        return df.agg(F.sum(nulls).alias(name))

    return total(before, "nulls_before").crossJoin(total(after, "nulls_after")).select(
        F.lit(strategy).alias("strategy"), F.lit(len(columns)).alias("columns"), "nulls_before", "nulls_after"
    )


def zscores(df: DataFrame, columns: Sequence[str], null_as: float | None = 0.0) -> DataFrame:
    """Population z-scores as ``<column>_z``; nulls first become ``null_as``."""
    value = {c: F.coalesce(num(c), F.lit(null_as)) if null_as is not None else num(c) for c in columns}
    stats = df.agg(
        *[F.avg(value[c]).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(value[c]).alias(f"_s_{c}") for c in columns]
    )
    out = df.crossJoin(F.broadcast(stats))
    z = {
        f"{c}_z": F.when(F.col(f"_s_{c}") == 0, F.lit(0.0)).otherwise((value[c] - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
        for c in columns
    }
    return out.withColumns(z).drop(*[f"_m_{c}" for c in columns], *[f"_s_{c}" for c in columns])


def levels_of(df: DataFrame, column: str, limit: int = 1000) -> list[str]:
    """Sorted levels; more than ``limit`` raises, because they become columns."""
    found = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v")).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} levels; encode it with category codes")
    return sorted(r["v"] for r in found)


def dummies(
    df: DataFrame, columns: Sequence[str], drop_first: bool = True, levels: Mapping[str, list[str]] | None = None, max_levels: int = 1000
) -> tuple[DataFrame, list[str]]:
    """0/1 columns per level, the first sorted level dropped; null and unseen levels give zeros.

    A column of more than ``max_levels`` levels raises: each level becomes a column of the table.
    """
    added: dict[str, Column] = {}
    for c in columns:
        known = list(levels[c]) if levels else levels_of(df, c, max_levels)
        for v in known[1 if drop_first else 0 :]:
            added[f"{c}_{v}"] = F.when(F.col(c).cast("string") == v, 1.0).otherwise(0.0)
    return df.withColumns(added), list(added)


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Alphabetical category number in ``<column>_code``; null gives -1."""
    return with_codes(df, column, f"{column}_code")


def equal_frequency_bins(df: DataFrame, column: str, bins: int) -> tuple[DataFrame, list[float]]:
    """Right-closed quantile bins in ``bin``; repeated edges are dropped."""
    q = quantiles(df, [column], [i / bins for i in range(bins + 1)])[column]
    edges = distinct_edges(q.values())
    return df.withColumn("bin", bin_of(num(column), edges)), edges


def fixed_bins(x: Column, cuts: Sequence[float]) -> Column:
    """Right-closed bucket name between fixed cut points, for example ``(30,45]``."""
    out = F.when(x <= cuts[0], f"<={cuts[0]:g}")
    for a, b in zip(cuts, cuts[1:]):
        out = out.when(x <= b, f"({a:g},{b:g}]")
    return out.when(x > cuts[-1], f">{cuts[-1]:g}")


def fractional_weights(d: float = 0.4, threshold: float = 1e-4, max_window: int = 48) -> list[float]:
    """Binomial weights of (1 - lag)^d, newest first, cut where they become negligible."""
    weights = [1.0]
    for k in range(1, max_window):
        w = -weights[-1] * (d - k + 1) / k
        if abs(w) < threshold:
            break
        weights.append(w)
    return weights


def fractional_difference(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    d: float = 0.4,
    threshold: float = 1e-4,
    max_window: int = 48,
    partition_by: Sequence[str] = (),
    block_rows: int = 200_000,
) -> DataFrame:
    """``<column>_fracdiff``: weighted sum of the row and its predecessors, null while history is short or holds a null.

    Without ``partition_by`` the order runs over the whole table, cut into blocks that carry the
    needed history along.
    """
    weights = fractional_weights(d, threshold, max_window)

    def build(window):
        out = {}
        for c in columns:
            terms = [F.lit(w) * (num(c) if k == 0 else F.lag(num(c), k).over(window)) for k, w in enumerate(weights)]
            out[f"{c}_fracdiff"] = sum(terms[1:], terms[0])
        return out

    if partition_by:
        return group_moving(df, partition_by, order, len(weights), build)
    return moving(df, order, len(weights), build, block_rows)


def lag_features(
    df: DataFrame, target: str, series: Sequence[str], order: Sequence[str], lags: int, seasonality: int = 0
) -> tuple[DataFrame, list[str]]:
    """Lags 1..L, mean of the three previous values and a seasonal lag per series; incomplete rows dropped."""
    names = [f"{target}_lag_{k}" for k in range(1, max(lags, 1) + 1)] + [f"{target}_rolling_mean_3"]
    if seasonality > 1:
        names.append(f"{target}_seasonal_lag_{seasonality}")

    def build(window):
        out = {f"{target}_lag_{k}": F.lag(num(target), k).over(window) for k in range(1, max(lags, 1) + 1)}
        previous = window.rowsBetween(-3, -1)
        out[f"{target}_rolling_mean_3"] = F.when(F.count(num(target)).over(previous) == 3, F.avg(num(target)).over(previous))
        if seasonality > 1:
            out[f"{target}_seasonal_lag_{seasonality}"] = F.lag(num(target), seasonality).over(window)
        return out

    width = max(lags, seasonality, 3) + 1
    return group_moving(df, series, order, width, build).dropna(subset=[*names, target]), names


def yeo_johnson(x: Column, lam: float | Column) -> Column:
    """Yeo-Johnson transform; ``lam`` may be a column."""
    k = F.lit(lam) if isinstance(lam, float) else lam
    up = F.when(F.abs(k) < 1e-9, F.log1p(x)).otherwise((F.pow(x + 1, k) - 1) / k)
    down = F.when(F.abs(k - 2) < 1e-9, -F.log1p(-x)).otherwise(-(F.pow(1 - x, 2 - k) - 1) / (2 - k))
    return F.when(x >= 0, up).when(x < 0, down)


def box_cox(x: Column, lam: float | Column) -> Column:
    k = F.lit(lam) if isinstance(lam, float) else lam
    return F.when(F.abs(k) < 1e-9, F.log(x)).otherwise((F.pow(x, k) - 1) / k)


#: Values that are transformed at once, so that a grid's working arrays stay in the processor's cache.
POWER_ROWS = 8192


def _powers(u: np.ndarray, exponents: Sequence[float]) -> dict[int, np.ndarray]:
    """``exp(k * u)`` for evenly spaced exponents: from the middle one outwards, each step is one product."""
    middle, h = len(exponents) // 2, (exponents[-1] - exponents[0]) / max(len(exponents) - 1, 1)
    out = {middle: np.exp(exponents[middle] * u)}
    up, down = np.exp(h * u), np.exp(-h * u)
    for i in range(middle + 1, len(exponents)):
        out[i] = out[i - 1] * up
    for i in range(middle - 1, -1, -1):
        out[i] = out[i + 1] * down
    return out


def _scaled_powers(u: np.ndarray, exponents: Sequence[float]) -> Iterator[np.ndarray]:
    """``(exp(k * u) - 1) / k`` in the exponents' order; ``u`` itself where k is 0."""
    found = _powers(u, exponents)
    for i, k in enumerate(exponents):
        yield u if abs(k) < 1e-9 else (found[i] - 1) / k


def _transformed(x: np.ndarray, grid: Sequence[float], method: str) -> Iterator[np.ndarray]:
    """``x`` under each lambda of an evenly spaced grid, as ``yeo_johnson`` and ``box_cox`` have it."""
    if method == "yeo_johnson":
        below = x < 0
        if not below.any():
            yield from _scaled_powers(np.log1p(x), grid)
            return
        out = np.empty_like(x)
        for up, down in zip(_scaled_powers(np.log1p(x[~below]), grid), _scaled_powers(np.log1p(-x[below]), [2 - k for k in grid])):
            out[~below], out[below] = up, -down
            yield out
    elif x.min(initial=1.0) > 0:
        yield from _scaled_powers(np.log(x), grid)
    else:
        for k in grid:
            yield np.log(x[x > 0]) if abs(k) < 1e-9 else (np.power(x, k) - 1) / k


def _joined(a: tuple, b: tuple) -> tuple:
    """Count, mean and squared deviations of two parts as one."""
    (na, ma, sa), (nb, mb, sb) = a, b
    n = na + nb
    d = mb - ma
    share = nb / np.maximum(n, 1.0)
    return n, np.where(na == 0, mb, np.where(nb == 0, ma, ma + d * share)), np.where(na == 0, sb, np.where(nb == 0, sa, sa + sb + d * d * na * share))


def _grid_moments(x: np.ndarray, grid: Sequence[float], method: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and squared deviations of ``x`` under each lambda of the grid."""
    n, mean, square = (np.zeros(len(grid)) for _ in range(3))
    for i, t in enumerate(_transformed(x, grid, method)):
        if len(t):
            n[i], mean[i] = len(t), t.mean()
            d = t - mean[i]
            square[i] = d @ d
    return n, mean, square


def power_lambdas(
    df: DataFrame, columns: Sequence[str], method: str = "yeo_johnson", steps: int = 21, refinements: int = 4
) -> dict[str, float]:
    """Maximum-likelihood lambda per column: a grid for all columns in one pass, then finer grids around the best.

    A task returns one row per column with the moments of its values under the whole grid.
    """
    columns = list(columns)
    numbers = df.select(*[num(c).alias(f"x{i}") for i, c in enumerate(columns)])
    spans = {c: (-3.0, 5.0) for c in columns}
    best = {c: 1.0 for c in columns}
    for _ in range(refinements):
        grids = {c: [low + (high - low) * i / (steps - 1) for i in range(steps)] for c, (low, high) in spans.items()}
        of = list(grids.values())

        def sums(batches: Iterator[pa.RecordBatch], of: list[list[float]] = of) -> Iterator[pa.RecordBatch]:
            nothing = tuple(np.zeros(steps) for _ in range(3))
            count, slope, moments = [0] * len(of), [0.0] * len(of), [nothing] * len(of)
            with np.errstate(all="ignore"):
                for batch in batches:
                    for c, grid in enumerate(of):
                        values = batch.column(c).drop_null().to_numpy()
                        for start in range(0, len(values), POWER_ROWS):
                            x = values[start : start + POWER_ROWS]
                            count[c] += len(x)
                            slope[c] += float((np.sign(x) * np.log1p(np.abs(x))).sum() if method == "yeo_johnson" else np.log(x[x > 0]).sum())
                            moments[c] = _joined(moments[c], _grid_moments(x, grid, method))
            rows = [(c, count[c], slope[c], *[m.tolist() for m in moments[c]]) for c in range(len(of)) if count[c]]
            names = ("place", "n", "j", "rows", "mean", "square")
            yield pa.RecordBatch.from_pydict({name: [r[i] for r in rows] for i, name in enumerate(names)}, schema=_GRID_ROWS)

        found: dict[str, list] = {}
        for r in numbers.mapInArrow(sums, "place int, n bigint, j double, rows array<double>, mean array<double>, square array<double>").collect():
            part = [r["n"], r["j"], tuple(np.array(r[name]) for name in ("rows", "mean", "square"))]
            whole = found.setdefault(columns[r["place"]], [0, 0.0, tuple(np.zeros(steps) for _ in range(3))])
            with np.errstate(all="ignore"):
                whole[:] = whole[0] + part[0], whole[1] + part[1], _joined(whole[2], part[2])
        for c, (n, j, (rows, _, square)) in found.items():
            per: dict[float, float] = {}
            for k, m, s in zip(grids[c], rows, square):
                v = float(s / m) if m else math.nan
                if 0 < v < math.inf:
                    per[k] = -n / 2 * math.log(v) + (k - 1) * j
            if per:
                best[c] = max(per, key=per.get)
                step = (spans[c][1] - spans[c][0]) / (steps - 1)
                spans[c] = (best[c] - step, best[c] + step)
    return best


def power_lambda(df: DataFrame, column: str, method: str = "yeo_johnson") -> float:
    return power_lambdas(df, [column], method)[column]


def compare_power_transforms(df: DataFrame, column: str) -> DataFrame:
    """Original, Yeo-Johnson and (for positive data) Box-Cox by remaining skewness; one row each."""
    x = num(column)
    options: list[tuple[str, float | None, Column]] = [("original", None, x)]
    lam = power_lambda(df, column)
    options.append(("yeo_johnson", lam, yeo_johnson(x, lam)))
    if (df.agg(F.min(x)).first()[0] or 0) > 0:
        lam = power_lambda(df, column, "box_cox")
        options.append(("box_cox", lam, box_cox(x, lam)))
    names = [n for n, _, _ in options]
    # Each transform is evaluated once per row and then read by its name.
    df = df.select(*[e.alias(n) for n, _, e in options])
    options = [(n, v, F.col(n)) for n, v, _ in options]
    wide = df.agg(
        *[F.lit(v).cast("double").alias(f"lambda__{i}") for i, (_, v, _) in enumerate(options)],
        *[rnd(F.abs(corrected_skewness(e)), 4).alias(f"abs_skewness__{i}") for i, (_, _, e) in enumerate(options)],
        *[rnd(F.abs(corrected_kurtosis(e)), 4).alias(f"abs_kurtosis__{i}") for i, (_, _, e) in enumerate(options)],
        *[rnd(F.stddev_samp(e), 4).alias(f"std__{i}") for i, (_, _, e) in enumerate(options)],
    )
    return rows_of(wide, names, ["lambda", "abs_skewness", "abs_kurtosis", "std"]).withColumnRenamed(
        "column_name", "transform"
    ).orderBy("abs_skewness", "abs_kurtosis")


def spline_basis(
    df: DataFrame, columns: Sequence[str], knots: int = 5, fit_on: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Cubic truncated-power columns on standardised values, inner knots at quantiles."""
    source = fit_on if fit_on is not None else df
    q = quantiles(source, columns, [i / (knots - 1) for i in range(knots)])
    stats = source.agg(*[F.avg(num(c)).alias(f"m{i}") for i, c in enumerate(columns)],
                   *[F.stddev_pop(num(c)).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    added: dict[str, Column] = {}
    for i, c in enumerate(columns):
        mean, sd = stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 1.0
        z = (num(c) - mean) / sd
        for power in (1, 2, 3):
            added[f"{c}_p{power}"] = F.pow(z, F.lit(float(power)))
        for j, knot in enumerate(distinct_edges(q[c].values())[1:-1]):
            added[f"{c}_k{j}"] = F.pow(F.greatest(z - (knot - mean) / sd, F.lit(0.0)), F.lit(3.0))
    return df.withColumns(added), list(added)


def effective_scaler(algorithm: str, scaler: str) -> str:
    """Distance-based models are always scaled."""
    return "standard" if algorithm == "knn" and scaler == "none" else scaler


def preprocessing_stages(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    imputer: str = "median",
    scaler: str = "standard",
    power: bool = False,
    output: str = "features",
    max_levels: int = MAX_LEVELS,
) -> list:
    """Fitted-on-train stages: impute, optional power transform, scale; one-hot with unseen levels as zeros.

    A categorical column of more than ``max_levels`` levels (counted exactly) raises: each becomes a feature.
    """
    numeric, categorical = list(numeric), list(categorical)
    if categorical:
        levels = train.agg(*[F.count_distinct(F.col(c).cast("string")).alias(c) for c in categorical]).first()
        wide = [c for c in categorical if levels[c] > max_levels]
        if wide:
            raise ValueError(f"too many levels for one-hot columns: {wide}; use category_codes")
    fills = fill_values(train, numeric, categorical, "mean" if imputer == "mean" else "median")
    lambdas = power_lambdas(train, numeric) if power and numeric else {}

    def sql_number(c: str) -> str:
        value = f"coalesce(try_cast(`{c}` as double), {float(fills.get(c, 0.0))!r}D)"
        if not power:
            return value
        lam = lambdas[c]
        up = f"ln(1 + {value})" if abs(lam) < 1e-9 else f"(power(1 + {value}, {lam!r}D) - 1) / {lam!r}D"
        down = f"-ln(1 - {value})" if abs(lam - 2) < 1e-9 else f"-(power(1 - {value}, {2 - lam!r}D) - 1) / {2 - lam!r}D"
        return f"case when {value} >= 0 then {up} else {down} end"

    def sql_text(c: str) -> str:
        escaped = str(fills.get(c, "desconocido")).replace("\\", "\\\\").replace("'", "\\'")
        return f"coalesce(cast(`{c}` as string), '{escaped}')"

    columns = [f"{sql_number(c)} as `_n_{c}`" for c in numeric] + [f"{sql_text(c)} as `_c_{c}`" for c in categorical]
    stages: list = [SQLTransformer(statement=f"select *, {', '.join(columns)} from __THIS__")]
    parts = []
    if numeric:
        stages.append(VectorAssembler(inputCols=[f"_n_{c}" for c in numeric], outputCol="_numbers"))
        if scaler == "standard":
            stages.append(StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True))
        elif scaler == "robust":
            stages.append(RobustScaler(inputCol="_numbers", outputCol="_scaled", withCentering=True, relativeError=0.0001))
        elif scaler != "none":
            raise ValueError("scaler must be standard, robust or none")
        parts.append("_numbers" if scaler == "none" else "_scaled")
    if categorical:
        indexed = [f"_i_{c}" for c in categorical]
        stages.append(StringIndexer(inputCols=[f"_c_{c}" for c in categorical], outputCols=indexed,
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=[f"_h_{c}" for c in categorical], handleInvalid="keep"))
        parts += [f"_h_{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol=output))
    return stages


def feature_pipeline(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], **options) -> Pipeline:
    return Pipeline(stages=preprocessing_stages(train, numeric, categorical, **options))


def etl(df: DataFrame, outlier_columns: Sequence[str], method: str = "clip_iqr") -> tuple[DataFrame, DataFrame]:
    """Full-row duplicates removed, then outliers treated."""
    return handle_outliers(materialize(df.dropDuplicates(), "etl"), outlier_columns, method)
