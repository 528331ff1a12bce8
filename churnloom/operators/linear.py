"""Least squares, collinearity and residual diagnostics from one-pass cross-products.

The data is only ever aggregated: k x k matrices come back to the driver, coefficients go out again
as column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dist
from ..functions.scalar import count_rows, num, rnd, text_columns
from ..session import materialize
from .clean import dummies
from .ordered import moving, positions, with_average_ranks
from .quality import zero_variance_columns
from .quantiles import quantiles


@dataclass(frozen=True)
class Gram:
    """Centred cross-products: n, means, X'X and X'y about the means, and y'y."""

    names: list[str]
    n: int
    mean: np.ndarray
    xx: np.ndarray
    y_mean: float
    xy: np.ndarray
    yy: float


def gram(df: DataFrame, names: Sequence[str], y: Column | None = None, where: Column | None = None) -> Gram:
    """All second moments of the columns (and y) over complete rows, in two aggregations."""
    columns = [num(c) for c in names]
    target = y if y is not None else F.lit(0.0)
    keep = target.isNotNull()
    for c in columns:
        keep = keep & c.isNotNull()
    rows = df.where(keep if where is None else keep & where)
    first = rows.agg(
        count_rows().alias("n"), F.avg(target).alias("my"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
    ).first()
    k = len(columns)
    n = first["n"]
    if n == 0:
        raise ValueError("no complete rows")
    mean = np.array([first[f"m{i}"] for i in range(k)])
    centred = [c - float(m) for c, m in zip(columns, mean)]
    dy = target - float(first["my"])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    second = rows.agg(
        *[F.sum(centred[i] * centred[j]).alias(f"s{i}_{j}") for i, j in pairs],
        *[F.sum(centred[i] * dy).alias(f"y{i}") for i in range(k)], F.sum(dy * dy).alias("yy"),
    ).first()
    xx = np.zeros((k, k))
    for i, j in pairs:
        xx[i, j] = xx[j, i] = second[f"s{i}_{j}"]
    return Gram(list(names), n, mean, xx, first["my"], np.array([second[f"y{i}"] for i in range(k)]), second["yy"])


@dataclass(frozen=True)
class Fit:
    """Least squares with an intercept; ``inverse`` is of the centred X'X."""

    gram: Gram
    slopes: np.ndarray
    intercept: float
    inverse: np.ndarray

    @property
    def sse(self) -> float:
        return max(float(self.gram.yy - self.slopes @ self.gram.xy), 0.0)

    @property
    def r2(self) -> float:
        return 1 - self.sse / self.gram.yy if self.gram.yy > 0 else float("nan")

    def predicted(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, b in zip(self.gram.names, self.slopes):
            out = out + num(c) * float(b)
        return out

    def leverage(self) -> Column:
        out = F.lit(1.0 / self.gram.n)
        d = [num(c) - float(m) for c, m in zip(self.gram.names, self.gram.mean)]
        for i in range(len(d)):
            for j in range(len(d)):
                out = out + d[i] * d[j] * float(self.inverse[i, j])
        return out


def fit(df: DataFrame, names: Sequence[str], y: Column, where: Column | None = None) -> Fit:
    g = gram(df, names, y, where)
    scale = np.sqrt(np.clip(np.diag(g.xx), 1e-300, None))
    inverse = np.linalg.pinv(g.xx / np.outer(scale, scale), rcond=1e-12, hermitian=True) / np.outer(scale, scale)
    slopes = inverse @ g.xy
    return Fit(g, slopes, float(g.y_mean - slopes @ g.mean), inverse)


def correlation_of(g: Gram) -> np.ndarray:
    s = np.sqrt(np.diag(g.xx))
    return g.xx / np.outer(s, s)


SINGULAR = 1e-10


def _vif(r: np.ndarray) -> np.ndarray:
    """Diagonal of the inverse correlation matrix; columns that others explain fully get infinity."""
    if len(r) < 2 or np.linalg.eigvalsh(r)[0] > SINGULAR:
        return np.diag(np.linalg.inv(r))
    out = []
    for i in range(len(r)):
        rest = [j for j in range(len(r)) if j != i]
        r2 = float(r[i, rest] @ np.linalg.pinv(r[np.ix_(rest, rest)], rcond=SINGULAR, hermitian=True) @ r[rest, i])
        out.append(float("inf") if r2 >= 1 - SINGULAR else 1 / (1 - r2))
    return np.array(out)


def vif_band(v: float) -> str:
    return "severa" if v >= 10 else "relevante" if v >= 5 else "manejable"


def _belsley(r: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Singular values of the standardised design, condition indices and variance shares, from R alone."""
    values, vectors = np.linalg.eigh(r)
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0, None) * n, vectors[:, order]
    singular = np.sqrt(values)
    index = np.where(singular <= 1e-12, np.inf, singular[0] / np.where(singular <= 1e-12, 1, singular))
    raw = vectors**2 / np.where(values <= 1e-12, np.nan, values)
    total = np.nansum(raw, axis=1, keepdims=True)
    return singular, index, np.nan_to_num(raw / np.where(total > 0, total, 1))


def _critical(index: np.ndarray, shares: np.ndarray, names: list[str], limit: float = 30.0, part: float = 0.5) -> list[tuple]:
    out = []
    for c in range(len(index)):
        involved = [i for i in range(len(names)) if shares[i, c] >= part]
        if index[c] >= limit and len(involved) >= 2:
            out.append((c + 1, round(float(index[c]), 4), ", ".join(names[i] for i in involved), round(float(max(shares[i, c] for i in involved)), 4)))
    return out


def collinearity(df: DataFrame, columns: Sequence[str], threshold: float = 5.0) -> dict[str, DataFrame | list[str]]:
    """VIF, condition indices, variance shares and the columns kept after dropping the worst one by one.

    Everything after the one correlation matrix is small arithmetic.
    """
    spark = df.sparkSession
    constant = set(zero_variance_columns(df, columns))
    names = [c for c in columns if c not in constant]
    if len(names) < 2:
        raise ValueError("at least two varying numeric columns are needed")
    g = gram(df, names)
    r = correlation_of(g)
    v = _vif(r)
    singular, index, shares = _belsley(r, g.n)
    report = [(c, round(float(x), 4), vif_band(x)) for c, x in zip(names, v)]
    components = [(i + 1, round(float(s), 6), round(float(s * s), 6), round(float(k), 4)) for i, (s, k) in enumerate(zip(singular, index))]
    parts = [(i + 1, names[j], round(float(shares[j, i]), 4)) for i in range(len(index)) for j in range(len(names))]
    left, steps = list(range(len(names))), []
    while len(left) >= 2:
        sub = r[np.ix_(left, left)]
        now = _vif(sub)
        _, sub_index, sub_shares = _belsley(sub, g.n)
        if max(now) < threshold and not _critical(sub_index, sub_shares, [names[i] for i in left]):
            break
        worst = int(np.argmax(now))
        steps.append((len(steps) + 1, names[left[worst]], round(float(now[worst]), 4), round(float(max(sub_index)), 4)))
        left.pop(worst)
    return {
        "vif": spark.createDataFrame(report, "column_name string, vif double, band string").orderBy(F.desc("vif"), "column_name"),
        "components": spark.createDataFrame(components, "component int, singular_value double, eigenvalue double, condition_index double"),
        "variance_shares": spark.createDataFrame(parts, "component int, column_name string, variance_share double"),
        "critical": spark.createDataFrame(_critical(index, shares, names), "component int, condition_index double, columns string, max_share double"),
        "mitigation": spark.createDataFrame(steps, "step int, dropped string, vif double, condition_index double"),
        "kept": [names[i] for i in left],
    }


def complete_design(df: DataFrame, target: str, features: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Complete rows with text features as dummies (first level dropped), target as ``_y``."""
    text = [c for c in features if c in text_columns(df)]
    numbers = [c for c in features if c not in text]
    rows = df.select(num(target).alias("_y"), *[num(c).alias(c) for c in numbers], *text, *[c for c in keep if c not in features]).dropna()
    if text:
        rows, added = dummies(rows, text)
        return rows, numbers + added
    return rows, numbers


@dataclass(frozen=True)
class OlsResult:
    coefficients: DataFrame
    fit_stats: DataFrame
    residuals: DataFrame
    fit: Fit
    names: list[str]


def ols(df: DataFrame, target: str, features: Sequence[str], covariance: str = "HC3", keep: Sequence[str] = ()) -> OlsResult:
    """OLS with heteroscedasticity-robust errors; residuals keep ``keep`` columns, leverage and Cook's distance."""
    data, names = complete_design(df, target, features, keep)
    data = materialize(data, "design")
    f = fit(data, names, F.col("_y"))
    n, k = f.gram.n, len(names) + 1
    e, h = F.col("residual"), F.col("leverage")
    s2 = f.sse / max(n - k, 1)
    rows = data.withColumns({"fitted": f.predicted(), "leverage": f.leverage()}).withColumn("residual", F.col("_y") - F.col("fitted"))
    rows = rows.withColumns(
        {
            "standard_residual": e / F.sqrt(F.lit(s2) * (1 - h)),
            "cooks_distance": e * e * h / (F.lit(s2 * k) * (1 - h) * (1 - h)),
        }
    )
    weight = {"HC0": e * e, "HC1": e * e * (n / max(n - k, 1)), "HC2": e * e / (1 - h), "HC3": e * e / ((1 - h) * (1 - h))}[covariance]
    # Meat of the sandwich in centred coordinates, intercept first.
    d = [F.lit(1.0), *[num(c) - float(m) for c, m in zip(names, f.gram.mean)]]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    one = rows.agg(*[F.sum(weight * d[i] * d[j]).alias(f"m{i}_{j}") for i, j in pairs]).first()
    meat = np.zeros((k, k))
    for i, j in pairs:
        meat[i, j] = meat[j, i] = one[f"m{i}_{j}"]
    bread = np.zeros((k, k))
    bread[0, 0] = 1.0 / n
    bread[1:, 1:] = f.inverse
    cov = bread @ meat @ bread
    shift = np.eye(k)
    shift[0, 1:] = -f.gram.mean
    cov = shift @ cov @ shift.T
    error = np.sqrt(np.clip(np.diag(cov), 0, None))
    beta = np.concatenate([[f.intercept], f.slopes])
    table = []
    for name, b, s in zip(["const", *names], beta, error):
        p = dist.normal_two_sided(b / s) if s > 0 else float("nan")
        table.append((name, round(float(b), 4), round(float(s), 4), round(p, 4), round(float(b - 1.959963984540054 * s), 4), round(float(b + 1.959963984540054 * s), 4)))
    spark = df.sparkSession
    adjusted = 1 - (1 - f.r2) * (n - 1) / max(n - k, 1)
    influence = rows.agg(F.max("cooks_distance").alias("c"), F.avg((F.col("cooks_distance") > 4.0 / n).cast("double")).alias("p")).first()
    stats = [(n, len(names), round(f.r2, 4), round(adjusted, 4), round(influence["c"], 4), round(influence["p"] * 100, 2))]
    return OlsResult(
        spark.createDataFrame(table, "term string, coef double, std_error double, p_value double, ci_low double, ci_high double"),
        spark.createDataFrame(stats, "rows bigint, predictors int, r2 double, adjusted_r2 double, max_cooks_distance double, pct_influential double"),
        rows, f, names,
    )


def durbin_watson(rows: DataFrame, residual: str, order: Sequence[str]) -> DataFrame:
    """Durbin-Watson over the given row order (which must identify rows)."""
    steps = moving(rows.select(residual, *order), order, 2, lambda w: {"_step": F.col(residual) - F.lag(residual).over(w)})
    e = F.col(residual)
    return steps.agg(rnd(F.sum(F.col("_step") * F.col("_step")) / F.sum(e * e), 4).alias("durbin_watson"), count_rows().alias("rows"))


def breusch_pagan(result: OlsResult) -> tuple[float, float, int]:
    """Koenker's n R2 of the squared residuals on the predictors: statistic, p-value, degrees of freedom."""
    g = fit(result.residuals, result.names, F.col("residual") * F.col("residual"))
    k = int(np.linalg.matrix_rank(g.gram.xx))
    lm = g.gram.n * g.r2
    return lm, dist.chi2_sf(lm, k), k


def white(result: OlsResult) -> tuple[float, float, int]:
    """n R2 of the squared residuals on predictors, their squares and products (redundant columns dropped by rank)."""
    names = result.names
    z = {c: (num(c) - float(m)) for c, m in zip(names, result.fit.gram.mean)}
    products = {f"_q{i}_{j}": z[names[i]] * z[names[j]] for i in range(len(names)) for j in range(i, len(names))}
    rows = result.residuals.withColumns(products)
    g = fit(rows, [*names, *products], F.col("residual") * F.col("residual"))
    scale = np.sqrt(np.clip(np.diag(g.gram.xx), 1e-300, None))
    k = int(np.linalg.matrix_rank(g.gram.xx / np.outer(scale, scale), tol=1e-9))
    lm = g.gram.n * g.r2
    return lm, dist.chi2_sf(lm, k), k


def goldfeld_quandt(result: OlsResult, drop: float = 0.2) -> tuple[str, float, float]:
    """Residual variance above against below the middle of the predictor most tied to |residual|."""
    base = materialize(result.residuals.select(*result.names, "_y", F.abs("residual").alias("_abs")), "gq")
    ranked = with_average_ranks(base, {"_abs": "_re", **{c: f"_r{i}" for i, c in enumerate(result.names)}})
    found = ranked.agg(*[F.corr(f"_r{i}", "_re").alias(f"s{i}") for i in range(len(result.names))]).first()
    strength = {c: abs(v) if v is not None and np.isfinite(v) else 0.0 for c, v in zip(result.names, found)}
    by = max(strength, key=strength.get)
    n = result.fit.gram.n
    if n <= max(40, 6 * (len(result.names) + 1)):
        return by, float("nan"), float("nan")
    cut = min(max(int(n * drop), 1), max(n - 2 * (len(result.names) + 5), 0))
    half = (n - cut) // 2
    # Rows that agree in all of these are interchangeable, so the cut does not depend on chance.
    placed = positions(base, [by, "_y", *[c for c in result.names if c != by]])
    a, b = (fit(placed, result.names, F.col("_y"), where) for where in (F.col("position") < half, F.col("position") >= half + cut))
    k = len(result.names) + 1
    da, db = a.gram.n - k, b.gram.n - k
    if da <= 0 or db <= 0 or a.sse <= 0:
        return by, float("nan"), float("nan")
    ratio = (b.sse / db) / (a.sse / da)
    tail = dist.f_sf(ratio, db, da)
    return by, ratio, 2 * min(tail, 1 - tail)


def dispersion_audit(result: OlsResult, alpha: float = 0.05, group: str | None = None) -> dict[str, DataFrame]:
    """Heteroscedasticity tests, spread of |residual| across the fit, and the four-way verdict."""
    from .stat_tests import variance_homogeneity

    spark = result.coefficients.sparkSession
    tests = []
    lm, p, _ = breusch_pagan(result)
    tests.append(("breusch_pagan", lm, p, p < alpha))
    lm, p, _ = white(result)
    tests.append(("white", lm, p, p < alpha))
    by, ratio, p = goldfeld_quandt(result)
    tests.append(("goldfeld_quandt", ratio, p, bool(p < alpha)))
    absolute = result.residuals.select("fitted", F.abs("residual").alias("abs_residual"), *([group] if group else []))
    if group:
        row = variance_homogeneity(absolute, "abs_residual", group).first()
        tests.append(("brown_forsythe", row["statistic"], row["p_value"], row["p_value"] < alpha))
    slim = materialize(absolute, "dispersion")
    q = quantiles(slim, ["fitted"], [0.25, 0.75])["fitted"]
    low = quantiles(slim.where(F.col("fitted") <= q[0.25]), ["abs_residual"], [0.5])["abs_residual"][0.5]
    high = quantiles(slim.where(F.col("fitted") >= q[0.75]), ["abs_residual"], [0.5])["abs_residual"][0.5]
    spread = high / max(low, 1e-8) if low is not None and high is not None else None
    rho = with_average_ranks(slim, {"fitted": "_a", "abs_residual": "_b"}).agg(F.corr("_a", "_b")).first()[0]
    rejected = sum(bool(t[3]) for t in tests)
    visual = (spread is not None and spread >= 1.25) or (rho is not None and abs(rho) >= 0.2)
    # The four verdict texts and their relevance.
    if rejected == 0 and not visual:
        verdict, relevance = "sin evidencia relevante de heterocedasticidad", "baja"
    elif rejected >= 2 and visual:
        verdict, relevance = "evidencia consistente de heterocedasticidad", "alta" if spread and spread >= 1.5 else "media"
    elif rejected >= 1 and not visual:
        verdict, relevance = "senal estadistica leve con relevancia practica baja", "baja"
    else:
        verdict, relevance = "seguimiento por dispersion potencial", "media"
    return {
        "tests": spark.createDataFrame(
            [(t, round(s, 4), round(p, 4), bool(r)) for t, s, p, r in tests], "test string, statistic double, p_value double, rejects boolean"
        ),
        "summary": spark.createDataFrame(
            [(rejected, None if spread is None else round(spread, 4), None if rho is None else round(rho, 4), by, verdict, relevance)],
            "rejected int, spread_ratio double, spearman_abs_residual double, order_feature string, verdict string, relevance string",
        ),
    }


def influence_report(result: OlsResult, top: int = 20) -> DataFrame:
    """The rows with the largest Cook's distance; ties go by the kept columns, then by the predictors."""
    made = ("_y", "fitted", "leverage", "residual", "standard_residual", "cooks_distance")
    kept = [c for c in result.residuals.columns if c not in made and c not in result.names]
    return result.residuals.orderBy(F.desc("cooks_distance"), *kept, "_y", *result.names).limit(top)


def linear_contributions(df: DataFrame, coefficients: dict[str, float], means: dict[str, float]) -> DataFrame:
    """Exact additive contributions of a linear model: ``contribution_<column> = coef * (x - mean)``."""
    return df.withColumns({f"contribution_{c}": F.lit(float(b)) * (num(c) - float(means[c])) for c, b in coefficients.items()})

