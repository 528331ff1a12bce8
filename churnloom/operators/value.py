"""Customer value from purchase history: RFM-T summaries, shrinkage CLV, BG/NBD with Gamma-Gamma."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip, count_rows, num, rnd, safe_div, sigmoid
from ..session import materialize
from .quantiles import quantiles

MIN_VALUE = 18.0
DAYS_PER_MONTH = 30.0


def rfmt_summary(transactions: DataFrame, customer: str, date: str, amount: str, cutoff: Column) -> DataFrame:
    """Repeat purchases, recency, observed age T (days) and mean amount per customer, up to the cutoff."""
    day = F.to_date(F.col(date))
    seen = transactions.where(day <= cutoff)
    return seen.groupBy(F.col(customer).alias("customer_id")).agg(
        (count_rows() - 1).alias("frequency"),
        F.datediff(F.max(day), F.min(day)).cast("bigint").alias("recency"),
        F.datediff(cutoff, F.min(day)).cast("bigint").alias("age"),
        F.datediff(cutoff, F.max(day)).cast("bigint").alias("days_since_last"),
        F.avg(num(amount)).alias("monetary"),
    )


def _filled(frequency: str, recency: str, age: str, monetary: str) -> tuple[Column, ...]:
    return tuple(F.coalesce(num(c), F.lit(0.0)) for c in (frequency, recency, age, monetary))


def _checks(f: Column, r: Column, t: Column, m: Column) -> dict[str, Column]:
    return {
        "age_positive": t <= 0,
        "frequency_not_negative": f < 0,
        "recency_inside_age": (r < 0) | (r > t),
        "repeaters_have_value": (f > 0) & (m <= 0),
    }


def rfmt_structure_audit(
    df: DataFrame, frequency: str = "frequency", recency: str = "recency", age: str = "age", monetary: str = "monetary"
) -> DataFrame:
    """Share of rows that break each RFM-T rule, as (check, pct_invalid, invalid_rows)."""
    checks = _checks(*_filled(frequency, recency, age, monetary))
    wide = df.agg(
        count_rows().alias("n"), *[F.count_if(c).alias(k) for k, c in checks.items()]
    )
    cells = [
        F.struct(F.lit(k).alias("check"), rnd(F.col(k) / F.col("n") * 100, 4).alias("pct_invalid"), F.col(k).alias("invalid_rows"))
        for k in checks
    ]
    return wide.select(F.inline(F.array(*cells)))


def value_independence(
    df: DataFrame, frequency: str = "frequency", recency: str = "recency", age: str = "age", monetary: str = "monetary"
) -> DataFrame:
    """Correlation of frequency and value among valid repeaters; up to 0.30 supports Gamma-Gamma."""
    f, r, t, m = _filled(frequency, recency, age, monetary)
    valid = (f > 0) & (r >= 0) & (r <= t) & (t > 0) & (m > 0)
    one = df.where(valid).agg(count_rows().alias("repeaters"), F.corr(f, m).alias("r"))
    return one.select("repeaters", rnd(F.col("r"), 4).alias("pearson_r"), (F.abs("r") <= 0.30).alias("is_independent"))


def typical_value(df: DataFrame, frequency: str, recency: str, age: str, monetary: str) -> float:
    """Median value of valid repeaters (of everyone when there are none), at least 18."""
    f, r, t, m = _filled(frequency, recency, age, monetary)
    repeaters = df.where((f > 0) & (r >= 0) & (r <= t) & (t > 0) & (m > 0)).select(m.alias("m"))
    middle = quantiles(repeaters, ["m"], [0.5])["m"][0.5]
    if middle is None:
        middle = quantiles(df.select(m.alias("m")), ["m"], [0.5])["m"][0.5]
    return max(middle or 0.0, MIN_VALUE)


def shrunk_value(f: Column, m: Column, typical: float) -> Column:
    return F.when(f > 0, (f * m + 3.0 * typical) / (f + 3.0)).otherwise(F.lit(typical * 0.85))


def clv_shrinkage(
    df: DataFrame,
    horizons: Sequence[int] = (6, 12),
    frequency: str = "frequency",
    recency: str = "recency",
    age: str = "age",
    monetary: str = "monetary",
    monthly_discount: float = 0.01,
) -> DataFrame:
    """Probability of being active, expected transactions and discounted value per horizon in months."""
    f, r, t, m = _filled(frequency, recency, age, monetary)
    typical = typical_value(df, frequency, recency, age, monetary)
    ratio = F.coalesce(safe_div(r, F.when(t > 0, t)), F.lit(0.0))
    alive = clip(sigmoid(F.lit(-1.35) + 2.85 * ratio + 0.55 * F.log1p(f)), 0.03, 0.995)
    rate = F.coalesce(safe_div(f + 1.0, F.when(t > 0, t)), F.lit(0.0))
    return _with_clv(df, horizons, alive, shrunk_value(f, m, typical),
                     lambda h: F.greatest(alive * rate * (h * DAYS_PER_MONTH) * ((f + 1.0) / (f + 3.5)), F.lit(0.0)),
                     monthly_discount, "shrinkage")


def _with_clv(df, horizons, alive, value, transactions, monthly_discount, engine) -> DataFrame:
    wanted = sorted({int(h) for h in horizons if int(h) > 0})
    if not wanted:
        raise ValueError("at least one positive horizon is needed")
    out = df.withColumns({"_alive": alive, "_value": value, **{f"_tx_{h}": transactions(h) for h in wanted}})
    added = {}
    for h in wanted:
        added[f"expected_transactions_{h}m"] = rnd(F.col(f"_tx_{h}"), 4)
        added[f"clv_{h}m"] = rnd(F.col(f"_tx_{h}") * F.col("_value") / F.lit((1.0 + monthly_discount) ** h), 2)
    added["p_alive"] = rnd(clip(F.col("_alive"), 0.03, 0.995), 4)
    added["expected_value"] = rnd(F.col("_value"), 2)
    added["clv_engine"] = F.lit(engine)
    return out.withColumns(added).drop("_alive", "_value", *[f"_tx_{h}" for h in wanted])


def clv_heuristic(monetary: Column, frequency: Column, horizon_months: int) -> Column:
    return monetary * frequency * (horizon_months / 12.0)


def clv_summary(df: DataFrame, horizon: int) -> DataFrame:
    return df.agg(
        F.max("clv_engine").alias("engine"), count_rows().alias("customers"),
        rnd(F.avg("p_alive"), 4).alias("mean_p_alive"), rnd(F.avg(f"clv_{horizon}m"), 2).alias("mean_clv"),
        rnd(F.avg("expected_value"), 2).alias("mean_expected_value"),
    )


def relative_gap(clv: Column, model_value: Column) -> Column:
    """(clv - model) / |model| where the model value passes 1 in size, else null."""
    return F.when(F.abs(model_value) > 1.0, rnd((clv - model_value) / F.abs(model_value), 4))


# --- BG/NBD and Gamma-Gamma -----------------------------------------------------------------------
#
# Log-likelihoods as one distributed sum per step (Fader, Hardie and Lee 2005; Fader and Hardie
# 2013). Equal (frequency, recency, age) triples are counted first, so a step reads the distinct ones.


def _lgamma(x):
    """log Gamma of an array or number above 0: shifted by 6, then Stirling's series (error below 1e-10)."""
    shift = x * (x + 1.0) * (x + 2.0) * (x + 3.0) * (x + 4.0) * (x + 5.0)
    z = x + 6.0
    w = 1.0 / (z * z)
    series = (1.0 / 12.0 + w * (-1.0 / 360.0 + w * (1.0 / 1260.0 - w / 1680.0))) / z
    return (z - 0.5) * np.log(z) - z + series - np.log(shift) + 0.5 * math.log(2 * math.pi)


def _digamma(x):
    """Derivative of log Gamma of an array or number above 0; error below 1e-10."""
    z = x + 6.0
    w = 1.0 / (z * z)
    series = w * (1.0 / 12.0 - w * (1.0 / 120.0 - w * (1.0 / 252.0 - w * (1.0 / 240.0 - w / 132.0))))
    out = np.log(z) - 0.5 / z - series
    for i in range(6):
        out = out - 1.0 / (x + float(i))
    return out


def _trigamma(x):
    """Second derivative of log Gamma of an array or number above 0; error below 1e-9."""
    z = x + 6.0
    w = 1.0 / (z * z)
    out = (1.0 + w * (1.0 / 6.0 - w * (1.0 / 30.0 - w * (1.0 / 42.0 - w * (1.0 / 30.0 - w * 5.0 / 66.0))))) / z + 0.5 * w
    for i in range(6):
        out = out + 1.0 / ((x + float(i)) * (x + float(i)))
    return out


@dataclass(frozen=True)
class Likelihood:
    """What a row adds to a log-likelihood with its first and second derivatives, and the part that rows share.

    ``row`` maps the arrays of ``columns`` and the parameters to ``value``, ``g<i>`` and ``h<i>_<j>`` (j >= i; what is
    missing is zero); ``shared`` gives the same three as number, gradient and matrix.
    """

    columns: tuple[str, ...]
    row: Callable[[Sequence[np.ndarray], np.ndarray], dict[str, np.ndarray]]
    shared: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]]


def bgnbd_likelihood(scale: float = 1.0) -> Likelihood:
    """BG/NBD of frequency, recency and age in units of ``1 / scale``."""

    def row(columns: Sequence[np.ndarray], p: np.ndarray) -> dict[str, np.ndarray]:
        rr, alpha, a, b = p
        f, seen, age = columns[0], columns[1] * scale + alpha, columns[2] * scale + alpha
        n, left = f + rr, np.maximum(f + b - 1.0, 1e-9)
        la, ls, ia, i_s = np.log(age), np.log(seen), 1.0 / age, 1.0 / seen
        d2, t2 = _digamma(f + a + b), _trigamma(f + a + b)
        alive, died = -n * la, np.log(a / left) - n * ls
        # The share of the likelihood that comes from customers who left after their last purchase.
        w = np.where(f > 0, 1.0 / (1.0 + np.exp(np.clip(alive - died, -700, 700))), 0.0)
        v = 1.0 - w
        mix = w * v
        # Differences of the two branches' gradients.
        d = [la - ls, n * (ia - i_s), 1.0 / a, -1.0 / left]
        out = {
            "value": _lgamma(n) + _lgamma(f + b) - _lgamma(f + a + b) + np.where(f > 0, np.logaddexp(alive, died), alive),
            "g0": _digamma(n) - v * la - w * ls, "g1": -n * (v * ia + w * i_s), "g2": w / a - d2, "g3": _digamma(f + b) - d2 - w / left,
        }
        own = {
            (0, 0): _trigamma(n), (0, 1): -(v * ia + w * i_s), (1, 1): n * (v * ia * ia + w * i_s * i_s),
            (2, 2): -w / (a * a) - t2, (2, 3): -t2, (3, 3): w / (left * left) + _trigamma(f + b) - t2,
        }
        for i in range(4):
            for j in range(i, 4):
                out[f"h{i}_{j}"] = mix * d[i] * d[j] + own.get((i, j), 0.0)
        return out

    return Likelihood(("f", "r", "t"), row, _bgnbd_shared)


def _bgnbd_shared(p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    rr, alpha, a, b = map(float, p)
    da, ta = _digamma(a + b), _trigamma(a + b)
    value = -math.lgamma(rr) + rr * math.log(alpha) + math.lgamma(a + b) - math.lgamma(b)
    slope = np.array([math.log(alpha) - _digamma(rr), rr / alpha, da, da - _digamma(b)])
    curve = np.zeros((4, 4))
    curve[0, 0], curve[0, 1], curve[1, 1] = -_trigamma(rr), 1 / alpha, -rr / alpha**2
    curve[2, 2], curve[2, 3], curve[3, 3] = ta, ta, ta - _trigamma(b)
    return value, slope, curve


def gamma_gamma_likelihood(mean: float = 1.0) -> Likelihood:
    """Gamma-Gamma of frequency and average value in units of ``mean``."""

    def row(columns: Sequence[np.ndarray], p: np.ndarray) -> dict[str, np.ndarray]:
        shape, q, v = p
        f, m = columns[0], columns[1] / mean
        pf, both, spent = f * shape, f * shape + q, f * m
        i, out = 1.0 / (spent + v), np.log(spent + v)
        d0, t0, inner = _digamma(both), _trigamma(both), np.log(spent)
        return {
            "value": _lgamma(both) - _lgamma(pf) + pf * inner - np.log(m) - both * out,
            "g0": f * (d0 - _digamma(pf) + inner - out), "g1": d0 - out, "g2": -both * i,
            "h0_0": f * f * (t0 - _trigamma(pf)), "h0_1": f * t0, "h0_2": -f * i, "h1_1": t0, "h1_2": -i, "h2_2": both * i * i,
        }

    return Likelihood(("f", "m"), row, _gamma_gamma_shared)


def _gamma_gamma_shared(p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    _, q, v = map(float, p)
    curve = np.zeros((3, 3))
    curve[1, 1], curve[1, 2], curve[2, 2] = -_trigamma(q), 1 / v, -q / v**2
    return q * math.log(v) - math.lgamma(q), np.array([0.0, math.log(v) - _digamma(q), q / v]), curve


def likelihood_sums(counts: DataFrame, model: Likelihood, p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log-likelihood of the counted rows (``n`` each) at ``p`` with gradient and Hessian, from one pass.

    A task returns one row per sum, whatever its rows.
    """
    k = len(p)
    wanted = ["value", *[f"g{i}" for i in range(k)], *[f"h{i}_{j}" for i in range(k) for j in range(i, k)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted) + 1)
        for batch in batches:
            *columns, n = [batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(batch.num_columns)]
            found = model.row(columns, p)
            total += [n.sum(), *[n @ (found[w] + np.zeros(len(n))) for w in wanted]]
        places = pa.array(np.arange(len(total)), pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array(total, pa.float64())], names=["place", "value"])

    parts = counts.select(*model.columns, "n").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    sums = {r["place"]: r["value"] for r in parts.collect()}
    total = sums[0]
    at = {w: sums[i + 1] / total for i, w in enumerate(wanted)}
    value, slope, curve = model.shared(p)
    for i in range(k):
        slope[i] += at[f"g{i}"]
        for j in range(i, k):
            curve[i, j] += at[f"h{i}_{j}"]
            curve[j, i] = curve[i, j]
    return value + at["value"], slope, curve


def _maximise(counts: DataFrame, start: Sequence[float], model: Likelihood, penalty: float, rounds: int, tolerance: float) -> tuple[list[float], float]:
    """Newton steps on log-parameters with analytic derivatives; one aggregation a step, and a worse step is halved.

    The objective is the mean log-likelihood minus ``penalty`` times the squared parameters.
    """
    x = np.log(np.array(start, dtype=float))
    best, base, step = -math.inf, x, np.zeros(len(x))
    for _ in range(rounds):
        p = np.exp(x)
        value, slope, curve = likelihood_sums(counts, model, p)
        value -= penalty * float(p @ p)
        if not value >= best - 1e-12 and np.abs(step).max() > 1e-9:
            step = step / 2
            x = base + step
            continue
        gained, best, base = value - best, value, x
        g = p * (slope - 2 * penalty * p)
        h = np.outer(p, p) * (curve - 2 * penalty * np.eye(len(p))) + np.diag(g)
        size, turn = np.linalg.eigh(-(h + h.T) / 2)
        step = turn @ ((turn.T @ g) / np.maximum(np.abs(size), 1e-4))
        step *= min(1.0, 2.0 / max(float(np.max(np.abs(step))), 1e-12))
        if gained < tolerance:
            break
        x = np.clip(base + step, -12, 14)
    return [float(v) for v in np.exp(base)], best


def fit_bgnbd(df: DataFrame, frequency="frequency", recency="recency", age="age", monetary="monetary", penalty: float = 0.01, rounds: int = 40, tolerance: float = 1e-6) -> dict[str, float]:
    """r, alpha, a, b of BG/NBD over structurally valid rows. Time is scaled so the longest age is 10."""
    f, r, t, m = _filled(frequency, recency, age, monetary)
    bad = F.lit(False)
    for c in _checks(f, r, t, m).values():
        bad = bad | c
    counts = materialize(
        df.where(~bad).select(f.alias("f"), r.alias("r"), t.alias("t")).groupBy("f", "r", "t").agg(count_rows().alias("n")), "bgnbd"
    )
    scale = 10.0 / counts.agg(F.max("t")).first()[0]
    params, score = _maximise(counts, [1.0, 3.0, 0.5, 2.0], bgnbd_likelihood(scale), penalty, rounds, tolerance)
    return {"r": params[0], "alpha": params[1] / scale, "a": params[2], "b": params[3], "mean_log_likelihood": float(score)}


def fit_gamma_gamma(df: DataFrame, frequency="frequency", recency="recency", age="age", monetary="monetary", penalty: float = 0.01, rounds: int = 40, tolerance: float = 1e-6) -> dict[str, float]:
    """p, q, v of Gamma-Gamma over valid repeaters. Values are scaled by their mean."""
    f, r, t, m = _filled(frequency, recency, age, monetary)
    repeaters = materialize(
        df.where((f > 0) & (m > 0) & (r >= 0) & (r <= t)).select(f.alias("f"), m.alias("m")).groupBy("f", "m").agg(count_rows().alias("n")), "gg"
    )
    mean = repeaters.agg(F.sum(F.col("m") * F.col("n")) / F.sum("n")).first()[0]
    params, score = _maximise(repeaters, [2.0, 3.0, 2.0], gamma_gamma_likelihood(mean), penalty, rounds, tolerance)
    return {"p": params[0], "q": params[1], "v": params[2] * mean, "mean_log_likelihood": float(score)}


def bgnbd_alive(f: Column, r: Column, t: Column, k: dict[str, float]) -> Column:
    odds = (k["a"] / F.greatest(f + (k["b"] - 1.0), F.lit(1e-9))) * F.pow((t + k["alpha"]) / (r + k["alpha"]), f + k["r"])
    return F.when(f > 0, 1.0 / (1.0 + odds)).otherwise(F.lit(1.0))


def bgnbd_expected(f: Column, r: Column, t: Column, days: float, k: dict[str, float], tolerance: float = 1e-13) -> Column:
    """Expected purchases in the next ``days``; the hypergeometric factor by its series after Euler's transform.

    Terms fall at least like z to their number in the end, so each row sums as many as its z needs for the tolerance.
    """
    rr, alpha, a, b = k["r"], k["alpha"], k["a"], k["b"]
    z = F.lit(float(days)) / (alpha + t + float(days))
    upper_a, upper_b, lower = a + b - 1 - rr, a - 1, f + (a + b - 1)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc, i):
        term = acc["term"] * (upper_a + i) * (upper_b + i) / ((lower + i) * (i + 1.0)) * z
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    terms = F.lit(60) + F.ceil(F.log(F.lit(tolerance) * (1.0 - z)) / F.log(z)).cast("int")
    places = F.transform(F.sequence(F.lit(0), terms), lambda i: i.cast("double"))
    series = F.aggregate(places, start, step, lambda acc: acc["total"])
    return lower / (a - 1) * (1.0 - F.pow(1.0 - z, F.lit(a - 1)) * series) * bgnbd_alive(f, r, t, k)


def clv_bgnbd(df: DataFrame, horizons: Sequence[int] = (6, 12), frequency="frequency", recency="recency", age="age", monetary="monetary", monthly_discount: float = 0.01, min_rows: int = 40, min_repeaters: int = 30, penalty: float = 0.01) -> DataFrame:
    """CLV from fitted BG/NBD and Gamma-Gamma; the shrinkage engine when there is too little data."""
    f, r, t, m = _filled(frequency, recency, age, monetary)
    bad = F.lit(False)
    for c in _checks(f, r, t, m).values():
        bad = bad | c
    valid, repeat = ~bad, ~bad & (f > 0)
    sizes = df.agg(F.count_if(valid).alias("valid"), F.count_if(repeat).alias("repeaters")).first()
    if sizes["valid"] < min_rows:
        return clv_shrinkage(df, horizons, frequency, recency, age, monetary, monthly_discount)
    names = dict(frequency=frequency, recency=recency, age=age, monetary=monetary)
    k = fit_bgnbd(df, **names, penalty=penalty)
    typical = typical_value(df, **names)
    value, engine = shrunk_value(f, m, typical), "bgnbd_shrunk_value"
    if sizes["repeaters"] >= min_repeaters:
        g = fit_gamma_gamma(df, **names, penalty=penalty)
        weight = F.lit(g["p"]) * f / (g["p"] * f + (g["q"] - 1.0))
        value = F.when(repeat, (1 - weight) * (g["v"] * g["p"] / (g["q"] - 1.0)) + weight * m).otherwise(value)
        engine = "bgnbd_gamma_gamma"
    alive = F.when(valid, bgnbd_alive(f, r, t, k)).otherwise(F.lit(0.03))
    return _with_clv(
        df, horizons, alive, value,
        lambda h: F.coalesce(F.when(valid, F.greatest(bgnbd_expected(f, r, t, h * DAYS_PER_MONTH, k), F.lit(0.0))), F.lit(0.0)),
        monthly_discount, engine,
    )
