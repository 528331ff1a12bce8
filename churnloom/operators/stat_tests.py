"""Hypothesis tests from grouped moments and distributed ranks."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dist
from ..functions.scalar import count_rows, normal_cdf, normal_quantile, num, rnd
from ..session import materialize
from .describe import effect_sizes, kendall_pair, spearman_pair
from .ordered import average_ranks, cumulative, with_average_rank, with_average_ranks
from .quantiles import quantile_table, quantiles
from .skew import attach


def _one_column(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    v = num(value)
    rows = df.where(v.isNotNull())
    if group is None:
        return rows.select(v.alias("v"))
    return rows.where(F.col(group).isNotNull()).select(v.alias("v"), F.col(group).cast("string").alias("g"))


def jarque_bera(df: DataFrame, value: str) -> DataFrame:
    v = F.col("v")
    one = _one_column(df, value).agg(count_rows().alias("n"), F.skewness(v).alias("s"), F.kurtosis(v).alias("k"))
    stat = F.col("n") / 6.0 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4.0)
    # The chi-square survival function with two degrees of freedom is exp(-x / 2).
    return one.select("n", rnd(stat, 4).alias("statistic"), rnd(F.exp(-stat / 2.0), 4).alias("p_value"))


def edf_statistics(df: DataFrame, value: str) -> DataFrame:
    """Lilliefors' D and Anderson-Darling's A2 against the fitted normal, from counts per distinct value."""
    rows = _one_column(df, value)
    stats = rows.agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"), count_rows().alias("total")).first()
    if not stats["s"]:
        raise ValueError(f"{value} does not vary")
    n = float(stats["total"])
    ranked = average_ranks(rows, "v")
    z = (F.col("v") - float(stats["m"])) / float(stats["s"])
    below, upper = F.col("before").cast("double"), (F.col("before") + F.col("n")).cast("double")
    c, d = F.greatest(normal_cdf(z), F.lit(1e-300)), F.greatest(normal_cdf(-z), F.lit(1e-300))
    term = (upper * upper - below * below) * F.log(c) + (F.pow(n - below, F.lit(2.0)) - F.pow(n - upper, F.lit(2.0))) * F.log(d)
    return ranked.agg(
        F.lit(int(n)).cast("bigint").alias("n"),
        F.max(F.greatest(upper / n - c, c - below / n)).alias("lilliefors_d"),
        (F.lit(-n) - F.sum(term) / n).alias("anderson_a2"),
    )


def _score_sums() -> list[Column]:
    """Sums for the correlation of values with normal scores, from rows (v, n, rank, total, m): centred at the mean."""
    x, w = F.col("v") - F.col("m"), F.col("n").cast("double")
    score = normal_quantile((F.col("rank") - 0.375) / (F.col("total") + 0.25))
    return [F.sum(w * x).alias("sx"), F.sum(w * x * x).alias("sxx"), F.sum(w * score).alias("sy"), F.sum(w * score * score).alias("syy"), F.sum(w * x * score).alias("sxy")]


def _score_correlation() -> Column:
    """Squared correlation from ``_score_sums`` and ``total``."""
    n = F.col("total").cast("double")
    xy, xx, yy = F.col("sxy") - F.col("sx") * F.col("sy") / n, F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    return F.when((xx > 0) & (yy > 0), xy * xy / (xx * yy))


def shapiro_francia(df: DataFrame, value: str) -> tuple[float, float, int]:
    """W' and its p-value from all rows: the squared correlation of values and normal scores of their average ranks.

    The p-value's formula is published for 5 to 5,000 rows; beyond, it is the same formula carried on.
    """
    rows = _one_column(df, value)
    one = rows.agg(F.avg("v").alias("m"), count_rows().alias("total")).first()
    ranked = average_ranks(rows, "v").select("v", "n", F.col("avg_rank").alias("rank"), F.lit(one["total"]).alias("total"), F.lit(one["m"]).alias("m"))
    w = ranked.agg(F.max("total").alias("total"), *_score_sums()).select(_score_correlation().alias("w")).first()["w"]
    return w, dist.shapiro_francia_p(w, one["total"]), one["total"]


def normality(df: DataFrame, value: str, alpha: float = 0.05) -> DataFrame:
    """Four tests with their p-value and rejection, on all rows; ``is_normal`` when at least half do not reject."""
    edf = edf_statistics(df, value).first()
    jb = jarque_bera(df, value).first()
    w, p_w, used = shapiro_francia(df, value)
    n = edf["n"]
    rows = [
        ("shapiro_francia", w, p_w, used),
        ("anderson_darling", edf["anderson_a2"], dist.anderson_normal_p(edf["anderson_a2"], n), n),
        ("lilliefors", edf["lilliefors_d"], dist.lilliefors_p(edf["lilliefors_d"], n), n),
        ("jarque_bera", jb["statistic"], jb["p_value"], n),
    ]
    votes = [p < alpha for _, _, p, _ in rows]
    normal = votes.count(False) >= votes.count(True)
    return df.sparkSession.createDataFrame(
        [(t, round(s, 4), round(p, 4), bool(v), m, normal) for (t, s, p, m), v in zip(rows, votes)],
        "test string, statistic double, p_value double, rejects boolean, rows bigint, is_normal boolean",
    )


def group_normality(df: DataFrame, value: str, group: str, alpha: float = 0.05) -> DataFrame:
    """The four normality tests per group, matched to the group by name; normal when at least half do not reject.

    Moments, rank statistics and normal scores use every row, so the result does not depend on partitions.
    """
    rows = _one_column(df, value, group)
    stats = materialize(
        rows.groupBy("g").agg(
            count_rows().alias("total"), F.avg("v").alias("m"), F.stddev_samp("v").alias("sd"), F.skewness("v").alias("s"), F.kurtosis("v").alias("k")
        ), "group_stats",
    )
    ranked = average_ranks(rows, "v", ["g"]).select("g", "v", "n", "before", F.col("avg_rank").alias("rank"))
    z = (F.col("v") - F.col("m")) / F.col("sd")
    n = F.col("total").cast("double")
    below, upper = F.col("before").cast("double"), (F.col("before") + F.col("n")).cast("double")
    low, high = F.greatest(normal_cdf(z), F.lit(1e-300)), F.greatest(normal_cdf(-z), F.lit(1e-300))
    term = (upper * upper - below * below) * F.log(low) + ((n - below) * (n - below) - (n - upper) * (n - upper)) * F.log(high)
    edf = attach(ranked, stats.where((F.col("total") >= 5) & (F.col("sd") > 0)), ["g"], "total", how="inner").groupBy("g").agg(
        F.max(F.greatest(upper / n - low, low - below / n)).alias("d"), (-F.max(n) - F.sum(term / n)).alias("a2"),
        F.max("total").alias("total"), *_score_sums(),
    ).select("g", "d", "a2", _score_correlation().alias("w"))

    @F.pandas_udf("p_francia double, p_anderson double, p_lilliefors double")
    def p_values(w: pd.Series, a2: pd.Series, d: pd.Series, size: pd.Series) -> pd.DataFrame:
        out = [
            (None if pd.isna(x) else dist.shapiro_francia_p(x, int(m)), None if pd.isna(a) else dist.anderson_normal_p(a, int(m)), None if pd.isna(a) else dist.lilliefors_p(b, int(m)))
            for x, a, b, m in zip(w, a2, d, size)
        ]
        return pd.DataFrame(out, columns=["p_francia", "p_anderson", "p_lilliefors"], dtype=float)

    jb = F.when(F.col("n") >= 3, F.exp(-(F.col("n") / 6.0 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4.0)) / 2.0))
    joined = stats.withColumnRenamed("total", "n").join(edf, "g", "left").withColumn("p", p_values("w", "a2", "d", "n"))
    tests = [F.col("p.p_francia"), F.col("p.p_anderson"), F.col("p.p_lilliefors"), jb]
    rejects = sum((F.when(F.nanvl(t, F.lit(None)) < alpha, 1).otherwise(0) for t in tests), F.lit(0))
    keeps = sum((F.when(F.nanvl(t, F.lit(None)) >= alpha, 1).otherwise(0) for t in tests), F.lit(0))
    return joined.select(
        F.col("g").alias("group"), "n", *[rnd(F.nanvl(t, F.lit(None)), 4).alias(name) for t, name in zip(tests, ("p_francia", "p_anderson", "p_lilliefors", "p_jarque_bera"))],
        ((F.col("n") >= 3) & (keeps >= rejects) & (keeps + rejects > 0)).alias("is_normal"),
    )


def _moments(rows: DataFrame, label: str = "moments") -> DataFrame:
    """Rows, mean and variance of every group (``n, m, s2``), written once: one row per group."""
    return materialize(rows.groupBy("g").agg(count_rows().cast("double").alias("n"), F.avg("v").alias("m"), F.coalesce(F.var_samp("v"), F.lit(0.0)).alias("s2")), label)


def _one_way(groups: DataFrame) -> tuple[float, float, int]:
    """F, its p-value and the number of groups, from ``_moments``; only one-row sums reach the driver."""
    n, m, s2 = F.col("n"), F.col("m"), F.col("s2")
    one = groups.agg(count_rows().alias("k"), F.sum(n).alias("n"), (F.sum(n * m) / F.sum(n)).alias("grand")).first()
    if one["k"] < 2:
        return float("nan"), float("nan"), one["k"]
    two = groups.agg(F.sum(n * (m - one["grand"]) * (m - one["grand"])).alias("between"), F.sum((n - 1) * s2).alias("within")).first()
    d1, d2 = one["k"] - 1, one["n"] - one["k"]
    if two["within"] <= 0 or d2 <= 0:
        return float("nan"), float("nan"), one["k"]
    f = (two["between"] / d1) / (two["within"] / d2)
    return f, dist.f_sf(f, d1, d2), one["k"]


def _test_row(df: DataFrame, name: str, statistic: float, p: float, groups: int) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(name, None if math.isnan(statistic) else round(statistic, 4), None if math.isnan(p) else round(p, 4), groups)],
        "test string, statistic double, p_value double, groups int",
    )


def anova(df: DataFrame, value: str, group: str) -> DataFrame:
    f, p, k = _one_way(_moments(_one_column(df, value, group)))
    return _test_row(df, "anova", f, p, k)


def welch_anova(df: DataFrame, value: str, group: str) -> DataFrame:
    groups = _moments(_one_column(df, value, group))
    n, m, w = F.col("n"), F.col("m"), F.col("n") / F.col("s2")
    one = groups.agg(count_rows().alias("k"), F.sum(w).alias("w"), (F.sum(w * m) / F.sum(w)).alias("grand")).first()
    k, share = one["k"], 1 - w / one["w"]
    two = groups.agg(F.sum(share * share / (n - 1)).alias("lam"), F.sum(w * (m - one["grand"]) * (m - one["grand"])).alias("between")).first()
    f = two["between"] / (k - 1) / (1 + 2 * (k - 2) / (k * k - 1) * two["lam"])
    return _test_row(df, "welch_anova", f, dist.f_sf(f, k - 1, (k * k - 1) / (3 * two["lam"])), k)


def _two(groups: Sequence) -> None:
    if len(groups) != 2:
        raise ValueError("exactly two groups are needed")


def student_t(df: DataFrame, value: str, group: str, equal_variance: bool = True) -> DataFrame:
    """Student's or Welch's t-test; the sign is first group minus second, by name."""
    g = _moments(_one_column(df, value, group)).orderBy("g").limit(3).collect()
    _two(g)
    (n1, m1, v1), (n2, m2, v2) = ((r["n"], r["m"], r["s2"]) for r in g)
    if equal_variance:
        dof = n1 + n2 - 2
        se = math.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / dof * (1 / n1 + 1 / n2))
    else:
        a, b = v1 / n1, v2 / n2
        se, dof = math.sqrt(a + b), (a + b) ** 2 / (a * a / (n1 - 1) + b * b / (n2 - 1))
    t = (m1 - m2) / se
    return _test_row(df, "student_t" if equal_variance else "welch_t", t, dist.t_two_sided(t, dof), 2)


def variance_homogeneity(df: DataFrame, value: str, group: str, center: str = "median", alpha: float = 0.05) -> DataFrame:
    """Levene (mean) or Brown-Forsythe (median): one-way analysis of |value - centre of its group|."""
    rows = _one_column(df, value, group)
    if center == "median":
        rows = materialize(rows, "levene")
        centre = quantile_table(rows, ["v"], [0.5], ["g"]).select("g", F.col("value").alias("c"))
    else:
        centre = rows.groupBy("g").agg(F.avg("v").alias("c"))
    sizes = rows.groupBy("g").agg(count_rows().alias("_rows"))
    spread = attach(rows, centre.join(sizes, "g"), ["g"], "_rows").select("g", F.abs(F.col("v") - F.col("c")).alias("v"))
    f, p, k = _one_way(_moments(spread))
    if k < 2:
        raise ValueError("at least two groups are needed")
    name = "brown_forsythe" if center == "median" else "levene"
    return _test_row(df, name, f, p, k).withColumn("equal_variance", F.col("p_value") >= alpha)


def rank_sums(df: DataFrame, value: str, group: str) -> DataFrame:
    """Rows, rank sum and tie term per group, from counts per (value, group); ranks run over all groups."""
    counts = materialize(_one_column(df, value, group).groupBy("v", "g").agg(count_rows().alias("c")), "ranks")
    totals = counts.groupBy("v").agg(F.sum("c").alias("n"))
    ranked = cumulative(totals, ["v"], ["n"]).select("v", "n", (F.col("before_n") + (F.col("n") + 1) / 2.0).alias("rank"))
    return counts.join(ranked, "v").groupBy(F.col("g").alias("group")).agg(
        F.sum("c").alias("rows"), F.sum(F.col("c") * F.col("rank")).alias("rank_sum"),
        F.sum(F.col("c") * (F.col("n").cast("double") * F.col("n") - 1)).alias("tie_term"),
    )


def kruskal(df: DataFrame, value: str, group: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction."""
    g = rank_sums(df, value, group)
    n = F.sum("rows").cast("double")
    h = F.lit(12.0) / (n * (n + 1)) * F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("rows")) - 3 * (n + 1)
    one = g.agg((h / (1 - F.sum("tie_term") / (n * n * n - n))).alias("h"), count_rows().alias("k")).first()
    return _test_row(df, "kruskal", one["h"], dist.chi2_sf(one["h"], one["k"] - 1), one["k"])


def mann_whitney(df: DataFrame, value: str, group: str) -> DataFrame:
    """U of the first group by name, normal approximation with tie and continuity corrections."""
    rows = rank_sums(df, value, group).orderBy("group").limit(3).collect()
    _two(rows)
    a, b = rows
    n1, n2 = float(a["rows"]), float(b["rows"])
    n = n1 + n2
    u = a["rank_sum"] - n1 * (n1 + 1) / 2
    sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - (a["tie_term"] + b["tie_term"]) / (n * (n - 1))))
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sd
    return _test_row(df, "mann_whitney", u, min(1.0, dist.normal_two_sided(max(z, 0.0))), 2)


def compare_groups(df: DataFrame, value: str, group: str, alpha: float = 0.05) -> DataFrame:
    """Picks the test from normality, variances and number of groups, and adds the effect size."""
    rows = materialize(_one_column(df, value, group), "groups")
    normal = group_normality(rows, "v", "g", alpha).agg(F.bool_and("is_normal"), count_rows()).first()
    equal = bool(variance_homogeneity(rows, "v", "g", "median", alpha).first()["equal_variance"])
    if normal[1] < 2:
        raise ValueError("at least two groups are needed")
    if normal[1] == 2:
        test = student_t(rows, "v", "g", equal) if normal[0] else mann_whitney(rows, "v", "g")
    elif normal[0]:
        test = anova(rows, "v", "g") if equal else welch_anova(rows, "v", "g")
    else:
        test = kruskal(rows, "v", "g")
    effect = effect_sizes(rows, "v", "g").select(F.coalesce("cohen_d", "eta_squared").alias("effect_size"))
    return test.crossJoin(effect).withColumn("rejects", F.col("p_value") < alpha)


def correlation_band(r):
    return F.when(F.abs(r) >= 0.7, "fuerte").when(F.abs(r) >= 0.4, "moderada").when(F.abs(r) >= 0.2, "debil").otherwise("muy debil")


def correlation_test(df: DataFrame, x: str, y: str, method: str = "auto", alpha: float = 0.05) -> DataFrame:
    """Pearson, Spearman or Kendall with p-value and strength; ``auto`` asks the normality tests."""
    both = df.where(num(x).isNotNull() & num(y).isNotNull())
    if method == "auto":
        normal = all(normality(both, c, alpha).first()["is_normal"] for c in (x, y))
        method = "pearson" if normal else "spearman"
    if method == "pearson":
        one = both.agg(F.corr(num(x), num(y)).alias("r"), count_rows().alias("n")).first()
        p = dist.pearson_p(one["r"], one["n"])
    elif method == "spearman":
        one = spearman_pair(both, x, y).first()
        p = dist.pearson_p(one["r"], one["n"])
    elif method == "kendall":
        one = kendall_pair(both, x, y).first()
        n = one["n"]
        p = dist.normal_two_sided(3 * one["r"] * math.sqrt(n * (n - 1)) / math.sqrt(2 * (2 * n + 5)))
    else:
        raise ValueError("method must be auto, pearson, spearman or kendall")
    out = df.sparkSession.createDataFrame(
        [(method, one["r"], p, one["n"])], "method string, r double, p_value double, n bigint"
    )
    return out.select("method", rnd(F.col("r"), 4).alias("r"), rnd(F.col("p_value"), 4).alias("p_value"), "n", correlation_band(F.col("r")).alias("strength"))


def simpson_groups(df: DataFrame, x: str, y: str, group: str, method: str = "spearman", min_rows: int = 20) -> DataFrame:
    """Correlation per group next to the overall one. Spearman ranks are taken inside each group."""
    rows = materialize(
        df.select(num(x).alias("x"), num(y).alias("y"), F.col(group).cast("string").alias("g")).dropna(), "simpson"
    )
    inner, outer = rows, rows
    if method == "spearman":
        inner = with_average_rank(with_average_rank(rows, "x", "_rx", ["g"]), "y", "_ry", ["g"]).select(
            "g", F.col("_rx").alias("x"), F.col("_ry").alias("y")
        )
        outer = with_average_ranks(rows, {"x": "_rx", "y": "_ry"}).select(F.col("_rx").alias("x"), F.col("_ry").alias("y"))
    overall = outer.agg(F.corr("x", "y").alias("_all"), count_rows().alias("_n"))
    per = inner.groupBy("g").agg(count_rows().alias("n"), F.corr("x", "y").alias("r")).where(F.col("n") >= min_rows)
    opposite = (F.signum("_all") != 0) & (F.signum("r") != 0) & (F.signum("_all") != F.signum("r"))
    return per.crossJoin(F.broadcast(overall)).select(
        F.col("g").alias("group"), "n", rnd(F.col("r"), 4).alias("r"), rnd(F.col("_all"), 4).alias("overall_r"),
        F.coalesce(opposite, F.lit(False)).alias("is_opposite"), F.col("_n").alias("total"),
    )


def simpson_verdict(groups: DataFrame) -> DataFrame:
    against = F.sum(F.when(F.col("is_opposite"), F.col("n")).otherwise(0))
    return groups.agg(
        count_rows().alias("valid_groups"), F.max("overall_r").alias("overall_r"), against.alias("opposite_rows"),
        ((count_rows() >= 2) & (against >= 0.5 * F.max("total")) & (F.abs(F.max("overall_r")) >= 0.1)).alias("paradox"),
    )


def qq_points(df: DataFrame, value: str, probes: int = 99) -> DataFrame:
    """Sample and fitted-normal quantiles at evenly spaced probabilities."""
    rows = _one_column(df, value)
    stats = rows.agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).first()
    levels = [i / (probes + 1) for i in range(1, probes + 1)]
    q = quantiles(rows, ["v"], levels)["v"]
    return df.sparkSession.createDataFrame(
        [(p, round(stats["m"] + stats["s"] * dist.normal_ppf(p), 4), round(q[p], 4)) for p in levels], "prob double, normal double, sample double"
    )
