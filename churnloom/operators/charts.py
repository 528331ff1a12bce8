"""Chart data: the tables behind the figures. Drawing is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import count_rows, hash_unit, melt_numeric, num, rnd
from .clean import box_cox, power_lambda, yeo_johnson
from .quantiles import quantile_table, quantiles
from .skew import attach


def missingness_map(df: DataFrame, key: str, columns: Sequence[str], buckets: int = 20) -> DataFrame:
    """Null share per column and key-hash bucket."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).isNull().cast("double").alias("missing")) for c in columns])
    rows = df.select(F.floor(hash_unit(key) * buckets).cast("int").alias("bucket"), F.inline(cells))
    return rows.groupBy("column_name", "bucket").agg(count_rows().alias("rows"), rnd(F.avg("missing") * 100, 2).alias("pct_null"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width counts per column; the top edge belongs to the last bin."""
    limits = df.agg(
        *[F.min(num(c)).alias(f"low{i}") for i, c in enumerate(columns)], *[F.max(num(c)).alias(f"high{i}") for i, c in enumerate(columns)]
    ).first()
    known = {c: (limits[f"low{i}"], limits[f"high{i}"]) for i, c in enumerate(columns) if limits[f"low{i}"] is not None}
    low = F.create_map(*[x for c, (a, _) in known.items() for x in (F.lit(c), F.lit(a))])[F.col("column_name")]
    step = F.create_map(*[x for c, (a, b) in known.items() for x in (F.lit(c), F.lit((b - a) / bins or 1.0))])[F.col("column_name")]
    place = F.least(F.floor((F.col("value") - low) / step), F.lit(bins - 1)).cast("int")
    counts = melt_numeric(df, list(known)).groupBy("column_name", place.alias("bin")).agg(count_rows().alias("rows"))
    return counts.select("column_name", "bin", rnd(low + F.col("bin") * step, 4).alias("bin_low"), "rows")


def transform_histograms(df: DataFrame, column: str, method: str = "yeo_johnson", bins: int = 30) -> DataFrame:
    """Histogram before and after the power transform."""
    lam = power_lambda(df, column, method)
    after = yeo_johnson(num(column), lam) if method == "yeo_johnson" else box_cox(num(column), lam)
    return histogram(df.select(num(column).alias("before"), after.alias("after")), ["before", "after"], bins)


def five_numbers(df: DataFrame, value: str, group: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers within 1.5 IQR and the points beyond them."""
    rows = df.where(num(value).isNotNull() & F.col(group).isNotNull()).select(F.col(group).alias("group"), num(value).alias("v"))
    q = quantile_table(rows, ["v"], [0.25, 0.5, 0.75], ["group"]).groupBy("group").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]]
    )
    width = 1.5 * (F.col("q75") - F.col("q25"))
    inside = (F.col("v") >= F.col("q25") - width) & (F.col("v") <= F.col("q75") + width)
    return attach(rows, q, ["group"]).groupBy("group").agg(
        count_rows().alias("rows"), rnd(F.min(F.when(inside, F.col("v"))), 4).alias("whisker_low"),
        *[rnd(F.any_value(c), 4).alias(c) for c in ("q25", "q50", "q75")],
        rnd(F.max(F.when(inside, F.col("v"))), 4).alias("whisker_high"), F.count_if(~inside).alias("outside"),
    )


def binned_pairs(df: DataFrame, x: Column, y: Column, bins: int = 20) -> DataFrame:
    """Mean and spread of ``y`` in equal-frequency bins of ``x``: residual and scale-location charts."""
    rows = df.select(x.alias("x"), y.alias("y")).dropna()
    q = quantiles(rows, ["x"], [i / bins for i in range(1, bins)])["x"]
    place = sum(((F.col("x") > v).cast("int") for v in sorted(set(q.values()))), F.lit(0))
    return rows.groupBy(place.alias("bin")).agg(
        count_rows().alias("rows"), rnd(F.avg("x"), 4).alias("mean_x"), rnd(F.avg("y"), 4).alias("mean_y"),
        rnd(F.stddev_samp("y"), 4).alias("std_y"),
    )


def winner_rank_histogram(per_event: DataFrame) -> DataFrame:
    return per_event.groupBy("winner_rank").agg(count_rows().alias("events"))
