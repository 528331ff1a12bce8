"""Column expressions shared by the operators. All stay on the JVM side."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def num(column: str | Column) -> Column:
    """Column as double; text that does not parse, and NaN, become null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def rnd(x: Column, digits: int) -> Column:
    """Round half to even on the scaled value, as NumPy does."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def rounded(x: float, digits: int) -> float:
    """``rnd`` for a Python number."""
    return round(x * 10**digits) / 10**digits if x == x and abs(x) != float("inf") else x


def count_rows() -> Column:
    return F.count(F.lit(1))


def exact_mean(x: Column) -> Column:
    """Mean of values with at most four decimals, summed exactly: the same whatever the row order."""
    return F.sum(x.cast("decimal(28,4)")).cast("double") / F.count(x)


def share(condition: Column, digits: int = 2) -> Column:
    """Percentage of rows that satisfy ``condition`` (null counts as false)."""
    return rnd(F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100, digits)


def clip(x: Column, low: Column | float | None, high: Column | float | None) -> Column:
    """Clip and keep nulls (``greatest`` and ``least`` alone would replace them)."""
    out = x
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(float(low)))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(float(high)))
    return F.when(x.isNotNull(), out)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column, epsilon: float = 1e-6) -> Column:
    q = clip(p, epsilon, 1 - epsilon)
    return F.log(q / (F.lit(1.0) - q))


def safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def normal_cdf(z: Column) -> Column:
    """Standard normal CDF from a Chebyshev fit of erfc; relative error below 1.2e-7 in both tails."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * x)
    # Published erfc coefficients, highest power first.
    coefficients = [
        0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807,
        -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223,
    ]
    poly = reduce(lambda acc, c: F.lit(c) + t * acc, coefficients[1:], F.lit(coefficients[0]))
    tail = F.lit(0.5) * t * F.exp(poly - x * x)
    return F.when(z >= 0, F.lit(1.0) - tail).otherwise(tail)


def normal_quantile(p: Column) -> Column:
    """Standard normal quantile by a published rational approximation; relative error below 1.2e-9."""
    # The approximation's coefficients, highest power first.
    a = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
    b = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0]
    poly = lambda k, x: reduce(lambda acc, v: acc * x + F.lit(v), k[1:], F.lit(k[0]))
    q = p - F.lit(0.5)
    r = q * q
    t = F.sqrt(F.lit(-2.0) * F.log(F.least(p, F.lit(1.0) - p)))
    tail = poly(c, t) / poly(d, t)
    return F.when(F.abs(q) <= 0.47575, poly(a, r) * q / poly(b, r)).when(q < 0, tail).otherwise(-tail)


def hash_unit(key: str | Column | Sequence[str], seed: int | Column = 42) -> Column:
    """Uniform value in [0, 1) that depends only on the key and the seed."""
    if isinstance(key, Column):
        parts = [key.cast("string")]
    else:
        names = [key] if isinstance(key, str) else list(key)
        parts = [F.col(n).cast("string") for n in names]
    text = F.concat_ws("|", *parts, seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


# Accented Latin letters and their plain forms, position by position.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"


def accentless(x: Column) -> Column:
    return F.translate(x, ACCENTED, PLAIN)


# Texts read as yes and as no.
YES_TEXTS = ("si", "sí", "s", "1", "true", "yes", "y")
NO_TEXTS = ("no", "n", "0", "false")


def standard_name(name: str) -> str:
    """Column name in snake case without accents or symbols."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", str(name)) if not unicodedata.combining(c))
    return re.sub(r"[^0-9a-zA-Z]+", "_", plain.strip().lower()).strip("_")


def standardize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_name(c) for c in df.columns])


def yes_no(column: str) -> Column:
    """1 for yes texts and 0 for no texts in any case; null for all others."""
    text = F.lower(F.trim(F.col(column).cast("string")))
    return F.when(text.isin(*YES_TEXTS), F.lit(1)).when(text.isin(*NO_TEXTS), F.lit(0))


def prepared_targets(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Target columns as whole numbers, in place.

    Numbers are cut to whole numbers. Texts are read as yes and no; only where some value is neither, and every value of the
    column (nulls count as values) parses as a number, all are read as numbers instead. What is left is null. Which of
    the two holds is found for all columns in one aggregation.
    """
    kinds = dict(df.dtypes)
    texts = [c for c in columns if kinds[c] in ("string", "date", "timestamp")]

    def number(c: str) -> Column:
        value = num(F.col(c).cast("string"))
        return F.when(~F.isnan(value), value)

    found = df.agg(
        *[F.bool_and(yes_no(c).isNotNull()).alias(f"words_{i}") for i, c in enumerate(texts)],
        *[F.bool_and(number(c).isNotNull()).alias(f"numbers_{i}") for i, c in enumerate(texts)],
    ).first() if texts else {}
    out = {c: num(c).cast("bigint") for c in columns if c not in texts}
    for i, c in enumerate(texts):
        as_numbers = not found[f"words_{i}"] and found[f"numbers_{i}"]
        out[c] = (number(c) if as_numbers else yes_no(c)).cast("bigint")
    return df.withColumns(out)


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("the table has no rows")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType))]


def category_columns(df: DataFrame) -> list[str]:
    return text_columns(df) + [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def date_like_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "fecha" in c.lower() or "date" in c.lower()]


def melt_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = ()) -> DataFrame:
    """Long form (by..., column_name, value) without nulls; narrow, so it combines before any shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), num(c).alias("value")) for c in columns])
    return df.select(*by, F.inline(cells)).where(F.col("value").isNotNull())


def melt_text(df: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = ()) -> DataFrame:
    """Long form (by..., column_name, value) with text values; nulls kept."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(*by, F.inline(cells))
