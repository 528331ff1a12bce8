"""Audit of a table before analysis: nulls, duplicates, identifiers, text and date standards, drift, health."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dist
from ..functions.scalar import (
    category_columns,
    count_rows,
    date_like_columns,
    melt_text,
    num,
    numeric_columns,
    require_columns,
    rnd,
    share,
    standard_name,
    text_columns,
)
from ..session import materialize
from .quantiles import bin_of, distinct_edges, quantiles

# Texts read as a logical null.
NULL_MARKERS = ("NA", "N/A", "NULL", "null", "")
# Texts of a two-valued category.
BINARY_TEXTS = ("si", "no", "true", "false", "0", "1")


def rows_of(one_row: DataFrame, columns: Sequence[str], fields: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """Turns one wide row ``<field>__<i>`` into one row per column."""
    structs = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{f}__{i}").alias(f) for f in fields],
                 *([F.lit(types[c]).alias("data_type")] if types else []))
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per distinct value (as text, null included) of every column, from one shuffle."""
    return melt_text(df, columns).groupBy("column_name", "value").agg(count_rows().alias("n"))


def sample_values(df: DataFrame, columns: Sequence[str], key: str, limit: int = 3, separator: str = ", ") -> DataFrame:
    """The first ``limit`` non-null values by key of every column, as one text.

    Each column reads only itself and the key, and keeps a few rows per task.
    """
    parts = None
    for c in columns:
        value = F.col(c).cast("string")
        first = (
            df.select(F.lit(c).alias("column_name"), F.col(key).alias("_key"), value.alias("value"))
            .where(F.col("value").isNotNull()).orderBy("_key", "value").limit(limit)
        )
        parts = first if parts is None else parts.unionByName(first)
    ordered = F.array_sort(F.collect_list(F.struct("_key", "value")))
    return parts.groupBy("column_name").agg(F.concat_ws(separator, F.transform(ordered, lambda s: s["value"])).alias("sample"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    wide = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"nulls__{i}") for i, c in enumerate(columns)],
        *[share(F.col(c).isNull()).alias(f"pct_null__{i}") for i, c in enumerate(columns)],
    )
    return rows_of(wide, columns, ["nulls", "pct_null"], dict(df.dtypes)).orderBy(
        F.desc("nulls"), F.desc("pct_null"), "column_name"
    )


def _counted_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = value_counts(df, columns)
    present = F.col("value").isNotNull()
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(present, F.col("n")).otherwise(0)).alias("non_null"),
        F.sum(F.when(present, 0).otherwise(F.col("n"))).alias("nulls"),
        F.count("value").alias("distinct_values"),
        count_rows().alias("distinct_with_null"),
        F.sum(F.when(F.col("value").try_cast("double") == 0, F.col("n")).otherwise(0)).alias("zeros"),
    )


def quality_report(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    numbers = set(numeric_columns(df))
    types = dict(df.dtypes)
    base = _counted_profile(df, columns)
    samples = sample_values(df, columns, key)
    type_of = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(types[c]))])
    return (
        base.join(F.broadcast(samples), "column_name", "left")
        .select(
            "column_name",
            type_of[F.col("column_name")].alias("data_type"),
            "non_null",
            "nulls",
            rnd(F.col("nulls") / F.col("rows") * 100, 2).alias("pct_null"),
            "distinct_values",
            rnd((F.lit(1.0) - F.col("distinct_with_null") / F.col("rows")) * 100, 2).alias("pct_duplicate_values"),
            F.coalesce("sample", F.lit("")).alias("sample"),
            F.when(F.col("column_name").isin(*numbers) if numbers else F.lit(False),
                   rnd(F.col("zeros") / F.col("rows") * 100, 2)).alias("pct_zero"),
        )
        .orderBy(F.desc("pct_null"), "distinct_values", "column_name")
    )


def drop_duplicates(
    df: DataFrame, keep: str = "first", order: str | None = None, subset: Sequence[str] | None = None
) -> DataFrame:
    """Duplicate removal as a combining aggregation, so a much-repeated row never gathers in one task.

    ``first`` and ``last`` need ``order`` when columns outside ``subset`` must come from that row;
    ``none`` drops every copy.
    """
    subset = list(subset or [c for c in df.columns if c != order])
    if keep == "none":
        once = df.groupBy(*subset).agg(count_rows().alias("_n"), *[F.first(c).alias(c) for c in df.columns if c not in subset])
        return once.where(F.col("_n") == 1).select(*df.columns)
    if order is None:
        return df.dropDuplicates(subset)
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    rest = [c for c in df.columns if c not in subset]
    chosen = df.groupBy(*subset).agg(pick(F.struct(*rest), F.col(order)).alias("_r"))
    return chosen.select(*subset, "_r.*").select(*df.columns)


def row_duplicates(df: DataFrame) -> DataFrame:
    copies = df.groupBy(*df.columns).agg(count_rows().alias("n"))
    return copies.agg(
        F.sum("n").alias("rows"),
        count_rows().alias("distinct_rows"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
        rnd(F.sum(F.col("n") - 1) / F.sum("n") * 100, 2).alias("pct_duplicates"),
    )


def id_uniqueness(df: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    require_columns(df, id_columns)
    p = _counted_profile(df, id_columns)
    return p.select(
        "column_name",
        rnd(F.col("distinct_with_null") / F.col("rows") * 100, 2).alias("pct_unique"),
        (F.col("rows") - F.col("distinct_with_null")).alias("duplicates"),
        (F.col("rows") == F.col("distinct_with_null")).alias("is_unique"),
    )


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with one value, null counting as a value. Needs only min, max and count."""
    columns = list(columns or df.columns)
    rows = count_rows()
    wide = df.agg(
        *[
            ((F.count(c) == 0) | ((F.count(c) == rows) & (F.min(c) == F.max(c)))).alias(f"is_constant__{i}")
            for i, c in enumerate(columns)
        ]
    )
    return rows_of(wide, columns, ["is_constant"]).where("is_constant").select("column_name")


def zero_variance_columns(df: DataFrame, columns: Sequence[str], tolerance: float = 1e-12) -> list[str]:
    row = df.agg(*[F.var_pop(num(c)).alias(f"v{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"v{i}"] is None or row[f"v{i}"] <= tolerance]


def leakage_candidates(df: DataFrame, target: str, threshold: float = 0.98) -> DataFrame:
    """Columns whose correlation with the target, or share of equal text, reaches ``threshold``."""
    others = [c for c in df.columns if c != target]
    numbers = [c for c in numeric_columns(df) if c != target] if target in numeric_columns(df) else []
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("<NA>")) for c in [*others, target]}
    wide = df.agg(
        *[F.abs(F.corr(num(c), num(target))).alias(f"corr__{i}") for i, c in enumerate(numbers)],
        *[F.avg((text[c] == text[target]).cast("double")).alias(f"match__{i}") for i, c in enumerate(others)],
    )
    found = [F.struct(F.lit(c).alias("column_name"), F.lit("correlation").alias("kind"), F.col(f"corr__{i}").alias("s"))
             for i, c in enumerate(numbers)]
    found += [F.struct(F.lit(c).alias("column_name"), F.lit("equal_text").alias("kind"), F.col(f"match__{i}").alias("s"))
              for i, c in enumerate(others)]
    return (
        wide.select(F.inline(F.array(*found)))
        .where(F.col("s") >= threshold)
        .select("column_name", "kind", rnd(F.col("s"), 4).alias("strength"))
        .orderBy(F.desc("strength"), "column_name", "kind")
    )


def header_audit(df: DataFrame) -> DataFrame:
    rows = [(c, standard_name(c), standard_name(c) == c) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, standard_name string, is_standard boolean")


def text_standards(df: DataFrame, columns: Sequence[str] | None = None, null_markers: Sequence[str] = NULL_MARKERS) -> DataFrame:
    """Case and space variants, and the null tokens mixed into each text column."""
    columns = list(columns or text_columns(df))
    markers = sorted({m.strip().upper() for m in null_markers})
    trimmed = F.trim("value")
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    levels = counts.groupBy("column_name", trimmed.alias("value")).agg(F.sum("n").alias("n"))
    folded = levels.groupBy("column_name", F.lower("value").alias("folded")).agg(
        count_rows().alias("forms"),
        F.collect_set(F.when(F.upper("value").isin(*markers), F.col("value"))).alias("tokens"),
    )
    tokens = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.size("tokens") > 0, F.col("tokens"))))))
    return folded.groupBy("column_name").agg(
        F.sum("forms").alias("levels_original"),
        count_rows().alias("levels_normalized"),
        F.sum(F.col("forms") - 1).alias("case_space_variants"),
        F.concat_ws(" | ", tokens).alias("null_tokens"),
        (F.size(tokens) > 1).alias("null_tokens_inconsistent"),
    )


def numeric_like_text(df: DataFrame, columns: Sequence[str] | None = None, min_rate: float = 0.85, min_levels: int = 5) -> DataFrame:
    """Text columns that hold numbers once thousands dots, decimal commas and % are read."""
    columns = list(columns or text_columns(df))
    levels = (
        value_counts(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column_name", F.trim("value").alias("value"))
        .agg(F.sum("n").alias("n"))
    )
    # Patterns of a thousands dot and of a decimal comma.
    probe = F.regexp_replace("value", r"(?<=\d)\.(?=\d{3}(\D|$))", "")
    probe = F.replace(F.regexp_replace(probe, r"(?<=\d),(?=\d)", "."), F.lit("%"), F.lit(""))
    parsed = F.sum(F.when(probe.try_cast("double").isNotNull(), F.col("n")).otherwise(0))
    rated = levels.groupBy("column_name").agg((parsed / F.sum("n")).alias("rate"), count_rows().alias("levels"))
    return rated.where((F.col("rate") >= min_rate) & (F.col("levels") > min_levels)).select(
        "column_name", rnd(F.col("rate") * 100, 2).alias("pct_numeric")
    )


def date_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of parseable dates, number of digit patterns and date range per column."""
    columns = list(columns or date_like_columns(df))
    cells = melt_text(df, columns).where(F.col("value").isNotNull())
    parsed = F.try_to_timestamp(F.trim("value"))
    pattern = F.regexp_replace(F.trim("value"), "[0-9]", "9")
    by_pattern = cells.groupBy("column_name", pattern.alias("pattern")).agg(
        count_rows().alias("n"), F.count(parsed).alias("valid"), F.min(parsed).alias("low"), F.max(parsed).alias("high")
    )
    rate = F.sum("valid") / F.sum("n")
    return by_pattern.groupBy("column_name").agg(
        rnd(rate * 100, 2).alias("pct_valid"),
        count_rows().alias("patterns"),
        ((rate < 0.98) | (count_rows() > 1)).alias("needs_normalization"),
        F.min("low").alias("date_min"),
        F.max("high").alias("date_max"),
    )


def semantic_families(df: DataFrame) -> dict[str, str]:
    """datetime, boolean, numeric, binary_categorical or categorical, from the schema and one aggregation."""
    families: dict[str, str] = {}
    texts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            families[f.name] = "datetime"
        elif isinstance(f.dataType, T.BooleanType):
            families[f.name] = "boolean"
        elif isinstance(f.dataType, T.NumericType):
            families[f.name] = "numeric"
        else:
            texts.append(f.name)
    if texts:
        row = df.agg(
            *[F.bool_and(F.lower(F.trim(F.col(c).cast("string"))).isin(*BINARY_TEXTS)).alias(f"b{i}") for i, c in enumerate(texts)]
        ).first()
        families.update({c: "binary_categorical" if row[f"b{i}"] else "categorical" for i, c in enumerate(texts)})
    return {c: families[c] for c in df.columns}


def problem_type(df: DataFrame, target: str) -> str:
    kind = df.schema[target].dataType
    if isinstance(kind, (T.BooleanType, T.StringType)):
        return "classification"
    if isinstance(kind, T.IntegralType):
        few = df.select(target).where(F.col(target).isNotNull()).distinct().limit(11).count() <= 10
        return "classification" if few else "regression"
    return "regression"


def data_dictionary(
    df: DataFrame,
    key: str,
    id_columns: Sequence[str] = (),
    target: str | None = None,
    date_columns: Sequence[str] | None = None,
    descriptions: dict[str, str] | None = None,
) -> DataFrame:
    families = semantic_families(df)
    dates = list(date_columns if date_columns is not None else date_like_columns(df))
    roles = {c: "target" if c == target else "identifier" if c in id_columns else "timestamp" if c in dates else "feature"
             for c in df.columns}
    known = descriptions or {}
    meta = df.sparkSession.createDataFrame(
        [(i, c, standard_name(c), roles[c], families[c], dict(df.dtypes)[c], known.get(c, f"Column {c}"))
         for i, c in enumerate(df.columns)],
        "place int, column_name string, standard_name string, role string, family string, data_type string, description string",
    )
    profile = _counted_profile(df, df.columns)
    return (
        F.broadcast(meta)
        .join(profile, "column_name")
        .join(F.broadcast(sample_values(df, df.columns, key, separator=" | ")), "column_name", "left")
        .select(
            "place", "column_name", "standard_name", "role", "family", "data_type", "description",
            rnd(F.col("nulls") / F.col("rows") * 100, 2).alias("pct_null"),
            "distinct_values",
            rnd(F.col("distinct_with_null") / F.col("rows") * 100, 2).alias("pct_unique"),
            (F.col("nulls") > 0).alias("nullable"),
            F.coalesce("sample", F.lit("")).alias("sample"),
        )
        .orderBy("place")
    )


def csvw_schema(dictionary: DataFrame, name: str) -> str:
    """Table schema in the W3C CSV-on-the-Web form, from the dictionary (one row per column)."""
    columns = [
        {
            "name": r["standard_name"], "titles": r["column_name"], "datatype": r["family"],
            "description": r["description"], "required": not r["nullable"],
            "unique": r["role"] == "identifier" or r["pct_unique"] >= 98,
        }
        for r in dictionary.orderBy("place").collect()
    ]
    return json.dumps(
        {
            "@context": "https://www.w3.org/ns/csvw", "url": f"{name}.csv",
            "tableSchema": {"columns": columns}, "dialect": {"encoding": "utf-8", "header": True},
        }
    )


def segment_coverage(df: DataFrame, segments: Sequence[str], target: str | None = None) -> DataFrame:
    """Rows, share and target rate of each value of each segment column."""
    value = F.coalesce(F.col("value"), F.lit("NA"))
    cells = melt_text(df, segments, [num(target).alias("_t")] if target else [])
    aggs = [count_rows().alias("rows")]
    if target:
        aggs.append((F.avg("_t") * 100).alias("rate"))
    counts = cells.groupBy("column_name", value.alias("value")).agg(*aggs)
    # Every row counts once in each dimension, so one total serves all.
    out = counts.crossJoin(F.broadcast(df.agg(count_rows().alias("_total")))).select(
        F.col("column_name").alias("dimension"), "value",
        rnd(F.col("rows") / F.col("_total") * 100, 2).alias("pct_rows"), "rows",
        *([rnd(F.col("rate"), 2).alias("pct_target")] if target else []),
    )
    return out.orderBy("dimension", F.desc("rows"), "value")


def coverage_alerts(coverage: DataFrame, rare_pct: float = 5.0, dominant_pct: float = 60.0) -> DataFrame:
    """Dominant and rare values per dimension, and the sampling they call for."""
    per = coverage.groupBy("dimension").agg(
        F.max("pct_rows").alias("largest_pct"), F.count_if(F.col("pct_rows") < rare_pct).alias("rare_values")
    )
    uneven = (F.col("largest_pct") >= dominant_pct) | (F.col("rare_values") > 0)
    return per.select(
        "dimension", "largest_pct", "rare_values",
        (F.col("largest_pct") >= dominant_pct).alias("is_dominated"),
        (F.col("rare_values") > 0).alias("has_rare"),
        F.when(uneven, "muestreo_estratificado").otherwise("muestreo_aleatorio_simple").alias("sampling"),
    )


def date_coverage(df: DataFrame, date: str) -> DataFrame:
    """Days covered, longest gap between recorded moments and share of parseable dates.

    Distinct days number in the thousands at most, so the gap window runs on a small table.
    """
    stamp = F.try_to_timestamp(F.col(date).cast("string"))
    days = (
        df.where(F.col(date).isNotNull())
        .groupBy(F.to_date(stamp).alias("day"))
        .agg(count_rows().alias("n"), F.min(stamp).alias("first"), F.max(stamp).alias("last"))
    )
    # Years split the ordering; each year's first moment is compared with the last one before it.
    year = Window.partitionBy(F.year("day")).orderBy("day")
    known = days.where(F.col("day").isNotNull())

    def whole_days(later: Column, earlier: Column) -> Column:
        return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / 8.64e10).cast("bigint")

    inside = known.withColumn("gap", whole_days(F.col("first"), F.lag("last").over(year)))
    yearly = inside.groupBy(F.year("day").alias("y")).agg(
        F.max("gap").alias("gap"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    across = yearly.withColumn("jump", whole_days(F.col("first"), F.lag("last").over(Window.orderBy("y"))))
    gaps = across.agg(
        whole_days(F.max("last"), F.min("first")).alias("days_covered"),
        F.coalesce(F.greatest(F.max("gap"), F.max("jump")), F.lit(0)).alias("longest_gap_days"),
    )
    parsed = days.agg(
        rnd(F.sum(F.when(F.col("day").isNotNull(), F.col("n")).otherwise(0)) / F.sum("n") * 100, 2).alias("pct_valid")
    )
    return gaps.crossJoin(F.broadcast(parsed)).select(F.lit(date).alias("column_name"), "days_covered", "longest_gap_days", "pct_valid")


def time_split(df: DataFrame, date: str, q: float = 0.65, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Reference rows up to the date quantile and current rows after it; halves by order if one is empty."""
    micros = F.unix_micros(F.col(date).cast("timestamp"))
    cut = quantiles(df.select(micros.alias("m")), ["m"], [q])["m"][q]
    if cut is None:
        raise ValueError(f"no dates in {date}")
    early, late = df.where(micros <= cut), df.where(micros > cut)
    if key is not None and late.isEmpty():
        from .ordered import positions

        placed = positions(df, [date, key])
        half = placed.count() // 2
        return placed.where(F.col("position") < half).drop("position"), placed.where(F.col("position") >= half).drop("position")
    return early, late


def schema_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    a, b = dict(reference.dtypes), dict(current.dtypes)
    rows = [
        (c, a.get(c), b.get(c),
         "added" if c not in a else "removed" if c not in b else "type_changed" if a[c] != b[c] else "same")
        for c in sorted(set(a) | set(b))
    ]
    return reference.sparkSession.createDataFrame(
        rows, "column_name string, type_reference string, type_current string, change string"
    )


def volume_drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Row counts of both snapshots and their deviation."""
    old = reference.agg(count_rows().alias("rows_reference"))
    new = current.agg(count_rows().alias("rows_current"))
    a, b = F.col("rows_reference"), F.col("rows_current")
    return old.crossJoin(new).select(
        "rows_reference", "rows_current", rnd((b - a) / F.greatest(a, F.lit(1)) * 100, 2).alias("pct_deviation")
    )


def population_stability(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10, threshold: float = 0.2, overflow: bool = False
) -> DataFrame:
    """PSI per column. Numeric columns use the reference deciles, others their categories.

    Current values outside the reference range are left out unless ``overflow`` adds two open bins.
    """
    numbers = [c for c in columns if c in numeric_columns(reference) and c in numeric_columns(current)]
    enough = max(20, 2 * bins)
    sizes = []
    for df in (reference, current):
        row = df.agg(*[F.count(num(c)).alias(f"n{i}") for i, c in enumerate(numbers)]).first() if numbers else {}
        sizes.append({c: row[f"n{i}"] for i, c in enumerate(numbers)})
    numbers = [c for c in numbers if min(s[c] for s in sizes) >= enough]
    levels = [i / bins for i in range(bins + 1)]
    cuts = quantiles(reference, numbers, levels) if numbers else {}
    edges: dict[str, list[float]] = {}
    flat = []
    for c in numbers:
        e = distinct_edges(cuts[c].values())
        if len(e) < 3:
            low, high = e[0], e[-1]
            if math.isclose(low, high):
                flat.append(c)
                continue
            e = [low + (high - low) * i / bins for i in range(bins + 1)]
        edges[c] = e

    def label(c: str) -> Column:
        if c in edges:
            b = bin_of(num(c), edges[c])
            if overflow:
                b = F.when(num(c) < edges[c][0], -1).when(num(c) > edges[c][-1], len(edges[c])).otherwise(b)
            return b.cast("string")
        return F.coalesce(F.col(c).cast("string"), F.lit("nan"))

    used = [c for c in columns if c not in flat]

    def shares(df: DataFrame, name: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), label(c).alias("bin")) for c in used])
        counts = (
            df.select(F.explode(cells).alias("c")).select("c.*").where(F.col("bin").isNotNull())
            .groupBy("column_name", "bin").agg(count_rows().alias("n"))
        )
        totals = counts.groupBy("column_name").agg(F.sum("n").alias("total"))
        return counts.join(totals, "column_name").select("column_name", "bin", (F.col("n") / F.col("total")).alias(name))

    # Columns without spread cannot drift over their own deciles.
    out = reference.sparkSession.createDataFrame([(c, 0.0) for c in flat], "column_name string, s double")
    if used:
        both = shares(reference, "r").join(shares(current, "c"), ["column_name", "bin"], "full_outer")
        r, c = F.coalesce("r", F.lit(0.0)), F.coalesce("c", F.lit(0.0))
        term = (c - r) * F.log(F.greatest(c, F.lit(1e-6)) / F.greatest(r, F.lit(1e-6)))
        out = out.unionByName(both.groupBy("column_name").agg(F.sum(term).alias("s")))
    return out.select("column_name", rnd(F.col("s"), 4).alias("psi"), (F.col("s") >= threshold).alias("is_severe")).orderBy(
        F.desc("psi"), "column_name"
    )


def dataset_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.2) -> dict[str, DataFrame]:
    common = [c for c in (columns or sorted(reference.columns)) if c in reference.columns and c in current.columns]
    return {
        "schema": schema_drift(reference, current),
        "volume": volume_drift(reference, current),
        "drift": population_stability(reference, current, common, threshold=threshold),
    }


@dataclass(frozen=True)
class HealthLimits:
    freshness_hours: float = 24.0
    count_pct: float = 20.0
    critical_freshness_multiplier: float = 2.0
    critical_count_pct: float | None = None
    error_alert_pct: float = 5.0
    error_critical_pct: float = 10.0


# The named limit profiles.
HEALTH_PROFILES = {
    "demo": HealthLimits(168.0, 50.0, 2.0, 75.0, 10.0, 15.0),
    "qa": HealthLimits(72.0, 35.0, 2.0, 60.0, 8.0, 12.0),
    "production": HealthLimits(24.0, 20.0, 2.0, 40.0, 5.0, 10.0),
}


def invalid_rows(df: DataFrame, required: Sequence[str]) -> Column:
    """Counts rows with a null in any required column."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    return F.count_if(missing)


def pipeline_health(
    df: DataFrame,
    dataset: str,
    date: str,
    required: Sequence[str],
    observed_at: Column,
    expected_rows: int,
    limits: HealthLimits = HealthLimits(),
    observed: Column | None = None,
) -> DataFrame:
    """Freshness, volume and validation status with the decision allow, degraded or blocked.

    ``observed`` restricts the volume count (for example to the newest snapshot).
    """
    top = limits.critical_count_pct if limits.critical_count_pct is not None else max(limits.count_pct * 2, 40.0)
    late = limits.freshness_hours * max(limits.critical_freshness_multiplier, 1.0)
    hours = (F.unix_micros(observed_at.cast("timestamp")) - F.unix_micros(F.max(F.col(date).cast("timestamp")))) / 3.6e9
    seen = F.count_if(observed) if observed is not None else count_rows()
    base = df.agg(
        rnd(hours, 2).alias("freshness_hours"),
        (rnd((seen - expected_rows) / F.lit(float(expected_rows)) * 100, 2) if expected_rows else F.lit(None).cast("double")).alias("pct_count_deviation"),
        rnd(invalid_rows(df, required) / F.greatest(count_rows(), F.lit(1)) * 100, 2).alias("pct_validation_errors"),
    )

    def status(x: Column, critical: float, alert: float) -> Column:
        return F.when(x > critical, "critico").when(x > alert, "alerta").otherwise("ok")

    out = base.select(
        F.lit(dataset).alias("dataset"), "*",
        status(F.col("freshness_hours"), late, limits.freshness_hours).alias("freshness_status"),
        status(F.abs("pct_count_deviation"), top, limits.count_pct).alias("count_status"),
        status(F.col("pct_validation_errors"), limits.error_critical_pct, limits.error_alert_pct).alias("validation_status"),
    )
    parts = {"frescura": "freshness_status", "conteo": "count_status", "validacion": "validation_status"}
    active = F.concat_ws(", ", *[F.when(F.col(c) != "ok", F.lit(n)) for n, c in parts.items()])
    critical = sum((F.when(F.col(c) == "critico", 1).otherwise(0) for c in parts.values()), F.lit(0))
    any_alert = F.col("active_alerts") != "ninguna"
    return out.withColumn("active_alerts", F.when(active == "", "ninguna").otherwise(active)).select(
        "*",
        critical.alias("critical_issues"),
        F.when(F.col("validation_status") == "critico", "critico").when(any_alert, "alerta").otherwise("ok").alias("severity"),
        F.when(F.col("validation_status") == "critico", "blocked").when(any_alert, "degraded").otherwise("allow").alias("decision"),
    )


def execution_gate(health: DataFrame, profile: str) -> DataFrame:
    return health.select(
        "dataset", F.lit(profile).alias("profile"), "severity", "decision", "active_alerts", "critical_issues",
        (F.col("decision") != "blocked").alias("modeling_enabled"),
    )


def target_balance(df: DataFrame, target: str, max_levels: int = 10) -> DataFrame:
    """Share of each target value, flagged from 80%; the numeric summary of a target of more than ``max_levels`` values."""
    counts = df.groupBy(F.col(target).cast("string").alias("value")).agg(count_rows().alias("rows"))
    if counts.limit(max_levels + 1).count() > max_levels and isinstance(df.schema[target].dataType, T.NumericType):
        from .describe import numeric_summary

        return numeric_summary(df, [target])
    total = F.sum("rows").over(Window.partitionBy(F.lit(1)))
    pct = F.col("rows") / total * 100
    return counts.select("value", "rows", rnd(pct, 2).alias("pct_rows"), (pct >= 80).alias("is_dominant"))


def required_sample(p1: float = 0.20, p2: float = 0.25, effect: float | None = None, alpha: float = 0.05, power: float = 0.8) -> int:
    """Rows per group, normal approximation: Cohen's h for two proportions, or a given Cohen's d."""
    size = effect if effect is not None else 2 * math.asin(math.sqrt(p1)) - 2 * math.asin(math.sqrt(p2))
    z = dist.normal_ppf(1 - alpha / 2) + dist.normal_ppf(power)
    return math.ceil(2 * (z / size) ** 2)


def sample_size_adequacy(df: DataFrame, segment: str, per_group: int, buffer: float = 0.10) -> DataFrame:
    needed = math.ceil(per_group * (1 + buffer))
    return df.groupBy(F.col(segment).alias("segment")).agg(count_rows().alias("rows")).select(
        "segment", "rows", F.lit(needed).cast("bigint").alias("required_rows"),
        (F.col("rows") >= needed).alias("is_enough"),
        F.greatest(F.lit(needed) - F.col("rows"), F.lit(0)).cast("bigint").alias("missing_rows"),
    )


def little_mcar(df: DataFrame, columns: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Approximate test that nulls are completely at random, from per-pattern means and pairwise covariances."""
    spark = df.sparkSession
    cells = df.select(*[num(c).alias(f"x{i}") for i, c in enumerate(columns)])
    names = cells.columns
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    one = cells.agg(
        *[F.count(n).alias(f"n_{n}") for n in names],
        *[F.avg(n).alias(f"m_{n}") for n in names],
        *[F.covar_samp(names[i], names[j]).alias(f"c_{i}_{j}") for i, j in pairs],
        count_rows().alias("rows"),
    ).first()
    used = [i for i, n in enumerate(names) if one[f"n_{n}"] >= 5]
    schema = "method string, statistic double, dof int, p_value double, is_mcar_compatible boolean"
    if not used or all(one[f"n_{names[i]}"] == one["rows"] for i in used):
        return spark.createDataFrame([("little_mcar", 0.0, 0, 1.0, True)], schema)
    cov = np.zeros((len(names), len(names)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = one[f"c_{i}_{j}"] if one[f"c_{i}_{j}"] is not None else 0.0
    mean = np.array([one[f"m_{n}"] or 0.0 for n in names])
    pattern = F.concat(*[F.when(F.col(names[i]).isNull(), "1").otherwise("0") for i in used])
    groups = cells.groupBy(pattern.alias("pattern")).agg(
        count_rows().alias("n"), F.array(*[F.avg(names[i]) for i in used]).alias("means")
    )

    def distances(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each pattern's squared distance from the overall means, and its number of seen columns."""
        for part in parts:
            out = []
            for flags, n, means in zip(part["pattern"], part["n"], part["means"]):
                at = [j for j, flag in enumerate(flags) if flag == "0"]
                if at:
                    seen = [used[j] for j in at]
                    d = np.array([means[j] for j in at], dtype=float) - mean[seen]
                    out.append((n * float(d @ np.linalg.pinv(cov[np.ix_(seen, seen)]) @ d), len(seen)))
            yield pd.DataFrame(out, columns=["statistic", "dof"])

    total = groups.mapInPandas(distances, "statistic double, dof bigint").agg(F.sum("statistic").alias("s"), F.sum("dof").alias("d")).first()
    statistic, dof = total["s"] or 0.0, max((total["d"] or 0) - len(used), 1)
    p = dist.chi2_sf(statistic, dof)
    return spark.createDataFrame([("little_mcar", round(statistic, 4), dof, round(p, 4), p >= alpha)], schema)


def dataset_summary(df: DataFrame, target: str, leakage: DataFrame) -> DataFrame:
    """One row: rows, columns, target share, highest null share and leakage candidates."""
    worst = F.greatest(*[F.avg(F.col(c).isNull().cast("double")) for c in df.columns])
    base = df.agg(
        count_rows().alias("rows"), F.lit(len(df.columns)).alias("columns"),
        rnd(F.avg(num(target)) * 100, 2).alias("pct_target"), rnd(worst * 100, 2).alias("max_pct_null"),
    )
    return base.crossJoin(F.broadcast(leakage.agg(count_rows().alias("leakage_columns"))))


def audit(
    df: DataFrame,
    key: str,
    target: str | None = None,
    id_columns: Sequence[str] = (),
    date_columns: Sequence[str] = (),
    segments: Sequence[str] = (),
    missing_threshold: float = 0.3,
) -> dict[str, DataFrame]:
    """All audit tables plus a one-row ``summary``. The profile is computed once and shared."""
    report = materialize(quality_report(df, key), "quality")
    texts = category_columns(df)
    tables = {
        "quality": report,
        "high_null_columns": report.where(F.col("pct_null") >= missing_threshold * 100).select("column_name", "pct_null"),
        "duplicates": row_duplicates(df),
        "constants": constant_columns(df),
        "headers": header_audit(df),
    }
    if texts:
        tables["text_standards"] = text_standards(df, texts)
        tables["numeric_like"] = numeric_like_text(df, texts)
    if id_columns:
        tables["ids"] = id_uniqueness(df, id_columns)
    if date_columns:
        tables["dates"] = date_audit(df, date_columns)
        tables["date_coverage"] = date_coverage(df, date_columns[0])
    if target:
        tables["leakage"] = leakage_candidates(df, target)
    if segments:
        tables["segments"] = segment_coverage(df, segments, target)
        tables["sampling"] = coverage_alerts(tables["segments"])
    total = F.lit(len(df.columns)).alias("columns")
    summary = tables["duplicates"].select("rows", total, "pct_duplicates")
    for name, table in {
        "constant_columns": tables["constants"], "high_null_columns": tables["high_null_columns"],
        "leakage_columns": tables.get("leakage"),
        "segment_alerts": tables["sampling"].where("is_dominated or has_rare") if "sampling" in tables else None,
    }.items():
        if table is not None:
            summary = summary.crossJoin(F.broadcast(table.agg(count_rows().alias(name))))
    tables["summary"] = summary
    return tables


def tabular_alerts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row that counts the alerts of an ``audit``: headers, null tokens, dates, identifiers and numeric-like text."""
    parts = {
        "nonstandard_headers": tables["headers"].where("NOT is_standard"),
        "inconsistent_null_tokens": tables["text_standards"].where("null_tokens_inconsistent") if "text_standards" in tables else None,
        "dates_to_normalize": tables["dates"].where("needs_normalization") if "dates" in tables else None,
        "ids_with_duplicates": tables["ids"].where("NOT is_unique") if "ids" in tables else None,
        "numeric_like_columns": tables.get("numeric_like"),
    }
    out = None
    for name, part in parts.items():
        spark = tables["headers"].sparkSession
        one = part.agg(count_rows().alias(name)) if part is not None else spark.range(1).select(F.lit(0).cast("bigint").alias(name))
        out = one if out is None else out.crossJoin(F.broadcast(one))
    return out


def risk_flags(spark: SparkSession, facts: Mapping[str, float | bool | str | None]) -> DataFrame:
    """Traffic light and its meaning for each of twelve risk dimensions, from headline facts; every row is always there.

    Without folds, time validation is followed up; without intervals, uncertainty is; a blocked gate blocks
    calibration; without a fairness gap, fairness is in order.
    """
    get = facts.get
    low = lambda name, limit: get(name) is not None and get(name) <= limit
    blocked = get("decision") == "blocked"
    matrix_stable = (
        low("top_vif", math.nextafter(5, 0)) and low("top_condition_index", math.nextafter(30, 0)) and not get("critical_components") and not get("paradox")
    )
    follow = lambda good: "OK" if good else "Seguimiento"
    gap = get("fairness_max_gap")
    states = [
        ("missingness", "OK" if get("is_mcar_compatible") else "Alerta", "no sign of selective nulls", "nulls do not look random: keep imputing and watch their causes"),
        ("normality", follow(get("is_normal")), "parametric tests are defensible", "prefer rank tests or a transformation"),
        ("parsimony", follow((get("features_dropped") or 0) > 0), "the simpler model was enough", "no feature could be dropped"),
        ("drift", "OK" if get("severe_drift_columns") == 0 else "Alerta", "distributions are stable between the snapshots", "review the columns that drifted before the score is used more widely"),
        ("health", {"blocked": "Bloqueado", "degraded": "Alerta"}.get(get("decision"), "OK"), "the data may be modelled", "repair the data first"),
        ("temporal_validation", follow((get("folds") or 0) > 0 and low("std_roc_auc", 0.06)), "the score ranks alike over time", "the score varies over time, or no fold had enough rows"),
        ("calibration", "Bloqueado" if blocked else follow(low("brier_score", 0.16)), "probabilities may carry thresholds", "not calibrated: the gate is closed" if blocked else "watch probabilities by bin"),
        ("uncertainty", follow(low("mean_interval_width", 0.25)), "score intervals are narrow", "scores are uncertain: act on the lower bound"),
        ("coefficients", follow(matrix_stable), "coefficients can be read one by one", "collinearity or a reversal between groups: do not read coefficients causally"),
        ("tabular_contract", follow(get("tabular_alerts") == 0), "headers, types, dates and identifiers follow the contract", "mend the columns listed in the audit"),
        ("fairness", follow(gap is None or gap != gap or gap <= 0.10), "groups are treated alike", "groups differ in selection or error rates"),
        ("representativeness", follow(get("sampling_alerts") == 0), "no segment is dominant or rare", "sample or weight by segment"),
    ]
    rows = [(name, state, fine if state == "OK" else other) for name, state, fine, other in states]
    return spark.createDataFrame(rows, "dimension string, state string, implication string")
