"""Descriptive, cleaning and transform queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import ACCENTED, PLAIN, accentless, prepared_targets, rnd
from ..operators import charts, clean, describe, impute, quality
from .base import CUSTOMERS, ORDERS_GAPS, customers, orders_gaps, table
from .registry import query, r

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def union(parts) -> str:
    return " UNION ALL ".join(parts)


@query(union(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg({c})', 3)} AS mean, {r(f'stddev_samp({c})', 3)} AS std, {r(f'min({c})', 3)} AS min,
    {r(f'max({c})', 3)} AS max, {r(f'skewness({c})', 3)} AS skewness, {r(f'kurtosis({c})', 3)} AS kurtosis, {r(f'quantile_cont({c}, 0.25)', 3)} AS q25,
    {r(f'quantile_cont({c}, 0.5)', 3)} AS q50, {r(f'quantile_cont({c}, 0.75)', 3)} AS q75, {r(f'quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)', 3)} AS iqr FROM lineitem"""
    for c in LINE))
def numeric_summary(spark, sf):
    return describe.numeric_summary(table(spark, sf, "lineitem"), LINE)


@query(f"WITH {ORDERS_GAPS}, " + ", ".join(
    f"""t_{c} AS (SELECT coalesce({c}, '<NA>') AS v, count(*) AS n FROM orders_gaps GROUP BY 1 ORDER BY n DESC, v LIMIT 3)""" for c in ("o_orderstatus", "o_orderpriority")) + " " + union(
    f"""SELECT '{c}' AS column_name, (SELECT count(DISTINCT {c}) FROM orders_gaps) AS distinct_values, (SELECT string_agg(v || ': ' || n, ', ' ORDER BY n DESC, v) FROM t_{c}) AS top_values"""
    for c in ("o_orderstatus", "o_orderpriority")))
def categorical_summary(spark, sf):
    return describe.categorical_summary(orders_gaps(spark, sf), ["o_orderstatus", "o_orderpriority"], 3)


@query(f"WITH {ORDERS_GAPS}, " + ", ".join(
    f"m_{c} AS (SELECT {c} AS v, count(*) AS n FROM orders_gaps GROUP BY 1 ORDER BY n DESC, {c} IS NULL, {c} LIMIT 1)" for c in ("o_orderstatus", "o_orderpriority")) + " " + union(
    f"""SELECT '{c}' AS column_name, (SELECT count(DISTINCT coalesce({c}, '<NA>')) FROM orders_gaps) AS distinct_values, v AS mode, n AS mode_rows FROM m_{c}"""
    for c in ("o_orderstatus", "o_orderpriority")))
def category_modes(spark, sf):
    return describe.category_modes(orders_gaps(spark, sf), ["o_orderstatus", "o_orderpriority"])


@query(f"""SELECT place, v AS "value", count(o_orderkey) AS "rows", {r('count(o_orderkey)/(SELECT count(*) FROM orders)*100', 2)} AS pct_rows
  FROM (VALUES (0::int,'O'),(1::int,'F'),(2::int,'P'),(3::int,'X')) t(place, v) LEFT JOIN orders ON o_orderstatus = v GROUP BY place, v""")
def value_shares(spark, sf):
    return describe.value_shares(table(spark, sf, "orders"), "o_orderstatus", ["O", "F", "P", "X"])


@query(f"""SELECT l_returnflag, {r('avg(l_extendedprice)', 2)} AS mean_price, {r('median(l_extendedprice)', 2)} AS median_price, count(*) AS "rows",
  {r('sum(l_quantity)', 2)} AS quantity, {r('avg((l_discount > 0)::int)', 2)} AS share_discounted FROM lineitem GROUP BY 1""")
def grouped_profile(spark, sf):
    li = table(spark, sf, "lineitem")
    middle = describe.quantile_table(li, ["l_extendedprice"], [0.5], ["l_returnflag"]).select("l_returnflag", rnd(F.col("value"), 2).alias("median_price"))
    means = describe.grouped(
        li, ["l_returnflag"],
        {"mean_price": F.avg("l_extendedprice"), "rows": F.count("*"), "quantity": F.sum("l_quantity"), "share_discounted": F.avg((F.col("l_discount") > 0).cast("double"))}, 2,
    )
    return means.join(middle, "l_returnflag")


@query(f"""WITH p AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_linestatus = 'F') GROUP BY ALL),
  g AS (SELECT * FROM (SELECT l_returnflag, sum(n) AS t FROM p GROUP BY 1), (SELECT DISTINCT l_linestatus FROM p))
  SELECT l_returnflag, l_linestatus, {r('coalesce(n, 0)/t', 3)} AS share FROM g LEFT JOIN p USING (l_returnflag, l_linestatus)""")
def crosstab_rows(spark, sf):
    li = table(spark, sf, "lineitem").where(~((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")))
    return describe.crosstab_shares(li, "l_returnflag", "l_linestatus")


PAIRS = [(a, b) for i, a in enumerate(LINE) for b in LINE[i + 1:]]


@query(union(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 4)} AS r FROM lineitem" for a, b in PAIRS))
def corr_matrix(spark, sf):
    return describe.correlation_matrix(table(spark, sf, "lineitem"), LINE)


RANKED = "ranked AS (SELECT " + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1)/2.0::double AS {c}" for c in LINE) + " FROM lineitem)"


@query(f"WITH {RANKED} " + union(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 4)} AS r FROM ranked" for a, b in PAIRS))
def corr_matrix_spearman(spark, sf):
    return describe.correlation_matrix(table(spark, sf, "lineitem"), LINE, "spearman")


NET = "round_even(l_extendedprice*(1.0::double - l_discount)*1e2,0)/1e2"
NET_RANKED = "ranked AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1)/2.0::double AS {c}" for c in [*LINE, "l_net"]
) + f" FROM (SELECT *, {NET} AS l_net FROM lineitem))"
NET_PAIRS = [(a, b) for i, a in enumerate([*LINE, "l_net"]) for b in [*LINE, "l_net"][i + 1 :]]


# The net price goes with the price, so one pair at least does depend.
@query(f"WITH {NET_RANKED}, m AS (" + union(f"SELECT '{a}' AS a, '{b}' AS b, abs({r(f'corr({a}, {b})', 4)}) AS abs_spearman FROM ranked" for a, b in NET_PAIRS) + ") SELECT * FROM m WHERE abs_spearman >= 0.65")
def dependent_pairs(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_net", rnd(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")), 2))
    return describe.dependent_pairs(rows, [*LINE, "l_net"])


GAP_PAIRS = [("o_totalprice", "o_totalprice"), ("o_totalprice", "o_custkey"), ("o_custkey", "o_custkey")]


@query(f"WITH {ORDERS_GAPS} " + union(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'covar_samp({a}, {b})', 4)} AS covariance, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM (SELECT o_totalprice/1e5 AS o_totalprice, o_custkey FROM orders_gaps)"
    for a, b in GAP_PAIRS))
def cov_matrix(spark, sf):
    o = orders_gaps(spark, sf).select((F.col("o_totalprice") / 1e5).alias("o_totalprice"), "o_custkey")
    return describe.covariance_matrix(o, ["o_totalprice", "o_custkey"])


@query(f"""WITH g AS (SELECT l_returnflag, count(*) AS n, avg(l_extendedprice) AS m, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1),
  t AS (SELECT avg(l_extendedprice) AS gm, var_pop(l_extendedprice)*count(*) AS sst FROM lineitem)
  SELECT count(*) AS groups, {r('sum(n*(m-gm)*(m-gm))/any_value(sst)', 4)} AS eta_squared, NULL::double AS cohen_d FROM g, t""")
def effect_sizes(spark, sf):
    return describe.effect_sizes(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")


@query(f"""WITH g AS (SELECT l_linestatus AS k, count(*) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS v FROM lineitem GROUP BY 1),
  a AS (SELECT * FROM g ORDER BY k LIMIT 1), b AS (SELECT * FROM g ORDER BY k DESC LIMIT 1), t AS (SELECT avg(l_quantity) AS gm, var_pop(l_quantity)*count(*) AS sst FROM lineitem)
  SELECT 2::bigint AS groups, {r('(a.n*(a.m-gm)*(a.m-gm) + b.n*(b.m-gm)*(b.m-gm))/sst', 4)} AS eta_squared,
  {r('(a.m-b.m)/sqrt(((a.n-1)*a.v + (b.n-1)*b.v)/(a.n+b.n-2))', 4)} AS cohen_d FROM a, b, t""")
def effect_size_two_groups(spark, sf):
    return describe.effect_sizes(table(spark, sf, "lineitem"), "l_quantity", "l_linestatus")


# --- outliers and imputation ----------------------------------------------------------------------

SPIKED = "spiked AS (SELECT o_orderkey, CASE WHEN o_orderkey % 25 = 0 THEN NULL WHEN o_orderkey % 40 = 1 THEN o_totalprice*4.5 ELSE o_totalprice END AS price, o_custkey FROM orders)"


def spiked(spark, sf):
    k = F.col("o_orderkey")
    price = F.when(k % 25 == 0, None).when(k % 40 == 1, F.col("o_totalprice") * 4.5).otherwise(F.col("o_totalprice"))
    return table(spark, sf, "orders").select(k, price.alias("price"), "o_custkey")


BOUNDS = SPIKED + """, q AS (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b, quantile_cont(price, 0.01) AS w1, quantile_cont(price, 0.99) AS w2 FROM spiked),
  bounds AS (SELECT a - 1.5*(b-a) AS lo, b + 1.5*(b-a) AS hi, w1, w2 FROM q)"""


@query(f"""WITH {BOUNDS}, c AS (SELECT quantile_cont(o_custkey, 0.25) - 1.5*(quantile_cont(o_custkey, 0.75) - quantile_cont(o_custkey, 0.25)) AS lo,
    quantile_cont(o_custkey, 0.75) + 1.5*(quantile_cont(o_custkey, 0.75) - quantile_cont(o_custkey, 0.25)) AS hi FROM spiked)
  SELECT 'price' AS column_name, {r('any_value(lo)', 4)} AS lower, {r('any_value(hi)', 4)} AS upper, count(*) FILTER (price < lo OR price > hi) AS outliers,
    {r('count(*) FILTER (price < lo OR price > hi)/count(price)*100', 2)} AS pct_outliers FROM spiked, bounds
  UNION ALL SELECT 'o_custkey', {r('any_value(lo)', 4)}, {r('any_value(hi)', 4)}, count(*) FILTER (o_custkey < lo OR o_custkey > hi), {r('count(*) FILTER (o_custkey < lo OR o_custkey > hi)/count(*)*100', 2)} FROM spiked, c""")
def outliers_iqr(spark, sf):
    return clean.outliers_iqr(spiked(spark, sf), ["price", "o_custkey"])


@query(f"WITH {BOUNDS} SELECT o_orderkey, {r('CASE WHEN price IS NOT NULL THEN greatest(least(price, hi), lo) END', 4)} AS price FROM spiked, bounds")
def clip_iqr(spark, sf):
    return clean.clip_iqr(spiked(spark, sf), ["price"]).select("o_orderkey", rnd(F.col("price"), 4).alias("price"))


@query(f"WITH {BOUNDS} SELECT o_orderkey, {r('CASE WHEN price IS NOT NULL THEN greatest(least(price, w2), w1) END', 4)} AS price FROM spiked, bounds")
def winsorize(spark, sf):
    return clean.handle_outliers(spiked(spark, sf), ["price"], "winsorize")[0].select("o_orderkey", rnd(F.col("price"), 4).alias("price"))


@query(f"""WITH {BOUNDS}, s1 AS (SELECT spiked.* FROM spiked, bounds WHERE price IS NULL OR price BETWEEN lo AND hi),
  q2 AS (SELECT quantile_cont(o_custkey, 0.25) AS a, quantile_cont(o_custkey, 0.75) AS b FROM s1)
  SELECT o_orderkey FROM s1, q2 WHERE o_custkey BETWEEN a - 1.5*(b-a) AND b + 1.5*(b-a)""")
def remove_iqr(spark, sf):
    return clean.handle_outliers(spiked(spark, sf), ["price", "o_custkey"], "remove_iqr")[0].select("o_orderkey")


@query(f"""WITH {BOUNDS}, p AS (SELECT {r('count(*) FILTER (price < lo OR price > hi)/count(*)*100', 2)} AS p FROM spiked, bounds)
  SELECT 'price' AS column_name, p AS pct_outliers, CASE WHEN p < 0.5 THEN 'winsorize' WHEN p <= 5 THEN 'transform' ELSE 'investigate' END AS action FROM p""")
def outlier_actions(spark, sf):
    report = clean.handle_outliers(spiked(spark, sf), ["price"], "clip_iqr")[1]
    return report.select("column_name", "pct_outliers", clean.outlier_action(F.col("pct_outliers")).alias("action"))


@query(f"""WITH {ORDERS_GAPS}, m AS (SELECT o_orderpriority AS v FROM orders_gaps WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
  SELECT o_orderkey, {r('coalesce(o_totalprice, (SELECT median(o_totalprice) FROM orders_gaps))', 4)} AS o_totalprice,
  coalesce(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority, coalesce(o_orderstatus, 'X') AS o_orderstatus FROM orders_gaps""")
def impute_median_mode(spark, sf):
    out = clean.fill_nulls(orders_gaps(spark, sf), {"o_orderstatus": "X"})
    return out.select("o_orderkey", rnd(F.col("o_totalprice"), 4).alias("o_totalprice"), "o_orderpriority", "o_orderstatus")


@query(f"""WITH {ORDERS_GAPS} SELECT 'mean' AS strategy, 2 AS "columns", (count(*) FILTER (o_totalprice IS NULL) + count(*) FILTER (o_orderpriority IS NULL))::bigint AS nulls_before, 0::bigint AS nulls_after FROM orders_gaps""")
def impute_null_change(spark, sf):
    o = orders_gaps(spark, sf)
    filled = clean.fill_nulls(o, strategy="mean", category_strategy="constant", constant="missing")
    return clean.null_change(o, filled, ["o_totalprice", "o_orderpriority"], "mean")


@query(f"""WITH {ORDERS_GAPS}, s AS (SELECT avg(coalesce(o_totalprice, 0)) AS m, stddev_pop(coalesce(o_totalprice, 0)) AS s FROM orders_gaps)
  SELECT o_orderkey, {r('(coalesce(o_totalprice, 0) - m)/s', 4)} AS o_totalprice_z FROM orders_gaps, s""")
def zscore(spark, sf):
    return clean.zscores(orders_gaps(spark, sf), ["o_totalprice"]).select("o_orderkey", rnd(F.col("o_totalprice_z"), 4).alias("o_totalprice_z"))


@query("""SELECT o_orderkey, (o_orderstatus = 'O')::int::double AS "o_orderstatus_O", (o_orderstatus = 'P')::int::double AS "o_orderstatus_P" FROM orders""")
def dummies(spark, sf):
    out, names = clean.dummies(table(spark, sf, "orders"), ["o_orderstatus"])
    return out.select("o_orderkey", *names)


@query(f"""WITH {ORDERS_GAPS}, l AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY o_orderpriority) - 1 AS c FROM (SELECT DISTINCT o_orderpriority FROM orders_gaps WHERE o_orderpriority IS NOT NULL))
  SELECT o_orderkey, coalesce(c, -1)::int AS o_orderpriority_code FROM orders_gaps LEFT JOIN l ON v = o_orderpriority""")
def category_codes(spark, sf):
    return clean.category_codes(orders_gaps(spark, sf), "o_orderpriority").select("o_orderkey", "o_orderpriority_code")


WEIGHTS = clean.fractional_weights()
ORDERED = f"""series AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS price FROM orders)"""


@query(f"WITH {ORDERED} SELECT o_orderkey, " + r(" + ".join(
    f"({w!r}::double)*" + ("price" if k == 0 else f"lag(price, {k}) OVER (ORDER BY o_orderdate, o_orderkey)") for k, w in enumerate(WEIGHTS)), 2) + " AS price_fracdiff FROM series")
def fracdiff(spark, sf):
    s = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 97 != 0, F.col("o_totalprice")).alias("price"))
    return clean.fractional_difference(s, ["price"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", rnd(F.col("price_fracdiff"), 2).alias("price_fracdiff"))


SHORT = clean.fractional_weights(max_window=4)


@query("SELECT o_orderkey, " + r(" + ".join(
    f"({w!r}::double)*" + ("o_totalprice" if k == 0 else f"lag(o_totalprice, {k}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)") for k, w in enumerate(SHORT)), 2) + " AS o_totalprice_fracdiff FROM orders")
def fracdiff_per_customer(spark, sf):
    out = clean.fractional_difference(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), ["o_totalprice"], ["o_orderdate", "o_orderkey"],
        max_window=4, partition_by=["o_custkey"],
    )
    return out.select("o_orderkey", rnd(F.col("o_totalprice_fracdiff"), 2).alias("o_totalprice_fracdiff"))


# Customers have about ten orders each, so the full window is checked on larger groups.
@query("SELECT o_orderkey, " + r(" + ".join(
    f"({w!r}::double)*" + ("o_totalprice" if k == 0 else f"lag(o_totalprice, {k}) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)") for k, w in enumerate(WEIGHTS)), 2) + " AS o_totalprice_fracdiff FROM orders")
def fracdiff_per_priority(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    out = clean.fractional_difference(o, ["o_totalprice"], ["o_orderdate", "o_orderkey"], partition_by=["o_orderpriority"])
    return out.select("o_orderkey", rnd(F.col("o_totalprice_fracdiff"), 2).alias("o_totalprice_fracdiff"))


@query("""SELECT * FROM (SELECT o_orderkey, lag(o_totalprice, 1) OVER w AS lag_1, lag(o_totalprice, 2) OVER w AS lag_2, lag(o_totalprice, 4) OVER w AS seasonal_lag_4,
  CASE WHEN count(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
  THEN round_even(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)*1e2,0)/1e2 END AS rolling_mean_3
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE seasonal_lag_4 IS NOT NULL""")
def lag_features(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.col("o_totalprice").alias("p"))
    out, _ = clean.lag_features(o, "p", ["o_custkey"], ["o_orderdate", "o_orderkey"], 2, 4)
    return out.select(
        "o_orderkey", F.col("p_lag_1").alias("lag_1"), F.col("p_lag_2").alias("lag_2"), F.col("p_seasonal_lag_4").alias("seasonal_lag_4"),
        rnd(F.col("p_rolling_mean_3"), 2).alias("rolling_mean_3"),
    )


@query()
def power_transform(spark, sf):
    return clean.compare_power_transforms(table(spark, sf, "lineitem"), "l_extendedprice")


@query("""WITH q AS (SELECT list_sort(list_distinct(quantile_cont(l_quantity, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM lineitem)
  SELECT bin, count(*) AS "rows", min(l_quantity) AS low, max(l_quantity) AS high FROM (SELECT (greatest(len(list_filter(e, lambda x: x < l_quantity)), 1) - 1)::int AS bin, l_quantity FROM lineitem, q) GROUP BY bin""")
def quantile_bins(spark, sf):
    out, _ = clean.equal_frequency_bins(table(spark, sf, "lineitem"), "l_quantity", 5)
    return out.groupBy("bin").agg(F.count("*").alias("rows"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))


@query("""SELECT CASE WHEN l_quantity <= 10 THEN '<=10' WHEN l_quantity <= 25 THEN '(10,25]' WHEN l_quantity <= 40 THEN '(25,40]' ELSE '>40' END AS bucket, count(*) AS "rows" FROM lineitem GROUP BY 1""")
def fixed_bins(spark, sf):
    return table(spark, sf, "lineitem").groupBy(clean.fixed_bins(F.col("l_quantity"), [10, 25, 40]).alias("bucket")).agg(F.count("*").alias("rows"))


TARGET_WORDS = "WHEN t IN ('si', 'sí', 's', '1', 'true', 'yes', 'y') THEN 1 WHEN t IN ('no', 'n', '0', 'false') THEN 0"
_RAW = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN ' SÍ ' WHEN 1 THEN 'true' WHEN 2 THEN 'No' WHEN 3 THEN '2.5' ELSE 'maybe' END AS mixed,
  CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'n' END AS words, o_totalprice::VARCHAR AS numbers FROM orders"""


def _target_sql(c: str) -> str:
    """Words first; numbers only where a value is no word and all values parse."""
    words = f"(CASE {TARGET_WORDS.replace('t IN', f'lower(trim({c})) IN')} END)"
    all_words, all_numbers = f"(bool_and({words} IS NOT NULL) OVER ())", f"(bool_and(try_cast({c} AS DOUBLE) IS NOT NULL) OVER ())"
    return f"CASE WHEN NOT {all_words} AND {all_numbers} THEN trunc(try_cast({c} AS DOUBLE))::BIGINT ELSE {words}::BIGINT END AS {c}"


@query(f"""WITH raw AS ({_RAW}) SELECT o_orderkey, {', '.join(map(_target_sql, ('mixed', 'words', 'numbers')))} FROM raw""")
def prepare_target(spark, sf):
    k = F.col("o_orderkey") % 5
    raw = table(spark, sf, "orders").select(
        "o_orderkey", F.when(k == 0, " SÍ ").when(k == 1, "true").when(k == 2, "No").when(k == 3, "2.5").otherwise("maybe").alias("mixed"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("n").alias("words"), F.col("o_totalprice").cast("string").alias("numbers"),
    )
    return prepared_targets(raw, ["mixed", "words", "numbers"])


@query(f"""SELECT doc_id, md5(translate(text, '{ACCENTED}', '{PLAIN}')) AS plain_md5, text = translate(text, '{ACCENTED}', '{PLAIN}') AS was_plain FROM documents""")
def plain_text(spark, sf):
    plain = accentless(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(plain.cast("binary")).alias("plain_md5"), (F.col("text") == plain).alias("was_plain"))


# Gaps in two columns, so that donors have gaps too and distances run over what both rows have.
@query(f"""WITH {CUSTOMERS}, g AS (SELECT customer_id, CASE WHEN customer_id % 25 <> 0 THEN balance END AS b, frequency::double AS f,
    CASE WHEN customer_id % 40 <> 3 THEN age::double END AS a FROM people),
  ask AS (SELECT * FROM g WHERE b IS NULL),
  d AS (SELECT q.customer_id, x.customer_id AS donor, x.b, sqrt(((q.f - x.f)*(q.f - x.f) + coalesce((q.a - x.a)*(q.a - x.a), 0)) * 3.0::double / CASE WHEN q.a - x.a IS NULL THEN 1 ELSE 2 END) AS dist
    FROM ask q, g x WHERE x.b IS NOT NULL),
  near AS (SELECT customer_id, b, row_number() OVER (PARTITION BY customer_id ORDER BY dist, donor::varchar) AS place FROM d),
  fill AS (SELECT customer_id, avg(b) AS b FROM near WHERE place <= 5 GROUP BY 1)
  SELECT customer_id, {r('coalesce(g.b, fill.b)', 2)} AS balance FROM g LEFT JOIN fill USING (customer_id)""")
def knn_impute(spark, sf):
    k = F.col("customer_id")
    c = customers(spark, sf).select("customer_id", "frequency", F.when(k % 40 != 3, F.col("age")).alias("age"), F.when(k % 25 != 0, F.col("balance")).alias("balance"))
    out = impute.knn_impute(c, "customer_id", ["balance", "frequency", "age"])
    return out.select("customer_id", rnd(F.col("balance"), 2).alias("balance"))


@query()
def mice_impute(spark, sf):
    o = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_orderkey") % 25 != 0, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_orderkey") % 30 != 1, F.col("l_quantity")).alias("quantity"), "l_discount",
    )
    out, rounds = impute.mice_impute(o, ["price", "quantity", "l_discount"])
    return out.groupBy("o_orderkey").agg(
        F.count("*").alias("rows"), rnd(F.avg("price"), 2).alias("mean_price"), rnd(F.avg("quantity"), 2).alias("mean_quantity"), F.lit(rounds).alias("rounds")
    )


# --- chart data -------------------------------------------------------------------------------------


@query(union(
    f"""SELECT '{c}' AS column_name, bin, {r('lo + bin*step', 4)} AS bin_low, count(*) AS "rows" FROM
    (SELECT lo, step, least(floor(({c} - lo)/step), 9)::int AS bin FROM lineitem, (SELECT min({c}) AS lo, (max({c}) - min({c}))/10 AS step FROM lineitem)) GROUP BY bin, lo, step"""
    for c in ("l_extendedprice", "l_quantity")))
def chart_histogram(spark, sf):
    return charts.histogram(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], 10)


@query()
def chart_power_histograms(spark, sf):
    return charts.transform_histograms(table(spark, sf, "lineitem"), "l_extendedprice", bins=10)


@query(f"""WITH q AS (SELECT l_returnflag AS g, quantile_cont(l_extendedprice, 0.25) AS a, median(l_extendedprice) AS m, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem GROUP BY 1)
  SELECT g AS "group", count(*) AS "rows", {r('min(l_extendedprice) FILTER (l_extendedprice >= a - 1.5*(b-a))', 4)} AS whisker_low, {r('any_value(a)', 4)} AS q25, {r('any_value(m)', 4)} AS q50,
  {r('any_value(b)', 4)} AS q75, {r('max(l_extendedprice) FILTER (l_extendedprice <= b + 1.5*(b-a))', 4)} AS whisker_high,
  count(*) FILTER (l_extendedprice < a - 1.5*(b-a) OR l_extendedprice > b + 1.5*(b-a)) AS outside FROM lineitem JOIN q ON g = l_returnflag GROUP BY g""")
def chart_box_by_group(spark, sf):
    return charts.five_numbers(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")


@query("""WITH d AS (SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority, floor(o_totalprice/1e5)*1e5 AS price FROM orders),
  q AS (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b FROM d)
  SELECT o_orderstatus, count(*) AS "rows", round_even(sum(greatest(least(price, b + 1.5*(b-a)), a - 1.5*(b-a)))*1e2,0)/1e2 AS total FROM d, q GROUP BY 1""")
def etl_clean(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", (F.floor(F.col("o_totalprice") / 1e5) * 1e5).alias("price"))
    out, _ = clean.etl(o, ["price"])
    return out.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), rnd(F.sum("price"), 2).alias("total"))


@query(f"""WITH {CUSTOMERS} SELECT segment, count(*) AS "rows", {r('avg(churned)*100', 2)} AS pct_churned, min(last_order) AS first_last_order, max(last_order) AS last_last_order,
  {r('avg(score)', 4)} AS mean_score, {r('avg(return_rate)', 4)} AS mean_return_rate, sum(n_events)::bigint AS events FROM people GROUP BY 1""")
def customer_overview(spark, sf):
    return customers(spark, sf).groupBy("segment").agg(
        F.count("*").alias("rows"), rnd(F.avg("churned") * 100, 2).alias("pct_churned"), F.min("last_order").alias("first_last_order"),
        F.max("last_order").alias("last_last_order"), rnd(F.avg("score"), 4).alias("mean_score"), rnd(F.avg("return_rate"), 4).alias("mean_return_rate"),
        F.sum("n_events").alias("events"),
    )


@query("SELECT column_name FROM (VALUES ('o_custkey'), ('o_orderdate'), ('o_orderkey'), ('o_totalprice')) t(column_name) WHERE (SELECT count(*) FROM orders) > 0")
def zero_variance_drop(spark, sf):
    o = table(spark, sf, "orders").withColumn("flat", F.lit(3.0))
    flat = quality.zero_variance_columns(o, ["o_custkey", "o_orderkey", "o_totalprice", "flat"])
    kept = [c for c in o.columns if c not in flat and c not in ("o_orderstatus", "o_orderpriority")]
    return spark.createDataFrame([(c,) for c in sorted(kept)], "column_name string")
