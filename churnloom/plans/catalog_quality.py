"""Data quality and profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import standardize_names
from ..operators import charts, quality
from .base import CUSTOMERS, ORDERS_GAPS, customers, orders_gaps, table
from .registry import query, r

GAP_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
GAP_NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")


def union(parts) -> str:
    return " UNION ALL ".join(parts)


@query(f"WITH {ORDERS_GAPS} " + union(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, {r(f'avg(({c} IS NULL)::int)*100', 2)} AS pct_null, '{t}' AS data_type FROM orders_gaps"
    for c, t in GAP_TYPES.items()))
def null_profile(spark, sf):
    return quality.null_profile(orders_gaps(spark, sf))


@query(f"WITH {ORDERS_GAPS} " + union(
    f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, count(*) - count({c}) AS nulls,
    {r(f'(count(*) - count({c}))/count(*)*100', 2)} AS pct_null, count(DISTINCT {c}) AS distinct_values,
    {r(f'(1.0::double - (count(DISTINCT {c}) + max(({c} IS NULL)::int))/count(*))*100', 2)} AS pct_duplicate_values,
    (SELECT string_agg(v, ', ' ORDER BY o_orderkey) FROM (SELECT {c}::varchar AS v, o_orderkey FROM orders_gaps WHERE {c} IS NOT NULL ORDER BY o_orderkey LIMIT 3)) AS sample,
    {r(f'count(*) FILTER ({c} = 0)/count(*)*100', 2) if c in GAP_NUMBERS else 'NULL::double'} AS pct_zero FROM orders_gaps"""
    for c, t in GAP_TYPES.items()))
def quality_report(spark, sf):
    return quality.quality_report(orders_gaps(spark, sf), "o_orderkey", list(GAP_TYPES))


@query("""WITH c AS (SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
  SELECT sum(n)::bigint AS "rows", count(*) AS distinct_rows, (sum(n) - count(*))::bigint AS duplicate_rows,
  round_even((sum(n) - count(*))/sum(n)*100*1e2,0)/1e2 AS pct_duplicates FROM c""")
def row_duplicates(spark, sf):
    return quality.row_duplicates(table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query("""SELECT arg_min(o_orderkey, o_orderkey) AS o_orderkey, o_custkey, o_orderstatus, arg_min(o_totalprice, o_orderkey) AS o_totalprice
  FROM orders GROUP BY o_custkey, o_orderstatus""")
def duplicates_keep_first(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return quality.drop_duplicates(o, "first", "o_orderkey", ["o_custkey", "o_orderstatus"])


@query("""SELECT max(o_orderkey) AS o_orderkey, o_custkey, o_orderstatus, arg_max(o_totalprice, o_orderkey) AS o_totalprice
  FROM orders GROUP BY o_custkey, o_orderstatus""")
def duplicates_keep_last(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return quality.drop_duplicates(o, "last", "o_orderkey", ["o_custkey", "o_orderstatus"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) = 1")
def duplicates_drop_all(spark, sf):
    return quality.drop_duplicates(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "none")


@query(union(
    f"""SELECT '{c}' AS column_name, {r(f'count(DISTINCT {c})/count(*)*100', 2)} AS pct_unique,
    count(*) - count(DISTINCT {c}) AS duplicates, count(*) = count(DISTINCT {c}) AS is_unique FROM orders"""
    for c in ("o_orderkey", "o_custkey")))
def id_uniqueness(spark, sf):
    return quality.id_uniqueness(table(spark, sf, "orders"), ["o_orderkey", "o_custkey"])


@query("SELECT 'fixed' AS column_name UNION ALL SELECT 'empty'")
def constant_columns(spark, sf):
    o = table(spark, sf, "orders").withColumns({"fixed": F.lit("x"), "empty": F.lit(None).cast("double")})
    return quality.constant_columns(o)


@query(f"""WITH t AS (SELECT o_totalprice, o_custkey, o_totalprice*2.0 + 1.0 AS copy, o_orderstatus FROM orders)
  SELECT * FROM (SELECT 'copy' AS column_name, 'correlation' AS kind, {r('abs(corr(copy, o_totalprice))', 4)} AS strength FROM t
  UNION ALL SELECT 'o_custkey', 'correlation', {r('abs(corr(o_custkey, o_totalprice))', 4)} FROM t) WHERE strength >= 0.98""")
def leakage_candidates(spark, sf):
    o = table(spark, sf, "orders").select("o_totalprice", "o_custkey", (F.col("o_totalprice") * 2.0 + 1.0).alias("copy"), "o_orderstatus")
    return quality.leakage_candidates(o, "o_totalprice")


MESSY = """messy AS (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN lower(o_orderstatus) WHEN 1 THEN ' ' || o_orderstatus ELSE o_orderstatus END AS status,
         CASE o_orderkey % 50 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN 'null' ELSE o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 20 = 0 THEN 'unknown' WHEN o_orderkey % 3 = 0 THEN (floor(o_totalprice)::bigint // 1000)::varchar || '.' || lpad((floor(o_totalprice)::bigint % 1000)::varchar, 3, '0') || ',5'
              ELSE floor(o_totalprice)::bigint::varchar || '%' END AS price_text,
         CASE WHEN o_orderkey % 10 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text
  FROM orders)"""


def messy(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    whole = F.floor("o_totalprice").cast("bigint")
    dotted = F.concat(F.floor(whole / 1000).cast("string"), F.lit("."), F.lpad((whole % 1000).cast("string"), 3, "0"), F.lit(",5"))
    return o.select(
        k,
        F.when(k % 4 == 0, F.lower("o_orderstatus")).when(k % 4 == 1, F.concat(F.lit(" "), F.col("o_orderstatus"))).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 50 == 0, "NA").when(k % 50 == 1, "n/a").when(k % 50 == 2, "null").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 20 == 0, "unknown").when(k % 3 == 0, dotted).otherwise(F.concat(whole.cast("string"), F.lit("%"))).alias("price_text"),
        F.when(k % 10 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_text"),
    )


@query(f"WITH {MESSY} " + union(
    f"""SELECT '{c}' AS column_name, count(DISTINCT trim({c})) AS levels_original, count(DISTINCT lower(trim({c}))) AS levels_normalized,
    count(DISTINCT trim({c})) - count(DISTINCT lower(trim({c}))) AS case_space_variants,
    coalesce(string_agg(DISTINCT trim({c}), ' | ' ORDER BY trim({c})) FILTER (upper(trim({c})) IN ('NA','N/A','NULL','')), '') AS null_tokens,
    count(DISTINCT trim({c})) FILTER (upper(trim({c})) IN ('NA','N/A','NULL','')) > 1 AS null_tokens_inconsistent FROM messy"""
    for c in ("status", "priority")))
def text_standards(spark, sf):
    return quality.text_standards(messy(spark, sf), ["status", "priority"])


@query(f"""WITH {MESSY} SELECT 'price_text' AS column_name,
  {r("avg((try_cast(replace(regexp_replace(regexp_replace(price_text, '([0-9])[.]([0-9]{3})([^0-9]|$)', '\\1\\2\\3', 'g'), '([0-9]),([0-9])', '\\1.\\2', 'g'), '%', '') AS double) IS NOT NULL)::int)*100", 2)} AS pct_numeric FROM messy""")
def numeric_like_text(spark, sf):
    return quality.numeric_like_text(messy(spark, sf), ["status", "priority", "price_text"])


@query(f"""WITH {MESSY} SELECT 'date_text' AS column_name, {r("avg((try_cast(date_text AS timestamp) IS NOT NULL)::int)*100", 2)} AS pct_valid,
  count(DISTINCT regexp_replace(date_text, '[0-9]', '9', 'g')) AS patterns, true AS needs_normalization,
  min(try_cast(date_text AS timestamp)) AS date_min, max(try_cast(date_text AS timestamp)) AS date_max FROM messy""")
def date_audit(spark, sf):
    return quality.date_audit(messy(spark, sf), ["date_text"])


HEADERS = {"o_custkey": ("Cliente ID", "cliente_id"), "o_orderstatus": ("Región", "region"), "o_totalprice": ("total", "total"), "o_orderpriority": (" Gasto  Mensual ", "gasto_mensual")}


# The standard names must lead to the same data: nulls are counted under them.
@query(f"WITH {ORDERS_GAPS} " + union(
    f"SELECT '{old}' AS column_name, '{new}' AS standard_name, {str(old == new).lower()} AS is_standard, count(*) - count({c}) AS nulls FROM orders_gaps"
    for c, (old, new) in HEADERS.items()))
def header_audit(spark, sf):
    renamed = orders_gaps(spark, sf).select(*[F.col(c).alias(old) for c, (old, _) in HEADERS.items()])
    nulls = quality.null_profile(standardize_names(renamed)).select(F.col("column_name").alias("standard_name"), "nulls")
    return quality.header_audit(renamed).join(nulls, "standard_name")


DICT_ROLES = {
    "o_orderkey": ("identifier", "numeric"), "o_custkey": ("feature", "numeric"), "o_orderstatus": ("feature", "categorical"),
    "o_totalprice": ("target", "numeric"), "o_orderpriority": ("feature", "categorical"),
}


@query(f"WITH {ORDERS_GAPS} " + union(
    f"""SELECT {i}::int AS place, '{c}' AS column_name, '{c}' AS standard_name, '{DICT_ROLES[c][0]}' AS "role", '{DICT_ROLES[c][1]}' AS family,
    '{GAP_TYPES[c]}' AS data_type, {r(f'(count(*) - count({c}))/count(*)*100', 2)} AS pct_null, count(DISTINCT {c}) AS distinct_values,
    {r(f'(count(DISTINCT {c}) + max(({c} IS NULL)::int))/count(*)*100', 2)} AS pct_unique, count(*) > count({c}) AS nullable FROM orders_gaps"""
    for i, c in enumerate(DICT_ROLES)))
def data_dictionary(spark, sf):
    d = quality.data_dictionary(orders_gaps(spark, sf).select(*DICT_ROLES), "o_orderkey", ["o_orderkey"], "o_totalprice", [])
    return d.drop("sample", "description")


@query(f"""WITH {CUSTOMERS}, s AS (SELECT 'segment' AS dimension, segment AS "value", churned FROM people UNION ALL SELECT 'channel', channel, churned FROM people),
  g AS (SELECT dimension, "value", count(*) AS n, avg(churned)*100 AS t FROM s GROUP BY ALL)
  SELECT dimension, "value", {r('n/sum(n) OVER (PARTITION BY dimension)*100', 2)} AS pct_rows, n AS "rows", {r('t', 2)} AS pct_target FROM g""")
def segment_coverage(spark, sf):
    return quality.segment_coverage(customers(spark, sf), ["segment", "channel"], "churned")


@query(f"""WITH {CUSTOMERS}, s AS (SELECT 'segment' AS dimension, segment AS v FROM people UNION ALL SELECT 'premium', premium FROM people),
  g AS (SELECT dimension, v, count(*) AS n FROM s GROUP BY ALL),
  p AS (SELECT dimension, {r('n/sum(n) OVER (PARTITION BY dimension)*100', 2)} AS pct FROM g)
  SELECT dimension, max(pct) AS largest_pct, count(*) FILTER (pct < 5.0) AS rare_values, max(pct) >= 60 AS is_dominated, count(*) FILTER (pct < 5.0) > 0 AS has_rare,
  CASE WHEN max(pct) >= 60 OR count(*) FILTER (pct < 5.0) > 0 THEN 'muestreo_estratificado' ELSE 'muestreo_aleatorio_simple' END AS sampling FROM p GROUP BY dimension""")
def coverage_alerts(spark, sf):
    return quality.coverage_alerts(quality.segment_coverage(customers(spark, sf), ["segment", "premium"]))


@query("""WITH g AS (SELECT ts, floor((epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts)))/8.64e10)::bigint AS gap FROM events)
  SELECT 'ts' AS column_name, floor((epoch_us(max(ts)) - epoch_us(min(ts)))/8.64e10)::bigint AS days_covered, max(gap) AS longest_gap_days, 100.0::double AS pct_valid FROM g""")
def date_gap(spark, sf):
    return quality.date_coverage(table(spark, sf, "events"), "ts")


SPLIT = "cut AS (SELECT quantile_cont(epoch_us(o_orderdate), 0.65) AS c FROM orders), old AS (SELECT o.* FROM orders o, cut WHERE epoch_us(o_orderdate) <= c), new AS (SELECT o.* FROM orders o, cut WHERE epoch_us(o_orderdate) > c)"


@query(f"""WITH {SPLIT} SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM old) THEN 'reference' ELSE 'current' END AS snapshot FROM orders""")
def time_split(spark, sf):
    a, b = quality.time_split(table(spark, sf, "orders"), "o_orderdate")
    return a.select("o_orderkey", F.lit("reference").alias("snapshot")).unionByName(b.select("o_orderkey", F.lit("current").alias("snapshot")))


@query(f"""WITH {SPLIT}, a AS (SELECT count(*) AS rows_reference FROM old), b AS (SELECT count(*) AS rows_current FROM new)
  SELECT *, {r('(rows_current - rows_reference)/rows_reference*100', 2)} AS pct_deviation FROM a, b""")
def volume_drift(spark, sf):
    return quality.volume_drift(*quality.time_split(table(spark, sf, "orders"), "o_orderdate"))


@query("""SELECT * FROM (VALUES ('o_clerk', NULL, 'string', 'added'), ('o_custkey', 'bigint', 'bigint', 'same'), ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'same'),
  ('o_orderkey', 'bigint', 'string', 'type_changed'), ('o_orderpriority', 'string', 'string', 'same'), ('o_orderstatus', 'string', NULL, 'removed'), ('o_totalprice', 'double', 'double', 'same'))
  t(column_name, type_reference, type_current, change)""")
def schema_drift(spark, sf):
    old, new = quality.time_split(table(spark, sf, "orders"), "o_orderdate")
    new = new.withColumns({"o_clerk": F.lit("c"), "o_orderkey": F.col("o_orderkey").cast("string")}).drop("o_orderstatus")
    return quality.schema_drift(old, new)


def psi_sql(columns) -> str:
    ctes, parts = [SPLIT], []
    for c in columns:
        levels = ", ".join(f"{i / 10}" for i in range(11))
        ctes.append(f"e_{c} AS (SELECT list_sort(list_distinct(quantile_cont({c}::double, [{levels}]))) AS e FROM old)")
        for side in ("old", "new"):
            ctes.append(f"""b_{side}_{c} AS (SELECT len(list_filter(e, lambda x: x < {c})) AS bin, count(*) AS n FROM {side}, e_{c}
              WHERE {c} >= e[1] AND {c} <= e[len(e)] GROUP BY 1)""")
            ctes.append(f"m_{side}_{c} AS (SELECT greatest(bin, 1) AS bin, sum(n) AS n FROM b_{side}_{c} GROUP BY 1)")
            ctes.append(f"s_{side}_{c} AS (SELECT bin, n/sum(n) OVER () AS s FROM m_{side}_{c})")
        total = f"sum((coalesce(n.s,0) - coalesce(o.s,0)) * ln(greatest(coalesce(n.s,0),1e-6)/greatest(coalesce(o.s,0),1e-6)))"
        parts.append(f"SELECT '{c}' AS column_name, {r(total, 4)} AS psi, {total} >= 0.2 AS is_severe FROM s_old_{c} o FULL JOIN s_new_{c} n USING (bin)")
    return f"WITH {', '.join(ctes)} {union(parts)}"


@query(psi_sql(["o_totalprice", "o_orderkey", "o_custkey"]))
def psi_numeric(spark, sf):
    return quality.population_stability(*quality.time_split(table(spark, sf, "orders"), "o_orderdate"), ["o_totalprice", "o_orderkey", "o_custkey"])


PSI_TERM = "sum((coalesce(c,0) - coalesce(p,0)) * ln(greatest(coalesce(c,0),1e-6)/greatest(coalesce(p,0),1e-6)))"


@query(f"WITH {SPLIT} " + union(
    f"""SELECT '{c}' AS column_name, {r(PSI_TERM, 4)} AS psi, {PSI_TERM} >= 0.2 AS is_severe FROM
    (SELECT {c} AS v, count(*)/sum(count(*)) OVER () AS p FROM old GROUP BY 1) FULL JOIN (SELECT {c} AS v, count(*)/sum(count(*)) OVER () AS c FROM new GROUP BY 1) USING (v)"""
    for c in ("o_orderstatus", "o_orderpriority")))
def psi_categorical(spark, sf):
    return quality.population_stability(*quality.time_split(table(spark, sf, "orders"), "o_orderdate"), ["o_orderstatus", "o_orderpriority"])


@query(f"""WITH {ORDERS_GAPS}, b AS (SELECT {r("(epoch_us(TIMESTAMP '2001-08-10 06:00:00') - epoch_us(max(o_orderdate)))/3.6e9", 2)} AS h,
    {r("(count(*) FILTER (o_orderdate >= TIMESTAMP '2000-01-01') - 5000)/5000.0::double*100", 2)} AS d,
    {r('count(*) FILTER (o_totalprice IS NULL OR o_orderpriority IS NULL)/count(*)*100', 2)} AS e FROM orders_gaps),
  s AS (SELECT *, CASE WHEN h > 336 THEN 'critico' WHEN h > 168 THEN 'alerta' ELSE 'ok' END AS fs,
    CASE WHEN abs(d) > 75 THEN 'critico' WHEN abs(d) > 50 THEN 'alerta' ELSE 'ok' END AS cs,
    CASE WHEN e > 15 THEN 'critico' WHEN e > 10 THEN 'alerta' ELSE 'ok' END AS vs FROM b)
  SELECT 'orders' AS dataset, h AS freshness_hours, d AS pct_count_deviation, e AS pct_validation_errors, fs AS freshness_status, cs AS count_status, vs AS validation_status,
    CASE WHEN fs='ok' AND cs='ok' AND vs='ok' THEN 'ninguna' ELSE concat_ws(', ', CASE WHEN fs<>'ok' THEN 'frescura' END, CASE WHEN cs<>'ok' THEN 'conteo' END, CASE WHEN vs<>'ok' THEN 'validacion' END) END AS active_alerts,
    ((fs='critico')::int + (cs='critico')::int + (vs='critico')::int) AS critical_issues,
    CASE WHEN vs='critico' THEN 'critico' WHEN fs='ok' AND cs='ok' AND vs='ok' THEN 'ok' ELSE 'alerta' END AS severity,
    CASE WHEN vs='critico' THEN 'blocked' WHEN fs='ok' AND cs='ok' AND vs='ok' THEN 'allow' ELSE 'degraded' END AS decision FROM s""")
def data_health(spark, sf):
    return quality.pipeline_health(
        orders_gaps(spark, sf), "orders", "o_orderdate", ["o_totalprice", "o_orderpriority"],
        F.lit("2001-08-10 06:00:00").cast("timestamp_ntz"), 5000, quality.HEALTH_PROFILES["demo"],
        observed=F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"),
    )


@query(f"""WITH {ORDERS_GAPS}, e AS (SELECT {r('count(*) FILTER (o_totalprice IS NULL OR o_orderpriority IS NULL)/count(*)*100', 2)} AS e,
    {r("(count(*) FILTER (o_orderdate >= TIMESTAMP '2000-01-01') - 5000)/5000.0::double*100", 2)} AS d FROM orders_gaps),
  s AS (SELECT abs(d) > 40 AS cc, abs(d) > 20 AS ca, e > 10 AS vc, e > 5 AS va FROM e)
  SELECT 'orders' AS dataset, 'production' AS profile, CASE WHEN vc THEN 'critico' ELSE 'alerta' END AS severity, CASE WHEN vc THEN 'blocked' ELSE 'degraded' END AS decision,
  concat_ws(', ', 'frescura', CASE WHEN ca THEN 'conteo' END, CASE WHEN va THEN 'validacion' END) AS active_alerts, (1 + cc::int + vc::int) AS critical_issues, NOT vc AS modeling_enabled FROM s""")
def execution_gate(spark, sf):
    health = quality.pipeline_health(
        orders_gaps(spark, sf), "orders", "o_orderdate", ["o_totalprice", "o_orderpriority"],
        F.lit("2001-08-10 06:00:00").cast("timestamp_ntz"), 5000, quality.HEALTH_PROFILES["production"],
        observed=F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"),
    )
    return quality.execution_gate(health, "production")


@query(f"""SELECT o_orderstatus AS "value", count(*) AS "rows", {r('count(*)/sum(count(*)) OVER ()*100', 2)} AS pct_rows,
  count(*)/sum(count(*)) OVER ()*100 >= 80 AS is_dominant FROM orders GROUP BY 1""")
def target_balance(spark, sf):
    return quality.target_balance(table(spark, sf, "orders"), "o_orderstatus")


@query("""WITH n AS (SELECT ceil(1.1*ceil(2*pow((1.959963984540054 + 0.8416212335729143)/(2*asin(sqrt(0.2)) - 2*asin(sqrt(0.25))), 2)))::bigint AS n)
  SELECT c_mktsegment AS segment, count(*) AS "rows", any_value(n) AS required_rows, count(*) >= any_value(n) AS is_enough,
  greatest(any_value(n) - count(*), 0)::bigint AS missing_rows FROM customer, n GROUP BY 1""")
def sample_size_adequacy(spark, sf):
    return quality.sample_size_adequacy(table(spark, sf, "customer"), "c_mktsegment", quality.required_sample())


@query()
def little_mcar(spark, sf):
    li = table(spark, sf, "lineitem")
    return quality.little_mcar(
        li.select(
            F.when(F.col("l_orderkey") % 25 != 0, F.col("l_quantity")).alias("l_quantity"),
            F.when(F.col("l_discount") < 0.09, F.col("l_extendedprice")).alias("l_extendedprice"), "l_discount", "l_tax",
        ),
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    )


@query(f"""WITH {ORDERS_GAPS} SELECT count(*) AS "rows", 6 AS "columns", {r('avg(o_totalprice)*100', 2)} AS pct_target,
  {r('greatest(avg((o_totalprice IS NULL)::int), avg((o_orderpriority IS NULL)::int))*100', 2)} AS max_pct_null, 0::bigint AS leakage_columns FROM orders_gaps""")
def dataset_summary(spark, sf):
    o = orders_gaps(spark, sf)
    return quality.dataset_summary(o, "o_totalprice", quality.leakage_candidates(o, "o_totalprice"))


@query(f"WITH {ORDERS_GAPS}, k AS (SELECT *, floor(('0x' || substr(md5(concat(o_orderkey, '|42')), 1, 8))::bigint / 4294967296.0::double * 20)::int AS bucket FROM orders_gaps) " + union(
    f"""SELECT '{c}' AS column_name, bucket, count(*) AS "rows", {r(f'avg(({c} IS NULL)::int)*100', 2)} AS pct_null FROM k GROUP BY bucket"""
    for c in ("o_totalprice", "o_orderpriority")))
def chart_missingness(spark, sf):
    return charts.missingness_map(orders_gaps(spark, sf), "o_orderkey", ["o_totalprice", "o_orderpriority"])

