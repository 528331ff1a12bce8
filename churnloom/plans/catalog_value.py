"""Customer value queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import rnd
from ..operators import value
from .base import HISTORY, purchase_history
from .registry import query, r

TYPICAL = """typical AS (SELECT greatest(median(monetary), 18.0) AS m FROM history
  WHERE frequency > 0 AND recency >= 0 AND recency <= age AND age > 0 AND monetary > 0)"""

CLV = f"""clv AS (
  SELECT customer_id, frequency, recency, age, days_since_last, alive, value,
         greatest(alive * ((frequency + 1.0::double) / age) * 180.0 * ((frequency + 1.0::double) / (frequency + 3.5::double)), 0.0) AS tx6,
         greatest(alive * ((frequency + 1.0::double) / age) * 360.0 * ((frequency + 1.0::double) / (frequency + 3.5::double)), 0.0) AS tx12
  FROM (SELECT h.*, least(greatest(1.0/(1.0+exp(-(-1.35::double + 2.85::double*(recency/age::double) + 0.55::double*ln(1.0::double+frequency)))), 0.03), 0.995) AS alive,
               CASE WHEN frequency > 0 THEN (frequency*monetary + 3.0::double*m) / (frequency + 3.0::double) ELSE m*0.85::double END AS value
        FROM history h, typical))"""


@query(f"WITH {HISTORY} SELECT customer_id, frequency, recency, age, days_since_last, {r('monetary', 2)} AS monetary FROM history")
def rfmt_summary(spark, sf):
    return purchase_history(spark, sf).withColumn("monetary", rnd(F.col("monetary"), 2))


@query(f"""WITH {HISTORY} SELECT * FROM (
  SELECT 'age_positive' AS "check", {r('avg((age <= 0)::int)*100', 4)} AS pct_invalid, count(*) FILTER (age <= 0) AS invalid_rows FROM history
  UNION ALL SELECT 'frequency_not_negative', {r('avg((frequency < 0)::int)*100', 4)}, count(*) FILTER (frequency < 0) FROM history
  UNION ALL SELECT 'recency_inside_age', {r('avg((recency < 0 OR recency > age)::int)*100', 4)}, count(*) FILTER (recency < 0 OR recency > age) FROM history
  UNION ALL SELECT 'repeaters_have_value', {r('avg((frequency > 0 AND monetary <= 0)::int)*100', 4)}, count(*) FILTER (frequency > 0 AND monetary <= 0) FROM history)""")
def rfmt_structure_audit(spark, sf):
    return value.rfmt_structure_audit(purchase_history(spark, sf))


@query(f"""WITH {HISTORY} SELECT count(*) AS repeaters, {r('corr(frequency, monetary)', 4)} AS pearson_r,
  abs(corr(frequency, monetary)) <= 0.30 AS is_independent FROM history WHERE frequency > 0 AND monetary > 0""")
def clv_independence(spark, sf):
    return value.value_independence(purchase_history(spark, sf))


@query(f"""WITH {HISTORY}, {TYPICAL}, {CLV}
  SELECT customer_id, frequency, recency, age, {r('alive', 4)} AS p_alive, {r('value', 2)} AS expected_value,
         {r('tx6', 4)} AS expected_transactions_6m, {r('tx12', 4)} AS expected_transactions_12m,
         {r('tx6*value/pow(1.01::double,6)', 2)} AS clv_6m, {r('tx12*value/pow(1.01::double,12)', 2)} AS clv_12m, 'shrinkage' AS clv_engine
  FROM clv""")
def clv_shrinkage(spark, sf):
    return value.clv_shrinkage(purchase_history(spark, sf)).drop("days_since_last", "monetary")


@query(f"""WITH {HISTORY}, {TYPICAL}, {CLV} SELECT 'shrinkage' AS engine, count(*) AS customers, {r(f"avg({r('alive', 4)})", 4)} AS mean_p_alive,
  {r(f"avg({r('tx12*value/pow(1.01::double,12)', 2)})", 2)} AS mean_clv, {r(f"avg({r('value', 2)})", 2)} AS mean_expected_value FROM clv""")
def clv_summary(spark, sf):
    return value.clv_summary(value.clv_shrinkage(purchase_history(spark, sf)), 12)


@query(f"WITH {HISTORY} SELECT customer_id, {r('monetary*frequency*0.5', 2)} AS clv_heuristic_6m FROM history")
def clv_heuristic(spark, sf):
    return purchase_history(spark, sf).select(
        "customer_id", rnd(value.clv_heuristic(F.col("monetary"), F.col("frequency"), 6), 2).alias("clv_heuristic_6m")
    )


@query(f"""WITH {HISTORY}, {TYPICAL}, {CLV}, g AS (
  SELECT customer_id, {r('tx12*value/pow(1.01::double,12)', 2)} AS clv, {r('h.monetary*h.frequency', 2)} AS model
  FROM clv JOIN history h USING (customer_id))
  SELECT customer_id, CASE WHEN abs(model) > 1 THEN {r('(clv - model)/abs(model)', 4)} END AS relative_gap FROM g""")
def clv_model_gap(spark, sf):
    rows = value.clv_shrinkage(purchase_history(spark, sf))
    model = rnd(value.clv_heuristic(F.col("monetary"), F.col("frequency"), 12), 2)
    return rows.select("customer_id", value.relative_gap(F.col("clv_12m"), model).alias("relative_gap"))


@query()
def clv_bgnbd(spark, sf):
    return value.clv_bgnbd(purchase_history(spark, sf)).drop("monetary")
