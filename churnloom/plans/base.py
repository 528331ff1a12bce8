"""Input tables of the registered queries, and the same definitions as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import clip, count_rows, rnd, sigmoid
from ..operators.skew import with_group_values
from ..operators.value import rfmt_summary

SNAPSHOT = "2000-08-01"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def orders_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with nulls put in by key."""
    o = table(spark, sf, "orders")
    return o.withColumns(
        {
            "o_totalprice": F.when(F.col("o_orderkey") % 25 != 0, F.col("o_totalprice")),
            "o_orderpriority": F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderpriority")),
        }
    )


ORDERS_GAPS = """orders_gaps AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 25 <> 0 THEN o_totalprice END AS o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 40 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM orders)"""


def purchase_history(spark: SparkSession, sf: str, cutoff: str = "2001-12-31") -> DataFrame:
    return rfmt_summary(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice", F.lit(cutoff).cast("date"))


HISTORY = """history AS (
  SELECT o_custkey AS customer_id, count(*) - 1 AS frequency,
         datediff('day', min(o_orderdate)::date, max(o_orderdate)::date) AS recency,
         datediff('day', min(o_orderdate)::date, DATE '2001-12-31') AS age,
         datediff('day', max(o_orderdate)::date, DATE '2001-12-31') AS days_since_last,
         avg(o_totalprice) AS monetary
  FROM orders WHERE o_orderdate::date <= DATE '2001-12-31' GROUP BY o_custkey)"""


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer with orders up to the snapshot; ``churned`` means none in the year after it."""
    cut = F.lit(SNAPSHOT).cast("date")
    day, price = F.to_date("o_orderdate"), F.col("o_totalprice")
    seen = day <= cut
    orders = table(spark, sf, "orders")
    first, last = F.min(F.when(seen, day)), F.max(F.when(seen, day))
    # History up to the snapshot and the outcome after it, from one pass over the orders.
    history = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        (F.count_if(seen) - 1).alias("frequency"),
        F.datediff(last, first).cast("bigint").alias("recency"),
        F.datediff(cut, first).cast("bigint").alias("age"),
        F.datediff(cut, last).cast("bigint").alias("days_since_last"),
        F.avg(F.when(seen, price)).alias("monetary"),
        F.sum(F.when(seen & (day > F.date_sub(cut, 365)), price).otherwise(0.0)).alias("v12"),
        F.count_if(~seen & (day <= F.date_add(cut, 365))).alias("later"),
    ).where(F.col("frequency") >= 0)
    known = orders.where(seen).select("o_orderkey", "o_custkey")
    items = (
        table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
        .groupBy("l_orderkey").agg(count_rows().alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("b"))
        .join(known, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("customer_id")).agg(F.sum("n").alias("items"), F.sum("b").alias("returned"))
    )
    activity = table(spark, sf, "events").groupBy(F.col("user_id").alias("customer_id")).agg(
        count_rows().alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_errors")
    )
    people = table(spark, sf, "customer").withColumnRenamed("c_custkey", "customer_id")
    # All are one row per customer after map-side combined aggregations on the customer key.
    base = (
        history.join(people, "customer_id")
        .join(items, "customer_id", "left").join(activity, "customer_id", "left")
    )
    nation, key = F.col("c_nationkey"), F.col("customer_id")
    yes = lambda c: F.when(c, "Si").otherwise("No")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rate = F.when(zero("items") > 0, zero("returned") / F.col("items")).otherwise(0.0)
    out = base.select(
        key, F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), nation.alias("nation"),
        "frequency", "recency", "age", "days_since_last", rnd(F.col("monetary"), 2).alias("monetary"),
        rnd(F.col("v12"), 2).alias("value_12m"), zero("items").alias("items"), rnd(rate, 4).alias("return_rate"),
        zero("n_events").alias("n_events"), zero("n_errors").alias("n_errors"),
        F.date_sub(cut, F.col("days_since_last").cast("int")).alias("last_order"),
        F.when(nation % 3 == 0, "Sucursal").when(nation % 3 == 1, "Mixto").otherwise("Digital").alias("channel"),
        yes(key % 3 != 0).alias("payroll"), yes(F.col("c_acctbal") > 7000).alias("premium"), yes(nation % 4 == 0).alias("mortgage"),
        yes(zero("n_events") > 0).alias("app"), (F.col("later") == 0).cast("int").alias("churned"),
    )
    line = F.lit(-1.6) + 0.0022 * F.col("days_since_last") - 0.15 * F.log(F.col("frequency") + 1.0) + 0.8 * F.col("return_rate")
    return out.withColumn("score", rnd(clip(sigmoid(line), 0.01, 0.99), 4))


CUSTOMERS = f"""people AS (
  WITH h AS (SELECT o_custkey AS customer_id, count(*) - 1 AS frequency,
                    datediff('day', min(o_orderdate)::date, max(o_orderdate)::date) AS recency,
                    datediff('day', min(o_orderdate)::date, DATE '{SNAPSHOT}') AS age,
                    datediff('day', max(o_orderdate)::date, DATE '{SNAPSHOT}') AS days_since_last,
                    avg(o_totalprice) AS monetary
             FROM orders WHERE o_orderdate::date <= DATE '{SNAPSHOT}' GROUP BY 1),
  e AS (SELECT o_custkey AS customer_id,
               sum(CASE WHEN o_orderdate::date <= DATE '{SNAPSHOT}' AND o_orderdate::date > DATE '{SNAPSHOT}' - 365 THEN o_totalprice ELSE 0.0 END) AS v12,
               count(*) FILTER (o_orderdate::date > DATE '{SNAPSHOT}' AND o_orderdate::date <= DATE '{SNAPSHOT}' + 365) AS later
        FROM orders GROUP BY 1),
  i AS (SELECT o_custkey AS customer_id, count(*) AS items, count(*) FILTER (l_returnflag = 'R') AS returned
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate::date <= DATE '{SNAPSHOT}' GROUP BY 1),
  v AS (SELECT user_id AS customer_id, count(*) AS n_events, count(*) FILTER (event_type = 'error') AS n_errors FROM events GROUP BY 1),
  b AS (SELECT h.customer_id, c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation, frequency, recency, age,
               days_since_last, round_even(monetary*1e2,0)/1e2 AS monetary, round_even(v12*1e2,0)/1e2 AS value_12m,
               coalesce(items,0)::bigint AS items,
               round_even((CASE WHEN coalesce(items,0) > 0 THEN returned / items::double ELSE 0.0 END)*1e4,0)/1e4 AS return_rate,
               coalesce(n_events,0)::bigint AS n_events, coalesce(n_errors,0)::bigint AS n_errors,
               DATE '{SNAPSHOT}' - days_since_last::int AS last_order,
               CASE c_nationkey % 3 WHEN 0 THEN 'Sucursal' WHEN 1 THEN 'Mixto' ELSE 'Digital' END AS channel,
               CASE WHEN h.customer_id % 3 <> 0 THEN 'Si' ELSE 'No' END AS payroll,
               CASE WHEN c_acctbal > 7000 THEN 'Si' ELSE 'No' END AS premium,
               CASE WHEN c_nationkey % 4 = 0 THEN 'Si' ELSE 'No' END AS mortgage,
               CASE WHEN coalesce(n_events,0) > 0 THEN 'Si' ELSE 'No' END AS app,
               CASE WHEN later = 0 THEN 1 ELSE 0 END AS churned
        FROM h JOIN e USING (customer_id) JOIN customer ON c_custkey = h.customer_id
        LEFT JOIN i USING (customer_id) LEFT JOIN v USING (customer_id))
  SELECT *, round_even(least(greatest(1.0/(1.0+exp(-(-1.6::double + 0.0022::double*days_since_last - 0.15::double*ln(frequency+1.0::double) + 0.8::double*return_rate))),0.01),0.99)*1e4,0)/1e4 AS score
  FROM b)"""


def line_events(spark: SparkSession, sf: str) -> DataFrame:
    """Competitors of an order: its lines. The winner has the highest price; scores come from other columns.

    Order and line number do not identify a row, so the key is a hash of the whole line.
    """
    li = table(spark, sf, "lineitem")
    text = F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.format_string("%.2f", "l_extendedprice"),
                       F.format_string("%.2f", "l_discount"), F.format_string("%.2f", "l_tax"), F.col("l_quantity").cast("int"))
    rows = li.select(
        F.col("l_orderkey").alias("event_id"), F.md5(text.cast("binary")).alias("competitor"), "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag",
        rnd(F.col("l_quantity") / 10.0 - F.col("l_discount") * 5.0 + F.col("l_tax"), 4).alias("score"),
    )
    best = with_group_values(rows, ["event_id"], {"_best": F.max("l_extendedprice")})
    return best.withColumn("target", (F.col("l_extendedprice") == F.col("_best")).cast("int")).drop("_best")


LINE_EVENTS = """rivals AS (
  SELECT l_orderkey AS event_id,
         md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, printf('%.2f', l_extendedprice), printf('%.2f', l_discount),
             printf('%.2f', l_tax), l_quantity::int)) AS competitor,
         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
         round_even((l_quantity/10.0 - l_discount*5.0 + l_tax)*1e4,0)/1e4 AS score,
         CASE WHEN l_extendedprice = max(l_extendedprice) OVER (PARTITION BY l_orderkey) THEN 1 ELSE 0 END AS target
  FROM lineitem)"""
