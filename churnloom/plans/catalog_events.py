"""Ranking inside events, score metrics and time folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import rnd
from ..operators import charts, events, ordered, scoring
from ..operators.clean import fixed_bins
from ..operators.skew import attach
from ..session import materialize
from .base import CUSTOMERS, LINE_EVENTS, customers, line_events, table
from .registry import query, r

SOFT = f"""{LINE_EVENTS}, soft AS (
  SELECT *, exp(score - max(score) OVER (PARTITION BY event_id)) / sum(exp(score - mx)) OVER (PARTITION BY event_id) AS p
  FROM (SELECT *, max(score) OVER (PARTITION BY event_id) AS mx FROM rivals)),
  soft6 AS (SELECT event_id, competitor, target, l_extendedprice, {r('p', 6)} AS probability FROM soft)"""


def scored_events(spark, sf):
    """Competitors and their scored events, each written once: the queries read them several times."""
    out = events.event_softmax(materialize(line_events(spark, sf), "rivals"), "event_id", "score")
    return materialize(out.withColumn("probability", rnd(F.col("probability"), 6)), "scored")


@query(f"WITH {SOFT} SELECT event_id, competitor, {r('p', 4)} AS probability FROM soft")
def event_softmax(spark, sf):
    out = events.event_softmax(line_events(spark, sf), "event_id", "score")
    return out.select("event_id", "competitor", rnd(F.col("probability"), 4).alias("probability"))


METRICS = f"""{SOFT}, c AS (SELECT event_id, competitor, target, least(greatest(probability, 1e-12), 1.0) AS p FROM soft6),
  h AS (SELECT event_id, count(*) AS n, max(p) FILTER (target = 1) AS wp, max(competitor) FILTER (target = 1) AS wk, avg((p-target)*(p-target)) AS brier
        FROM c GROUP BY 1 HAVING count(*) >= 2 AND sum(target) = 1),
  m AS (SELECT event_id, any_value(n) AS n, any_value(wp) AS wp, any_value(brier) AS brier, count(*) FILTER (p > wp) AS above, count(*) FILTER (p = wp) AS tied,
               count(*) FILTER (p = wp AND competitor < wk) AS before_ FROM c JOIN h USING (event_id) GROUP BY 1),
  per AS (SELECT event_id, n AS field_size, above + before_ + 1 AS winner_rank, {r('wp', 6)} AS winner_probability, (above + before_ = 0)::int::double AS top1_hit,
    (above + before_ + 1 <= least(3, n))::int::double AS topk_hit, {r('1.0/(above + before_ + 1)', 6)} AS reciprocal_rank, {r('-ln(wp)', 6)} AS event_log_loss,
    {r('brier', 6)} AS event_brier,
    {r('(CASE WHEN above < 1 AND above + tied >= 1 THEN 1.0 ELSE 0 END + CASE WHEN above < 2 AND above + tied >= 2 AND n >= 2 THEN 1/log2(3.0) ELSE 0 END + CASE WHEN above < 3 AND above + tied >= 3 AND n >= 3 THEN 1/log2(4.0) ELSE 0 END)/tied', 6)} AS ndcg_at_k FROM m)"""


@query(f"WITH {METRICS} SELECT * FROM per")
def event_ranking_metrics(spark, sf):
    return events.event_metrics(scored_events(spark, sf), "event_id", "competitor", "target", "probability")


@query(f"""WITH {METRICS} SELECT count(*) AS n_events, {r('avg(field_size)', 3)} AS mean_field_size, {r('avg(top1_hit)', 4)} AS top1_accuracy, {r('avg(topk_hit)', 4)} AS topk_accuracy,
  {r('avg(reciprocal_rank)', 4)} AS mean_reciprocal_rank, {r('avg(ndcg_at_k)', 4)} AS mean_ndcg_at_k, {r('avg(event_log_loss)', 4)} AS winner_log_loss, {r('avg(event_brier)', 4)} AS winner_brier,
  {r('avg(winner_probability)', 4)} AS mean_winner_probability FROM per""")
def event_metric_means(spark, sf):
    return events.event_metric_means(events.event_metrics(scored_events(spark, sf), "event_id", "competitor", "target", "probability"))


BOARD = f"""{SOFT}, a AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY probability DESC, competitor) AS pr,
    row_number() OVER (PARTITION BY event_id ORDER BY l_extendedprice DESC, competitor) AS ar, count(*) OVER (PARTITION BY event_id) AS n FROM soft6),
  g AS (SELECT event_id, any_value(n) AS field_size, max(competitor) FILTER (pr=1) AS p1, max(competitor) FILTER (pr=2) AS p2, max(competitor) FILTER (pr=3) AS p3, max(probability) FILTER (pr=1) AS pp,
    max(competitor) FILTER (ar=1) AS a1, max(competitor) FILTER (ar=2) AS a2, max(competitor) FILTER (ar=3) AS a3 FROM a GROUP BY 1),
  board AS (SELECT event_id, field_size, p1 AS predicted_winner, pp AS predicted_winner_probability, p1 || ' > ' || p2 AS predicted_exacta, p1 || ' > ' || p2 || ' > ' || p3 AS predicted_podium,
    a1 AS actual_winner, a1 || ' > ' || a2 AS actual_exacta, a1 || ' > ' || a2 || ' > ' || a3 AS actual_podium, (p1 = a1)::int::double AS winner_hit,
    coalesce(p1 = a1 AND p2 = a2, false)::int::double AS exacta_ordered_hit, coalesce(list_sort([p1, p2]) = list_sort([a1, a2]) AND a2 IS NOT NULL, false)::int::double AS exacta_box_hit,
    coalesce(p1 = a1 AND p2 = a2 AND p3 = a3, false)::int::double AS podium_ordered_hit, coalesce(list_sort([p1, p2, p3]) = list_sort([a1, a2, a3]) AND a3 IS NOT NULL, false)::int::double AS podium_box_hit FROM g)"""


def board(spark, sf):
    rows = ordered.rank_within(scored_events(spark, sf), ["event_id"], [F.desc("l_extendedprice"), F.asc("competitor")], "finish")
    return events.event_board(rows, "event_id", "competitor", "probability", "finish")


@query(f"WITH {BOARD} SELECT * FROM board")
def event_board(spark, sf):
    return board(spark, sf).drop("predicted_top_k", "predicted_top_k_probabilities")


@query(f"""WITH {BOARD} SELECT count(*) AS n_events, {r('avg(winner_hit)', 4)} AS winner_hit, {r('avg(exacta_ordered_hit)', 4)} AS exacta_ordered_hit, {r('avg(exacta_box_hit)', 4)} AS exacta_box_hit,
  {r('avg(podium_ordered_hit)', 4)} AS podium_ordered_hit, {r('avg(podium_box_hit)', 4)} AS podium_box_hit, {r('avg(predicted_winner_probability)', 4)} AS mean_top1_probability FROM board""")
def event_tickets(spark, sf):
    return events.event_tickets(board(spark, sf))


@query(f"""WITH {LINE_EVENTS}, v AS (SELECT event_id FROM rivals GROUP BY 1 HAVING count(*) >= 2 AND sum(target) = 1)
  SELECT event_id, competitor FROM rivals WHERE event_id IN (SELECT event_id FROM v)""")
def valid_events(spark, sf):
    return events.valid_events(line_events(spark, sf), "event_id", "target").select("event_id", "competitor")


@query(f"WITH {METRICS} SELECT winner_rank, count(*) AS events FROM per GROUP BY 1")
def chart_winner_ranks(spark, sf):
    return charts.winner_rank_histogram(events.event_metrics(scored_events(spark, sf), "event_id", "competitor", "target", "probability"))


@query()
def train_event_model(spark, sf):
    ranked, metrics = events.train_event_model(
        line_events(spark, sf), "event_id", "competitor", "target", ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    )
    means = events.event_metric_means(events.event_metrics(ranked, "event_id", "competitor", "actual", "competitive_probability"))
    return metrics.crossJoin(F.broadcast(means))


# --- ranks and time blocks --------------------------------------------------------------------------


@query(f"""SELECT o_orderkey, {r('(rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1)/2.0::double)/count(*) OVER ()*100', 2)} AS percentile FROM orders""")
def pct_rank_average(spark, sf):
    out = ordered.with_average_rank(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "rk", percent=True)
    return out.select("o_orderkey", rnd(F.col("rk") * 100, 2).alias("percentile"))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders")
def rank_in_group(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ordered.rank_within(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], "place").select(
        "o_orderkey", F.col("place").cast("bigint").alias("place")
    )


@query("SELECT o_custkey, o_orderkey, place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place <= 3")
def top_k_per_group(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return events.top_places(o, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", F.col("place").cast("bigint").alias("place"))


BLOCKS = """days AS (SELECT o_orderdate::date AS day, count(*) AS n FROM orders GROUP BY 1), nb AS (SELECT *, ntile(4) OVER (ORDER BY day) AS block FROM days),
  blocks AS (SELECT block::int AS block, min(day) AS start, max(day) AS "end", count(*) AS days, sum(n)::bigint AS "rows" FROM nb GROUP BY 1)"""


@query(f"WITH {BLOCKS} SELECT * FROM blocks")
def date_blocks(spark, sf):
    return scoring.date_blocks(table(spark, sf, "orders"), "o_orderdate", 4)


@query(f"""WITH {BLOCKS}, t AS (SELECT o_orderdate::date AS d, (o_orderstatus = 'F')::int AS y FROM orders),
  f AS (SELECT block, start, "end", count(*) FILTER (d < start - 7) AS n_train, coalesce(sum(y) FILTER (d < start - 7), 0)::bigint AS train_positives,
    count(*) FILTER (d BETWEEN start AND "end") AS n_test, coalesce(sum(y) FILTER (d BETWEEN start AND "end"), 0)::bigint AS test_positives,
    count(*) FILTER (d >= start - 7 AND d < start) AS purged_rows, count(*) FILTER (d > "end" AND d <= "end" + 14) AS embargoed_rows FROM t, blocks GROUP BY ALL)
  SELECT *, n_train >= 80 AND n_test >= 20 AND train_positives BETWEEN 1 AND n_train - 1 AND test_positives BETWEEN 1 AND n_test - 1 AS is_valid FROM f""")
def purged_folds(spark, sf):
    o = table(spark, sf, "orders").select("o_orderdate", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return scoring.purged_folds(o, "o_orderdate", "y", 4)


# --- metrics of the deterministic customer score -------------------------------------------------------

PRED = f"{CUSTOMERS}, s AS (SELECT customer_id, segment, channel, age, churned AS y, score AS p, (score >= 0.4)::int AS c FROM people)"


def scores(spark, sf):
    return customers(spark, sf).select(
        "customer_id", "segment", "channel", "age", F.col("churned").alias("y"), F.col("score").alias("p"), (F.col("score") >= 0.4).cast("int").alias("c")
    )


@query(f"""WITH {PRED}, k AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1)/2.0::double AS rk FROM s),
  a AS (SELECT sum(y)::bigint AS np, sum(1-y)::bigint AS nn, sum(CASE WHEN y = 1 THEN rk ELSE 0 END) AS rs FROM k)
  SELECT np AS positives, nn AS negatives, {r('(rs - np*(np+1)/2.0::double)/(np*nn)', 4)} AS roc_auc FROM a""")
def roc_auc(spark, sf):
    return scoring.roc_auc(scores(spark, sf), "y", "p")


@query(f"WITH {PRED} SELECT y AS actual, c AS predicted, count(*) AS \"rows\" FROM s GROUP BY ALL")
def confusion_matrix(spark, sf):
    return scoring.confusion_counts(scores(spark, sf), "y", "c")


@query(f"""WITH {PRED}, k AS (SELECT v, count(*) FILTER (y = v) AS support, count(*) FILTER (y = v AND c = v) AS hits, count(*) FILTER (c = v) AS chosen FROM s, (VALUES (0), (1)) t(v) GROUP BY v),
  m AS (SELECT *, CASE WHEN chosen > 0 THEN hits/chosen ELSE 0 END AS p, CASE WHEN support > 0 THEN hits/support ELSE 0 END AS q FROM k),
  f AS (SELECT *, CASE WHEN p + q > 0 THEN 2*p*q/(p+q) ELSE 0 END AS f FROM m)
  SELECT sum(support)::bigint AS "rows", {r('sum(hits)/sum(support)', 4)} AS accuracy, {r('sum(p*support)/sum(support)', 4)} AS precision, {r('sum(q*support)/sum(support)', 4)} AS recall, {r('sum(f*support)/sum(support)', 4)} AS f1 FROM f""")
def confusion_metrics(spark, sf):
    return scoring.confusion_metrics(scores(spark, sf), "y", "c")


@query(f"WITH {PRED} SELECT {r('avg(-(y*ln(p) + (1-y)*ln(1-p)))', 4)} AS log_loss, {r('avg((p-y)*(p-y))', 4)} AS brier_score FROM s")
def log_loss_brier(spark, sf):
    return scoring.probability_losses(scores(spark, sf), "y", "p")


@query(f"""WITH {PRED} SELECT least(floor(p*10), 9)::int AS bin, count(*) AS "rows", {r('avg(p)', 4)} AS mean_probability, {r('avg(y)', 4)} AS observed_rate FROM s GROUP BY 1""")
def calibration_curve(spark, sf):
    return scoring.reliability_curve(scores(spark, sf), "y", "p")


@query(f"""WITH {PRED}, q AS (SELECT list_sort(list_distinct(quantile_cont(p, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM s)
  SELECT (greatest(len(list_filter(e, lambda x: x < p)), 1) - 1)::int AS bin, count(*) AS "rows", {r('avg(p)', 4)} AS mean_probability, {r('avg(y)', 4)} AS observed_rate, {r('avg(y) - avg(p)', 4)} AS calibration_gap FROM s, q GROUP BY 1""")
def calibration_bins(spark, sf):
    return scoring.calibration_gaps(scores(spark, sf), "y", "p")


GROUPS = f"""{PRED}, g AS (SELECT 'segment' AS feature, segment AS "group", y, c, p FROM s UNION ALL SELECT 'channel', channel, y, c, p FROM s
    UNION ALL SELECT 'age', CASE WHEN age <= 1500 THEN '<=1500' WHEN age <= 1800 THEN '(1500,1800]' ELSE '>1800' END, y, c, p FROM s),
  fair AS (SELECT feature, "group", count(*) AS support, {r('avg(c)', 4)} AS selection_rate, {r('avg(y)', 4)} AS actual_rate, {r('avg(p)', 4)} AS mean_probability,
    {r('count(*) FILTER (y=1 AND c=1)/nullif(count(*) FILTER (y=1), 0)', 4)} AS tpr, {r('count(*) FILTER (y=0 AND c=1)/nullif(count(*) FILTER (y=0), 0)', 4)} AS fpr,
    {r('abs(avg(p) - avg(y))', 4)} AS calibration_gap FROM g GROUP BY ALL)"""


def fair_groups(spark, sf):
    features = {"segment": F.col("segment"), "channel": F.col("channel"), "age": fixed_bins(F.col("age"), [1500, 1800])}
    return scoring.fairness_groups(scores(spark, sf), features, "y", "c", "p")


@query(f"WITH {GROUPS} SELECT * FROM fair")
def fairness_groups(spark, sf):
    return fair_groups(spark, sf)


@query(f"""WITH {GROUPS}, f AS (SELECT feature, count(*) AS groups, max(selection_rate) - min(selection_rate) AS d, min(selection_rate)/nullif(max(selection_rate), 0) AS q,
    CASE WHEN count(tpr) >= 2 THEN max(tpr) - min(tpr) END AS a, CASE WHEN count(fpr) >= 2 THEN max(fpr) - min(fpr) END AS b FROM fair GROUP BY 1)
  SELECT feature, groups, {r('d', 4)} AS demographic_parity_difference, {r('q', 4)} AS demographic_parity_ratio, {r('a', 4)} AS equal_opportunity_difference, {r('greatest(a, b)', 4)} AS equalized_odds_difference FROM f""")
def fairness_summary(spark, sf):
    return scoring.fairness_summary(fair_groups(spark, sf))


@query(f"""WITH t AS (SELECT o_totalprice AS y, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS p FROM orders)
  SELECT count(*) AS "rows", {r('avg(abs(y-p))', 4)} AS mae, {r('sqrt(avg((y-p)*(y-p)))', 4)} AS rmse, {r('1 - avg((y-p)*(y-p))/var_pop(y)', 4)} AS r2, {r('avg(p-y)', 4)} AS mean_error,
  {r('avg(abs(y-p)/greatest((abs(y)+abs(p))/2, 1e-6))*100', 4)} AS smape FROM t""")
def regression_metrics(spark, sf):
    o = table(spark, sf, "orders").select("o_totalprice", "o_orderpriority")
    means = o.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("p"))
    return scoring.regression_metrics(attach(o, means, ["o_orderpriority"]), "o_totalprice", "p")


@query(f"""WITH {PRED}, m AS (SELECT {r('avg((p-y)*(p-y))', 4)} AS b, {r('corr(p, y)', 4)} AS r2 FROM s)
  SELECT 'r2' AS metric, r2 AS "value", CASE WHEN r2 >= 0.7 THEN 'strong' WHEN r2 >= 0.4 THEN 'useful' ELSE 'weak' END AS reading FROM m
  UNION ALL SELECT 'brier_score', b, 'compare with the cost of an error' FROM m""")
def metric_readings(spark, sf):
    one = scores(spark, sf).agg(
        rnd(F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))), 4).alias("brier_score"), rnd(F.corr("p", "y"), 4).alias("r2")
    )
    return scoring.unpivot_metrics(one, ["r2", "brier_score"])


@query(f"""WITH q AS (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS e FROM lineitem)
  SELECT len(list_filter(e, lambda x: x < l_extendedprice))::int AS bin, count(*) AS "rows", {r('avg(l_extendedprice)', 4)} AS mean_x, {r('avg(l_quantity)', 4)} AS mean_y, {r('stddev_samp(l_quantity)', 4)} AS std_y FROM lineitem, q GROUP BY 1""")
def chart_binned_pairs(spark, sf):
    return charts.binned_pairs(table(spark, sf, "lineitem"), F.col("l_extendedprice"), F.col("l_quantity"), 4)
