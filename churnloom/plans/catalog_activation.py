"""Thresholds, scorecards, segments and next best action on the deterministic customer score."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import rnd
from ..operators import activation, value
from ..operators.describe import crosstab_shares
from ..session import materialize
from .base import CUSTOMERS, customers
from .registry import query, r

VALUED = f"""{CUSTOMERS}, ty AS (SELECT greatest(median(monetary), 18.0) AS m FROM people WHERE frequency > 0 AND recency <= age AND age > 0 AND monetary > 0),
  cv AS (SELECT people.*, least(greatest(1.0/(1.0+exp(-(-1.35::double + 2.85::double*coalesce(recency/nullif(age,0)::double,0) + 0.55::double*ln(1.0::double+frequency)))), 0.03), 0.995) AS alive,
           CASE WHEN frequency > 0 THEN (frequency*monetary + 3.0::double*m) / (frequency + 3.0::double) ELSE m*0.85::double END AS ev,
           coalesce((frequency + 1.0::double) / nullif(age,0), 0) * ((frequency + 1.0::double) / (frequency + 3.5::double)) AS rt FROM people, ty),
  valued AS (SELECT * EXCLUDE (alive, ev, rt), {r('alive*rt*180.0*ev/pow(1.01::double,6)', 2)} AS clv_6m, {r('alive*rt*360.0*ev/pow(1.01::double,12)', 2)} AS clv_12m, {r('alive', 4)} AS p_alive FROM cv)"""

COST, RATE, CUT = 22.0, 0.28, 0.4


def valued(spark, sf):
    """Customers with the shrinkage CLV; written once because the operators below read it several times."""
    return materialize(value.clv_shrinkage(materialize(customers(spark, sf), "customers")), "valued")


SWEEP = f"""{VALUED}, sweep AS (
  SELECT t AS threshold, n AS contacted, {r('n/pop*100', 2)} AS pct_contacted, {r('CASE WHEN n > 0 THEN tp/n ELSE 0 END', 4)} AS precision, {r('CASE WHEN n > 0 THEN tp/pos ELSE 0 END', 4)} AS recall,
    {r('CASE WHEN n > 0 AND tp > 0 THEN 2.0*tp/(n+pos) ELSE 0 END', 4)} AS f1, tp AS detected, {r('tp/pos*100', 2)} AS pct_captured, {r('v*0.28', 2)} AS recovered_value, {r('n*22.0', 2)} AS campaign_cost,
    {r('v*0.28 - n*22.0', 2)} AS net_value, {r('(v*0.28 - n*22.0)/nullif(n*22.0, 0)', 4)} AS roi
  FROM (SELECT t, count(*) FILTER (score >= t) AS n, count(*) FILTER (score >= t AND churned = 1) AS tp, coalesce(sum(clv_12m) FILTER (score >= t AND churned = 1), 0) AS v,
               count(*) AS pop, greatest(sum(churned), 1) AS pos
        FROM valued, (SELECT unnest([{', '.join(f'{t}::double' for t in activation.THRESHOLDS)}]) AS t) GROUP BY t))"""


@query(f"WITH {SWEEP} SELECT * FROM sweep")
def threshold_sweep(spark, sf):
    return activation.threshold_sweep(valued(spark, sf), "churned", "score", "clv_12m", COST, RATE)


@query(f"WITH {SWEEP} SELECT * FROM sweep ORDER BY (pct_contacted <= 30) DESC, net_value DESC, threshold LIMIT 1")
def recommended_threshold(spark, sf):
    return activation.recommended_threshold(activation.threshold_sweep(valued(spark, sf), "churned", "score", "clv_12m", COST, RATE))


A, O, C = activation.ACTIONS, activation.OFFERS, activation.CHANNELS
CARD = f"""{VALUED}, k AS (SELECT *, score >= {CUT} AS hit,
    {r('(rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1)/2.0::double)/count(*) OVER ()*100', 2)} AS risk_percentile,
    {r('(rank() OVER (ORDER BY clv_12m) + (count(*) OVER (PARTITION BY clv_12m) - 1)/2.0::double)/count(*) OVER ()*100', 2)} AS value_percentile,
    CASE WHEN score >= 0.7 THEN 'Critico' WHEN score >= {CUT} THEN 'Alto' WHEN score >= {CUT - 0.1!r} THEN 'Medio' ELSE 'Bajo' END AS risk FROM valued),
  k2 AS (SELECT *, CASE WHEN risk = 'Critico' AND value_percentile >= 70 THEN 'Maxima' WHEN risk IN ('Critico','Alto') AND value_percentile >= 50 THEN 'Alta'
     WHEN risk IN ('Alto','Medio') AND value_percentile >= 35 THEN 'Media' ELSE 'Monitoreo' END AS priority FROM k),
  card AS (SELECT *, hit::int AS contact, {r('0.58::double*risk_percentile + 0.42::double*value_percentile', 2)} AS priority_score, {r('clv_12m', 2)} AS future_value,
     CASE WHEN hit THEN {r('clv_6m*score*0.28::double - 22.0', 2)} ELSE 0.0 END AS expected_contact_value,
     CASE WHEN channel = 'Sucursal' OR premium = 'Si' OR priority = 'Maxima' THEN '{C[0]}' WHEN channel = 'Mixto' THEN '{C[1]}' ELSE '{C[2]}' END AS recommended_channel,
     CASE WHEN priority = 'Maxima' AND premium = 'Si' THEN '{A[0]}' WHEN priority = 'Maxima' THEN '{A[1]}' WHEN priority = 'Alta' AND payroll = 'No' THEN '{A[2]}'
          WHEN risk = 'Alto' THEN '{A[3]}' WHEN priority = 'Media' THEN '{A[4]}' ELSE '{A[5]}' END AS action,
     CASE WHEN priority = 'Maxima' AND premium = 'Si' THEN '{O[0]}' WHEN priority = 'Maxima' AND payroll = 'No' THEN '{O[1]}' WHEN priority = 'Maxima' AND mortgage = 'No' THEN '{O[2]}'
          WHEN risk = 'Alto' AND app = 'No' THEN '{O[3]}' WHEN risk = 'Alto' AND payroll = 'No' THEN '{O[4]}' WHEN risk = 'Alto' THEN '{O[5]}'
          WHEN priority = 'Media' AND premium = 'No' THEN '{O[6]}' WHEN priority = 'Media' THEN '{O[7]}' ELSE '{O[8]}' END AS offer FROM k2)"""


def card(spark, sf):
    return materialize(activation.retention_scorecard(valued(spark, sf), CUT, "score", contact_cost=COST, success_rate=RATE), "card")


CARD_COLUMNS = ["customer_id", "contact", "risk_percentile", "value_percentile", "priority_score", "risk", "priority", "recommended_channel", "action", "offer", "future_value", "expected_contact_value"]


@query(f"WITH {CARD} SELECT {', '.join(CARD_COLUMNS)} FROM card")
def retention_scorecard(spark, sf):
    return card(spark, sf).select(*CARD_COLUMNS)


@query(f"WITH {CARD} SELECT customer_id, score, expected_contact_value, offer FROM card WHERE contact = 1 ORDER BY expected_contact_value DESC, score DESC, customer_id LIMIT 25")
def shortlist(spark, sf):
    return activation.shortlist(card(spark, sf), "customer_id", "score").select("customer_id", "score", "expected_contact_value", "offer")


@query(f"""WITH {CARD} SELECT risk, segment, count(*) AS customers, {r('sum(score::decimal(28,4))::double/count(*)', 4)} AS mean_score, {r('sum(clv_12m::decimal(28,4))::double/count(*)', 2)} AS mean_value,
  {r('sum(future_value::decimal(28,4))::double/count(*)', 2)} AS mean_future_value, {r('sum(expected_contact_value::decimal(28,4))::double/count(*)', 2)} AS mean_expected_value FROM card GROUP BY ALL""")
def risk_segment_summary(spark, sf):
    return activation.risk_segment_summary(card(spark, sf), "segment", "clv_12m", "score")


@query(f"WITH {CARD} SELECT place, t.risk, count(customer_id) AS customers FROM (VALUES (0::int,'Critico'),(1::int,'Alto'),(2::int,'Medio'),(3::int,'Bajo')) t(place, risk) LEFT JOIN card ON card.risk = t.risk AND contact = 1 GROUP BY place, t.risk")
def risk_counts(spark, sf):
    return activation.dashboard_tables(card(spark, sf), "segment", "score")["risk_counts"]


@query(f"WITH {CARD} SELECT offer, count(*) AS customers FROM card WHERE contact = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def offer_mix(spark, sf):
    return activation.dashboard_tables(card(spark, sf), "segment", "score")["offer_mix"]


@query(f"""WITH {CARD} SELECT segment, count(*) AS customers, {r('sum(expected_contact_value)', 2)} AS total_expected_value, {r('sum(future_value)', 2)} AS total_future_value, {r('avg(score)', 4)} AS mean_score
  FROM card WHERE contact = 1 GROUP BY 1""")
def segment_value(spark, sf):
    return activation.dashboard_tables(card(spark, sf), "segment", "score")["segment_value"]


GAPS = f"""{CARD}, gaps AS (SELECT customer_id, segment, score, expected_contact_value, {r('score - avg(score) OVER (PARTITION BY segment)', 4)} AS score_gap,
  {r('expected_contact_value - avg(expected_contact_value) OVER (PARTITION BY segment)', 2)} AS value_gap FROM card)"""


@query(f"WITH {GAPS} SELECT customer_id, score_gap, value_gap FROM gaps")
def consensus_gap(spark, sf):
    return activation.consensus_gap(card(spark, sf), "segment", "score", "expected_contact_value").select("customer_id", "score_gap", "value_gap")


@query(f"""WITH {GAPS} SELECT segment, count(*) AS customers, abs({r('avg(score_gap)', 3)}) AS mean_score_gap, {r('avg(score)', 4)} AS mean_score, {r('avg(expected_contact_value)', 2)} AS mean_value FROM gaps GROUP BY 1""")
def consensus_summary(spark, sf):
    gaps = activation.consensus_gap(card(spark, sf), "segment", "score", "expected_contact_value")
    out = activation.consensus_summary(gaps, "segment", "score", "expected_contact_value")
    return out.withColumns(
        {"mean_score_gap": F.abs(rnd(F.col("mean_score_gap"), 3)), "mean_value": rnd(F.col("mean_value"), 2)}
    ).drop("mean_value_gap")


@query(f"""WITH {CARD}, a AS (SELECT offer AS arm, count(*) AS n, avg(expected_contact_value) AS m, median(expected_contact_value) AS md, count(*) FILTER (expected_contact_value > 0) AS w FROM card GROUP BY 1),
  s AS (SELECT *, min(m) OVER () AS lo, max(m) OVER () AS hi, count(*) OVER () AS k FROM a), l AS (SELECT *, CASE WHEN hi = lo THEN 1.0 ELSE (m - lo)/(hi - lo) END AS lv, (w+1)/(n+2) AS pm FROM s)
  SELECT arm, n, {r('m', 6)} AS mean_reward, {r('md', 6)} AS median_reward, {r('w/n', 4)} AS positive_rate, w + 1 AS alpha, n - w + 1 AS beta, {r('pm', 4)} AS posterior_mean,
  {r('0.9::double*lv + 0.1::double/k', 4)} AS epsilon_greedy_score, {r('pm*greatest(lv, 0.05::double)', 4)} AS thompson_score FROM l""")
def bandit_policy(spark, sf):
    return activation.bandit_policy(card(spark, sf), "offer", "expected_contact_value", digits=6)


@query(f"""WITH {VALUED} SELECT customer_id, {r('0.28::double*clv_6m - 22.0', 2)} AS expected_contact_value, {r('score*clv_6m', 2)} AS priority_score FROM valued""")
def priority_value(spark, sf):
    made = activation.priority_value(F.col("clv_6m"), F.col("score"), RATE, COST)
    return valued(spark, sf).select("customer_id", *[rnd(c, 2).alias(n) for n, c in made.items()])


NBA = f"""{VALUED}, nv AS (SELECT customer_id, segment, score*0.05::double*clv_6m - 25.0 AS v_call, (1 - score)*0.01::double*clv_12m - 40.0 AS v_cross, score*0.02::double*monetary - 5.0 AS v_app FROM valued),
  nb AS (SELECT *, greatest(v_call, v_cross, v_app) AS best FROM nv),
  nba AS (SELECT *, CASE WHEN best <= 1500.0 THEN 'Monitorear' WHEN v_call = best THEN 'Llamada' WHEN v_cross = best THEN 'Venta cruzada' ELSE 'App' END AS nba FROM nb)"""


def actions(spark, sf):
    p = F.col("score")
    return activation.next_best_action(
        valued(spark, sf), {"call": p, "cross": 1 - p, "app": p},
        {"call": 0.05 * F.col("clv_6m"), "cross": 0.01 * F.col("clv_12m"), "app": 0.02 * F.col("monetary")},
        {"call": 25.0, "cross": 40.0, "app": 5.0}, {"call": "Llamada", "cross": "Venta cruzada", "app": "App"}, minimum=1500.0,
    )


@query(f"WITH {NBA} SELECT customer_id, nba, {r('best', 2)} AS nba_value FROM nba")
def nba_argmax(spark, sf):
    return actions(spark, sf).select("customer_id", "nba", rnd(F.col("nba_value"), 2).alias("nba_value"))


@query(f"""WITH {NBA}, p AS (SELECT segment, nba, count(*) AS n FROM nba GROUP BY ALL), g AS (SELECT * FROM (SELECT segment, sum(n) AS t FROM p GROUP BY 1), (SELECT DISTINCT nba FROM p))
  SELECT segment, nba, {r('coalesce(n, 0)/t', 3)} AS share FROM g LEFT JOIN p USING (segment, nba)""")
def nba_mix(spark, sf):
    return crosstab_shares(materialize(actions(spark, sf).select("segment", "nba"), "nba"), "segment", "nba")


@query(f"WITH {NBA} SELECT segment, count(*) AS customers, {r('avg(best)', 3)} AS mean_value FROM nba GROUP BY 1")
def nba_summary(spark, sf):
    return activation.nba_summary(actions(spark, sf), "segment")


PROFILE = f"{CARD}, prof AS (SELECT segment, avg(clv_6m) AS v, avg(score) AS s FROM card GROUP BY 1)"


@query(f"""WITH {PROFILE}, d AS (SELECT segment, dense_rank() OVER (ORDER BY {r('v', 3)} DESC) AS vr, dense_rank() OVER (ORDER BY {r('s', 3)} DESC) AS sr FROM prof)
  SELECT segment, CASE WHEN vr = 1 AND sr <= 2 THEN 'Riesgo critico de alto CLV' WHEN sr = 1 OR vr <= 2 THEN 'Riesgo alto monetizable' ELSE 'Monitoreo preventivo de valor medio' END AS segment_name FROM d""")
def segment_names(spark, sf):
    profile = card(spark, sf).groupBy("segment").agg(rnd(F.avg("clv_6m"), 3).alias("v"), rnd(F.avg("score"), 3).alias("s"))
    return activation.rank_labels(profile, "v", "s").select("segment", "segment_name")


@query(f"""WITH {CARD}, oc AS (SELECT segment, offer, count(*) AS n FROM card GROUP BY 1, 2), o AS (SELECT segment, offer, row_number() OVER (PARTITION BY segment ORDER BY n DESC, offer) AS k FROM oc)
  SELECT card.segment, count(*) AS customers, {r('avg(contact)', 3)} AS share_contacted, {r('avg(score)', 3)} AS mean_score, {r('avg(clv_6m)', 1)} AS mean_clv, {r('avg(expected_contact_value)', 1)} AS mean_expected_value,
  any_value(o.offer) AS main_offer FROM card JOIN o ON o.segment = card.segment AND k = 1 GROUP BY 1""")
def segment_playbook(spark, sf):
    out = activation.segment_playbook(card(spark, sf), "segment", "score", "clv_6m", digits=6)
    ones, threes = ("mean_clv", "mean_expected_value"), ("share_contacted", "mean_score")
    return out.withColumns({**{c: rnd(F.col(c), 1) for c in ones}, **{c: rnd(F.col(c), 3) for c in threes}})


@query(f"""WITH {CUSTOMERS} SELECT channel, count(*) AS contacts, count(*) FILTER (churned = 0) AS successes, {r('avg((churned = 0)::int)', 4)} AS rate, {r('(1 + count(*) FILTER (churned = 0))/(2 + count(*))', 4)} AS posterior_mean FROM people GROUP BY 1""")
def success_rate_interval(spark, sf):
    out = activation.success_rate_interval(customers(spark, sf), F.col("churned") == 0, ["channel"])
    return out.select("channel", "contacts", "successes", "rate", "posterior_mean")


@query()
def success_rate_bounds(spark, sf):
    return activation.success_rate_interval(customers(spark, sf), F.col("churned") == 0, ["channel"])


@query(f"""WITH {PROFILE}, n AS (SELECT segment, row_number() OVER (ORDER BY segment) AS c, v, s FROM prof),
  a AS (SELECT c FROM n ORDER BY v DESC, c LIMIT 1), b AS (SELECT c FROM n WHERE c NOT IN (SELECT c FROM a) ORDER BY s DESC, c LIMIT 1)
  SELECT segment, CASE WHEN c IN (SELECT c FROM a) THEN 'Valor' WHEN c IN (SELECT c FROM b) THEN 'Riesgo' ELSE 'Segmento ' || c END AS segment_name FROM n""")
def segment_labels_greedy(spark, sf):
    profile = card(spark, sf).groupBy("segment").agg(F.avg("clv_6m").alias("v"), F.avg("score").alias("s"))
    numbered = {row["segment"]: i + 1 for i, row in enumerate(profile.orderBy("segment").collect())}
    pairs = [x for k, v in numbered.items() for x in (F.lit(k), F.lit(v))]
    coded = profile.withColumn("cluster", F.create_map(*pairs)[F.col("segment")])
    names = activation.greedy_labels(coded, "cluster", [{"label": "Valor", "metric": "v"}, {"label": "Riesgo", "metric": "s"}])
    return activation.with_labels(coded, "cluster", names).select("segment", "segment_name")
