"""Model training, validation, explanation and segmentation queries. Results depend on optimisers, so rows are
checked by invariants in the tests rather than by SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import rnd
from ..operators import activation, linear, models, penalized, segments, value
from ..operators.penalized import Penalty
from ..session import materialize
from .base import CUSTOMERS, customers, table
from .registry import query, r

NUMBERS = ["frequency", "recency", "age", "days_since_last", "monetary", "value_12m", "balance", "return_rate"]
TEXTS = ["segment", "channel", "payroll", "premium"]
FEATURES = NUMBERS + TEXTS
KEY, TARGET = "customer_id", "churned"


def base(spark, sf):
    """Customers, written once: every query below reads them many times."""
    return materialize(customers(spark, sf), "customers")


def metrics_with_calibration(t: models.Trained):
    return t.metrics.withColumns({"algorithm": F.lit(t.algorithm), "calibration": F.lit(t.calibration)})


@query()
def train_logistic(spark, sf):
    return metrics_with_calibration(models.train_classifier(base(spark, sf), KEY, TARGET, FEATURES))


@query()
def train_forest(spark, sf):
    return metrics_with_calibration(models.train_classifier(base(spark, sf), KEY, TARGET, FEATURES, "random_forest", trees=400))


@query()
def train_gbt(spark, sf):
    return metrics_with_calibration(models.train_classifier(base(spark, sf), KEY, TARGET, FEATURES, "gradient_boosting"))


@query()
def train_mlp(spark, sf):
    return metrics_with_calibration(models.train_classifier(base(spark, sf), KEY, TARGET, FEATURES, "mlp"))


@query()
def train_spline(spark, sf):
    return metrics_with_calibration(models.train_classifier(base(spark, sf), KEY, TARGET, NUMBERS, "spline"))


@query()
def knn_score(spark, sf):
    return metrics_with_calibration(models.train_classifier(base(spark, sf), KEY, TARGET, NUMBERS, "knn"))


#: The penalties of ``models.regressor``.
LINEAR_MODELS = {"linear": Penalty(), "ridge": Penalty(0.1), "lasso": Penalty(0.1, 1.0), "elasticnet": Penalty(0.1, 0.5)}


@query()
def train_regressors(spark, sf):
    data, features = base(spark, sf), [n for n in NUMBERS if n != "value_12m"]
    out = penalized.train_path(data, KEY, "value_12m", features, LINEAR_MODELS)[0]
    for m in ("random_forest", "gradient_boosting"):
        out = out.unionByName(models.train_regressor(data, KEY, "value_12m", features, m).metrics.select(F.lit(m).alias("model"), "*"))
    return out


PATH = {f"{mix}/{strength}": Penalty(strength, mix) for mix in (0.0, 0.5, 1.0) for strength in (0.0, 100.0, 5000.0, 12000.0, 40000.0)}
_PATH_ROWS = ", ".join(f"('{name}', {p.strength}, {p.mix})" for name, p in PATH.items())


# The SQL descends coordinate by coordinate from the plain correlations of two columns, 80 rounds for each penalty.
@query(f"""WITH RECURSIVE x AS (SELECT l_quantity::double AS a, (l_quantity*l_discount)::double AS b, l_extendedprice::double AS y FROM lineitem),
  m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, stddev_pop(a) AS sa, stddev_pop(b) AS sb, stddev_pop(y) AS sy,
    corr(a, b) AS rab, corr(a, y) AS ray, corr(b, y) AS rby FROM x),
  p AS (SELECT model, strength*mix/sy AS l1, strength*(1 - mix)/sy AS l2, m.* FROM m, (VALUES {_PATH_ROWS}) v(model, strength, mix)),
  d AS (SELECT 0 AS i, 0.0::double AS u, 0.0::double AS w, p.* FROM p
    UNION ALL SELECT i + 1, u2, sign(rby - rab*u2)*greatest(abs(rby - rab*u2) - l1, 0)/(1 + l2), model, l1, l2, ma, mb, my, sa, sb, sy, rab, ray, rby
    FROM (SELECT *, sign(ray - rab*w)*greatest(abs(ray - rab*w) - l1, 0)/(1 + l2) AS u2 FROM d WHERE i < 80)),
  e AS (SELECT model, u*sy/sa AS ca, w*sy/sb AS cb, my - u*sy/sa*ma - w*sy/sb*mb AS c FROM d WHERE i = 80)
  SELECT model, 'quantity' AS feature, {r('ca', 3)} AS coefficient, {r('c', 2)} AS intercept, true AS is_optimal FROM e
  UNION ALL SELECT model, 'discounted', {r('cb', 3)}, {r('c', 2)}, true FROM e""")
def penalty_path(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_quantity").cast("double").alias("quantity"), (F.col("l_quantity") * F.col("l_discount")).cast("double").alias("discounted"), "l_extendedprice"
    )
    out = penalized.path(rows, "l_extendedprice", ["quantity", "discounted"], PATH)
    return out.select(
        "model", "feature", rnd(F.col("coefficient"), 3).alias("coefficient"), rnd(F.col("intercept"), 2).alias("intercept"),
        (F.col("violation") < 1e-9).alias("is_optimal"),
    )


@query()
def model_benchmark(spark, sf):
    data = base(spark, sf)
    return models.benchmark(data, KEY, TARGET, FEATURES, ("logistic", "random_forest", "gradient_boosting", "mlp"), trees=400)[0]


@query()
def parsimony(spark, sf):
    return models.parsimony_study(base(spark, sf), KEY, TARGET, FEATURES)["summary"]


@query()
def parsimony_cv(spark, sf):
    return models.select_by_cv_then_bic(base(spark, sf), KEY, TARGET, FEATURES, (4, 8, 12, 18), folds=5)


MI_BINS = 10


@query(f"""WITH q AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, [{', '.join(str(i / MI_BINS) for i in range(MI_BINS + 1))}]))) AS e FROM lineitem),
  b AS (SELECT greatest(len(list_filter(e, lambda x: x < l_extendedprice)), 1) AS x, l_returnflag AS y, count(*)::double AS n FROM lineitem, q GROUP BY ALL),
  p AS (SELECT n/sum(n) OVER () AS p, sum(n) OVER (PARTITION BY x)/sum(n) OVER () AS px, sum(n) OVER (PARTITION BY y)/sum(n) OVER () AS py FROM b),
  c AS (SELECT l_linestatus AS x, l_returnflag AS y, count(*)::double AS n FROM lineitem GROUP BY ALL),
  d AS (SELECT n/sum(n) OVER () AS p, sum(n) OVER (PARTITION BY x)/sum(n) OVER () AS px, sum(n) OVER (PARTITION BY y)/sum(n) OVER () AS py FROM c)
  SELECT 'l_extendedprice' AS feature, {r('sum(p*ln(p/(px*py)))', 4)} AS mutual_information FROM p
  UNION ALL SELECT 'l_linestatus', {r('sum(p*ln(p/(px*py)))', 4)} FROM d""")
def mutual_information(spark, sf):
    return models.mutual_information(table(spark, sf, "lineitem"), "l_returnflag", ["l_extendedprice", "l_linestatus"], MI_BINS)


@query()
def rfe(spark, sf):
    return models.recursive_elimination(base(spark, sf), KEY, TARGET, NUMBERS, keep=4)


@query()
def permutation_importance(spark, sf):
    data = base(spark, sf)
    trained = models.train_classifier(data, KEY, TARGET, FEATURES, calibrate=None)
    return models.permutation_importance(trained, data, KEY, TARGET)


@query()
def calibration_comparison(spark, sf):
    trained = models.train_classifier(base(spark, sf), KEY, TARGET, NUMBERS, "gradient_boosting")
    return models.calibration_comparison(trained.predictions).withColumn("method", F.lit(trained.calibration))


@query()
def purged_validation(spark, sf):
    return models.purged_validation(base(spark, sf), KEY, TARGET, FEATURES, "last_order", blocks=4)[0]


@query()
def quantile_validation(spark, sf):
    o = table(spark, sf, "orders").withColumn("late", (F.col("o_orderstatus") == "F").cast("int"))
    return models.quantile_validation(o, "o_orderkey", "late", ["o_totalprice", "o_orderpriority"], "o_orderdate")


@query()
def bootstrap_intervals(spark, sf):
    rows, _ = models.bootstrap_intervals(base(spark, sf), KEY, TARGET, FEATURES, "last_order")
    return rows


@query()
def bootstrap_summary(spark, sf):
    return models.bootstrap_intervals(base(spark, sf), KEY, TARGET, FEATURES, "last_order")[1]


@query()
def multiverse(spark, sf):
    return models.multiverse(base(spark, sf), KEY, TARGET, FEATURES, ["monetary", "balance"], trees=400)


@query()
def linear_shap(spark, sf):
    data = base(spark, sf)
    trained = models.train_classifier(data, KEY, TARGET, FEATURES, calibrate=None)
    return models.linear_shap(trained, data, KEY)[1]


# Contributions and base add up to the output on every row, so all gaps are zero.
@query(f"""WITH {CUSTOMERS} SELECT count(*) AS "rows", 0.0::double AS mean_gap, 0.0::double AS max_gap, true AS is_consistent FROM people""")
def shap_check(spark, sf):
    data = base(spark, sf)
    trained = models.train_classifier(data, KEY, TARGET, FEATURES, calibrate=None)
    return models.shap_check(models.linear_shap(trained, data, KEY)[0], KEY)


@query()
def shap_top_row(spark, sf):
    data = base(spark, sf)
    trained = models.train_classifier(data, KEY, TARGET, FEATURES, calibrate=None)
    return models.top_row_explanation(models.linear_shap(trained, data, KEY)[0], KEY)


# A one-predictor regression has closed forms, so its contributions can be checked in SQL.
@query(f"""WITH g AS (SELECT regr_slope(o_totalprice, o_orderkey) AS b, avg(o_orderkey) AS m FROM orders)
  SELECT o_orderkey, {r('b*(o_orderkey - m)', 2)} AS contribution FROM orders, g""")
def linear_contributions(spark, sf):
    o = table(spark, sf, "orders")
    f = linear.fit(o, ["o_orderkey"], F.col("o_totalprice"))
    out = linear.linear_contributions(o, {"o_orderkey": f.slopes[0]}, {"o_orderkey": f.gram.mean[0]})
    return out.select("o_orderkey", rnd(F.col("contribution_o_orderkey"), 2).alias("contribution"))


@query()
def value_benchmark(spark, sf):
    data = base(spark, sf)
    return models.value_benchmark(data, KEY, "value_12m", NUMBERS[:5] + ["segment", "channel"], ("linear", "random_forest", "gradient_boosting"), trees=400)[0]


@query()
def forecast_lags(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return models.forecast_lags(o, ["o_custkey"], "o_orderdate", "o_totalprice", lags=3, horizon=2, seasonality=4, key=["o_orderkey"])[1]


@query()
def forecast_differences(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return models.forecast_differences(o, ["o_custkey"], "o_orderdate", "o_totalprice", horizon=2, key=["o_orderkey"])[1]


SEGMENT_ON = ["score", "clv_6m", "monetary", "days_since_last"]


def segment_base(spark, sf):
    return segments.segment_matrix(value.clv_shrinkage(base(spark, sf)), SEGMENT_ON)


@query()
def kmeans_options(spark, sf):
    return segments.kmeans_options(segment_base(spark, sf), (2, 3, 4, 5))


@query()
def kmeans_segments(spark, sf):
    out = segments.kmeans_segments(segment_base(spark, sf), 4)
    return out.select(KEY, "cluster_id", rnd(F.col("pc1"), 4).alias("pc1"), rnd(F.col("pc2"), 4).alias("pc2"))


@query()
def segment_profile(spark, sf):
    out = materialize(segments.kmeans_segments(segment_base(spark, sf), 4).select(KEY, "cluster_id", *SEGMENT_ON), "clusters")
    profile = out.groupBy("cluster_id").agg(F.count("*").alias("customers"), *[rnd(F.avg(c), 3).alias(c) for c in SEGMENT_ON])
    return activation.rank_labels(profile, "clv_6m", "score")

