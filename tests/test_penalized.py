import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from churnloom.operators import models, penalized
from churnloom.operators.penalized import Penalty

NAMES = ["a", "b", "c", "d"]
PENALTIES = {f"{m}/{s}": Penalty(s, m) for m in (0.0, 0.3, 1.0) for s in (0.0, 0.05, 0.5, 2.0, 50.0)}


def rows(n=600):
    rng = np.random.default_rng(3)
    a, b = rng.normal(5, 2, n), rng.normal(0, 30, n)
    c = 0.8 * a + rng.normal(0, 1, n)
    y = 3 * a - 0.1 * b + c + rng.normal(0, 2, n)
    return [(i, *map(float, x), 7.0, float(t)) for i, (*x, t) in enumerate(zip(a, b, c, y))]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "id long, a double, b double, c double, d double, y double").repartition(5)


def test_equal_to_spark_ml(frame):
    data = VectorAssembler(inputCols=NAMES[:3], outputCol="x").transform(frame)
    got = {}
    for r in penalized.path(frame, "y", NAMES, PENALTIES).collect():
        got.setdefault(r["model"], {})[r["feature"]] = r
    for name, p in PENALTIES.items():
        if p.strength in (0.05, 2.0, 0.0):
            m = LinearRegression(featuresCol="x", labelCol="y", regParam=p.strength, elasticNetParam=p.mix, tol=1e-12, maxIter=2000).fit(data)
            assert np.allclose([got[name][f]["coefficient"] for f in NAMES[:3]], m.coefficients.toArray(), atol=1e-6)
            assert abs(got[name]["a"]["intercept"] - m.intercept) < 1e-5
        assert got[name]["d"]["coefficient"] == 0 and got[name]["a"]["violation"] < 1e-10
    assert all(got["1.0/50.0"][f]["coefficient"] == 0 for f in NAMES)


def test_optimum_is_no_worse_than_its_neighbours(frame):
    d, fills = penalized._designed(frame, "y", NAMES[:3])
    g = penalized.moments(d.rows, d.width, d.label, fills)
    spread, y_spread = np.sqrt(np.diag(g.xx) / g.n), np.sqrt(g.yy / g.n)

    def loss(b, p):
        z = b * spread / y_spread
        fit = z @ (g.xx / np.outer(spread, spread) / g.n) @ z / 2 - z @ (g.xy / spread / y_spread / g.n)
        return fit + p.strength / y_spread * (p.mix * np.abs(z).sum() + (1 - p.mix) * z @ z / 2)

    rng = np.random.default_rng(4)
    for p, m in zip(PENALTIES.values(), penalized.solve(g, list(PENALTIES.values()))):
        at = loss(m.coefficients, p)
        assert all(loss(m.coefficients + rng.normal(0, s, 3) / spread, p) >= at - 1e-12 for s in (1e-3, 0.1, 1) for _ in range(20))


def test_path_errors_are_those_of_the_single_models(frame):
    got = {r["model"]: r for r in penalized.train_path(frame, "id", "y", NAMES[:3], {"ridge": Penalty(0.1), "lasso": Penalty(0.1, 1.0), "linear": Penalty()})[0].collect()}
    for name in got:
        want = models.train_regressor(frame, "id", "y", NAMES[:3], name).metrics.first()
        assert got[name]["rows"] == want["rows"]
        assert all(abs(got[name][k] - want[k]) <= 2e-4 for k in ("mae", "rmse", "r2", "mean_error", "smape"))


def test_odd_tables(spark):
    schema = "id long, a double, t string, y double"
    data = [(i, None if i % 5 == 0 else float(i % 7), [None, "p", "q'x"][i % 3], float(i % 7) + (i % 3)) for i in range(90)] + [(90, 1.0, "p", None), (91, float("nan"), "p", 2.0)]
    df = spark.createDataFrame(data, schema)
    out, found = penalized.train_path(df, "id", "y", ["a", "t"], {"lasso": Penalty(0.01, 1.0), "plain": Penalty()})
    assert all(r["rows"] > 0 and r["r2"] > 0.2 for r in out.collect()) and len(found["plain"].coefficients) == 3
    names = {r["feature"] for r in penalized.path(df, "y", ["a", "t"], {"x": Penalty(0.1, 0.5)}).collect()}
    assert names == {"a", "t=p", "t=q'x"}
    flat = spark.createDataFrame([(1, 1.0, "p", 4.0), (2, 2.0, "p", 4.0)], schema)
    assert [(r["coefficient"], r["intercept"]) for r in penalized.path(flat, "y", ["a"], {"x": Penalty(0.1, 1.0)}).collect()] == [(0.0, 4.0)]
    with pytest.raises(ValueError):
        penalized.path(df.limit(0), "y", ["a"], {"x": Penalty()})
    with pytest.raises(ValueError):
        penalized.path(df, "y", ["a"], {"x": Penalty(-1.0)})
