"""Hypothesis tests and regression diagnostics.

SQL gives the test statistics, and p-values where they have a closed form (three groups); other p-values and matrix
inverses are covered by the unit tests.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from ..functions.scalar import rnd
from ..operators import charts, linear, stat_tests
from ..operators.describe import kendall_pair, spearman_pair
from .base import CUSTOMERS, customers, table
from .registry import query, r


def f_tail(f: str, d2: str) -> str:
    """P-value of F with two numerator degrees of freedom, that is for three groups."""
    return r(f"pow(1.0::double + 2.0::double*({f})/({d2}), -({d2})/2.0::double)", 4)


def line(spark, sf):
    return table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query(f"""WITH s AS (SELECT count(*) AS n, avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS sd FROM lineitem),
  z AS (SELECT avg(pow((l_extendedprice - m)/sd, 3)) AS g, avg(pow((l_extendedprice - m)/sd, 4)) - 3 AS k, any_value(n) AS n FROM lineitem, s)
  SELECT n, {r('n/6.0*(g*g + k*k/4.0)', 2)} AS statistic, {r('exp(-n/6.0*(g*g + k*k/4.0)/2.0)', 4)} AS p_value FROM z""")
def jarque_bera(spark, sf):
    return stat_tests.jarque_bera(line(spark, sf), "l_extendedprice").withColumn("statistic", rnd(F.col("statistic"), 2))


ERFC = "(0.5::double*t*exp(-x*x - 1.26551223::double + t*(1.00002368::double + t*(0.37409196::double + t*(0.09678418::double + t*(-0.18628806::double + t*(0.27886807::double + t*(-1.13520398::double + t*(1.48851587::double + t*(-0.82215223::double + t*0.17087277::double))))))))))"


@query(f"""WITH s AS (SELECT count(*) AS n, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS sd FROM lineitem),
  v AS (SELECT (l_extendedprice - m)/sd AS z, count(*) AS c, any_value(n) AS n FROM lineitem, s GROUP BY 1),
  w AS (SELECT *, sum(c) OVER (ORDER BY z) AS up, abs(z)/sqrt(2.0) AS x FROM v), t AS (SELECT *, 1.0/(1.0 + 0.5*x) AS t FROM w),
  e AS (SELECT *, {ERFC} AS tail FROM t), f AS (SELECT *, CASE WHEN z >= 0 THEN 1 - tail ELSE tail END AS cdf FROM e)
  SELECT any_value(n) AS n, {r('max(greatest(up/n - cdf, cdf - (up - c)/n))', 4)} AS lilliefors_d FROM f""")
def lilliefors(spark, sf):
    return stat_tests.edf_statistics(line(spark, sf), "l_extendedprice").select("n", rnd(F.col("lilliefors_d"), 4).alias("lilliefors_d"))


def horner(coefficients: list[str], x: str) -> str:
    out = coefficients[0]
    for c in coefficients[1:]:
        out = f"({out}*{x} + {c})"
    return out


def erfc_tail(x: str) -> str:
    """Upper normal tail at |z|, with x = |z| / sqrt(2)."""
    return ERFC.replace("t*", "(1.0::double/(1.0::double + 0.5::double*(X_)))*").replace("-x*x", "-(X_)*(X_)").replace("X_", x)


# The published coefficients of the normal quantile, as in the library.
QUANTILE = [
    ["-3.969683028665376e01", "2.209460984245205e02", "-2.759285104469687e02", "1.383577518672690e02", "-3.066479806614716e01", "2.506628277459239e00"],
    ["-5.447609879822406e01", "1.615858368580409e02", "-1.556989798598866e02", "6.680131188771972e01", "-1.328068155288572e01", "1.0"],
    ["-7.784894002430293e-03", "-3.223964580411365e-01", "-2.400758277161838e00", "-2.549732539343734e00", "4.374664141464968e00", "2.938163982698783e00"],
    ["7.784695709041462e-03", "3.224671290700398e-01", "2.445134137142996e00", "3.754408661907416e00", "1.0"],
]
_A, _B, _C, _D = QUANTILE


def normality_ctes(rows: str) -> str:
    """Per group ``g`` of ``rows`` (g, v): n, W', A2, D and the Jarque-Bera statistic with their p-values."""
    mid = f"({horner(_A, '(p-0.5)*(p-0.5)')}*(p-0.5)/{horner(_B, '(p-0.5)*(p-0.5)')})"
    end = f"({horner(_C, 'e')}/{horner(_D, 'e')})"
    return f"""nv AS ({rows}), ns AS (SELECT g, count(*)::double AS n, avg(v) AS m, stddev_samp(v) AS sd, stddev_pop(v) AS sp FROM nv GROUP BY g),
      nk AS (SELECT g, avg(pow((v - m)/sp, 3)) AS s, avg(pow((v - m)/sp, 4)) - 3 AS k FROM nv JOIN ns USING (g) GROUP BY g),
      nd AS (SELECT g, v, count(*)::double AS c FROM nv GROUP BY ALL), nu AS (SELECT *, sum(c) OVER (PARTITION BY g ORDER BY v) AS up FROM nd),
      nz AS (SELECT nu.*, n, (v - m) AS x, (v - m)/sd AS z, abs((v - m)/sd)/sqrt(2.0::double) AS ax, (up - (c - 1)/2.0::double - 0.375::double)/(n + 0.25::double) AS p FROM nu JOIN ns USING (g)),
      nt AS (SELECT *, {erfc_tail('ax')} AS tail, sqrt(-2.0::double*ln(least(p, 1.0::double - p))) AS e FROM nz),
      nl AS (SELECT *, greatest(CASE WHEN z >= 0 THEN 1 - tail ELSE tail END, 1e-300) AS lo, greatest(CASE WHEN z >= 0 THEN tail ELSE 1 - tail END, 1e-300) AS hi,
        CASE WHEN abs(p - 0.5) <= 0.47575 THEN {mid} WHEN p < 0.5 THEN {end} ELSE -{end} END AS y FROM nt),
      na AS (SELECT g, any_value(n) AS n, max(greatest(up/n - lo, lo - (up - c)/n)) AS d,
        -any_value(n) - sum(((up*up - (up - c)*(up - c))*ln(lo) + ((n - up + c)*(n - up + c) - (n - up)*(n - up))*ln(hi))/n) AS a2,
        pow(sum(c*x*y) - sum(c*x)*sum(c*y)/any_value(n), 2)/((sum(c*x*x) - pow(sum(c*x), 2)/any_value(n))*(sum(c*y*y) - pow(sum(c*y), 2)/any_value(n))) AS w FROM nl GROUP BY g),
      nb AS (SELECT *, n/6.0::double*(s*s + k*k/4.0::double) AS jb, a2*(1 + 0.75::double/n + 2.25::double/(n*n)) AS a, least(n, 100) AS ln_, d*CASE WHEN n > 100 THEN pow(n/100.0::double, 0.49::double) ELSE 1 END AS ld,
        (ln(greatest(1 - w, 1e-300)) - (-1.2725::double + 1.0521::double*(ln(ln(n)) - ln(n))))/(1.0308::double - 0.26758::double*(ln(ln(n)) + 2/ln(n))) AS fz FROM na JOIN nk USING (g)),
      np AS (SELECT *, exp(-jb/2) AS p_jb,
        least(exp(-7.01256::double*ld*ld*(ln_ + 2.78019::double) + 2.99587::double*ld*sqrt(ln_ + 2.78019::double) - 0.122119::double + 0.974598::double/sqrt(ln_) + 1.67997::double/ln_), 1.0::double) AS p_d,
        greatest(0.0::double, least(1.0::double, CASE WHEN a >= 153 THEN 0.0::double WHEN a >= 0.6 THEN exp(1.2937::double - 5.709::double*a + 0.0186::double*a*a) WHEN a > 0.34 THEN exp(0.9177::double - 4.279::double*a - 1.38::double*a*a)
          WHEN a > 0.2 THEN 1 - exp(-8.318::double + 42.796::double*a - 59.938::double*a*a) ELSE 1 - exp(-13.436::double + 101.14::double*a - 223.73::double*a*a) END)) AS p_a,
        CASE WHEN fz >= 0 THEN {erfc_tail('(abs(fz)/sqrt(2.0::double))')} ELSE 1 - {erfc_tail('(abs(fz)/sqrt(2.0::double))')} END AS p_w FROM nb)"""


VOTES = "(p_w < 0.05)::int + (p_a < 0.05)::int + (p_d < 0.05)::int + (p_jb < 0.05)::int"


@query(f"""WITH {normality_ctes("SELECT 1 AS g, l_extendedprice AS v FROM lineitem")}, t AS (
    SELECT 'shapiro_francia' AS test, w AS s, p_w AS p, n, {VOTES} AS votes FROM np UNION ALL SELECT 'anderson_darling', a2, p_a, n, {VOTES} FROM np
    UNION ALL SELECT 'lilliefors', d, p_d, n, {VOTES} FROM np UNION ALL SELECT 'jarque_bera', jb, p_jb, n, {VOTES} FROM np)
  SELECT test, {r('s', 3)} AS statistic, {r('p', 4)} AS p_value, p < 0.05 AS rejects, n::bigint AS "rows", votes <= 2 AS is_normal FROM t""")
def normality(spark, sf):
    return stat_tests.normality(table(spark, sf, "lineitem"), "l_extendedprice").withColumn("statistic", rnd(F.col("statistic"), 3))


ONE_WAY = "(sum(n*(m-gm)*(m-gm))/(any_value(k)-1))/(sum((n-1)*s2)/(any_value(nn)-any_value(k)))"


def levene_sql(center: str, name: str) -> str:
    return f"""WITH c AS (SELECT l_returnflag AS g, {center}(l_extendedprice) AS c FROM lineitem GROUP BY 1),
      d AS (SELECT g, abs(l_extendedprice - c) AS v FROM lineitem JOIN c ON g = l_returnflag),
      p AS (SELECT g, count(*) AS n, avg(v) AS m, var_samp(v) AS s2 FROM d GROUP BY 1), t AS (SELECT sum(n*m)/sum(n) AS gm, sum(n) AS nn, count(*) AS k FROM p)
      SELECT '{name}' AS test, {r(ONE_WAY, 4)} AS statistic, {f_tail(ONE_WAY, 'any_value(nn) - 3')} AS p_value, count(*)::int AS groups,
      {f_tail(ONE_WAY, 'any_value(nn) - 3')} >= 0.05 AS equal_variance FROM p, t"""


@query(levene_sql("median", "brown_forsythe"))
def brown_forsythe(spark, sf):
    return stat_tests.variance_homogeneity(line(spark, sf), "l_extendedprice", "l_returnflag")


@query(levene_sql("avg", "levene"))
def levene(spark, sf):
    return stat_tests.variance_homogeneity(line(spark, sf), "l_extendedprice", "l_returnflag", "mean")


WELCH = "q/(k-1)/(1 + 2*(k-2)/(k*k-1)*lam)"
MOMENTS = "p AS (SELECT l_returnflag AS g, count(*) AS n, avg(l_extendedprice) AS m, var_samp(l_extendedprice) AS s2 FROM lineitem GROUP BY 1)"


@query(f"""WITH {MOMENTS}, t AS (SELECT sum(n*m)/sum(n) AS gm, sum(n) AS nn, count(*) AS k FROM p)
  SELECT 'anova' AS test, {r(ONE_WAY, 4)} AS statistic, {f_tail(ONE_WAY, 'any_value(nn) - 3')} AS p_value, count(*)::int AS groups FROM p, t""")
def anova(spark, sf):
    return stat_tests.anova(line(spark, sf), "l_extendedprice", "l_returnflag")


@query(f"""WITH {MOMENTS}, w AS (SELECT *, n/s2 AS w FROM p), t AS (SELECT sum(w*m)/sum(w) AS gm, sum(w) AS ww, count(*) AS k FROM w),
  l AS (SELECT sum(pow(1 - w/ww, 2)/(n - 1)) AS lam, sum(w*(m-gm)*(m-gm)) AS q, any_value(k) AS k FROM w, t)
  SELECT 'welch_anova' AS test, {r(WELCH, 4)} AS statistic, {f_tail(WELCH, '(k*k-1)/(3*lam)')} AS p_value, k::int AS groups FROM l""")
def welch(spark, sf):
    return stat_tests.welch_anova(line(spark, sf), "l_extendedprice", "l_returnflag")


TWO = "p AS (SELECT l_linestatus AS g, count(*) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS v FROM lineitem GROUP BY 1), a AS (SELECT * FROM p ORDER BY g LIMIT 1), b AS (SELECT * FROM p ORDER BY g DESC LIMIT 1)"


@query(f"""WITH {TWO} SELECT 'student_t' AS test, {r('(a.m-b.m)/sqrt(((a.n-1)*a.v+(b.n-1)*b.v)/(a.n+b.n-2)*(1.0/a.n+1.0/b.n))', 4)} AS statistic, 2::int AS groups FROM a, b
  UNION ALL SELECT 'welch_t', {r('(a.m-b.m)/sqrt(a.v/a.n + b.v/b.n)', 4)}, 2::int FROM a, b""")
def t_tests(spark, sf):
    rows = line(spark, sf)
    both = stat_tests.student_t(rows, "l_quantity", "l_linestatus").unionByName(stat_tests.student_t(rows, "l_quantity", "l_linestatus", False))
    return both.select("test", "statistic", "groups")


def ranks_sql(group: str) -> str:
    return f"""k AS (SELECT {group} AS g, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1)/2.0::double AS rk FROM lineitem),
      s AS (SELECT g, count(*) AS n, sum(rk) AS rs FROM k GROUP BY 1), tt AS (SELECT sum(c::double*c*c - c) AS t, sum(c)::double AS nn FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_quantity))"""


H = "(12.0/(any_value(nn)*(any_value(nn)+1))*sum(rs*rs/n) - 3*(any_value(nn)+1))/(1 - any_value(t)/(any_value(nn)*any_value(nn)*any_value(nn) - any_value(nn)))"


# With three groups the chi-square tail is exp(-H / 2).
@query(f"""WITH {ranks_sql('l_returnflag')} SELECT 'kruskal' AS test, {r(H, 3)} AS statistic, {r(f'exp(-({H})/2.0::double)', 3)} AS p_value, count(*)::int AS groups FROM s, tt""")
def kruskal(spark, sf):
    out = stat_tests.kruskal(line(spark, sf), "l_quantity", "l_returnflag")
    return out.select("test", rnd(F.col("statistic"), 3).alias("statistic"), rnd(F.col("p_value"), 3).alias("p_value"), "groups")


@query(f"""WITH {ranks_sql('l_linestatus')} SELECT 'mann_whitney' AS test, arg_min(rs - n*(n+1)/2.0::double, g) AS statistic, 2::int AS groups FROM s""")
def mann_whitney(spark, sf):
    return stat_tests.mann_whitney(line(spark, sf), "l_quantity", "l_linestatus").select("test", "statistic", "groups")


RK = """rk AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1)/2.0::double AS a,
  rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1)/2.0::double AS b FROM lineitem)"""


@query(f"WITH {RK} SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, {r('corr(a, b)', 4)} AS r, count(*) AS n FROM rk")
def spearman(spark, sf):
    return spearman_pair(line(spark, sf), "l_quantity", "l_extendedprice").withColumn("r", rnd(F.col("r"), 4))


# Pairs are counted per quantity level: at each price, how many lower prices every level has.
@query(f"""WITH p AS (SELECT l_quantity AS q, l_extendedprice AS v, count(*) AS c FROM lineitem GROUP BY ALL), lv AS (SELECT DISTINCT q AS k FROM p), vs AS (SELECT DISTINCT v FROM p),
  under AS (SELECT k, vs.v, sum(coalesce(c, 0)) OVER (PARTITION BY k ORDER BY vs.v) - coalesce(c, 0) AS b FROM lv CROSS JOIN vs LEFT JOIN p ON p.q = k AND p.v = vs.v),
  s AS (SELECT sum(c*b) FILTER (k < q) AS conc, sum(c*b) FILTER (k > q) AS disc FROM p JOIN under USING (v)),
  n AS (SELECT count(*)::double AS n FROM lineitem), tx AS (SELECT sum(m::double*(m-1)/2) AS t FROM (SELECT count(*) AS m FROM lineitem GROUP BY l_quantity)),
  ty AS (SELECT sum(m::double*(m-1)/2) AS t FROM (SELECT count(*) AS m FROM lineitem GROUP BY l_extendedprice))
  SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, {r('(conc - disc)::double/sqrt((n*(n-1)/2 - tx.t)*(n*(n-1)/2 - ty.t))', 4)} AS r, n::bigint AS n FROM s, n, tx, ty""")
def kendall(spark, sf):
    return kendall_pair(line(spark, sf), "l_quantity", "l_extendedprice").withColumn("r", rnd(F.col("r"), 4))


# Neither column passes the normality tests, so the ranks are correlated; with so many rows t is normal to three digits.
@query(f"""WITH {RK}, one AS (SELECT corr(a, b) AS c, count(*) AS n FROM rk), u AS (SELECT *, abs(c)*sqrt((n - 2)/(1 - c*c))/sqrt(2.0::double) AS x FROM one),
  w AS (SELECT *, 1.0::double/(1.0::double + 0.5::double*x) AS t FROM u) SELECT 'spearman' AS method, {r('c', 4)} AS r, {r(f'2*{ERFC}', 3)} AS p_value, n,
  CASE WHEN abs(c) >= 0.7 THEN 'fuerte' WHEN abs(c) >= 0.4 THEN 'moderada' WHEN abs(c) >= 0.2 THEN 'debil' ELSE 'muy debil' END AS strength FROM w""")
def correlation_auto(spark, sf):
    out = stat_tests.correlation_test(line(spark, sf), "l_quantity", "l_extendedprice", "auto")
    return out.withColumn("p_value", rnd(F.col("p_value"), 3))


@query(f"""WITH a AS (SELECT l_returnflag AS g, corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem GROUP BY 1), o AS (SELECT corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem)
  SELECT g AS "group", a.n, {r('a.r', 4)} AS r, {r('o.r', 4)} AS overall_r, sign(a.r) <> sign(o.r) AND sign(a.r) <> 0 AND sign(o.r) <> 0 AS is_opposite, o.n AS total FROM a, o WHERE a.n >= 20""")
def simpson(spark, sf):
    return stat_tests.simpson_groups(line(spark, sf), "l_quantity", "l_extendedprice", "l_returnflag", "pearson")


@query(f"""WITH k AS (SELECT l_returnflag AS g, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1)/2.0::double AS x,
    rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1)/2.0::double AS y FROM lineitem),
  a AS (SELECT g, corr(x, y) AS r, count(*) AS n FROM k GROUP BY 1), {RK}, o AS (SELECT corr(a, b) AS r, count(*) AS n FROM rk)
  SELECT count(*) AS valid_groups, any_value({r('o.r', 4)}) AS overall_r, coalesce(sum(a.n) FILTER (sign(a.r) <> sign(o.r)), 0)::bigint AS opposite_rows,
  coalesce(sum(a.n) FILTER (sign(a.r) <> sign(o.r)), 0) >= 0.5*any_value(o.n) AND abs(any_value(o.r)) >= 0.1 AND count(*) >= 2 AS paradox FROM a, o WHERE a.n >= 20""")
def simpson_spearman(spark, sf):
    return stat_tests.simpson_verdict(stat_tests.simpson_groups(line(spark, sf), "l_quantity", "l_extendedprice", "l_returnflag"))


PRICE_RANKS = """k AS (SELECT l_returnflag AS g, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1)/2.0::double AS rk FROM lineitem),
  s AS (SELECT g, count(*) AS n, sum(rk) AS rs FROM k GROUP BY 1), tt AS (SELECT sum(c::double*c*c - c) AS t, sum(c)::double AS nn FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_extendedprice))"""


# The groups are not normal, so three of them are compared by ranks; the effect size is eta squared.
@query(f"""WITH {PRICE_RANKS}, h AS (SELECT {H} AS h FROM s, tt), {MOMENTS}, t AS (SELECT sum(n*m)/sum(n) AS gm FROM p),
  e AS (SELECT sum(n*(m-gm)*(m-gm)) AS b, sum(n*(m-gm)*(m-gm)) + sum((n-1)*s2) AS a FROM p, t)
  SELECT 'kruskal' AS test, {r('h', 3)} AS statistic, {r('exp(-h/2.0::double)', 3)} AS p_value, 3::int AS groups, {r('b/a', 4)} AS effect_size, exp(-h/2.0::double) < 0.05 AS rejects FROM h, e""")
def compare_groups(spark, sf):
    out = stat_tests.compare_groups(line(spark, sf), "l_extendedprice", "l_returnflag")
    return out.withColumns({"statistic": rnd(F.col("statistic"), 3), "p_value": rnd(F.col("p_value"), 3), "effect_size": rnd(F.col("effect_size"), 4)})


# For two predictors the VIF has the closed form 1 / (1 - r^2).
@query(f"""WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem)
  SELECT column_name, {r('1/(1-r*r)', 4)} AS vif, CASE WHEN 1/(1-r*r) >= 10 THEN 'severa' WHEN 1/(1-r*r) >= 5 THEN 'relevante' ELSE 'manejable' END AS band
  FROM c, (VALUES ('l_quantity'), ('l_extendedprice')) t(column_name)""")
def vif_two(spark, sf):
    return linear.collinearity(line(spark, sf), ["l_quantity", "l_extendedprice"])["vif"]


# Three predictors: the inverse of a 3 x 3 correlation matrix written out.
@query(f"""WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS ab, corr(l_quantity, l_discount) AS ac, corr(l_extendedprice, l_discount) AS bc FROM lineitem),
  d AS (SELECT *, 1 + 2*ab*ac*bc - ab*ab - ac*ac - bc*bc AS det FROM c), v AS (SELECT 'l_quantity' AS column_name, (1 - bc*bc)/det AS v FROM d
    UNION ALL SELECT 'l_extendedprice', (1 - ac*ac)/det FROM d UNION ALL SELECT 'l_discount', (1 - ab*ab)/det FROM d)
  SELECT column_name, {r('v', 4)} AS vif, CASE WHEN v >= 10 THEN 'severa' WHEN v >= 5 THEN 'relevante' ELSE 'manejable' END AS band FROM v""")
def vif_three(spark, sf):
    return linear.collinearity(line(spark, sf), ["l_quantity", "l_extendedprice", "l_discount"])["vif"]


@query()
def vif(spark, sf):
    rows = line(spark, sf).withColumn("echo", F.col("l_quantity") * 2.0 + F.col("l_discount"))
    return linear.collinearity(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "echo"])["vif"]


@query()
def belsley(spark, sf):
    rows = line(spark, sf).withColumn("echo", F.col("l_quantity") * 2.0 + F.col("l_discount"))
    return linear.collinearity(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "echo"])["variance_shares"]


@query()
def vif_mitigation(spark, sf):
    rows = line(spark, sf).withColumn("echo", F.col("l_quantity") * 2.0 + F.col("l_discount"))
    return linear.collinearity(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "echo"])["mitigation"]


SIMPLE = """g AS (SELECT count(*) AS n, avg(l_quantity) AS mx, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, var_pop(l_quantity)*count(*) AS sxx FROM lineitem),
  e AS (SELECT l_extendedprice - a - b*l_quantity AS e, 1.0/n + (l_quantity-mx)*(l_quantity-mx)/sxx AS h, l_quantity - mx AS d, n, sxx, a, b, mx FROM lineitem, g)"""


@query(f"""WITH {SIMPLE}, m AS (SELECT any_value(a) AS a, any_value(b) AS b, sqrt(sum(e*e/((1-h)*(1-h))*d*d))/any_value(sxx) AS sb,
    sqrt(sum(e*e/((1-h)*(1-h))*pow(1.0/n - mx*d/sxx, 2))) AS sa FROM e)
  SELECT 'const' AS term, {r('a', 2)} AS coef, {r('sa', 2)} AS std_error FROM m UNION ALL SELECT 'l_quantity', {r('b', 2)}, {r('sb', 2)} FROM m""")
def ols_hc3_simple(spark, sf):
    out = linear.ols(line(spark, sf), "l_extendedprice", ["l_quantity"]).coefficients
    return out.select("term", rnd(F.col("coef"), 2).alias("coef"), rnd(F.col("std_error"), 2).alias("std_error"))


@query()
def ols_hc3(spark, sf):
    return linear.ols(line(spark, sf), "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "l_returnflag"]).coefficients


@query()
def ols_fit_stats(spark, sf):
    return linear.ols(line(spark, sf), "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "l_returnflag"]).fit_stats


@query(f"WITH {SIMPLE} SELECT {r('regr_r2(e*e, d)*count(*)', 2)} AS statistic FROM e")
def breusch_pagan(spark, sf):
    lm, p, dof = linear.breusch_pagan(linear.ols(line(spark, sf), "l_extendedprice", ["l_quantity"]))
    return spark.createDataFrame([(lm,)], "statistic double").select(rnd(F.col("statistic"), 2).alias("statistic"))


@query()
def dispersion_tests(spark, sf):
    result = linear.ols(line(spark, sf), "l_extendedprice", ["l_quantity", "l_discount"], keep=["l_returnflag"])
    return linear.dispersion_audit(result, group="l_returnflag")["tests"]


@query()
def dispersion_verdict(spark, sf):
    return linear.dispersion_audit(linear.ols(line(spark, sf), "l_extendedprice", ["l_quantity", "l_discount"]))["summary"]


@query(f"""WITH t AS (SELECT o_totalprice - avg(o_totalprice) OVER () AS e, o_orderdate, o_orderkey FROM orders), d AS (SELECT e, e - lag(e) OVER (ORDER BY o_orderdate, o_orderkey) AS s FROM t)
  SELECT {r('sum(s*s)/sum(e*e)', 4)} AS durbin_watson, count(*) AS "rows" FROM d""")
def durbin_watson(spark, sf):
    o = table(spark, sf, "orders")
    mean = o.agg(F.avg("o_totalprice")).first()[0]
    return linear.durbin_watson(o.withColumn("e", F.col("o_totalprice") - mean), "e", ["o_orderdate", "o_orderkey"])


# One categorical predictor: the fit is the group mean and the leverage one over the group's rows.
@query(f"""WITH g AS (SELECT o_orderpriority, avg(o_totalprice) AS m, count(*)::double AS n FROM orders GROUP BY 1),
  e AS (SELECT o_orderkey, o_totalprice - m AS e, 1.0::double/n AS h FROM orders JOIN g USING (o_orderpriority)),
  s AS (SELECT sum(e*e)/(count(*) - (SELECT count(*) FROM g)) AS s2, (SELECT count(*) FROM g) AS k FROM e),
  c AS (SELECT o_orderkey, e*e*h/(k*s2*(1-h)*(1-h)) AS cooks, h, e/sqrt(s2*(1-h)) AS z FROM e, s)
  SELECT o_orderkey, {r('cooks', 6)} AS cooks_distance, {r('h', 6)} AS leverage, {r('z', 4)} AS standard_residual FROM c ORDER BY cooks DESC, o_orderkey LIMIT 10""")
def influence(spark, sf):
    result = linear.ols(table(spark, sf, "orders"), "o_totalprice", ["o_orderpriority"], keep=["o_orderkey"])
    top = linear.influence_report(result, 10)
    return top.select("o_orderkey", rnd(F.col("cooks_distance"), 6).alias("cooks_distance"), rnd(F.col("leverage"), 6).alias("leverage"), rnd(F.col("standard_residual"), 4).alias("standard_residual"))


PROBES = [i / 100 for i in range(1, 100)]
_PROBE_ROWS = ", ".join(f"({p!r}::double, {NormalDist().inv_cdf(p)!r}::double)" for p in PROBES)


@query(f"""WITH z AS (SELECT * FROM (VALUES {_PROBE_ROWS}) v(prob, z)), s AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS d FROM lineitem),
  q AS (SELECT unnest({PROBES}::double[]) AS prob, unnest(quantile_cont(l_extendedprice, {PROBES})) AS x FROM lineitem)
  SELECT prob, {r('m + d*z', 2)} AS normal, {r('x', 4)} AS sample FROM q JOIN z USING (prob), s""")
def chart_qq(spark, sf):
    return stat_tests.qq_points(line(spark, sf), "l_extendedprice").withColumn("normal", rnd(F.col("normal"), 2))


@query()
def chart_residuals(spark, sf):
    result = linear.ols(line(spark, sf), "l_extendedprice", ["l_quantity", "l_discount"])
    return charts.binned_pairs(result.residuals, F.col("fitted"), F.col("residual"), 10)


@query(f"""WITH {CUSTOMERS}, {normality_ctes("SELECT segment AS g, balance::double AS v FROM people")}
  SELECT g AS "group", n::bigint AS n, {r('p_w', 4)} AS p_francia, {r('p_a', 4)} AS p_anderson, {r('p_d', 4)} AS p_lilliefors, {r('p_jb', 4)} AS p_jarque_bera, {VOTES} <= 2 AS is_normal FROM np""")
def group_normality(spark, sf):
    return stat_tests.group_normality(customers(spark, sf), "balance", "segment")
