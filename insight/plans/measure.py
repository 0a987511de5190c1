"""Measurement queries: ratings by age on ``events`` (M1-M3), review scores per
part from return flags (M4-M7), A/B statistics on ``orders`` (M8-M11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.operators import measure as M
from insight.plans.registry import ORACLES, i64, query, r
from insight.sources import Tables

_AGE = """e AS (SELECT event_type, value,
  date_diff('day', CAST(ts AS DATE), (SELECT CAST(max(ts) AS DATE) FROM events)) AS days FROM events)"""


def _events_age(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    ref = e.agg(F.to_date(F.max("ts")).alias("_ref"))
    return e.crossJoin(F.broadcast(ref)).select(
        "event_type", "value", F.datediff("_ref", F.to_date("ts")).alias("days"))


@query("avg_rating", sql="SELECT round(avg(value), 6) AS avg_rating, CAST(count(value) AS BIGINT) AS n FROM events")
def q_avg_rating(spark, sf_dir):
    """M1: the plain average."""
    e = Tables(spark, sf_dir).events
    return e.agg(r(F.avg("value")).alias("avg_rating"), i64(F.count("value")).alias("n"))


@query("avg_by_age", sql=f"""WITH {_AGE}, q AS (SELECT quantile_cont(days, [0.25, 0.5, 0.75]) AS q FROM e)
SELECT CASE WHEN days <= q[1] THEN 1 WHEN days <= q[2] THEN 2 WHEN days <= q[3] THEN 3 ELSE 4 END
  AS quartile, round(avg(value), 6) AS avg_rating, CAST(count(value) AS BIGINT) AS n
FROM e, q GROUP BY 1""")
def q_avg_by_age(spark, sf_dir):
    out = M.avg_by_age(_events_age(spark, sf_dir), "days", "value")
    return out.select("quartile", r("avg_rating").alias("avg_rating"), i64("n").alias("n"))


@query("time_weighted_avg", sql=f"""WITH {_AGE},
q AS (SELECT event_type, quantile_cont(days, [0.25, 0.5, 0.75]) AS q FROM e GROUP BY event_type),
b AS (SELECT e.event_type, value, CASE WHEN days <= q[1] THEN 1 WHEN days <= q[2] THEN 2
      WHEN days <= q[3] THEN 3 ELSE 4 END AS k FROM e JOIN q USING (event_type))
SELECT event_type, round(avg(CASE WHEN k = 1 THEN value END) * 28 / 100
  + avg(CASE WHEN k = 2 THEN value END) * 26 / 100 + avg(CASE WHEN k = 3 THEN value END) * 24 / 100
  + avg(CASE WHEN k = 4 THEN value END) * 22 / 100, 6) AS weighted_rating FROM b GROUP BY event_type""")
def q_time_weighted_avg(spark, sf_dir):
    out = M.time_based_weighted_average(_events_age(spark, sf_dir), "days", "value", ["event_type"])
    return out.select("event_type", r("weighted_rating").alias("weighted_rating"))


_VOTES = """v AS (SELECT l_partkey, count_if(l_returnflag IN ('A', 'N')) AS up,
  count_if(l_returnflag = 'R') AS down FROM lineitem GROUP BY l_partkey),
z AS (SELECT 1.959963984540054 AS z),
s AS (SELECT l_partkey, up, down, up - down AS score_pos_neg_diff,
  CASE WHEN up + down = 0 THEN 0.0 ELSE up / (up + down) END AS score_average_rating,
  CASE WHEN up + down = 0 THEN 0.0 ELSE
   (up / (up + down) + z * z / (2 * (up + down)) - z * sqrt((up / (up + down) * (1 - up / (up + down))
    + z * z / (4 * (up + down))) / (up + down))) / (1 + z * z / (up + down)) END AS wilson_lower_bound
  FROM v, z)"""


def _votes(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    v = li.groupBy("l_partkey").agg(F.count_if(F.col("l_returnflag").isin("A", "N")).alias("up"),
                                    F.count_if(F.col("l_returnflag") == "R").alias("down"))
    return M.review_scores(v, "up", "down")


@query("vote_scores", sql=f"""WITH {_VOTES}
SELECT l_partkey, CAST(up AS BIGINT) AS up, CAST(down AS BIGINT) AS down,
  CAST(score_pos_neg_diff AS BIGINT) AS score_pos_neg_diff,
  round(score_average_rating, 6) AS score_average_rating,
  round(wilson_lower_bound, 6) AS wilson_lower_bound FROM s""")
def q_vote_scores(spark, sf_dir):
    s = _votes(spark, sf_dir)
    return s.select("l_partkey", i64("up").alias("up"), i64("down").alias("down"),
                    i64("score_pos_neg_diff").alias("score_pos_neg_diff"),
                    r("score_average_rating").alias("score_average_rating"),
                    r("wilson_lower_bound").alias("wilson_lower_bound"))


@query("wilson_top", sql=f"""WITH {_VOTES}
SELECT l_partkey, round(wilson_lower_bound, 6) AS wilson_lower_bound FROM s
ORDER BY wilson_lower_bound DESC, l_partkey LIMIT 20""")
def q_wilson_top(spark, sf_dir):
    """M7: the top-20 report by Wilson lower bound (a top-k report: the limit is the feature)."""
    s = _votes(spark, sf_dir)
    return s.orderBy(F.col("wilson_lower_bound").desc(), "l_partkey").limit(20).select(
        "l_partkey", r("wilson_lower_bound").alias("wilson_lower_bound"))


@query("t_test_stat", sql="""WITH g AS (SELECT o_orderpriority AS g, count(*) AS n, avg(o_totalprice) AS m,
  var_samp(o_totalprice) AS v FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1),
a AS (SELECT * FROM g WHERE g = '1-URGENT'), b AS (SELECT * FROM g WHERE g = '5-LOW')
SELECT round((a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2)
  * (1.0 / a.n + 1.0 / b.n)), 6) AS t_stat, CAST(a.n + b.n - 2 AS BIGINT) AS dof FROM a, b""")
def q_t_test_stat(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    t = M.ttest_ind(o, "o_orderpriority", "o_totalprice", "1-URGENT", "5-LOW")
    return t.select(r("t_stat").alias("t_stat"), "dof")


@query("levene_stat", sql="""WITH x AS (SELECT o_orderpriority AS g, o_totalprice AS v FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '5-LOW')),
m AS (SELECT g, quantile_cont(v, 0.5) AS med FROM x GROUP BY g),
z AS (SELECT x.g, abs(v - med) AS z FROM x JOIN m USING (g)),
gi AS (SELECT g, count(*) AS ni, avg(z) AS zi FROM z GROUP BY g),
t AS (SELECT count(*) AS n, avg(z) AS zbar FROM z),
w AS (SELECT sum((z - zi) * (z - zi)) AS within FROM z JOIN gi USING (g)),
b AS (SELECT sum(ni * (zi - zbar) * (zi - zbar)) AS between FROM gi, t)
SELECT round((n - 2) / 1.0 * between / within, 6) AS w_stat, CAST(1 AS BIGINT) AS df1,
  CAST(n - 2 AS BIGINT) AS df2 FROM t, w, b""")
def q_levene_stat(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    w = M.levene(o, "o_orderpriority", "o_totalprice")
    return w.select(r("w_stat").alias("w_stat"), "df1", "df2")


@query("samples_t_stat", sql="""WITH s AS (SELECT 'early' AS g, o_totalprice AS v FROM orders WHERE o_orderdate < DATE '1996-01-01'
  UNION ALL SELECT 'late', o_totalprice FROM orders WHERE o_orderdate >= DATE '1996-01-01'),
m AS (SELECT g, count(v) AS n, avg(v) AS m, var_samp(v) AS s2 FROM s GROUP BY g)
SELECT round((a.m - b.m) / sqrt(((a.n - 1) * a.s2 + (b.n - 1) * b.s2) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)), 6) AS t_stat,
  CAST(a.n + b.n - 2 AS BIGINT) AS dof FROM m a, m b WHERE a.g = 'early' AND b.g = 'late'""")
def q_samples_t_stat(spark, sf_dir):
    """Two tables of orders as labelled samples, and their t statistic."""
    o, cut = Tables(spark, sf_dir).orders, F.lit("1996-01-01").cast("timestamp")
    both = M.label_samples({"early": o.where(F.col("o_orderdate") < cut).select("o_totalprice"),
                            "late": o.where(F.col("o_orderdate") >= cut).select("o_totalprice")})
    t = M.ttest_ind(both, "group", "o_totalprice", "early", "late")
    return t.select(r("t_stat").alias("t_stat"), "dof")


@query("two_prop_z", sql="""WITH s AS (SELECT
  count_if(o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS x1,
  count_if(o_orderpriority = '1-URGENT') AS n1,
  count_if(o_orderpriority = '5-LOW' AND o_orderstatus = 'F') AS x2,
  count_if(o_orderpriority = '5-LOW') AS n2 FROM orders)
SELECT round((x1 / n1 - x2 / n2) / sqrt((x1 + x2) / (n1 + n2) * (1 - (x1 + x2) / (n1 + n2))
  * (1.0 / n1 + 1.0 / n2)), 6) AS z_stat, round(x1 / n1, 6) AS p1, round(x2 / n2, 6) AS p2 FROM s""")
def q_two_prop_z(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    z = M.proportions_ztest(o, "o_orderpriority", F.col("o_orderstatus") == "F", "1-URGENT", "5-LOW")
    return z.select(r("z_stat").alias("z_stat"), r("p1").alias("p1"), r("p2").alias("p2"))


#: Two-sided t probabilities by the finite series in the angle atan(t / sqrt(dof)); with one degree of freedom between
#: the groups, F is t squared. The normal integral by Simpson's rule.
_AB_SQL = f"""WITH t AS ({ORACLES['t_test_stat']}), w AS ({ORACLES['levene_stat']}), z AS ({ORACLES['two_prop_z']}),
u AS (SELECT 't_test' AS test, t_stat AS statistic, abs(t_stat) AS t, dof FROM t
  UNION ALL SELECT 'levene', w_stat, sqrt(w_stat), df2 FROM w),
v AS (SELECT *, atan(t / sqrt(dof)) AS th, CASE WHEN dof % 2 = 0 THEN dof // 2 ELSE (dof - 1) // 2 END AS terms FROM u),
s AS (SELECT test, statistic, dof, th, sum(CASE
    WHEN dof % 2 = 0 THEN exp(lgamma(k + 0.5) - lgamma(k + 1.0) - ln(pi()) / 2 + 2 * k * ln(cos(th)))
    ELSE exp(lgamma(k + 1.0) - lgamma(k + 1.5) + ln(pi()) / 2 - ln(2) + (2 * k + 1) * ln(cos(th))) END) AS f
  FROM (SELECT *, unnest(generate_series(0, terms - 1)) AS k FROM v) GROUP BY test, statistic, dof, th)
SELECT test, statistic, round(CASE WHEN dof % 2 = 0 THEN 1 - sin(th) * f ELSE 1 - 2 / pi() * (th + sin(th) * f) END, 6) AS p_value FROM s
UNION ALL SELECT 'two_prop_z', any_value(z_stat), round(1 - 2 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
  * exp(-pow(z_stat * i / 2000, 2) / 2) / sqrt(2 * pi())) * abs(any_value(z_stat)) / 6000, 6)
FROM z, (SELECT unnest(generate_series(0, 2000)) AS i)"""


@query("ab_test", sql=_AB_SQL)
def q_ab_test(spark, sf_dir):
    """M9-M11 with p-values: statistics from Spark, p from a few scalars."""
    t = q_t_test_stat(spark, sf_dir).first()
    w = q_levene_stat(spark, sf_dir).first()
    z = q_two_prop_z(spark, sf_dir).first()
    rows = [("t_test", float(t["t_stat"]), M.t_two_sided_p(t["t_stat"], t["dof"])),
            ("levene", float(w["w_stat"]), M.f_upper_p(w["w_stat"], w["df1"], w["df2"])),
            ("two_prop_z", float(z["z_stat"]), M.normal_two_sided_p(z["z_stat"]))]
    out = spark.createDataFrame(rows, "test string, statistic double, p_value double")
    return out.withColumn("p_value", r("p_value"))


def _shapiro_sql() -> str:
    """The statistics over all rows ranked one by one, with the fixed coefficients of the approximations."""
    def poly(coefs, x: str) -> str:
        out = "CAST(0 AS DOUBLE)"
        for c in coefs:
            out = f"({out} * ({x}) + CAST({c!r} AS DOUBLE))"
        return out

    def ppf(p: str) -> str:
        low, high, q = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))", f"({p} - 0.5)"
        def ratio(parts, x: str) -> str:
            return f"{poly(parts[0], x)} / {poly(parts[1], x)}"
        return (f"CASE WHEN {p} < 0.02425 THEN {ratio(M.PPF_TAIL, low)} WHEN {p} > 1 - 0.02425 THEN -({ratio(M.PPF_TAIL, high)}) "
                f"ELSE {ratio(M.PPF_CENTRE, f'{q} * {q}')} * {q} END")

    def upper(z: str) -> str:
        t = f"(1 / (1 + abs({z}) / sqrt(2) / 2))"
        tail = f"({t} * exp(-({z}) * ({z}) / 2 + {poly(M.ERFC, t)}) / 2)"
        return f"CASE WHEN {z} >= 0 THEN {tail} ELSE 1 - {tail} END"

    large = " ".join(f"WHEN moved <= {end} THEN {poly(coefs, 'moved')}" for end, coefs in M.KS_PIECES)
    return f"""WITH x AS (SELECT o_orderpriority AS g, CAST(o_totalprice AS DOUBLE) AS v,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS i,
  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_totalprice IS NOT NULL),
p AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM x),
m AS (SELECT *, {ppf('p')} AS m FROM p),
s AS (SELECT g, n, avg(v) AS mean, sum(m * m) AS mm, var_pop(v) * n AS ss, 1 / sqrt(n) AS u,
  max(CASE WHEN i = n THEN m END) AS mn, max(CASE WHEN i = n - 1 THEN m END) AS mn1 FROM m GROUP BY g, n),
e AS (SELECT *, {poly(M.SW_AN, 'u')} + mn / sqrt(mm) AS an, {poly(M.SW_AN1, 'u')} + mn1 / sqrt(mm) AS an1 FROM s),
f AS (SELECT *, (mm - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * an * an - 2 * an1 * an1) AS phi FROM e),
w AS (SELECT g, n, pow(sum(v * CASE WHEN i = 1 THEN -an WHEN i = 2 THEN -an1 WHEN i = n - 1 THEN an1 WHEN i = n THEN an ELSE m / sqrt(phi) END), 2) / any_value(ss) AS w
  FROM m JOIN f USING (g, n) GROUP BY g, n),
k AS (SELECT g, n, max(greatest(i / n - below, below - (i - 1) / n)) AS d FROM (
  SELECT g, n, i, 1 - ({upper('z')}) AS below FROM (SELECT x.*, (v - mean) / sqrt(ss / (n - 1)) AS z FROM x JOIN s USING (g, n))) GROUP BY g, n),
q AS (SELECT g, d, exp({poly(M.KS_HUNDRED, 'd * pow(n / 100, 0.49)')}) AS small, (sqrt(n) - 0.01 + 0.85 / sqrt(n)) * d AS moved FROM k),
l AS (SELECT w.*, d, CASE WHEN small <= 0.1 THEN small ELSE CASE {large} ELSE 0 END END AS ks,
  (ln(greatest(1 - w, 1e-19)) - {poly(M.SW_MU, 'ln(n)')}) / exp({poly(M.SW_SIGMA, 'ln(n)')}) AS z FROM w JOIN q USING (g))
SELECT g AS o_orderpriority, CAST(n AS BIGINT) AS n, round(w, 6) AS w_stat, CASE WHEN n > {M.SW_MOST} THEN round(d, 6) END AS ks_stat,
  round(CASE WHEN n > {M.SW_MOST} THEN least(greatest(ks, 0), 1) ELSE {upper('z')} END, 6) AS p_value,
  CASE WHEN n > {M.SW_MOST} THEN 'kolmogorov_smirnov' ELSE 'shapiro_wilk' END AS test FROM l"""


@query("shapiro", sql=_shapiro_sql())
def q_shapiro(spark, sf_dir):
    """M8: normality of order value for the two priority groups."""
    o = Tables(spark, sf_dir).orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    sw = M.shapiro_wilk(o, "o_totalprice", "o_orderpriority")
    return sw.select("o_orderpriority", "n", r("w_stat").alias("w_stat"), r("ks_stat").alias("ks_stat"),
                     r("p_value").alias("p_value"), "test")
