"""CRM queries: RFM on ``orders`` keyed by ``o_custkey`` (C1-C5, C12) and the
lifetime-value base table and likelihoods (C6-C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.operators import cltv, rfm
from insight.plans.registry import i64, query, r
from insight.sources import Tables

_RFM_CTE = """
per AS (SELECT o_custkey AS customer_id, max(o_orderdate) AS last_date,
               count(*) AS frequency, round(sum(o_totalprice), 2) AS monetary
        FROM orders GROUP BY o_custkey),
ref AS (SELECT CAST(max(last_date) AS DATE) + 2 AS analysis_date FROM per),
rfm AS (SELECT customer_id,
               date_diff('day', CAST(last_date AS DATE), analysis_date) AS recency,
               frequency, monetary
        FROM per, ref)"""

_SCORES_CTE = _RFM_CTE + """,
n AS (SELECT count(*) AS n FROM rfm),
e AS (SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS e FROM rfm),
ranked AS (SELECT rfm.*,
                  row_number() OVER (ORDER BY frequency, customer_id) AS fr,
                  row_number() OVER (ORDER BY monetary, customer_id) AS mr
           FROM rfm),
scored AS (
  SELECT customer_id, recency, frequency, monetary,
    CASE WHEN recency <= e[1] THEN 5 WHEN recency <= e[2] THEN 4
         WHEN recency <= e[3] THEN 3 WHEN recency <= e[4] THEN 2 ELSE 1 END AS recency_score,
    CASE WHEN fr <= 1 + (n - 1) // 5 THEN 1 WHEN fr <= 1 + (2 * (n - 1)) // 5 THEN 2
         WHEN fr <= 1 + (3 * (n - 1)) // 5 THEN 3 WHEN fr <= 1 + (4 * (n - 1)) // 5 THEN 4
         ELSE 5 END AS frequency_score,
    CASE WHEN mr <= 1 + (n - 1) // 5 THEN 1 WHEN mr <= 1 + (2 * (n - 1)) // 5 THEN 2
         WHEN mr <= 1 + (3 * (n - 1)) // 5 THEN 3 WHEN mr <= 1 + (4 * (n - 1)) // 5 THEN 4
         ELSE 5 END AS monetary_score
  FROM ranked, n, e),
seg AS (
  SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) AS rf_score
  FROM scored),
segmented AS (
  SELECT *, CASE
    WHEN regexp_full_match(rf_score, '[1-2][1-2]') THEN 'hibernating'
    WHEN regexp_full_match(rf_score, '[1-2][3-4]') THEN 'at_Risk'
    WHEN regexp_full_match(rf_score, '[1-2]5') THEN 'cant_loose'
    WHEN regexp_full_match(rf_score, '3[1-2]') THEN 'about_to_sleep'
    WHEN regexp_full_match(rf_score, '33') THEN 'need_attention'
    WHEN regexp_full_match(rf_score, '[3-4][4-5]') THEN 'loyal_customers'
    WHEN regexp_full_match(rf_score, '41') THEN 'promising'
    WHEN regexp_full_match(rf_score, '51') THEN 'new_customers'
    WHEN regexp_full_match(rf_score, '[4-5][2-3]') THEN 'potential_loyalists'
    WHEN regexp_full_match(rf_score, '5[4-5]') THEN 'champions' END AS segment
  FROM seg)"""


def _rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    m = rfm.rfm_metrics(t.orders, "o_custkey", "o_orderdate", "o_totalprice")
    return m.select(F.col("o_custkey").alias("customer_id"), "recency", "frequency",
                    F.round("monetary", 2).alias("monetary"))


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_segments(rfm.rfm_scores(_rfm(spark, sf_dir), "customer_id"))


@query("rfm_metrics", sql=f"WITH {_RFM_CTE} SELECT customer_id, CAST(recency AS BIGINT) AS recency, "
       "CAST(frequency AS BIGINT) AS frequency, monetary FROM rfm")
def q_rfm_metrics(spark, sf_dir):
    m = _rfm(spark, sf_dir)
    return m.select("customer_id", i64("recency").alias("recency"),
                    i64("frequency").alias("frequency"), "monetary")


@query("rfm_scores", sql=f"""WITH {_SCORES_CTE}
SELECT customer_id, CAST(recency AS BIGINT) AS recency, CAST(frequency AS BIGINT) AS frequency,
       monetary, CAST(recency_score AS BIGINT) AS recency_score,
       CAST(frequency_score AS BIGINT) AS frequency_score,
       CAST(monetary_score AS BIGINT) AS monetary_score, rf_score,
       rf_score || CAST(monetary_score AS VARCHAR) AS rfm_score,
       CAST(recency_score + frequency_score AS BIGINT) AS rf_sum,
       CAST(recency_score + frequency_score + monetary_score AS BIGINT) AS rfm_sum
FROM seg""")
def q_rfm_scores(spark, sf_dir):
    s = rfm.rfm_scores(_rfm(spark, sf_dir), "customer_id")
    return s.select("customer_id", i64("recency").alias("recency"),
                    i64("frequency").alias("frequency"), "monetary",
                    *[i64(c).alias(c) for c in ("recency_score", "frequency_score",
                                                "monetary_score")],
                    "rf_score", "rfm_score", i64("rf_sum").alias("rf_sum"),
                    i64("rfm_sum").alias("rfm_sum"))


@query("rfm_segments", sql=f"WITH {_SCORES_CTE} SELECT customer_id, rf_score, segment FROM segmented")
def q_rfm_segments(spark, sf_dir):
    return _segmented(spark, sf_dir).select("customer_id", "rf_score", "segment")


@query("segment_profile", sql=f"""WITH {_SCORES_CTE}
SELECT segment, CAST(count(*) AS BIGINT) AS n_customers, round(avg(recency), 6) AS avg_recency,
       round(avg(frequency), 6) AS avg_frequency, round(avg(monetary), 4) AS avg_monetary
FROM segmented GROUP BY segment""")
def q_segment_profile(spark, sf_dir):
    p = rfm.segment_profile(_segmented(spark, sf_dir), "customer_id")
    return p.select("segment", i64("n_customers").alias("n_customers"),
                    r("avg_recency").alias("avg_recency"),
                    r("avg_frequency").alias("avg_frequency"),
                    r("avg_monetary", 4).alias("avg_monetary"))


@query("channel_profile", sql=f"""WITH {_RFM_CTE}
SELECT c.c_mktsegment AS channel, CAST(count(*) AS BIGINT) AS n_customers,
       round(avg(frequency), 6) AS avg_frequency, round(avg(monetary), 4) AS avg_monetary
FROM rfm JOIN customer c ON c.c_custkey = rfm.customer_id GROUP BY c.c_mktsegment""")
def q_channel_profile(spark, sf_dir):
    """Customer count and mean metrics per channel (market segment)."""
    t = Tables(spark, sf_dir)
    m = _rfm(spark, sf_dir).join(
        t.customer.select(F.col("c_custkey").alias("customer_id"),
                          F.col("c_mktsegment").alias("channel")), "customer_id")
    return m.groupBy("channel").agg(
        i64(F.count(F.lit(1))).alias("n_customers"),
        r(F.avg("frequency")).alias("avg_frequency"),
        r(F.avg("monetary"), 4).alias("avg_monetary"))


@query("campaign_list", sql=f"""WITH {_SCORES_CTE},
avgm AS (SELECT avg(monetary) AS mv FROM segmented)
SELECT s.customer_id, s.segment, c.c_mktsegment AS channel
FROM segmented s JOIN customer c ON c.c_custkey = s.customer_id, avgm
WHERE s.segment IN ('champions', 'loyal_customers')
  AND contains(c.c_mktsegment, 'BUILD') AND s.monetary > avgm.mv""")
def q_campaign_list(spark, sf_dir):
    """Champions and loyal customers of the BUILDING channel whose spend is
    above the mean spend of all customers."""
    t = Tables(spark, sf_dir)
    seg = _segmented(spark, sf_dir)
    mean_value = seg.agg(F.avg("monetary").alias("_mv"))
    seg = seg.join(t.customer.select(F.col("c_custkey").alias("customer_id"),
                                     F.col("c_mktsegment").alias("channel")), "customer_id")
    seg = seg.crossJoin(F.broadcast(mean_value))
    out = rfm.campaign_audience(seg, ["champions", "loyal_customers"], "channel", ["BUILD"],
                                F.col("_mv"))
    return out.select("customer_id", "segment", "channel")


# ------------------------------------------------------------------- CLTV
_CLTV_CTE = """
per AS (SELECT o_custkey AS customer_id, min(o_orderdate) AS first_date,
               max(o_orderdate) AS last_date, count(*) AS frequency,
               round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey),
ref AS (SELECT CAST(max(last_date) AS DATE) + 2 AS analysis_date FROM per),
base AS (SELECT customer_id,
                date_diff('day', CAST(first_date AS DATE), CAST(last_date AS DATE)) / 7.0 AS recency_weekly,
                date_diff('day', CAST(first_date AS DATE), analysis_date) / 7.0 AS t_weekly,
                frequency, total / frequency AS monetary_avg
         FROM per, ref WHERE frequency > 1)"""

BG_PARAMS = {"r": 0.5, "alpha": 8.0, "a": 0.6, "b": 2.5}
GG_PARAMS = {"p": 3.0, "q": 4.0, "v": 900.0}


def _cltv_base(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cltv.cltv_base(t.orders, "o_custkey", "o_orderdate", "o_totalprice",
                          money_digits=2).withColumnRenamed(
        "o_custkey", "customer_id")


@query("cltv_base", sql=f"""WITH {_CLTV_CTE}
SELECT customer_id, round(recency_weekly, 6) AS recency_weekly, round(t_weekly, 6) AS t_weekly,
       CAST(frequency AS BIGINT) AS frequency, round(monetary_avg, 6) AS monetary_avg FROM base""")
def q_cltv_base(spark, sf_dir):
    b = _cltv_base(spark, sf_dir)
    return b.select("customer_id", r("recency_weekly").alias("recency_weekly"),
                    r("t_weekly").alias("t_weekly"), i64("frequency").alias("frequency"),
                    r("monetary_avg").alias("monetary_avg"))


_BG = BG_PARAMS
_GG = GG_PARAMS


@query("bgnbd_loglik", sql=f"""WITH {_CLTV_CTE},
p AS (SELECT {_BG['r']} AS r, {_BG['alpha']} AS alpha, {_BG['a']} AS a, {_BG['b']} AS b),
t AS (SELECT customer_id, frequency AS x, recency_weekly AS tx, t_weekly AS tt, p.* FROM base, p),
l AS (SELECT customer_id,
  lgamma(r + x) - lgamma(r) + r * ln(alpha) + lgamma(a + b) + lgamma(b + x) - lgamma(b)
  - lgamma(a + b + x) AS part1,
  -(r + x) * ln(alpha + tt) AS a3,
  CASE WHEN x > 0 THEN ln(a) - ln(b + greatest(x, 1) - 1) - (r + x) * ln(alpha + tx) END AS a4
  FROM t)
SELECT customer_id, round(part1 + CASE WHEN a4 IS NULL THEN a3
  ELSE greatest(a3, a4) + ln(exp(a3 - greatest(a3, a4)) + exp(a4 - greatest(a3, a4))) END, 6) AS loglik
FROM l""")
def q_bgnbd_loglik(spark, sf_dir):
    """C7 at fixed parameters: per-customer BG/NBD log-likelihood."""
    b = _cltv_base(spark, sf_dir)
    ll = cltv.bgnbd_loglik_expr(F.col("frequency"), F.col("recency_weekly"), F.col("t_weekly"),
                                **BG_PARAMS)
    return b.select("customer_id", r(ll).alias("loglik"))


@query("ggamma_loglik", sql=f"""WITH {_CLTV_CTE},
t AS (SELECT customer_id, CAST(frequency AS DOUBLE) AS x, monetary_avg AS m FROM base)
SELECT customer_id, round(lgamma({_GG['p']} * x + {_GG['q']}) - lgamma({_GG['p']} * x)
  - lgamma({_GG['q']}) + {_GG['q']} * ln({_GG['v']}) + ({_GG['p']} * x - 1) * ln(m)
  + {_GG['p']} * x * ln(x) - ({_GG['p']} * x + {_GG['q']}) * ln(x * m + {_GG['v']}), 6) AS loglik
FROM t""")
def q_ggamma_loglik(spark, sf_dir):
    """C9 at fixed parameters: per-customer Gamma-Gamma log-likelihood."""
    b = _cltv_base(spark, sf_dir)
    ll = cltv.ggamma_loglik_expr(F.col("frequency"), F.col("monetary_avg"), **GG_PARAMS)
    return b.select("customer_id", r(ll).alias("loglik"))


@query("ggamma_score", sql=f"""WITH {_CLTV_CTE}
SELECT customer_id, round(({_GG['p']} * ({_GG['v']} + frequency * monetary_avg))
  / ({_GG['p']} * frequency + {_GG['q']} - 1), 6) AS expected_average_profit FROM base""")
def q_ggamma_score(spark, sf_dir):
    """Conditional expected average profit at fixed parameters."""
    b = _cltv_base(spark, sf_dir)
    e = cltv.ggamma_expected_profit(F.col("frequency"), F.col("monetary_avg"), **GG_PARAMS)
    return b.select("customer_id", r(e).alias("expected_average_profit"))


@query("bgnbd_expected", sql=f"""WITH {_CLTV_CTE},
h AS (SELECT customer_id, CAST(frequency AS DOUBLE) AS x, CAST(recency_weekly AS DOUBLE) AS tx, CAST(t_weekly AS DOUBLE) AS tt, w,
  CAST({_BG['r']} AS DOUBLE) AS r, CAST({_BG['alpha']} AS DOUBLE) AS alpha, CAST({_BG['a']} AS DOUBLE) AS a, CAST({_BG['b']} AS DOUBLE) AS b
  FROM base, (SELECT CAST(unnest([12, 24]) AS DOUBLE) AS w)),
s AS (SELECT customer_id, w, sum(exp(lgamma(r + x + k) - lgamma(r + x) + lgamma(b + x + k) - lgamma(b + x)
  - lgamma(a + b + x - 1 + k) + lgamma(a + b + x - 1) - lgamma(k + 1) + k * ln(w / (alpha + tt + w)))) AS f
  FROM h, (SELECT CAST(unnest(generate_series(0, 599)) AS DOUBLE) AS k) GROUP BY customer_id, w),
e AS (SELECT customer_id, w, (a + b + x - 1) / (a - 1) * (1 - f * pow((alpha + tt) / (alpha + tt + w), r + x))
  / (1 + a / (b + x - 1) * pow((alpha + tt) / (alpha + tx), r + x)) AS e FROM h JOIN s USING (customer_id, w))
SELECT customer_id, round(max(CASE WHEN w = 12 THEN e END), 6) AS exp_12w,
  round(max(CASE WHEN w = 24 THEN e END), 6) AS exp_24w FROM e GROUP BY customer_id""")
def q_bgnbd_expected(spark, sf_dir):
    """C8 at fixed parameters: expected purchases in 12 and 24 weeks."""
    b = _cltv_base(spark, sf_dir)
    args = (F.col("frequency"), F.col("recency_weekly"), F.col("t_weekly"))
    return b.select("customer_id",
                    r(cltv.bgnbd_expected_purchases(12.0, *args, **BG_PARAMS)).alias("exp_12w"),
                    r(cltv.bgnbd_expected_purchases(24.0, *args, **BG_PARAMS)).alias("exp_24w"))


@query("cltv_score")
def q_cltv_score(spark, sf_dir):
    """C7-C11 end to end: fit both models on the base table, score 6-month
    discounted value, scale to 1..100 and cut into quartile segments D..A."""
    b = _cltv_base(spark, sf_dir)
    scored = cltv.cltv_pipeline(b, "customer_id", months=6)
    return scored.select("customer_id", r("exp_purchases_12w").alias("exp_purchases_12w"),
                         r("exp_purchases_24w").alias("exp_purchases_24w"),
                         r("expected_average_profit", 4).alias("expected_average_profit"),
                         r("clv", 4).alias("clv"), r("scaled_clv").alias("scaled_clv"),
                         "cltv_segment")


@query("cltv_segment_profile")
def q_cltv_segment_profile(spark, sf_dir):
    """C11/A3: what the value segments of ``cltv_score`` look like."""
    return cltv.cltv_profile(cltv.cltv_pipeline(_cltv_base(spark, sf_dir), "customer_id", months=6))


_STRING_SCORES = _SCORES_CTE.replace("o_custkey AS customer_id", "'C' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer_id"
                                     ).replace("FROM orders GROUP BY o_custkey)", "FROM orders GROUP BY o_custkey)")


@query("rfm_string_keys", sql=f"""WITH {_STRING_SCORES}
SELECT customer_id, CAST(recency_score AS INT) AS recency_score, CAST(frequency_score AS INT) AS frequency_score,
       CAST(monetary_score AS INT) AS monetary_score FROM scored""")
def q_rfm_string_keys(spark, sf_dir):
    """C2/W1 on text customer ids: ties of the first-rank are broken by the text."""
    m = _rfm(spark, sf_dir).withColumn(
        "customer_id", F.concat(F.lit("C"), F.lpad(F.col("customer_id").cast("string"), 9, "0")))
    s = rfm.rfm_scores(m, "customer_id")
    return s.select("customer_id", "recency_score", "frequency_score", "monetary_score")


@query("campaign_list_2", sql=f"""WITH {_SCORES_CTE}
SELECT s.customer_id, s.segment, c.c_mktsegment AS channel
FROM segmented s JOIN customer c ON c.c_custkey = s.customer_id
WHERE s.segment IN ('cant_loose', 'hibernating', 'new_customers')
  AND (contains(c.c_mktsegment, 'HOUSE') OR contains(c.c_mktsegment, 'FURN'))""")
def q_campaign_list_2(spark, sf_dir):
    """C12, second list: lapsed and new customers with an interest in either of two channels."""
    t = Tables(spark, sf_dir)
    seg = _segmented(spark, sf_dir).join(t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("channel")), "customer_id")
    names = ["cant_loose", "hibernating", "new_customers"]
    lists = [rfm.campaign_audience(seg, names, "channel", [term]) for term in ("HOUSE", "FURN")]
    return lists[0].unionByName(lists[1]).select("customer_id", "segment", "channel").distinct()
