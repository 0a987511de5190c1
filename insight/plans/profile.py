"""Profiling queries (D1-D16) on ``part`` (with planted nulls), ``customer``
and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.operators import profile as P
from insight.plans.registry import i64, query, r
from insight.sources import Tables

# part with nulls planted the same way in Spark and SQL (the test data has none)
_PART_N = """part_n AS (SELECT p_partkey, p_name, p_brand,
    nullif(p_type, 'SMALL') AS p_type, nullif(p_size, 1) AS p_size, p_retailprice FROM part)"""


def part_n(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", "p_name", "p_brand",
                    F.nullif(F.col("p_type"), F.lit("SMALL")).alias("p_type"),
                    F.nullif(F.col("p_size"), F.lit(1)).alias("p_size"), "p_retailprice")


_Q = "[0.0, 0.05, 0.5, 0.95, 0.99, 1.0]"


@query("table_profile", sql=f"""WITH {_PART_N}, q AS (
  SELECT 'p_size' AS column_name, count(*) AS n_rows, count(*) - count(p_size) AS n_null,
         quantile_cont(p_size, {_Q}) AS q FROM part_n
  UNION ALL
  SELECT 'p_retailprice', count(*), count(*) - count(p_retailprice),
         quantile_cont(p_retailprice, {_Q}) FROM part_n)
SELECT column_name, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_null AS BIGINT) AS n_null,
  round(q[1], 6) AS q00, round(q[2], 6) AS q05, round(q[3], 6) AS q50, round(q[4], 6) AS q95,
  round(q[5], 6) AS q99, round(q[6], 6) AS q100 FROM q""")
def q_table_profile(spark, sf_dir):
    prof = P.table_profile(part_n(spark, sf_dir), ["p_size", "p_retailprice"])
    return prof.select("column_name", "n_rows", "n_null",
                       *[r(c).alias(c) for c in ("q00", "q05", "q50", "q95", "q99", "q100")])


@query("column_types", sql=f"""WITH {_PART_N}, n AS (SELECT count(*) AS n, count(p_type) AS t, count(p_size) AS s FROM part_n)
SELECT v.i AS position, v.c AS column_name, v.t AS type, n.n AS n_rows,
  CASE v.c WHEN 'p_type' THEN n.n - n.t WHEN 'p_size' THEN n.n - n.s ELSE 0 END AS n_null
FROM n, (VALUES (0, 'p_partkey', 'bigint'), (1, 'p_name', 'string'), (2, 'p_brand', 'string'), (3, 'p_type', 'string'),
  (4, 'p_size', 'int'), (5, 'p_retailprice', 'double')) v(i, c, t)""")
def q_column_types(spark, sf_dir):
    """Types, rows and nulls."""
    return P.column_types(part_n(spark, sf_dir))


@query("head_tail", sql="""(SELECT 'head' AS part, o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL (SELECT 'tail', o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def q_head_tail(spark, sf_dir):
    """The first and last five orders by key."""
    return P.head_tail(Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], 5)


@query("column_roles", sql=f"""WITH {_PART_N}, nd AS (
  SELECT 'p_partkey' AS column_name, false AS is_str, count(DISTINCT p_partkey) AS n FROM part_n
  UNION ALL SELECT 'p_name', true, count(DISTINCT p_name) FROM part_n
  UNION ALL SELECT 'p_brand', true, count(DISTINCT p_brand) FROM part_n
  UNION ALL SELECT 'p_type', true, count(DISTINCT p_type) FROM part_n
  UNION ALL SELECT 'p_size', false, count(DISTINCT p_size) FROM part_n
  UNION ALL SELECT 'p_retailprice', false, count(DISTINCT p_retailprice) FROM part_n)
SELECT column_name, CASE WHEN is_str THEN CASE WHEN n > 20 THEN 'cardinal' ELSE 'categorical' END
                    ELSE CASE WHEN n < 10 THEN 'categorical' ELSE 'numeric' END END AS role,
       CAST(n AS BIGINT) AS n_distinct FROM nd""")
def q_column_roles(spark, sf_dir):
    return P.column_roles(part_n(spark, sf_dir))


_P12 = "[0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99]"
_PN = ["p05", "p10", "p20", "p30", "p40", "p50", "p60", "p70", "p80", "p90", "p95", "p99"]


@query("numeric_summary", sql=f"""WITH {_PART_N}, s AS (
  SELECT 'p_size' AS column_name, count(p_size) AS n, avg(p_size) AS mean, stddev_samp(p_size) AS std,
         min(p_size) AS mn, max(p_size) AS mx, quantile_cont(p_size, {_P12}) AS q FROM part_n
  UNION ALL
  SELECT 'p_retailprice', count(p_retailprice), avg(p_retailprice), stddev_samp(p_retailprice),
         min(p_retailprice), max(p_retailprice), quantile_cont(p_retailprice, {_P12}) FROM part_n)
SELECT column_name, CAST(n AS BIGINT) AS count, round(mean, 6) AS mean, round(std, 6) AS std,
       round(mn, 6) AS min, round(mx, 6) AS max,
       {", ".join(f"round(q[{i + 1}], 6) AS {n}" for i, n in enumerate(_PN))} FROM s""")
def q_numeric_summary(spark, sf_dir):
    s = P.numeric_summary(part_n(spark, sf_dir), ["p_size", "p_retailprice"])
    return s.select("column_name", "count", *[r(c).alias(c) for c in
                                         ["mean", "std", "min", "max"] + _PN])


@query("category_summary", sql=f"""WITH {_PART_N}, t AS (SELECT count(*) AS total FROM part_n),
l AS (SELECT 'p_brand' AS column_name, p_brand AS category FROM part_n
      UNION ALL SELECT 'p_type', p_type FROM part_n)
SELECT column_name, category, CAST(count(*) AS BIGINT) AS n,
       round(count(*) * 100.0 / any_value(total), 6) AS ratio
FROM l, t WHERE category IS NOT NULL GROUP BY column_name, category""")
def q_category_summary(spark, sf_dir):
    s = P.category_summary(part_n(spark, sf_dir), ["p_brand", "p_type"])
    return s.select("column_name", "category", i64("n").alias("n"), r("ratio").alias("ratio"))


@query("missing_table", sql=f"""WITH {_PART_N}, c AS (
  SELECT 'p_type' AS column_name, count(*) - count(p_type) AS n_miss, count(*) AS n FROM part_n
  UNION ALL SELECT 'p_size', count(*) - count(p_size), count(*) FROM part_n
  UNION ALL SELECT 'p_brand', count(*) - count(p_brand), count(*) FROM part_n)
SELECT column_name, CAST(n_miss AS BIGINT) AS n_miss, round(n_miss * 100.0 / n, 2) AS ratio
FROM c WHERE n_miss > 0""")
def q_missing_table(spark, sf_dir):
    m = P.missing_values_table(part_n(spark, sf_dir), ["p_type", "p_size", "p_brand"])
    return m.select("column_name", i64("n_miss").alias("n_miss"), F.col("ratio").cast("double"))


@query("missing_vs_target", sql=f"""WITH {_PART_N}, l AS (
  SELECT 'p_type' AS column_name, CAST(p_type IS NULL AS INTEGER) AS na_flag, p_retailprice FROM part_n
  UNION ALL SELECT 'p_size', CAST(p_size IS NULL AS INTEGER), p_retailprice FROM part_n)
SELECT column_name, CAST(na_flag AS BIGINT) AS na_flag, round(avg(p_retailprice), 6) AS target_mean,
       CAST(count(p_retailprice) AS BIGINT) AS count FROM l GROUP BY column_name, na_flag""")
def q_missing_vs_target(spark, sf_dir):
    m = P.missing_vs_target(part_n(spark, sf_dir), "p_retailprice", ["p_type", "p_size"])
    return m.select("column_name", i64("na_flag").alias("na_flag"),
                    r("target_mean").alias("target_mean"), i64("count").alias("count"))


@query("target_mean", sql="""SELECT l_returnflag,
  round(avg(l_quantity), 6) AS mean_l_quantity, round(avg(l_extendedprice), 6) AS mean_l_extendedprice,
  round(avg(l_discount), 6) AS mean_l_discount, round(avg(l_tax), 6) AS mean_l_tax
FROM lineitem GROUP BY l_returnflag""")
def q_target_mean(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    m = P.target_mean(Tables(spark, sf_dir).lineitem, "l_returnflag", cols)
    return m.select("l_returnflag", *[r(f"mean_{c}").alias(f"mean_{c}") for c in cols])


@query("rare_profile", sql="""WITH t AS (SELECT count(*) AS total FROM customer),
l AS (SELECT 'c_mktsegment' AS column_name, c_mktsegment AS category, c_acctbal FROM customer
      UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), c_acctbal FROM customer)
SELECT column_name, category, CAST(count(*) AS BIGINT) AS count,
       round(count(*) / any_value(total), 6) AS ratio, round(avg(c_acctbal), 6) AS target_mean
FROM l, t GROUP BY column_name, category""")
def q_rare_profile(spark, sf_dir):
    p = P.rare_profile(Tables(spark, sf_dir).customer, ["c_mktsegment", "c_nationkey"],
                       "c_acctbal")
    return p.select("column_name", "category", i64("count").alias("count"), r("ratio").alias("ratio"),
                    r("target_mean").alias("target_mean"))


_LNUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(cols, table, cond=""):
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr "
             f"FROM {table} {cond}" for a in cols for b in cols]
    return " UNION ALL ".join(parts)


@query("corr_matrix", sql=_corr_sql(_LNUM, "lineitem"))
def q_corr_matrix(spark, sf_dir):
    c = P.corr_matrix(Tables(spark, sf_dir).lineitem, _LNUM)
    return c.select("col_a", "col_b", r("corr").alias("corr"))


@query("target_corr", sql="SELECT column_name, round(c, 6) AS corr FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, corr({c}, l_extendedprice) AS c FROM lineitem" for c in _LNUM)
    + ") WHERE abs(c) > 0.5")
def q_target_corr(spark, sf_dir):
    t = P.target_correlation(Tables(spark, sf_dir).lineitem, _LNUM, "l_extendedprice", 0.5)
    return t.select("column_name", r("corr").alias("corr"))


_PNUM = ["p_size", "p_retailprice", "p_partkey"]


@query("high_corr", sql="WITH c AS (" + _corr_sql(_PNUM, "part") + """),
pos AS (SELECT * FROM (VALUES ('p_size', 0), ('p_retailprice', 1), ('p_partkey', 2)) v(name, i))
SELECT DISTINCT col_b AS column_name FROM c JOIN pos pa ON pa.name = c.col_a
JOIN pos pb ON pb.name = c.col_b WHERE pa.i < pb.i AND abs(corr) > 0.5""")
def q_high_corr(spark, sf_dir):
    return P.high_correlated_cols(Tables(spark, sf_dir).part, _PNUM, 0.5)


@query("histogram", sql="""WITH l AS (SELECT min(p_retailprice) AS mn, max(p_retailprice) AS mx FROM part),
b AS (SELECT least(CAST(floor((p_retailprice - mn) / ((mx - mn) / 20)) AS BIGINT) + 1, 20) AS bin, mn, mx
      FROM part, l)
SELECT CAST(bin AS INTEGER) AS bin, round(mn + (bin - 1) * (mx - mn) / 20, 6) AS lo,
       round(mn + bin * (mx - mn) / 20, 6) AS hi, CAST(count(*) AS BIGINT) AS count
FROM b GROUP BY bin, mn, mx""")
def q_histogram(spark, sf_dir):
    h = P.histogram(Tables(spark, sf_dir).part, "p_retailprice", 20)
    return h.select("bin", r("lo").alias("lo"), r("hi").alias("hi"), i64("count").alias("count"))


@query("null_corr", sql=f"""WITH {_PART_N}, f AS (SELECT CAST(p_type IS NULL AS DOUBLE) AS p_type,
  CAST(p_size IS NULL AS DOUBLE) AS p_size FROM part_n) """ + _corr_sql(["p_type", "p_size"], "f"))
def q_null_corr(spark, sf_dir):
    c = P.null_correlation(part_n(spark, sf_dir), ["p_type", "p_size"])
    return c.select("col_a", "col_b", r("corr").alias("corr"))


_DCOLS = ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity"]


@query("distinct_diff", sql="WITH a AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_a FROM lineitem WHERE l_shipdate < DATE '1996-01-01'"
    for c in _DCOLS) + "), b AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_b FROM lineitem WHERE l_shipdate >= DATE '1996-01-01'"
    for c in _DCOLS) + """)
SELECT a.column_name, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b FROM a JOIN b USING (column_name)
WHERE n_a <> n_b""")
def q_distinct_diff(spark, sf_dir):
    """Columns whose distinct count differs between early and late shipments."""
    li = Tables(spark, sf_dir).lineitem
    early = li.where(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp"))
    late = li.where(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp"))
    d = P.distinct_count_diff(early, late, _DCOLS)
    return d.select("column_name", i64("n_a").alias("n_a"), i64("n_b").alias("n_b"))


@query("null_counts", sql=f"""WITH {_PART_N}, c AS (
SELECT 'p_partkey' AS column_name, count(*) - count(p_partkey) AS n_miss FROM part_n
UNION ALL SELECT 'p_name', count(*) - count(p_name) FROM part_n
UNION ALL SELECT 'p_brand', count(*) - count(p_brand) FROM part_n
UNION ALL SELECT 'p_type', count(*) - count(p_type) FROM part_n
UNION ALL SELECT 'p_size', count(*) - count(p_size) FROM part_n
UNION ALL SELECT 'p_retailprice', count(*) - count(p_retailprice) FROM part_n)
SELECT column_name, CAST(n_miss AS BIGINT) AS n_miss FROM c""")
def q_null_counts(spark, sf_dir):
    """Null count of every column, one pass."""
    n = P.null_counts(part_n(spark, sf_dir))
    return n.select("column_name", F.col("n_miss").cast("bigint").alias("n_miss"))


@query("drop_null_columns", sql=f"""WITH {_PART_N}
SELECT p_partkey, p_brand, p_size FROM part_n""")
def q_drop_null_columns(spark, sf_dir):
    """A column that is null everywhere is dropped (metadata: one count per column)."""
    from insight.sources import drop_all_null_columns
    p = part_n(spark, sf_dir).select("p_partkey", "p_brand", "p_size",
                                     F.lit(None).cast("double").alias("empty_metric"))
    return drop_all_null_columns(p)


@query("group_stats", sql="""SELECT l_suppkey, round(sum(l_quantity), 6) AS sum_qty,
  round(avg(l_quantity), 6) AS mean_qty, round(median(l_quantity), 6) AS median_qty,
  round(stddev_samp(l_quantity), 6) AS std_qty FROM lineitem GROUP BY l_suppkey""")
def q_group_stats(spark, sf_dir):
    """A1: per-group sum, mean, exact median and sample sd. The median uses the
    distributed grouped quantiles (value counts + bucket offsets), so a group
    holding a large share of rows is not collected into one task."""
    from insight.functions.order_stats import quantiles
    li = Tables(spark, sf_dir).lineitem.select("l_suppkey", "l_quantity")
    base = li.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("s"), F.avg("l_quantity").alias("m"),
                                       F.stddev_samp("l_quantity").alias("sd"))
    med = quantiles(li, "l_quantity", [0.5], ["l_suppkey"], out="_q")
    return base.join(med, "l_suppkey").select(
        "l_suppkey", r("s").alias("sum_qty"), r("m").alias("mean_qty"),
        r(F.col("_q")[0]).alias("median_qty"), r("sd").alias("std_qty"))


_LINE_FIGURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query("high_corr_lines", sql="WITH c AS (" + _corr_sql(_LINE_FIGURES, "lineitem") + """),
pos AS (SELECT * FROM (VALUES ('l_quantity', 0), ('l_extendedprice', 1), ('l_discount', 2)) v(name, i))
SELECT DISTINCT col_b AS column_name FROM c JOIN pos pa ON pa.name = c.col_a
JOIN pos pb ON pb.name = c.col_b WHERE pa.i < pb.i AND abs(corr) > 0.002""")
def q_high_corr_lines(spark, sf_dir):
    """D13 where columns are reported: line figures above a low limit."""
    return P.high_correlated_cols(Tables(spark, sf_dir).lineitem, _LINE_FIGURES, 0.002)


_OCOLS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query("distinct_diff_orders", sql="WITH a AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_a FROM orders WHERE o_orderdate < DATE '1996-01-01'"
    for c in _OCOLS) + "), b AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_b FROM orders WHERE o_orderdate >= DATE '1996-01-01'"
    for c in _OCOLS) + """)
SELECT a.column_name, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b FROM a JOIN b USING (column_name)
WHERE n_a <> n_b""")
def q_distinct_diff_orders(spark, sf_dir):
    """D14 where counts differ: columns of early and late orders."""
    o = Tables(spark, sf_dir).orders
    cut = F.lit("1996-01-01").cast("timestamp")
    d = P.distinct_count_diff(o.where(F.col("o_orderdate") < cut), o.where(F.col("o_orderdate") >= cut), _OCOLS)
    return d.select("column_name", i64("n_a").alias("n_a"), i64("n_b").alias("n_b"))
