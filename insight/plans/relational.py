"""Relational building blocks as used by the analyses: joins (J1-J4), union
by name (U1), top-k and latest-match (T1-T4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.functions.order_stats import value_at_rank
from insight.operators.ml import seeded_order
from insight.plans.registry import i64, query, r
from insight.sources import Tables


@query("left_join", sql="""SELECT p.p_partkey, p.p_name, CAST(count(l.l_orderkey) AS BIGINT) AS n_lines
FROM part p LEFT JOIN lineitem l ON l.l_partkey = p.p_partkey GROUP BY p.p_partkey, p.p_name""")
def q_left_join(spark, sf_dir):
    """Every part with its line count, unsold parts included (0)."""
    t = Tables(spark, sf_dir)
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("_n"))
    return t.part.select("p_partkey", "p_name").join(counts, "p_partkey", "left").select(
        "p_partkey", "p_name", i64(F.coalesce("_n", F.lit(0))).alias("n_lines"))


@query("inner_join", sql="""SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey""")
def q_inner_join(spark, sf_dir):
    """Orders with their customer (keys explicit; Spark/AQE pick the strategy)."""
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t.orders.select("o_orderkey", "o_custkey").join(c, "o_custkey").drop("o_custkey")


@query("semi_join", sql="""SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o
WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def q_semi_join(spark, sf_dir):
    """Customers with at least one urgent order."""
    t = Tables(spark, sf_dir)
    # keys deduplicated first: map-side partial aggregation shrinks the build side
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.select("c_custkey", "c_name").join(urgent, "c_custkey", "left_semi")


@query("anti_join", sql="""SELECT p_partkey FROM part p WHERE NOT EXISTS (SELECT 1 FROM lineitem l
WHERE l.l_partkey = p.p_partkey AND l.l_returnflag = 'R')""")
def q_anti_join(spark, sf_dir):
    """Parts never returned."""
    t = Tables(spark, sf_dir)
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("p_partkey")).distinct()
    return t.part.select("p_partkey").join(returned, "p_partkey", "left_anti")


@query("union_by_name", sql="""SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  'train' AS source FROM orders WHERE o_orderdate < DATE '2001-01-01'
UNION ALL SELECT o_orderkey, NULL, CAST(o_orderdate AS DATE), 'test' FROM orders
WHERE o_orderdate >= DATE '2001-01-01'""")
def q_union_by_name(spark, sf_dir):
    """Labelled and unlabelled rows stacked by name with a source tag."""
    o = Tables(spark, sf_dir).orders
    cut = F.lit("2001-01-01").cast("timestamp")
    train = o.where(F.col("o_orderdate") < cut).select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"),
        F.lit("train").alias("source"))
    test = o.where(F.col("o_orderdate") >= cut).select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), F.lit("test").alias("source"))
    return train.unionByName(test, allowMissingColumns=True)


@query("top_k", sql="""SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY o_custkey
ORDER BY spend DESC, o_custkey LIMIT 10""")
def q_top_k(spark, sf_dir):
    """The 10 biggest spenders (a top-k report; key tiebreak)."""
    o = Tables(spark, sf_dir).orders
    s = o.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
    return s.orderBy(F.col("spend").desc(), "o_custkey").limit(10)


@query("latest_match", sql="""SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  CAST(max(o_orderdate) AS DATE) AS o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT'
GROUP BY o_custkey""")
def q_latest_match(spark, sf_dir):
    """Each customer's most recent urgent order (ties by key)."""
    o = Tables(spark, sf_dir).orders.where(F.col("o_orderpriority") == "1-URGENT")
    m = o.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m"))
    return m.select("o_custkey", F.col("m.o_orderkey").alias("o_orderkey"),
                    F.to_date("m.o_orderdate").alias("o_orderdate"))


@query("random_pick", sql="SELECT c_custkey FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR) || '|45'), c_custkey LIMIT 1")
def q_random_pick(spark, sf_dir):
    """A reproducible random customer (seeded hash order)."""
    c = Tables(spark, sf_dir).customer
    return c.orderBy(seeded_order("c_custkey", 45), "c_custkey").limit(1).select("c_custkey")


@query("kth_smallest", sql="""SELECT round(o_totalprice, 6) AS threshold FROM orders
ORDER BY o_totalprice LIMIT 1 OFFSET 4""")
def q_kth_smallest(spark, sf_dir):
    """T4: the 5th smallest order value, exact, without sorting the table."""
    o = Tables(spark, sf_dir).orders
    v = value_at_rank(o, "o_totalprice", 4)
    return spark.range(1).select(r(F.lit(v)).alias("threshold"))


@query("anti_join_orders", sql="""SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l
WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""")
def q_anti_join_orders(spark, sf_dir):
    """Orders without a returned line."""
    t = Tables(spark, sf_dir)
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t.orders.select("o_orderkey").join(returned, "o_orderkey", "left_anti")
