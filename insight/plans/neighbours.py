"""Neighbour queries over customers: exact nearest neighbours, local outlier factor, KNN imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.operators import neighbours as N
from insight.plans.registry import i64, query, r
from insight.sources import Tables

_CUSTOMERS = """c AS (SELECT c_custkey, CAST(c_acctbal AS DOUBLE) AS acctbal, CAST(count(o_orderkey) AS DOUBLE) AS n_orders,
    coalesce(sum(CAST(o_totalprice AS DOUBLE)), 0.0) / 100 AS spent
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal)"""
_COLUMNS = ["acctbal", "n_orders", "spent"]


def _customers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    orders = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").cast("double").alias("n_orders"),
                                               (F.sum(F.col("o_totalprice").cast("double")) / 100).alias("spent"))
    c = t.customer.select("c_custkey", F.col("c_acctbal").cast("double").alias("acctbal"))
    return c.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


def _near_sql(k: int, columns: str) -> str:
    """Distinct points, all pairs, and the neighbours up to the distance that holds k rows."""
    names = columns.split(", ")
    distance = "sqrt(" + " + ".join(f"(a.{x} - b.{x}) * (a.{x} - b.{x})" for x in names) + ")"
    return f"""pts AS (SELECT {columns}, min(c_custkey) AS p, count(*) AS n FROM c GROUP BY {columns}),
d AS (SELECT a.p, b.p AS q, {distance} AS distance, b.n - CAST(a.p = b.p AS BIGINT) AS n FROM pts a, pts b),
nb AS (SELECT * FROM d WHERE n > 0 QUALIFY sum(n) OVER (PARTITION BY p ORDER BY distance RANGE UNBOUNDED PRECEDING)
  - sum(n) OVER (PARTITION BY p, distance) < {k})"""


@query("nearest_customers", sql=f"""WITH {_CUSTOMERS}, {_near_sql(5, "acctbal, n_orders")}
SELECT p, q, round(distance, 6) AS distance, CAST(n AS BIGINT) AS n FROM nb""")
def q_nearest_customers(spark, sf_dir):
    """The five nearest customers by balance and number of orders, ties kept."""
    c = _customers(spark, sf_dir).na.fill(0.0, ["n_orders", "spent"])
    pts = N.points(c, "c_custkey", ["acctbal", "n_orders"])
    return N.nearest(pts, pts, 5).where("p is not null").select("p", "q", r("distance").alias("distance"), i64("n").alias("n"))


@query("lof_outliers", sql=f"""WITH {_CUSTOMERS}, {_near_sql(20, "acctbal, n_orders, spent")},
kd AS (SELECT p, max(distance) AS kd FROM nb GROUP BY p),
lrd AS (SELECT nb.p, 1 / (sum(greatest(nb.distance, kd.kd) * nb.n) / sum(nb.n) + 1e-10) AS lrd
  FROM nb JOIN kd ON kd.p = nb.q GROUP BY nb.p),
lof AS (SELECT nb.p, -(sum(o.lrd * nb.n) / sum(nb.n)) / any_value(m.lrd) AS lof
  FROM nb JOIN lrd o ON o.p = nb.q JOIN lrd m ON m.p = nb.p GROUP BY nb.p),
scored AS (SELECT c.c_custkey, lof.lof FROM c JOIN pts USING (acctbal, n_orders, spent) JOIN lof ON lof.p = pts.p)
SELECT c_custkey, round(lof, 6) AS lof FROM scored
WHERE lof < (SELECT lof FROM scored ORDER BY lof LIMIT 1 OFFSET 17)""")
def q_lof_outliers(spark, sf_dir):
    """Customers whose local outlier factor lies below the score at position 17, the rows that the method drops."""
    c = _customers(spark, sf_dir).na.fill(0.0, ["n_orders", "spent"])
    scored = N.local_outlier_factor(c, "c_custkey", _COLUMNS, 20).checkpoint()
    stay = N.drop_local_outliers(scored, 17).select(F.col("c_custkey").alias("stay"))
    return scored.join(stay, F.col("c_custkey") == F.col("stay"), "left_anti").select("c_custkey", r("lof").alias("lof"))


@query("knn_impute")
def q_knn_impute(spark, sf_dir):
    """Overdrawn balances count as unknown, customers without orders lack both order columns."""
    c = _customers(spark, sf_dir).withColumn("acctbal", F.when(F.col("acctbal") >= 0, F.col("acctbal")))
    return N.knn_impute(c, "c_custkey", _COLUMNS, 5).select("c_custkey", *[r(x).alias(x) for x in _COLUMNS])
