"""Basket queries: basket = order, item = part brand."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.operators import basket as B
from insight.plans.registry import query, r
from insight.sources import Tables

MIN_SUPPORT = 0.01

_PAIRS = """bp AS (SELECT l.l_orderkey AS basket, p.p_brand AS item FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1, 2 HAVING sum(l.l_quantity) > 0),
nb AS (SELECT count(DISTINCT basket) AS n FROM bp),
i1 AS (SELECT item AS a, count(*) AS f FROM bp GROUP BY 1),
i2 AS (SELECT x.item AS a, y.item AS b, count(*) AS f FROM bp x JOIN bp y
  ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2),
i3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS f FROM bp x
  JOIN bp y ON x.basket = y.basket AND x.item < y.item
  JOIN bp z ON z.basket = x.basket AND y.item < z.item GROUP BY 1, 2, 3),
fi AS (SELECT a AS items, f, 1 AS k FROM i1 UNION ALL SELECT a || ',' || b, f, 2 FROM i2
  UNION ALL SELECT a || ',' || b || ',' || c, f, 3 FROM i3),
frequent AS (SELECT items, f, f / n AS support FROM fi, nb WHERE f / n >= 0.01)"""


def _pairs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"),
                         "l_partkey")
    return B.basket_items(li, "l_orderkey", "p_brand", "l_quantity")


def _itemsets(spark, sf_dir):
    return B.frequent_itemsets(_pairs(spark, sf_dir), "l_orderkey", "p_brand", MIN_SUPPORT)


@query("basket_pairs", sql=f"""WITH {_PAIRS} SELECT basket AS l_orderkey, item AS p_brand FROM bp""")
def q_basket_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query("frequent_itemsets", sql=f"""WITH {_PAIRS}
SELECT items, CAST(f AS BIGINT) AS freq, round(support, 6) AS support FROM frequent""")
def q_frequent_itemsets(spark, sf_dir):
    fi = _itemsets(spark, sf_dir)
    return fi.select(F.array_join("items", ",").alias("items"), "freq",
                     r("support").alias("support"))


_RULES = _PAIRS + """,
s3 AS (SELECT a, b, c, f / n AS s FROM i3, nb WHERE f / n >= 0.01),
s2 AS (SELECT a, b, f / n AS s FROM i2, nb WHERE f / n >= 0.01),
sup AS (SELECT items, support FROM frequent),
splits AS (
  SELECT a AS ante, b AS cons, s FROM s2 UNION ALL SELECT b, a, s FROM s2
  UNION ALL SELECT a, b || ',' || c, s FROM s3 UNION ALL SELECT b, a || ',' || c, s FROM s3
  UNION ALL SELECT c, a || ',' || b, s FROM s3 UNION ALL SELECT a || ',' || b, c, s FROM s3
  UNION ALL SELECT a || ',' || c, b, s FROM s3 UNION ALL SELECT b || ',' || c, a, s FROM s3),
rules AS (SELECT ante, cons, sa.support AS antecedent_support, sc.support AS consequent_support,
  s AS support, s / sa.support AS confidence, s / (sa.support * sc.support) AS lift
  FROM splits JOIN sup sa ON sa.items = ante JOIN sup sc ON sc.items = cons)"""


def _rules(spark, sf_dir):
    return B.association_rules(_itemsets(spark, sf_dir), MIN_SUPPORT)


@query("association_rules", sql=f"""WITH {_RULES}
SELECT ante AS antecedents, cons AS consequents, round(antecedent_support, 6) AS antecedent_support,
  round(consequent_support, 6) AS consequent_support, round(support, 6) AS support,
  round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM rules""")
def q_association_rules(spark, sf_dir):
    ru = _rules(spark, sf_dir)
    return ru.select(F.array_join("antecedents", ",").alias("antecedents"),
                     F.array_join("consequents", ",").alias("consequents"),
                     *[r(c).alias(c) for c in ("antecedent_support", "consequent_support",
                                               "support", "confidence", "lift")])


@query("product_recs", sql=f"""WITH {_RULES},
ex AS (SELECT unnest(string_split(ante, ',')) AS product, ante, cons, lift FROM rules),
rk AS (SELECT product, string_split(cons, ',')[1] AS recommendation, lift,
  row_number() OVER (PARTITION BY product ORDER BY lift DESC, ante, cons) AS rank FROM ex)
SELECT product, CAST(rank AS INTEGER) AS rank, recommendation, round(lift, 6) AS lift
FROM rk WHERE rank <= 1""")
def q_product_recs(spark, sf_dir):
    rec = B.recommend(_rules(spark, sf_dir), 1)
    return rec.select("product", "rank", "recommendation", r("lift").alias("lift"))
