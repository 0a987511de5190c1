"""Recommender queries: user = customer, item = part brand, rating = mean
line quantity (R4-R6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.operators import recommend as R
from insight.plans.registry import query, r
from insight.sources import Tables

MIN_ITEM_RATINGS = 100
SCORE_TH = 15.0

_R = f"""ev AS (SELECT o.o_custkey AS user_id, p.p_brand AS item, l.l_quantity AS q, o.o_orderdate AS d
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
keep AS (SELECT item FROM ev GROUP BY item HAVING count(*) > {MIN_ITEM_RATINGS}),
ratings AS (SELECT user_id, item, avg(q) AS rating, max(d) AS last_d FROM ev JOIN keep USING (item)
  GROUP BY user_id, item),
target AS (SELECT user_id FROM ratings GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)"""


def _events(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"),
                        "o_orderdate")
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("item"))
    return li.join(o, "l_orderkey").join(p, "l_partkey")


def _ratings(spark, sf_dir):
    return R.user_item_ratings(_events(spark, sf_dir), "user_id", "item", "l_quantity",
                               MIN_ITEM_RATINGS)


@query("user_item_ratings", sql=f"""WITH {_R}
SELECT user_id, item, round(rating, 6) AS rating FROM ratings""")
def q_user_item_ratings(spark, sf_dir):
    return _ratings(spark, sf_dir).select("user_id", "item", r("rating").alias("rating"))


@query("user_recs", sql=f"""WITH {_R},
mine AS (SELECT item, rating AS t FROM ratings JOIN target USING (user_id)),
nm AS (SELECT count(*) AS nm FROM mine),
st AS (SELECT user_id, count(*) AS common, corr(t, rating) AS c FROM ratings JOIN mine USING (item)
  WHERE user_id <> (SELECT user_id FROM target) GROUP BY user_id),
top AS (SELECT user_id, c FROM st, nm WHERE common > nm * 60.0 / 100 AND c >= 0.65),
sc AS (SELECT item, avg(c * rating) AS score FROM ratings JOIN top USING (user_id) GROUP BY item)
SELECT item, round(score, 6) AS score FROM sc WHERE score > {SCORE_TH}
ORDER BY score DESC, item LIMIT 5""")
def q_user_recs(spark, sf_dir):
    ratings = _ratings(spark, sf_dir)
    target = R.most_active_user(ratings, "user_id")
    rec = R.user_based(ratings, "user_id", "item", target, 60.0, 0.65, SCORE_TH, 5)
    return rec.select("item", r("score").alias("score"))


@query("user_rec_titles", sql=f"""WITH {_R},
mine AS (SELECT item, rating AS t FROM ratings JOIN target USING (user_id)),
st AS (SELECT user_id, count(*) AS common, corr(t, rating) AS c FROM ratings JOIN mine USING (item)
  WHERE user_id <> (SELECT user_id FROM target) GROUP BY user_id),
top AS (SELECT user_id, c FROM st WHERE common > (SELECT count(*) FROM mine) * 20.0 / 100 AND c >= 0.1),
sc AS (SELECT item, avg(c * rating) AS score FROM ratings JOIN top USING (user_id) GROUP BY item),
best AS (SELECT item, score FROM sc WHERE score > 1 ORDER BY score DESC, item LIMIT 5)
SELECT item, round(score, 6) AS score, (SELECT min(p_name) FROM part WHERE p_brand = item) AS title FROM best""")
def q_user_rec_titles(spark, sf_dir):
    """R5 with titles: a brand's is the first of its part names."""
    ratings = _ratings(spark, sf_dir)
    rec = R.user_based(ratings, "user_id", "item", R.most_active_user(ratings, "user_id"), 20.0, 0.1, 1.0, 5)
    titles = Tables(spark, sf_dir).part.groupBy(F.col("p_brand").alias("item")).agg(F.min("p_name").alias("title"))
    return R.with_titles(rec, titles, "item", "title").select("item", r("score").alias("score"), "title")


@query("item_recs", sql=f"""WITH {_R},
ti AS (SELECT arg_max(item, (last_d, item)) AS item FROM ratings JOIN target USING (user_id)
  WHERE rating = (SELECT max(rating) FROM ratings JOIN target USING (user_id))),
col AS (SELECT user_id, rating AS t FROM ratings WHERE item = (SELECT item FROM ti)),
st AS (SELECT item, count(*) AS n, corr(t, rating) AS c FROM ratings JOIN col USING (user_id)
  WHERE item <> (SELECT item FROM ti) GROUP BY item)
SELECT item, round(c, 6) AS corr FROM st WHERE c IS NOT NULL AND NOT isnan(c)
ORDER BY c DESC, item LIMIT 5""")
def q_item_recs(spark, sf_dir):
    ratings = R.user_item_ratings(_events(spark, sf_dir), "user_id", "item", "l_quantity",
                                  MIN_ITEM_RATINGS, "o_orderdate")
    target = R.most_active_user(ratings, "user_id")
    best = ratings.join(target, "user_id").agg(F.max("rating").alias("b")).first()["b"]
    ti = R.latest_top_item(ratings, "user_id", "item", target, "last", best)
    rec = R.item_based(ratings.select("user_id", "item", "rating"), "user_id", "item", ti, 5)
    return rec.select("item", r("corr").alias("corr"))
