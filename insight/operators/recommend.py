"""Collaborative filtering on a long (user, item, rating) table (A9, A11,
J1-J5, U3, R4-R6, T2).

No dense user x item matrix is built. User-based: the target user's ratings
(one row per item, bounded by the item dimension) are joined to all ratings
on item and correlated per user in one grouped aggregate. Item-based: the
target item's ratings are joined on user and correlated per item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.session import ensure_checkpoint_dir


def _pearson(a: Column, b: Column) -> Column:
    """Pearson correlation; null (not an ANSI error) when a side is constant."""
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def user_item_ratings(events: DataFrame, user: str, item: str, rating: str,
                      min_item_ratings: int, when: str | None = None) -> DataFrame:
    """Mean rating per (user, item), for items with more than
    ``min_item_ratings`` rating rows.

    Events are aggregated once; the items' row counts are sums over that
    table, which is checkpointed, so the events are read a single time however
    often the ratings are used. With ``when``, ``last`` is the latest time.
    """
    ensure_checkpoint_dir(events.sparkSession)
    more = [F.max(when).alias("last")] if when else []
    pairs = events.groupBy(user, item).agg(F.avg(rating).alias("rating"), F.count(F.lit(1)).alias("_n"), *more)
    pairs = pairs.checkpoint(eager=True)
    rare = (pairs.groupBy(item).agg(F.sum("_n").alias("_all"))
            .where(F.col("_all") <= min_item_ratings).select(item))
    return pairs.drop("_n").join(rare, item, "left_anti")


def most_active_user(ratings: DataFrame, user: str) -> DataFrame:
    """The user with the most rated items (smallest key on ties), one row."""
    return (ratings.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
                   .orderBy(F.col("_n").desc(), user).limit(1).select(user))


def user_based(ratings: DataFrame, user: str, item: str, target: DataFrame,
               ratio: float = 60.0, cor_th: float = 0.65, score: float = 3.5,
               top_n: int = 5) -> DataFrame:
    """Users sharing more than ``ratio`` % of the target's items, whose
    Pearson correlation with the target is >= ``cor_th``; items scored by the
    mean of corr x rating over those users, kept when above ``score``."""
    mine = ratings.join(target, user).select(item, F.col("rating").alias("_t"))
    n_mine = mine.agg(F.count(F.lit(1)).alias("_nm"))
    others = ratings.join(target, user, "left_anti")
    common = others.join(mine, item)  # no hint: Spark broadcasts the side whose size it has checked
    stats = common.groupBy(user).agg(F.count(F.lit(1)).alias("_common"),
                                     _pearson(F.col("_t"), F.col("rating")).alias("corr"))
    top = (stats.crossJoin(F.broadcast(n_mine))
                .where((F.col("_common") > F.col("_nm") * ratio / 100) & (F.col("corr") >= cor_th))
                .select(user, "corr"))
    scored = ratings.join(top, user).groupBy(item).agg(
        F.avg(F.col("corr") * F.col("rating")).alias("score"))
    return (scored.where(F.col("score") > score)
                  .orderBy(F.col("score").desc(), item).limit(top_n))


def with_titles(recs: DataFrame, items: DataFrame, item: str, title: str) -> DataFrame:
    """Recommendations with the title of each item; an item without one keeps a null title."""
    return recs.join(items.select(item, title).dropDuplicates([item]), item, "left")


def latest_top_item(ratings: DataFrame, user: str, item: str, target: DataFrame,
                    when_col: str, top_rating: float) -> DataFrame:
    """The item the target rated ``top_rating`` (the best mark) most recently
    (largest key on ties)."""
    mine = ratings.join(target, user).where(F.col("rating") == F.lit(top_rating))
    return mine.agg(F.max(F.struct(when_col, item)).alias("_m")).select(F.col(f"_m.{item}").alias(item))


def item_based(ratings: DataFrame, user: str, item: str, target_item: DataFrame,
               top_n: int = 5) -> DataFrame:
    """Items most correlated (over users who rated both) with the target
    item, the item itself excluded (quirk Q9 fixed)."""
    col_t = ratings.join(target_item, item).select(user, F.col("rating").alias("_t"))
    others = ratings.join(target_item, item, "left_anti")
    stats = others.join(col_t, user).groupBy(item).agg(
        _pearson(F.col("_t"), F.col("rating")).alias("corr"))
    return (stats.where(F.col("corr").isNotNull())
                 .orderBy(F.col("corr").desc(), item).limit(top_n).select(item, "corr"))
