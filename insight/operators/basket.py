"""Basket analysis: 0/1 basket-item pairs, frequent itemsets, association
rules with every antecedent/consequent split, product recommendations
(A10, R1-R3, J7).

Baskets stay in long form (basket, item); Spark ML's FPGrowth mines the
itemsets. Rules are built here because FPGrowth only emits single-item
consequents: each itemset is expanded into all its proper non-empty subsets
(bit masks over the sorted item array) and joined to the itemset table on
the sorted-array key for the antecedent and consequent supports.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.session import ensure_checkpoint_dir


def basket_items(df: DataFrame, basket: str, item: str, quantity: str) -> DataFrame:
    """A10: (basket, item) pairs whose summed quantity is positive."""
    return (df.groupBy(basket, item).agg(F.sum(quantity).alias("_q"))
              .where(F.col("_q") > 0).select(basket, item))


def frequent_itemsets(pairs: DataFrame, basket: str, item: str, min_support: float) -> DataFrame:
    """(items sorted array, freq, support) with support >= min_support."""
    ensure_checkpoint_dir(pairs.sparkSession)
    # written once: the count of baskets and the passes of the mining read it, and the pairs are made only for it
    baskets = pairs.groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias("items")).checkpoint(eager=True)
    n = baskets.agg(F.count(basket).alias("_nb"))  # one row, attached lazily; as before, a null basket is not counted
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(baskets)
    # freqItemsets is backed by an uncached RDD: every reference would mine the
    # FP-tree again, so the (small) itemset table is checkpointed once
    return model.freqItemsets.crossJoin(F.broadcast(n)).select(
        F.array_sort("items").alias("items"), "freq",
        (F.col("freq") / F.col("_nb")).alias("support")).checkpoint(eager=True)


def association_rules(itemsets: DataFrame, min_support: float = 0.0) -> DataFrame:
    """R2: every split of every itemset of size >= 2 into antecedent and
    consequent, with support, confidence and lift."""
    multi = itemsets.where(F.size("items") >= 2)
    masks = F.expr("sequence(1, shiftleft(1, size(items)) - 2)")
    split = multi.select("items", "support", F.explode(masks).alias("_m")).select(
        "support",
        F.expr("filter(items, (x, i) -> (shiftright(_m, i) & 1) = 1)").alias("antecedents"),
        F.expr("filter(items, (x, i) -> (shiftright(_m, i) & 1) = 0)").alias("consequents"))
    ante = itemsets.select(F.col("items").alias("antecedents"),
                           F.col("support").alias("antecedent_support"))
    cons = itemsets.select(F.col("items").alias("consequents"),
                           F.col("support").alias("consequent_support"))
    rules = split.join(ante, "antecedents").join(cons, "consequents")
    return rules.where(F.col("support") >= min_support).select(
        "antecedents", "consequents", "antecedent_support", "consequent_support", "support",
        (F.col("support") / F.col("antecedent_support")).alias("confidence"),
        (F.col("support") / (F.col("antecedent_support") * F.col("consequent_support")))
        .alias("lift"))


def recommend(rules: DataFrame, rec_count: int = 1) -> DataFrame:
    """R3 (batch form): for every product, the first consequent item of its
    ``rec_count`` best rules by lift among rules whose antecedent contains it."""
    exploded = rules.select(F.explode("antecedents").alias("product"), "antecedents",
                            "consequents", "lift")
    w = Window.partitionBy("product").orderBy(
        F.col("lift").desc(), F.array_join("antecedents", ","), F.array_join("consequents", ","))
    return (exploded.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= rec_count)
                    .select("product", "rank", F.element_at("consequents", 1).alias("recommendation"),
                            "lift"))
