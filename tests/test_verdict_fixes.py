"""Findings of the first review, each held against an independent version."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from insight.functions.order_stats import qcut_first_rank, text_at_rank
from insight.functions.scalar import hyp2f1
from insight.operators import cltv, prep, profile, recommend


@pytest.mark.parametrize("make_key", [lambda i: i, lambda i: f"u{i}", lambda i: f"customer-{i:07d}-äöü"])
def test_first_rank_with_keys_of_any_type(spark, make_key):
    rng = np.random.default_rng(3)
    rows = [(make_key(i), int(rng.integers(0, 4))) for i in range(300)]
    df = spark.createDataFrame(rows, ["key", "x"])
    got = {r.key: r.bin for r in qcut_first_rank(df, "x", "key", [1, 2, 3, 4, 5], "bin").collect()}
    pdf = pd.DataFrame(rows, columns=["key", "x"])
    pdf = pdf.iloc[sorted(range(len(rows)), key=lambda i: rows[i][0].encode() if isinstance(rows[i][0], str) else rows[i][0])]
    want = pd.qcut(pdf["x"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5])
    assert got == dict(zip(pdf["key"], want.astype(int)))


def test_text_at_rank_with_long_common_starts_and_repeats(spark):
    keys = sorted([f"a-very-long-common-start-{i:03d}" for i in range(40)] * 2 + ["a", "zz"])
    df = spark.createDataFrame([("g", k) for k in keys], "_g string, _key string")
    for rank in (0, 1, 37, 80, 81):
        assert text_at_rank(df, {"g": rank})["g"] == keys[rank]


def simulated_customers(n=4000, r=1.2, alpha=6.0, a=0.9, b=2.5, weeks=60.0, seed=11):
    """Purchases and dropouts drawn from the model itself."""
    rng = np.random.default_rng(seed)
    out = []
    for lam, p in zip(rng.gamma(r, 1 / alpha, n), rng.beta(a, b, n)):
        t = last = x = 0
        age = rng.uniform(weeks / 2, weeks)
        while True:
            t = t + rng.exponential(1 / lam)
            if t > age:
                break
            last, x = t, x + 1
            if rng.random() < p:
                break
        out.append((x, float(last), float(age)))
    return out


def test_lifetime_fit_recovers_known_parameters(spark):
    base = spark.createDataFrame(simulated_customers(), "frequency int, recency_weekly double, t_weekly double")
    got = cltv.fit_bgnbd(base, penalizer=0.0)
    assert abs(got["r"] / 1.2 - 1) < 0.15 and abs(got["alpha"] / 6.0 - 1) < 0.2
    assert abs(got["a"] / (got["a"] + got["b"]) - 0.9 / 3.4) < 0.05


def test_spend_fit_recovers_known_parameters(spark):
    rng = np.random.default_rng(5)
    p, q, v, rows = 6.0, 4.0, 15.0, []
    for nu in rng.gamma(q, 1 / v, 4000):
        x = int(rng.integers(2, 12))
        rows.append((x, float(rng.gamma(p * x, 1 / (nu * x)))))
    base = spark.createDataFrame(rows, "frequency int, monetary_avg double")
    got = cltv.fit_ggamma(base, penalizer=0.0)
    assert abs(got["q"] / q - 1) < 0.15
    assert abs(got["p"] * got["v"] / (got["q"] - 1) / (p * v / (q - 1)) - 1) < 0.05


def test_minimise_is_flat_at_the_end_or_raises():
    def bowl(points):
        return [float((x[0] - 1) ** 2 + 10 * (x[1] + 2) ** 2 + x[0] * x[1]) for x in points]
    x, grad = cltv.minimise(bowl, np.zeros(2))
    assert grad < 1e-6 and np.allclose(np.array([[2, 1], [1, 20]]) @ x, [2, -40], atol=1e-4)
    with pytest.raises(RuntimeError):
        cltv.minimise(lambda ps: [float(-x[0]) for x in ps], np.zeros(1), max_iter=5)


def test_series_that_does_not_converge_raises(spark):
    one = spark.range(1).select(F.lit(1.0).alias("o"))
    ok = one.select(hyp2f1(F.col("o"), F.col("o"), F.lit(2.0), F.lit(0.5)).alias("h")).first()["h"]
    assert abs(ok - 2 * np.log(2)) < 1e-12
    with pytest.raises(Exception, match="converged"):
        one.select(hyp2f1(F.col("o"), F.col("o"), F.lit(2.0), F.lit(0.999)).alias("h")).collect()


def test_missing_ratio_rounds_half_to_even(spark):
    df = spark.range(800).select(F.when(F.col("id") > 0, F.col("id")).alias("x"))
    assert profile.missing_values_table(df, ["x"]).first()["ratio"] == 0.12


def test_null_correlation_leaves_out_full_columns(spark):
    df = spark.createDataFrame([(1, None, 2), (None, 1, 3), (3, 4, 4)], "a int, b int, c int")
    assert {r.col_a for r in profile.null_correlation(df, ["a", "b", "c"]).collect()} == {"a", "b"}


def test_binary_columns_are_not_numeric(spark):
    df = spark.createDataFrame([(1, "x", "p"), (0, "y", "p")], "n int, c string, one string")
    assert prep.binary_columns(df, ["n", "c", "one"]) == ["c"]


def test_label_codes_of_many_values(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("v"), F.col("id").alias("keep"))
    df = df.unionByName(spark.createDataFrame([(None, -1)], "v string, keep bigint"))
    want = {v: i for i, v in enumerate(sorted(str(i) for i in range(1500)))}
    got = prep.label_encode(df, "v", "code").collect()
    assert len(got) == 3001 and all(r.code == want.get(r.v) for r in got)
    assert prep.label_encode(df, "v").columns == ["v", "keep"]


def test_item_based_counts_pairs_of_two_and_uses_the_latest_best_mark(spark):
    ev = spark.createDataFrame([
        (1, "a", 5.0, 1), (1, "b", 5.0, 3), (1, "c", 4.0, 9), (2, "b", 1.0, 1), (2, "c", 1.0, 1), (3, "b", 3.0, 1),
        (3, "d", 2.0, 1), (2, "d", 1.0, 1)], "u int, i string, q double, t int")
    ratings = recommend.user_item_ratings(ev, "u", "i", "q", 0, "t")
    target = recommend.most_active_user(ratings, "u")
    item = recommend.latest_top_item(ratings, "u", "i", target, "last", 5.0)
    assert target.first()["u"] == 1 and item.first()["i"] == "b"
    got = {r.i: r["corr"] for r in recommend.item_based(ratings.select("u", "i", "rating"), "u", "i", item).collect()}
    assert got == pytest.approx({"c": 1.0, "d": 1.0})
