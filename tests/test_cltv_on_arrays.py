"""The fits of lifetime values run over arrays, with the likelihoods that are there as expressions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from insight.operators import cltv


def rows(spark):
    """Some with a null or with a logarithm of what is not above 0, where the expression is null."""
    rng = np.random.default_rng(4)
    made = [(float(x), float(t * u), float(t), float(m)) for x, t, u, m in zip(
        rng.integers(0, 300, 400), rng.uniform(0.1, 300, 400), rng.uniform(0, 1, 400), rng.lognormal(3, 2, 400))]
    odd = [(None, 1.0, 2.0, 3.0), (2.0, None, 2.0, 3.0), (2.0, 1.0, None, None), (2.0, 1.0, 2.0, 0.0), (3.0, 1.0, 2.0, -5.0), (0.0, 1.0, -9.0, 2.0)]
    return spark.createDataFrame(made + odd, "x double, tx double, T double, m double").withColumn("_w", F.lit(2) + F.pmod(F.hash("T"), F.lit(3))).checkpoint()


@pytest.mark.parametrize("expr, arrays, cols, points", [
    (cltv.bgnbd_loglik_expr, cltv.bgnbd_loglik, ["x", "tx", "T"], [(0.4, 5.0, 0.7, 2.5), (7.2, 6.3, 2.4e-8, 0.025)]),
    (cltv.ggamma_loglik_expr, cltv.ggamma_loglik, ["x", "m"], [(6.25, 3.74, 15.4), (2.2, 0.1, 2.2)])])
def test_means_equal_the_expressions(spark, monkeypatch, expr, arrays, cols, points):
    monkeypatch.setattr(cltv, "ARRAY_ROWS", 70)
    df = rows(spark)
    total = df.agg(F.sum("_w")).first()[0]
    got = cltv._mean_loglik(cltv._arrays(df, cols), total, arrays, points)
    want = df.agg(*[F.sum(F.col("_w") * expr(*map(F.col, cols), *p)) / F.sum("_w") for p in points]).first()
    assert got == pytest.approx(list(want), rel=1e-12)
    nothing = cltv._mean_loglik(cltv._arrays(df.limit(0), cols), 1.0, arrays, points)
    assert np.isnan(nothing).all() and np.isnan(cltv._mean_loglik(cltv._arrays(df, cols), total, arrays, [[0.0] * len(points[0])])).all()


def test_a_fit_makes_no_table_of_points(spark, monkeypatch):
    """Each pass sent a table of points and evaluated long generated code, seconds for some thousand rows."""
    base = rows(spark).na.drop().where("x > 0 and T > 0 and m > 0").selectExpr("x as frequency", "tx as recency_weekly", "T as t_weekly", "m as monetary_avg")
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **b: pytest.fail("a table of points"))
    assert set(cltv.fit_bgnbd(base)) == {"r", "alpha", "a", "b"} and set(cltv.fit_ggamma(base)) == {"p", "q", "v"}
