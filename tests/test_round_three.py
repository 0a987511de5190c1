"""Correlation blocks, head, tail and types, labelled samples, titles, campaign files, medians per segment."""

import numpy as np
import pandas as pd
import pytest

from insight.functions import order_stats as OS
from insight.operators import measure as M
from insight.operators import profile as P
from insight.operators import recommend as R
from insight.operators import rfm


def test_correlations_equal_pandas_with_nulls(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(4000, 4)) * [1, 50, 1e-3, 1] + [1e6, 0, 5, 0], columns=list("abcd"))
    pdf["b"] += 20 * pdf.a
    pdf["same"] = 0.1
    for i, c in enumerate("abc"):
        pdf.loc[rng.random(4000) < 0.1 * i, c] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in row) for row in pdf.itertuples(index=False)]
    rows += [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, same double").repartition(5)
    got = {(r.col_a, r.col_b): r["corr"] for r in P.corr_matrix(df, df.columns).collect()}
    want = pdf.corr()
    assert len(got) == 25
    for (x, y), v in got.items():
        if "same" in (x, y):
            assert v is None
        else:
            assert abs(v - want.loc[x, y]) < 1e-9


def test_correlations_have_no_aggregate_per_pair(spark):
    df = spark.createDataFrame([(float(i), float(i * i), 1.0) for i in range(9)], "a double, b double, c double")
    plan = P.gram(df, ["a", "b", "c"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sum(") <= 12 and "corr" not in plan and "Generate" not in plan
    none = P.corr_matrix(df.limit(0), ["a", "b"]).collect()
    assert len(none) == 4 and all(r["corr"] is None for r in none)


def test_head_tail_and_types(spark):
    df = spark.createDataFrame([(i, None if i % 2 else str(i)) for i in range(7)], "k int, t string")
    got = P.head_tail(df, ["k"], 2).collect()
    assert sorted((r.part, r.k) for r in got) == [("head", 0), ("head", 1), ("tail", 5), ("tail", 6)]
    assert [tuple(r) for r in P.column_types(df).collect()] == [(0, "k", "int", 7, 0), (1, "t", "string", 7, 3)]
    assert [tuple(r) for r in P.column_types(df.limit(0)).collect()] == [(0, "k", "int", 0, 0), (1, "t", "string", 0, 0)]


def test_labelled_samples(spark):
    a, b = spark.createDataFrame([(1.0,), (2.0,)], "v double"), spark.createDataFrame([(5.0, 1)], "v double, w int")
    got = M.label_samples({"a": a, "b": b}).collect()
    assert sorted((r.group, r.v, r.w or 0) for r in got) == [("a", 1.0, 0), ("a", 2.0, 0), ("b", 5.0, 1)]
    with pytest.raises(ValueError):
        M.label_samples({})


def test_titles(spark):
    recs = spark.createDataFrame([(1, 0.5), (2, 0.4)], "item int, score double")
    items = spark.createDataFrame([(1, "one"), (1, "one"), (3, "three")], "item int, title string")
    assert sorted((r.item, r.title) for r in R.with_titles(recs, items, "item", "title").collect()) == [(1, "one"), (2, None)]


def test_campaign_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "customer_id int, segment string")
    paths = rfm.write_campaign_lists({"all": df, "none": df.limit(0)}, str(tmp_path), ["customer_id"])
    assert sorted(r.customer_id for r in spark.read.csv(paths["all"], header=True, schema="customer_id int").collect()) == [1, 2]
    assert spark.read.csv(paths["none"], header=True, schema="customer_id int").count() == 0


def test_medians_of_several_columns_per_group(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 900), "x": rng.normal(size=900), "y": rng.integers(0, 9, 900).astype(float)})
    got = {r.g: (r.median_x, r.median_y) for r in OS.group_medians_of(spark.createDataFrame(pdf), ["x", "y"], "g").collect()}
    for g, part in pdf.groupby("g"):
        assert np.allclose(got[g], (part.x.median(), part.y.median()))
