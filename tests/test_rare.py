"""Rare categories and modes against counting by hand."""

from collections import Counter

from insight.operators import prep, profile


def test_rare_categories_of_several_columns(spark):
    rows = [("a", "x")] * 60 + [("b", "y")] * 30 + [("c", None)] * 6 + [(None, "z")] * 4
    df = spark.createDataFrame(rows, "p string, q string")
    got = Counter(map(tuple, prep.rare_encode(df, ["p", "q"], 0.1).collect()))
    assert got == {("a", "x"): 60, ("b", "y"): 30, ("Rare", None): 6, (None, "Rare"): 4}
    assert prep.rare_encode(df.limit(0), ["p"], 0.1).collect() == []


def test_modes_only_for_columns_with_few_values(spark):
    rows = [(i, "u" if i % 3 else "v") for i in range(100)] + [(None, None)] * 5
    df = spark.createDataFrame(rows, "n int, s string")
    assert prep.few_distinct(df, ["n", "s"], 25) == {"s": 2}
    filled = prep.fill_mode(df, ["n", "s"])
    assert filled.filter("n is null").count() == 5 and filled.filter("s = 'u'").count() == 66 + 5


def test_correlations_are_told_in_both_directions(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 5.0, 5.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "b"] == got["b", "a"] > 0.9 and got["a", "c"] is None
