import numpy as np
import pandas as pd
import pytest

import insight.functions.order_stats as OS

PROBS = [0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 1500), "x": rng.integers(0, 40, 1500).astype(float),
                        "k": np.arange(1500), "y": rng.normal(size=1500)})
    pdf.loc[pdf.g == 0, "x"] = 7.0  # one value holds a third of the rows
    return pdf, spark.createDataFrame(pdf)


#: Usual settings, and ones that make small data take brackets and their narrowing.
SETTINGS = [{}, {"GRID": 40, "BRACKET_ROWS": 30}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_quantiles_match_numpy(frame, settings, monkeypatch):
    pdf, df = frame
    for name, value in settings.items():
        monkeypatch.setattr(OS, name, value)
    got = OS.multi_quantiles(df, ["x", "y"], PROBS)
    assert np.allclose(got["x"], np.quantile(pdf.x, PROBS))
    assert np.allclose(got["y"], np.quantile(pdf.y, PROBS))


def test_grouped_quantiles(frame):
    pdf, df = frame
    res = OS.quantiles(df, "x", PROBS, by=["g"]).toPandas()
    for _, row in res.iterrows():
        assert np.allclose(row.quantiles, np.quantile(pdf[pdf.g == row.g].x, PROBS))


def test_grouped_quantiles_of_large_groups(spark):
    """Groups beyond WHOLE_GROUP are counted inside brackets; a null key is a group; one value is hot."""
    rng = np.random.default_rng(8)
    n = 60_000
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "x": np.round(rng.normal(size=n), 3)})
    pdf.loc[rng.random(n) < 0.3, "x"] = 0.5
    pdf.loc[::1000, "x"] = np.nan
    df = spark.createDataFrame([(None if g == 2 else int(g), None if np.isnan(x) else float(x)) for g, x in pdf.itertuples(index=False)],
                               "g int, x double")
    got = {r.g: r.quantiles for r in OS.quantiles(df, "x", PROBS, by=["g"]).collect()}
    for g in (0, 1, 2):
        assert np.allclose(got[None if g == 2 else g], np.nanquantile(pdf[pdf.g == g].x, PROBS))
    whole = OS.quantiles(df, "x", PROBS).first()["quantiles"]
    assert np.allclose(whole, np.nanquantile(pdf.x, PROBS))
    assert np.allclose(OS.global_quantiles(df, "x", PROBS), np.nanquantile(pdf.x, PROBS))


def _plans_of(df, ask, monkeypatch):
    """Plans of all tables that ``ask`` has written to the checkpoint folder, and of its result if it is a DataFrame."""
    kind, plans = type(df), []
    original = kind.checkpoint

    def watched(self, *args, **kwargs):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return original(self, *args, **kwargs)

    monkeypatch.setattr(kind, "checkpoint", watched)
    got = ask()
    if isinstance(got, kind):
        plans.append(got._jdf.queryExecution().optimizedPlan().toString())
    return plans


def test_scans_of_the_source(spark, monkeypatch):
    """Grouped quantiles read their source twice, whatever the number of quantiles, and copy no row."""
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plans = _plans_of(df, lambda: OS.quantiles(df, "l_quantity", PROBS, by=["l_returnflag"]), monkeypatch)
    assert [p.count("Relation [") for p in plans] == [2, 0]
    assert "Generate" not in plans[0] and "Expand" not in plans[0]


def test_no_row_copy_per_rank(spark, monkeypatch):
    """Ranks of several columns: one scan, one stacked copy per column, no join with the ranks."""
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plans = _plans_of(df, lambda: OS.multi_quantiles(df, ["l_quantity", "l_tax"], PROBS), monkeypatch)
    assert [p.count("Relation [") for p in plans] == [1] and "Join" not in plans[0]


@pytest.mark.parametrize("settings", SETTINGS)
def test_infinite_and_not_a_number(spark, settings, monkeypatch):
    """Not-a-number is the largest value; infinite values and signed zeros are values like others."""
    for name, value in settings.items():
        monkeypatch.setattr(OS, name, value)
    values = [float("nan")] * 30 + [float("-inf")] * 20 + [0.0, -0.0] * 40 + [float(i) for i in range(70)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    order = sorted(values, key=lambda v: (v != v, v))
    for rank in (0, 19, 20, 60, 99, 100, 150, 169, 170, 199):
        got = OS.value_at_rank(df, "v", rank)
        assert got == order[rank] or (got != got and order[rank] != order[rank])


@pytest.mark.parametrize("settings", SETTINGS)
def test_first_rank_qcut_matches_pandas(frame, settings, monkeypatch):
    pdf, df = frame
    for name, value in settings.items():
        monkeypatch.setattr(OS, name, value)
    out = OS.qcut_first_rank(df, "x", "k", [1, 2, 3, 4, 5], "s").toPandas().sort_values("k")
    exp = pd.qcut(pdf.sort_values("k").x.rank(method="first"), 5, labels=[1, 2, 3, 4, 5])
    assert (out.s.values == exp.astype(int).values).all()


def test_value_qcut_matches_pandas(frame):
    pdf, df = frame
    out = OS.qcut(df, "y", [5, 4, 3, 2, 1], "r").toPandas().sort_values("k")
    exp = pd.qcut(pdf.sort_values("k").y, 5, labels=[5, 4, 3, 2, 1])
    assert (out.r.values == exp.astype(int).values).all()


def test_qcut_duplicate_edges_raise(frame):
    _, df = frame
    with pytest.raises(ValueError):
        OS.qcut(df, "x", [1, 2, 3, 4, 5], "s")


def test_qcut_not_ntile(spark):
    # 7 rows in 5 bins: qcut gives 1,1,2,3,4,5,5 (ntile would give 1,1,2,2,3,4,5)
    df = spark.createDataFrame([(i, float(i)) for i in range(7)], "k long, x double")
    out = [r.s for r in OS.qcut_first_rank(df, "x", "k", [1, 2, 3, 4, 5], "s").orderBy("k").collect()]
    assert out == [1, 1, 2, 3, 4, 5, 5]
