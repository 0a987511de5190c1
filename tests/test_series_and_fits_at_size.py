"""What keeps smoothing, lifetime values and baskets small on large tables."""

from pyspark.sql import functions as F

from insight.functions.scalar import hyp2f1
from insight.operators import basket, cltv
from insight.operators import timeseries as T


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_smoothing_sorts_wide_rows_never(spark):
    """Sums and lags use the order of blocks; a sort back to dates would spill rows of some twenty sums."""
    df = spark.range(900).selectExpr("id % 3 as k", "date_add(date'2020-01-01', cast(id / 3 as int)) as date", "cast(id as double) as v")
    sorts = [line for line in plan_of(T.ewm_features(df, ["k"], "date", "v")).splitlines() if " Sort " in line]
    assert len(sorts) == 2 and "_block" in sorts[0] and "_block" not in sorts[1]


def test_series_is_summed_once_for_a_row(spark):
    """One series for a row, its arguments chosen before; both ways agree with the plain recurrence."""
    df = spark.range(1).select(*[F.lit(v).alias(c) for c, v in {"x": 3.0, "tx": 20.0, "t": 30.0}.items()])
    e = cltv.bgnbd_expected_purchases(12.0, F.col("x"), F.col("tx"), F.col("t"), 0.5, 8.0, 0.6, 2.5)
    assert plan_of(df.select(e.alias("e"))).count("series(") <= 2  # where it is made, and its plan's list of outputs
    assert spark.range(1).select(hyp2f1(F.lit(1.0), F.lit(1.0), F.lit(2.0), F.lit(None).cast("double")).alias("h")).first().h is None


def test_fits_spread_their_inputs(spark, monkeypatch):
    monkeypatch.setattr(cltv, "PART_ROWS", 10)
    df = spark.range(60).coalesce(1).selectExpr("cast(id % 30 as double) as x")
    data = cltv._compact(df, ["x"])
    assert data.rdd.getNumPartitions() >= 3 and data.agg(F.sum("_w")).first()[0] == 60 and data.count() == 30


def test_baskets_are_made_once(spark, monkeypatch):
    reads = spark.sparkContext.accumulator(0)
    see = F.udf(lambda v: reads.add(1) or v, "string").asNondeterministic()
    rows = [(b, i) for b in range(20) for i in "xyz"[: 1 + b % 3]] + [(None, "x")]
    pairs = spark.createDataFrame(rows, "b long, i string").withColumn("i", see("i"))
    sets = {tuple(r["items"]): (r.freq, r.support) for r in basket.frequent_itemsets(pairs, "b", "i", 0.1).collect()}
    assert reads.value == len(rows)
    assert sets[("x",)] == (21, 21 / 20) and sets[("x", "y")] == (13, 13 / 20)
