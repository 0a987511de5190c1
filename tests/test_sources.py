"""Scans and sinks, round trips."""

import datetime

import pytest

from insight.operators import prep
from insight.sources import tables

ROWS = [(1, "a", 1.5, datetime.date(2024, 1, 2)), (2, None, None, None), (3, "x,y", -2.0, datetime.date(2023, 12, 31))]
SCHEMA = "id int, name string, value double, day date"


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_sink_and_scan_round_trip(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    tables.write_table(spark.createDataFrame(ROWS, SCHEMA), path, fmt)
    back = tables.read_csv(spark, path, SCHEMA) if fmt == "csv" else tables.load(spark, "train", {"train": path})
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)


def test_unknown_names_raise(spark):
    with pytest.raises(KeyError):
        tables.load(spark, "test", {"train": "x"})
    with pytest.raises(KeyError):
        tables.read_table(spark, "/x", "no_table")


def test_bad_cells_raise_or_are_kept(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,value\n1,2.5\n2,oops\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(path), "id int, value double").collect()
    got = tables.read_csv(spark, str(path), "id int, value double", bad_rows="bad").collect()
    assert [(r.id, r.value, r.bad) for r in got] == [(1, 2.5, None), (2, None, "2,oops")]


def test_dates_in_a_given_format(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("day\n31/12/2023\n")
    assert tables.read_csv(spark, str(path), "day date", date_format="dd/MM/yyyy").first()["day"] == datetime.date(2023, 12, 31)


def test_partitioned_sink(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.write_table(spark.createDataFrame(ROWS, SCHEMA), path, partition_by=["name"])
    assert spark.read.parquet(path).count() == 3


def test_one_hot_of_many_values_and_names(spark):
    df = spark.range(1200).selectExpr("id", "cast(id as string) as v")
    out = prep.one_hot(df, ["v"])
    assert len(out.columns) == 1201 and prep.name_contains(df, "V") == ["v"]
    assert out.selectExpr("sum(v_7) as s").first()["s"] == 1


def test_one_hot_refuses_a_column_of_many_values(spark):
    df = spark.range(30).selectExpr("id", "cast(id as string) AS v")
    with pytest.raises(ValueError, match="more than 20 values"):
        prep.one_hot(df, ["v"], most_values=20)
    assert len(prep.one_hot(df, ["v"], most_values=30).columns) == 31
