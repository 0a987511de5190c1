"""Table scans and sinks.

S1/S2: CSV with an explicit schema (dates parsed by the schema, never by
inference). S3: a named catalog switch. S4: file sink. S5: drop columns that
hold only nulls. Parquet is the default format for everything we read;
column pruning and predicate pushdown happen in the scan because every
operator is lazy and selects by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the parquet tables under one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True, date_format: str | None = None,
             timestamp_format: str | None = None, bad_rows: str | None = None) -> DataFrame:
    """CSV scan with an explicit schema. A malformed cell raises; with
    ``bad_rows`` it becomes null and that extra column holds the row's text."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE" if bad_rows else "FAILFAST")
    if bad_rows:
        ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        schema = f"{ddl}, `{bad_rows}` string"
        reader = reader.option("columnNameOfCorruptRecord", bad_rows)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.schema(schema).csv(path)


def load(spark: SparkSession, name: str, catalog: dict[str, str],
         fmt: str = "parquet") -> DataFrame:
    """S3: resolve a data set name ("train", "test", ...) to a path and scan it."""
    if name not in catalog:
        raise KeyError(f"unknown data set {name!r}; known: {sorted(catalog)}")
    return spark.read.format(fmt).load(catalog[name])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, header: bool = True) -> None:
    """Sink. CSV keeps a header row; no row index is written (keys are columns)."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """One aggregate job counts non-nulls of every column; the result schema
    depends on data, so this is a (tiny, one-row) metadata action."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    keep = [c for c in df.columns if counts[c] > 0]
    return df.select(*keep)
