"""Profiling and description.

Every profile is ONE pass over the table for all columns (stacked long form
or one multi-column ``agg``) instead of one pass per column. Exact quantiles
come from :mod:`insight.functions.order_stats`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from insight.functions.order_stats import multi_quantiles

PROFILE_PROBS = (0.0, 0.05, 0.5, 0.95, 0.99, 1.0)
SUMMARY_PROBS = (0.05, 0.10, 0.20, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90, 0.95, 0.99)


def stack(df: DataFrame, columns: Sequence[str], cast: str = "string",
          keys: Sequence[str] = ()) -> DataFrame:
    """Long form (keys..., column, value) of several columns in one projection."""
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(cast).alias("value"))
                    for c in columns])
    return df.select(*keys, F.explode(arr).alias("_s")).select(*keys, "_s.column_name", "_s.value")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def table_profile(df: DataFrame, columns: Sequence[str],
                  probs: Sequence[float] = PROFILE_PROBS) -> DataFrame:
    """Rows, nulls and exact quantiles per numeric column, long form."""
    spark = df.sparkSession
    counts = df.agg(F.count(F.lit(1)).alias("_n"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    qs = multi_quantiles(df, columns, probs)
    rows = [(c, counts["_n"], counts[c], *qs[c]) for c in columns]
    names = ["column_name", "n_rows", "n_null"] + [f"q{int(round(p * 100)):02d}" for p in probs]
    schema = "column_name string, n_rows long, n_null long, " + ", ".join(
        f"{n} double" for n in names[3:])
    return spark.createDataFrame(rows, schema)


def column_types(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with its rows and nulls from one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
    parts = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(kind).alias("type"),
                      F.col("_n").alias("n_rows"), F.col(f"_{i}").alias("n_null")) for i, (c, kind) in enumerate(df.dtypes)]
    return row.select(F.explode(F.array(*parts)).alias("_s")).select("_s.*")


def head_tail(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first and last ``n`` rows in the order of ``order``, told apart by ``part`` (head, tail). A table of fewer
    rows gives them in both. Each end is a bounded top-n, not a sort of the table; rows tied at an end are any of them."""
    first = df.orderBy(*[F.col(c).asc() for c in order]).limit(n)
    last = df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return first.select(F.lit("head").alias("part"), "*").unionByName(last.select(F.lit("tail").alias("part"), "*"))


def column_roles(df: DataFrame, cat_th: int = 10, car_th: int = 20) -> DataFrame:
    """Categorical / numeric / cardinal role per column (nulls not counted).

    Strings are categorical unless they have more than ``car_th`` distinct
    values (cardinal); non-strings with fewer than ``cat_th`` distinct values
    are categorical, other non-strings numeric."""
    nd = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns])
    parts = []
    for f in df.schema.fields:
        n = F.col(f.name)
        if isinstance(f.dataType, StringType):
            role = F.when(n > car_th, "cardinal").otherwise("categorical")
        else:
            role = F.when(n < cat_th, "categorical").otherwise("numeric")
        parts.append(F.struct(F.lit(f.name).alias("column_name"), role.alias("role"),
                              n.cast("long").alias("n_distinct")))
    return nd.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def numeric_summary(df: DataFrame, columns: Sequence[str],
                    probs: Sequence[float] = SUMMARY_PROBS) -> DataFrame:
    """Count, mean, std, min, max and exact percentiles per column."""
    spark = df.sparkSession
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    st = df.agg(*aggs).first()
    qs = multi_quantiles(df, columns, probs)
    names = [f"p{int(round(p * 100)):02d}" for p in probs]
    rows = [(c, st[f"{c}__n"], st[f"{c}__mean"], st[f"{c}__std"], st[f"{c}__min"],
             st[f"{c}__max"], *qs[c]) for c in columns]
    schema = ("column_name string, count long, mean double, std double, min double, max double, "
              + ", ".join(f"{n} double" for n in names))
    return spark.createDataFrame(rows, schema)


def category_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency and percent of all rows (nulls in the denominator)."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    long = stack(df, columns).where(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(total)).select(
        "column_name", F.col("value").alias("category"), "n",
        (F.col("n") * 100.0 / F.col("_total")).alias("ratio"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_miss) for every column, one pass."""
    columns = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_miss")) for c in columns
    ])).alias("s")).select("s.*")


def missing_values_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with nulls, their count and percent (2 decimals)."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return null_counts(df, columns).where(F.col("n_miss") > 0).crossJoin(
        F.broadcast(total)).select(
        "column_name", "n_miss", F.bround(F.col("n_miss") * F.lit(100.0) / F.col("_total"), 2).alias("ratio"))


def missing_vs_target(df: DataFrame, target: str, na_columns: Sequence[str]) -> DataFrame:
    """Target mean and count by the null flag of each column, one pass."""
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"),
                             F.col(c).isNull().cast("int").alias("na_flag")) for c in na_columns])
    long = df.select(target, F.explode(arr).alias("s")).select("s.column_name", "s.na_flag", target)
    return long.groupBy("column_name", "na_flag").agg(F.avg(target).alias("target_mean"),
                                                 F.count(target).alias("count"))


def target_mean(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Mean of every numeric column per target class, one aggregate."""
    return df.groupBy(target).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def rare_profile(df: DataFrame, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """Per category COUNT, RATIO (share of all rows) and target mean."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    keys = [target] if target else []
    long = stack(df, columns, keys=keys)
    aggs = [F.count(F.lit(1)).alias("count")]
    if target:
        aggs.append(F.avg(target).alias("target_mean"))
    g = long.groupBy("column_name", "value").agg(*aggs)
    return g.crossJoin(F.broadcast(total)).select(
        "column_name", F.col("value").alias("category"), "count",
        (F.col("count") / F.col("_total")).alias("ratio"),
        *(["target_mean"] if target else []))


def _corr(a: str, b: str):
    """Pearson correlation over pairwise-complete rows; null (not an error)
    for a constant column (ANSI mode raises inside ``corr``)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    cov = F.covar_samp(x, y)
    return F.try_divide(cov, F.stddev_samp(x) * F.stddev_samp(y))


#: A variance below this share of the mean square (about the column's mean) counts as none: it is rounding.
NO_VARIANCE = 1e-13


def gram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per pair of columns (i, j), over the rows where both are present and with every column centred on its mean:
    n, sum of products p, sums si and sj, sums of squares qi and qj. Two scans; each task multiplies its rows as blocks
    (values and null patterns) and gives one row per pair, so no aggregate is made per pair."""
    columns = list(columns)
    size = len(columns)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    centre = np.array([0.0 if m is None else m for m in means])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, size, size))
        for batch in batches:
            here = np.column_stack([~np.asarray(c.is_null()) for c in batch.columns]).astype(float)
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            x = np.where(here > 0, x - centre, 0.0)
            with np.errstate(invalid="ignore", over="ignore"):
                total += np.stack([here.T @ here, x.T @ x, x.T @ here, (x * x).T @ here])
        n, p, s, q = total
        i, j = np.divmod(np.arange(size * size), size)
        cols = [i, j, *[m.ravel() for m in (n, p, s, s.T, q, q.T)]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["i", "j", "n", "p", "si", "sj", "qi", "qj"])

    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    sums = ["n", "p", "si", "sj", "qi", "qj"]
    parts = rows.mapInArrow(blocks, "i bigint, j bigint, " + ", ".join(f"{c} double" for c in sums))
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long-form correlation matrix (col_a, col_b, corr) over pairwise complete rows from the blocks of
    :func:`gram`. A pair with fewer than two rows or a column that is constant there has a null correlation, and so
    have all pairs of an empty table."""
    def spread(square: str, total: str) -> Column:
        var = F.col(square) - F.col(total) * F.try_divide(F.col(total), F.col("n"))
        return F.when((F.col("n") > 1) & (var > NO_VARIANCE * F.col(square)), var)

    cov = F.col("p") - F.col("si") * F.try_divide(F.col("sj"), F.col("n"))
    corr = cov / F.sqrt(spread("qi", "si")) / F.sqrt(spread("qj", "sj"))
    size = len(columns)
    pairs = df.sparkSession.range(size * size, numPartitions=1).select(
        F.floor(F.col("id") / size).cast("bigint").alias("i"), (F.col("id") % size).alias("j"))
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.join(gram(df, columns), ["i", "j"], "left").select(
        names[F.col("i")].alias("col_a"), names[F.col("j")].alias("col_b"), corr.alias("corr"))


def target_correlation(df: DataFrame, columns: Sequence[str], target: str,
                       corr_th: float = 0.5) -> DataFrame:
    """Columns whose |corr with target| > threshold (the target included)."""
    row = df.agg(*[_corr(c, target).alias(c) for c in columns])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("corr")) for c in columns
    ])).alias("s")).select("s.*")
    return long.where(F.abs("corr") > corr_th)


def high_correlated_cols(df: DataFrame, columns: Sequence[str], corr_th: float = 0.5) -> DataFrame:
    """Columns to drop - |corr| > threshold with any earlier column."""
    cm = corr_matrix(df, columns)
    pos = {c: i for i, c in enumerate(columns)}
    idx = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(pos[c]))])
    return (cm.where((idx[F.col("col_a")] < idx[F.col("col_b")]) & (F.abs("corr") > corr_th))
              .select(F.col("col_b").alias("column_name")).distinct())


def distinct_count_diff(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns whose distinct count differs between two tables."""
    def nd(df, name):
        row = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
        return row.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias(name)) for c in columns
        ])).alias("s")).select("s.*")
    return nd(a, "n_a").join(nd(b, "n_b"), "column_name").where(F.col("n_a") != F.col("n_b"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts of equal-width bins over [min, max]; the last bin is closed."""
    lim = df.agg(F.min(column).alias("_mn"), F.max(column).alias("_mx"))
    x = F.col(column).cast("double")
    width = (F.col("_mx") - F.col("_mn")) / bins
    b = F.least(F.floor((x - F.col("_mn")) / width).cast("int") + 1, F.lit(bins))
    b = F.when(F.col("_mx") == F.col("_mn"), F.lit(1)).otherwise(b)
    return (df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(lim))
              .withColumn("bin", b)
              .groupBy("bin", "_mn", "_mx").agg(F.count(F.lit(1)).alias("count"))
              .select("bin", (F.col("_mn") + (F.col("bin") - 1) * (F.col("_mx") - F.col("_mn")) / bins)
                      .alias("lo"), (F.col("_mn") + F.col("bin") * (F.col("_mx") - F.col("_mn")) / bins)
                      .alias("hi"), "count"))


def null_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of null indicators between columns that have nulls
    (columns without any, or with nothing but nulls, are left out)."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(c) for c in columns]).first()
    columns = [c for c in columns if 0 < row[c] < row["_n"]]
    flags = df.select(*[F.col(c).isNull().cast("double").alias(c) for c in columns])
    return corr_matrix(flags, columns)
