"""Data preparation: outliers, missing values, encoding, scaling.

Fitted parameters (limits, medians, modes, scaler statistics, category
shares) are small and computed once - exact quantiles by the order-statistics
module, everything else by one multi-column aggregate - and then applied by
narrow projections inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from insight.functions.order_stats import multi_quantiles
from insight.session import ensure_checkpoint_dir


# ----------------------------------------------------------------- outliers
def outlier_thresholds(df: DataFrame, columns: Sequence[str], q1: float = 0.25,
                       q3: float = 0.75) -> dict[str, tuple[float, float]]:
    """(low, up) = (Q1 - 1.5 IQR, Q3 + 1.5 IQR) per column, exact quantiles."""
    qs = multi_quantiles(df, columns, [q1, q3])
    out = {}
    for c in columns:
        lo, hi = qs[c]
        if lo is None:
            out[c] = (None, None)
            continue
        iqr = hi - lo
        out[c] = (lo - 1.5 * iqr, hi + 1.5 * iqr)
    return out


def limits_frame(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    rows = [(c, lo, up) for c, (lo, up) in limits.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, low_limit double, up_limit double")


def outlier_flags(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Does any row lie beyond the limits? One aggregate for all columns."""
    row = df.agg(*[F.max((F.col(c) < lo) | (F.col(c) > up)).alias(c)
                   for c, (lo, up) in limits.items()])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(False)).alias("has_outliers"))
        for c in limits])).alias("s")).select("s.*")


def outlier_rows(df: DataFrame, column: str, limits: tuple[float, float]) -> DataFrame:
    """Every row beyond the limits (all of them; display caps are the caller's)."""
    lo, up = limits
    return df.where((F.col(column) < lo) | (F.col(column) > up))


def cap(c: str, lo: float | None, up: float | None) -> Column:
    x = F.col(c)
    return F.when(x < lo, F.lit(lo)).when(x > up, F.lit(up)).otherwise(x)


def replace_with_thresholds(df: DataFrame, limits: dict[str, tuple[float, float]],
                            round_limits: bool = False) -> DataFrame:
    """Cap to limits; nulls stay null. ``round_limits`` rounds them half-even
    to integers first, as in the lifetime-value preparation."""
    cols = {}
    for c, (lo, up) in limits.items():
        if round_limits:
            lo, up = float(round(lo)), float(round(up))
        cols[c] = cap(c, lo, up)
    return df.withColumns(cols)


# ------------------------------------------------------------ missing values
def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric nulls -> exact median of the column."""
    med = multi_quantiles(df, columns, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med[c][0]))
                           for c in columns if med[c][0] is not None})


def few_distinct(df: DataFrame, columns: Sequence[str], limit: int) -> dict[str, int]:
    """Exact distinct counts of the columns that have at most ``limit`` distinct values.

    A sketch of all columns (one scan, no copies of rows) rules out those far
    above the limit; only the rest are counted exactly.
    """
    if not columns:
        return {}
    rough = df.agg(*[F.approx_count_distinct(c).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    near = [c for i, c in enumerate(columns) if rough[f"_{i}"] <= 2 * limit + 10]
    if not near:
        return {}
    exact = df.agg(*[F.count_distinct(c).alias(f"_{i}") for i, c in enumerate(near)]).first()
    return {c: exact[f"_{i}"] for i, c in enumerate(near) if exact[f"_{i}"] <= limit}


def fill_mode(df: DataFrame, columns: Sequence[str], max_distinct: int = 25) -> DataFrame:
    """Nulls -> most frequent value (lowest on ties), only for columns with
    at most ``max_distinct`` distinct values, null counted as one."""
    few = few_distinct(df, columns, max_distinct)
    if not few:
        return df
    # mode only where the distinct count is proven small (its buffer holds one
    # entry per distinct value)
    found = df.agg(*[F.mode(c, True).alias(f"_m{i}") for i, c in enumerate(few)],
                   *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(few)]).first()
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(found[f"_m{i}"])) for i, (c, n) in enumerate(few.items())
                           if found[f"_m{i}"] is not None and n + (found[f"_n{i}"] > 0) <= max_distinct})


def fill_absent(df: DataFrame, columns: Sequence[str], min_null_share: float = 0.45,
                token: str = "Na") -> DataFrame:
    """In columns with more than ``min_null_share`` nulls, null means
    "feature absent" and becomes ``token``."""
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    chosen = [c for c in columns if row["_n"] and row[c] / row["_n"] > min_null_share]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(token)) for c in chosen})


# ----------------------------------------------------------------- encoding
def binary_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """X11: non-numeric columns with exactly two distinct values."""
    columns = [c for c in columns if not isinstance(df.schema[c].dataType, NumericType)]
    few = few_distinct(df, columns, 2)
    return [c for c in columns if few.get(c) == 2]


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Codes 0..k-1 in sorted order of the distinct values; null stays null.

    The codes are a table of distinct values, numbered over ranges: sorted
    range partitions count their values, and each adds what lies before it.
    The table is joined back without a hint, and no value passes the driver.
    """
    values = (df.select(F.col(column).alias("_v")).where(F.col("_v").isNotNull()).distinct()
              .repartitionByRange("_v").withColumn("_p", F.spark_partition_id()))
    ensure_checkpoint_dir(df.sparkSession)
    values = values.checkpoint(eager=True)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = (values.groupBy("_p").agg(F.count(F.lit(1)).alias("_k"))  # one row per partition
              .select("_p", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_start")))
    within = F.row_number().over(Window.partitionBy("_p").orderBy("_v")) - 1
    codes = values.withColumn("_i", within).join(starts, "_p").select("_v", (F.col("_i") + F.col("_start")).cast("int").alias("_code"))
    name = out or column
    joined = df.join(codes, F.col(column) == F.col("_v"), "left").drop("_v")
    if name == column:
        return joined.select(*[F.col("_code").alias(c) if c == column else F.col(c) for c in df.columns])
    return joined.withColumnRenamed("_code", name)


def rare_encode(df: DataFrame, columns: Sequence[str], rare_perc: float,
                label: str = "Rare") -> DataFrame:
    """Categories whose share of all rows (nulls in the denominator) is
    below ``rare_perc`` become ``label``.

    The categories of all columns are counted in one scan. At most
    1 / ``rare_perc`` of a column's categories are not rare, so those, a table
    of a size known beforehand, become one set per column in a single row, and
    the rows are labelled without a join on categories.
    """
    columns = list(columns)
    if not columns or rare_perc <= 0:
        return df
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("v"))
                                         for i, c in enumerate(columns)])).alias("s")).select("s.c", "s.v")
    total = df.count()
    kept = (long.where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") / F.lit(total) >= rare_perc).collect() if total else [])
    sets = {i: [r["v"] for r in kept if r["c"] == i] for i in range(len(columns))}
    return df.withColumns({c: F.when(F.col(c).isNull(), F.col(c).cast("string"))
                           .when(F.col(c).cast("string").isin(sets[i]) if sets[i] else F.lit(False), F.col(c).cast("string"))
                           .otherwise(F.lit(label)) for i, c in enumerate(columns)})


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = False, most_values: int = 10_000) -> DataFrame:
    """0/1 columns ``<col>_<value>`` for sorted distinct values; a null row
    gets all zeros. The values of a column are found by a distributed distinct; a
    column with more than ``most_values`` raises, as each becomes a column of the result."""
    out = df
    for c in columns:
        found = df.where(F.col(c).isNotNull()).select(c).distinct().limit(most_values + 1).collect()
        if len(found) > most_values:
            raise ValueError(f"{c} has more than {most_values} values")
        values = sorted(r[0] for r in found)
        keep = values[1:] if drop_first else values
        out = out.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
                               for v in keep}).drop(c)
    return out


# ------------------------------------------------------------------ scaling
def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population sd, as the reference's scaler does."""
    st = df.agg(*[F.avg(c).alias(f"{c}__m") for c in columns],
                *[F.stddev_pop(c).alias(f"{c}__s") for c in columns]).first()
    return df.withColumns({c: F.try_divide(F.col(c) - F.lit(st[f"{c}__m"]), F.lit(st[f"{c}__s"]))
                           for c in columns})


def minmax_scale(df: DataFrame, columns: Sequence[str], low: float = 0.0,
                 high: float = 1.0) -> DataFrame:
    """(x - min) / (max - min) * (high - low) + low."""
    st = df.agg(*[F.min(c).alias(f"{c}__lo") for c in columns],
                *[F.max(c).alias(f"{c}__hi") for c in columns]).first()
    return df.withColumns({
        c: F.try_divide(F.col(c) - F.lit(st[f"{c}__lo"]),
                        F.lit(st[f"{c}__hi"]) - F.lit(st[f"{c}__lo"])) * (high - low) + low
        for c in columns})


def minmax_inverse(df: DataFrame, params: dict[str, tuple[float, float]], low: float = 0.0,
                   high: float = 1.0) -> DataFrame:
    """Inverse of :func:`minmax_scale` given (min, max) per column."""
    return df.withColumns({c: (F.col(c) - low) / (high - low) * (hi - lo) + lo
                           for c, (lo, hi) in params.items()})


def robust_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - median) / (Q3 - Q1) with exact quantiles."""
    qs = multi_quantiles(df, columns, [0.25, 0.5, 0.75])
    return df.withColumns({c: F.try_divide(F.col(c) - F.lit(qs[c][1]), F.lit(qs[c][2] - qs[c][0]))
                           for c in columns})


# ------------------------------------------------------- predicates, binning
def bin_fixed(x: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed fixed bins (lo, hi]; values outside every bin -> null."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (F.col(x) > lo) & (F.col(x) <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def near_constant_columns(df: DataFrame, columns: Sequence[str], min_share: float = 0.01) -> list[str]:
    """0/1 columns where one value's share of all rows is below ``min_share``, one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c) == 1).alias(f"_ones{i}") for i, c in enumerate(columns)]).first()
    if not row["_n"]:
        return list(columns)
    shares = [row[f"_ones{i}"] / row["_n"] for i in range(len(columns))]
    return [c for c, ones in zip(columns, shares) if min(ones, 1 - ones) < min_share]


def categorize(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The label of the first condition that holds; conditions may use several columns."""
    expr = None
    for condition, label in rules:
        expr = F.when(condition, F.lit(label)) if expr is None else expr.when(condition, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def parse_dates(df: DataFrame, columns: Sequence[str], fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text columns to dates; text that is no date becomes null."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)).cast("date") for c in columns})


def name_contains(df: DataFrame, part: str) -> list[str]:
    """P5: columns whose name contains ``part`` (any case)."""
    return [c for c in df.columns if part.lower() in c.lower()]


def first_description(df: DataFrame, code_col: str, desc_col: str, order_col: str) -> DataFrame:
    """The first description of each product code (by ``order_col``)."""
    return df.groupBy(code_col).agg(F.min_by(desc_col, order_col).alias(desc_col))


def basket_clean(df: DataFrame, quantity: str, price: str, cancelled: Column,
                 excluded: Column | None = None, q1: float = 0.01, q3: float = 0.99) -> DataFrame:
    """Drop excluded/cancelled/null rows, keep positive quantity and price,
    then cap both at the (q1, q3) outlier limits."""
    out = df.na.drop("any")
    if excluded is not None:
        out = out.where(~excluded)
    out = out.where(~cancelled & (F.col(quantity) > 0) & (F.col(price) > 0))
    lim = outlier_thresholds(out, [quantity, price], q1, q3)
    return replace_with_thresholds(out, lim)
