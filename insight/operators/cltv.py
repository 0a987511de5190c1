"""Customer lifetime value: BG/NBD + Gamma-Gamma.

Models: Fader, Hardie & Lee (2005) "Counting your customers the easy way";
Fader & Hardie (2013) on the Gamma-Gamma spend model. Likelihoods and
predictions are column expressions (own ``lgamma`` and 2F1, no UDF).

Fitting: customers are first collapsed to distinct (x, t_x, T) - or (x, m) -
with a weight, which is reliably checkpointed into ``spark.checkpoint.dir``.
A damped Newton search runs on the driver over 3-4 numbers; each iteration
evaluates all of its points in two passes over arrays of the checkpointed
table, which Spark keeps for the fit. Only parameter vectors and
sums cross to the driver. A fit that does not reach a flat point raises.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.functions.order_stats import group_medians_of, qcut
from insight.functions.scalar import hyp2f1, lgamma, lgamma_array, log_sum_exp
from insight.session import ensure_checkpoint_dir

# tasks get these functions themselves: the machines they run on need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Weeks per month used to step monthly value (weekly data).
WEEKS_PER_MONTH = 4.345


def cltv_base(orders: DataFrame, customer: str, date: str, value: str,
              today: str | None = None, days_after: int = 2,
              min_frequency: int = 2, money_digits: int | None = None) -> DataFrame:
    """recency_weekly (first to last order), t_weekly (first order to the
    analysis date), frequency (all orders, Q19) and mean spend per order;
    customers with fewer than ``min_frequency`` orders are dropped. With
    ``money_digits`` the spend total is rounded first (to whole cents), so
    summation order cannot move the mean across a rounding boundary."""
    total = F.sum(value)
    if money_digits is not None:
        total = F.round(total, money_digits)
    per = orders.groupBy(customer).agg(F.min(date).alias("_first"), F.max(date).alias("_last"),
                                       F.count(F.lit(1)).alias("frequency"),
                                       total.alias("_total"))
    if today is None:
        ref = per.agg(F.date_add(F.to_date(F.max("_last")), days_after).alias("_today"))
    else:
        ref = per.sparkSession.range(1).select(F.to_date(F.lit(today)).alias("_today"))
    per = per.crossJoin(F.broadcast(ref))
    return per.where(F.col("frequency") >= min_frequency).select(
        customer,
        (F.datediff(F.to_date("_last"), F.to_date("_first")) / 7.0).alias("recency_weekly"),
        (F.datediff("_today", F.to_date("_first")) / 7.0).alias("t_weekly"),
        "frequency",
        F.try_divide(F.col("_total"), F.col("frequency")).alias("monetary_avg"))


# ------------------------------------------------------------ expressions
def bgnbd_loglik_expr(x: Column, tx: Column, T: Column, r: float | Column, alpha: float | Column,
                      a: float | Column, b: float | Column) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    r, alpha, a, b = lit(r), lit(alpha), lit(a), lit(b)
    x = x.cast("double")
    part1 = (lgamma(r + x) - lgamma(r) + r * F.log(alpha)
             + lgamma(a + b) + lgamma(b + x) - lgamma(b) - lgamma(a + b + x))
    a3 = -(r + x) * F.log(alpha + T)
    a4 = F.log(a) - F.log(b + F.greatest(x, F.lit(1.0)) - 1) - (r + x) * F.log(alpha + tx)
    return part1 + F.when(x > 0, log_sum_exp(a3, a4)).otherwise(a3)


def ggamma_loglik_expr(x: Column, m: Column, p: float | Column, q: float | Column,
                       v: float | Column) -> Column:
    lit = lambda val: val if isinstance(val, Column) else F.lit(float(val))
    p, q, v = lit(p), lit(q), lit(v)
    x = x.cast("double")
    return (lgamma(p * x + q) - lgamma(p * x) - lgamma(q) + q * F.log(v)
            + (p * x - 1) * F.log(m) + p * x * F.log(x) - (p * x + q) * F.log(x * m + v))


def bgnbd_loglik(x: np.ndarray, tx: np.ndarray, T: np.ndarray, r: float, alpha: float, a: float, b: float) -> np.ma.MaskedArray:
    """``bgnbd_loglik_expr`` on arrays, masked where that is null: at a logarithm of what is not above 0. Functions of the
    purchase count alone are worked out once for each count."""
    n, of = np.unique(x, return_inverse=True)
    lg = lgamma_array
    part1 = (lg(r + n) - lg(r) + r * np.log(alpha) + lg(a + b) + lg(b + n) - lg(b) - lg(a + b + n))[of]
    a3 = -(r + x) * np.log(alpha + T)
    a4 = (np.log(a) - np.log(b + np.maximum(n, 1.0) - 1))[of] - (r + x) * np.log(alpha + tx)
    m = np.maximum(a3, a4)
    null = (x + min(r, b) <= 0) | (alpha + T <= 0) | ((alpha + tx <= 0) & (x > 0))
    return np.ma.array(part1 + np.where(x > 0, m + np.log(np.exp(a3 - m) + np.exp(a4 - m)), a3), mask=null)


def ggamma_loglik(x: np.ndarray, m: np.ndarray, p: float, q: float, v: float) -> np.ma.MaskedArray:
    """``ggamma_loglik_expr`` on arrays, masked where that is null."""
    n, of = np.unique(x, return_inverse=True)
    lg = lgamma_array
    of_count = (lg(p * n + q) - lg(p * n) - lg(q) + q * np.log(v) + p * n * np.log(n))[of]
    null = (x <= 0) | (m <= 0) | (x * m + v <= 0)
    return np.ma.array(of_count + (p * x - 1) * np.log(m) - (p * x + q) * np.log(x * m + v), mask=null)


def ggamma_expected_profit(x: Column, m: Column, p: float, q: float, v: float) -> Column:
    x = x.cast("double")
    return (p * (v + x * m)) / (p * x + q - 1)


def bgnbd_expected_purchases(t: float, x: Column, tx: Column, T: Column, r: float,
                             alpha: float, a: float, b: float, terms: int = 400) -> Column:
    """Expected purchases in the next ``t`` periods. The 2F1 series is
    summed directly when it converges fast and otherwise through Euler's
    transformation 2F1(a,b;c;z) = (1-z)^(c-a-b) 2F1(c-a,c-b;c;z), whose
    coefficients do not grow with the purchase count. A series whose last term
    still counts raises instead of returning a cut sum."""
    x = x.cast("double")
    ha, hb, hc = r + x, b + x, a + b + x - 1
    z = F.lit(float(t)) / (alpha + T + t)
    direct = hc - ha - hb >= 0
    series = hyp2f1(F.when(direct, ha).otherwise(hc - ha), F.when(direct, hb).otherwise(hc - hb), hc, z, terms)
    h = F.when(direct, series).otherwise(F.pow(1 - z, hc - ha - hb) * series)
    first = (a + b + x - 1) / (a - 1)
    second = 1 - h * F.pow((alpha + T) / (alpha + t + T), r + x)
    denom = 1 + F.when(x > 0, F.lit(1.0)).otherwise(F.lit(0.0)) * (a / (b + x - 1)) * F.pow(
        (alpha + T) / (alpha + tx), r + x)
    return first * second / denom


# ------------------------------------------------------------------ fitting
STEP = 3e-4
#: Distinct inputs of a part of the fits' data.
PART_ROWS = 10_000
STEP_SIZES = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001)


def minimise(evaluate, x0: np.ndarray, tol: float = 1e-6, max_iter: int = 200) -> tuple[np.ndarray, float]:
    """Damped Newton search where ``evaluate(points) -> values`` scores a batch
    of points in one distributed pass.

    One pass gives gradient and curvature by differences, a second one tries
    all step sizes. The search ends when no gradient component exceeds
    ``tol``; a search that does not get there raises, so that no limit on the
    number of steps ever decides a result.
    """
    x, n = np.array(x0, float), len(x0)
    units = np.eye(n) * STEP
    pairs = [(i, j) for i in range(n) for j in range(i)]
    for _ in range(max_iter):
        f = np.array(evaluate([x, *(x + u for u in units), *(x - u for u in units),
                               *(x + units[i] + units[j] for i, j in pairs)]))
        if not np.isfinite(f).all():
            raise RuntimeError("the likelihood is not finite near the current parameters")
        f0, up, down, cross = f[0], f[1:n + 1], f[n + 1:2 * n + 1], f[2 * n + 1:]
        grad = (up - down) / (2 * STEP)
        if np.abs(grad).max() < tol:
            return x, float(np.abs(grad).max())
        hess = np.diag((up - 2 * f0 + down) / STEP ** 2)
        for (i, j), c in zip(pairs, cross):
            hess[i, j] = hess[j, i] = (c - up[i] - up[j] + f0) / STEP ** 2
        curve, axes = np.linalg.eigh(hess)
        move = -axes @ ((axes.T @ grad) / np.maximum(np.abs(curve), 1e-5))
        move *= min(1.0, 2.0 / np.abs(move).max())
        steep = -grad / np.abs(grad).max()
        tries = [x + t * d for d in (move, steep) for t in STEP_SIZES]
        values = np.array(evaluate(tries))
        best = int(np.nanargmin(np.where(np.isfinite(values), values, np.inf)))
        if not values[best] < f0:
            if np.abs(grad).max() < 100 * tol:
                return x, float(np.abs(grad).max())  # as flat as the sums are exact
            raise RuntimeError(f"no descent at gradient {np.abs(grad).max():.3g}")
        x = tries[best]
    raise RuntimeError(f"not converged after {max_iter} steps, gradient {np.abs(grad).max():.3g}")


def _compact(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct inputs with weights, cut from lineage by a reliable checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    data = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_w")).checkpoint(eager=True)
    # every row costs much arithmetic in each pass, so a few megabytes are work for many tasks
    parts = min(df.sparkSession.sparkContext.defaultParallelism, -(-data.count() // PART_ROWS))
    return data.repartition(parts).checkpoint(eager=True) if parts > data.rdd.getNumPartitions() else data


#: Rows of an array, so that what is worked out for it stays in a processor's cache.
ARRAY_ROWS = 8_192


def _arrays(data: DataFrame, cols: Sequence[str]) -> RDD:
    """``cols`` and the weight of at most ``ARRAY_ROWS`` rows at a time as an array of doubles, a row a column, kept until ``unpersist``.
    Rows with a null in one of ``cols`` are not there: a sum passes over their likelihood (``_mean_loglik``)."""
    n = len(cols) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.stack([c.to_numpy(zero_copy_only=False).astype("float64") for c in batch.columns])
            for at in range(0, whole.shape[1], ARRAY_ROWS):
                yield pa.RecordBatch.from_pydict({"a": [np.ascontiguousarray(whole[:, at:at + ARRAY_ROWS]).tobytes()]})

    numbers = data.select(*[F.col(c).cast("double") for c in (*cols, "_w")]).na.drop(subset=list(cols))
    return numbers.mapInArrow(pack, "a binary").rdd.map(lambda r: np.frombuffer(r.a).reshape(n, -1)).persist(StorageLevel.MEMORY_AND_DISK)


def _mean_loglik(arrays: RDD, total: float, loglik: Callable[..., np.ma.MaskedArray], points: Sequence[Sequence[float]]) -> list[float]:
    """Weighted sum of ``loglik(*columns, *point)`` over the ``total`` weight for each point, from one pass; as in SQL, nulls add
    nothing and their weight counts. NaN for a point where a sum is not finite or nothing was added."""
    def of_part(part):
        sums = np.zeros((2, len(points)))
        with np.errstate(all="ignore"):
            for *cols, w in part:
                for i, point in enumerate(points):
                    ll = loglik(*cols, *point)
                    sums[:, i] += w @ ll.filled(0.0), w @ ~np.ma.getmaskarray(ll)
        yield sums

    sums = np.array(arrays.mapPartitions(of_part).collect()).reshape(-1, 2, len(points))
    return [math.fsum(s) / total if n.any() and np.isfinite(s).all() else math.nan for s, n in (sums[:, :, i].T for i in range(len(points)))]


def _fit(data: DataFrame, cols: Sequence[str], loglik: Callable[..., np.ma.MaskedArray], n: int, penalizer: float) -> np.ndarray:
    """The ``n`` positive parameters of least penalised mean negative log-likelihood."""
    total = data.agg(F.sum("_w")).first()[0]
    arrays = _arrays(data, cols)

    def evaluate(points):
        with np.errstate(over="ignore"):
            points = [np.exp(lp) for lp in points]
            values = _mean_loglik(arrays, total, loglik, [[float(v) for v in p] for p in points])
            return [-v + penalizer * float(np.sum(p ** 2)) if np.isfinite(v) else np.inf for v, p in zip(values, points)]

    try:
        return np.exp(minimise(evaluate, np.zeros(n))[0])
    finally:
        arrays.unpersist()


def fit_bgnbd(base: DataFrame, frequency: str = "frequency", recency: str = "recency_weekly",
              age: str = "t_weekly", penalizer: float = 0.001) -> dict[str, float]:
    """Maximum (penalised) likelihood for r, alpha, a, b. Times are
    rescaled by 10 / max(T) during the search, and the penalty is
    ``penalizer * sum(params^2)`` on the rescaled parameters."""
    data = _compact(base.select(F.col(frequency).cast("double").alias("x"),
                                F.col(recency).alias("tx"), F.col(age).alias("T")),
                    ["x", "tx", "T"])
    scale = 10.0 / data.agg(F.max("T")).first()[0]
    scaled = data.withColumns({"tx": F.col("tx") * scale, "T": F.col("T") * scale})
    best = _fit(scaled, ["x", "tx", "T"], bgnbd_loglik, 4, penalizer)
    return {"r": float(best[0]), "alpha": float(best[1] / scale), "a": float(best[2]),
            "b": float(best[3])}


def fit_ggamma(base: DataFrame, frequency: str = "frequency", monetary: str = "monetary_avg",
               penalizer: float = 0.01) -> dict[str, float]:
    """Maximum (penalised) likelihood for p, q, v of the Gamma-Gamma model."""
    data = _compact(base.select(F.col(frequency).cast("double").alias("x"),
                                F.col(monetary).alias("m")), ["x", "m"])
    best = _fit(data, ["x", "m"], ggamma_loglik, 3, penalizer)
    return {"p": float(best[0]), "q": float(best[1]), "v": float(best[2])}


def customer_lifetime_value(base: DataFrame, bg: dict[str, float], gg: dict[str, float],
                            months: int = 6, discount_rate: float = 0.01,
                            weeks: tuple[int, ...] = (12, 24),
                            frequency: str = "frequency", recency: str = "recency_weekly",
                            age: str = "t_weekly", monetary: str = "monetary_avg") -> DataFrame:
    """Expected purchases in each of ``weeks``. C10: discounted value over
    ``months`` months of weekly data."""
    x, tx, T = F.col(frequency), F.col(recency), F.col(age)
    profit = ggamma_expected_profit(x, F.col(monetary), **gg)
    clv = F.lit(0.0)
    prev = F.lit(0.0)
    for i in range(1, months + 1):
        cur = bgnbd_expected_purchases(i * WEEKS_PER_MONTH, x, tx, T, **bg)
        clv = clv + profit * (cur - prev) / (1 + discount_rate) ** i
        prev = cur
    return base.withColumns({
        **{f"exp_purchases_{w}w": bgnbd_expected_purchases(float(w), x, tx, T, **bg) for w in weeks},
        "expected_average_profit": profit,
        "clv": clv,
    })


def minmax_scale_col(df: DataFrame, c: str, out: str, low: float = 1.0,
                     high: float = 100.0) -> DataFrame:
    lim = df.agg(F.min(c).alias("_mn"), F.max(c).alias("_mx"))
    span = F.col("_mx") - F.col("_mn")
    scaled = F.when(span == 0, F.lit(low)).otherwise(
        (F.col(c) - F.col("_mn")) / span * (high - low) + low)
    return df.crossJoin(F.broadcast(lim)).withColumn(out, scaled).drop("_mn", "_mx")


def cltv_pipeline(base: DataFrame, key: str, months: int = 6) -> DataFrame:
    """Fit, score, scale to 1..100 and cut into quartile segments."""
    bg = fit_bgnbd(base)
    gg = fit_ggamma(base)
    ensure_checkpoint_dir(base.sparkSession)
    # once, before the range of the values is taken and before the ranks are looked for
    scored = customer_lifetime_value(base, bg, gg, months=months).checkpoint(eager=True)
    scored = minmax_scale_col(scored, "clv", "scaled_clv").checkpoint(eager=True)
    return qcut(scored, "scaled_clv", ["D", "C", "B", "A"], "cltv_segment")


def cltv_profile(scored: DataFrame) -> DataFrame:
    """C11/A3: customers, and mean, median and sum of the main figures, per value segment."""
    figures = ["recency_weekly", "t_weekly", "frequency", "monetary_avg", "clv", "scaled_clv"]
    return group_medians_of(scored, figures, "cltv_segment").join(scored.groupBy("cltv_segment").agg(
        F.count(F.lit(1)).alias("n_customers"), *[F.avg(c).alias(f"mean_{c}") for c in figures],
        *[F.sum(c).alias(f"sum_{c}") for c in ("frequency", "clv")]), "cltv_segment")
