"""RFM metrics, scores and segments.

Shape of the plan: one shuffle by customer for the metrics, then the score
thresholds come from :mod:`insight.functions.order_stats` (value counts and
bucket offsets, never a global sort) and reach every row as a one-row
broadcast. Scoring itself is a narrow projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.sources.tables import write_table
from insight.functions.order_stats import (
    first_rank_label,
    multi_first_rank_thresholds,
    qcut_label,
)
from insight.session import ensure_checkpoint_dir

# Segment names by two-digit recency/frequency score, as regular
# expressions over the "RF" string, in this order.
SEGMENT_PATTERNS = [
    (r"[1-2][1-2]", "hibernating"),
    (r"[1-2][3-4]", "at_Risk"),
    (r"[1-2]5", "cant_loose"),
    (r"3[1-2]", "about_to_sleep"),
    (r"33", "need_attention"),
    (r"[3-4][4-5]", "loyal_customers"),
    (r"41", "promising"),
    (r"51", "new_customers"),
    (r"[4-5][2-3]", "potential_loyalists"),
    (r"5[4-5]", "champions"),
]


def analysis_date(per_customer: DataFrame, last: str = "last_date", days_after: int = 2) -> DataFrame:
    """One-row table with the analysis date = latest order + ``days_after`` days (Q21)."""
    return per_customer.agg(F.date_add(F.to_date(F.max(last)), days_after).alias("analysis_date"))


def rfm_metrics(orders: DataFrame, customer: str, date: str, value: str,
                count: str | None = None, today: str | None = None,
                days_after: int = 2) -> DataFrame:
    """Recency (days from the analysis date to the last order), frequency
    (orders, or the sum of ``count``) and monetary (sum of ``value``) per
    customer. Named as measured (quirk Q1 fixed)."""
    freq = F.sum(count) if count else F.count(F.lit(1))
    per = orders.groupBy(customer).agg(F.max(date).alias("last_date"),
                                       freq.alias("frequency"),
                                       F.sum(value).alias("monetary"))
    if today is None:
        ref = analysis_date(per, days_after=days_after)
    else:
        ref = per.sparkSession.range(1).select(F.to_date(F.lit(today)).alias("analysis_date"))
    return (per.crossJoin(F.broadcast(ref))
               .select(customer,
                       F.datediff("analysis_date", F.to_date("last_date")).alias("recency"),
                       "frequency", "monetary"))


def rfm_scores(rfm: DataFrame, key: str, bins: int = 5, materialize: bool = True) -> DataFrame:
    """Recency score by value quantiles (newest = highest); frequency and
    monetary scores by quantiles of the first-rank (ties broken by ``key``)."""
    up = list(range(1, bins + 1))
    if materialize:
        # The per-customer table feeds ~15 small threshold stages; one reliable
        # checkpoint replaces re-deriving it from the order table in each.
        ensure_checkpoint_dir(rfm.sparkSession)
        rfm = rfm.checkpoint(eager=True)
    base = rfm.select(key, "recency", "frequency", "monetary")
    thr, qs = multi_first_rank_thresholds(
        base, ["frequency", "monetary"], key, bins,
        quantile_columns={"recency": [i / bins for i in range(bins + 1)]})
    edges = qs["recency"]
    if len(set(edges)) < len(edges):
        raise ValueError(f"qcut: bin edges must be unique: {edges}")
    scored = rfm.withColumns({
        "recency_score": qcut_label("recency", edges, list(reversed(up))),
        "frequency_score": first_rank_label("frequency", key, thr["frequency"], up),
        "monetary_score": first_rank_label("monetary", key, thr["monetary"], up),
    })
    return scored.withColumn(
        "rf_score", F.concat(F.col("recency_score").cast("string"),
                             F.col("frequency_score").cast("string"))
    ).withColumn(
        "rfm_score", F.concat("rf_score", F.col("monetary_score").cast("string"))
    ).withColumn(
        "rf_sum", F.col("recency_score") + F.col("frequency_score")
    ).withColumn(
        "rfm_sum", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))


def segment_of(rf_score: Column | str) -> Column:
    """C4: map the two-digit RF string to a segment name (unmatched -> null)."""
    rf = F.col(rf_score) if isinstance(rf_score, str) else rf_score
    expr = None
    for pattern, name in SEGMENT_PATTERNS:
        cond = rf.rlike(f"^{pattern}$")
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def rfm_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn("segment", segment_of("rf_score"))


def segment_profile(segmented: DataFrame, key: str) -> DataFrame:
    """A2: customers and mean metrics per segment."""
    return segmented.groupBy("segment").agg(
        F.count(key).alias("n_customers"),
        F.avg("recency").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("monetary").alias("avg_monetary"))


def campaign_audience(segmented: DataFrame, segments: Sequence[str], interest_col: str,
                      interests: Sequence[str], min_value: float | Column | None = None,
                      value_col: str = "monetary", literal_precedence: bool = False) -> DataFrame:
    """Customers in ``segments`` whose interests contain every term of
    ``interests`` and whose value exceeds ``min_value``.

    With ``literal_precedence`` the first segment is OR-ed with the rest of
    the conjunction (``a | b & c & d``), as the original analysis wrote it (Q2).
    """
    conds = [F.coalesce(F.col(interest_col).contains(t), F.lit(False)) for t in interests]
    if min_value is not None:
        mv = min_value if isinstance(min_value, Column) else F.lit(min_value)
        conds.append(F.col(value_col) > mv)
    rest = None
    for c in conds:
        rest = c if rest is None else rest & c
    if literal_precedence:
        tail = F.col("segment") == segments[-1] if len(segments) > 1 else F.lit(True)
        tail = tail & rest if rest is not None else tail
        pred = (F.col("segment") == segments[0]) | tail
    else:
        pred = F.col("segment").isin(list(segments))
        if rest is not None:
            pred = pred & rest
    return segmented.where(pred)


def write_campaign_lists(lists: dict[str, DataFrame], folder: str, columns: Sequence[str], fmt: str = "csv") -> dict[str, str]:
    """Each list's distinct ``columns`` as files under ``folder``/<list name>; returns the paths.

    A rerun overwrites a list. The folder must be one that all executors share.
    """
    paths = {}
    for name, audience in lists.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        write_table(audience.select(*columns).distinct(), paths[name], fmt)
    return paths
