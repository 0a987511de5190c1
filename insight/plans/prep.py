"""Data-preparation queries (X1-X18, P6-P11) on lineitem, part and customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.operators import prep as X
from insight.plans.profile import _PART_N, part_n
from insight.plans.registry import i64, query, r
from insight.sources import Tables

_OCOLS = ["l_quantity", "l_extendedprice", "l_discount"]
_LIM_CTE = "lim AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 "
    f"FROM lineitem" for c in _OCOLS) + """),
lims AS (SELECT column_name, q1 - 1.5 * (q3 - q1) AS low_limit, q3 + 1.5 * (q3 - q1) AS up_limit FROM lim)"""


@query("outlier_limits", sql=f"""WITH {_LIM_CTE}
SELECT column_name, round(low_limit, 6) AS low_limit, round(up_limit, 6) AS up_limit FROM lims""")
def q_outlier_limits(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    lim = X.limits_frame(li, X.outlier_thresholds(li, _OCOLS, 0.25, 0.75))
    return lim.select("column_name", r("low_limit").alias("low_limit"), r("up_limit").alias("up_limit"))


@query("outlier_flags", sql=f"""WITH {_LIM_CTE}
SELECT column_name, max(CASE column_name WHEN 'l_quantity' THEN l_quantity
                                 WHEN 'l_extendedprice' THEN l_extendedprice ELSE l_discount END
                   NOT BETWEEN low_limit AND up_limit) AS has_outliers
FROM lims, lineitem GROUP BY column_name""")
def q_outlier_flags(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return X.outlier_flags(li, X.outlier_thresholds(li, _OCOLS, 0.25, 0.75))


@query("outlier_rows", sql="""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.1) AS q1,
  quantile_cont(l_extendedprice, 0.9) AS q3 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q
WHERE l_extendedprice > q3 + 1.5 * (q3 - q1) OR l_extendedprice < q1 - 1.5 * (q3 - q1)""")
def q_outlier_rows(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    lim = X.outlier_thresholds(li, ["l_extendedprice"], 0.10, 0.90)["l_extendedprice"]
    return X.outlier_rows(li, "l_extendedprice", lim).select(
        "l_orderkey", "l_linenumber", "l_extendedprice")


@query("cap_outliers", sql="""WITH q AS (SELECT
  quantile_cont(l_quantity, 0.01) AS a1, quantile_cont(l_quantity, 0.99) AS a3,
  quantile_cont(l_extendedprice, 0.01) AS b1, quantile_cont(l_extendedprice, 0.99) AS b3 FROM lineitem),
lim AS (SELECT a1 - 1.5 * (a3 - a1) AS alo, a3 + 1.5 * (a3 - a1) AS ahi,
               b1 - 1.5 * (b3 - b1) AS blo, b3 + 1.5 * (b3 - b1) AS bhi FROM q)
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN l_quantity < alo THEN alo WHEN l_quantity > ahi THEN ahi ELSE l_quantity END, 6) AS l_quantity,
  round(CASE WHEN l_extendedprice < blo THEN blo WHEN l_extendedprice > bhi THEN bhi
        ELSE l_extendedprice END, 6) AS l_extendedprice
FROM lineitem, lim""")
def q_cap_outliers(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_quantity",
                                               "l_extendedprice")
    lim = X.outlier_thresholds(li, ["l_quantity", "l_extendedprice"], 0.01, 0.99)
    out = X.replace_with_thresholds(li, lim)
    return out.select("l_orderkey", "l_linenumber", r("l_quantity").alias("l_quantity"),
                      r("l_extendedprice").alias("l_extendedprice"))


@query("fill_median", sql=f"""WITH {_PART_N}, m AS (SELECT quantile_cont(p_size, 0.5) AS med FROM part_n)
SELECT p_partkey, round(coalesce(CAST(p_size AS DOUBLE), med), 6) AS p_size FROM part_n, m""")
def q_fill_median(spark, sf_dir):
    out = X.fill_median(part_n(spark, sf_dir), ["p_size"])
    return out.select("p_partkey", r("p_size").alias("p_size"))


@query("fill_mode", sql=f"""WITH {_PART_N}, m AS (
  SELECT p_type AS mode FROM part_n WHERE p_type IS NOT NULL GROUP BY p_type
  ORDER BY count(*) DESC, p_type LIMIT 1)
SELECT p_partkey, coalesce(p_type, m.mode) AS p_type FROM part_n, m""")
def q_fill_mode(spark, sf_dir):
    out = X.fill_mode(part_n(spark, sf_dir), ["p_type"])
    return out.select("p_partkey", "p_type")


@query("fill_absent", sql=f"""WITH {_PART_N}, sparse AS (SELECT p_partkey,
  CASE WHEN p_size < 25 THEN NULL ELSE p_brand END AS p_brand, p_type FROM part_n)
SELECT p_partkey, coalesce(p_brand, 'Na') AS p_brand, p_type FROM sparse""")
def q_fill_absent(spark, sf_dir):
    """Only the column with more than 45 % nulls (p_brand blanked for small
    parts) gets "Na"; p_type (about 1/6 null) stays as it is."""
    p = part_n(spark, sf_dir).select(
        "p_partkey", F.when(F.col("p_size") < 25, F.lit(None)).otherwise(F.col("p_brand"))
        .alias("p_brand"), "p_type")
    return X.fill_absent(p, ["p_brand", "p_type"], 0.45)


@query("label_encode", sql="""SELECT l_orderkey, l_linenumber,
  CAST(CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS BIGINT) AS l_linestatus FROM lineitem""")
def q_label_encode(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_linestatus",
                                               "l_returnflag")
    for c in X.binary_columns(li, ["l_linestatus", "l_returnflag"]):
        li = X.label_encode(li, c)
    return li.select("l_orderkey", "l_linenumber", i64("l_linestatus").alias("l_linestatus"))


@query("rare_encode", sql="""WITH s AS (SELECT p_brand AS b, count(*) / (SELECT count(*) FROM part) AS share
  FROM part GROUP BY p_brand)
SELECT p_partkey, CASE WHEN share < 0.035 THEN 'Rare' ELSE p_brand END AS p_brand
FROM part JOIN s ON s.b = part.p_brand""")
def q_rare_encode(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_brand")
    return X.rare_encode(p, ["p_brand"], 0.035).select("p_partkey", "p_brand")


_TYPES = ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("one_hot", sql="SELECT p_partkey, " + ", ".join(
    f"CAST(coalesce(p_type = '{v}', false) AS INTEGER) AS p_type_{v}" for v in _TYPES)
    + " FROM part")
def q_one_hot(spark, sf_dir):
    """X13 with drop_first: ECONOMY (first in sorted order) is the dropped level."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_type")
    return X.one_hot(p, ["p_type"], drop_first=True)


@query("scale_standard", sql="""WITH s AS (SELECT avg(p_retailprice) AS m1, stddev_pop(p_retailprice) AS s1,
  avg(p_size) AS m2, stddev_pop(p_size) AS s2 FROM part)
SELECT p_partkey, round((p_retailprice - m1) / s1, 6) AS p_retailprice,
       round((p_size - m2) / s2, 6) AS p_size FROM part, s""")
def q_scale_standard(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_retailprice", "p_size")
    out = X.standard_scale(p, ["p_retailprice", "p_size"])
    return out.select("p_partkey", r("p_retailprice").alias("p_retailprice"),
                      r("p_size").alias("p_size"))


@query("scale_minmax", sql="""WITH s AS (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b,
  min(p_size) AS c, max(p_size) AS d FROM part)
SELECT p_partkey, round((p_retailprice - a) / (b - a) * 99 + 1, 6) AS p_retailprice,
       round((p_size - c) / (d - c) * 99 + 1, 6) AS p_size FROM part, s""")
def q_scale_minmax(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_retailprice", "p_size")
    out = X.minmax_scale(p, ["p_retailprice", "p_size"], 1.0, 100.0)
    return out.select("p_partkey", r("p_retailprice").alias("p_retailprice"),
                      r("p_size").alias("p_size"))


@query("scale_robust", sql="""WITH q AS (SELECT quantile_cont(p_retailprice, [0.25, 0.5, 0.75]) AS a,
  quantile_cont(p_size, [0.25, 0.5, 0.75]) AS b FROM part)
SELECT p_partkey, round((p_retailprice - a[2]) / (a[3] - a[1]), 6) AS p_retailprice,
       round((p_size - b[2]) / (b[3] - b[1]), 6) AS p_size FROM part, q""")
def q_scale_robust(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_retailprice", "p_size")
    out = X.robust_scale(p, ["p_retailprice", "p_size"])
    return out.select("p_partkey", r("p_retailprice").alias("p_retailprice"),
                      r("p_size").alias("p_size"))


_EDGES = [-1000.0, 0.0, 2500.0, 5000.0, 10000.0]
_LABELS = ["negative", "low", "mid", "high"]


@query("bin_fixed", sql="""SELECT c_custkey, CASE
  WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 'negative'
  WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 'low'
  WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 'mid'
  WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 'high' END AS balance_band FROM customer""")
def q_bin_fixed(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", X.bin_fixed("c_acctbal", _EDGES, _LABELS).alias("balance_band"))


@query("derive_ratio", sql="""SELECT l_orderkey, l_linenumber,
  round(l_extendedprice * (1 - l_discount), 6) AS revenue,
  round(CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END, 6) AS unit_price,
  round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge FROM lineitem""")
def q_derive_ratio(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     r(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
                     r(F.try_divide("l_extendedprice", "l_quantity")).alias("unit_price"),
                     r(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
                     .alias("charge"))


@query("basket_clean", sql="""WITH b AS (SELECT l.l_orderkey, l.l_linenumber, l.l_quantity,
    l.l_extendedprice / l.l_quantity AS price FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  WHERE l.l_returnflag <> 'R' AND p.p_type <> 'PROMO' AND l.l_quantity > 0 AND l.l_extendedprice > 0),
q AS (SELECT quantile_cont(l_quantity, 0.01) AS a1, quantile_cont(l_quantity, 0.99) AS a3,
             quantile_cont(price, 0.01) AS b1, quantile_cont(price, 0.99) AS b3 FROM b),
lim AS (SELECT a1 - 1.5 * (a3 - a1) AS alo, a3 + 1.5 * (a3 - a1) AS ahi,
               b1 - 1.5 * (b3 - b1) AS blo, b3 + 1.5 * (b3 - b1) AS bhi FROM q)
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN l_quantity < alo THEN alo WHEN l_quantity > ahi THEN ahi ELSE l_quantity END, 6) AS quantity,
  round(CASE WHEN price < blo THEN blo WHEN price > bhi THEN bhi ELSE price END, 6) AS price
FROM b, lim""")
def q_basket_clean(spark, sf_dir):
    """Returned lines play cancelled invoices, PROMO parts the postage code."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"),
                         "l_partkey").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"), "l_returnflag", "p_type")
    out = X.basket_clean(li, "quantity", "price", cancelled=F.col("l_returnflag") == "R",
                         excluded=F.col("p_type") == "PROMO")
    return out.select("l_orderkey", "l_linenumber", r("quantity").alias("quantity"),
                      r("price").alias("price"))


@query("coerce_types", sql="""SELECT event_id, TRY_CAST(props AS DOUBLE) AS props_number,
  TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k_value,
  CAST(ts AS DATE) AS event_date FROM events""")
def q_coerce_types(spark, sf_dir):
    """Text to number with failures as null, timestamp to date."""
    e = Tables(spark, sf_dir).events
    return e.select("event_id", F.col("props").try_cast("double").alias("props_number"),
                    F.regexp_extract("props", "[0-9]+", 0).try_cast("double").alias("k_value"),
                    F.to_date("ts").alias("event_date"))


@query("first_description", sql="""SELECT p_brand, arg_min(p_name, p_partkey) AS p_name
FROM part GROUP BY p_brand""")
def q_first_description(spark, sf_dir):
    """The first name recorded for each brand code (by part key)."""
    p = Tables(spark, sf_dir).part
    return X.first_description(p, "p_brand", "p_name", "p_partkey")


@query("minmax_inverse", sql="""SELECT p_partkey, round(p_retailprice, 6) AS p_retailprice FROM part""")
def q_minmax_inverse(spark, sf_dir):
    """X15 then X17: scaling to (0, 1) and back returns the original values."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_retailprice")
    lim = p.agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi")).first()
    scaled = X.minmax_scale(p, ["p_retailprice"])
    back = X.minmax_inverse(scaled, {"p_retailprice": (lim["lo"], lim["hi"])})
    return back.select("p_partkey", r("p_retailprice").alias("p_retailprice"))


@query("conditional_category", sql="""SELECT c_custkey, CASE
  WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'builder_in_debt'
  WHEN c_acctbal < 0 THEN 'in_debt'
  WHEN c_acctbal >= 5000 AND c_nationkey < 10 THEN 'rich_near'
  WHEN c_acctbal >= 5000 THEN 'rich_far' ELSE 'usual' END AS category FROM customer""")
def q_conditional_category(spark, sf_dir):
    """A category from conditions over several columns."""
    c = Tables(spark, sf_dir).customer
    debt, rich = F.col("c_acctbal") < 0, F.col("c_acctbal") >= 5000
    label = X.categorize([(debt & (F.col("c_mktsegment") == "BUILDING"), "builder_in_debt"), (debt, "in_debt"),
                          (rich & (F.col("c_nationkey") < 10), "rich_near"), (rich, "rich_far")], "usual")
    return c.select("c_custkey", label.alias("category"))


@query("text_to_date", sql="""SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day
FROM orders""")
def q_text_to_date(spark, sf_dir):
    """Dates kept as text, some of them broken."""
    o = Tables(spark, sf_dir).orders
    text = F.when(F.col("o_orderkey") % 97 == 0, F.lit("no date")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return X.parse_dates(o.select("o_orderkey", text.alias("day")), ["day"], "dd/MM/yyyy")


@query("near_constant", sql="""WITH s AS (SELECT count(*) AS n, count(*) FILTER (l_quantity > 49) AS a,
  count(*) FILTER (l_quantity > 0) AS b, count(*) FILTER (l_discount > 0.05) AS c FROM lineitem),
l AS (SELECT 'top_quantity' AS column_name, a / n AS share FROM s UNION ALL SELECT 'any_quantity', b / n FROM s
  UNION ALL SELECT 'discounted', c / n FROM s)
SELECT column_name FROM l WHERE least(share, 1 - share) < 0.03""")
def q_near_constant(spark, sf_dir):
    """Flags that are almost always the same."""
    flags = Tables(spark, sf_dir).lineitem.select(
        (F.col("l_quantity") > 49).cast("int").alias("top_quantity"), (F.col("l_quantity") > 0).cast("int").alias("any_quantity"),
        (F.col("l_discount") > 0.05).cast("int").alias("discounted"))
    found = X.near_constant_columns(flags, flags.columns, 0.03)
    return spark.createDataFrame([(c,) for c in found], "column_name string")


@query("label_outlier_rows", sql="""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, l_linenumber FROM lineitem, q
WHERE l_extendedprice > q3 + 0.25 * (q3 - q1) OR l_extendedprice < q1 - 0.25 * (q3 - q1)""")
def q_label_outlier_rows(spark, sf_dir):
    """X3 with limits a quarter of an interquartile range out, which some rows exceed."""
    li = Tables(spark, sf_dir).lineitem
    lo, hi = X.outlier_thresholds(li, ["l_extendedprice"], 0.25, 0.75)["l_extendedprice"]
    iqr = (hi - lo) / 4  # the limits lie 1.5 ranges out on each side of one range
    near = (lo + 1.25 * iqr, hi - 1.25 * iqr)
    return X.outlier_rows(li, "l_extendedprice", near).select("l_orderkey", "l_linenumber")
