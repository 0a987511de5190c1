"""Model queries: regression on lineitem x part,
classification on labels x documents, clustering of customers by RFM."""

from __future__ import annotations

from pyspark.sql import functions as F

from insight.operators import ml as L
from insight.operators import prep as X
from insight.plans import crm
from insight.plans.registry import query, r
from insight.session import ensure_checkpoint_dir
from insight.sources import Tables

_REG_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


def _reg_data(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice",
                                       "p_size"), "l_partkey")
    li = li.withColumn("row_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return L.hash_split(li.select("row_key", "l_extendedprice", *_REG_FEATURES), "row_key", 0.2)


#: The split of ``hash_split`` with its seed and a share of 0.2.
_SPLIT_SQL = """d AS (SELECT l_orderkey * 10 + l_linenumber AS row_key, CAST(l_extendedprice AS DOUBLE) AS y,
  CAST(l_quantity AS DOUBLE) AS x0, CAST(l_discount AS DOUBLE) AS x1, CAST(l_tax AS DOUBLE) AS x2,
  CAST(p_retailprice AS DOUBLE) AS x3, CAST(p_size AS DOUBLE) AS x4,
  CASE WHEN ('0x' || substr(md5(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) || '|17'), 1, 8))::BIGINT % 10000 < 2000
       THEN 'test' ELSE 'train' END AS split
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""


def _ols_sql() -> str:
    """Least squares by Gauss-Jordan elimination of the training rows' covariances, one step per feature."""
    n = len(_REG_FEATURES)
    names = [f"x{i}" for i in range(n)] + ["y"]
    steps = ["a0 AS (SELECT " + ", ".join(
        [f"covar_pop({names[i]}, {names[j]}) AS c{i}_{j}" for i in range(n) for j in range(n + 1)]
        + [f"avg({c}) AS m_{c}" for c in names]) + " FROM d WHERE split = 'train')"]
    keep = ", ".join(f"m_{c}" for c in names)
    for k in range(n):
        cells = [f"c{i}_{j} / c{k}_{k} AS c{i}_{j}" if i == k else f"c{i}_{j} - c{i}_{k} * c{k}_{j} / c{k}_{k} AS c{i}_{j}"
                 for i in range(n) for j in range(n + 1)]
        steps.append(f"a{k + 1} AS (SELECT {', '.join(cells)}, {keep} FROM a{k})")
    intercept = "m_y - " + " - ".join(f"c{i}_{n} * m_x{i}" for i in range(n))
    guess = f"{intercept} + " + " + ".join(f"c{i}_{n} * x{i}" for i in range(n))
    terms = " UNION ALL ".join([f"SELECT 'intercept' AS term, {intercept} AS value FROM a{n}"] + [
        f"SELECT '{f}', c{i}_{n} FROM a{n}" for i, f in enumerate(_REG_FEATURES)])
    return f"""WITH {_SPLIT_SQL}, {', '.join(steps)},
e AS (SELECT split, y, y - ({guess}) AS e FROM d, a{n}),
g AS (SELECT split, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / (count(*) * var_pop(y)) AS r2 FROM e GROUP BY split)
SELECT term, round(value, 4) AS value FROM ({terms} UNION ALL SELECT 'rmse_' || split, rmse FROM g
  UNION ALL SELECT 'r2_' || split, r2 FROM g)"""


@query("hash_split", sql=f"WITH {_SPLIT_SQL} SELECT row_key, split FROM d")
def q_hash_split(spark, sf_dir):
    """L1: every line labelled train/test by a seeded key hash."""
    return _reg_data(spark, sf_dir).select("row_key", "split")


@query("linear_regression", sql=_ols_sql())
def q_linear_regression(spark, sf_dir):
    """OLS coefficients and train/test RMSE and R^2."""
    d = _reg_data(spark, sf_dir)
    model = L.fit_linear(d.where(F.col("split") == "train"), _REG_FEATURES, "l_extendedprice")
    pred = model.transform(L.assemble(d, _REG_FEATURES))
    met = L.regression_metrics(pred, "l_extendedprice", by=["split"])
    coef = L.coefficients_table(spark, model, _REG_FEATURES)
    long = met.select(F.concat(F.lit("rmse_"), "split").alias("term"), F.col("rmse").alias("value")) \
        .unionByName(met.select(F.concat(F.lit("r2_"), "split").alias("term"), F.col("r2").alias("value")))
    return coef.unionByName(long).select("term", r("value", 4).alias("value"))


@query("gbt_regression")
def q_gbt_regression(spark, sf_dir):
    """Boosted trees (100 rounds of depth 5), test RMSE, importances (zero-importance flagged)."""
    ensure_checkpoint_dir(spark)
    d = _reg_data(spark, sf_dir).checkpoint(eager=True)
    model = L.fit_gbt(d.where(F.col("split") == "train"), _REG_FEATURES, "l_extendedprice", by_cells=True)
    imp = L.importance_table(spark, model, _REG_FEATURES)
    rmse = L.regression_metrics(model.transform(L.assemble(d.where(F.col("split") == "test"),
                                                          _REG_FEATURES)), "l_extendedprice")
    return imp.withColumn("zero_importance", F.col("importance") == 0).crossJoin(
        rmse.select(r("rmse").alias("test_rmse")))


@query("gbt_top_features")
def q_gbt_top_features(spark, sf_dir):
    """Refit on the three strongest features; test RMSE of both models and
    the split counts (L10) of the full one."""
    ensure_checkpoint_dir(spark)
    d = _reg_data(spark, sf_dir).checkpoint(eager=True)
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    full = L.fit_gbt(train, _REG_FEATURES, "l_extendedprice", by_cells=True)
    top = L.top_features(full, _REG_FEATURES, 3)
    small = L.fit_gbt(train, top, "l_extendedprice", by_cells=True)
    rmse = [L.regression_metrics(m.transform(L.assemble(test, f)), "l_extendedprice").first()["rmse"]
            for m, f in ((full, _REG_FEATURES), (small, top))]
    return L.split_counts(spark, full, _REG_FEATURES).select(
        "feature", "splits", F.col("feature").isin(top).alias("kept"),
        F.lit(rmse[0]).alias("rmse_all"), F.lit(rmse[1]).alias("rmse_top"))


#: Learning rate x rounds x share of the columns a split may use (2 x 3 x 3 points).
_GRID = {"stepSize": [0.01, 0.1], "maxIter": [10, 20, 40], "featureSubsetStrategy": ["0.5", "0.7", "1.0"]}


@query("grid_search")
def q_grid_search(spark, sf_dir):
    """5-fold cross-validated grid (18 points, 30 fits) with mean RMSE per point."""
    d = _reg_data(spark, sf_dir).where(F.col("split") == "train")
    found = L.cross_validate(d, _REG_FEATURES, "l_extendedprice", folds=5, grid=_GRID, key="row_key")
    rows = [(float(p["stepSize"]), int(p["maxIter"]), float(p["featureSubsetStrategy"]), float(rmse)) for p, rmse in found]
    return spark.createDataFrame(rows, "step_size double, max_iter int, feature_share double, mean_rmse double")


@query("random_forest")
def q_random_forest(spark, sf_dir):
    """Predict document quality from its length, language and source."""
    t = Tables(spark, sf_dir)
    docs = t.documents.select("doc_id", "n_chars", "lang", "source").join(
        t.labels.select("doc_id", "quality"), "doc_id")
    docs = X.one_hot(docs, ["lang", "source"], drop_first=False)
    feats = [c for c in docs.columns if c not in ("doc_id", "quality")]
    d = L.hash_split(docs, "doc_id", 0.3, seed=17)
    model = L.fit_random_forest(d.where(F.col("split") == "train"), feats, "quality")
    acc = L.accuracy(model.transform(L.assemble(d.where(F.col("split") == "test"), feats)), "quality")
    return L.importance_table(spark, model, feats).crossJoin(acc.select(r("accuracy").alias("accuracy")))


def _rfm_scaled(spark, sf_dir):
    m = crm._rfm(spark, sf_dir)
    return X.minmax_scale(m, ["recency", "frequency", "monetary"])


_RFM = ["recency", "frequency", "monetary"]


@query("kmeans")
def q_kmeans(spark, sf_dir):
    """K from the knee over 2..20, k-means on scaled RFM, 1-based
    labels, per-cluster profile."""
    ensure_checkpoint_dir(spark)
    data = _rfm_scaled(spark, sf_dir).checkpoint(eager=True)
    k = next(k for k, _, knee in L.elbow(data, _RFM, range(2, 21)) if knee)
    lab = L.kmeans(data, _RFM, k=k).transform(L.assemble(data, _RFM)).withColumn(
        "cluster", F.col("prediction") + 1)
    return L.cluster_profile(lab, "cluster", _RFM)


@query("elbow")
def q_elbow(spark, sf_dir):
    """Inertia for k = 1..29 and the knee over k >= 2."""
    ensure_checkpoint_dir(spark)
    data = _rfm_scaled(spark, sf_dir).checkpoint(eager=True)
    rows = L.elbow(data, _RFM, range(1, 30), knee_from=2)
    return spark.createDataFrame(rows, "k int, inertia double, knee boolean")


@query("bisecting")
def q_bisecting(spark, sf_dir):
    """8 clusters, top-down."""
    ensure_checkpoint_dir(spark)
    data = _rfm_scaled(spark, sf_dir).checkpoint(eager=True)
    cols = ["recency", "frequency", "monetary"]
    model = L.bisecting(data, cols, 8)
    lab = model.transform(L.assemble(data, cols)).withColumn("cluster", F.col("prediction") + 1)
    return L.cluster_profile(lab, "cluster", cols)
