"""Neighbour methods against brute force on clustered, tied and skewed data."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from insight.operators import neighbours as N


def clustered(n, seed):
    """Clusters, a grid with ties, and one point that a third of the rows share."""
    rnd = random.Random(seed)
    middles = [(rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for _ in range(8)]
    rows = [(i, *(m + rnd.gauss(0, 1) for m in rnd.choice(middles))) for i in range(n)]
    rows += [(n + i, float(i % 12), float(i // 12)) for i in range(n // 3)]
    rows += [(2 * n + i, 7.5, -0.0 if i % 2 else 0.0) for i in range(n // 2)]
    return rows


def brute(rows, k):
    """key -> [(distance, key)] of all rows up to the k-th distance."""
    out = {}
    for i, *x in rows:
        d = sorted((math.sqrt(sum((a - b) * (a - b) for a, b in zip(x, y))), j) for j, *y in rows if j != i)
        edge = d[k - 1][0] if len(d) >= k else math.inf
        out[i] = [e for e in d if e[0] <= edge]
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = clustered(240, 4)
    df = spark.createDataFrame(rows, "id bigint, x double, y double").repartition(5)
    return rows, df, brute(rows, 6)


def test_nearest_equals_brute_force_and_compares_few_pairs(spark, data, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    rows, df, want = data
    pts = N.points(df, "id", ["x", "y"]).checkpoint()
    found = N.nearest(pts, pts, 6).collect()
    place = {r.p: tuple(r.v) for r in pts.collect()}
    point_of = {v: p for p, v in place.items()}
    got = {}
    for r in found:
        if r.p is not None:
            got.setdefault(r.p, {})[r.q] = (r.distance, r.n)
    for i, *x in rows:
        p = point_of[tuple(c + 0.0 for c in x)]
        if p != i:
            continue
        by_point = {}
        for d, j in want[i]:
            q = point_of[tuple(c + 0.0 for c in rows_by_id(rows)[j])]
            by_point[q] = (d, by_point.get(q, (d, 0))[1] + 1)
        assert got[p] == by_point
    compared = sum(r.n for r in found if r.p is None)
    assert compared < 0.35 * len(place) ** 2, (compared, len(place))


def rows_by_id(rows, memo={}):  # noqa: B006
    if id(rows) not in memo:
        memo[id(rows)] = {r[0]: r[1:] for r in rows}
    return memo[id(rows)]


def test_plan_has_no_cartesian_product(spark, data):
    pts = N.points(data[1], "id", ["x", "y"])
    plan = N.nearest(pts, pts, 3)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_few_rows_and_empty_tables(spark):
    schema = "id bigint, x double, y double"
    one = N.points(spark.createDataFrame([(1, 0.0, 0.0)], schema), "id", ["x", "y"])
    assert N.nearest(one, one, 5).where("p is not null").collect() == []
    none = N.points(spark.createDataFrame([], schema), "id", ["x", "y"])
    assert N.nearest(none, none, 5).collect() == []
    three = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 4.0), (3, None, 1.0)], schema)
    pts = N.points(three, "id", ["x", "y"])
    assert sorted((r.p, r.q, r.distance, r.n) for r in N.nearest(pts, pts, 5).where("p is not null").collect()) == [(1, 2, 5.0, 1), (2, 1, 5.0, 1)]


def test_local_outlier_factor_equals_brute_force(spark, data):
    rows, df, _ = data
    near = brute(rows, 6)
    edge = {i: d[-1][0] for i, d in near.items()}
    density = {i: 1 / (sum(max(d, edge[j]) for d, j in ds) / len(ds) + 1e-10) for i, ds in near.items()}
    want = {i: -(sum(density[j] for _, j in ds) / len(ds)) / density[i] for i, ds in near.items()}
    scored = N.local_outlier_factor(df, "id", ["x", "y"], 6).checkpoint()
    got = {r.id: r.lof for r in scored.collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i], want[i], rel_tol=1e-6) for i in want)
    kept = {r.id for r in N.drop_local_outliers(scored, 9).collect()}
    line = sorted(got.values())[9]
    assert kept == {i for i, s in got.items() if s >= line}


def test_knn_impute_equals_brute_force(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(90):
        a, b = rnd.uniform(0, 10), rnd.choice([1.0, 2.0, 3.0])
        row = [i, a, b, a * b + rnd.random()]
        for c in (1, 2, 3):
            if rnd.random() < .15:
                row[c] = None
        rows.append(tuple(row))
    rows.append((90, None, None, None))
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double").withColumn("extra", F.lit("x"))
    low = [min(r[j] for r in rows if r[j] is not None) for j in (1, 2, 3)]
    size = [max(r[j] for r in rows if r[j] is not None) - low[j - 1] for j in (1, 2, 3)]
    scaled = {r[0]: [None if x is None else (x - m) / s for x, m, s in zip(r[1:], low, size)] for r in rows}
    want = {}
    for i, x in scaled.items():
        full = []
        for c in range(3):
            if x[c] is not None:
                full.append(rows[i][c + 1])
                continue
            d = []
            for y in scaled.values():
                both = [k for k in range(3) if x[k] is not None and y[k] is not None]
                if y[c] is not None and both:
                    d.append((math.sqrt(3 / len(both)) * math.sqrt(sum((x[k] - y[k]) ** 2 for k in both)), y[c]))
            d.sort()
            near = [v for e, v in d if e <= d[min(5, len(d)) - 1][0] + 1e-12] if d else [y[c] for y in scaled.values() if y[c] is not None]
            full.append(sum(near) / len(near) * size[c] + low[c])
        want[i] = full
    got = {r.id: [r.a, r.b, r.c] for r in N.knn_impute(df, "id", ["a", "b", "c"], 5).collect()}
    assert got.keys() == want.keys()
    for i in want:
        assert all(math.isclose(g, w, rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got[i], want[i])), (i, got[i], want[i])


def test_small_portions_make_the_same_neighbours(spark, monkeypatch):
    """A task may hold few distances at a time: portions of some rows, tiles and results cut between them."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.integers(0, 30, (400, 2)))], "id long, a double, b double")
    pts = N.points(df, "id", ["a", "b"])

    def found():
        rows = N.nearest(pts, pts, 4)
        return sorted(map(tuple, rows.where("p is not null").collect())), rows.where("p is null").agg({"n": "sum"}).first()[0]
    whole, compared = found()
    monkeypatch.setattr(N, "HELD", 100)
    small, again = found()
    assert small == whole and again == compared
