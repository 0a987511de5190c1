import math
import random

import numpy as np
import pytest

from insight.llm import hard_negatives as H


def brute(rows, anchor_ids, scale=256):
    use = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows
           if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, lab, v in sorted((r for r in use if r[0] in anchor_ids), key=lambda r: (r[1], r[2])):
        asked.setdefault(i, (lab, v))
    out = []
    for i, (lab, v) in asked.items():
        scored = sorted(((sum(a * b for a, b in zip(v, w)), j, other == lab) for j, other, w in use if j != i and len(w) == len(v)),
                        key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scored if s[2]][:5]:
            bad = [s for s in scored if not s[2] and 30 * p <= 100 * s[0] <= 90 * p][:10]
            out += [(i, j, r + 1, n, p, s) for r, (s, n, _) in enumerate(bad)]
    return sorted(out)


def mined(spark, rows, every, monkeypatch, **small):
    for name, value in {"SAMPLE": 60, "BLOCK_BYTES": 400, "TILE_BYTES": 100, **small}.items():
        monkeypatch.setattr(H, name, value)
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").repartition(4)
    q = H.quantised(df)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in H.hard_negatives(q, q.filter(f"vec_id % {every} = 0")).select(*cols).collect())


def clustered(n, seed):
    rnd = random.Random(seed)
    middles = [[rnd.uniform(-2, 2) for _ in range(4)] for _ in range(6)]
    return [(i, rnd.randrange(3), [x + rnd.gauss(0, .1) for x in middles[0 if rnd.random() < .4 else rnd.randrange(6)]]) for i in range(n)]


def test_equals_brute_force_on_clusters_ties_and_odd_rows(spark, monkeypatch):
    rows = clustered(400, 1)
    rows += [(1000 + i, i % 2, [1.0, 1.0, 1.0, 1.0]) for i in range(60)]  # equal vectors: ties to the smaller id
    rows += [(2000 + i, i % 3, [float(i), 1.0, -1.0]) for i in range(12)]  # another length
    rows += [(2020, None, [1.0] * 4), (2040, 1, None), (2060, 1, []), (2080, 1, [1.0, None, 1.0, 1.0]), (2100, 1, [math.nan] * 4),
             (2120, 1, [math.inf] * 4), (None, 1, [1.0] * 4), (20, 2, [1.0, 1.0, 1.0, 1.1]), (40, 1, [0.0] * 4), (2140, 0, [3.0])]
    got = mined(spark, rows, 20, monkeypatch)
    assert got == brute(rows, set(range(0, 3000, 20)))
    assert len(got) > 300


def test_tree_rules_out_subtrees_and_no_row_of_a_window(monkeypatch):
    """On clusters most leaves are not visited, and none that holds a row inside the window."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * (np.repeat(rng.normal(0, 2, (30, 6)), 80, 0) + rng.normal(0, .05, (2400, 6))))
    tree = H.grown(x[::8], 8, 16)
    norms = (x * x).sum(1)

    def seen(node, j, d, n):
        tree.low[node][:, j], tree.high[node][:, j] = d.min(0), d.max(0)
        tree.n_low[node][j], tree.n_high[node][j] = n.min(), n.max()
    leaf = tree.place(x, norms, seen)
    asks = x[::100]
    scores = asks @ x.T
    top = np.sort(scores, 1)[:, -10:]
    lows, highs = top[:, :1], top[:, 4:5]
    went = {(leaf_, i) for leaf_, rows in tree.visits(asks, norms[::100], lows, highs) for i in rows.tolist()}
    for i in range(len(asks)):
        for r in np.flatnonzero((scores[i] >= lows[i]) & (scores[i] <= highs[i])):
            assert (int(leaf[r]), i) in went
    assert len(went) < .5 * tree.leaves * len(asks), (len(went), tree.leaves)


def test_large_numbers_are_exact_or_raise():
    a = np.array([[2.0 ** 27 + 1, 3.0]])
    assert H.products(a, a)[0, 0] == (2 ** 27 + 1) ** 2 + 9
    with pytest.raises(ArithmeticError):
        H.products(a * 2 ** 10, a * 2 ** 10)


def test_floor_division(spark):
    values = [-201, -200, -199, -1, 0, 1, 99, 100, 101, 90 * (1 << 55), -90 * (1 << 55) + 7]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    from pyspark.sql import functions as F
    assert [r[0] for r in df.select(H.floor_div(F.col("x"), 100)).collect()] == [v // 100 for v in values]


def test_empty_few_and_clashing(spark, monkeypatch):
    assert mined(spark, [], 1, monkeypatch) == []
    assert mined(spark, [(0, 1, [1.0])], 1, monkeypatch) == []
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [.5, 0.0]), (3, 2, [.5, 9.0])]
    assert mined(spark, rows, 100, monkeypatch) == brute(rows, {0}) == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 3, 65536, 32768)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, label int, embedding array<float>, v string, leaf string")
    q = H.quantised(df)
    assert H.hard_negatives(q, q.filter("vec_id = 0")).count() == 2
