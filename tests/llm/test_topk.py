import math
import random

from insight.llm import topk


def rows():
    rnd = random.Random(2)
    out = [(i, [rnd.uniform(-1, 1) * rnd.choice([1, 1e-25, 1e12 if i % 7 == 0 else 1]) for _ in range(3 if i % 11 else 2)])
           for i in range(300)]
    out += [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan")] * 3), (303, []), (304, [float("inf"), 0.0, 0.0]),
            (5, [1.0, 2.0, 3.0]), (None, [1.0, 1.0, 1.0]), (400, [-1e-30, 0.0, 1.0]), (500, [1e30, 1e30, -1e30]),
            (501, [1e30, 1e30, 1e30]), (502, [-1e30, 0.0, 0.0]), (600, [0.5, 0.5, 0.5]), (601, [0.5, 0.5, 0.5])]
    return out


def test_equals_brute_force(spark):
    df = spark.createDataFrame(rows(), "vec_id bigint, embedding array<double>").repartition(5)
    q = topk.quantised(df)
    got = topk.search(q.filter("vec_id % 20 = 0"), q, 10, 5, shard_bytes=500, query_bytes=100).collect()
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows()
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, v in whole:
        if i % 20 == 0:
            scored = sorted(((sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i and len(w) == len(v)),
                            key=lambda p: (-p[0], p[1]))[:10]
            want += [(i, r + 1, j, max(-2 ** 63, min(2 ** 63 - 1, x))) for r, (x, j) in enumerate(scored)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_no_rows_fewer_rows_and_clashing_columns(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, dim int")
    q = topk.quantised(none)
    assert topk.search(q, q, 10, 3).collect() == []
    two = spark.createDataFrame([(0, [1.0, 0.0], 1, "x"), (1, [2.0, 0.0], 1, "y"), (2, [2.0, 0.0], 1, "z")],
                                "vec_id bigint, embedding array<float>, dim int, ids string")
    q = topk.quantised(two)
    got = topk.search(q.filter("vec_id = 0"), q, 10, 3).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in got] == [(1, 1, 2 << 20), (2, 2, 2 << 20)]
