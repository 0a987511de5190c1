import random

from pyspark.sql import functions as F

from insight.llm import mixing
from tests.llm.helpers import DOC_SCHEMA, no_docs, odd_docs


def waterfill(sizes, n_weights=3, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % n_weights for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: cap * sizes[s] for s in over}
        free -= over
    return target


def docs(spark, seed, n=400):
    rnd = random.Random(seed)
    rows = [(i, "w " * rnd.choice([0, 1, 3, 10, 60]), "en", rnd.choice(["a"] * 30 + ["b", "c", "d", "e", None]), 0) for i in range(n)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def test_targets_and_takes(spark):
    for seed in (1, 2):
        rows = [r.asDict() for r in mixing.plan(docs(spark, seed)).collect()]
        sizes = {}
        for r in rows:
            sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        want = waterfill(sizes)
        taken = dict.fromkeys(sizes, 0)
        for r in rows:
            assert abs(r["target"] - want[r["source"]]) < 1e-6 and 0 <= r["epochs"] <= 3
            taken[r["source"]] += r["size"] * r["epochs"]
        assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
        assert sum(taken.values()) <= sum(sizes.values())


def test_small_buckets_give_the_same_plan(spark, monkeypatch):
    """The prefix sums and the search for the cut, over many buckets and rounds."""
    d = docs(spark, 3)
    want = sorted(map(tuple, mixing.plan(d).select("doc_id", "epochs").collect()))
    monkeypatch.setattr(mixing, "BUCKET", 7)
    monkeypatch.setattr(mixing, "SLOTS", 5)
    assert sorted(map(tuple, mixing.plan(d).select("doc_id", "epochs").collect())) == want


def test_mix_repeats_rows_and_keeps_columns(spark):
    d = docs(spark, 4).withColumns({"epoch": F.lit(1), "epochs": F.lit(2), "size": F.lit(3)})
    got = mixing.mix(d)
    assert got.columns == d.columns
    want = {r.doc_id: r.epochs for r in mixing.plan(d).collect() if r.epochs}
    assert {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()} == want


def test_odd_rows_and_no_rows(spark):
    got = mixing.plan(odd_docs(spark, clashing=True)).collect()
    assert len(got) == 10 and all(r.epochs == 0 for r in got if r.size == 0)
    assert mixing.plan(no_docs(spark)).collect() == [] and mixing.mix(no_docs(spark)).collect() == []
