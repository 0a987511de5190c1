import random

import pytest

from insight.llm import near_dup
from tests.llm.helpers import brute_components, no_docs, odd_docs

SF = "/root/testdata/sf0.001"


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force_on_documents(spark, width):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(near_dup.near_duplicates(docs, width)) == brute_components(rows, width)


@pytest.mark.parametrize("tile", [256, 7])
def test_group_of_near_copies_with_weak_hubs(spark, monkeypatch, tile):
    """Copies edited in several places: many pairs are not similar, yet all links must be kept."""
    monkeypatch.setattr(near_dup, "TILE_NODES", tile)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(3000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        copy = base[:]
        for _ in range(rnd.randrange(0, 9)):
            copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(f"w{rnd.randrange(3000)}" for _ in range(100))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(near_dup.near_duplicates(docs, 2)) == brute_components(rows, 2)


def test_odd_rows(spark):
    got = near_dup.near_duplicates(odd_docs(spark, clashing=True), 2).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 10
    assert [(by[i].n_shingles, by[i].component_id, by[i].kept) for i in (1, 2, 3)] == [(0, i, True) for i in (1, 2, 3)]
    assert (by[5].component_id, by[5].kept) == (5, True)
    assert [(r.component_id, r.kept) for r in got if r.doc_id == 6] == [(5, False)] * 2
    assert (by[None].component_id, by[None].kept) == (None, True)
    assert by[7].n_shingles == 1


def test_no_rows(spark):
    assert near_dup.near_duplicates(no_docs(spark), 5).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    def b(i):
        return i.to_bytes(16, "big")
    links = [(b(i), b(i + 1)) for i in range(1, 40)] + [(b(100), b(100 + i)) for i in range(1, 30)]
    got = near_dup.labels_of(near_dup.components(spark.createDataFrame(links, "a binary, b binary"))).collect()
    assert {bytes(r.node): bytes(r.comp) for r in got} == ({b(i): b(1) for i in range(1, 41)} | {b(100 + i): b(100) for i in range(30)})


def test_signature_agreement_bound():
    """At similarity 0.8 a pair falls short of MATCHES agreeing coordinates less than once in 100,000."""
    from math import comb
    k, m = near_dup.COORDINATES, near_dup.MATCHES
    assert sum(comb(k, i) * 0.8 ** i * 0.2 ** (k - i) for i in range(m)) < 1e-5
