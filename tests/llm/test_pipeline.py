import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from insight.llm import mixing, near_dup, quality, secrets
from insight.llm.tokens import public
from tests.llm.helpers import brute_components, no_docs, odd_docs, sha

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_rules"](spark, docs, SF)
    assert good.columns == docs.columns
    rows = {r.doc_id: r for r in good.collect()}
    assert set(rows) == {r.doc_id for r in quality.ledger(docs).filter(quality.passes("v1")).collect()}
    one = stage["near_dedup"](spark, good, SF)
    assert one.columns == docs.columns
    comp = brute_components([(i, r.text) for i, r in rows.items()], 5)
    assert {r.doc_id for r in one.collect()} == {i for i, (_, c) in comp.items() if c == i}
    clean = stage["secret_scan"](spark, one, SF)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert r.text == secrets.redacted(rows[r.doc_id].text) and r.n_chars == len(r.text)
        assert not [s for s in secrets.scanner().text_spans(r.text) if s[2] < 3]
    mixed = stage["mix_sources"](spark, clean, SF)
    assert mixed.columns == docs.columns
    want = {r.doc_id: r.epochs for r in mixing.plan(clean).collect() if r.epochs}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want
    tok = Tokenizer.from_file(public("word_bpe_49k.json"))
    texts = {r.doc_id: tok.encode(r.text, add_special_tokens=False).ids for r in clean.collect()}
    out = stage["bpe_encode"](spark, mixed, SF).collect()
    assert len(out) == sum(want.values())
    assert all(r.ids_sha256 == sha(" ".join(map(str, texts[r.doc_id]))) for r in out)


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 50 and "ids_sha256" in got.columns


def test_stages_with_odd_rows_and_no_rows(spark):
    for docs in (odd_docs(spark, clashing=True), no_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
    one = dict(corpus_pipeline.STAGES)["near_dedup"](spark, odd_docs(spark), SF)
    assert one.filter("doc_id = 6").count() == 0 and one.filter(F.col("doc_id").isNull()).count() == 1
    assert near_dup.near_duplicates(one, 5).filter("not kept").count() == 0


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    """Different texts under one id or none all stay; equal ones leave one."""
    a, b, c = ("a text about rivers and the many towns that lie on them", "another one of quite different words which tells of hills",
               "third words here again nothing that was said before at all")
    rows = [(1, a), (1, b), (1, b), (None, c), (None, c), (None, a + " " + b), (2, c), (3, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x") for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)
    one = stage["near_dedup"](spark, docs, SF)
    assert one.columns == docs.columns
    assert sorted(r.text for r in one.collect()) == sorted([a, b, c, a + " " + b])
    assert {(r.doc_id, r.text) for r in one.collect()} >= {(1, b), (2, c), (3, a)}
    mixed = stage["mix_sources"](spark, docs, SF)
    assert mixed.columns == docs.columns and sorted(r.text for r in mixed.collect()) == sorted(t for _, t in rows)
