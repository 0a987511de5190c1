import time
import tracemalloc

from pyspark.sql import functions as F

from insight.llm import quality
from insight.llm.common import parts
from tests.llm.helpers import no_docs, odd_docs, words


def brute(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hot = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), dup, len(hot))


def test_measurements_equal_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: brute(r.text) for r in rows.filter(F.length("text") < 6000).collect()}
    got = {r.doc_id: tuple(r[m] for m in quality.MEASURES) for r in quality.ledger(rows).collect()}
    assert all(got[i] == v for i, v in want.items()) and len(want) > 100


def test_edges_of_measurements():
    for text in ("a b c a b c", "x x x x", "a\nb\na\n\n \nb", "日本 # #", "\x1c a\x85b", "one\r\ntwo\r\none", None, ""):
        assert quality.measure_text(text) == brute(text), text


def test_long_texts_give_the_same_measurements(monkeypatch):
    """The form for long texts, its parts cut small, equals brute force and the form for short ones."""
    texts = ("a b c a b c", "x x x x", "a\nb\na\n\n \nb", "日本 # #", "\x1c a\x85b", "one\r\ntwo\r\none", "a", "a b", " ", "\n\n",
             "the cat sat on the mat and the cat sat\n" * 9 + "end | <of> it\n", "é" * 40 + " " + "é" * 40)
    short = [quality.measure_text(t) for t in texts]
    monkeypatch.setattr(quality, "WHOLE_BYTES", 0)
    monkeypatch.setattr(quality, "parts", lambda data: parts(data, 7))
    assert [quality.measure_text(t) for t in texts] == short == [brute(t) for t in texts]


def test_a_text_of_ten_megabytes_needs_bounded_memory():
    """Distinct short words and one-word lines: peak memory below 14 bytes a byte, within seconds."""
    text = "\n".join(format(i, "x") for i in range(1_600_000))
    tracemalloc.start()
    begun = time.time()
    got = quality.measure_text(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] == got[3] == 1_600_000 and got[4:] == (0, 0)
    assert peak < 14 * len(text) and time.time() - begun < 60


def test_odd_rows_and_no_rows(spark):
    got = quality.ledger(odd_docs(spark, clashing=True)).collect()
    assert len(got) == 10
    null = next(r for r in got if r.doc_id == 1)
    assert (null.n_words, null.word_chars, null.fail_bits & 1) == (0, 0, 1)
    assert quality.ledger(no_docs(spark)).collect() == []


def test_filter_keeps_columns_and_agrees_with_the_ledger(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("ledger", F.lit(1))
    kept = quality.filter_documents(docs, "v1")
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality.ledger(docs).filter(quality.passes("v1")).collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_labelled_clean_documents_stay(spark):
    """Labelled good documents fail no rule but the contract's base rules; labelled junk goes."""
    sf = "/root/testdata/sf0.1"
    rows = quality.ledger(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    said = rows.groupBy("quality", quality.passes("base").alias("base"), quality.passes("v1").alias("kept")).count().collect()
    n = {(r.quality, r.base, r.kept): r["count"] for r in said}
    assert n.get((1, True, False), 0) <= 0.005 * n[(1, True, True)]
    assert n.get((0, True, True), 0) <= 0.02 * sum(v for k, v in n.items() if k[0] == 0)


def test_ablations_equal_recounting(spark):
    ledger = quality.ledger(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    bits = [r.fail_bits for r in ledger.collect()]
    m = quality.mask("v1")
    got = {r.rule: (r.failed, r.failed_only_this, r.kept_without) for r in quality.ablations(ledger, "v1").collect()}
    for rule in quality.POLICIES["v1"]:
        b = 1 << quality.RULE_NAMES.index(rule)
        assert got[rule] == (sum(x & b > 0 for x in bits), sum(x & m == b for x in bits), sum(x & m & ~b == 0 for x in bits))
