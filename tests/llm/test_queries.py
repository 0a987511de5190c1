import pytest

import __spark_entry__
from insight.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline_are_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    status, n, _, msg = compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert status == "OK" and n > 0, msg


@pytest.mark.parametrize("name, column", [("op1_minhash_dedup", "doc_id"), ("op4_secret_scan", "doc_id"), ("op5_bpe_roundtrip", "doc_id"),
                                          ("op6_token_counts", "doc_id"), ("op8_license_scan", "doc_id"), ("op10_html_text", "page_id")])
def test_one_row_per_input_row(spark, name, column):
    table = "pages" if column == "page_id" else "documents"
    want = sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(column).collect())
    assert sorted(r[column] for r in QUERIES[name](spark, SF).select(column).collect()) == want
