"""From raw documents to encoded training text: five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that go
on, with the columns it was given; the last returns ids, token counts and
digests. ``run`` writes each stage's result to the shared checkpoint folder and
reads it again, so a lost executor costs a re-read and no stage is run twice.

Defined cases: null and empty texts fail the first stage; rows whose id is null or
repeated are documents of their own in the second and fourth stage, so different
texts under one id both stay and equal ones leave one; null sources
are mixed as a source of their own; an empty table passes as an empty table;
extra columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.llm import bpe, mixing, near_dup, quality, secrets
from insight.llm.common import row_keys, table, written
from insight.llm.tokens import public


#: Text bytes of a block of the last stage: half of the operator's, as its workers also hold what earlier stages loaded.
BLOCK_BYTES = 16 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v1 of the rule ledger accepts."""
    return quality.filter_documents(docs, "v1")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates (5-word shingles, similarity 0.8 or more)."""
    keyed, key = row_keys(docs)
    found = near_dup.near_duplicates(keyed, width=5, id_col=key)
    stay = found.filter("kept").select(F.col("doc_id").alias("stay_id"))
    return keyed.join(stay, keyed[key] == stay["stay_id"], "left_semi").drop(key)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: documents as often as they are taken."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every row of the mix."""
    return bpe.encode(docs, public("word_bpe_49k.json"), digest=True, block_bytes=BLOCK_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

#: Near-duplicates and tokens cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
