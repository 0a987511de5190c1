"""Helpers shared by the training-data operators.

Text rule used everywhere: a null text is the empty text. Words are maximal
runs of bytes other than space and ``\\t\\n\\v\\f\\r``; on UTF-8 bytes that is
exactly what ``bytes.split()`` returns, because those six bytes never occur
inside a multi-byte character.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import insight
from insight.session import ensure_checkpoint_dir

#: Fixed value of the contracts: the characters that part words.
WORD = r"[^\x20\x09-\x0D]+"
#: Longest part of one text that is split into words at once, so that a huge text needs little memory.
PART_BYTES = 4 << 20
WHITE = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after making sure that a local session's Python workers find this package.

    On a cluster the package is installed or passed with ``--py-files``; in
    local mode the workers share this machine's files, but not ``sys.path``.
    """
    sc = df.sparkSession.sparkContext
    root = str(Path(insight.__file__).resolve().parent.parent)
    if sc.master.startswith("local") and root not in sc.environment.get("PYTHONPATH", "").split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, sc.environment.get("PYTHONPATH")]))
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs a re-read of that table, not a
    re-run of what made it, and two consumers see the same rows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/insight-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it returns a dict of output columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch))
    return shipped(df).mapInArrow(run, schema)


def utf8(value: str | None) -> bytes:
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def word_count(text) -> F.Column:
    """Number of words of a text column (null: 0), inside the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts(data: bytes, most: int = PART_BYTES) -> Iterator[bytes]:
    """A text in parts cut at white space; a longer word stays whole."""
    at = 0
    while len(data) - at > most:
        cut = WHITE.search(data, at + most)
        if not cut:
            break
        yield data[at:cut.start()]
        at = cut.end()
    yield data[at:]


def row_keys(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """``docs`` with a long column, named apart from the others, that no two rows share, and its name.

    A row whose id is no other row's keeps it; rows with a null or repeated id get keys above all ids. Only where there
    are such rows are the documents written, so that the keys do not change. Ids are below 2**62.
    """
    name = "row_key"
    while name in docs.columns:
        name += "_"
    key = F.col(id_col).cast("long")
    again = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(id_col).isNull())
    if again.isEmpty():
        return docs.withColumn(name, key), name
    most = docs.agg(F.max(key)).first()[0] or 0
    if most >= 1 << 62:
        raise ValueError("ids are 2**62 or more and not unique")
    again = again.select(F.col(id_col).alias(name + "again"))
    rows = docs.join(again, docs[id_col].eqNullSafe(again[name + "again"]), "left")
    null_or_again = docs[id_col].isNull() | F.col(name + "again").isNotNull()
    fresh = F.lit(max(most, 0) + 1) + F.monotonically_increasing_id()
    return written(rows.withColumn(name, F.when(null_or_again, fresh).otherwise(key)).drop(name + "again"), "row-keys"), name
