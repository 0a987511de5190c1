"""Exact top-k search by tiled matrix products.

Vectors are packed into matrices: shards of ``SHARD_BYTES`` of candidates, tiles
of ``QUERY_BYTES`` of queries. A shard is dealt to one of ``slots`` slots and every
query tile to all slots, so each pair of shard and tile meets exactly once, in
an equi-join on the slot (a stated query set against all rows, in blocks). A
task multiplies tile by shard, keeps the best k of each query, and merges them
over the shards that follow with the same tile; windows merge the tops of the
slots, k rows per query and task first, then per query.

Scores are exact: components are integers, a product is done in floating point
only where every partial sum stays below 2**53, else in Python's integers.
Scores beyond the range of a long are ranked exactly and written as its end.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part, neither as query nor candidate; vectors of another
length than the query's are no candidates of it; ties go to the smaller id;
rows that repeat an id are candidates each, but none of the query's own id; a
query id that repeats is asked once, with the vector that sorts first. An
empty table gives no rows. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from insight.llm.common import shipped

#: Bytes of a shard's and a query tile's matrix; their score matrix is cut by these, too.
SHARD_BYTES = 4 << 20
QUERY_BYTES = 512 << 10
LONG = (1 << 63) - 1
PACK_SCHEMA = "dim int, ids binary, matrix binary"


def quantised(vectors: DataFrame, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component as double, whole usable vectors only."""
    x = F.transform(F.col(vec_col).cast("array<double>"), lambda e: F.lit(float(scale)) * e)
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    rows = vectors.filter(F.col(id_col).isNotNull()).filter(usable)
    whole = F.transform(x, lambda e: F.when(F.abs(e) < F.lit(2.0 ** 53), F.floor(e).cast("double")).otherwise(e))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def packed(rows: DataFrame, n_bytes: int) -> DataFrame:
    """Rows as matrices of about ``n_bytes`` with vectors of one length (row order: as read)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, vectors = zip(*held.pop(dim))
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                "matrix": pa.array([np.array(vectors, "<f8").tobytes()], pa.binary())})

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = np.asarray(vector.values)
                held.setdefault(len(v), []).append((vec_id, v))
                if len(held[len(v)]) * v.nbytes >= n_bytes:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    return shipped(rows).select("vec_id", "v").mapInArrow(run, PACK_SCHEMA)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products, as floats where floats are exact, else as Python integers."""
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * queries.shape[1]
    if bound < 2.0 ** 53:
        return queries @ shard.T
    big = [[int(x) for x in row] for row in shard]
    return np.array([[sum(int(a) * b for a, b in zip(q, row)) for row in big] for q in queries], object).reshape(len(queries), len(shard))


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple]:
    """The k best (score, id) of one query, ties to the smaller id, its own id left out."""
    keep = np.flatnonzero(ids != own)
    s = scores[keep]
    if len(s) > k:
        edge = np.partition(s, len(s) - k)[len(s) - k] if s.dtype != object else sorted(s)[-k]
        near = np.flatnonzero(s >= edge)
        keep, s = keep[near], s[near]
    return sorted(zip(s.tolist(), ids[keep].tolist()), key=lambda p: (-p[0], p[1]))[:k]


def search(queries: DataFrame, base: DataFrame, k: int, slots: int,
           shard_bytes: int = SHARD_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query. Inputs as of ``quantised``."""
    one = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    tiles = packed(one, query_bytes).select(
        F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"),
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("q_slot"))
    shards = packed(base, shard_bytes).withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int"))
    pairs = tiles.join(shards, (F.col("slot") == F.col("q_slot")) & (F.col("dim") == F.col("q_dim")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, tops = None, []

        def out() -> Iterator[pa.RecordBatch]:
            found = [(int(q), s, i) for q, top in zip(np.frombuffer(tile, "<i8") if tile else (), tops) for s, i in top]
            if found:
                q, s, i = zip(*found)
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()),
                    "score": pa.array([max(-LONG - 1, min(LONG, int(x))) for x in s], pa.int64()),
                    "exact": pa.array([f"{int(x) + (1 << 2200):0700d}" if abs(x) > LONG else None for x in s], pa.string())})

        for batch in batches:
            for dim, q_ids, q_matrix, ids, matrix in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if q_ids != tile:
                    yield from out()
                    tile, tops = q_ids, []
                asked, known = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                scores = products(np.frombuffer(q_matrix, "<f8").reshape(-1, dim), np.frombuffer(matrix, "<f8").reshape(-1, dim))
                new = [best(row, known, own, k) for row, own in zip(scores, asked)]
                tops = [sorted(a + b, key=lambda p: (-p[0], p[1]))[:k] for a, b in zip(tops, new)] if tops else new
        yield from out()

    tops = pairs.select("dim", "q_ids", "q_matrix", "ids", "matrix").mapInArrow(
        run, "query_id bigint, vec_id bigint, score bigint, exact string")
    return merged(tops, k)


def order() -> list[Column]:
    """Best first. ``exact`` orders scores beyond a long: their value, shifted to be positive, in fixed width."""
    return [F.col("score").desc(), F.col("exact").desc_nulls_last(), F.col("vec_id").asc()]


def merged(tops: DataFrame, k: int) -> DataFrame:
    """Tree merge of top lists: a window with a rank limit is cut to k per task before its shuffle and after it."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(*order()))
    return tops.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
