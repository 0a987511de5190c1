"""Token counts of whole texts; huge texts by overlapping chunks that are spliced.

A text longer than ``CHUNK`` code points is cut into chunks that overlap by
``OVERLAP`` on each side. The chunks go to tasks of their own and are encoded
with offsets. Two neighbours are spliced at a place that both give as a token
boundary, around which both have the same boundaries, and which is proven
stable: a single space between a visible ASCII character and an ASCII letter.
No pattern of words, no merge and no normaliser of the supported kinds (word
BPE, byte-level BPE, sentencepiece with white space splitting) reaches across
it, so what stands left of it cannot change the tokens right of it. A text
with a seam that has no such place is tried again with chunks and overlaps
``WIDEN`` times as long, in the end as a whole: every text gets its exact count.

Shorter texts are encoded as they are. Where a tokenizer's words part at ASCII
white space (``word_parted``), the count of a word is remembered per worker in a
table of bounded size, as the same words come again and again.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows
each give a row; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from insight.llm.common import shipped, utf8, written
from insight.llm.tokens import tokens

CHUNK = 65_536
OVERLAP = 512
WIDEN = 8
#: Code points on each side of a seam in which both encodings must agree.
AGREE = 48
#: Remembered words of one Python worker (about 150 bytes each).
MEMO = 800_000


def seams(text: str, ends: np.ndarray, starts: np.ndarray, lo: int, hi: int, base: int) -> list[dict]:
    """Places of ``text[lo:hi]`` where it may be spliced: place, tokens before it, print of the boundaries around."""
    found = []
    at = text.find(" ", max(lo, 1), hi)
    while at >= 0:
        left, right = text[at - 1], text[at + 1:at + 2]
        if "!" <= left <= "~" and right.isascii() and right.isalpha():
            before = int(np.searchsorted(ends, at, "right"))
            if before == len(starts) or starts[before] >= at:
                a, b = np.searchsorted(ends, at - AGREE, "left"), np.searchsorted(starts, at + AGREE, "right")
                near = np.concatenate([ends[a:before], starts[before:b]]) - at
                found.append({"at": base + at, "before": before, "print": zlib.crc32(near.astype("<i4").tobytes())})
        at = text.find(" ", at + 1, hi)
    return found


SEAM = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64()), ("print", pa.int64())]))
SEAM_SQL = "array<struct<at:bigint,before:bigint,print:bigint>>"


def cut_up(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(doc_id, key, text) -> (doc_id, key, chunk, chunks, begin, text): chunks with their overlaps."""
    id_type = rows.dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                text = batch.column(2)[r].as_py()
                n = max(1, -(-len(text) // chunk))
                for i in range(n):
                    begin = max(0, i * chunk - overlap)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": batch.column(0).slice(r, 1), "key": batch.column(1).slice(r, 1),
                        "chunk": pa.array([i], pa.int64()), "chunks": pa.array([n], pa.int64()),
                        "begin": pa.array([begin], pa.int64()),
                        "text": pa.array([text[begin:(i + 1) * chunk + overlap] if i < n - 1 else text[begin:]], pa.string())})

    return rows.mapInArrow(run, f"doc_id {id_type}, key bigint, chunk bigint, chunks bigint, begin bigint, text string")


def encode_chunks(chunks: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Encode chunks with offsets; per chunk its tokens and the places of its two seams."""
    id_type = chunks.dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens(path)
        for batch in batches:
            n, left, right = [], [], []
            for i, last, begin, text in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5))):
                offsets = np.array(tok.offsets(text), np.int64).reshape(-1, 2)
                starts, ends = offsets[:, 0], offsets[:, 1]
                n.append(len(offsets))
                places = [seams(text, ends, starts, max(0, s - overlap + AGREE) - begin, s + overlap - AGREE - begin, begin)
                          for s in (i * chunk, (i + 1) * chunk)]
                left.append(places[0] if i else [])
                right.append(places[1] if i < last - 1 else [])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "key": batch.column(1), "chunk": batch.column(2), "chunks": batch.column(3),
                "n": pa.array(n, pa.int64()), "left": pa.array(left, SEAM), "right": pa.array(right, SEAM)})

    return chunks.mapInArrow(run, f"doc_id {id_type}, key bigint, chunk bigint, chunks bigint, n bigint, left {SEAM_SQL}, right {SEAM_SQL}")


def splice(encoded: DataFrame) -> DataFrame:
    """(doc_id, key, n_tokens): null where a seam has no common stable place."""
    order = W.partitionBy("doc_id", "key").orderBy("chunk")
    nxt = F.lead("left").over(order)

    def place(a):
        return F.transform(a, lambda x: F.struct(x["at"], x["print"]))

    def before(a, at):
        return F.get(F.filter(a, lambda x: x["at"] == at), F.lit(0))["before"]

    rows = encoded.withColumn("next_left", nxt)
    common = F.array_intersect(place(F.col("right")), place(F.col("next_left")))
    middle = F.get(common, F.floor(F.size(common) / 2).cast("int"))["at"]
    rows = rows.withColumn("seam", middle)
    rows = rows.withColumn("prev_seam", F.lag("seam").over(order))
    last = F.col("chunk") == F.col("chunks") - 1
    upto = F.when(last, F.col("n")).otherwise(before(F.col("right"), F.col("seam")))
    since = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(before(F.col("left"), F.col("prev_seam")))
    rows = rows.withColumn("own", upto - since)
    return rows.groupBy("doc_id", "key").agg(
        F.when(F.count("own") == F.count(F.lit(1)), F.sum("own")).alias("n_tokens"))


def count_long(rows: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, key, text) of huge texts -> (doc_id, key, n_tokens)."""
    rows = rows.dropDuplicates(["doc_id", "key"])
    todo, done = rows, []
    while True:
        pieces = cut_up(todo, chunk, overlap).repartition("doc_id", "key", "chunk")
        got = written(splice(encode_chunks(pieces, path, chunk, overlap)), "spliced")
        done.append(got.filter("n_tokens is not null"))
        left = got.filter("n_tokens is null").select("doc_id", "key")
        if left.isEmpty():
            break
        todo = rows.join(left.select(F.col("doc_id").alias("l_id"), F.col("key").alias("l_key")),
                         F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("key") == F.col("l_key")), "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class WordCounter:
    """Token counts of texts as sums over their words, with a table of bounded size."""

    def __init__(self, path: str) -> None:
        self.tok = tokens(path)
        self.known: dict[bytes, int] = {}

    def __call__(self, texts: list[bytes]) -> list[int]:
        if len(self.known) > MEMO:
            self.known = {}
        split = [t.split() for t in texts]
        got = [list(map(self.known.get, words)) for words in split]
        new = list({w for words, ns in zip(split, got) if None in ns for w, n in zip(words, ns) if n is None})
        fresh = dict(zip(new, self.tok.counts([w.decode("utf-8", "surrogatepass") for w in new])))
        self.known.update(fresh)
        return [sum(fresh[w] if n is None else n for w, n in zip(words, ns)) if None in ns else sum(ns)
                for words, ns in zip(split, got)]


@cache
def word_counter(path: str) -> WordCounter:
    """One per Python worker, as its tasks meet the same words."""
    return WordCounter(path)


def token_counts(docs: DataFrame, path: str, word_parted: bool, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row."""
    rows = shipped(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.dtypes[0][1]
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = word_counter(path) if word_parted else None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(2).to_pylist()
                n = count([utf8(t) for t in texts]) if count else tokens(path).counts(texts)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "n_bytes": part.column(1), "n_tokens": pa.array(n, pa.int64())})

    is_long = F.length("text") > chunk
    short = rows.filter(~is_long).select("doc_id", "n_bytes", "text").mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    keyed = rows.filter(is_long).withColumn("key", F.xxhash64("text"))
    spliced = count_long(keyed.select("doc_id", "key", "text"), path, chunk, overlap)
    ids = keyed.select(F.col("doc_id").alias("k_id"), F.col("key").alias("k_key"), "n_bytes")
    long = ids.join(spliced, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("key") == F.col("k_key")))
    return short.unionByName(long.select(F.col("k_id").alias("doc_id"), "n_bytes", "n_tokens"))
