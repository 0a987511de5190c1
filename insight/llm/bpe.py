"""BPE encoding through a distinct-word table, and decoding through an id-to-piece join.

For tokenizers whose words part at ASCII white space (normaliser, word pattern
and added tokens never reach across it), a text's ids are its words' ids in
order. The work is done in three steps:

1. ``block_words`` and ``block_codes``: texts are split in blocks of about
   ``BLOCK_BYTES``. A block has a table of distinct words (most frequent first,
   one row per hash bucket) and one row of word codes, which are places in that
   table. The two are made by two passes over the same texts, as keeping the
   codes on disk between them would cost more than splitting again; a block's
   key is a hash of its content, so blocks that differ could only miss each
   other, which ``join_back`` reports as an error.
2. ``encode_buckets``: rows of a bucket meet in one task, which encodes each
   distinct word once. A word that is a third of all words comes once per block.
3. ``join_back``: each block's codes meet its words' ids, joined by position,
   and the ids meet their pieces in the id-to-piece table.

Buckets grow with the input, blocks are bounded in bytes (a longer text is cut
at white space while it is split). Nothing passes through the driver. The
texts must come in the same order in both passes, as from any table.

Defined cases: a null or empty text has no ids and decodes to the empty
string; a word without tokens adds nothing; repeated rows each give a row; an
empty table gives no rows. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from insight.llm.common import parts, shipped, utf8
from insight.llm.tokens import tokens

#: Text bytes of a block; a block's rows meet in one task.
BLOCK_BYTES = 32 << 20


def pack(codes: np.ndarray) -> bytes:
    """Byte planes of 32-bit codes, compressed."""
    return zstandard.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    """Codes of ``pack``, writable by nobody."""
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Block:
    """Words of the texts gathered so far, as codes into a table of distinct words."""

    def __init__(self) -> None:
        self.code = defaultdict(count().__next__)
        self.ids: list = []
        self.lengths: list[int] = []
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, data: bytes) -> None:
        n = 0
        for part in parts(data):
            words = part.split()
            self.codes.append(np.fromiter(map(self.code.__getitem__, words), np.uint32, len(words)))
            n += len(words)
        self.ids.append(doc_id)
        self.lengths.append(n)
        self.size += len(data)

    def ranked(self) -> tuple[str, np.ndarray, np.ndarray]:
        """Key of the block, its codes with the most frequent word as 0, and each first code's rank."""
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint32)
        order = np.argsort(-np.bincount(codes, minlength=len(self.code)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        key = xxhash.xxh3_128(b" ".join(self.code))
        key.update(codes.tobytes())
        return key.hexdigest(), rank[codes] if len(codes) else codes, rank

    def words(self, n_buckets: int) -> Iterator[dict]:
        key, _, rank = self.ranked()
        by_bucket: dict[int, list] = defaultdict(list)
        for word, code in self.code.items():
            by_bucket[zlib.crc32(word) % n_buckets].append((rank[code], word))
        for bucket, found in by_bucket.items():
            found.sort()
            yield {"block": key, "bucket": bucket, "codes": pack(np.array([c for c, _ in found], np.uint32)),
                   "words": zstandard.compress(b" ".join(w for _, w in found), 3)}

    def documents(self) -> Iterator[dict]:
        key, codes, _ = self.ranked()
        yield {"block": key, "doc_ids": self.ids, "lengths": self.lengths, "n_words": len(self.code), "codes": pack(codes)}


def _blocks(docs: DataFrame, block_bytes: int, rows: Callable[[Block], Iterator[dict]], schema: str) -> DataFrame:
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, utf8(text.as_py()))
                if block.size >= block_bytes:
                    yield pa.RecordBatch.from_pylist(list(rows(block)), arrow)
                    block = Block()
        if block.ids:
            yield pa.RecordBatch.from_pylist(list(rows(block)), arrow)

    return shipped(docs).mapInArrow(run, schema)


def block_words(docs: DataFrame, n_buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Step 1, per block and bucket: the bucket's words and their codes. ``docs`` is (id, text)."""
    return _blocks(docs, block_bytes, lambda b: b.words(n_buckets), "block string, bucket int, codes binary, words binary")


def block_codes(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Step 1, per block: ids, word counts and word codes of its documents."""
    return _blocks(docs, block_bytes, Block.documents,
                   f"block string, doc_ids array<{docs.dtypes[0][1]}>, lengths array<bigint>, n_words bigint, codes binary")


def encode_buckets(words: DataFrame, n_buckets: int, path: str) -> DataFrame:
    """Step 2. Per block and bucket: codes, and for each its token count and ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens(path)
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for block, codes, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = zstandard.decompress(packed).split()
                new = [w for w in found if w not in known]
                known.update(zip(new, tok.ids([w.decode("utf-8", "surrogatepass") for w in new])))
                ids = [known[w] for w in found]
                yield pa.RecordBatch.from_pydict({
                    "block": [block], "codes": pa.array([codes], pa.binary()),
                    "n_tokens": pa.array([pack(np.fromiter(map(len, ids), np.uint32, len(ids)))], pa.binary()),
                    "ids": pa.array([pack(np.array([i for x in ids for i in x], np.uint32))], pa.binary())})

    dealt = words.repartition(n_buckets, "bucket").select("block", "codes", "words")
    return dealt.mapInArrow(run, "block string, codes binary, n_tokens binary, ids binary")


def join_back(blocks: DataFrame, words: DataFrame, path: str, digest: bool) -> DataFrame:
    """Step 3. One row per document: its ids and decoded text, or their digests."""
    id_type = dict(blocks.dtypes)["doc_ids"][len("array<"):-1]
    names = ("ids_sha256 string", "decoded_sha256 string") if digest else ("ids array<int>", "decoded string")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        n_words = int(left["n_words"].max()) if len(left) else -1
        if sum(len(unpack(c)) for c in right["codes"]) < n_words or not len(left):
            raise RuntimeError("the texts came in another order in the second pass; write them to a table first")
        piece = np.array(tokens(path).pieces(), object)
        decimal = np.array([str(i) for i in range(len(piece))], object)
        n_of, ids_of, pieces_of = np.zeros(n_words, np.int64), np.empty(n_words, object), np.empty(n_words, object)
        for codes, n, ids in zip(right["codes"], right["n_tokens"], right["ids"]):
            codes, n, ids = unpack(codes), unpack(n), unpack(ids)
            n_of[codes] = n
            ends = np.cumsum(n, dtype=np.int64)
            for table, out in ((decimal, ids_of), (piece, pieces_of)):
                found = table[ids].tolist()
                out[codes] = [" ".join(found[a:b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
        rows = []
        for block in left.itertuples(index=False):
            every, at = unpack(block.codes), 0
            for doc_id, length in zip(block.doc_ids, block.lengths):
                mine = every[at:at + length]
                at += length
                mine = mine[n_of[mine] > 0]
                ids, text = " ".join(ids_of[mine].tolist()), " ".join(pieces_of[mine].tolist())
                made = (sha256(ids), sha256(text)) if digest else ([int(i) for i in ids.split()], text)
                rows.append((doc_id, int(n_of[mine].sum()), *made))
        return pd.DataFrame(rows, columns=["doc_id", "n_tokens", *(n.split()[0] for n in names)])

    return (blocks.groupBy("block").cogroup(words.groupBy("block"))
            .applyInPandas(run, f"doc_id {id_type}, n_tokens bigint, {', '.join(names)}"))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode(docs: DataFrame, path: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Encode and decode every text: (doc_id, n_tokens, ids, decoded), or digests of the last two."""
    two = docs.select(F.col(id_col), F.col(text_col))
    n_buckets = math.ceil(8 * max(1, two.rdd.getNumPartitions()) ** 0.75)
    words = encode_buckets(block_words(two, n_buckets, block_bytes), n_buckets, path)
    return join_back(block_codes(two, block_bytes), words, path, digest)


def piece_table(spark, path: str) -> DataFrame:
    """(id, piece) of a tokenizer's vocabulary: bounded by its size."""
    return spark.createDataFrame(list(enumerate(tokens(path).pieces())), "id int, piece string")


def decode(encoded: DataFrame, pieces: DataFrame) -> DataFrame:
    """Decode any (doc_id, ids array<int>): ids joined to their pieces by position.

    The piece table is bounded by the vocabulary and may be broadcast. Null or
    empty ids decode to the empty string; rows are told apart by id, so equal
    rows are decoded once.
    """
    each = encoded.select("doc_id", F.posexplode_outer("ids").alias("pos", "id")).distinct()
    joined = each.join(F.broadcast(pieces), "id", "left")
    return joined.groupBy("doc_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "piece")))), lambda x: x["piece"]), " ").alias("decoded"))
