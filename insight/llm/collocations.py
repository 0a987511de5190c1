"""Phrase collocation mining: n-gram counts by HAT-tries, sorted runs, one merge per prefix partition.

A task counts the contiguous word sequences of its texts in one trie per
language. The trie is shallow: its nodes part keys by word id, its leaves are
hash containers that take keys of a range of ids. A container that grows past
``BURST`` keys bursts into containers of narrower ranges, and where one word
fills it, into a node one word deeper. When a task holds more than ``HELD``
keys, its largest subtrees are spilled whole: as sorted runs, one per prefix
partition (the hash of a phrase's language and first two words, so that one
frequent first word does not meet in one task). Spark sends each partition's
runs to one place, where they are merged and summed; sums below ``least``
are dropped, as every part of a candidate is at least as frequent as it.

Joins that look up the counts of a candidate's parts are salted by the
candidate, so a word or pair that very many candidates hold is read by many
tasks. The best of a language are found among the best of ``TOP_SALTS`` shares.

Scores are exact: whole-number division of decimals with 38 digits, right for
counts below 10**15.

Defined cases: a null text is empty and counts nothing; a null language is
``und``; words are runs other than space and tab inside pieces that end at
``. , ; : ! ?`` and line ends, A-Z in lower case; repeated rows count each; a
language without candidates and an empty table give no rows. A text of any
length is read in parts that share their last words, so no phrase is lost at a
cut. Only the language and text columns are read.
"""

from __future__ import annotations

import io
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, repeat
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from insight.llm.common import WHITE, shipped, utf8, written

#: Keys of one hash container; keys and words held by a task before it spills.
BURST = 1 << 14
HELD = 1 << 20
WORDS = 400_000
#: Bits of a word id inside a packed key of three words (0: no word).
ID_BITS = 21
#: Bytes of text that are counted at once.
SLICE_BYTES = 1 << 20
#: Shares of the salted joins and of the search for the best of a language.
JOIN_SALTS = 8
TOP_SALTS = 16
#: Prefix partitions per shuffle partition: a task merges one after the other.
PREFIXES = 4

#: Fixed values of the contract: the characters that end a piece. 0xFF is in no UTF-8 text.
BREAK = b"\xff"
TO_WORDS = bytes(0xFF if b in b".,;:!?\x0a\x0b\x0c\x0d" else b + 32 if 65 <= b <= 90 else b for b in range(256))
RUN_SCHEMA = "bucket int, lang string, run binary"


class Node:
    """Children by ranges of keys: ``lows[i]`` is the least key of child i, a hash container or a deeper node."""

    def __init__(self, depth: int, low: int = 0) -> None:
        self.depth = depth
        self.lows: list[int] = [low]
        self.kids: list[dict[int, int] | Node] = [{}]

    def put(self, keys: np.ndarray, counts: np.ndarray) -> int:
        """Add sorted distinct keys; returns how many are new."""
        cuts = [0, *np.searchsorted(keys, self.lows[1:]).tolist(), len(keys)]
        new, burst = 0, []
        for i, kid in enumerate(self.kids):
            a, b = cuts[i], cuts[i + 1]
            if a == b:
                continue
            if isinstance(kid, Node):
                new += kid.put(keys[a:b], counts[a:b])
                continue
            before, some = len(kid), keys[a:b].tolist()
            kid.update(zip(some, map(add, map(kid.get, some, repeat(0)), counts[a:b].tolist())))
            new += len(kid) - before
            if len(kid) > BURST and self.depth < 3:
                burst.append(i)
        for i in reversed(burst):
            self._burst(i)
        return new

    def _burst(self, i: int) -> None:
        """Part a container at word ids; a word that fills one by itself gets a node of its own."""
        kid = self.kids[i]
        keys, counts = in_order(kid)
        starts = np.flatnonzero(np.diff(keys >> ID_BITS * (2 - self.depth), prepend=-1))
        ends = np.append(starts[1:], len(keys))
        lows, kids, at = [], [], 0
        for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            alone = b - a > BURST // 2
            if alone:
                low = int(keys[a]) >> ID_BITS * (2 - self.depth) << ID_BITS * (2 - self.depth)
                deeper = Node(self.depth + 1, low)
                deeper.put(keys[a:b], counts[a:b])
                lows.append(low)
                kids.append(deeper)
                at = b
            elif b == len(keys) or ends[min(k + 1, len(ends) - 1)] - at > BURST // 2:
                lows.append(int(keys[at]) >> ID_BITS * (2 - self.depth) << ID_BITS * (2 - self.depth))
                kids.append(dict(zip(keys[at:b].tolist(), counts[at:b].tolist())))
                at = b
        lows[0] = self.lows[i]
        self.lows[i:i + 1], self.kids[i:i + 1] = lows, kids

    def size(self) -> int:
        return sum(k.size() if isinstance(k, Node) else len(k) for k in self.kids)

    def items(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All keys and counts in the order of keys, container by container."""
        for kid in self.kids:
            if isinstance(kid, Node):
                yield from kid.items()
            elif kid:
                yield in_order(kid)

    def take(self, i: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Remove the whole subtree i and return its keys in order."""
        kid, self.kids[i] = self.kids[i], {}
        return list(kid.items()) if isinstance(kid, Node) else [in_order(kid)]


def in_order(container: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.fromiter(container.keys(), np.int64, len(container))
    counts = np.fromiter(container.values(), np.int64, len(container))
    order = np.argsort(keys)
    return keys[order], counts[order]


class Counter:
    """The tries of one task, and the word ids that they share."""

    def __init__(self, longest: int, buckets: int) -> None:
        if not 2 <= longest <= 3:
            raise ValueError("phrases have 2 or 3 words")
        self.longest, self.buckets = longest, buckets
        self._clear()

    def _clear(self) -> None:
        numbers = count(1)
        self.ids: dict[bytes, int] = defaultdict(lambda: next(numbers))
        self.tries: dict[str, Node] = {}
        self.held = 0

    def add(self, lang: str, texts: list[bytes], carry: np.ndarray) -> np.ndarray:
        """Count texts; ``carry`` holds the words just before the first. Returns the last words."""
        data = (b" " + BREAK + b" ").join(t.translate(TO_WORDS).replace(BREAK, b" \xff ") for t in texts)
        told = data.split()
        self.ids[BREAK] = 0
        seq = np.concatenate([carry, np.fromiter(map(self.ids.__getitem__, told), np.int64, len(told))])
        n0, keys = len(carry), []
        for k in range(1, self.longest + 1):
            span = len(seq) - k + 1
            if span <= 0:
                break
            key, whole = np.zeros(span, np.int64), np.ones(span, bool)
            for j in range(k):
                word = seq[j:j + span]
                key |= word << ID_BITS * (2 - j)
                whole &= word > 0
            whole[:max(0, n0 - k + 1)] = False  # phrases that end inside the carry are counted already
            keys.append(key[whole])
        if keys:
            found, times = np.unique(np.concatenate(keys), return_counts=True)
            if len(found):
                self.held += self.tries.setdefault(lang, Node(0)).put(found, times)
        return seq[max(0, len(seq) - self.longest + 1):]

    def full(self) -> bool:
        return self.held > HELD or len(self.ids) > WORDS

    def spill(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Runs of the largest subtrees until half is left; of all, and the words forgotten, if these are too many."""
        everything = everything or len(self.ids) > WORDS
        words = [b""] * (len(self.ids) + 1)
        for word, i in self.ids.items():
            words[i] = b"" if word == BREAK else word
        crc = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        texts = pa.array(words, pa.binary())
        if everything:
            for lang, trie in self.tries.items():
                yield from self._runs(lang, list(trie.items()), texts, crc)
            self._clear()
            return
        trees = sorted(((k.size() if isinstance(k, Node) else len(k), lang, i) for lang, t in self.tries.items()
                        for i, k in enumerate(t.kids)), reverse=True)
        gone: dict[str, list] = defaultdict(list)
        for size, lang, i in trees:
            if self.held <= HELD // 2:
                break
            gone[lang].append((i, self.tries[lang].take(i)))
            self.held -= size
        for lang, subtrees in gone.items():
            yield from self._runs(lang, [run for _, taken in sorted(subtrees, key=lambda s: s[0]) for run in taken], texts, crc)

    def _runs(self, lang: str, subtree: list, texts: pa.Array, crc: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not subtree:
            return
        keys, counts = (np.concatenate(x) for x in zip(*subtree))
        mask = (1 << ID_BITS) - 1
        first, second, third = keys >> 2 * ID_BITS, keys >> ID_BITS & mask, keys & mask
        bucket = ((crc[first] * np.uint64(31) + crc[second] + np.uint64(zlib.crc32(lang.encode()))) % np.uint64(self.buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=self.buckets))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            here = order[a:b]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([int(bucket[here[0]])], pa.int32()), "lang": pa.array([lang], pa.string()),
                "run": pa.array([packed(first[here], second[here], third[here], counts[here], texts)], pa.binary())})


def packed(first: np.ndarray, second: np.ndarray, third: np.ndarray, counts: np.ndarray, texts: pa.Array) -> bytes:
    """A run as compressed Arrow: phrases, their numbers of words, their counts."""
    one, two = second == 0, (second > 0) & (third == 0)
    phrases = texts.take(pa.array(first))
    pair = pc.binary_join_element_wise(phrases, texts.take(pa.array(second)), b" ")
    triple = pc.binary_join_element_wise(pair, texts.take(pa.array(third)), b" ")
    phrases = pc.if_else(pa.array(one), phrases, pc.if_else(pa.array(two), pair, triple))
    batch = pa.RecordBatch.from_pydict({"phrase": phrases, "words": pa.array(np.where(one, 1, np.where(two, 2, 3)).astype(np.int8)),
                                        "f": pa.array(counts)})
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue()


def runs(docs: DataFrame, longest: int, buckets: int, lang_col: str, text_col: str) -> DataFrame:
    """Sorted runs of (phrase, words, f), one row per spilled subtree, language and prefix partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, none = Counter(longest, buckets), np.zeros(0, np.int64)
        for batch in batches:
            waiting: dict[str, list[bytes]] = defaultdict(list)
            sizes: dict[str, int] = defaultdict(int)
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, data = lang.as_py(), utf8(text.as_py())
                if len(data) <= SLICE_BYTES:
                    waiting[lang].append(data)
                    sizes[lang] += len(data)
                    if sizes[lang] >= SLICE_BYTES:
                        counter.add(lang, waiting.pop(lang), none)
                        sizes[lang] = 0
                        if counter.full():
                            yield from counter.spill()
                    continue
                carry: list[bytes] = []
                for part in slices(data):
                    # ids do not outlive a spill, so the words before the cut are looked up anew
                    before = np.array([counter.ids[w] if w != BREAK else 0 for w in carry], np.int64)
                    counter.add(lang, [part], before)
                    carry = (carry + tail(part, longest - 1))[1 - longest:]
                    if counter.full():
                        yield from counter.spill()
            for lang, texts in waiting.items():
                counter.add(lang, texts, none)
                if counter.full():
                    yield from counter.spill()
        yield from counter.spill(everything=True)

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    return shipped(rows).mapInArrow(run, RUN_SCHEMA)


def slices(data: bytes) -> Iterator[bytes]:
    """A text in slices that begin with white space; a longer word stays whole."""
    at = 0
    while len(data) - at > SLICE_BYTES and (cut := WHITE.search(data, at + SLICE_BYTES)):
        yield data[at:cut.start()]
        at = cut.start()
    yield data[at:]


def tail(part: bytes, n: int) -> list[bytes]:
    """The last n words of a slice, breaks taken as words."""
    return part.translate(TO_WORDS).replace(BREAK, b" \xff ").split()[-n:]


def counts(docs: DataFrame, least: int, longest: int = 3, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, words, f) of all phrases found ``least`` times or more; phrase null, words 0: occurrences of all words."""
    spark = docs.sparkSession
    buckets = PREFIXES * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sent = runs(docs, longest, buckets, lang_col, text_col).repartition("bucket").sortWithinPartitions("bucket", "lang")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n = None, [], 0

        def summed(tables: list[pa.Table]) -> pa.Table:
            t = pa.concat_tables(tables).group_by(["phrase", "words"]).aggregate([("f", "sum")])
            return t.rename_columns(["phrase", "words", "f"])

        def out() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            t = summed(held)
            total = pc.sum(t.filter(pc.equal(t["words"], 1))["f"]).as_py() or 0
            t = t.filter(pc.greater_equal(t["f"], least))
            m = t.num_rows
            made = pa.Table.from_pydict({
                "lang": pa.array([key[1]] * (m + 1), pa.string()),
                "phrase": pa.chunked_array([*t["phrase"].cast(pa.string()).chunks, pa.array([None], pa.string())]),
                "words": pa.chunked_array([*t["words"].cast(pa.int32()).chunks, pa.array([0], pa.int32())]),
                "f": pa.chunked_array([*t["f"].cast(pa.int64()).chunks, pa.array([total], pa.int64())])})
            yield from made.combine_chunks().to_batches()

        for batch in batches:
            for bucket, lang, data in zip(*(batch.column(c) for c in range(3))):
                if (bucket.as_py(), lang.as_py()) != key:
                    yield from out()
                    key, held, n = (bucket.as_py(), lang.as_py()), [], 0
                held.append(pa.ipc.open_stream(data.as_buffer()).read_all())
                n += held[-1].num_rows
                if n > HELD:
                    held = [summed(held)]
                    n = held[0].num_rows // 2
        yield from out()

    return sent.mapInArrow(merge, "lang string, phrase string, words int, f bigint")


def looked_up(rows: DataFrame, key: str, table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Join ``table`` (lang, phrase, ...) on ``key``; rows are dealt to salts, the table is copied to each salt."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(JOIN_SALTS)).cast("int"))
    copies = table.select(F.col("lang"), F.col("phrase").alias(key), *[F.col(c).alias(to) for c, to in columns.items()],
                          F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))).alias("salt"))
    return salted.join(copies, ["lang", key, "salt"], "left").drop("salt")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), exact: at most 1000000, as no part is rarer than the whole."""
    return F.expr(f"(1000000BD * (CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)))) "
                  f"div (CAST({left} AS DECIMAL(15,0)) * CAST({right} AS DECIMAL(15,0)))").cast("long")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, lang_col: str = "lang", text_col: str = "text",
                 share: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 and 3 words.

    A candidate is dropped if its words stand in a longer one that is found ``share`` % as often or more.
    """
    known = written(counts(docs, least, 3, lang_col, text_col), "collocations-counts")
    totals = known.filter("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    word = F.split("phrase", " ")
    singles = known.filter("words = 1")
    pairs = known.filter("words = 2").select("lang", "phrase", F.col("f").alias("a"), word[0].alias("w1"), word[1].alias("w2"))
    pairs = looked_up(looked_up(pairs, "w1", singles, {"f": "l"}), "w2", singles, {"f": "r"})
    pairs = written(pairs.select("lang", "phrase", "a", "l", "r"), "collocations-pairs")
    triples = known.filter("words = 3").select(
        "lang", "phrase", F.col("f").alias("a"), F.concat_ws(" ", word[0], word[1]).alias("p1"),
        F.concat_ws(" ", word[1], word[2]).alias("p2"))
    inside = triples.select("lang", "a", F.explode(F.array("p1", "p2")).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    triples = looked_up(looked_up(triples, "p1", pairs, {"l": "f1", "a": "f12"}), "p2", pairs, {"a": "f23", "r": "f3"})

    cut1, cut2 = F.struct(score("a", "f1", "f23").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r")), \
        F.struct(score("a", "f12", "f3").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r"))
    triples = triples.select("lang", "phrase", "a", F.least(cut1, cut2).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    kept = pairs.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a")))
    every = kept.select("lang", "phrase", "a", "l", "r", score("a", "l", "r").alias("score")).unionByName(triples)

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    shared = every.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)))
    some = shared.withColumn("rank", F.row_number().over(W.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
