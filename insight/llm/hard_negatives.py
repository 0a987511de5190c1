"""Hard negatives through a GNAT-style tree: split points, distance ranges to sibling subtrees, exact leaves.

A tree of split points is fitted on a bounded sample (``SAMPLE`` rows, those of
least hash); every row then goes to its nearest split point at each level
(a generalised hyperplane partition) and ends in a leaf. Over all rows, each
split point stores the least and greatest distance to the rows of each sibling
subtree. A leaf is kept as blocks of bounded size; a leaf with many rows is
dealt to several slots, so no group of near vectors lands in one task.

A window of scores is an annulus of distances around the anchor, since
``|q - x|^2 = |q|^2 + |x|^2 - 2 q x`` and the range of ``|x|^2`` in a subtree is
known. By the triangle inequality, a sibling whose stored range does not meet
the annulus around any split point holds no row of the window and is not
visited. Each search has two rounds: the anchor's own leaf, whose results narrow
the windows, then all other leaves that are left. In a leaf, all products are
computed: the answer is that of brute force. Where distances are all alike (high
dimensions without clusters) few subtrees can be ruled out and the work
is that of the products, in tiles of anchors by blocks of rows.

Positives of an anchor are its best rows of the same label; for each, the
negatives are the best rows of other labels with ``low * positive <= 100 *
negative <= high * positive``.

Defined cases: rows with a null id or label, or a null vector, an empty one or
one with null or non-finite components take no part; vectors of another length
than the anchor's are no candidates of it; ties go to the smaller id; an
anchor is compared with no row of its own id, and an anchor id that repeats is
asked once, with the label and vector that sort first; other rows that repeat
are candidates each; fewer rows than asked give fewer; an empty table gives no
rows. Scores beyond 2**55 raise an error, as the windows need exact numbers.
Only the id, vector and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from insight.llm.common import shipped, written

#: Rows that the split points are chosen from, children of a node, rows of the sample that a leaf holds at most.
SAMPLE = 4096
FANOUT = 16
SAMPLE_LEAF = 64
#: Bytes of the matrices of a block of rows and of a tile of anchors.
BLOCK_BYTES = 2 << 20
TILE_BYTES = 256 << 10
#: Distances are computed in floating point; ranges are widened by this share of the lengths involved.
SLACK = 1e-5
NO_LOW, NO_HIGH = -(1 << 62), 1 << 62
MOST = 1 << 55


@dataclass
class Tree:
    """Nodes of split points; ``kids[n][j]`` is a node, or ``~leaf``. Lists go by node, arrays by split point."""

    dim: int = 0
    points: list[np.ndarray] = field(default_factory=list)
    kids: list[list[int]] = field(default_factory=list)
    leaves: int = 1
    low: list[np.ndarray] = field(default_factory=list)     # [n][i, j]: least distance of point i to subtree j
    high: list[np.ndarray] = field(default_factory=list)
    n_low: list[np.ndarray] = field(default_factory=list)   # [n][j]: least squared length in subtree j
    n_high: list[np.ndarray] = field(default_factory=list)
    slots: np.ndarray | None = None                         # per leaf

    def distances(self, node: int, x: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Distances of rows (cut or padded to ``dim``, with whole squared lengths) to a node's points."""
        p = self.points[node]
        return np.sqrt(np.maximum(norms[:, None] + (p * p).sum(1)[None] - 2 * (x @ p.T), 0))

    def place(self, x: np.ndarray, norms: np.ndarray, seen=None) -> np.ndarray:
        """Leaf of every row; ``seen(node, child, distances, norms)`` is told what goes where."""
        leaf = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.points else []
        while todo:
            node, here = todo.pop()
            d = self.distances(node, x[here], norms[here])
            near = d.argmin(1)
            for j, kid in enumerate(self.kids[node]):
                mine = np.flatnonzero(near == j)
                if not len(mine):
                    continue
                if seen:
                    seen(node, j, d[mine], norms[here[mine]])
                if kid < 0:
                    leaf[here[mine]] = ~kid
                else:
                    todo.append((kid, here[mine]))
        return leaf

    def visits(self, x: np.ndarray, norms: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, rows that must visit it), for score windows ``lows[row, window] .. highs[row, window]``."""
        if not self.points:
            return [(0, np.arange(len(x)))]
        out, todo = [], [(0, np.arange(len(x)))]
        while todo:
            node, here = todo.pop()
            d = self.distances(node, x[here], norms[here])
            lengths = np.sqrt(norms[here])
            for j, kid in enumerate(self.kids[node]):
                if self.n_low[node][j] > self.n_high[node][j]:
                    continue  # no row went there
                wide = SLACK * (lengths + np.sqrt(self.n_high[node][j]) + 1)[:, None]
                near = np.sqrt(np.maximum(norms[here, None] + self.n_low[node][j] - 2 * highs[here], 0)) - wide
                most = norms[here, None] + self.n_high[node][j] - 2 * lows[here]
                far = np.sqrt(np.maximum(most, 0)) + wide
                some = (most >= -wide * wide) & (lows[here] <= highs[here])
                for i in range(len(self.kids[node])):
                    at = d[:, i, None]
                    some &= (at + far >= self.low[node][i, j]) & (np.maximum(near - at, at - far) <= self.high[node][i, j])
                left = here[some.any(1)]
                if len(left):
                    if kid < 0:
                        out.append((~kid, left))
                    else:
                        todo.append((kid, left))
        return out


def grown(sample: np.ndarray, fanout: int = FANOUT, leaf: int = SAMPLE_LEAF) -> Tree:
    """Split points by greedy farthest choice in each part of the sample."""
    tree = Tree(dim=sample.shape[1] if len(sample) else 0, leaves=0)

    def grow(part: np.ndarray) -> int:
        least = np.full(len(part), np.inf)
        chosen = [0]
        while len(part) > leaf and len(chosen) < fanout:
            least = np.minimum(least, ((part - part[chosen[-1]]) ** 2).sum(1))
            if least.max() <= 0:
                break
            chosen.append(int(least.argmax()))
        if len(chosen) < 2:
            tree.leaves += 1
            return ~(tree.leaves - 1)
        node = len(tree.points)
        tree.points.append(part[chosen])
        tree.kids.append([])
        near = tree.distances(node, part, (part * part).sum(1)).argmin(1)
        groups = [part[near == j] for j in range(len(chosen))]
        if max(map(len, groups)) == len(part):  # distances that floating point cannot tell apart
            tree.points.pop(), tree.kids.pop()
            tree.leaves += 1
            return ~(tree.leaves - 1)
        tree.kids[node] = [grow(g) for g in groups]
        return node

    if grow(sample) != 0:
        tree.leaves = 1
    for points in tree.points:
        m = len(points)
        tree.low.append(np.full((m, m), np.inf))
        tree.high.append(np.full((m, m), -np.inf))
        tree.n_low.append(np.full(m, np.inf))
        tree.n_high.append(np.full(m, -np.inf))
    tree.slots = np.ones(tree.leaves, np.int64)
    return tree


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
              label_col: str = "label") -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of every component as double; rows that take part only."""
    x = F.transform(F.col(vec_col).cast("array<double>"), lambda e: F.lit(float(scale)) * e)
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    whole = F.transform(x, lambda e: F.when(F.abs(e) < F.lit(2.0 ** 53), F.floor(e).cast("double")).otherwise(e))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"))


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """A list column as rows cut or padded to ``dim``, and the rows' whole squared lengths."""
    out, norms = np.zeros((len(column), dim)), np.zeros(len(column))
    flat, ends = np.asarray(column.flatten()), np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
    sizes = np.diff(ends)
    if len(sizes) and (sizes == sizes[0]).all():
        whole = flat.reshape(len(sizes), -1)
        out[:, :min(dim, whole.shape[1])] = whole[:, :dim]
        return out, (whole * whole).sum(1)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        part = flat[a:b]
        out[i, :min(dim, len(part))] = part[:dim]
        norms[i] = (part * part).sum()
    return out, norms


def measured(rows: DataFrame, tree: Tree) -> Tree:
    """The tree with the ranges of all rows and the slots of its leaves; one row per node, pair of children and task is summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[tuple, list[float]] = {}
        counts = np.zeros(tree.leaves, np.int64)
        size = np.zeros(tree.leaves, np.int64)

        def seen(node: int, j: int, d: np.ndarray, norms: np.ndarray) -> None:
            for i, (a, b) in enumerate([*zip(d.min(0), d.max(0)), (norms.min(), norms.max())]):
                key = (node, i if i < d.shape[1] else -1, j)  # -1: squared lengths
                was = ranges.get(key, [np.inf, -np.inf])
                ranges[key] = [min(was[0], float(a)), max(was[1], float(b))]

        for batch in batches:
            x, norms = matrix(batch.column(0), tree.dim)
            leaf = tree.place(x, norms, seen)
            counts += np.bincount(leaf, minlength=tree.leaves)
            size += np.bincount(leaf, 8 * batch.column(0).value_lengths().to_numpy(zero_copy_only=False), tree.leaves).astype(np.int64)
        told = [(n, i, j, a, b, 0) for (n, i, j), (a, b) in ranges.items()]
        told += [(-1, -1, leaf, 0.0, 0.0, int(size[leaf])) for leaf in np.flatnonzero(counts).tolist()]
        if told:
            yield pa.RecordBatch.from_pydict(dict(zip(("node", "i", "j", "low", "high", "n"), map(list, zip(*told)))),
                                             schema=pa.schema([("node", pa.int32()), ("i", pa.int32()), ("j", pa.int32()),
                                                               ("low", pa.float64()), ("high", pa.float64()), ("n", pa.int64())]))

    found = shipped(rows).select("v").mapInArrow(run, "node int, i int, j int, low double, high double, n bigint") \
        .groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    for r in found.collect():  # at most nodes x FANOUT x (FANOUT + 1) + leaves rows, whatever the table's size
        if r.node < 0:
            tree.slots[r.j] = max(1, -(-r.n // BLOCK_BYTES))
        elif r.i < 0:
            tree.n_low[r.node][r.j], tree.n_high[r.node][r.j] = r.low, r.high
        else:
            tree.low[r.node][r.i, r.j], tree.high[r.node][r.i, r.j] = r.low, r.high
    return tree


def blocks(rows: DataFrame, tree: Tree) -> DataFrame:
    """(leaf, slot, dim, ids, labels, matrix): all rows in blocks of one leaf and slot."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            x, norms = matrix(batch.column(2), tree.dim)
            leaf = tree.place(x, norms)
            slot = (at + np.arange(len(leaf))) % tree.slots[leaf]
            at += len(leaf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(slot.astype(np.int32)),
                                              pa.array(batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int32))],
                                             names=["vec_id", "label", "v", "leaf", "slot", "dim"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                ids, labels, vectors = zip(*held)
                yield pa.RecordBatch.from_pydict({
                    "leaf": pa.array([key[0]], pa.int32()), "slot": pa.array([key[1]], pa.int32()), "dim": pa.array([key[2]], pa.int32()),
                    "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                    "labels": pa.array([np.array(labels, "<i8").tobytes()], pa.binary()),
                    "matrix": pa.array([np.array(vectors, "<f8").tobytes()], pa.binary())})

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in (3, 4, 5)))
            for here, vec_id, label, v in zip(keys, batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if here != key or len(held) * 8 * here[2] >= BLOCK_BYTES:
                    yield from out()
                    key, held = here, []
                held.append((vec_id, label, np.asarray(v.values)))
        yield from out()

    placed = shipped(rows).select("vec_id", "label", "v").mapInArrow(
        place, "vec_id bigint, label bigint, v array<double>, leaf int, slot int, dim int")
    return placed.repartition("leaf", "slot").sortWithinPartitions("leaf", "slot", "dim").mapInArrow(
        pack, "leaf int, slot int, dim int, ids binary, labels binary, matrix binary")


TILE = pa.schema([("leaf", pa.int32()), ("slot", pa.int32()), ("dim", pa.int32()), ("tile", pa.int64()), ("q_ids", pa.binary()),
                  ("q_labels", pa.binary()), ("q_lows", pa.binary()), ("q_highs", pa.binary()), ("q_matrix", pa.binary())])
TILE_SCHEMA = "leaf int, slot int, dim int, tile bigint, q_ids binary, q_labels binary, q_lows binary, q_highs binary, q_matrix binary"


def tiles(asks: DataFrame, tree: Tree, home: bool) -> DataFrame:
    """Asks (vec_id, label, v, lows, highs) packed per leaf that they visit: their own, or all others that are left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in filter(len, batches):
            x, norms = matrix(batch.column(2), tree.dim)
            own = tree.place(x, norms)
            ids, labels = (np.asarray(batch.column(c)) for c in (0, 1))
            lows, highs = (np.stack([np.asarray(w.values) for w in batch.column(c)]) for c in (3, 4))
            vectors = [np.asarray(v.values) for v in batch.column(2)]
            sizes = np.array([len(v) for v in vectors])
            goes = [(leaf, np.flatnonzero(own == leaf)) for leaf in np.unique(own).tolist()] if home else [
                (leaf, rows[own[rows] != leaf]) for leaf, rows in tree.visits(x, norms, lows.astype(float), highs.astype(float))]
            for leaf, rows in goes:
                for dim in np.unique(sizes[rows]).tolist():
                    some = rows[sizes[rows] == dim]
                    step = max(1, TILE_BYTES // (8 * dim))
                    for a in range(0, len(some), step):
                        part, n = some[a:a + step], n + 1
                        data = [ids[part], labels[part], lows[part], highs[part]]
                        row = [np.ascontiguousarray(d, "<i8").tobytes() for d in data] + [np.array([vectors[i] for i in part], "<f8").tobytes()]
                        m = int(tree.slots[leaf])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([leaf] * m, pa.int32()), pa.array(range(m), pa.int32()), pa.array([dim] * m, pa.int32()),
                             pa.array([n] * m, pa.int64()), *(pa.array([b] * m, pa.binary()) for b in row)], schema=TILE)

    return shipped(asks).select("vec_id", "label", "v", "lows", "highs").mapInArrow(run, TILE_SCHEMA)


def products(asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as whole numbers."""
    if np.abs(asked).max(initial=0) * np.abs(rows).max(initial=0) * asked.shape[1] < 2.0 ** 53:
        return (asked @ rows.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in asked], object) @ np.array([[int(x) for x in r] for r in rows], object).T
    if max(abs(exact.max()), abs(exact.min())) > MOST:
        raise ArithmeticError("scores beyond 2**55: use a smaller scale")
    return exact.astype(np.int64)


def search(asks: DataFrame, tree: Tree, index: DataFrame, k: int, same: bool, home: bool) -> DataFrame:
    """(vec_id, window, score, found): each window's k best rows of the same or another label, per block read.

    A merge join: blocks grow with the table, and their compressed size on disk would pass for small enough to broadcast.
    """
    asked = tiles(asks, tree, home).withColumnRenamed("leaf", "q_leaf").withColumnRenamed("slot", "q_slot").withColumnRenamed("dim", "q_dim")
    met = asked.join(index.hint("merge"), (F.col("leaf") == F.col("q_leaf")) & (F.col("slot") == F.col("q_slot")) & (F.col("dim") == F.col("q_dim")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c) for c in range(batch.num_columns))):
                dim = row[0].as_py()
                q_ids, q_labels, lows, highs, ids, labels = (np.frombuffer(row[c].as_buffer(), "<i8") for c in (1, 2, 3, 4, 6, 7))
                lows, highs = lows.reshape(len(q_ids), -1), highs.reshape(len(q_ids), -1)
                scores = products(np.frombuffer(row[5].as_buffer(), "<f8").reshape(-1, dim), np.frombuffer(row[8].as_buffer(), "<f8").reshape(-1, dim))
                out: list[list] = [[], [], [], []]
                for q in range(len(q_ids)):
                    fits = ((labels == q_labels[q]) == same) & (ids != q_ids[q])
                    for w in range(lows.shape[1]):
                        hits = np.flatnonzero(fits & (scores[q] >= lows[q, w]) & (scores[q] <= highs[q, w]))
                        if len(hits) > k:
                            s = scores[q][hits]
                            hits = hits[s >= np.partition(s, len(s) - k)[len(s) - k]]
                        hits = hits[np.lexsort((ids[hits], -scores[q][hits]))[:k]]
                        for to, values in zip(out, ([int(q_ids[q])] * len(hits), [w] * len(hits), scores[q][hits].tolist(), ids[hits].tolist())):
                            to += values
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                                                      pa.array(out[3], pa.int64())], names=["vec_id", "window", "score", "found"])

    return met.select("dim", "q_ids", "q_labels", "q_lows", "q_highs", "q_matrix", "ids", "labels", "matrix").mapInArrow(
        run, "vec_id bigint, window int, score bigint, found bigint")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each ask and window, with their rank."""
    rank = F.row_number().over(W.partitionBy("vec_id", "window").orderBy(F.col("score").desc(), "found"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def two_rounds(asks: DataFrame, tree: Tree, index: DataFrame, k: int, same: bool, name: str) -> DataFrame:
    """The k best of all rows: own leaves first; a window whose k places are taken there is narrowed for the rest."""
    first = written(best(search(asks, tree, index, k, same, home=True), k), f"negatives-{name}-own")
    edge = first.filter(F.col("rank") == k).groupBy("vec_id").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("edge"))  # an entry per window
    narrowed = asks.join(edge.withColumnRenamed("vec_id", "e_id").hint("merge"), F.col("vec_id") == F.col("e_id"), "left").select(
        "vec_id", "label", "v", F.transform("lows", lambda low, w: F.coalesce(F.try_element_at("edge", w.cast("int")), low)).alias("lows"), "highs")
    rest = search(narrowed, tree, index, k, same, home=False)
    return best(first.drop("rank").unionByName(rest), k)


def floor_div(x: Column, by: int) -> Column:
    """Whole-number floor of x / by."""
    return F.call_function("div", x - F.pmod(x, F.lit(by)), F.lit(by))


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). Inputs as of ``quantised``.

    ``low`` and ``high`` are percentages of the positive's score.
    """
    rows = written(rows, "negatives-rows")
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "label", "v").limit(SAMPLE).select("v").collect()
    dim = max((len(r.v) for r in sample), default=0)
    points = np.zeros((len(sample), dim))
    for i, r in enumerate(sample):
        points[i, :len(r.v)] = r.v
    tree = measured(rows, grown(points))
    index = written(blocks(rows, tree), "negatives-blocks")

    asked = written(anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.label", "a.v"), "negatives-anchors")
    every = asked.select("*", F.array(F.lit(NO_LOW).cast("long")).alias("lows"), F.array(F.lit(NO_HIGH).cast("long")).alias("highs"))
    good = written(two_rounds(every, tree, index, positives, True, "positives"), "negatives-positives")

    of = good.groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("good")) \
        .withColumnRenamed("vec_id", "p_id")  # at most ``positives`` entries

    def limits(make, none: int) -> Column:
        """One limit per rank of a positive; ``none`` where there is no positive of that rank."""
        return F.transform(F.sequence(F.lit(0), F.lit(positives - 1)),
                           lambda w: F.coalesce(make(F.get(F.col("good"), w)["score"]), F.lit(none)).cast("long"))

    asks = asked.join(of.hint("merge"), F.col("vec_id") == F.col("p_id")).select(
        "vec_id", "label", "v", limits(lambda s: -floor_div(F.lit(-low) * s, 100), NO_HIGH).alias("lows"),
        limits(lambda s: floor_div(F.lit(high) * s, 100), NO_LOW).alias("highs"))
    bad = two_rounds(written(asks, "negatives-asks"), tree, index, negatives, False, "negatives")
    pos = good.select(F.col("vec_id").alias("anchor_id"), (F.col("rank") - 1).alias("at"), F.col("found").alias("positive_id"),
                      F.col("score").alias("positive_score"))
    return bad.join(pos.hint("merge"), (F.col("vec_id") == F.col("anchor_id")) & (F.col("window") == F.col("at"))).select(
        "anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
