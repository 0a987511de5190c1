"""Neighbour methods: exact nearest neighbours (J6), local outlier factor (X5, T4), KNN imputation.

J6 works on distinct points: rows with equal coordinates become one point with
a count, so copies cost nothing and ties are kept by weight. Pivots (a bounded
sample of the points, about the square root of their number) part the space into
cells, one shuffle deals the points to blocks of their cell, ordered by the
distance to its pivot. A point is first compared with its own cell; the distance
that holds ``k`` neighbours there is its radius. It then visits only the cells
that the triangle inequality leaves inside that radius:

* ring: the cell's points lie between ``low`` and ``high`` from its pivot;
* hyperplane: a point nearer to pivot j than to the own pivot i is at least
  ``(d(x, j)^2 - d(x, i)^2) / (2 d(i, j))`` away.

Blocks that their ring rules out are skipped inside a cell as well. The pairs that are
compared are counted in the result's ``compared`` rows (``p`` null). Points meet
cells by an equality join; no step makes all pairs, and no answer is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.functions.order_stats import value_at_rank
from insight.session import ensure_checkpoint_dir

#: Pivots at most (they are sent to the driver and to every task), and points of a block and a tile.
PIVOTS = 2048
BLOCK = 512
TILE = 256
#: Distances to pivots that a task holds at a time, and visits or neighbours it gathers before it hands them on.
HELD = 1 << 18
#: Relative widening of bounds, for rounding in distances.
SLACK = 1e-9
#: Copies of a point's row that its equal rows are joined with, one per so many rows.
COPY_ROWS = 50_000


def points(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(v, p, n): distinct coordinates, the least key among their rows, and how many rows. Rows with a null coordinate are left out."""
    v = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in columns])
    rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return rows.groupBy(v.alias("v")).agg(F.min(key).cast("long").alias("p"), F.count(F.lit(1)).alias("n"))


def nearest(asks: DataFrame, base: DataFrame, k: int, same: bool = True) -> DataFrame:
    """(p, q, distance, n) for points as of ``points``: all base points up to the distance that holds k rows, ties kept.

    ``same``: asks and base are one table, where a point's own row is no neighbour of itself (its copies are).
    Rows with a null ``p`` tell in ``n`` how many pairs a task compared. Fewer than k rows give all there are.
    """
    ensure_checkpoint_dir(base.sparkSession)
    base = base.select("p", "v", "n").checkpoint()
    asks = base if same else asks.select("p", "v", "n").checkpoint()
    total = base.count()
    sample = base.orderBy(F.xxhash64("v"), "p").limit(min(PIVOTS, max(1, int(np.ceil(np.sqrt(total)))))).select("v").collect()
    if not sample:
        return asks.select("p", F.col("p").alias("q"), F.lit(0.0).alias("distance"), "n").limit(0)
    pivots = np.array([r.v for r in sample])
    block, tile, slack, dim, held_most = BLOCK, TILE, SLACK, pivots.shape[1], HELD
    step = max(1, held_most // len(pivots))

    def matrix(column) -> np.ndarray:
        return np.asarray(column.flatten()).reshape(-1, dim)

    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sums of squares in the order of the columns, so equal pairs get equal distances everywhere."""
        d = np.zeros((len(a), len(b)))
        for j in range(dim):
            d += (a[:, j, None] - b[None, :, j]) ** 2
        return np.sqrt(d)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            x = matrix(batch.column(1))
            cell, far = np.empty(len(x), np.int32), np.empty(len(x))
            for a in range(0, len(x), step):
                d = distances(x[a:a + step], pivots)
                cell[a:a + step] = own = d.argmin(1)
                far[a:a + step] = d[np.arange(len(d)), own]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=["p", "v", "n", "cell", "far"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                p, v, n, far = zip(*held)
                yield pa.RecordBatch.from_pydict({
                    "cell": pa.array([here], pa.int32()), "low": pa.array([min(far)]), "high": pa.array([max(far)]),
                    "qs": pa.array([np.array(p, "<i8").tobytes()]), "ns": pa.array([np.array(n, "<i8").tobytes()]),
                    "matrix": pa.array([np.array(v, "<f8").tobytes()])})

        for batch in batches:
            for p, v, n, cell, far in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if cell != here or len(held) >= block:
                    yield from out()
                    here, held = cell, []
                held.append((p, v, n, far))
        yield from out()

    placed = base.mapInArrow(place, "p bigint, v array<double>, n bigint, cell int, far double").checkpoint()
    cells = placed.groupBy("cell").agg(F.min("far").alias("low"), F.max("far").alias("high"), F.sum("n").alias("n")).collect()  # a row per pivot
    low, high, weight = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.zeros(len(pivots))
    for r in cells:
        low[r.cell], high[r.cell], weight[r.cell] = r.low, r.high, r.n
    between = distances(pivots, pivots)
    blocks = placed.repartition("cell").sortWithinPartitions("cell", "far", "p").mapInArrow(
        pack, "cell int, low double, high double, qs binary, ns binary, matrix binary").checkpoint()

    def visits(own_only: bool):
        def cells_of(x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, ...]:
            """(cell, row, distance to its pivot, radius) of the cells that each row must visit."""
            d, at = distances(x, pivots), np.arange(len(x))
            own = d.argmin(1)
            if own_only:
                some = np.zeros(d.shape, bool)
                some[at, own] = True
            else:
                # a radius that certainly holds k rows, where the own cell had too few
                reach = d + np.where(high >= 0, high, np.inf)[None]
                order = np.argsort(reach, 1)
                enough = np.cumsum(weight[order], 1) >= k + same
                first = np.where(enough.any(1), enough.argmax(1), -1)
                bound = np.where(first >= 0, np.take_along_axis(reach, order, 1)[at, first], np.inf)
                radius = np.minimum(radius, bound)
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (d ** 2 - d[at, own][:, None] ** 2) / (2 * between[own])
                    least = np.maximum(np.maximum(d - high, low - d), np.nan_to_num(plane, nan=0, posinf=0))
                    some = least <= radius[:, None] + slack * (1 + d + high)
                some[at, own] = False
            rows, cells = np.nonzero(some & (high >= 0))
            return cells, rows, d[rows, cells], radius[rows]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in filter(len, batches):
                x, radius, ids = matrix(batch.column(1)), np.asarray(batch.column(2)), np.asarray(batch.column(0))
                held, size = [], 0
                for a in range(0, len(x), step):
                    cells, rows, far, radii = cells_of(x[a:a + step], radius[a:a + step])
                    held.append((cells, rows + a, far, radii))
                    size += len(rows)
                    if size >= held_most or a + step >= len(x):
                        yield from tiles(x, ids, *map(np.concatenate, zip(*held)))
                        held, size = [], 0

        def tiles(x: np.ndarray, ids: np.ndarray, cells: np.ndarray, rows: np.ndarray, far: np.ndarray, radii: np.ndarray) -> Iterator[pa.RecordBatch]:
            order = np.argsort(cells, kind="stable")
            starts = np.flatnonzero(np.diff(cells[order], prepend=-1))
            for of_cell in np.split(order, starts[1:]):
                for a in range(0, len(of_cell), tile):
                    part = of_cell[a:a + tile]
                    yield pa.RecordBatch.from_pydict({
                        "to": pa.array([cells[part[0]]], pa.int32()), "ps": pa.array([np.ascontiguousarray(ids[rows[part]], "<i8").tobytes()]),
                        "xs": pa.array([x[rows[part]].tobytes()]), "radii": pa.array([radii[part].tobytes()]),
                        "pivot": pa.array([far[part].tobytes()])})
        return run

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = 0
        out: list[list] = [[], [], [], []]

        def found() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["p", "q", "distance", "n"])
            for c in out:
                c.clear()
            return made

        for batch in batches:
            for at_row in range(batch.num_rows):
                ps, xs, radii, at, inner, outer, qs, ns, data = (batch.column(c)[at_row].as_py() for c in range(9))
                ps, qs, ns = (np.frombuffer(b, "<i8") for b in (ps, qs, ns))
                radii, at = np.frombuffer(radii), np.frombuffer(at)
                wide = slack * (1 + at + outer)
                need = np.flatnonzero((at - outer <= radii + wide) & (inner - at <= radii + wide))
                d = distances(np.frombuffer(xs).reshape(-1, dim)[need], np.frombuffer(data).reshape(-1, dim))
                pairs += d.size
                for i, line in zip(need.tolist(), d):
                    near = np.flatnonzero(line <= radii[i])
                    counts = ns[near] - ((qs[near] == ps[i]) if same else 0)
                    near, counts = near[counts > 0], counts[counts > 0]
                    order = np.argsort(line[near], kind="stable")
                    near, counts = near[order], counts[order]
                    full = np.flatnonzero(np.cumsum(counts) >= k)
                    if len(full):
                        last = line[near[full[0]]]
                        keep = line[near] <= last
                        near, counts = near[keep], counts[keep]
                    for to, values in zip(out, ([int(ps[i])] * len(near), qs[near].tolist(), line[near].tolist(), counts.tolist())):
                        to += values
                if len(out[0]) >= held_most // 8:
                    yield found()
        yield found()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.float64()),
                                          pa.array([pairs], pa.int64())], names=["p", "q", "distance", "n"])

    def search(rows: DataFrame, own_only: bool) -> DataFrame:
        goes = rows.select("p", "v", "radius").mapInArrow(visits(own_only), "to int, ps binary, xs binary, radii binary, pivot binary")
        met = goes.join(blocks.hint("merge"), F.col("to") == F.col("cell"))
        return met.select("ps", "xs", "radii", "pivot", "low", "high", "qs", "ns", "matrix").mapInArrow(
            compare, "p bigint, q bigint, distance double, n bigint")

    first = search(asks.withColumn("radius", F.lit(float("inf"))), True).checkpoint()
    radius = within(first.where("p is not null"), k).groupBy(F.col("p").alias("r_p")).agg(
        F.max("distance").alias("most"), F.sum("n").alias("held"))
    rows = asks.join(radius.hint("merge"), F.col("p") == F.col("r_p"), "left").select(
        "p", "v", F.when(F.col("held") >= k, F.col("most")).otherwise(F.lit(float("inf"))).alias("radius"))
    every = first.unionByName(search(rows.checkpoint(), False))
    return within(every.where("p is not null"), k).unionByName(every.where("p is null"))


def within(found: DataFrame, k: int) -> DataFrame:
    """Neighbours up to the distance at which k rows are held: those with fewer than k rows strictly nearer."""
    w = Window.partitionBy("p").orderBy("distance").rangeBetween(Window.unboundedPreceding, 0)
    tie = Window.partitionBy("p", "distance")
    return found.withColumn("_nearer", F.sum("n").over(w) - F.sum("n").over(tie)).where(F.col("_nearer") < k).drop("_nearer")


def back_to_rows(df: DataFrame, key: str, columns: Sequence[str], per_point: DataFrame) -> DataFrame:
    """``df`` with the columns of ``per_point`` (v, n, ...) by equal coordinates; points of very many rows are copied to salts."""
    copies = F.greatest(F.lit(1), F.ceil(F.col("n") / COPY_ROWS)).cast("int")
    most = per_point.agg(F.max(copies)).first()[0] or 1
    dealt = per_point.withColumn("_of", copies).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    v = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in columns])
    rows = df.withColumn("_v", v).withColumn("_at", F.pmod(F.xxhash64(key), F.lit(most)).cast("int"))
    joined = rows.join(dealt, (F.col("_v") == F.col("v")) & (F.pmod(F.col("_at"), F.col("_of")) == F.col("_salt")), "left")
    return joined.drop("_v", "_at", "_of", "_salt", "v", "n")


def local_outlier_factor(df: DataFrame, key: str, columns: Sequence[str], k: int = 20) -> DataFrame:
    """``df`` with ``lof`` (the negative local outlier factor: lower is more of an outlier; null beside a null coordinate).

    Two passes over the neighbour table: each point's k-distance, then the density from ``max(distance, k-distance of the
    neighbour)``. All rows at the k-distance are neighbours, copies of a row count each.
    """
    pts = points(df, key, columns).checkpoint()
    found = nearest(pts, pts, k).where("p is not null").checkpoint()
    reach = found.groupBy(F.col("p").alias("k_p")).agg(F.max("distance").alias("k_distance"))
    density = found.join(reach, F.col("q") == F.col("k_p")).groupBy("p").agg(
        F.lit(1.0).alias("one"), (F.sum(F.greatest("distance", "k_distance") * F.col("n")) / F.sum("n")).alias("mean")).select(
        F.col("p"), (1 / (F.col("mean") + 1e-10)).alias("density")).checkpoint()
    of = density.select(F.col("p").alias("d_q"), F.col("density").alias("d"))
    near = found.join(of, F.col("q") == F.col("d_q")).groupBy("p").agg((F.sum(F.col("d") * F.col("n")) / F.sum("n")).alias("around"))
    score = near.join(density, "p").select("p", (-F.col("around") / F.col("density")).alias("lof"))
    return back_to_rows(df, key, columns, pts.join(score, "p").select("v", "n", "lof"))


def drop_local_outliers(scored: DataFrame, position: int, score: str = "lof") -> DataFrame:
    """Rows not strictly below the score at 0-based ``position`` of the sorted scores; rows without a score stay."""
    known = scored.where(F.col(score).isNotNull())
    if known.count() <= position:
        return scored
    edge = value_at_rank(known, score, position)
    return scored.where(F.col(score).isNull() | (F.col(score) >= F.lit(float(edge))))


def knn_impute(df: DataFrame, key: str, columns: Sequence[str], k: int = 5) -> DataFrame:
    """Nulls in ``columns`` become the mean of the k nearest rows that have the value; other columns stay as they are.

    Columns are scaled to 0..1 for the distances and scaled back. A distance is Euclidean over the columns present in both
    rows, times sqrt(columns / columns present in both). Rows fall into few patterns of missing columns; for a
    pattern that lacks a value and one that has it, the shared columns span a space in which ``nearest`` is exact, so there is one
    search per such pair of patterns. Donors that tie at the k-th distance count all. A row that shares no present column with any
    donor gets the column's mean; a column without values stays null. ``key`` must be unique.
    """
    ensure_checkpoint_dir(df.sparkSession)
    stats = df.agg(*[f(F.col(c).cast("double")).alias(f"{f.__name__}_{i}") for i, c in enumerate(columns) for f in (F.min, F.max, F.avg)]).first()
    live = [i for i, _ in enumerate(columns) if stats[f"min_{i}"] is not None]
    low = {i: stats[f"min_{i}"] for i in live}
    size = {i: (stats[f"max_{i}"] - low[i]) or 1.0 for i in live}
    names = {i: f"_s{i}" for i in live}
    pattern = reduce(lambda a, b: a + b, [F.when(F.col(columns[i]).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in live], F.lit(0))
    rows = df.select(F.col(key).cast("long").alias("_key"), *[((F.col(columns[i]).cast("double") - low[i]) / size[i]).alias(names[i]) for i in live],
                     pattern.alias("_has")).checkpoint()
    patterns = [r._has for r in rows.select("_has").distinct().collect()]  # at most 2^columns
    found: dict[int, list[DataFrame]] = {i: [] for i in live}
    for asked in patterns:
        lacks = [i for i in live if not asked >> i & 1]
        for given in patterns if lacks else []:
            shared, gets = [i for i in live if asked & given & 1 << i], [i for i in lacks if given >> i & 1]
            if not shared or not gets:
                continue
            at = [names[i] for i in shared]
            donors = rows.where(F.col("_has") == given)
            base = points(donors, "_key", at).checkpoint()
            near = nearest(rows.where(F.col("_has") == asked).select(F.col("_key").alias("p"), F.array(*at).alias("v"), F.lit(1).cast("long").alias("n")),
                           base, k, same=False).where("p is not null")
            sums = donors.groupBy(F.array(*[F.col(c) + F.lit(0.0) for c in at]).alias("v")).agg(*[F.sum(names[i]).alias(f"_t{i}") for i in gets])
            values = base.select("v", F.col("p").alias("q_p")).join(sums, "v").drop("v")
            met = near.join(values, F.col("q") == F.col("q_p")).withColumn("distance", F.lit(float(np.sqrt(len(live) / len(shared)))) * F.col("distance"))
            met = met.checkpoint()
            for i in gets:
                found[i].append(met.select("p", "distance", "n", F.col(f"_t{i}").alias("total")))
    out = df
    for i in (i for i in live if found[i]):
        near = within(reduce(DataFrame.unionByName, found[i]), k).groupBy(F.col("p").alias("_p")).agg(
            (F.sum("total") / F.sum("n") * size[i] + low[i]).alias("_new"))
        out = out.join(near, F.col(key) == F.col("_p"), "left").withColumn(
            columns[i], F.coalesce(F.col(columns[i]).cast("double"), F.col("_new"), F.lit(stats[f"avg_{i}"]))).drop("_p", "_new")
    rest = {columns[i]: F.coalesce(F.col(columns[i]).cast("double"), F.lit(stats[f"avg_{i}"])) for i in live if not found[i]}
    return out.withColumns(rest) if rest else out
