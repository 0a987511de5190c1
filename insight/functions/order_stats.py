"""Exact order statistics without a global sort.

Quantiles, quantile binning (``qcut``) and "rank with ties by key" are the
backbone of RFM scores, outlier limits, robust scaling and quartile
weighting. The obvious Spark forms do not scale: ``percentile`` holds every
value of a group in one task, and ``row_number()`` over an un-partitioned
window funnels the whole table into one partition.

Method: a sketch, then a bracket, then exact counts. Rows are never shuffled.

1. One scan takes the size and a bounded sketch (``percentile_approx``) of each
   group. The sketch's rank error is known, so two of its values with a margin
   around a rank enclose the value at that rank. The sketch only chooses these
   brackets; the answer stays exact.
2. The ends of all brackets are sorted borders. A second scan counts, map-side, the rows
   between borders and, inside a bracket, those of each distinct value (a value that holds a
   third of all rows is one row). A row counts once, however many ranks are asked for.
   These counts are checkpointed: totals between borders give a rank's segment, and a
   running sum in that segment alone gives the value at the rank.
3. A bracket of more than ``BRACKET_ROWS`` rows is narrowed first, by a scan
   that sketches only the rows inside it. A rank that a bracket should have
   missed is looked for again without one, so no error bound is trusted blindly.

Un-grouped statistics are *fitted* like Spark ML's ``QuantileDiscretizer``:
only sizes, sketch values and the rows at requested ranks reach the driver,
and rows are labelled by literal ``CASE WHEN`` chains inside whole-stage
codegen. In grouped statistics (``quantiles`` with ``by``) a group's
borders are an array that meets the group's rows by an ordinary join; nothing reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from insight.session import ensure_checkpoint_dir

#: Quantiles that a sketch is asked for, its accuracy (rank error 1 in so many), and the
#: number of grid steps that a bracket reaches beyond a rank: ten times that error.
GRID = 1_000
SKETCH_ACCURACY = 10_000
MARGIN = 1
#: Rows of a bracket that one running sum may hold.
BRACKET_ROWS = 1_000_000
#: Groups up to this size are counted whole; beyond it neighbouring ranks lie within a bracket's margin.
WHOLE_GROUP = 10_000
#: The one not-a-number used as a border: Spark orders it last and equal to itself, Python by identity.
NAN = float("nan")
#: Parts of equal width that a group's rows between two borders are spread over.
PARTS = 64


def _grid(value: Column | str) -> Column:
    return F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], SKETCH_ACCURACY)


def _around(grid: list, n: int, rank: int) -> tuple:
    """Values of a sketch's grid that enclose a 0-based rank of n; None is open."""
    if n <= GRID:
        return None, None
    lo, hi = rank * GRID // n - MARGIN - 1, -(-(rank + 1) * GRID // n) + MARGIN + 1
    grid = [NAN if e != e else e for e in grid]
    return (grid[lo] if lo >= 0 else None), (grid[hi] if hi <= GRID else None)


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
              out: str = "quantiles") -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default, DuckDB's
    ``quantile_cont``). Nulls are ignored. One row per group:
    (by..., out: array<double> in the order of ``probs``).

    Two scans, the second one run at once: its counts go to the checkpoint folder. A row meets its group's
    borders as one array, so no row is copied per quantile, and each bracket is spread over ``PARTS`` parts,
    so that a hot group is no single window."""
    by = list(by)
    keys = [f"_k{i}" for i in range(len(by))]
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.where(F.col(value).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(value).cast("double").alias("_x"))
    margin = 10 / SKETCH_ACCURACY
    edges = [e for p in probs for e in (max(p - margin, 0.0), min(p + margin, 1.0))]
    stats = rows.groupBy(*keys).agg(F.count("_x").alias("_n"), F.percentile_approx("_x", edges, SKETCH_ACCURACY).alias("_e"))
    wide = F.col("_n") > WHOLE_GROUP
    brackets = F.array(*[F.struct(
        F.when(wide & F.lit(p - margin > 0), F.col("_e")[2 * j]).alias("lo"),
        F.when(wide & F.lit(p + margin < 1), F.col("_e")[2 * j + 1]).alias("hi")) for j, p in enumerate(probs)])
    stats = stats.select(*keys, "_n", brackets.alias("_w"), F.when(
        wide, F.array_sort(F.array_distinct("_e"))).otherwise(F.array().cast("array<double>")).alias("_e"))
    x, e = F.col("_x"), F.col("_e")
    met = _same_group(rows, stats, keys, ["_n", "_w", "_e"]).withColumn("_i", F.size(F.filter(e, lambda b: b < x)))
    low, high, on_border = F.get(e, F.col("_i") - 1), F.get(e, F.col("_i")), F.coalesce(F.get(e, F.col("_i")) == x, F.lit(False))
    part = F.when(on_border, PARTS).otherwise(F.coalesce(
        F.floor(F.try_divide(x - low, high - low) * PARTS).cast("int"), F.lit(0)))
    kept = F.exists("_w", lambda w: (w["lo"].isNull() | (x >= w["lo"])) & (w["hi"].isNull() | (x <= w["hi"])))
    counts = met.groupBy(*keys, "_n", (F.col("_i") * (PARTS + 1) + F.least(part, F.lit(PARTS - 1) + on_border.cast("int"))).alias("_s"),
                         F.when(kept, x).alias("_v")).agg(F.count(F.lit(1)).alias("_c")).checkpoint()
    pos = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    wanted = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(side).alias("side"), fn(q).cast("long").alias("rank"))
                       for j, q in enumerate(pos) for side, fn in enumerate((F.floor, F.ceil))])
    upto = F.sum("_t").over(Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, 0))
    parts = counts.groupBy(*keys, "_n", "_s").agg(F.sum("_c").alias("_t")).withColumn("_upto", upto)
    start = F.col("_upto") - F.col("_t")
    parts = parts.select(*keys, "_s", F.filter(F.transform(wanted, lambda w: F.struct(
        w["j"].alias("j"), w["side"].alias("side"), (w["rank"] - start).alias("rank"))),
        lambda w: (w["rank"] >= 0) & (w["rank"] < F.col("_t"))).alias("_r")).where(F.size("_r") > 0)
    run = Window.partitionBy(*keys, "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = _same_group(counts, parts, [*keys, "_s"], ["_r"]).withColumn("_run", F.sum("_c").over(run))
    hits = near.select(*keys, "_n", "_v", F.explode(F.filter("_r", lambda w: (
        w["rank"] < F.col("_run")) & (w["rank"] >= F.col("_run") - F.col("_c")))).alias("_h"))
    lost = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    found = F.map_from_entries(F.collect_list(F.struct(
        F.col("_h.j") * 2 + F.col("_h.side"), F.coalesce("_v", lost))))
    found = hits.groupBy(*keys, "_n").agg(found.alias("_f"))

    def between(j: int, q: Column) -> Column:
        a, b = F.col("_f")[2 * j], F.col("_f")[2 * j + 1]
        return a + (q - F.floor(q)) * (b - a)

    return found.select(*[F.col(k).alias(c) for c, k in zip(by, keys)],
                        F.array(*[between(j, q) for j, q in enumerate(pos)]).alias(out))


def group_medians_of(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, median_<column>...): exact medians of several columns per group, all from one plan of two scans."""
    parts = F.array(*[F.struct(F.lit(c).alias("_g"), F.col(c).cast("double").alias("_v")) for c in columns])
    long = df.select(by, F.explode(parts).alias("_s")).select(by, "_s._g", "_s._v")
    med = quantiles(long, "_v", [0.5], [by, "_g"], out="_q")
    return med.groupBy(by).agg(*[F.max(F.when(F.col("_g") == c, F.col("_q")[0])).alias(f"median_{c}") for c in columns])


def _same_group(rows: DataFrame, other: DataFrame, keys: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Rows with the columns ``take`` of the one row of their group; a null key is a group, too."""
    if not keys:
        return rows.crossJoin(F.broadcast(other.select(*take)))  # one row
    right = other.select(*[F.col(k).alias(f"{k}b") for k in keys], *take)
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"{k}b"))
        on = same if on is None else on & same
    return rows.join(right, on).drop(*[f"{k}b" for k in keys])


def _segment(x: Column, borders: Sequence, kind: str, at: int = 0) -> Column:
    """Place of ``x`` among sorted borders, by halving: 2i between borders i-1 and i, 2i+1 on border i."""
    if not borders:
        return F.lit(2 * at)
    mid = len(borders) // 2
    border = F.lit(borders[mid]).cast(kind)
    return (F.when(x == border, 2 * (at + mid) + 1)
            .when(x < border, _segment(x, borders[:mid], kind, at))
            .otherwise(_segment(x, borders[mid + 1:], kind, at + mid + 1)))


def _locate_groups(rows: DataFrame, value: str, ranks_fn):
    """Values at ranks of a few groups, eagerly.

    ``rows`` is (_g, value); ``_g`` names a small set of groups (columns of one
    table, or tie groups). ``ranks_fn(g, n)`` gives the 0-based ranks wanted in
    group ``g`` of size n. Returns {g: (n, {rank: (value, rows_before_value)})}.

    Two scans; one more for each narrowing of large brackets. The brackets of a group
    are sorted borders: a row counts once, in its segment between two of them (not once per
    rank), with its value where the segment lies inside a bracket. Totals of segments give the segment
    and the place of each rank; a running sum in that segment alone gives the value.
    """
    rows = rows.where(F.col(value).isNotNull())
    ensure_checkpoint_dir(rows.sparkSession)
    x, kind = F.col(value), rows.schema[value].dataType.simpleString()
    stats = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), _grid(value).alias("b")).collect()
    result = {st["_g"]: (st["n"], {}) for st in stats}
    brackets, sizes = {}, {}  # (group, rank) -> (lo, hi), rows between
    for st in stats:
        g, n = st["_g"], st["n"]
        for k in sorted({int(k) for k in ranks_fn(g, n)}):
            lo, hi = brackets[g, k] = _around(st["b"], n, k)
            sizes[g, k] = n if lo is None and hi is None else n * (2 * MARGIN + 4) // GRID

    def placed(todo: dict) -> tuple[dict, DataFrame]:
        """Sorted borders by group, and rows with their segment."""
        borders = {g: sorted({e for (h, _), w in todo.items() if h == g for e in w if e is not None}, key=lambda e: (e != e, e))
                   for g in {g for g, _ in todo}}
        seg = F.lit(None).cast("int")
        for g, es in borders.items():
            seg = F.when(F.col("_g") == g, _segment(x, es, kind)).otherwise(seg)
        return borders, rows.where(F.col("_g").isin(list(borders))).withColumn("_s", seg)

    def segments(es: list, bracket: tuple) -> range:
        lo, hi = bracket
        return range(0 if lo is None else 2 * es.index(lo) + 1, 2 * len(es) + 1 if hi is None else 2 * es.index(hi) + 2)

    def spans(borders: dict, todo: dict) -> list[tuple]:
        return sorted({(g, i) for (g, k), w in todo.items() for i in segments(borders[g], w)})

    def totals(counts: DataFrame) -> dict:
        """Rows before and in each segment of each group, and what else was counted there."""
        before, out = {}, {}
        for r in sorted(counts.collect(), key=lambda r: (r["_g"], r["_s"])):
            out[r["_g"], r["_s"]] = (before.get(r["_g"], 0), r)
            before[r["_g"]] = before.get(r["_g"], 0) + r["c"]
        return out

    def at(tot: dict, g: str, k: int) -> int:
        """The segment that holds rank ``k``."""
        return next(s for (h, s), (b, r) in tot.items() if h == g and b <= k < b + r["c"])

    while any(sizes[w] > BRACKET_ROWS and lo != hi for w, (lo, hi) in brackets.items()):
        borders, seen = placed(brackets)
        tot = totals(seen.groupBy("_g", "_s").agg(F.count(F.lit(1)).alias("c"), _grid(value).alias("b")))
        narrower = {}
        for (g, k), (lo, hi) in brackets.items():
            s = at(tot, g, k)
            b, r = tot[g, s]
            es = borders[g]
            if s % 2:  # the rank's value is the border itself
                narrower[g, k], sizes[g, k] = (es[s // 2], es[s // 2]), r["c"]
                continue
            a, z = _around(r["b"], r["c"], k - b)
            lo = (es[s // 2 - 1] if s else None) if a is None else a
            hi = (es[s // 2] if s // 2 < len(es) else None) if z is None else z
            narrower[g, k], sizes[g, k] = (lo, hi), r["c"] if r["c"] <= GRID else r["c"] * (2 * MARGIN + 4) // GRID
        if narrower == brackets:
            break
        brackets = narrower
    todo = brackets
    while todo:
        borders, seen = placed(todo)
        keep = F.lit(False)
        for g in borders:
            keep = keep | ((F.col("_g") == g) & F.col("_s").isin([s for h, s in spans(borders, todo) if h == g]))
        counts = seen.groupBy("_g", "_s", F.when(keep, x).alias("_v")).agg(F.count(F.lit(1)).alias("_c")).checkpoint()
        tot = totals(counts.groupBy("_g", "_s").agg(F.sum("_c").alias("c")))
        wanted, missed = {}, {}
        for (g, k), w in todo.items():
            s = at(tot, g, k)
            before = tot[g, s][0]
            if s % 2:
                result[g][1][k] = (borders[g][s // 2], before)
            elif s in segments(borders[g], w):
                wanted.setdefault((g, s), []).append(k - before)
            else:
                missed[g, k] = (None, None)
        pick = F.lit(False)
        for (g, s), ks in wanted.items():
            holds = [(F.col("_run") > k) & (F.col("_run") - F.col("_c") <= k) for k in ks]
            any_of = holds[0]
            for h in holds[1:]:
                any_of = any_of | h
            pick = pick | ((F.col("_g") == g) & (F.col("_s") == s) & any_of)
        run = Window.partitionBy("_g", "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        near = F.lit(False)
        for g, s in wanted:
            near = near | ((F.col("_g") == g) & (F.col("_s") == s))
        hits = counts.where(near).withColumn("_run", F.sum("_c").over(run)).where(pick).collect() if wanted else []
        for h in hits:
            g, s = h["_g"], h["_s"]
            before = tot[g, s][0]
            for k in wanted[g, s]:
                if h["_run"] - h["_c"] <= k < h["_run"]:
                    result[g][1][k + before] = (h["_v"], before + h["_run"] - h["_c"])
        todo = missed
    return result


def stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Several numeric columns as one long table (_g, _v)."""
    parts = F.array(*[F.struct(F.lit(c).alias("_g"), F.col(c).cast("double").alias("_v"))
                      for c in columns])
    long = df.select(F.explode(parts).alias("_s")).select("_s._g", "_s._v")
    return long.where(F.col("_v").isNotNull())


def value_at_rank(df: DataFrame, value: str, rank: int):
    """T4: the value at a 0-based rank, exact, without sorting the table."""
    rows = df.select(F.lit("v").alias("_g"), F.col(value).alias("_v"))
    return _locate_groups(rows, "_v", lambda g, n: [rank])["v"][1][rank][0]


def _interp(n: int, found: dict, probs: Sequence[float]) -> list[float | None]:
    if n == 0:
        return [None] * len(probs)
    res = []
    for p in probs:
        pos = p * (n - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        vlo, vhi = float(found[lo][0]), float(found[hi][0])
        res.append(vlo + (pos - lo) * (vhi - vlo))
    return res


def _quantile_ranks(probs):
    def ranks(_g, n):
        out = []
        for p in probs:
            pos = p * (n - 1)
            out += [math.floor(pos), math.ceil(pos)]
        return out
    return ranks


def multi_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    ) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns at once (two jobs in all)."""
    found = _locate_groups(stacked(df, columns), "_v", _quantile_ranks(probs))
    return {c: _interp(*found.get(c, (0, {})), probs) for c in columns}


def global_quantiles(df: DataFrame, value: str, probs: Sequence[float]) -> list[float | None]:
    """Exact quantiles of one column, linear interpolation (numpy default,
    DuckDB ``quantile_cont``), nulls ignored. Returns Python floats."""
    return multi_quantiles(df, [value], probs)[value]


def qcut_edges(df: DataFrame, value: str, q: int) -> list[float]:
    """q+1 edges at probabilities 0, 1/q, ..., 1; duplicate edges raise, as in pandas."""
    edges = global_quantiles(df, value, [i / q for i in range(q + 1)])
    if len(set(edges)) < len(edges):
        raise ValueError(f"qcut: bin edges must be unique: {edges}")
    return edges


def qcut_label(x: Column | str, edges: Sequence[float], labels: Sequence) -> Column:
    """Right-closed bins with the lowest edge included (pandas ``qcut``/``cut``)."""
    x = F.col(x) if isinstance(x, str) else x
    expr = None
    for e, lab in zip(edges[1:-1], labels[:-1]):
        cond = x <= F.lit(e)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    last = F.lit(labels[-1])
    expr = last if expr is None else expr.otherwise(last)
    return F.when(x.isNull(), F.lit(None)).otherwise(expr)


def qcut(df: DataFrame, value: str, labels: Sequence, out: str) -> DataFrame:
    """Quantile binning of ``value`` into len(labels) bins."""
    return df.withColumn(out, qcut_label(value, qcut_edges(df, value, len(labels)), labels))


def first_rank_thresholds(df: DataFrame, value: str, key: str, q: int) -> list[tuple]:
    """The q-1 (value, key) pairs closing the bins of
    ``qcut(x.rank(method="first"), q)`` with ties broken by ``key``."""
    return multi_first_rank_thresholds(df, [value], key, q)[value]


def multi_first_rank_thresholds(df: DataFrame, columns: Sequence[str], key: str, q: int,
                                quantile_columns: dict[str, Sequence[float]] | None = None):
    """First-rank bin thresholds for several columns (four jobs in all).

    Ranks 1..n have edges 1 + i(n-1)/q, so a row falls in a bin <= i exactly
    when its 1-based rank is <= m_i = 1 + floor(i(n-1)/q). The row at rank m_i
    is found in two exact steps: the value at that rank, then the key at the
    remaining position among the rows tied on that value. Nothing numbers the
    whole table.

    ``quantile_columns`` ({column: probs}) rides along in the first step, so
    plain quantiles of other columns cost no extra job; the return value is
    then ``(thresholds, quantiles)``.
    """
    quantile_columns = dict(quantile_columns or {})
    kq = lambda n: [(i * (n - 1)) // q for i in range(1, q)]
    qranks = {c: _quantile_ranks(p) for c, p in quantile_columns.items()}

    def ranks(g, n):
        return qranks[g](g, n) if g in qranks else kq(n)

    step1 = _locate_groups(stacked(df, list(columns) + list(quantile_columns)), "_v", ranks)
    qout = {c: _interp(*step1.get(c, (0, {})), p) for c, p in quantile_columns.items()}
    ties, tie_rank = [], {}
    for c in columns:
        n, found = step1.get(c, (0, {}))
        for i, k in enumerate(kq(n) if n else []):
            v, before = found[k]
            gid = f"{c}|{i}"
            ties.append((gid, c, v))
            tie_rank[gid] = k - before
    out = {c: [] for c in columns}
    if ties:
        tags = F.array_compact(F.array(*[F.when(F.col(c).cast("double") == F.lit(v), F.lit(gid)) for gid, c, v in ties]))
        tied = df.select(F.explode(tags).alias("_g"), F.col(key).alias("_key"))
        if isinstance(df.schema[key].dataType, (StringType, BinaryType)):
            keys = text_at_rank(tied, tie_rank)
        else:
            step2 = _locate_groups(tied, "_key", lambda g, n: [tie_rank[g]])
            keys = {g: step2[g][1][tie_rank[g]][0] for g in tie_rank}
        for gid, c, v in ties:
            out[c].append((v, keys[gid]))
    return (out, qout) if quantile_columns else out


#: Bytes of a text key that one round of ``text_at_rank`` looks at (an exact double).
KEY_BYTES = 6


def text_at_rank(rows: DataFrame, ranks: dict[str, int]) -> dict[str, str]:
    """The text key at a rank of each group of (_g, _key), in byte order.

    Each round looks at the next six bytes as a number, finds the number at
    the rank, and goes on with the rows that have it and the rank among them.
    The rounds end with the longest key that is left.
    """
    def chunk(j: int) -> Column:
        part = F.hex(F.substring(F.col("_key").cast("binary"), j * KEY_BYTES + 1, KEY_BYTES))
        return F.conv(F.rpad(part, 2 * KEY_BYTES, "0"), 16, 10).cast("long").cast("double")

    left, at, j = rows, dict(ranks), 0
    while True:
        found = _locate_groups(left.select("_g", chunk(j).alias("_c")), "_c", lambda g, n: [at[g]])
        same = F.lit(False)
        for g, rank in at.items():
            value, before = found[g][1][rank]
            at[g] = rank - before
            same = same | ((F.col("_g") == g) & (chunk(j) == F.lit(value)))
        left = left.where(same)
        ends = left.groupBy("_g").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi")).collect()
        if all(e["lo"] == e["hi"] for e in ends):
            return {e["_g"]: e["lo"] for e in ends}
        j += 1


def first_rank_label(value: str, key: str, thresholds: Sequence[tuple],
                     labels: Sequence) -> Column:
    xv, kv = F.col(value), F.col(key)
    above = F.lit(0)
    for v, k in thresholds:
        above = above + F.when((xv > F.lit(v)) | ((xv == F.lit(v)) & (kv > F.lit(k))), 1).otherwise(0)
    expr = None
    for i, lab in enumerate(labels):
        expr = F.when(above == i, F.lit(lab)) if expr is None else expr.when(above == i, F.lit(lab))
    return F.when(xv.isNull(), F.lit(None)).otherwise(expr)


def qcut_first_rank(df: DataFrame, value: str, key: str, labels: Sequence, out: str) -> DataFrame:
    """W1+W2 on one column; see :func:`first_rank_thresholds`."""
    thr = first_rank_thresholds(df, value, key, len(labels))
    return df.withColumn(out, first_rank_label(value, key, thr, labels))
