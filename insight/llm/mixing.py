"""Mixing sources to target weights by weighted fair queueing, all in DataFrame functions.

Each source queues its documents in a shuffled order (a hash of the id), up to
``max_epochs`` times over. An item's virtual finish time is the source's
cumulative tokens through it divided by the source's weight. The mix is all
items in global order of finish time, cut where the budget (all tokens once)
is spent. A source that has used up its epochs leaves the queue, so its share
passes to the others by weight, which is the water-filling that ``targets``
computes in closed form.

Scale: cumulative sums and the cut are prefix sums over buckets of about
``BUCKET`` rows. Bucket totals are one row per bucket; no window holds a whole
source and no task holds the whole order.

Defined cases: a null or empty text has size 0 and is never taken; a null
source is a source of its own, ordered last; rows that repeat count each by
itself; ties in the hash go by id, then size; an empty table gives no rows.
Only id, source and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from insight.llm.common import row_keys, word_count, written

#: Rows per bucket of a prefix sum.
BUCKET = 5_000
#: Ranges of finish time looked at in one round of the search for the cut.
SLOTS = 2_048
#: Width in bits of the shuffle hash (15 hex digits of md5).
HASH_RANGE = float(1 << 60)


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, u): word count and the shuffle hash."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 15), 16, 10)
         .cast("long").alias("u"))


def targets(rows: DataFrame, n_weights: int = 3, max_epochs: int = 3) -> DataFrame:
    """One row per source: size, weight (1..n repeating, by code point, null last), target.

    A target is ``min(weight * level, max_epochs * size)``; the level spends
    the total. Sources sorted by their cap per weight give the level directly:
    it is the largest of the levels that would hold if all earlier ones were capped.
    The two windows run over one row per source.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", (1 + (rank - 1) % n_weights).cast("long"))
    cap = F.lit(max_epochs) * F.col("source_size")
    by_cap = W.orderBy((cap / F.col("weight")).asc(), F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = ((total - F.coalesce(F.sum(cap).over(before), F.lit(0))).cast("double")
             / F.sum("weight").over(onward).cast("double"))
    per = per.withColumn("level_here", level).withColumn("total", total)
    per = per.withColumn("level", F.max("level_here").over(everything))
    return per.select("source", "source_size", "n_rows", "weight", "total",
                      F.least(F.col("weight") * F.col("level"), cap.cast("double")).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def queued(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's figures and ``cum``, the source's tokens through the row.

    Rows are bucketed by the hash inside each source, the number of buckets
    following the source's row count, so a source with a third of all rows is
    as many tasks' work as its rows need.
    """
    s = sources.select(F.col("source").alias("s_source"), "source_size", "n_rows", "weight", "target")
    rows = rows.join(s, _same(F.col("source"), F.col("s_source"))).drop("s_source")
    n_buckets = F.ceil(F.col("n_rows") / F.lit(BUCKET))
    rows = rows.withColumn("bucket", F.floor(F.col("u") / F.lit(HASH_RANGE) * n_buckets))
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("b_size"))
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("t_source"), F.col("bucket").alias("t_bucket"),
                           F.coalesce(F.sum("b_size").over(ahead), F.lit(0)).alias("offset"))
    inside = W.partitionBy("source", "bucket").orderBy("u", "doc_id", "size") \
              .rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("within", F.sum("size").over(inside))
    return (rows.join(totals, _same(F.col("source"), F.col("t_source")) & (F.col("bucket") == F.col("t_bucket")))
            .withColumn("cum", F.col("offset") + F.col("within"))
            .drop("t_source", "t_bucket", "offset", "within", "bucket"))


def finish_time(epoch: Column) -> Column:
    return (F.col("cum") + epoch * F.col("source_size")).cast("double") / F.col("weight").cast("double")


#: The global order of items.
ORDER = ("finish", "u", "doc_id", "size", "epoch")


def items(queue: DataFrame, max_epochs: int = 3) -> DataFrame:
    """One row per document and epoch with its finish time (documents without words queue nothing)."""
    epochs = F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))
    return (queue.filter(F.col("size") > 0).select("doc_id", "u", "size", "cum", "source_size", "weight", epochs.alias("epoch"))
            .select("doc_id", "u", "size", "epoch", finish_time(F.col("epoch")).alias("finish")))


def cut(queue: DataFrame, budget: int, max_epochs: int = 3) -> tuple | None:
    """Sort key of the last item, in global order, that the budget still holds.

    Each round cuts a range of finish times into ``SLOTS`` equal ones, whose
    totals (at most ``SLOTS`` rows) tell which slot the budget ends in; that
    slot is the next round's range. The last range, of at most ``BUCKET``
    items or of equal finish times, is summed item by item.
    """
    line = items(queue, max_epochs)
    whole = line.agg(F.min("finish").alias("lo"), F.max("finish").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi, n, spent, last = whole["lo"], whole["hi"], whole["n"], 0, None
    while n > BUCKET and hi > lo:
        slot = F.floor((F.col("finish") - F.lit(lo)) / F.lit(hi - lo) * F.lit(SLOTS))
        slots = (line.filter(F.col("finish").between(lo, hi)).groupBy(slot.alias("slot"))
                 .agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"), F.min("finish").alias("lo"),
                      F.max("finish").alias("hi"), F.max(F.struct(*ORDER)).alias("last")).collect())
        n = 0
        for row in sorted(slots, key=lambda r: r["slot"]):
            if spent + row["s"] > budget:
                lo, hi, n = row["lo"], row["hi"], row["n"]
                break
            spent, last = spent + row["s"], row["last"]
        if len(slots) == 1:
            break
    if n:
        acc = F.sum("size").over(W.orderBy(*ORDER).rowsBetween(W.unboundedPreceding, W.currentRow))
        within = (line.filter(F.col("finish").between(lo, hi)).withColumn("acc", acc + F.lit(spent))
                  .filter(F.col("acc") <= budget).agg(F.max(F.struct(*ORDER)).alias("last")).first()["last"])
        last = within if within is not None else last
    return tuple(last) if last is not None else None


def taken_epochs(key: tuple | None, id_type: str, max_epochs: int = 3) -> Column:
    """How many times a queued row is in the mix, given the last item's sort key."""
    if key is None:
        return F.lit(0).cast("long")
    end = F.struct(*[F.lit(v).cast(t) for v, t in zip(key, ("double", "long", id_type, "long", "int"))])
    hits = [F.when((F.col("size") > 0) & (F.struct(finish_time(F.lit(e)), F.col("u"), F.col("doc_id"),
                                                   F.col("size"), F.lit(e)) <= end), 1).otherwise(0)
            for e in range(max_epochs)]
    return reduce(lambda a, b: a + b, hits).cast("long")


def plan(docs: DataFrame, n_weights: int = 3, max_epochs: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs) for every row of ``docs``."""
    rows = written(sized(docs, id_col), "mix-sizes")
    sources = written(targets(rows, n_weights, max_epochs), "mix-sources")
    budget = sources.agg(F.max("total").alias("t")).first()["t"] or 0
    queue = written(queued(rows, sources), "mix-queue")
    key = cut(queue, int(budget), max_epochs)
    return queue.select("doc_id", "source", "size", "source_size", "target",
                        taken_epochs(key, dict(queue.dtypes)["doc_id"], max_epochs).alias("epochs"))


def mix(docs: DataFrame, n_weights: int = 3, max_epochs: int = 3) -> DataFrame:
    """The mix itself: each taken document as often as it is taken, with the columns of ``docs``.

    Rows that share an id, or have none, are mixed each by itself.
    """
    keyed, key = row_keys(docs)
    chosen = (plan(keyed, n_weights, max_epochs, key).filter("epochs > 0")
              .select(F.col("doc_id").alias(key + "id"), F.explode(F.sequence(F.lit(1), F.col("epochs").cast("int"))).alias(key + "epoch")))
    return (keyed.join(chosen, keyed[key] == F.col(key + "id"))
            .select(*[keyed[c] for c in docs.columns]))
