"""Joins that need a written strategy: ranges, order, next anchor, mutual best."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import with_checkpoints

#: Length of a bucket of time, an hour in microseconds.
BUCKET = 3_600_000_000
#: Rows, of all values of the keys together, that mutual_best puts in order instead of taking more rounds.
LAST = 1 << 18


def bucketed_range_join(points: DataFrame, ranges: DataFrame, keys: Sequence[str], time: str, low: str, high: str, width: int) -> DataFrame:
    """Inner join on ``keys`` where low <= time < high, all integers.

    A bare range predicate is a nested loop over both sides.  Here a range is put
    into every bucket of ``width`` that it touches and a point into its own, so the
    join is an equality on (keys, bucket) and the range only a filter; ``width``
    about the length of the ranges makes two copies of each range.  The bucket also
    spreads one hot key over its times.
    """
    first, last = F.floor(F.col(low) / width), F.floor((F.col(high) - 1) / width)
    spread = ranges.where(F.col(low) < F.col(high)).withColumn("_bucket", F.explode(F.sequence(first, last)))
    keyed = points.withColumn("_bucket", F.floor(F.col(time) / width))
    joined = keyed.join(spread, [*keys, "_bucket"])
    return joined.where((F.col(time) >= F.col(low)) & (F.col(time) < F.col(high))).drop("_bucket")


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "ord") -> DataFrame:
    """``df`` with the row's number, from 1, among the rows of its keys."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def ordinal_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str], right_order: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins the k-th row of the left with the k-th of the right for each value of the keys."""
    return ordinal(left, keys, left_order).join(ordinal(right, keys, right_order), [*keys, "ord"], how)


def anchor_before(points: DataFrame, anchors: DataFrame, keys: Sequence[str], time: str, anchor: str, anchor_time: str, width: int = BUCKET) -> DataFrame:
    """``points`` with the anchor whose interval [own time, next anchor's time) holds the point, null before the first.

    Both sides are read in one order of time, anchors first on equal times, inside
    buckets of ``width``, so a hot key is spread over its times.  To the points before a
    bucket's first anchor the last one of the buckets before is carried, over one row for
    each key and bucket.  Equal times go to the greatest anchor; null anchors are none.
    """
    kind = anchors.schema[anchor].dataType
    bucket = lambda t: F.floor(F.col(t) / width).alias("_bucket")
    mine = points.select(*points.columns, bucket(time), F.lit(1).alias("_side"), F.col(time).alias("_t"), F.lit(None).cast(kind).alias("_a"))
    theirs = anchors.where(F.col(anchor).isNotNull()).select(*keys, bucket(anchor_time), F.lit(0).alias("_side"), F.col(anchor_time).alias("_t"), F.col(anchor).alias("_a"))
    both = mine.unionByName(theirs, allowMissingColumns=True)
    order = Window.partitionBy(*keys, "_bucket").orderBy("_t", "_side", "_a").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = both.withColumn("_in", F.last("_a", ignorenulls=True).over(order)).where("_side = 1")
    # a null where a bucket has points only
    ends = both.groupBy(*keys, "_bucket").agg(F.max(F.when(F.col("_side") == 0, F.struct("_t", "_a")))["_a"].alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).where(F.col("_carried").isNotNull())
    rows, told = inside.alias("p"), carried.select(*keys, "_bucket", "_carried").alias("c")
    on = F.col("p._bucket") == F.col("c._bucket")
    for k in keys:
        on &= F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}"))
    return rows.join(told, on, "left").select(*(F.col(f"p.{c}") for c in points.columns), F.coalesce("p._in", "c._carried").alias(anchor))


def _in_order(left: str, right: str, score: str) -> Callable[[pa.Table], pa.Table]:
    """Pairs of one value of the keys from the best score down, of equal ones by the smaller ids, each unless a side of it is gone.

    They are the mutual best of all rounds: no row before a mutual best has a side of it,
    and the first row that is left is always one.
    """

    def taken(rows: pa.Table) -> pa.Table:
        values = rows[score].to_pandas().to_numpy(float)
        missing = rows[score].is_null().to_numpy()
        a, b = (np.unique(rows[c].to_pandas().to_numpy(), return_inverse=True)[1] for c in (left, right))
        # as Spark sorts down: NaN before numbers, nulls last
        order = np.lexsort((b, a, -values, ~np.isnan(values), missing))
        gone_a, gone_b, held = set(), set(), []
        for row, p, q in zip(order.tolist(), a[order].tolist(), b[order].tolist()):
            if p not in gone_a and q not in gone_b:
                gone_a.add(p)
                gone_b.add(q)
                held.append(row)
        return rows.take(pa.array(held, pa.int64()))

    return taken


def mutual_best(pairs: DataFrame, keys: Sequence[str], left: str, right: str, score: str) -> DataFrame:
    """One-to-one pairs: rows that are the best of both their sides, taken out, until none is left.

    Equal scores go to the smaller ids.  Where a group of lefts and a group of rights
    have each other, and nothing else, as their best, all are taken in one round, the
    k-th with the k-th, as rounds of one pair each would.  Every round is cut off by
    a checkpoint.  Rows that are LAST or fewer in all take no more rounds: see _in_order.
    """
    of_left, of_right = Window.partitionBy(*keys, left), Window.partitionBy(*keys, right)
    with_checkpoints(pairs.sparkSession)
    pairs = pairs.checkpoint()  # the scores are computed once
    rest, found, done = pairs, None, 0
    while True:
        if rest.count() <= LAST:
            taken = rest.groupBy(*keys).applyInArrow(_in_order(left, right, score), pairs.schema).checkpoint()
            return taken if found is None else found.unionByName(taken)
        ranked = rest
        # each side's best, what is best on it as a set: all that a side is dealt for comes one after the other
        for rank, top, name, other, side in (("_l", "_tl", "_sl", right, of_left), ("_r", "_tr", "_sr", left, of_right)):
            ranked = ranked.withColumn(rank, F.row_number().over(side.orderBy(F.desc(score), other))).withColumn(top, F.col(score) == F.max(score).over(side))
            ranked = ranked.withColumn(name, F.struct(F.count(F.when(F.col(top), 1)).over(side).alias("n"), F.bit_xor(F.when(F.col(top), F.xxhash64(other))).over(side).alias("h")))
        # what is best on neither side says nothing about those that are
        first = (F.col("_l") == 1) & (F.col("_r") == 1)
        ranked = ranked.where(first | F.coalesce("_tl", F.lit(False)) | F.coalesce("_tr", F.lit(False)))
        # the best ones of a side all have this side among their best, and the same set of best
        for name, top, back, theirs, side in (("_cl", "_tl", "_tr", "_sr", of_left), ("_cr", "_tr", "_tl", "_sl", of_right)):
            theirs = F.when(F.col(top), F.col(theirs))
            ranked = ranked.withColumn(name, F.min(F.when(F.col(top), F.col(back))).over(side) & (F.min(theirs).over(side) == F.max(theirs).over(side)))
        tied = F.col("_tl") & F.col("_tr") & F.col("_cl") & F.col("_cr") & (F.col("_l") == F.col("_r"))
        taken = ranked.where(tied | first).select(*pairs.columns).checkpoint()
        if taken.isEmpty():
            break
        done += 1
        found = taken if found is None else found.unionByName(taken)
        if done % 20 == 0:
            found = found.checkpoint()
        rest = rest.join(taken.select(*keys, left), [*keys, left], "left_anti").join(taken.select(*keys, right), [*keys, right], "left_anti").checkpoint()
    return pairs.limit(0) if found is None else found


def update_join(original: DataFrame, updates: DataFrame, key: str, flags: Sequence[str] = (), keep: str | None = "keep") -> DataFrame:
    """Patches rows: where an update has the key its columns take over, nulls too; new columns are added.

    Boolean ``flags`` that an update leaves null become false; rows whose ``keep``
    is false are dropped.  Unknown keys are given by ``unknown_updates``.
    """
    marked = updates.select(F.col(key), F.lit(True).alias("_hit"), *(F.col(c).alias(f"_new_{c}") for c in updates.columns if c != key))
    joined = original.join(marked, key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    columns = [F.col(key)]
    for c in [x for x in original.columns if x != key] + [x for x in updates.columns if x not in original.columns]:
        if c not in updates.columns:
            columns.append(F.col(c))
            continue
        new = F.coalesce(F.col(f"_new_{c}"), F.lit(False)) if c in flags else F.col(f"_new_{c}")
        columns.append(F.when(hit, new).otherwise(F.col(c) if c in original.columns else F.lit(None)).alias(c))
    patched = joined.select(*columns)
    return patched.where(F.coalesce(F.col(keep), F.lit(True))).drop(keep) if keep in updates.columns else patched


def unknown_updates(original: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    return updates.join(original, key, "left_anti")


def reconcile(declared: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, with the side's name."""
    both = declared.select(key, F.lit(True).alias("d")).distinct().join(found.select(key, F.lit(True).alias("f")).distinct(), key, "full_outer")
    return both.where(F.col("d").isNull() | F.col("f").isNull()).select(key, F.when(F.col("d").isNull(), "found_only").otherwise("declared_only").alias("side"))
