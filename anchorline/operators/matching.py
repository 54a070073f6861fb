"""One-to-one matching of two spike trains in bounded buckets of time.

The earliest spike of ``a`` takes the nearest unused spike of ``b`` within a tolerance,
then the next one.  What a bucket needs to know of those before it is which spikes of
``b`` near its beginning are used.  All buckets are matched at once as if none were; the
used spikes near a bucket's end are told to the bucket after it, and the buckets that
were told something else than they had taken are matched again, until none is.  The first
bucket of a train never is, so after each round one more bucket is surely right, and as a
wrong guess is forgotten at the next pause of the train, few rounds are needed; a train in
which every choice hangs on the one before takes a round for each of its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import with_checkpoints

MATCHED = "tp long, used array<long>"


def greedy(xs: Sequence[int], ys: Sequence[int], used: Sequence[int], tolerance: int, after: int) -> tuple[int, list[int]]:
    """How many of the sorted ``xs`` find a partner among the sorted ``ys``, of which ``used`` are gone, and the used ones from ``after`` on."""
    taken, low, hits = bytearray(len(ys)), 0, 0
    gone = list(used)
    for j, y in enumerate(ys):
        if gone and y in gone:
            gone.remove(y)
            taken[j] = 1
    for x in xs:
        while low < len(ys) and (taken[low] or ys[low] < x - tolerance):
            low += 1
        best, j = -1, low
        while j < len(ys) and ys[j] <= x + tolerance:
            if not taken[j]:
                if best < 0 or abs(ys[j] - x) < abs(ys[best] - x):
                    best = j
                # beyond the first unused one at or after x none is nearer
                if ys[j] >= x:
                    break
            j += 1
        if best >= 0:
            taken[best] = 1
            hits += 1
    return hits, [y for y, t in zip(ys, taken) if t and y >= after]


def bucketed(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance: int, width: int) -> DataFrame:
    """(keys, bucket, xs, ys): a bucket's spikes of ``a`` and those of ``b`` that can be their partners."""
    left = a.select(*keys, F.floor(F.col("t") / width).alias("bucket"), "t", F.lit(0).alias("side"))
    first, last = F.floor((F.col("t") - tolerance) / width), F.floor((F.col("t") + tolerance) / width)
    right = b.select(*keys, F.explode(F.sequence(first, last)).alias("bucket"), "t", F.lit(1).alias("side"))
    of = lambda side: F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("t"))))
    found = left.unionByName(right).groupBy(*keys, "bucket").agg(of(0).alias("xs"), of(1).alias("ys"))
    return found.where((F.size("xs") > 0) & (F.size("ys") > 0))


def spike_matches(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance: int, width: int | None = None) -> DataFrame:
    """(keys, tp): spikes of b matched one to one to those of a, the earliest a first, each to the nearest unused b.

    ``width`` is the length of a bucket, by default 4096 times the tolerance.  A key of
    ``a`` or ``b`` alone has no matches and a row with zero.
    """
    width = max(width or 4096 * tolerance, 2 * tolerance + 1, 1)
    with_checkpoints(a.sparkSession)

    @F.pandas_udf(MATCHED)
    def matched(xs: pd.Series, ys: pd.Series, used: pd.Series, after: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([greedy(*row[:3], tolerance, row[3]) for row in zip(xs, ys, used, after)], columns=["tp", "used"])

    after = (F.col("bucket") + 1) * width - tolerance
    trains = bucketed(a, b, keys, tolerance, width).withColumn("_after", after).checkpoint()
    none = F.array().cast("array<long>")
    on = [*keys, "bucket"]

    def told(rows: DataFrame) -> DataFrame:
        """Rows (keys, bucket, was, xs, ys, _after) matched under what they were told."""
        return rows.withColumn("m", matched("xs", "ys", "was", "_after")).select(*on, "was", "m.tp", "m.used").checkpoint()

    state = told(trains.withColumn("was", none))
    while True:
        before = state.select(*keys, (F.col("bucket") + 1).alias("bucket"), F.col("used").alias("_now")).where(F.size("_now") > 0)
        now = state.join(before, on, "left").withColumn("_now", F.coalesce("_now", none))
        wrong = now.where(F.col("_now") != F.col("was")).select(*on, F.col("_now").alias("was")).checkpoint()
        if wrong.isEmpty():
            break
        again = told(trains.join(wrong, on))
        state = state.join(again.select(*on), on, "left_anti").unionByName(again).checkpoint()
    every = a.select(*keys).unionByName(b.select(*keys)).distinct()
    hits = state.groupBy(*keys).agg(F.sum("tp").alias("tp"))
    return every.join(hits, list(keys), "left").select(*keys, F.coalesce("tp", F.lit(0)).cast("long").alias("tp"))
