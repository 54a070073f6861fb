"""Average ranks of rows that are dealt over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import with_checkpoints


def sums_before(rows: DataFrame, keys: Sequence[str], at: str, value: str, levels: int) -> DataFrame:
    """(keys, at, before): the sum of ``value`` over the rows of smaller ``at``, whole numbers below 2 ** levels.

    A tree in place of a running sum: a row counts for the block of each size 1, 2, 4, ...
    that holds it, and the rows before it are made up of one block for each bit of ``at``.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_level")
    block = F.expr(f"shiftright({at}, _level)")
    blocks = rows.select(*keys, at, value, level).withColumn("_block", block).groupBy(*keys, "_level", "_block").agg(F.sum(value).alias("_sum"))
    asked = rows.select(*keys, at, level).withColumn("_block", block - 1).where(F.expr(f"shiftright({at}, _level) % 2 = 1"))
    found = asked.join(blocks, [*keys, "_level", "_block"]).groupBy(*keys, at).agg(F.sum("_sum").alias("before"))
    return rows.select(*keys, at).join(found, [*keys, at], "left").select(*keys, at, F.coalesce("before", F.lit(0)).alias("before"))


def with_average_rank(rows: DataFrame, value: str, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` with the rank of ``value`` among the rows of the same keys, ties sharing their mean; null for null.

    Distinct values are counted and dealt by range; a rank is what all partitions before
    hold, what the own one holds before the value, and half of the value's own rows.
    """
    with_checkpoints(rows.sparkSession)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    # which partition has a value is written down, as a task that is run again may see other bounds
    dealt = counts.repartitionByRange(tasks, *keys, value).withColumn("_task", F.spark_partition_id()).checkpoint()
    sizes = dealt.groupBy(*keys, "_task").agg(F.sum("_n").alias("_n"))
    offsets = sums_before(sizes, keys, "_task", "_n", max(1, (tasks - 1).bit_length()))
    run = Window.partitionBy(*keys, "_task").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_low", F.coalesce(F.sum("_n").over(run), F.lit(0)))
    ranks = local.join(offsets, [*keys, "_task"]).select(*keys, value, (F.col("before") + F.col("_low") + (F.col("_n") + 1) / 2.0).alias(name))
    return rows.join(ranks, [*keys, value], "left").select(*rows.columns, name)
