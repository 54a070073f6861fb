"""Statistics as aggregate and window expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: z beyond which a one-sided normal tail is under 0.001.
Z_OF_P_001 = 3.090232306167813


def average_rank(value: str | Column, keys: Sequence[str]) -> Column:
    """Rank with ties sharing their mean."""
    value = F.col(value) if isinstance(value, str) else value
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, value))
    return F.rank().over(Window.partitionBy(*keys).orderBy(value)) + (ties - 1) / 2.0


def safe_corr(x: Column, y: Column, least: int = 3) -> Column:
    """Pearson correlation over pairs without nulls; null for fewer than ``least`` or no variance."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    fine = (F.count(a) >= least) & (F.var_pop(a) > 1e-18) & (F.var_pop(b) > 1e-18)
    return F.when(fine, F.covar_pop(a, b) / (F.stddev_pop(a) * F.stddev_pop(b)))


def spearman_brown(r: Column) -> Column:
    return F.when(r > -1, 2 * r / (1 + r))


def rank_sum(histogram: DataFrame, keys: Sequence[str], value: str, base: str, response: str, trials: str) -> DataFrame:
    """One-sided Mann-Whitney test of base < response from a histogram of counts per side.

    Rows (keys, value, base, response, trials): how many trials have the value on
    either side; ``trials`` is the number of trials of each side.  Gives u, z and
    ``responsive`` (p under 0.001): the normal law with ties and continuity, and the
    exact law where it applies (up to eight trials without ties).
    """
    t = F.col(base) + F.col(response)
    before = F.coalesce(F.sum(t).over(Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = histogram.withColumn("_t", t).withColumn("_rank", before + (t + 1) / 2.0)
    n = F.first(trials).cast("double")
    sums = rows.groupBy(*keys).agg(
        n.alias("n"), F.sum(F.col("_rank") * F.col(base)).alias("_r"), F.sum(F.col("_t").cast("double") * F.col("_t") * F.col("_t") - F.col("_t")).alias("_ties"),
        (F.sum(F.col(value) * F.col(base)) / n).alias("mean_base"), (F.sum(F.col(value) * F.col(response)) / n).alias("mean_response"), F.max("_t").alias("_most"),
    )
    n = F.col("n")
    u = F.col("_r") - n * (n + 1) / 2
    spread = F.sqrt(n * n / 12 * ((2 * n + 1) - F.col("_ties") / (2 * n * (2 * n - 1))))
    z = F.when(spread > 0, (n * n - u - n * n / 2 - 0.5) / spread)
    exact = F.when(n <= 6, F.lit(False)).when(n <= 7, u <= 1).otherwise(u <= 4)
    small = F.when((n <= 8) & (F.col("_most") == 1), exact).otherwise(F.coalesce(z > Z_OF_P_001, F.lit(False)))
    return sums.select(*keys, "mean_base", "mean_response", u.alias("u"), z.alias("z"), ((n >= 5) & (F.col("mean_response") > F.col("mean_base")) & small).alias("responsive"))


def ks_statistic(samples: DataFrame, keys: Sequence[str], value: str, side: str, first: str, second: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance and its asymptotic p, for rows labelled with a side."""
    counts = samples.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count_if(F.col(side) == first).alias("_a"), F.count_if(F.col(side) == second).alias("_b"))
    run = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    gap = F.abs(F.sum("_a").over(run) / F.sum("_a").over(whole) - F.sum("_b").over(run) / F.sum("_b").over(whole))
    found = counts.withColumn("_gap", gap).groupBy(*keys).agg(F.max("_gap").alias("d"), F.sum("_a").alias("n1"), F.sum("_b").alias("n2"))
    x = F.sqrt(F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2"))) * F.col("d")
    series = sum((2 * (-1) ** (k - 1) * F.exp(-2.0 * k * k * x * x) for k in range(1, 51)), F.lit(0.0))
    return found.withColumn("p", F.when(x < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))))


def hash_order(seed: int | Column, *keys: str) -> Column:
    """A digest to order rows by: the same on every engine, in place of a random number."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat_ws(":", seed.cast("string"), *(F.col(k).cast("string") for k in keys)))
