"""Similarity matrices, their comparison, split halves and ablation grids."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import with_average_rank
from ..functions.stats import hash_order, safe_corr, spearman_brown
from ..session import with_checkpoints

#: Stimuli, and units, of a block.
TILE = 128


def means(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of ``value`` per (keys, stim, unit)."""
    return rows.groupBy(*keys, "stim", "unit").agg(F.avg("value").alias("value"))


def varying(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Only the units whose values are not all the same."""
    fine = rows.groupBy(*keys, "unit").agg(F.var_pop("value").alias("_v")).where("_v > 1e-18")
    return rows.join(fine.select(*keys, "unit"), [*keys, "unit"], "left_semi")


def rsm(mean: DataFrame, keys: Sequence[str] = (), tile: int = TILE) -> DataFrame:
    """Pearson correlation across units of every two stimuli, the larger first.

    Each stimulus is centred and scaled once; a pair is then one sum of products, found
    as a product of matrices: stimuli and units are dealt into blocks of about ``tile``,
    a row goes to the pairs of stimulus blocks that its own is in, a pair of blocks is
    multiplied inside a task, and a pair of stimuli leaves it as one sum.
    """
    with_checkpoints(mean.sparkSession)
    mean = mean.select(*keys, "stim", "unit", "value").checkpoint()
    per = mean.groupBy(*keys, "stim").agg(F.avg("value").alias("_m"), F.sqrt(F.sum(F.col("value") * F.col("value")) - F.sum("value") * F.sum("value") / F.count("value")).alias("_norm"))
    z = mean.join(per.where("_norm > 1e-9"), [*keys, "stim"]).select(*keys, "stim", "unit", ((F.col("value") - F.col("_m")) / F.col("_norm")).alias("z"))
    stims, units = (max(1, math.ceil(mean.select(c).distinct().count() / tile)) for c in ("stim", "unit"))
    own, of_unit = (F.pmod(F.xxhash64(c), F.lit(n)).cast("int") for c, n in (("stim", stims), ("unit", units)))
    dealt = z.withColumn("_own", own).withColumn("_u", of_unit).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(stims - 1))))
    dealt = dealt.withColumn("_i", F.least("_own", "_other")).withColumn("_j", F.greatest("_own", "_other")).drop("_other")
    kinds = {f.name: f.dataType.simpleString() for f in mean.schema}
    ddl = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"p {kinds['stim']}", f"q {kinds['stim']}", "r double"])

    def multiplied(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        (stims, s), (_, u) = (coded(group[c]) for c in ("stim", "unit"))
        z = np.zeros((len(stims), u.max() + 1))
        there = np.zeros(z.shape)
        z[s, u], there[s, u] = group["z"].to_numpy(), 1
        block = np.zeros(len(stims), int)
        block[s] = group["_own"].to_numpy()
        one, two = (np.flatnonzero(block == group[c][0].as_py()) for c in ("_i", "_j"))
        x, y = np.nonzero(there[one] @ there[two].T)  # pairs with a unit in common
        r = (z[one] @ z[two].T)[x, y]
        # inside one block each pair is found twice
        x, y = one[x], two[y]
        kept = (x < y) | (block[x] != block[y])
        fixed = [pa.array([group[k][0].as_py()] * int(kept.sum()), group.schema.field(k).type) for k in keys]
        return pa.table([*fixed, stims.take(pa.array(x[kept])), stims.take(pa.array(y[kept])), pa.array(r[kept])], names=[*keys, "p", "q", "r"])

    sums = dealt.groupBy(*keys, "_i", "_j", "_u").applyInArrow(multiplied, ddl)
    return sums.groupBy(*keys, F.greatest("p", "q").alias("stim_a"), F.least("p", "q").alias("stim_b")).agg(F.sum("r").alias("r"))


def coded(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct values, and each row's number among them."""
    found = column.combine_chunks().dictionary_encode()
    return found.dictionary, found.indices.to_numpy()


def compared(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Pearson and Spearman correlation of two matrices over the pairs that both have; null under three."""
    both = a.withColumnRenamed("r", "ra").join(b.withColumnRenamed("r", "rb"), [*keys, "stim_a", "stim_b"])
    with_checkpoints(a.sparkSession)
    both = both.select(*keys, "ra", "rb").checkpoint()
    both = with_average_rank(with_average_rank(both, "ra", keys, "_ka"), "rb", keys, "_kb")
    return both.groupBy(*keys).agg(F.count("*").alias("n"), safe_corr(F.col("ra"), F.col("rb")).alias("pearson"), safe_corr(F.col("_ka"), F.col("_kb")).alias("spearman"))


def halves(rows: DataFrame, seeds: Sequence[int], interleaved: bool = False) -> DataFrame:
    """(seed, half) on the rows: a stimulus's trials in the order of a hash, the first half to A or every other one.

    Not interleaved, a stimulus with a single trial goes to B alone.
    """
    trials = rows.select("stim", "trial").distinct().withColumn("seed", F.explode(F.array(*(F.lit(s) for s in seeds))))
    of = Window.partitionBy("seed", "stim")
    rn = F.row_number().over(of.orderBy(hash_order(F.col("seed"), "trial"), "trial"))
    half = F.when((rn - 1) % 2 == 0, "a").otherwise("b") if interleaved else F.when(rn <= F.floor(F.count(F.lit(1)).over(of) / 2), "a").otherwise("b")
    return rows.join(trials.withColumn("half", half), ["stim", "trial"])


def unit_reliability(rows: DataFrame, seeds: Sequence[int], least: int = 5) -> DataFrame:
    """Per unit: split-half correlation of its means over stimuli, stepped up, averaged over the seeds; zeros are left out."""
    mean = halves(rows, seeds).groupBy("seed", "unit", "stim", "half").agg(F.avg("value").alias("value"))
    wide = mean.groupBy("seed", "unit", "stim").agg(F.max(F.when(F.col("half") == "a", F.col("value"))).alias("a"), F.max(F.when(F.col("half") == "b", F.col("value"))).alias("b"))
    per = wide.groupBy("seed", "unit").agg(spearman_brown(safe_corr(F.col("a"), F.col("b"), least)).alias("r"))
    return per.groupBy("unit").agg(F.avg(F.when(F.col("r") != 0, F.col("r"))).alias("reliability"), F.count("r").alias("n_seeds"))


def rsm_reliability(rows: DataFrame, seeds: Sequence[int]) -> DataFrame:
    """Correlation of the matrices of interleaved halves, per seed."""
    mean = means(halves(rows, seeds, interleaved=True), ("seed", "half"))
    both = rsm(mean, ("seed", "half"))
    a, b = (both.where(F.col("half") == h).drop("half") for h in "ab")
    return compared(a, b, ("seed",))


def drawn(run: DataFrame, seeds: Sequence[int], fractions: Sequence[float], unit_counts: Sequence[int]) -> DataFrame:
    """(seed, fraction, units, stim, trial, unit, value): a share of a stimulus's trials and a number of units, in the order of a hash.

    Each larger sample holds the smaller; at least two trials stay.
    """
    grid = F.explode(F.array(*(F.struct(F.lit(s).alias("seed"), F.lit(f).alias("fraction"), F.lit(u).alias("units")) for s in seeds for f in fractions for u in unit_counts)))
    trials = run.select("stim", "trial").distinct().withColumn("seed", F.explode(F.array(*(F.lit(s) for s in seeds))))
    of = Window.partitionBy("seed", "stim")
    trials = trials.withColumn("_t", F.row_number().over(of.orderBy(hash_order(F.col("seed"), "trial"), "trial"))).withColumn("_n", F.count(F.lit(1)).over(of))
    units = run.select("unit").distinct().withColumn("seed", F.explode(F.array(*(F.lit(s) for s in seeds))))
    units = units.withColumn("_u", F.row_number().over(Window.partitionBy("seed").orderBy(hash_order(F.col("seed"), "unit"), "unit")))
    cells = run.join(trials, ["stim", "trial"]).join(units, ["seed", "unit"]).withColumnRenamed("seed", "_seed").withColumn("g", grid)
    kept = cells.where((F.col("g.seed") == F.col("_seed")) & (F.col("_u") <= F.col("g.units")) & (F.col("_t") <= F.greatest(F.lit(2), F.ceil(F.col("g.fraction") * F.col("_n")))))
    return kept.select("g.*", "stim", "trial", "unit", "value")


def ablation(rows: DataFrame, other: DataFrame, seeds: Sequence[int], fractions: Sequence[float], unit_counts: Sequence[int]) -> DataFrame:
    """Mean and deviation over seeds of the match of two runs' matrices, for shares of trials and numbers of units."""
    keys = ("seed", "fraction", "units")
    a, b = (drawn(run, seeds, fractions, unit_counts) for run in (rows, other))
    match = compared(rsm(means(a, keys), keys), rsm(means(b, keys), keys), keys)
    return match.groupBy("fraction", "units").agg(F.avg("pearson").alias("mean"), F.stddev_samp("pearson").alias("sd"), F.count("pearson").alias("n"))


def split_ablation(rows: DataFrame, seeds: Sequence[int], fractions: Sequence[float], unit_counts: Sequence[int]) -> DataFrame:
    """As ``ablation`` for the two halves of one run's drawn trials, every other one in the order of a hash: what a run can match itself by."""
    keys = ("seed", "fraction", "units")
    order = Window.partitionBy(*keys, "stim").orderBy(hash_order(F.col("seed"), "trial"), "trial")
    # a trial has a row for each unit
    placed = drawn(rows, seeds, fractions, unit_counts).withColumn("half", F.when(F.dense_rank().over(order) % 2 == 1, "a").otherwise("b"))
    both = rsm(means(placed, (*keys, "half")), (*keys, "half"))
    a, b = (both.where(F.col("half") == h).drop("half") for h in "ab")
    match = compared(a, b, keys)
    return match.groupBy("fraction", "units").agg(F.avg("pearson").alias("mean"), F.stddev_samp("pearson").alias("sd"), F.count("pearson").alias("n"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)
