"""Pulse trains of several clocks: intervals, gap repair, pairing, linear fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import ordinal_join

STREAM = ("session", "stream")


def intervals(pulses: DataFrame, keys: Sequence[str] = STREAM, time: str = "t") -> DataFrame:
    """``pulses`` with the time since the one before, null for the first."""
    return pulses.withColumn("gap", F.col(time) - F.lag(time).over(Window.partitionBy(*keys).orderBy(time)))


def repaired(pulses: DataFrame, threshold: float, keys: Sequence[str] = STREAM) -> DataFrame:
    """Gaps above ``threshold`` get round(gap / median gap) - 1 evenly spaced pulses, marked ``added``."""
    gaps = intervals(pulses, keys)
    typical = gaps.groupBy(*keys).agg(F.median("gap").alias("_typical"))
    missing = F.bround(F.col("gap") / F.col("_typical")).cast("int") - 1
    holes = gaps.join(typical, list(keys)).where(F.col("gap") > threshold).withColumn("_n", missing).where("_n >= 1")
    added = holes.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*keys, (F.col("t") - F.col("gap") + F.col("_i") * F.col("gap") / (F.col("_n") + 1)).alias("t"), F.lit(True).alias("added"))
    return pulses.select(*keys, "t", F.lit(False).alias("added")).unionByName(added)


def clock_fits(pulses: DataFrame, reference: str, threshold: float, max_residual_ms: float, strict: bool = False) -> DataFrame:
    """Per (session, stream): reference time = a t + b by least squares over pulses paired in order after gap repair.

    ``status`` tells what is wrong instead of an exception, so that one session
    does not end a batch; with ``strict`` a row that is not ok raises.  ``a`` and ``b``
    are null where the counts differ, as the pairs are shifted then.  ``n_repaired``
    counts the pulses added to the stream and to the reference.
    """
    whole = repaired(pulses, threshold)
    counts = whole.groupBy("session", "stream").agg(F.count("*").alias("n"), F.count_if("added").alias("n_repaired"))
    other = whole.where(F.col("stream") != reference).select("session", "stream", F.col("t").alias("x"))
    base = whole.where(F.col("stream") == reference).select("session", F.col("t").alias("y"))
    streams = other.select("session", "stream").distinct()
    paired = ordinal_join(other, base.join(streams, "session"), ["session", "stream"], ["x"], ["y"])
    fit = paired.groupBy("session", "stream").agg(F.count("*").alias("pairs"), F.when(F.var_pop("x") > 0, F.regr_slope("y", "x")).alias("a"), F.when(F.var_pop("x") > 0, F.regr_intercept("y", "x")).alias("b"))
    off = F.col("y") - (F.col("a") * F.col("x") + F.col("b"))
    residual = paired.join(fit, ["session", "stream"]).groupBy("session", "stream").agg((F.sqrt(F.avg(off * off)) * 1000).alias("residual_ms"))
    sizes = counts.where(F.col("stream") == reference).select("session", F.col("n").alias("n_reference"), F.col("n_repaired").alias("_added"))
    found = fit.join(residual, ["session", "stream"]).join(counts, ["session", "stream"]).join(sizes, "session")
    status = F.when(F.col("pairs") < 2, "too_few_pulses").when(F.col("n") != F.col("n_reference"), "counts_differ").when(F.col("residual_ms") > max_residual_ms, "residual_too_large").otherwise("ok")
    found = found.withColumn("status", status).withColumn("n_repaired", F.col("n_repaired") + F.col("_added"))
    found = found.select("session", "stream", *(F.when(F.col("status") != "counts_differ", F.col(c)).alias(c) for c in "ab"), "residual_ms", "n_repaired", "status")
    return found.withColumn("status", F.when(F.col("status") == "ok", F.col("status")).otherwise(F.raise_error(F.col("status")))) if strict else found


def transformed(times: DataFrame, fits: DataFrame, time: str = "t", inverse: bool = False) -> DataFrame:
    """``times`` in the reference clock, or from it into each stream's clock; fits are a row per stream, and null where one has no usable line."""
    t = (F.col(time) - F.col("b")) / F.col("a") if inverse else F.col("a") * F.col(time) + F.col("b")
    return times.join(fits.select("session", "stream", "a", "b"), "session").withColumn("t_out", t).drop("a", "b")
