"""Chunked signals: windows around onsets, calibration, halos, filters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sliced(chunks: DataFrame, low: int, high: int) -> DataFrame:
    """Chunks cut to the samples low <= s < high; the filter on the chunk's bounds prunes by statistics."""
    kept = chunks.where((F.col("start_sample") < high) & (F.col("start_sample") + F.col("n_samples") > low))
    a = F.greatest(F.lit(0), F.lit(low) - F.col("start_sample"))
    b = F.least(F.col("n_samples"), F.lit(high) - F.col("start_sample"))
    return kept.withColumn("data", F.slice("data", (a + 1).cast("int"), (b - a).cast("int"))).withColumn("start_sample", F.col("start_sample") + a).withColumn("n_samples", b - a)


def with_halo(chunks: DataFrame, keys: Sequence[str], halo: int) -> DataFrame:
    """Each chunk with ``halo`` samples of its neighbours, nulls at the ends: one equality join on neighbouring numbers."""
    sent = chunks.select(*keys, F.col("chunk_id"), F.col("data"), F.explode(F.array(*(F.lit(d) for d in (-1, 0, 1)))).alias("_d"))
    parts = sent.select(*keys, (F.col("chunk_id") - F.col("_d")).alias("chunk_id"), "_d", F.when(F.col("_d") == -1, F.slice("data", -F.least(F.size("data"), F.lit(halo)), F.lit(halo))).when(F.col("_d") == 1, F.slice("data", 1, halo)).otherwise(F.col("data")).alias("_part"))
    found = parts.groupBy(*keys, "chunk_id").agg(*(F.first(F.when(F.col("_d") == d, F.col("_part")), ignorenulls=True).alias(f"_{i}") for i, d in enumerate((-1, 0, 1))))
    none = F.array().cast(chunks.schema["data"].dataType)
    return found.where("_1 IS NOT NULL").select(*keys, "chunk_id", F.coalesce("_0", none).alias("before"), F.col("_1").alias("data"), F.coalesce("_2", none).alias("after"))


def filtered(chunks: DataFrame, keys: Sequence[str], kernel: Sequence[float]) -> DataFrame:
    """Symmetric FIR filter of odd length, chunk by chunk with halos; what is missing at the ends counts as zero."""
    taps = np.asarray(kernel, dtype=float)
    half = len(taps) // 2

    @F.pandas_udf("array<double>")
    def convolved(before: pd.Series, data: pd.Series, after: pd.Series) -> pd.Series:
        out = []
        for p, x, q in zip(before, data, after):
            p, q = np.asarray(p, float), np.asarray(q, float)
            row = np.concatenate([np.zeros(half - len(p)), p, np.asarray(x, float), q, np.zeros(half - len(q))])
            out.append(np.convolve(row, taps, mode="valid"))
        return pd.Series(out)

    return with_halo(chunks, keys, half).select(*keys, "chunk_id", convolved("before", "data", "after").alias("data"))


def band_pass(low_hz: float, high_hz: float, rate_hz: float, taps: int, delay: float = 0.0) -> list[float]:
    """Hamming-windowed sinc kernel; ``delay``, in samples, shifts a channel's phase."""
    n = np.arange(taps) - (taps - 1) / 2 - delay
    k = 2 * high_hz / rate_hz * np.sinc(2 * high_hz / rate_hz * n) - 2 * low_hz / rate_hz * np.sinc(2 * low_hz / rate_hz * n)
    return (k * np.hamming(taps)).tolist()


def referenced(samples: DataFrame, keys: Sequence[str], value: str, how: str = "median") -> DataFrame:
    """The value less the median (or mean) over the channels of the same sample."""
    middle = samples.groupBy(*keys).agg((F.median(value) if how == "median" else F.avg(value)).alias("_mid"))
    return samples.join(middle, list(keys)).withColumn(value, F.col(value) - F.col("_mid")).drop("_mid")


def saturated_int16(value: Column) -> Column:
    return F.greatest(F.lit(-32768), F.least(F.lit(32767), F.rint(value))).cast("smallint")


def volts(value: Column, reach: float) -> Column:
    return value * reach / 32768.0


def bad_channels(samples: DataFrame, channel: str, sample: str, value: str, limit: float = 3.0) -> DataFrame:
    """Channels whose spread is far, in median absolute deviations of its log, from the others'."""
    spread = samples.groupBy(channel).agg(F.log(F.stddev_pop(value) + 1e-9).alias("s"))
    mid = spread.agg(F.median("s")).first()[0]
    mad = spread.agg(F.median(F.abs(F.col("s") - mid))).first()[0]
    return spread.select(channel, ((F.col("s") - mid) / (1.4826 * mad + 1e-9)).alias("z")).withColumn("bad", F.abs("z") > limit)


def windows(chunks: DataFrame, onsets: DataFrame, keys: Sequence[str], pre: int, post: int, chunk_size: int) -> DataFrame:
    """(keys, trial_id, offset, v): samples centre - pre <= s < centre + post of every onset, by an equality join on chunk numbers."""
    lo, hi = F.col("centre") - pre, F.col("centre") + post
    wanted = onsets.select(*keys, "trial_id", lo.alias("_lo"), hi.alias("_hi"), F.explode(F.sequence(F.floor(F.greatest(lo, F.lit(0)) / chunk_size), F.floor((hi - 1) / chunk_size))).alias("chunk_id"))
    joined = wanted.join(chunks.select(*keys, "chunk_id", "start_sample", "data"), [*keys, "chunk_id"])
    rows = joined.select(*keys, "trial_id", "_lo", "_hi", "start_sample", F.posexplode("data").alias("_i", "v")).withColumn("_s", F.col("start_sample") + F.col("_i"))
    return rows.where("_s >= _lo AND _s < _hi").select(*keys, "trial_id", (F.col("_s") - F.col("_lo")).cast("int").alias("offset"), "v")


def normalised(rows: DataFrame, keys: Sequence[str], least_variance: float) -> DataFrame:
    """Per trial: z of each sample, turned over where the largest step (the first on ties) goes down; flat trials are dropped."""
    from pyspark.sql import Window

    of = [*keys, "trial_id"]
    whole = Window.partitionBy(*of)
    sd = F.stddev_pop("v").over(whole)
    z = rows.withColumn("_var", F.var_pop("v").over(whole)).withColumn("_z", F.when(sd > 0, (F.col("v") - F.avg("v").over(whole)) / sd)).where((F.col("_var") >= least_variance) & F.col("_z").isNotNull())
    step = z.withColumn("_step", F.col("_z") - F.lag("_z").over(whole.orderBy("offset")))
    way = F.max_by("_step", F.struct(F.round(F.abs("_step"), 9), -F.col("offset"))).over(whole)
    return step.withColumn("z", F.when(way < 0, -F.col("_z")).otherwise(F.col("_z"))).drop("_var", "_z", "_step")


def calibrated(chunks: DataFrame, onsets: DataFrame, keys: Sequence[str], pre: int, post: int, high: tuple[int, int], chunk_size: int, ms_per_sample: float, delay_ms: float = 0.0, least_variance: float = 1e-6) -> DataFrame:
    """Latency of each onset from the signal's first crossing of a session-wide threshold.

    onsets: keys, trial_id, centre (null where missing).  Flags: 0 good, 1 crossed
    before the onset, 2 missing or out of bounds, 3 flat or never crossed (tested
    before 1).  The threshold is 0.1 mean(baseline) + 0.9 mean(high window) over
    the trials that are not flagged by then.  A session whose whole signal is flat
    has ``dead`` set.
    """
    a, b = (pre + high[0], pre + high[1]) if pre + high[1] <= pre + post else (pre, pre + post)
    sizes = chunks.select(*keys, "start_sample", F.size("data").alias("n")).groupBy(*keys).agg(F.max(F.col("start_sample") + F.col("n")).alias("_end"))
    spread = chunks.select(*keys, F.explode("data").alias("v")).groupBy(*keys).agg((F.var_pop("v") < least_variance).alias("dead"))
    placed = onsets.join(sizes.join(spread, list(keys)), list(keys), "left").withColumn("_in", F.coalesce((F.col("centre") - pre >= 0) & (F.col("centre") + post <= F.col("_end")), F.lit(False)))
    z = normalised(windows(chunks, placed.where("_in").select(*keys, "trial_id", "centre"), keys, pre, post, chunk_size), keys, least_variance)
    level = z.groupBy(*keys).agg((0.1 * F.avg(F.when(F.col("offset") < pre, F.col("z"))) + 0.9 * F.avg(F.when((F.col("offset") >= a) & (F.col("offset") < b), F.col("z")))).alias("threshold"))
    over = F.col("z") > F.col("threshold")
    found = z.join(level, list(keys)).groupBy(*keys, "trial_id").agg(
        F.min(F.when(over & (F.col("offset") >= pre), F.col("offset") - pre)).alias("_first"), F.max(F.when(F.col("offset") < pre, over)).alias("_early"))
    joined = placed.join(found, [*keys, "trial_id"], "left")
    flag = F.when(~F.col("_in"), 2).when(F.col("_first").isNull(), 3).when(F.col("_early"), 1).otherwise(0)
    latency = F.when(flag == 0, F.col("_first") * ms_per_sample + delay_ms)
    return joined.select(*keys, "trial_id", flag.alias("flag"), latency.alias("latency_ms"), "dead")


def band(rows: DataFrame, keys: Sequence[str], value: str = "v") -> DataFrame:
    """Mean and deviation over trials at each offset."""
    return rows.groupBy(*keys, "offset").agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.count("*").alias("n"))


def realigned(rows: DataFrame, latencies: DataFrame, keys: Sequence[str], value: str = "v") -> DataFrame:
    """Traces moved earlier by each trial's latency (in samples, with fractions), linear between samples, null past the end."""
    from pyspark.sql import Window

    of = [*keys, "trial_id"]
    moved = rows.join(latencies.select(*of, "latency"), of)
    whole = F.floor("latency").cast("int")
    order = Window.partitionBy(*of).orderBy("offset")
    next_ = F.lead(value).over(order)
    part = F.col("latency") - whole
    return moved.withColumn("_v", F.when(part == 0, F.col(value)).otherwise(F.col(value) * (1 - part) + next_ * part)).select(*of, (F.col("offset") - whole).alias("offset"), F.col("_v").alias(value)).where("offset >= 0")
