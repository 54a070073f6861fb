"""Quality metrics, labels, histograms and summaries of units."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Label of a unit and its number in exports.
LABELS = {"good": "SUA", "mua": "MUA", "non_soma": "NON-SOMA", "noise": "NOISE"}
NUMBERS = {"SUA": 1, "GOOD": 1, "MUA": 2, "NON-SOMA": 3, "NOISE": 3}
#: Refractory time and its censored start, in the unit of the spike times.
TAU, TAU_MIN = 2.0, 0.0


def quality_metrics(spikes: DataFrame, key: str, t: str, amplitude: str, bins: int, duration: float, tau: float = TAU) -> DataFrame:
    """Per unit: count, rate, occupied share of equal time bins, interval violations, amplitude median, snr and cut-off.

    violations ratio = nv T / (2 N^2 tau) with nv the intervals below tau; the
    contamination is 1 - sqrt(1 - nv (T - 2 N tau) / (N^2 tau)), not below 0.
    """
    gap = F.col(t) - F.lag(t).over(Window.partitionBy(key).orderBy(t))
    rows = spikes.select(key, F.col(t), F.col(amplitude)).withColumn("_gap", gap)
    mid = rows.groupBy(key).agg(F.median(amplitude).alias("amplitude_median"))
    rows = rows.join(mid, key)
    sums = rows.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(F.col("_gap") < tau).alias("nv"), F.countDistinct(F.floor(F.col(t) * bins / duration)).alias("occupied"),
        F.first("amplitude_median").alias("amplitude_median"), F.avg(amplitude).alias("_mean"), F.stddev_pop(amplitude).alias("_sd"),
        F.avg((F.col(amplitude) < 0.25 * F.col("amplitude_median")).cast("double")).alias("amplitude_cutoff"))
    n = F.col("n").cast("double")
    inner = 1 - F.col("nv") * (duration - 2 * n * tau) / (n * n * tau)
    return sums.select(
        key, "n", (n / duration).alias("firing_rate"), (F.col("occupied") / bins).alias("presence_ratio"), (F.col("nv") * duration / (2 * n * n * tau)).alias("isi_violations_ratio"),
        (1 - F.sqrt(F.greatest(F.lit(0.0), inner))).alias("rp_contamination"), "amplitude_median", "amplitude_cutoff", F.when(F.col("_sd") > 0, F.col("_mean") / F.col("_sd")).alias("snr"))


def classified(metrics: DataFrame, isi_max: float, cutoff_max: float, presence_min: float, snr_min: float) -> DataFrame:
    """Presence and cut-off are hard gates, then violations and snr tell SUA from MUA; a missing cut-off passes."""
    noise = (F.col("presence_ratio") < presence_min) | F.coalesce(F.col("amplitude_cutoff") > cutoff_max, F.lit(False))
    clean = (F.col("isi_violations_ratio") <= isi_max) & (F.col("snr") >= snr_min)
    label = F.when(noise, "NOISE").when(clean, "SUA").when(F.col("snr") >= snr_min, "MUA").otherwise("NOISE")
    return metrics.withColumn("unittype", label)


def long_metrics(metrics: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    return metrics.select(key, F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names))).alias("m")).select(key, "m.*")


def failures(metrics: DataFrame, key: str, thresholds: DataFrame) -> DataFrame:
    """(key, layer, metric) of every bound that a unit misses; thresholds: layer, metric, op (greater, less, abs), bound.

    ``greater`` and ``less`` bound what passes; ``abs`` bounds the size.  Missing values pass.
    """
    names = [r.metric for r in thresholds.select("metric").distinct().collect()]  # a config table
    v, bound = F.col("value"), F.col("bound")
    passes = F.when(F.col("op") == "greater", v > bound).when(F.col("op") == "less", v < bound).otherwise(F.abs(v) < bound)
    return long_metrics(metrics, key, sorted(names)).join(F.broadcast(thresholds), "metric").where(~F.coalesce(passes, F.lit(True))).select(key, "layer", "metric")


def labelled(metrics: DataFrame, key: str, thresholds: DataFrame, order: Sequence[str], default: str) -> DataFrame:
    """The first layer of ``order`` with a missed bound names the unit, else ``default``."""
    missed = failures(metrics, key, thresholds).groupBy(key).agg(F.collect_set("layer").alias("_layers"))
    label = F.coalesce(*(F.when(F.array_contains("_layers", x), x) for x in order), F.lit(default))
    return metrics.select(key).join(missed, key, "left").select(key, label.alias("label"))


def overlaps(failed: DataFrame, key: str) -> DataFrame:
    """How many units miss exactly each set of bounds."""
    return failed.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("metric")), "+").alias("metrics")).groupBy("metrics").agg(F.count("*").alias("n_units"))


def shares(units: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    counts = units.groupBy(*keys, label).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def mapped(label: Column, names: Mapping[str, str | int], default: str | int) -> Column:
    """Looks a label up without regard to case."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for k, v in names.items() for x in (k.lower(), v))), F.lower(label)), F.lit(default))


def histogram(rows: DataFrame, value: str, bins: int | None = None) -> DataFrame:
    """Counts in equal bins from least to greatest, the last edge closed; min(30, max(5, n)) bins unless given."""
    edges = rows.where(F.col(value).isNotNull()).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_n")).withColumn("_bins", F.lit(bins) if bins else F.least(F.lit(30), F.greatest(F.lit(5), F.col("_n"))))
    e = edges.first()  # one row of numbers
    if not e["_n"]:
        return rows.limit(0).select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n"))
    width = (e["_hi"] - e["_lo"]) / e["_bins"]
    at = F.least(F.lit(int(e["_bins"]) - 1), F.floor((F.col(value) - e["_lo"]) / width)) if width else F.lit(0)
    return rows.where(F.col(value).isNotNull()).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def density(points: DataFrame, x: str, y: str, cells: int, reach: float) -> DataFrame:
    """Counts on a square grid over -reach..reach, the last edges closed; points outside are left out."""
    def cell(c: str) -> Column:
        return F.least(F.lit(cells - 1), F.floor((F.col(c) + reach) * cells / (2 * reach))).cast("int")
    inside = points.where(F.col(x).between(-reach, reach) & F.col(y).between(-reach, reach))
    return inside.groupBy(cell(x).alias("ix"), cell(y).alias("iy")).agg(F.count("*").alias("n"))


def quantile_summary(rows: DataFrame, run: str, label: str, value: str, points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Quantiles per (run, label) and per run over all labels (ALL), in one pass of grouping sets."""
    sets = rows.groupingSets([[run, label], [run]], run, label)
    found = sets.agg(F.grouping(label).alias("_all"), F.count(value).alias("n"), *(F.percentile(value, p).alias(f"p{int(100 * p)}") for p in points))
    return found.withColumn(label, F.when(F.col("_all") == 1, "ALL").otherwise(F.col(label))).drop("_all")


def fixation(trials: DataFrame, eye: DataFrame, interval_ms: float, window: float, least: float = 0.999) -> DataFrame:
    """Share of eye samples within ``window`` of the middle while a stimulus is on; over the whole trial if it has no timing or no sample.

    trials: trial_id, onset_ms, duration_ms, valid; eye: trial_id, i, x, y.  A trial
    without eye data keeps its validity.
    """
    near = (F.sqrt(F.col("x") ** 2 + F.col("y") ** 2) < window).cast("double")
    lo, hi = F.greatest(F.lit(0), (F.col("onset_ms") / interval_ms).cast("int")), ((F.col("onset_ms") + F.col("duration_ms")) / interval_ms).cast("int")
    rows = trials.select("trial_id", lo.alias("lo"), hi.alias("hi")).join(eye.withColumn("_near", near), "trial_id")
    ratio = rows.groupBy("trial_id").agg(F.avg(F.when((F.col("i") >= F.col("lo")) & (F.col("i") < F.col("hi")), F.col("_near"))).alias("_on"), F.avg("_near").alias("_all"))
    found = trials.join(ratio, "trial_id", "left").withColumn("ratio", F.coalesce("_on", "_all"))
    return found.select("trial_id", "ratio", F.when(F.col("ratio").isNull(), F.col("valid")).otherwise(F.col("ratio") > least).alias("valid"))
