"""Behaviour trials, units and channels as tables, and the checks between stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def analog(trials: DataFrame, channel: str, wanted: DataFrame | None = None, keys: Sequence[str] = ("session", "trial_id")) -> DataFrame:
    """(keys, i, value): one analog channel, sample by sample; trials that lack it or hold nothing in it are left out.

    ``trials`` has a map column ``analog`` from channel names to arrays; ``wanted``
    limits the trials.
    """
    held = trials if wanted is None else trials.join(wanted.select(*keys).distinct(), list(keys), "left_semi")
    samples = F.col("analog")[channel]
    return held.where(samples.isNotNull() & (F.size(samples) > 0)).select(*keys, F.posexplode(samples).alias("i", "value"))


def code_times(trials: DataFrame, codes: Sequence[int | str], keys: Sequence[str] = ("session", "trial_id"), wanted: DataFrame | None = None) -> DataFrame:
    """(keys, time) of the nested ``events`` (code, time) of trials that have one of the codes; ``wanted`` limits the trials."""
    held = trials if wanted is None else trials.join(wanted.select(*keys).distinct(), list(keys), "left_semi")
    return held.select(*keys, F.explode("events").alias("e")).where(F.col("e.code").isin(list(codes))).select(*keys, F.col("e.time").alias("time"))


def session_report(trials: DataFrame, units: DataFrame, eye: DataFrame, suspicious: float) -> DataFrame:
    """Per session: trials, units, mean score, units without a score, units with a score below ``suspicious``, and the sampling interval of the first trial that has one.

    trials: (session, trial_id); units: (session, unit_id, score); eye: (session,
    trial_id, interval_ms).  A session that only one table knows has a row.
    """
    t = trials.groupBy("session").agg(F.count("*").alias("n_trials"))
    u = units.groupBy("session").agg(F.count("*").alias("n_units"), F.avg("score").alias("mean_score"), F.count_if(F.col("score").isNull()).alias("n_null"), F.count_if(F.col("score") < suspicious).alias("n_suspicious"))
    e = eye.where("interval_ms IS NOT NULL").groupBy("session").agg(F.min_by("interval_ms", "trial_id").alias("interval_ms"))
    both = t.join(u, "session", "full_outer").join(e, "session", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select("session", zero("n_trials"), zero("n_units"), "mean_score", zero("n_null"), zero("n_suspicious"), "interval_ms")


def behavior_events(trials: DataFrame, onsets: DataFrame, fits: DataFrame, names: DataFrame) -> DataFrame:
    """One row for each aligned stimulus: what every later stage reads.

    trials: (session, trial_id, ...); onsets: (session, trial_id, onset_s,
    latency_ms, flag) in the reference clock; fits: (session, stream, a, b); names:
    (session, dataset_name).  ``onset_by_probe`` is the onset in each probe's own
    clock, as JSON text; a probe without a usable fit is left out of it.
    """
    usable = fits.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    lines = usable.groupBy("session").agg(F.array_sort(F.collect_list(F.struct("stream", "a", "b"))).alias("_lines"))
    joined = trials.join(onsets, ["session", "trial_id"]).join(lines, "session", "left").join(names, "session", "left")
    per_probe = F.map_from_arrays(F.transform("_lines", lambda x: x["stream"]), F.transform("_lines", lambda x: (F.col("onset_s") - x["b"]) / x["a"]))
    return joined.withColumn("onset_by_probe", F.coalesce(F.to_json(per_probe), F.lit("{}"))).drop("_lines")


def unit_problems(units: DataFrame) -> DataFrame:
    """(probe_id, problem): what keeps a units table from being read; no rows if it is fine."""
    missing = [c for c in ("probe_id", "spike_times") if c not in units.columns]
    if missing:
        raise ValueError(f"the units table lacks {', '.join(missing)}")
    counted = units.groupBy("probe_id").agg(F.count("*").alias("n"), F.count_if(F.size(F.coalesce("spike_times", F.array().cast("array<double>"))) == 0).alias("empty"))
    problem = F.when(F.col("probe_id").isNull(), "no_probe").when(F.col("n") == F.col("empty"), "no_spikes")
    return counted.select("probe_id", problem.alias("problem")).where("problem IS NOT NULL")


def units_per_probe(probes: DataFrame, units: DataFrame, key: str = "probe_id") -> DataFrame:
    """(key, n_units, status): how many of ``units`` each expected probe has; none, whether it is known or not, warns."""
    counts = units.groupBy(key).agg(F.count("*").alias("n_units"))
    found = probes.select(key).distinct().join(counts, key, "left").withColumn("n_units", F.coalesce("n_units", F.lit(0)))
    return found.withColumn("status", F.when(F.col("n_units") > 0, "pass").otherwise("warn"))


def probe_key(units: DataFrame) -> DataFrame:
    """``units`` with ``probe``: its probe_id, else its electrode_group_name; without either column it raises."""
    have = [F.col(c).cast("string") for c in ("probe_id", "electrode_group_name") if c in units.columns]
    if not have:
        raise ValueError("units need probe_id or electrode_group_name")
    return units.withColumn("probe", F.coalesce(*have))


def imported_sorting(spikes: DataFrame, labels: DataFrame, keys: Sequence[str] = ("session", "probe", "unit_id")) -> DataFrame:
    """Units of a sorting: number of spikes, label and status; units without a label are ``unsorted``, labels without spikes warn, of repeated labels the first in order counts."""
    labels = labels.groupBy(*keys).agg(F.min("label").alias("label"))
    counts = spikes.groupBy(*keys).agg(F.count("*").alias("n_spikes"))
    both = counts.join(labels, list(keys), "full_outer")
    return both.select(*keys, F.coalesce("n_spikes", F.lit(0)).alias("n_spikes"), F.coalesce("label", F.lit("unsorted")).alias("label"), F.when(F.col("n_spikes").isNull(), "warn").otherwise("pass").alias("status"))


def channel_locations(channels: DataFrame, series: DataFrame) -> DataFrame:
    """(series, locations): channels' places in order, only where they are as many as the series has and all finite.

    channels: (series, channel, x, y); series: (series, n_channels).
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    placed = channels.groupBy("series").agg(F.array_sort(F.collect_list(F.struct("channel", "x", "y"))).alias("locations"), F.count("*").alias("n"), F.min(finite("x") & finite("y")).alias("fine"))
    joined = series.join(placed, "series", "left")
    return joined.select("series", F.when((F.col("n") == F.col("n_channels")) & F.col("fine"), F.col("locations")).alias("locations"))


def electrodes(table: DataFrame, probes: DataFrame) -> DataFrame:
    """(probe, position, electrode): a probe's rows of the electrode table, or 0 to n_channels - 1 where it has none."""
    order = Window.partitionBy("probe").orderBy("electrode")
    own = table.join(probes.select("probe"), "probe", "left_semi").select("probe", (F.row_number().over(order) - 1).cast("long").alias("position"), "electrode")
    plain = probes.join(table.select("probe").distinct(), "probe", "left_anti").where("n_channels > 0")
    plain = plain.select("probe", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_channels").cast("long") - 1)).alias("position"))
    return own.unionByName(plain.withColumn("electrode", F.col("position")))


def chosen(rows: DataFrame, wanted: DataFrame, key: str = "unit_id", order: str = "ord") -> DataFrame:
    """The rows of the keys in ``wanted`` (key, order), with their order; a key that is wanted twice comes twice."""
    return wanted.select(key, order).join(rows, key)


def without_channels(channels: DataFrame, bad: DataFrame, keys: Sequence[str] = ("probe", "channel")) -> DataFrame:
    return channels.join(bad.select(*keys).distinct(), list(keys), "left_anti")


def subject(rows: DataFrame, allowed: Sequence[str] = ("subject_id", "species", "sex", "age", "weight", "description")) -> DataFrame:
    """The allowed columns that are there; a blank weight is null."""
    return rows.select(*(F.when(F.trim("weight") != "", F.trim("weight")).alias(c) if c == "weight" else F.col(c) for c in allowed if c in rows.columns))


def trace_variants(windows: DataFrame, keys: Sequence[str] = ("session", "trial_id")) -> DataFrame:
    """(keys, i, z, delta, abs_delta, upright) of onset windows (keys, i, v): z-scores, change against the first sample, its size, and turned so that the largest change rises."""
    whole = Window.partitionBy(*keys)
    sd = F.stddev_pop("v").over(whole)
    z = F.when(sd > 0, (F.col("v") - F.avg("v").over(whole)) / sd).otherwise(0.0)
    rows = windows.withColumn("z", z).withColumn("delta", F.col("z") - F.min_by("z", "i").over(whole)).withColumn("abs_delta", F.abs("delta"))
    sign = F.max_by(F.signum("delta"), F.struct("abs_delta", -F.col("i"))).over(whole)
    return rows.select(*keys, "i", "z", "delta", "abs_delta", (F.col("z") * F.when(sign < 0, -1).otherwise(1)).alias("upright"))


def unlike_neighbours(windows: DataFrame, channels: DataFrame, least: float = 0.5) -> DataFrame:
    """(probe, channel, r, status): correlation of each channel with the median of the two beside it; ``dead`` without variance, ``noisy`` under ``least``.

    windows: (probe, channel, i, v); channels: (probe, channel) in the order of depth.
    """
    order = Window.partitionBy("probe").orderBy("channel")
    beside = channels.select("probe", "channel", F.lag("channel").over(order).alias("_above"), F.lead("channel").over(order).alias("_below"))
    beside = beside.select("probe", "channel", F.explode(F.array("_above", "_below")).alias("other")).where("other IS NOT NULL")
    theirs = beside.join(windows.withColumnsRenamed({"channel": "other", "v": "w"}), ["probe", "other"]).groupBy("probe", "channel", "i").agg(F.median("w").alias("w"))
    both = windows.join(theirs, ["probe", "channel", "i"], "left").groupBy("probe", "channel").agg(F.var_pop("v").alias("own"), F.var_pop("w").alias("other"), F.covar_pop("v", "w").alias("shared"))
    r = F.when((F.col("own") > 1e-18) & (F.col("other") > 1e-18), F.col("shared") / F.sqrt(F.col("own") * F.col("other")))
    return both.select("probe", "channel", r.alias("r"), F.when(F.col("own") <= 1e-18, "dead").when(r < least, "noisy").otherwise("good").alias("status"))


# ---- checks between stages ------------------------------------------------------


def curated(metrics: DataFrame, units: DataFrame, needed: Sequence[str]) -> DataFrame:
    """(probe, status, reason): whether a probe's metrics have the needed columns and a unit was kept.

    metrics: a row per unit; units: (probe, kept).
    """
    lacking = [c for c in needed if c not in metrics.columns]
    rows = metrics.groupBy("probe").agg(F.count("*").alias("n"))
    kept = units.groupBy("probe").agg(F.count_if("kept").alias("kept"))
    both = kept.join(rows, "probe", "full_outer")
    reason = F.when(F.col("n").isNull(), "no_metrics").when(F.lit(bool(lacking)), F.lit("missing_columns")).when(F.coalesce("kept", F.lit(0)) == 0, "no_units_kept")
    return both.select("probe", F.when(reason.isNull(), "pass").otherwise("fail").alias("status"), F.coalesce(reason, F.lit("")).alias("reason"))


def out_of_range(thresholds: DataFrame, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """The rows (name, value) of ratio thresholds that are missing or outside [low, high]."""
    v = F.col("value")
    return thresholds.where(v.isNull() | F.isnan(v) | (v < low) | (v > high))


def stage_outputs(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """(probe, output, status) of wanted outputs: ``pass`` if a file is there and holds something; found: (probe, output, bytes)."""
    sizes = found.groupBy("probe", "output").agg(F.sum("bytes").alias("bytes"))
    joined = wanted.join(sizes, ["probe", "output"], "left")
    return joined.select("probe", "output", F.when(F.col("bytes").isNull(), "missing").when(F.col("bytes") <= 0, "empty").otherwise("pass").alias("status"))


def safe_to_delete(sessions: DataFrame, streams: DataFrame) -> DataFrame:
    """(session, safe, reason): whether originals may go.

    sessions: (session, readable); streams: (session, stream, verified, files), a row
    for each stream that should have been copied.  The first reason that holds is
    given: unreadable, no_files, unverified.
    """
    seen = streams.groupBy("session").agg(F.sum(F.coalesce("files", F.lit(0))).alias("files"), F.count_if(~F.coalesce("verified", F.lit(False))).alias("open"))
    joined = sessions.join(seen, "session", "left")
    reason = F.when(~F.coalesce("readable", F.lit(False)), "unreadable").when(F.coalesce("files", F.lit(0)) == 0, "no_files").when(F.col("open") > 0, "unverified")
    return joined.select("session", reason.isNull().alias("safe"), F.coalesce(reason, F.lit("")).alias("reason"))


def copy_chunks(source: DataFrame, copy: DataFrame, full: bool, keys: Sequence[str] = ("stream",)) -> DataFrame:
    """(keys, compared, differing): chunks (keys, chunk, digest) of a copy against its source, all or the first, middle and last."""
    last = source.groupBy(*keys).agg(F.max("chunk").alias("_last"))
    rows = source.join(last, list(keys))
    if not full:
        rows = rows.where((F.col("chunk") == 0) | (F.col("chunk") == F.expr("_last div 2")) | (F.col("chunk") == F.col("_last")))
    both = rows.join(copy.select(*keys, "chunk", F.col("digest").alias("_copy")), [*keys, "chunk"], "left")
    return both.groupBy(*keys).agg(F.count("*").alias("compared"), F.count_if(~F.col("digest").eqNullSafe(F.col("_copy"))).alias("differing"))


def named_stims(onsets: DataFrame, manifest: DataFrame) -> DataFrame:
    """``onsets`` with stim_name: index 0 and unknown ones have none; an index below 0 or above the manifest's last raises."""
    top = manifest.agg(F.coalesce(F.max("stim_index"), F.lit(0)).alias("_top"))
    joined = onsets.crossJoin(F.broadcast(top)).join(manifest, "stim_index", "left")  # one row, the last index
    bad = (F.col("stim_index") < 0) | (F.col("stim_index") > F.col("_top"))
    name: Column = F.when(bad, F.raise_error(F.concat(F.lit("stimulus out of range: "), F.col("stim_index"))).cast("string")).otherwise(F.coalesce("stim_name", F.lit("")))
    return joined.withColumn("stim_name", name).drop("_top")
