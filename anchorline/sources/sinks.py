"""Result tables: trials, units, eye series and versioned output."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import unknown_updates, update_join
from .commits import commit_version


def trials_table(events: DataFrame, onsets: DataFrame, probes: Sequence[str], reference: str, default_ms: float = 150.0) -> DataFrame:
    """Trials with start and stop in the reference probe's clock and one onset column for each probe.

    onsets: (trial_id, probe_id, t_s); a missing validity becomes true.
    """
    wide = onsets.groupBy("trial_id").pivot("probe_id", list(probes)).agg(F.first("t_s"))
    wide = wide.select("trial_id", *(F.col(p).alias(f"stim_onset_{p}") for p in probes))
    start = F.col(f"stim_onset_{reference}")
    joined = events.join(wide, "trial_id", "left")
    return joined.select("*", start.alias("start_time"), (start + F.coalesce("duration_ms", F.lit(default_ms)) / 1000).alias("stop_time")).withColumn("trial_valid", F.coalesce("trial_valid", F.lit(True)))


def units_table(spikes: DataFrame, metrics: DataFrame, keys: Sequence[str] = ("session", "probe", "unit_id"), merged: DataFrame | None = None) -> DataFrame:
    """Units with their metrics, their spike times as one sorted array, and, by ``merged`` (keys, merged_from), the units they were made of, none for most."""
    trains = spikes.groupBy(*keys).agg(F.array_sort(F.collect_list("t_us")).alias("spike_times_us"))
    out = metrics.join(trains, list(keys), "left").withColumn("spike_times_us", F.coalesce("spike_times_us", F.array().cast("array<long>")))
    if merged is None:
        return out
    return out.join(merged.select(*keys, "merged_from"), list(keys), "left").withColumn("merged_from", F.coalesce("merged_from", F.array().cast("array<long>")))


def probe_fits(fits: DataFrame) -> DataFrame:
    """One row for each probe of a session, without the reference: slope, intercept, residual, repaired pulses and whether the fit is to be used."""
    usable = (F.col("status") == "ok") & F.col("a").isNotNull()
    return fits.select("session", F.col("stream").alias("probe"), "a", "b", "residual_ms", "n_repaired", "status", usable.alias("usable"))


def writable(units: DataFrame, trials: DataFrame, keys: Sequence[str] = ("session", "probe")) -> DataFrame:
    """(keys, status): what is exported: ``skip_no_units``, ``skip_no_trials`` for a session without a valid trial, else ``write``.

    units: (keys, unit_id), null ids for probes without units; trials: (session, valid).
    """
    n = units.groupBy(*keys).agg(F.count("unit_id").alias("_units"))
    t = trials.groupBy("session").agg(F.count_if(F.coalesce("valid", F.lit(False))).alias("_trials"))
    status = F.when(F.col("_units") == 0, "skip_no_units").when(F.coalesce("_trials", F.lit(0)) == 0, "skip_no_trials").otherwise("write")
    return n.join(t, "session", "left").select(*keys, status.alias("status"))


def padded(values, width: int):
    """An array with nulls at its end up to ``width``."""
    return F.concat(values, F.array_repeat(F.lit(None).cast("double"), F.greatest(F.lit(0), F.lit(width) - F.size(values))))


def eye_series(eye: DataFrame, interval_ms: float | None = None) -> DataFrame:
    """Per-trial blocks one after another in trial order: ``index`` is the sample's place in the whole series, ``rate`` in Hz follows the interval."""
    from pyspark.sql import Window

    sizes = eye.groupBy("session", "trial_id").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("session").orderBy("trial_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("session", "trial_id", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    return eye.join(offsets, ["session", "trial_id"]).withColumns({"index": F.col("_at") + F.col("i"), "rate": F.lit(1000.0 / interval_ms if interval_ms else None).cast("double")}).drop("_at")


def write_update(original: DataFrame, updates: DataFrame, key: str, root: str) -> DataFrame:
    """Commits the updated rows as the next version and reports it in a row: version, rows before and after, updates of unknown keys.

    The original is left as it is, and so is every version before.
    """
    spark = original.sparkSession
    path = commit_version(update_join(original, updates, key), root)
    written = spark.read.parquet(path)
    one = lambda df, name: df.agg(F.count("*").alias(name))
    return one(original, "rows_before").join(one(written, "rows_after")).join(one(unknown_updates(original, updates, key), "unknown")).select(F.lit(path.rsplit("=", 1)[1]).alias("version"), "*")


def write_metrics(units: DataFrame, root: str, needed: Sequence[str] = ("unit_id",)) -> str:
    """Quality metrics and labels as CSV with a header; columns that are needed must be there."""
    if lacking := [c for c in needed if c not in units.columns]:
        raise ValueError(f"the metrics lack {', '.join(lacking)}")
    return commit_version(units, root, "csv", header="true")


def write_scores(units: DataFrame, root: str) -> str:
    """(unit_id, score, is_visual): a missing flag is false."""
    return commit_version(units.select("unit_id", "score", F.coalesce("is_visual", F.lit(False)).alias("is_visual")), root)


def merge_log(merged: DataFrame, config: dict, manifest: DataFrame | None = None) -> DataFrame:
    """(new_id, merged_from, config, manifest): one row for each unit made of several, with the run's settings and resolved manifest.

    merged: (unit_id, merged_from), from ``merged_units``; manifest: (path, source), one row.
    """
    rows = merged.where(F.size("merged_from") > 1).select(F.col("unit_id").alias("new_id"), "merged_from", F.lit(json.dumps(config, sort_keys=True)).alias("config"))
    if manifest is None:
        return rows.withColumn("manifest", F.lit(None).cast("string"))
    source = manifest.limit(1).select(F.concat_ws(" ", "source", "path").alias("manifest"))
    return rows.join(source, how="left")


def write_sorter_columns(spikes: DataFrame, root: str) -> str:
    """(probe, unit_id, template_id, amplitude) beside the spikes, dealt by probe so that a probe's rows lie together."""
    return commit_version(spikes.select("probe", "unit_id", "template_id", "amplitude").repartition("probe", "unit_id").sortWithinPartitions("probe", "unit_id"), root)


def write_sessions(df: DataFrame, path: str, keys: Sequence[str] = ("session", "probe")) -> None:
    """One folder for each session and probe; empty ones do not come about."""
    df.repartition(*keys).write.partitionBy(*keys).mode("overwrite").parquet(path)


def sync_audit(fits: DataFrame, onsets: DataFrame) -> DataFrame:
    """Per session one JSON text of all clock fits and the counts of trials."""
    f = fits.groupBy("session").agg(F.to_json(F.array_sort(F.collect_list(F.struct("stream", "a", "b", "residual_ms", "status")))).alias("fits"))
    n = onsets.groupBy("session").agg(F.count("*").alias("n_trials"))
    return f.join(n, "session", "full_outer")


def require(found: DataFrame, condition: str, message: str) -> DataFrame:
    """``found``, raising where a row misses the condition."""
    return found.withColumn("_ok", F.assert_true(F.expr(condition), message)).drop("_ok")


def expected_rows(found: DataFrame, wanted: int) -> DataFrame:
    """A row that tells whether a written table has as many rows as it should."""
    return found.agg(F.count("*").alias("rows")).select("rows", F.lit(wanted).alias("expected"), F.when(F.col("rows") == wanted, "pass").otherwise("fail").alias("status"))
