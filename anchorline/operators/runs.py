"""From decoded codes, behaviour and a photodiode to the table of stimuli that every later stage reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import with_checkpoints
from . import signal, trials
from .sessions import behavior_events


@dataclass(frozen=True)
class RunSettings:
    """Codes of a trial's start and a stimulus, tolerances, and how the photodiode is read."""

    trial_code: int
    stim_code: int
    code_rate: float
    signal_rate: float
    chunk_size: int
    pre: int
    post: int
    high: tuple[int, int]
    trial_tolerance: int = 1
    stim_tolerance: int = 1
    delay_ms: float = 0.0


def stimulus_times(codes: DataFrame, behaviour: DataFrame, given: DataFrame, of: RunSettings) -> DataFrame:
    """(session, trial_id, stim, j, t_us): the sample of the code of each stimulus, null where it has none.

    codes: (session, sample, value), changes of the code; behaviour: (session, trial_id),
    in order; given: (session, trial_id, stim, order_key), stimuli inside trials.  The
    k-th trial is that of the k-th code of a trial; sessions whose numbers differ by more
    than the tolerance have no trial that is placed.
    """
    starts = codes.where(F.col("value") == of.trial_code).select("session", F.col("sample").alias("t_us"))
    placed = trials.truncated(behaviour, starts, ["session"], ["trial_id"], ["t_us"], of.trial_tolerance).where("status = 'ok'")
    edges = codes.where(F.col("value") == of.stim_code).select("session", F.col("sample").alias("t_us"))
    return trials.matched_in_trial(given, edges, placed.select("session", "trial_id", "t_us"), of.stim_tolerance)


def stimulus_table(codes: DataFrame, behaviour: DataFrame, given: DataFrame, chunks: DataFrame, fits: DataFrame, names: DataFrame, of: RunSettings) -> DataFrame:
    """A row for each stimulus (its number as trial_id, its trial as ``trial``): code time, calibrated onset, flag, and the onset in every probe's clock.

    chunks: the photodiode's (session, chunk_id, start_sample, data); fits: (session,
    stream, a, b); names: (session, dataset_name).  Without a calibrated latency the onset
    is the code's time.
    """
    times = stimulus_times(codes, behaviour, given, of)
    rows = times.select("session", F.col("stim").alias("trial_id"), F.col("trial_id").alias("trial"), "j", (F.col("t_us") / of.code_rate).alias("code_s"))
    with_checkpoints(codes.sparkSession)
    rows = rows.checkpoint()  # three joins read what is matched here
    centre = F.floor(F.col("code_s") * of.signal_rate).cast("long")
    found = signal.calibrated(chunks, rows.select("session", "trial_id", centre.alias("centre")), ["session"], of.pre, of.post, of.high, of.chunk_size, 1000.0 / of.signal_rate, of.delay_ms)
    onset = F.col("code_s") + F.coalesce("latency_ms", F.lit(0.0)) / 1000
    onsets = rows.select("session", "trial_id", "code_s").join(found, ["session", "trial_id"]).select("session", "trial_id", onset.alias("onset_s"), "latency_ms", "flag")
    return behavior_events(rows, onsets, fits, names)
