"""Digital codes and behaviour trials: decoding, edges, bit search, matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import anchor_before, ordinal


def repacked(word: Column, bits: Sequence[int]) -> Column:
    """The bits of a word, in the order given, as a number."""
    parts = [F.shiftleft(F.shiftright(word, b).bitwiseAND(F.lit(1)), i) for i, b in enumerate(bits)]
    return sum(parts[1:], parts[0])


def carried(chunks: DataFrame, keys: Sequence[str], data: Column) -> DataFrame:
    """Chunks with ``_x`` (the data) and ``_before`` (the last value of the chunk before): one row a chunk is ordered, never samples."""
    with_last = chunks.withColumn("_x", data).withColumn("_last", F.element_at("_x", -1))
    return with_last.withColumn("_before", F.lag("_last").over(Window.partitionBy(*keys).orderBy("start_sample")))


def changes(chunks: DataFrame, keys: Sequence[str], data: Column, rising: bool) -> DataFrame:
    """(keys, sample, value) where the data change; only steps from 0 to 1 for ``rising``."""
    rows = carried(chunks.where(F.size("data") > 0), keys, data)
    before = F.concat(F.array("_before"), F.slice("_x", 1, F.size("_x") - 1))
    pairs = F.transform(F.arrays_zip(before.alias("p"), F.col("_x").alias("v")), lambda z, i: F.struct(i.alias("i"), z["p"].alias("p"), z["v"].alias("v")))
    step = (lambda z: (z["p"] == 0) & (z["v"] == 1)) if rising else (lambda z: z["p"] != z["v"])
    hit = rows.select(*keys, "start_sample", F.explode(F.filter(pairs, step)).alias("z"))
    return hit.select(*keys, (F.col("start_sample") + F.col("z.i")).alias("sample"), F.col("z.v").alias("value"))


def rising_edges(chunks: DataFrame, bit: int, keys: Sequence[str] = ("session",)) -> DataFrame:
    """Samples at which a bit goes from 0 to 1."""
    return changes(chunks, keys, F.transform("data", lambda w: F.shiftright(w, bit).bitwiseAND(F.lit(1))), True)


def code_changes(chunks: DataFrame, bits: Sequence[int], keys: Sequence[str] = ("session",)) -> DataFrame:
    """Samples at which the code of some bits changes, and the new code."""
    return changes(chunks, keys, F.transform("data", lambda w: repacked(w, bits)), False)


def trial_bit(codes: DataFrame, n_trials: DataFrame, tolerance: int) -> DataFrame:
    """Per session the bit 0-7 whose lone code comes closest to the number of trials; the lowest on ties.

    ``n_trials``: (session, n).  ``status`` is ``no_bit`` beyond the tolerance.
    """
    bits = n_trials.select("session", "n", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    counts = codes.groupBy("session", "code").agg(F.count("*").alias("codes"))
    bits = bits.withColumn("code", F.expr("shiftleft(1, bit)"))
    counted = bits.join(counts, ["session", "code"], "left").select("session", "n", "bit", F.coalesce("codes", F.lit(0)).alias("codes"))
    off = counted.withColumn("off", F.abs(F.col("codes") - F.col("n")))
    best = off.groupBy("session").agg(F.min_by(F.struct("bit", "codes", "off"), F.struct("off", "bit")).alias("best"))
    return best.select("session", "best.bit", "best.codes", F.when(F.col("best.off") <= tolerance, "ok").otherwise("no_bit").alias("status"))


def stim_bit(codes: DataFrame, n_stims: DataFrame, exclude: DataFrame) -> DataFrame:
    """Per session the lowest bit, other than the excluded one, with exactly n codes; -1 for none."""
    counts = codes.groupBy("session", "code").agg(F.count("*").alias("codes"))
    bit = F.when(F.log2("code") == F.floor(F.log2("code")), F.log2("code").cast("int"))
    found = counts.withColumn("bit", bit).join(n_stims, "session").join(exclude.select("session", F.col("bit").alias("not")), "session").where("codes = n AND bit <> not AND bit <= 7").groupBy("session").agg(F.min("bit").alias("bit"))
    return n_stims.select("session").join(found, "session", "left").select("session", F.coalesce("bit", F.lit(-1)).alias("bit"))


def truncated(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[str], right_order: Sequence[str], tolerance: int) -> DataFrame:
    """Both sides cut to the shorter, matched in order; ``status`` where they differ by more than the tolerance."""
    a, b = ordinal(left, keys, left_order), ordinal(right, keys, right_order)
    na = left.groupBy(*keys).agg(F.count("*").alias("n_left"))
    nb = right.groupBy(*keys).agg(F.count("*").alias("n_right"))
    sizes = na.join(nb, list(keys), "full_outer").select(*keys, F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))
    off = F.abs(F.col("n_left") - F.col("n_right"))
    return a.join(b, [*keys, "ord"]).join(sizes, list(keys)).withColumn("status", F.when(off <= tolerance, "ok").otherwise("counts_differ"))


def matched_in_trial(given: DataFrame, edges: DataFrame, trials: DataFrame, tolerance: int, keys: Sequence[str] = ("session",)) -> DataFrame:
    """j-th behaviour stimulus of a trial to the trial's j-th edge.

    given: (keys, trial_id, stim, order_key); edges: (keys, t_us); trials: (keys,
    trial_id, t_us).  An edge belongs to the trial that began last; all are null
    if the counts differ by more than the tolerance, else only the surplus.
    """
    placed = anchor_before(edges, trials.select(*keys, "trial_id", F.col("t_us").alias("_start")), keys, "t_us", "trial_id", "_start").where(F.col("trial_id").isNotNull())
    of = [*keys, "trial_id"]
    found = placed.groupBy(*of).agg(F.count("*").alias("n_edges"))
    wanted = given.groupBy(*of).agg(F.count("*").alias("n_given"))
    joined = ordinal(given, of, ["order_key"]).join(ordinal(placed, of, ["t_us"]), [*of, "ord"], "left").join(wanted, of).join(found, of, "left")
    fits = F.abs(F.col("n_given") - F.coalesce("n_edges", F.lit(0))) <= tolerance
    return joined.select(*of, "stim", F.col("ord").alias("j"), F.when(fits, F.col("t_us")).alias("t_us"))


def expanded(trials: DataFrame, stims: DataFrame, keys: Sequence[str] = ("session",)) -> DataFrame:
    """A row for each stimulus of a trial; a trial without one keeps a single row of nulls."""
    return trials.join(stims, [*keys, "trial_id"], "left")


def reversals(times: DataFrame, keys: Sequence[str], order: str, time: str) -> DataFrame:
    """How many rows are not later than the row before."""
    step = F.col(time) - F.lag(time).over(Window.partitionBy(*keys).orderBy(order))
    return times.withColumn("_step", step).groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("_step") <= 0).alias("reversals"))
