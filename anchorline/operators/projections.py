"""Row-wise exports, templates and small per-session summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import hash_order, safe_corr
from .sweeps import UNIT


def json_map(text: Column) -> Column:
    """A JSON object of numbers as a map."""
    return F.from_json(text, "map<string,double>")


def marker_size(rate: Column, top: Column, least: float, most: float) -> Column:
    """Size between two bounds by the logarithm of the rate against the greatest."""
    share = F.when(top > 0, F.log1p(rate) / F.log1p(top)).otherwise(0.0)
    return least + (most - least) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def region_key(probes: DataFrame, keys: Sequence[str], order: str, area: str) -> DataFrame:
    """The areas of a session's probes, joined by - in the order of the probes."""
    ordered = F.array_sort(F.collect_list(F.struct(order, area)))
    return probes.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x[area]), "-").alias("region"))


def safe_id(text: Column, position: Column) -> Column:
    """The text as a number, else the row's position."""
    return F.coalesce(text.try_cast("bigint"), position)


def unit_prop(units: DataFrame, probe: str, unit: str, place: str) -> DataFrame:
    """Row number within the probe, from 0, the unit's id and its first two coordinates."""
    row = F.row_number().over(Window.partitionBy(probe).orderBy(unit)) - 1
    return units.select(probe, row.alias("row"), F.col(unit).alias("ks_id"), F.slice(place, 1, 2).alias("unit_pos"))


def trial_record(trials: DataFrame) -> DataFrame:
    """Trials for export: missing index -1, missing name blank, validity as fix_success."""
    have = set(trials.columns)
    index = F.coalesce("stim_index", F.lit(-1)) if "stim_index" in have else F.lit(-1)
    name = F.coalesce("stim_name", F.lit("")) if "stim_name" in have else F.lit("")
    return trials.select("trial_id", "t_us", index.alias("stim_index"), name.alias("stim_name"), F.coalesce("valid", F.lit(True)).alias("fix_success"))


def new_ids(units: DataFrame, probe: str, unit: str) -> DataFrame:
    """Ids from 1 over all probes, in order of probe and unit; nothing is scored yet.

    A unit's id is its rank in its probe and the number of units of the probes before;
    only the table of probes passes through one task.
    """
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = units.groupBy(F.col(probe).alias("_p")).agg((F.countDistinct(unit) + F.max(F.col(unit).isNull().cast("int"))).alias("_n"))
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = units.select(probe, unit, F.dense_rank().over(Window.partitionBy(probe).orderBy(unit)).alias("_k"))
    joined = ranked.join(offsets, F.col(probe).eqNullSafe(F.col("_p")))
    return joined.select(probe, unit, (F.col("_before") + F.col("_k")).cast("int").alias("new_id"), F.lit("UNCLASSIFIED").alias("unittype"), F.lit(None).cast("double").alias("score"))


def moved_in_time(spikes: DataFrame, offset_s: float, rate: float) -> DataFrame:
    """Spikes of a sliced run (column ``sample``) with their times in the whole recording; a run without spikes raises when it is read."""
    moved = spikes.withColumn("t", F.col("sample") / rate + offset_s)
    # no row, or an error: a column that holds the test would be dropped unread
    test = F.when(F.col("_all") > 0, False).otherwise(F.raise_error(F.lit("no units were found")).cast("boolean"))
    nothing = spikes.agg(F.count("*").alias("_all")).where(test).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in moved.schema))
    return moved.unionByName(nothing)


def peak(template: Column) -> Column:
    """Position, from 0, of the greatest size; the first on ties."""
    sizes = F.transform(template, lambda v, i: F.struct(F.abs(v).alias("a"), (-i).alias("i")))
    return -F.array_max(sizes)["i"]


def cropped(template: Column, at: Column, before: int, after: int) -> Column:
    """The samples from ``before`` ahead of a place to ``after`` behind it, cut at the ends."""
    first = F.greatest(F.lit(0), at - before)
    return F.slice(template, first + 1, F.least(F.size(template), at + after) - first)


def mean_template(units: DataFrame, kind: str, template: str) -> DataFrame:
    """Mean of each sample over the units of a kind."""
    return units.select(kind, F.posexplode(template).alias("sample", "v")).groupBy(kind, "sample").agg(F.avg("v").alias("mean"), F.count("*").alias("n"))


def psth_reliability(cells: DataFrame, seed: int, bins: int) -> DataFrame:
    """Correlation over bins of the rates of two random halves of the trials, per unit; empty bins are zeros."""
    sums = cells.withColumn("_h", half(seed)).groupBy(*UNIT, "bin").agg(F.sum(F.when(F.col("_h") == 0, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("_h") == 1, F.col("n")).otherwise(0)).alias("b"))
    grid = sums.select(*UNIT).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return _halves(grid.join(sums, [*UNIT, "bin"], "left").fillna(0, ["a", "b"]))


def half(seed: int) -> Column:
    """The random half, 0 or 1, that a trial is in."""
    return F.conv(F.substring(hash_order(seed, "trial_id"), 1, 1), 16, 10).cast("int") % 2


def courses_reliability(sums: DataFrame, bins: int) -> DataFrame:
    """psth_reliability from spikes per unit and half as lists by bin, (unit, by, n), as sweeps.bin_parts gives them: both halves are added in one go."""
    side = lambda h: F.array(*(F.sum(F.when(F.col("by") == h, F.col("n")[i]).otherwise(0)) for i in range(bins)))
    both = sums.groupBy(*UNIT).agg(side(0).alias("a"), side(1).alias("b"))
    return _halves(both.select(*UNIT, F.explode(F.arrays_zip("a", "b")).alias("_c")).select(*UNIT, "_c.a", "_c.b"))


def _halves(full: DataFrame) -> DataFrame:
    return full.groupBy(*UNIT).agg(safe_corr(F.col("a").cast("double"), F.col("b").cast("double")).alias("r"))


def first_name(trials: DataFrame, keys: Sequence[str], name: str, order: str) -> DataFrame:
    """The first name that is not blank, and whether names vary."""
    named = F.col(name) != ""
    return trials.groupBy(*keys).agg(F.min_by(F.when(named, F.col(name)), F.when(named, F.col(order))).alias("name"), (F.countDistinct(F.when(named, F.col(name))) > 1).alias("varies"))


def median_window(trials: DataFrame, keys: Sequence[str], onset: str, offset: str, default: float = 800.0) -> DataFrame:
    """Median onset plus median offset, and the longest sum, with a default for none."""
    return trials.groupBy(*keys).agg((F.median(onset) + F.median(offset)).alias("window"), F.coalesce(F.max(F.col(onset) + F.col(offset)), F.lit(default)).alias("longest"))
