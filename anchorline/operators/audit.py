"""What a run says about itself: missing sample ranges, audit rows, agreement of two runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .population import compared, means, rsm


def missing_ranges(expected: DataFrame, present: DataFrame, keys: Sequence[str] = ("stream",)) -> DataFrame:
    """(keys, first, last, reason): ranges [first, last) of samples that a copy lacks and that are to be written again.

    expected: (keys, n_samples); present: (keys, start, n), chunks in any order that may
    overlap.  Chunks are read in order, one row each, beside the greatest end before
    them; reason is ``missing`` for a stream without chunks, ``hole`` between chunks and
    ``short`` after the last.  What is present beyond the expected end, or of streams
    that are not expected, counts for nothing.
    """
    before = Window.partitionBy(*keys).orderBy("start", "_end").rowsBetween(Window.unboundedPreceding, -1)
    held = present.where("n > 0").withColumn("_end", F.col("start") + F.col("n")).join(expected.select(*keys, "n_samples"), list(keys))
    held = held.withColumn("_covered", F.coalesce(F.max("_end").over(before), F.lit(0)))
    holes = held.where((F.col("start") > F.col("_covered")) & (F.col("_covered") < F.col("n_samples")))
    holes = holes.select(*keys, F.col("_covered").alias("first"), F.least("start", "n_samples").alias("last"), F.lit("hole").alias("reason"))
    ends = present.where("n > 0").groupBy(*keys).agg(F.max(F.col("start") + F.col("n")).alias("_end"))
    tails = expected.join(ends, list(keys), "left").where(F.coalesce("_end", F.lit(0)) < F.col("n_samples"))
    tails = tails.select(*keys, F.coalesce("_end", F.lit(0)).alias("first"), F.col("n_samples").alias("last"), F.when(F.col("_end").isNull(), "missing").otherwise("short").alias("reason"))
    # a copy whose only chunks lie beyond a hole at its beginning is holed there
    return holes.unionByName(tails)


def audit_rows(parts: dict[str, DataFrame], key: str = "session") -> DataFrame:
    """(key, kind, payload): every row of the named tables as a VARIANT; a null field is left out.

    The tables may have different columns, and the same table other columns in other
    runs: rows of all of them go into one table.
    """
    rows = [df.select(key, F.lit(kind).alias("kind"), F.parse_json(F.to_json(F.struct(*(c for c in df.columns if c != key)))).alias("payload")) for kind, df in parts.items()]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def audited(field: str, kind: str) -> Column:
    """A field of the payload; null where it is absent or of another kind."""
    return F.try_variant_get("payload", f"$.{field}", kind)


def agreement_summary(pairs: DataFrame, value: str, kind: str, cuts: Sequence[float]) -> DataFrame:
    """Per kind of unit and over ALL: number, quartiles and shares of ``value`` at or above each cut."""
    each = pairs.withColumn("_kind", F.explode(F.array(F.col(kind).cast("string"), F.lit("ALL"))))
    v = F.col(value)
    shares = [(F.count_if(v >= c) / F.count(v)).alias(f"share_{round(100 * c)}") for c in cuts]
    quartiles = [F.percentile(v, F.lit(q)).alias(f"p{round(100 * q)}") for q in (0.25, 0.5, 0.75)]
    return each.groupBy(F.col("_kind").alias(kind)).agg(F.count(v).alias("n"), *quartiles, *shares)


def matched_subset(a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """Matrices of two runs compared for all units and for the paired ones, over all trials and over the valid ones.

    a, b: (stim, trial, unit, value, valid); pairs: (unit_a, unit_b).  The units of b are
    taken by their pairs' ids, never by their place.
    """
    def tagged(rows: DataFrame, ids: DataFrame) -> DataFrame:
        paired = rows.join(ids, "unit", "left_semi")
        both = rows.withColumn("units", F.lit("full")).unionByName(paired.withColumn("units", F.lit("matched")))
        which = F.when(F.coalesce("valid", F.lit(False)), F.array(F.lit("all"), F.lit("valid"))).otherwise(F.array(F.lit("all")))
        return both.withColumn("trials", F.explode(which))

    keys = ("units", "trials")
    left = tagged(a, pairs.select(F.col("unit_a").alias("unit")))
    right = tagged(b, pairs.select(F.col("unit_b").alias("unit")))
    # the paired units of b get the names of their partners
    names = pairs.select(F.col("unit_b").alias("unit"), F.col("unit_a").alias("_name"), F.lit("matched").alias("units"))
    right = right.join(names, ["units", "unit"], "left").withColumn("unit", F.coalesce("_name", "unit")).drop("_name")
    return compared(rsm(means(left, keys), keys), rsm(means(right, keys), keys), keys)


def merged_bounds(defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """(layer, metric, op, bound): the default thresholds with those that an override names replaced, others of the same metric kept; a null override takes a bound away."""
    on = ["layer", "metric", "op"]
    new = overrides.select(*on, F.col("bound").alias("_new"), F.lit(True).alias("_hit"))
    both = defaults.join(new, on, "full_outer")
    return both.select(*on, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("bound")).alias("bound")).where("bound IS NOT NULL")


def distinct_in_order(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The distinct values of ``keys`` with the least ``order`` of each, to sort them by first occurrence."""
    return rows.groupBy(*keys).agg(F.min(order).alias(order))


def probe_times(rows: DataFrame, column: str, probe: str, missing: str = "null") -> DataFrame:
    """``rows`` with ``t``, a probe's entry of a JSON text {probe: seconds}; a probe that is missing gives null, or raises for ``error``."""
    found = F.from_json(F.col(column), "map<string,double>")[probe]
    if missing == "error":
        found = F.when(found.isNull(), F.raise_error(F.lit(f"no time of {probe}")).cast("double")).otherwise(found)
    return rows.withColumn("t", found)
