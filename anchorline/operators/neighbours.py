"""Pairs of near units and nearest places without comparing all with all."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import with_checkpoints

#: Entries of a template that make up one part of it; what rounding may add to a bound.
PART, SLACK = 8, 1e-9


def parts(template: Column, width: int = PART) -> Column:
    """Norms of the template's parts of ``width`` entries, over the norm of the whole; empty without one."""
    square = F.transform(template, lambda v: v.cast("double") * v)
    total = F.aggregate(square, F.lit(0.0), lambda s, v: s + v)
    n = F.ceil(F.size(template) / width).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.sqrt(F.aggregate(F.slice(square, i * width + 1, width), F.lit(0.0), lambda s, v: s + v) / total))
    return F.when(total > 0, each).otherwise(F.array().cast("array<double>"))


def heavy(norms: Column, least: float) -> Column:
    """The fewest parts, the largest first, beyond which less than half of ``least`` of the norm is left.

    If two templates have no heavy part in common, either's heavy parts meet only what
    is left of the other, so their cosine is below ``least``.
    """
    order = F.array_sort(F.transform(norms, lambda x, i: F.struct((-x * x).alias("x"), i.alias("i"))))
    stop = (least / 2) ** 2 - SLACK
    start = F.struct(F.lit(1.0).alias("rest"), F.array().cast("array<int>").alias("held"))
    taken = F.aggregate(order, start, lambda s, p: F.when(s["rest"] < stop, s).otherwise(F.struct((s["rest"] + p["x"]).alias("rest"), F.array_append(s["held"], p["i"]).alias("held"))))
    return taken["held"]


def candidates(a: DataFrame, b: DataFrame, keys: Sequence[str], least_cosine: float, within: float | None = None, width: int = PART) -> DataFrame:
    """(keys, unit_a, unit_b): pairs, each once, that hold all of a cosine of ``least_cosine`` or more, by an equality on light rows.

    Units meet if they share a heavy part and, where ``within`` bounds the distance, lie
    in neighbouring cells of that width.  Rows (keys, unit_id, template, x, y).
    """
    if least_cosine <= 0:
        raise ValueError("without a positive least cosine every pair is wanted")

    def side(rows: DataFrame, name: str) -> DataFrame:
        part = F.explode(heavy(parts(F.col("template"), width), least_cosine)).alias("_part")
        return rows.select(*keys, F.col("unit_id").alias(f"unit_{name}"), "x", "y", part)

    left, right, on = side(a, "a"), side(b, "b"), [*keys, "_part"]
    if within is not None:
        cell = lambda c: F.floor(F.col(c) / within)
        left = left.withColumn("_cx", F.explode(F.sequence(cell("x") - 1, cell("x") + 1))).withColumn("_cy", F.explode(F.sequence(cell("y") - 1, cell("y") + 1)))
        right = right.withColumn("_cx", cell("x")).withColumn("_cy", cell("y"))
        on += ["_cx", "_cy"]
    return left.drop("x", "y").join(right.drop("x", "y"), on).select(*keys, "unit_a", "unit_b").distinct()


def close_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], least_cosine: float, within: float | None = None, bound: Column | None = None, width: int = PART) -> DataFrame:
    """(keys, unit_a, unit_b, cos, d_xy): the pairs of the same keys with a cosine of ``least_cosine`` or more, at most ``within`` apart.

    A candidate is dropped by the sum of the products of its parts' norms, which no cosine
    exceeds, before the cosine is computed; ``bound`` is a greater least cosine by ``d_xy``.
    """
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    product = lambda x, y: total(F.zip_with(x, y, lambda p, q: p.cast("double") * q))

    def side(rows: DataFrame, name: str) -> DataFrame:
        square = product(F.col("template"), F.col("template"))
        return rows.select(*keys, F.col("unit_id").alias(f"unit_{name}"), F.col("template").alias(f"_t{name}"), F.col("x").alias(f"_x{name}"), F.col("y").alias(f"_y{name}"), parts(F.col("template"), width).alias(f"_n{name}"), square.alias(f"_s{name}"))

    met = candidates(a, b, keys, least_cosine, within, width).join(side(a, "a"), [*keys, "unit_a"]).join(side(b, "b"), [*keys, "unit_b"])
    met = met.withColumn("d_xy", F.sqrt((F.col("_xa") - F.col("_xb")) ** 2 + (F.col("_ya") - F.col("_yb")) ** 2))
    need = F.lit(least_cosine) if bound is None else F.greatest(F.lit(least_cosine), bound)
    fits = product(F.col("_na"), F.col("_nb")) >= need - SLACK
    met = met.where(fits if within is None else (F.col("d_xy") <= within) & fits)
    cosine = product(F.col("_ta"), F.col("_tb")) / F.sqrt(F.col("_sa") * F.col("_sb"))
    return met.select(*keys, "unit_a", "unit_b", cosine.alias("cos"), "d_xy").where(F.col("cos") >= least_cosine)


def similar_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], least: float, width: int = PART) -> DataFrame:
    """The pairs whose blend of cosine and distance, 0.7 cos + 0.3 exp(-d / 100), is ``least`` or more, above 0.3."""
    # with the cosine at 1, only places within this distance can reach it
    within = -100 * math.log((least - 0.7) / 0.3) + SLACK if least > 0.7 else None
    bound = (least - 0.3 * F.exp(-F.col("d_xy") / 100)) / 0.7
    found = close_pairs(a, b, keys, (least - 0.3) / 0.7 - SLACK, within, bound, width)
    return found.withColumn("sim", 0.7 * F.col("cos") + 0.3 * F.exp(-F.col("d_xy") / 100)).where(F.col("sim") >= least)


def nearest(places: DataFrame, keys: Sequence[str], name: str, k: int) -> DataFrame:
    """(keys, name, near, d, rank): the k nearest other places of each, ties to the smaller name.

    A place meets those of its own and the eight cells around it; what lies outside is
    further off than a cell's width, so a place whose k-th distance is at most that is
    settled.  The others are tried again with cells of twice the width, which are at last
    as wide as all places of their keys.  The first width leaves about k places to a cell.
    """
    with_checkpoints(places.sparkSession)
    rows = places.select(*keys, name, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    across, up = F.max("x") - F.min("x"), F.max("y") - F.min("y")
    wide = F.greatest(across, up)
    sizes = rows.groupBy(*keys).agg(wide.alias("_wide"), F.greatest(F.sqrt(across * up * k / F.count("*")), wide * k / F.count("*")).alias("_w"))
    rows = rows.join(sizes.withColumn("_w", F.when(F.col("_w") > 0, F.col("_w")).otherwise(1.0)), list(keys)).checkpoint()
    other = rows.select(*keys, F.col(name).alias("near"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("_w").alias("_own"))
    order = Window.partitionBy(*keys, name).orderBy("d", "near")
    left, found, step = rows, None, 1
    while True:
        w = F.col("_w") * step
        cell = lambda c: F.floor(F.col(c) / w)  # noqa: E731,B023
        mine = left.withColumn("_cx", F.explode(F.sequence(cell("x") - 1, cell("x") + 1))).withColumn("_cy", F.explode(F.sequence(cell("y") - 1, cell("y") + 1)))
        theirs = other.withColumn("_cx", F.floor(F.col("_x") / (F.col("_own") * step))).withColumn("_cy", F.floor(F.col("_y") / (F.col("_own") * step)))
        met = mine.join(theirs, [*keys, "_cx", "_cy"]).where(F.col(name) != F.col("near"))
        d = F.sqrt((F.col("x") - F.col("_x")) ** 2 + (F.col("y") - F.col("_y")) ** 2)
        best = met.withColumn("d", d).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        # a place without neighbours yet has no row here
        last = best.groupBy(*keys, name).agg(F.count("*").alias("_n"), F.max("d").alias("_far"))
        state = left.join(last, [*keys, name], "left").withColumn("_done", (w >= F.col("_wide")) | ((F.coalesce("_n", F.lit(0)) >= k) & (F.col("_far") <= w)))
        state = state.select(*left.columns, "_done").checkpoint()
        settled = best.join(state.where("_done").select(*keys, name), [*keys, name], "left_semi").select(*keys, name, "near", "d", "rank").checkpoint()
        found = settled if found is None else found.unionByName(settled)
        left = state.where("NOT _done").drop("_done")
        if left.isEmpty():
            return found
        step *= 2
