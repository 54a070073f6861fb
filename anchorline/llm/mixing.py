"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document's expected number of
copies is its source's target over its source's size.  Whole copies are certain;
the fractional parts are rounded so that the words of a source add up: of two
fractional documents one gives mass to the other, in words, until one of them is
integral.  Which of the two directions is drawn so that every document keeps its
expectation, and the words of the pair stay the same.

The work is a reduction tree.  The documents of a source are dealt to groups of
bounded size by a hash of their ids; a group leaves at most one fractional
document; those meet in groups of the next level, until one is left for each
source, which is rounded at random.  All draws come from hashes, so reruns agree.

Rows with the same id and source are one unit and get the same copies; rows without
an id are told apart by a hash of their texts, so the rounding can split them.  Defined
results: null text has no words and is never taken, a very long one is counted whole and is
a unit like any other, a null source is a source of
its own, last in order; an empty table gives no rows; other columns are not read
but pass through ``mixed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Weights of the sources in code point order, repeating; words wanted over words there; most copies.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Fractional documents that one group holds on average, and groups that meet in one of the next level.
GROUP, FAN_IN = 20_000, 256
#: Sources up to this number are broadcast, more are joined.
FEW = 10_000
ROUNDED = pa.schema([("s", pa.int32()), ("key", pa.int64()), ("known", pa.bool_()), ("size", pa.int64()), ("part", pa.float64()), ("node", pa.int64())])
ROUNDED_DDL = "s int, key long, known boolean, size long, part double, node long"


def targets(sizes: DataFrame) -> DataFrame:
    """(source, s, source_size, target) from (source, size): s numbers the sources in their order.

    With the sources ordered by limit over weight, the first k stop at their
    limit and the others share the rest by weight, for the least k at which none
    of the others is above its limit.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = common.saved(by, "sources")  # one row for each source from here on
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("s") % len(WEIGHTS) + 1))
    by = by.withColumn("s", F.row_number().over(order) - 1).withColumn("weight", weight).withColumn("limit", MOST * F.col("source_size"))
    everything = Window.partitionBy()
    by = by.withColumn("wanted", SHARE * F.sum("source_size").over(everything)).withColumn("all", F.sum("weight").over(everything))
    up = Window.orderBy(F.col("limit") / F.col("weight"), "s").rowsBetween(Window.unboundedPreceding, -1)
    rate = (F.col("wanted") - F.coalesce(F.sum("limit").over(up), F.lit(0.0))) / (F.col("all") - F.coalesce(F.sum("weight").over(up), F.lit(0.0)))
    by = by.withColumn("rate", rate)
    rank = F.row_number().over(Window.orderBy(F.col("limit") / F.col("weight"), "s"))
    by = by.withColumn("fits", F.when(F.col("rate") * F.col("weight") <= F.col("limit"), F.struct(rank.alias("k"), F.col("rate").alias("rate"))))
    level = F.min("fits").over(everything)["rate"]
    return by.select("source", F.col("s").cast("int").alias("s"), "source_size", F.coalesce(F.least("limit", level * F.col("weight")), F.col("limit")).alias("target"))


def draw(*what: int) -> float:
    """A number from 0 to below 1 that depends on its arguments alone."""
    return (xxhash.xxh64_intdigest(repr(what).encode(), 42) >> 11) / (1 << 53)


def pivotal(sizes: list[int], parts: list[float], keys: list[int]) -> list[float]:
    """Rounds all parts but at most one; the sum of size times part stays as it is, each part in expectation."""
    parts = list(parts)
    held = None
    for i, p in enumerate(parts):
        if not 0.0 < p < 1.0:
            continue
        if held is None:
            held = i
            continue
        j = held
        a, b = sizes[j], sizes[i]
        up = min(a * (1.0 - parts[j]), b * parts[i])  # words that i can give to j
        down = min(a * parts[j], b * (1.0 - parts[i]))
        moved = up if draw(keys[j], keys[i]) * (up + down) < down else -down
        settles_j = (a * (1.0 - parts[j]) <= b * parts[i]) if moved > 0 else (a * parts[j] <= b * (1.0 - parts[i]))
        x, y = parts[j] + moved / a, parts[i] - moved / b
        if settles_j:
            parts[j], parts[i] = (1.0 if moved > 0 else 0.0), y
        else:
            parts[j], parts[i] = x, (0.0 if moved > 0 else 1.0)
        for k in (i, j):  # what rounding leaves within a billionth is settled too
            if abs(parts[k] - round(parts[k])) < 1e-9:
                parts[k] = float(round(parts[k]))
        held = j if 0.0 < parts[j] < 1.0 else i if 0.0 < parts[i] < 1.0 else None
    return parts


def _level(units: DataFrame, last: bool) -> DataFrame:
    """One level of the tree: groups of rows with the same (s, node) leave at most one fractional row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for row in rows:
                if held and (row[0], row[5]) != (held[0][0], held[0][5]):
                    yield from done(held)
                    held = []
                held.append(row)
        if held:
            yield from done(held)

    def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        s, ids, known, sizes, parts, nodes = map(list, zip(*rows))
        parts = pivotal(sizes, parts, [(s[0], i) for i in ids])
        if last:
            parts = [float(draw(s[0], i, 7) < p) if 0.0 < p < 1.0 else p for i, p in zip(ids, parts)]
        yield from common.emit(ROUNDED, [s, ids, known, sizes, parts, np.array(nodes) // FAN_IN])

    return units.repartition("s", "node").sortWithinPartitions("s", "node", F.xxhash64("key"), "known", "key").mapInArrow(of, ROUNDED_DDL)


def _beside(df: DataFrame, sources: DataFrame, on: Column) -> DataFrame:
    """Joined on the source: broadcast where the sources are few, else by a shuffle."""
    return df.join(F.broadcast(sources) if sources.count() <= FEW else sources, on)


def copies(sizes: DataFrame) -> DataFrame:
    """(s, source, key, known, source_size, target, copies): a row for each key of a source; ``sizes``: key, known, source, size."""
    spark = sizes.sparkSession
    common.on_workers(spark)
    sources = common.saved(targets(sizes), "targets").withColumnRenamed("source", "of")
    units = sizes.groupBy("source", "key", "known").agg(F.sum("size").alias("size"))
    units = _beside(units, sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.withColumn("whole", F.floor(expected + F.lit(1e-12)).cast("int"))
    units = units.withColumn("part", F.when(F.col("size") > 0, F.greatest(expected - F.col("whole"), F.lit(0.0))).otherwise(0.0))
    units = common.saved(units.withColumn("part", F.when(F.col("part") < 1e-9, 0.0).otherwise(F.col("part"))), "units")
    n = units.where("part > 0").count()
    groups, levels = 1, 1
    while groups * GROUP < n:
        groups, levels = groups * FAN_IN, levels + 1
    # as many groups on the first level as there are documents for; fewer on each level above
    used = max(1, -(-n // GROUP))
    node = F.pmod(F.xxhash64("key", "s"), F.lit(used))
    left = units.where("part > 0").select("s", "key", "known", "size", "part", node.alias("node"))
    settled = None
    for level in range(levels):
        out = common.saved(_level(left, last=level == levels - 1), "rounded")
        here = out.where("part = 0 OR part = 1").select("s", "key", "known", F.col("part").cast("int").alias("more"))
        settled = here if settled is None else settled.unionByName(here)
        left = out.where("part > 0 AND part < 1")
    found = common.met(units, settled, ["s", "key", "known"], "left")
    return found.select("s", "source", "key", "known", "source_size", "target", (F.col("whole") + F.coalesce("more", F.lit(0))).alias("copies"))


def key() -> Column:
    """What tells the units of a source apart: the id, or the hash of a text without one."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")))


def sized(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), key().alias("key"), doc_id.isNotNull().alias("known"), F.col("source").cast("string").alias("source"), common.n_words(F.col("text").cast("string")).alias("size"))


def op9(docs: DataFrame) -> DataFrame:
    sizes = common.saved(sized(docs), "sizes")
    found = copies(sizes).withColumnsRenamed({"source": "of", "key": "id", "known": "has"})
    joined = sizes.join(found, (F.col("key") == F.col("id")) & (F.col("known") == F.col("has")) & F.col("source").eqNullSafe(F.col("of")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    sizes = common.saved(sized(docs), "sizes")
    found = copies(sizes).where("copies > 0").select(F.col("key").alias("_id"), F.col("known").alias("_known"), F.col("source").alias("_of"), "copies")
    rows = docs.select(F.struct("*").alias("_row"), key().alias("_key"), F.col("doc_id").cast("long").isNotNull().alias("_has"), F.col("source").cast("string").alias("_source"))
    joined = rows.join(found, (F.col("_key") == F.col("_id")) & (F.col("_has") == F.col("_known")) & F.col("_source").eqNullSafe(F.col("_of")))
    return joined.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy")).select("_row.*")
