"""Hard-negative mining by a secondary-sort shuffle.

For each anchor the best rows of its own label are its positives, and for each
positive the best rows of other labels whose score lies between two shares of the
positive's score are its hard negatives.  A score is the integer inner product of two
vectors; higher scores come first, ties by the smaller id.

1. Rows are dealt into blocks of about ``ROWS`` by a hash of their ids.  In a shuffle
   sorted by block the rows of a block come first and then every anchor, so a task
   holds one block and lets the anchors, a stated set of queries, stream past it.
2. Of a block only what can be among the answers leaves the task: first the best
   ``positives`` of an anchor's label, then, when the anchor's positives are known, the
   best ``negatives`` inside each positive's window.  This loses nothing, as no more
   than that of one block can be among the best of all.
3. What is left is packed into keys (anchor, descending score, id) and goes through
   ``repartitionAndSortWithinPartitions``.  An iterator over the sorted keys opens a
   window at each positive, emits the negatives that fall into it and closes it when it
   is full or passed, so no anchor's rows are held.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component, take no part; of rows with the same id the one with the least (label,
vector) counts; a vector that is shorter than another counts as filled up with zeros; a
positive with a score below zero has no window; an anchor alone in its label has no
rows; an empty table gives none; other columns are not read.  Scores that may not fit 64
bits are an error.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from . import common

#: Rows of a block, anchors that are scored against it at once, most partitions of the blocks.
ROWS, AT_ONCE, PARTITIONS = 8192, 256, 10_000
#: Whole steps of a component's unit.
STEPS = 256
SCORED = pa.schema([("anchor_id", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])
SCORED_DDL = "anchor_id long, score long, vec_id long"
MINED_DDL = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
KEY, SHIFT = struct.Struct(">QQBQ"), 1 << 63
POSITIVE, NEGATIVE = 0, 1


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, components as doubles."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)


def matrix(column: pa.ListArray, dims: int = 0) -> np.ndarray:
    """The lists as rows, filled up with zeros to the longest or to ``dims``."""
    bounds = column.offsets.to_numpy()
    sizes, values = np.diff(bounds), column.values.to_numpy()[bounds[0] : bounds[-1]]
    dims = max(dims, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), dims), values.dtype)
    out[np.arange(dims)[None, :] < sizes[:, None]] = values
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; by doubles where these hold them."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims], b[:, :dims]
    most = dims * max(map(abs, (int(a.min(initial=0)), int(a.max(initial=0))))) * max(map(abs, (int(b.min(initial=0)), int(b.max(initial=0)))))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    raise OverflowError("scores do not fit 64 bits")


def best(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Those of the positions ``at``, which ascend, with the ``k`` highest scores; of equal ones the first."""
    if len(at) > k:
        least = np.partition(scores, len(at) - k)[len(at) - k]
        near = scores >= least
        at, scores = at[near], scores[near]
        at = at[np.argsort(-scores, kind="stable")[:k]]
    return at


def met(rows: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """The rows of each block, and after them all anchors (with ``windows``), sorted by id."""
    mine = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"), F.lit(0).alias("kind"), "vec_id", "label", "x", F.array().cast("array<long>").alias("windows"))
    every = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("kind"), "vec_id", "label", "x", "windows")
    both = mine.unionByName(every).repartition(min(blocks, PARTITIONS), "block")
    return both.sortWithinPartitions("block", "kind", "vec_id", "label", "x")


def against_blocks(sorted_rows: DataFrame, pick) -> DataFrame:
    """(anchor_id, score, vec_id) for what ``pick(scores, is_same, is_self, windows)`` chooses among a block's rows for an anchor."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, held, last = None, [], None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(2)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                ids, labels = (batch.column(c).to_numpy()[low:high] for c in (2, 3))
                x, windows = matrix(batch.column(4).slice(low, high - low)), batch.column(5).slice(low, high - low)
                now, kind = keys[low].tolist()
                # of repeated ids the first in order counts
                new = np.append(last != (now, kind, int(ids[0])), ids[1:] != ids[:-1])
                last = (now, kind, int(ids[-1]))
                if now != block:
                    block, parts, held = now, [], None
                if kind == 0:
                    parts.append((ids[new], labels[new], x[new]))
                    continue
                if held is None and parts:
                    dims = max(p[2].shape[1] for p in parts)
                    held = [np.concatenate(c) for c in zip(*((i, n, np.pad(v, ((0, 0), (0, dims - v.shape[1])))) for i, n, v in parts))]
                if held is not None:
                    yield from scored(held, ids[new], labels[new], x[new], windows.filter(pa.array(new)))

    def scored(held: list, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, windows: pa.ListArray) -> Iterator[pa.RecordBatch]:
        own, own_labels, own_x = held
        for at in range(0, len(ids), AT_ONCE):
            scores = product(x[at : at + AT_ONCE], own_x)
            out = []
            for i, row in enumerate(scores, at):
                found = pick(row, own_labels == labels[i], own == ids[i], windows[i].as_py())
                out.append((np.full(len(found), ids[i]), row[found], own[found]))
            yield from common.emit(SCORED, [np.concatenate(c) for c in zip(*out)])

    return sorted_rows.mapInArrow(of, SCORED_DDL)


def packed(anchor: int, score: int, kind: int, vec_id: int) -> bytes:
    """A key whose bytes sort by anchor, descending score, positives before negatives, id."""
    return KEY.pack(anchor + SHIFT, SHIFT - 1 - score, kind, vec_id + SHIFT)


def streamed(keys: Iterable[bytes], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """The rows MINED_DDL of sorted keys: windows are open at each positive until they are full or passed."""
    anchor, windows = None, []
    for key in keys:
        a, score, kind, vec_id = KEY.unpack(key)
        a, score, vec_id = a - SHIFT, SHIFT - 1 - score, vec_id - SHIFT
        if a != anchor:
            anchor, windows = a, []
        if kind == POSITIVE:
            windows.append([vec_id, score, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
        for w in windows:
            if 100 * score <= high * w[1]:
                w[2] += 1
                yield a, w[0], w[2], vec_id, w[1], score


def mined(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """The rows MINED_DDL for ``rows`` (vec_id, label, x: array of long) and the anchors among them.

    A negative's score is from ``low`` to ``high`` hundredths of its positive's.
    """
    spark = rows.sparkSession
    common.on_workers(spark)
    held = common.saved(rows.select("vec_id", "label", "x"), "vectors")
    blocks = max(1, math.ceil(held.count() / ROWS))
    anchors = held.where(is_anchor).withColumn("windows", F.array().cast("array<long>"))

    def nearest(scores, same, own, _):
        at = np.flatnonzero(same & ~own)
        return best(scores[at], at, positives)

    def in_windows(scores, same, own, tops):
        at = np.flatnonzero(~same)
        others, found = scores[at], []
        for top in tops:
            inside = (others >= -(-low * top // 100)) & (others <= high * top // 100)
            found.append(best(others[inside], at[inside], negatives))
        return np.unique(np.concatenate(found))

    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    found = against_blocks(met(held, anchors, blocks), nearest).withColumn("_n", F.row_number().over(first))
    found = common.saved(found.where(F.col("_n") <= positives).drop("_n"), "positives")
    windows = found.where("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("score").alias("windows"))
    inside = against_blocks(met(held, anchors.drop("windows").join(windows, "vec_id"), blocks), in_windows)

    kinds = found.withColumn("kind", F.lit(POSITIVE)).unionByName(inside.withColumn("kind", F.lit(NEGATIVE)))

    def keyed(r: Row) -> tuple[bytes, None]:
        return packed(r.anchor_id, r.score, r.kind, r.vec_id), None

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = kinds.rdd.map(keyed).repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(ordered.mapPartitions(lambda part: streamed((k for k, _ in part), negatives, low, high)), MINED_DDL, verifySchema=False)


def op11(vectors: DataFrame) -> DataFrame:
    """Anchors are the rows whose id 100 divides; where 7 does, the label is the next of ten."""
    rows = usable(vectors)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    x = F.transform("embedding", lambda c: F.floor(STEPS * c).cast("long"))
    return mined(rows.select("vec_id", label.alias("label"), x.alias("x")), F.col("vec_id") % 100 == 0)


SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM given a JOIN given b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 10
"""
