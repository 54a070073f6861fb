"""Token ids in ORC files, ordered by document id.

Every file is one shard, a range of ids in ascending order.  ORC stores the ids
with its run-length encoding, keeps minimum and maximum of every column for each
stripe and row group, and a Bloom filter on the document id; Spark reads stripes
in parallel and skips those whose statistics or filter rule a wanted id out.

Defined results: null text is empty and still has its end id; rows with the same
id are kept, ordered by a hash of their texts; a very long text is one row of its shard; an empty
table gives an empty table back; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .encoding import encoder

END_ID = 2
#: shard: number of the file's range; first: ids of the shard's documents before this one.
SCHEMA = "doc_id long, shard int, first long, n_tokens int, ids array<int>"
ARROW = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))])
OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    # the ids are run-length coded already
    "compression": "none",
}


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encodes every text with the tokenizer file and writes the shards under ``path``."""
    common.on_workers(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, shard, first = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in common.slices(batches, 2000):
            ids, at = codes.encode(batch.column(1))
            ends = at[1:] + np.arange(1, len(at))  # with an end id after each text
            ids = np.insert(ids.astype(np.int32), at[1:], end_id)
            sizes = np.diff(ends, prepend=0)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(ends), shard, np.int32)), pa.array(first + ends - sizes), pa.array(sizes.astype(np.int32)), lists], schema=ARROW)
            first += int(ends[-1])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    dealt = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    dealt.mapInArrow(of, SCHEMA).write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows with ``start``: the ids of all documents before; only small columns are read for it."""
    rows = spark.read.schema(SCHEMA).orc(path)
    shards = rows.groupBy("shard").agg(F.max(F.col("first") + F.col("n_tokens")).alias("size"))
    # one row for each file of the table
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(shards), "shard").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; statistics and Bloom filters rule out stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def op6(docs: DataFrame, tokenizer: str) -> DataFrame:
    spark = docs.sparkSession
    path = common.scratch(spark, "tokens")
    write(docs, path, tokenizer)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ids, at = lists.values.to_numpy().astype("<u4", copy=False), lists.offsets.to_numpy()
            crcs = np.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:])], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2).cast(pa.int64()), pa.array(crcs)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read(spark, path).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
