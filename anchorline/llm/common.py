"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only if a session on one machine names none."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="anchorline-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def met(rows: DataFrame, others: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """rows.join(others, on, how) by a shuffle, whatever their size is taken for.

    Spark takes exploded rows for as many as there were before, and a written table for as
    large as its packed file; of either it would send many times its limit through the driver.
    """
    return rows.join(others.hint("merge"), on, how)


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver has it."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH", "")) if x)


def lower_az(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The runs of characters other than BLANKS; no element for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    """size(words(text)) without building the words: the pieces less an empty one at either end."""
    text = F.coalesce(text, F.lit(""))
    pieces = F.split(F.regexp_replace(text, rf"\A{BLANKS}+|{BLANKS}+\z", ""), BLANKS + "+")
    return F.when(text.rlike(f"[^{BLANKS[1:-1]}]"), F.size(pieces)).otherwise(0).cast("long")


def slices(batches: Iterable[pa.RecordBatch], rows: int = 500, size: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows and, above one row, ``size`` bytes: few long texts are in memory at once.

    What Arrow keeps for later goes back to the system at the end, as workers live on.
    """
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).nbytes > size:
                n //= 2
            yield batch.slice(at, n)
            at += n
    pa.default_memory_pool().release_unused()


def emit(schema: pa.Schema, columns: list, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    made = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    for at in range(0, made.num_rows, rows):
        yield made.slice(at, rows)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
