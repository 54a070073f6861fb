"""Versions of a table that appear whole or not at all."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

VERSION = re.compile(r"version=v(\d+)")


def hadoop_files(spark: SparkSession, root: str):
    """The cluster's file system of a folder, and how to make its paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the committed versions; none for a folder that is not there."""
    fs, path = hadoop_files(spark, root)
    if not fs.exists(path(root)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(root)) if s.isDirectory()]
    return sorted(int(m[1]) for n in names if (m := VERSION.fullmatch(n)))


def commit_version(df: DataFrame, root: str, form: str = "parquet", **options: str) -> str:
    """Writes ``df`` as the next version under ``root`` and gives its path.

    The rows are written to a folder that readers do not see.  When all tasks are done a
    number is claimed by creating a file, which succeeds for one writer only, and the
    folder gets the version's name by one rename.  A job that fails leaves no version and
    no folder; a claim whose writer died before the rename leaves a gap in the numbers.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    fs, path = hadoop_files(spark, root)
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    try:
        df.write.format(form).options(**options).save(staging)
        n = max(versions(spark, root), default=0) + 1
        while not fs.createNewFile(path(f"{root}/_claim-v{n:03}")):
            n += 1
        target = f"{root}/version=v{n:03}"
        if fs.exists(path(target)) or not fs.rename(path(staging), path(target)):
            raise OSError(f"{target} could not be committed")
    except BaseException:
        fs.delete(path(staging), True)
        raise
    return target
