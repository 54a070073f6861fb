import re
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from anchorline.llm import common

TEXTS = [None, "", " ", "a", "a\n", "\r\na\x0bb\x0c", " a  b ", "a\n\x85", "\x85\n", "\xa0", "a\t\x1cb", "  x", "é\nü", "a\n\n", "\x00 \x00"]


def test_words_and_their_number(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    rows = df.select("i", common.words(F.col("t")).alias("w"), common.n_words(F.col("t")).alias("n")).collect()
    for r in rows:
        want = re.findall(r"[^\x20\x09-\x0D]+", TEXTS[r.i] or "")
        assert (r.w, r.n) == (want, len(want)), repr(TEXTS[r.i])


def test_lower_and_crc(spark):
    [r] = spark.createDataFrame([(12, "AbÉZ")], "i long, t string").select(common.lower_az(F.col("t")).alias("l"), common.crc_of_id(F.col("i")).alias("c")).collect()
    assert (r.l, r.c) == ("abÉz", zlib.crc32(b"12"))


def test_written_tables_come_back(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    again = common.saved(df, "t")
    assert again.dtypes == df.dtypes and [tuple(r) for r in again.collect()] == [(1, None)]


def test_slices_are_bounded_and_whole():
    texts = ["x" * n for n in (10, 5000, 10, 10, 20000, 3, 0, 7)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    parts = list(common.slices([batch, batch.slice(0, 0)], rows=3, size=6000))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows <= 3 and (p.num_rows == 1 or p.nbytes <= 6000) for p in parts)
