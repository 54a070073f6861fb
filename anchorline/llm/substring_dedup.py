"""Substring deduplication over sliding spans of sentences.

A text is cut into sentences: after a word that ends in ``.``, ``!`` or ``?``, at
a line's end, and, unless ``every`` is 0, inside sentences after words whose hash says
so (one of ``every`` on average), so that a passage is cut alike wherever it stands,
in texts without punctuation too.  A span
is a run of at least ``RUN`` consecutive sentences with at least ``WORDS`` words.
The least span from each sentence on and the least span up to each sentence are
hashed; together they cover every sentence of every span.  Equal spans meet by a
join over all documents, and the sentences under a span that is not the first of
its kind, in the order of document ids and positions, are removed.  Words are compared with A-Z in lower
case and without regard to white space; punctuation counts.

Hashes have 96 bits.  Only the hashes of spans that occur twice or more come to
the join, and what is collected for a document is bounded by its own length.

Rows with the same id and text are one document and get the same result.  Defined
results: null stays null and an empty text empty; a very long text is cut whole, in memory
of a few times its length; a text with fewer sentences or words than a span is
left alone; an empty table gives no rows; other columns pass through ``cleaned``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RUN, WORDS, BREAK = 2, 16, 10
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES)
SPANS = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("id", pa.int64()), ("tie", pa.int32()), ("pos", pa.int32()), ("n", pa.int16())])
SPANS_DDL = "h1 long, h2 int, id long, tie int, pos int, n short"
#: Stands for a null id.
NO_ID = -(1 << 63)
WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def sentences(data: bytes, every: int = BREAK) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and the number of the first word of every sentence and of the end."""
    words, line_ends = [], []
    for line in data.lower().split(b"\n"):
        words += line.split()
        line_ends.append(len(words))
    if not words:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter(map(h, words), np.uint64, len(words))
    stops = np.fromiter((w[-1] for w in words), np.uint8, len(words))
    ends = (stops == 46) | (stops == 33) | (stops == 63)
    if every:
        ends |= hashes % np.uint64(every) == 0
    ends[np.array(line_ends) - 1] = True
    return hashes, np.concatenate([[0], np.flatnonzero(ends) + 1]).astype(np.int64)


def spans(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """h1, h2, first sentence and number of sentences of the least spans from each sentence on and up to each sentence."""
    last = len(starts) - 1
    begin = np.arange(last)
    # the first end that leaves WORDS words and RUN sentences
    end = np.maximum(np.searchsorted(starts, starts[:-1] + WORDS), begin + RUN)
    begin, end = begin[end <= last], end[end <= last]
    # the last beginning that leaves as much before an end
    stop = np.arange(RUN, last + 1)
    start = np.minimum(np.searchsorted(starts, starts[stop] - WORDS, side="right") - 1, stop - RUN)
    # a span that is the least both ways comes once
    new = start >= 0
    to = np.full(last + 1, -1)
    to[begin] = end
    new[new] &= to[start[new]] != stop[new]
    begin, end = np.concatenate([begin, start[new]]), np.concatenate([end, stop[new]])
    powers = [np.ones(len(hashes) + 1, np.uint64) for _ in range(4)]
    found = []
    for k, (base, inverse) in enumerate(zip(BASES, INVERSES)):
        for p, b in ((powers[2 * k], base), (powers[2 * k + 1], inverse)):
            p[1:] = b
            np.cumprod(p, out=p)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[2 * k][:-1], dtype=np.uint64)])
        found.append((sums[starts[end]] - sums[starts[begin]]) * powers[2 * k + 1][starts[begin]])
    # sums of products keep their low bits low: fold the high ones in
    h1, h2 = (x ^ (x >> np.uint64(29)) for x in found)
    h1 = h1 * np.uint64(0xBF58476D1CE4E5B9)
    return (h1 ^ (h1 >> np.uint64(32))).view(np.int64), (h2 >> np.uint64(16)).astype(np.uint32).view(np.int32), begin, end - begin


def keys(docs: DataFrame) -> DataFrame:
    """docs with _id and _tie, which tell documents apart."""
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("_tie", F.hash("text"))


def all_spans(docs: DataFrame, every: int = BREAK) -> DataFrame:
    common.on_workers(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 300):
            parts = []
            for i, tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                h1, h2, pos, n = spans(*sentences((text or "").encode("utf-8", "surrogatepass"), every))
                parts.append((h1, h2, np.full(len(h1), i, np.int64), np.full(len(h1), tie, np.int32), pos.astype(np.int32), n.astype(np.int16)))
            yield from common.emit(SPANS, [np.concatenate(c) for c in zip(*parts)])

    return docs.select("_id", "_tie", "text").mapInArrow(of, SPANS_DDL)


def repeated(docs: DataFrame, every: int = BREAK) -> DataFrame:
    """(_id, _tie, covered, firsts) for documents with later copies: (pos, n) of their spans, ids of the documents that come first."""
    each = all_spans(keys(docs.select("doc_id", "text")), every)
    twice = common.saved(each.groupBy("h1").agg(F.count("*").alias("c")).where("c > 1").select("h1"), "repeated")
    held = common.saved(common.met(each, twice, "h1"), "spans")
    first = common.saved(held.groupBy("h1", "h2").agg(F.min(F.struct("id", "tie", "pos")).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"), "firsts")
    later = held.join(first, ["h1", "h2"]).where(F.struct("id", "tie", "pos") != F.col("first"))
    return later.groupBy(F.col("id").alias("_id"), F.col("tie").alias("_tie")).agg(F.collect_set(F.struct("pos", "n")).alias("covered"), F.array_sort(F.collect_set("first.id")).alias("firsts"))


def without(text: str, covered: list, every: int = BREAK) -> tuple[str, int, int]:
    """The text without the covered sentences; how many sentences and words those are."""
    data = text.encode("utf-8", "surrogatepass")
    _, starts = sentences(data, every)
    gone = np.zeros(len(starts), dtype=np.int64)
    for span in covered:
        gone[span["pos"]] += 1
        gone[span["pos"] + span["n"]] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    at = [m.start() for m in WORD.finditer(data)] + [len(data)]
    cuts = [at[s] for s in starts]
    kept = [data[: cuts[0]], *(data[a:b] for a, b, g in zip(cuts, cuts[1:], gone) if not g)]
    return b"".join(kept).decode("utf-8", "surrogatepass"), int(gone.sum()), int(np.diff(starts)[gone].sum())


def cleaned(docs: DataFrame, every: int = BREAK) -> DataFrame:
    """(_row, _new, firsts): the rows of ``docs`` and what is left of them, null where nothing is removed."""
    common.on_workers(docs.sparkSession)

    def rewrite(texts: pd.Series, covered: pd.Series) -> pd.DataFrame:
        rows = [(None, 0, 0) if t is None or c is None else without(t, c, every) for t, c in zip(texts, covered)]
        return pd.DataFrame(rows, columns=["text", "sentences", "words"])

    new = F.pandas_udf(rewrite, "text string, sentences long, words long")
    rows = keys(docs.select(F.struct("*").alias("_row"), "doc_id", "text")).drop("doc_id", "text")
    joined = rows.join(repeated(docs, every), ["_id", "_tie"], "left")
    touched = F.when(F.col("covered").isNotNull(), F.col("_row.text"))
    return joined.select("_row", "firsts", new(touched, F.col("covered")).alias("_new"))


def op3(docs: DataFrame, every: int = BREAK) -> DataFrame:
    found = cleaned(docs.select("doc_id", "text"), every)
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), F.coalesce("_new.text", "_row.text").alias("text"),
        F.coalesce("_new.sentences", F.lit(0)).alias("removed_sentences"), F.coalesce("_new.words", F.lit(0)).alias("removed_words"),
        F.coalesce("firsts", F.array().cast("array<long>")).alias("first_doc_ids"),
    )


def deduplicated(docs: DataFrame, every: int = BREAK) -> DataFrame:
    """The rows of ``docs`` with ``text`` cleaned; rows of which nothing is left are dropped."""
    at = docs.columns.index("text")
    columns = [F.col("_row")[c].alias(c) if i != at else F.coalesce("_new.text", "_row.text").alias(c) for i, c in enumerate(docs.columns)]
    return cleaned(docs, every).where(F.col("_new.text").isNull() | F.col("_new.text").rlike(f"[^{common.BLANKS[1:-1]}]")).select(*columns)
