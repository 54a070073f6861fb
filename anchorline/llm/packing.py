"""Order-preserving packing of documents into sequences by dynamic programming.

The documents, in the order of their ids, are one stream of tokens.  Windows of
at most ``length`` tokens are cut from it at document ends, at sentence ends, and
inside sentences on a coarse grid; a cut costs a truncation penalty by its kind
and a window costs its padding.  With f(p) the least cost up to cut p,

    f(p) = penalty(p) + length - p + min over q in [p - length, p) of f(q) + q,

so the minimum slides and a monotone queue gives every transition in constant
time.  A sequence whose length is a power of two is not padded, so windows of
such lengths are further transitions, and the last window of a shard is cut at
powers of two.

Shards are ranges of ids; each is packed on its own, in bounded blocks.  Defined
results: null text is empty and still has its end id; a very long text is cut into as many
pieces as it needs; rows with the same id are
packed each for itself, ordered by their texts; an empty table gives no pieces;
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .encoding import CACHED, encoder

LENGTH, END_ID = 2048, 1
#: Truncation penalties in tokens of padding.
SENTENCE_CUT, INNER_CUT, GRID = 4, 24, 64
#: Cost of a further sequence that needs no padding; only these lengths are tried.
SPARE, UNPADDED = 8, (1024, 512, 256)
#: Tokens that one run of the dynamic program sees at most, besides one document.
BLOCK = 1 << 18
NEVER = 255

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def best_cuts(positions: list[int], penalties: list[int], length: int, open_end: bool) -> list[int]:
    """Cut positions after 0 of the least cost; with an open end, up to where the next window would best begin."""
    at = {0: 0}
    cost, back = [0], [0]
    where = [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (f(q) + q, index), rising
    for p, penalty in zip(positions, penalties):
        while p - where[queue[0][1]] > length:
            queue.popleft()
        least, j = queue[0]
        f = least + length - p
        for size in UNPADDED:
            if size < length and (k := at.get(p - size)) is not None and cost[k] + SPARE < f:
                f, j = cost[k] + SPARE, k
        f += penalty
        i = len(where)
        where.append(p)
        cost.append(f)
        back.append(j)
        at[p] = i
        while queue and queue[-1][0] > f + p:
            queue.pop()
        queue.append((f + p, i))
    i = len(where) - 1
    if open_end:
        while where[-1] - where[queue[0][1]] > length:
            queue.popleft()
        i = queue[0][1]
    cuts = []
    while i:
        cuts.append(where[i])
        i = back[i]
    return cuts[::-1]


def powers_of_two(size: int, length: int) -> list[int]:
    """Summands of ``size``: itself if it needs no padding, else its binary digits from the largest."""
    return [size] if size == length else [1 << b for b in range(size.bit_length() - 1, -1, -1) if size >> b & 1]


class Packer:
    """Packs one shard, document after document."""

    def __init__(self, shard: int, length: int, sentence_ends: np.ndarray):
        self.next_id, self.length, self.sentence_ends = shard << 40, length, sentence_ends
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.done = 0  # tokens of the first document that are packed
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, ids))
        self.held += len(ids)
        return self.flush(open_end=True) if self.held >= BLOCK else []

    def flush(self, open_end: bool) -> list[tuple]:
        if not self.held:
            return []
        stream = np.concatenate([ids for _, ids in self.docs])[self.done :]
        ends = np.cumsum([len(ids) for _, ids in self.docs]) - self.done
        penalty = np.full(len(stream) + 1, NEVER, dtype=np.uint8)
        grid = min(GRID, self.length)
        penalty[grid::grid] = INNER_CUT
        penalty[np.flatnonzero(np.isin(stream, self.sentence_ends)) + 1] = SENTENCE_CUT
        penalty[ends] = 0
        positions = np.flatnonzero(penalty[1:] < NEVER) + 1
        cuts = best_cuts(positions.tolist(), penalty[positions].tolist(), self.length, open_end)
        if not open_end and cuts:
            last = cuts[-2] if len(cuts) > 1 else 0
            cuts[-1:] = (last + np.cumsum(powers_of_two(cuts[-1] - last, self.length))).tolist()
        rows, doc, begin = [], 0, -self.done  # begin: where the document starts in the stream
        low = 0
        for high in cuts:
            offset = 0
            while low < high:
                doc_id, ids = self.docs[doc]
                until = min(high, begin + len(ids))
                piece = stream[low:until]
                rows.append((doc_id, low - begin, until - low, zlib.crc32(piece.tobytes()), len(ids), self.next_id, offset))
                offset += until - low
                low = until
                if until == begin + len(ids):
                    begin, doc = until, doc + 1
            self.next_id += 1
        self.docs, self.done, self.held = self.docs[doc:], low - begin, len(stream) - low
        return rows


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, cached: int = CACHED) -> DataFrame:
    """A row for each piece of a document in a sequence; ``tokenizer`` is a file's path, ``cached`` bounds a worker's memory."""
    common.on_workers(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer, cached)
        stops = [codes.tokenizer.token_to_id(mark + end) for mark in ".!?" for end in ("</w>", "")]
        packer = Packer(TaskContext.get().partitionId(), length, np.array([s for s in stops if s is not None], dtype=np.uint32))
        for batch in common.slices(batches, 1000):
            rows = []
            ids, at = codes.encode(batch.column(1))
            for doc_id, a, b in zip(batch.column(0).to_pylist(), at.tolist(), at[1:].tolist()):
                rows += packer.add(doc_id, np.append(ids[a:b], np.uint32(end_id)))
            if rows:
                yield from common.emit(ARROW, list(zip(*rows)))
        if rows := packer.flush(open_end=False):
            yield from common.emit(ARROW, list(zip(*rows)))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    return texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text").mapInArrow(of, SCHEMA)
