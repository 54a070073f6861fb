"""Language-model scores from a log-frequency Bloom filter of words and word pairs.

Counts of the training documents are quantised on a log scale; an n-gram of level
q enters the filter with each of the levels 1 to q, so that a count is read back
by probing level after level until one is missing.  All n-grams enter, at every
size of the corpus, so the filter grows with it: it is cut into segments by the
n-grams' hashes, and these are rows of a stored table.

1. Documents are read in batches of bounded size.  A batch is written as one row
   (its words, and the number of the word at every token) and one row for each
   segment: the batch's distinct words and pairs that fall in it, with their counts
   in the batch's training documents.  However often an n-gram occurs, a batch sends
   it once.
2. A segment's rows meet in one task, which adds up the counts, builds and stores the
   segment of the filter, and answers every row in its order: exact counts of the words
   (for the base score) and the levels that the probes of words and pairs find.
3. A batch's row meets the answers to it, and its documents are scored.

``rescored`` scores other documents with the stored filter, without counting again: a
filter of at most ``BROADCAST`` bytes is broadcast to the workers, a larger one
answers by its segments.

The probability of a word w after h is ``PAIR_WEIGHT`` c(hw) / c(h) + the rest of
(c(w) + 0.5) / (N + 0.5 (V + 1)), of w alone where h is unknown.  Above the line stands the
least count of a level, below it the greatest one, and no n-gram is taken to be commoner
than its parts or than all tokens, so both terms are at most 1, and over all words they
sum to at most 1 but for n-grams that the filter holds by chance.

A segment holds the n-grams of about ``SEGMENT`` bytes of text, a batch ``BATCH``
bytes or one longer text; nothing is collected on the driver but sums and a filter of
bounded size.

Defined results: null text has no words and one end; a very long text is a batch of
its own; an id that is null counts as empty text in the split; repeated rows each get
a row; with nothing to learn from all counts are zero; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of text in a batch, and for which one segment is made.
BATCH, SEGMENT = 12 << 20, 16 << 20
#: Bytes up to which a stored filter is broadcast.
BROADCAST = 64 << 20
#: Ratio of two levels' counts; bits of the filter for each n-gram and level; places that one of these sets.
BASE, BITS, PROBES = 1.5, 10, 4
#: Weight of the pair's estimate against the single word's.
PAIR_WEIGHT = 0.6
FOLDS, HELD_OUT = 5, 1
SEED = 42
#: Number of the row that holds a batch itself among its rows, and of the batch that stands for a segment's sums.
ITSELF = -1

BATCHES = pa.schema([
    ("segment", pa.int32()), ("batch", pa.int64()), ("words", pa.binary()), ("word_counts", pa.binary()), ("pairs", pa.binary()), ("pair_counts", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("tokens", pa.binary()),
])
BATCHES_DDL = "segment int, batch long, words binary, word_counts binary, pairs binary, pair_counts binary, doc_ids array<long>, held_out array<boolean>, sizes array<int>, tokens binary"
ANSWERS = pa.schema([("segment", pa.int32()), ("batch", pa.int64()), ("counts", pa.binary()), ("word_levels", pa.binary()), ("pair_levels", pa.binary()), ("n", pa.int64()), ("v", pa.int64()), ("size", pa.int64()), ("bits", pa.binary())])
ANSWERS_DDL = "segment int, batch long, counts binary, word_levels binary, pair_levels binary, n long, v long, size long, bits binary"
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORES_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(words: list[bytes]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return mixed(np.fromiter((h(w, SEED) for w in words), np.uint64, len(words)))


#: No word can be a blank.
END = hashed([b"\n"])[0]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words in order, the end among them; the number of the word at every token; tokens of each text."""
    # a copy that begins at its buffers' beginning, as not every function minds a slice's offset
    texts = pc.take(pc.fill_null(texts.cast(pa.large_string()), ""), pa.array(np.arange(len(texts))))
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    bounds = cut.offsets.to_numpy()
    pieces = cut.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).dictionary_encode()
    words = pieces.dictionary.cast(pa.large_binary()).to_pylist()
    h, number = np.unique(np.append(hashed(words), END), return_inverse=True)
    at = pieces.indices.to_numpy()
    # blanks at a text's ends leave empty pieces
    is_word = at != words.index(b"") if b"" in words else np.ones(len(at), bool)
    before = np.concatenate([[0], np.cumsum(is_word)])
    sizes = np.diff(before[bounds - bounds[0]]) + 1
    out = np.full(int(sizes.sum()), number[-1], np.uint32)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = number[at[is_word]]
    if b"" in words:
        # nothing stands for the empty piece
        there = np.zeros(len(h), bool)
        there[out] = True
        out = (np.cumsum(there) - 1).astype(np.uint32)[out]
        h = h[there]
    return h, out, sizes


def before(out: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The number of the word before each token; the end stands before the first."""
    previous = np.empty_like(out)
    previous[1:] = out[:-1]
    previous[np.cumsum(sizes) - sizes] = end
    return previous


def pairs(h: np.ndarray, out: np.ndarray, previous: np.ndarray) -> np.ndarray:
    """Hashes of each token with the one before."""
    return mixed(mixed(h * np.uint64(3) + np.uint64(0x632BE59BD9B4E019))[previous] + h[out])


def segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    """Segments in the order of the hashes; what tells hashes of one segment apart are their low 32 bits."""
    return ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def level_of(c: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(c, 1)) / math.log(BASE) + 1e-9).astype(np.int64)


def least(levels: np.ndarray) -> np.ndarray:
    """The smallest count of a level; zero for none."""
    return np.where(levels > 0, np.ceil(BASE ** (levels - 1.0)), 0.0)


def most(levels: np.ndarray) -> np.ndarray:
    """The greatest count of a level; zero for none."""
    return np.where(levels > 0, np.maximum(np.ceil(BASE ** (levels * 1.0)) - 1, least(levels)), 0.0)


class Filter:
    """A segment of the filter: the bits, and how levels are read from them."""

    def __init__(self, h: np.ndarray, c: np.ndarray):
        """Holds the n-grams with the counts ``c``, all above zero."""
        levels = level_of(c)
        self.size = max(64, int(levels.sum()) * BITS)
        bits = np.zeros(self.size, np.uint8)
        for level in range(int(levels.max(initial=0))):
            for at in self.places(h[levels > level], level):
                bits[at] = 1
        self.bits = np.packbits(bits, bitorder="little")

    @classmethod
    def stored(cls, size: int, bits: bytes) -> Filter:
        found = cls.__new__(cls)
        found.size, found.bits = size, np.frombuffer(bits, np.uint8)
        return found

    def places(self, h: np.ndarray, level: int) -> Iterator[np.ndarray]:
        """Positions of the bits that a level of each hash sets."""
        h = mixed(h + np.uint64(SEED))
        step = (h << np.uint64(32)) | (h >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            x = h + step * np.uint64(level * PROBES + i + 1)
            yield ((x >> np.uint64(32)) * np.uint64(self.size) >> np.uint64(32)).astype(np.int64)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The highest level up to which all probes are there, from the first."""
        found = np.zeros(len(h), np.uint8)
        left = np.arange(len(h))
        level = 0
        while len(left):
            hit = np.ones(len(left), bool)
            for at in self.places(h[left], level):
                hit &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            left = left[hit]
            level += 1
            found[left] = level
        return found


def likelihood(both: np.ndarray, previous: np.ndarray, own: np.ndarray, n: int, v: int) -> np.ndarray:
    """Probabilities from the levels of a pair, the word before and the word itself, of ``n`` tokens with ``v`` words."""
    highest = level_of(np.array([n]))[0] if n else 0
    previous, own = np.minimum(previous, highest), np.minimum(own, highest)
    both = np.minimum(both, np.minimum(previous, own))
    single = (least(own) + 0.5) / (n + 0.5 * (v + 1))
    joint = least(both) / np.maximum(most(previous), 1.0)
    return np.where(previous > 0, PAIR_WEIGHT * joint + (1 - PAIR_WEIGHT) * single, single)


def logs_of(h: np.ndarray, out: np.ndarray, sizes: np.ndarray, ask, n: int, v: int) -> np.ndarray:
    """log10 of the probability of each token; ``ask(words, pairs)`` gives the levels of ascending hashes."""
    previous = before(out, sizes, int(np.searchsorted(h, END)))
    p, first, number = np.unique(pairs(h, out, previous), return_index=True, return_inverse=True)
    levels, both = (x.astype(np.int64) for x in ask(h, p))
    return np.log10(likelihood(both, levels[previous[first]], levels[out[first]], n, v))[number]


def planes(x: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte: the high bytes are mostly zero and go to nothing when compressed."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def batched(rows: DataFrame, segments: int) -> DataFrame:
    """The rows BATCHES of ``rows`` (doc_id, held_out, text)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        for rows in common.slices(batches, 20_000, BATCH):
            h, out, sizes = tokens(rows.column(2))
            end = int(np.searchsorted(h, END))
            learns = np.repeat(~rows.column(1).to_numpy(zero_copy_only=False), sizes)
            word_counts = np.bincount(out[learns], minlength=len(h))
            p, number = np.unique(pairs(h, out, before(out, sizes, end)), return_inverse=True)
            pair_counts = np.bincount(number[learns], minlength=len(p))
            cut = lambda x: np.searchsorted(segment_of(x, segments), np.arange(segments + 1))
            w_at, p_at = cut(h), cut(p)
            met = np.flatnonzero((np.diff(w_at) > 0) | (np.diff(p_at) > 0)).tolist()
            low = (p & np.uint64(0xFFFFFFFF)).astype("<u4")
            none = [None] * len(met)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip([
                [ITSELF, *met], [batch] * (1 + len(met)),
                [h.tobytes(), *(h[w_at[s] : w_at[s + 1]].tobytes() for s in met)], [None, *(planes(word_counts[w_at[s] : w_at[s + 1]]) for s in met)],
                [None, *(low[p_at[s] : p_at[s + 1]].tobytes() for s in met)], [None, *(planes(pair_counts[p_at[s] : p_at[s + 1]]) for s in met)],
                [rows.column(0).to_pylist(), *none], [rows.column(1).to_pylist(), *none], [sizes.tolist(), *none], [planes(out), *none],
            ], BATCHES)], schema=BATCHES)
            batch += 1

    return rows.mapInArrow(of, BATCHES_DDL)


def answered(asked: DataFrame) -> DataFrame:
    """The rows ANSWERS: one for each row of a batch in a segment, and one for each segment with its sums."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, held = None, []
        for rows in batches:
            for row in zip(*(c.to_pylist() for c in rows.columns)):
                if row[0] != segment:
                    if held:
                        yield answers(segment, held)
                    segment, held = row[0], []
                held.append(row[1:])
        if held:
            yield answers(segment, held)

    def answers(segment: int, held: list[tuple]) -> pa.RecordBatch:
        batch, words, word_counts, two, pair_counts = zip(*held)
        parts = [[np.frombuffer(x, "<u8") for x in words], [np.frombuffer(x, "<u4") for x in two]]
        w, w_number = np.unique(np.concatenate(parts[0]), return_inverse=True)
        c = np.bincount(w_number, np.concatenate([unplaned(x) for x in word_counts]), len(w)).astype(np.int64)
        p, p_number = np.unique(np.concatenate(parts[1]), return_inverse=True)
        both = np.bincount(p_number, np.concatenate([unplaned(x) for x in pair_counts]), len(p)).astype(np.int64)
        p = p.astype(np.uint64)
        bloom = Filter(np.concatenate([w[c > 0], p[both > 0]]), np.concatenate([c[c > 0], both[both > 0]]))
        w_levels, p_levels = bloom.levels(w)[w_number], bloom.levels(p)[p_number]
        w_at, p_at = (np.cumsum([0, *map(len, x)]) for x in parts)
        each = list(zip(w_at, w_at[1:], p_at, p_at[1:]))
        exact = c.astype("<i8")[w_number]
        return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip([
            [segment] * (1 + len(batch)), [ITSELF, *batch], [None, *(exact[a:b].tobytes() for a, b, _, _ in each)],
            [None, *(w_levels[a:b].tobytes() for a, b, _, _ in each)], [None, *(p_levels[a:b].tobytes() for _, _, a, b in each)],
            [int(c.sum()), *([None] * len(batch))], [int((c > 0).sum()), *([None] * len(batch))],
            [bloom.size, *([None] * len(batch))], [bloom.bits.tobytes(), *([None] * len(batch))],
        ], ANSWERS)], schema=ANSWERS)

    return asked.repartition("segment").sortWithinPartitions("segment", "batch").mapInArrow(of, ANSWERS_DDL)


@dataclass(frozen=True)
class Model:
    """A stored filter: rows (segment, size, bits), one of each of ``segments`` that holds something; tokens and words it has seen."""

    rows: DataFrame
    segments: int
    n: int
    v: int


def told(docs: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), (common.crc_of_id(doc_id) % FOLDS == HELD_OUT).alias("held_out"), text.alias("text"))


def learnt(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The filter of the documents that are not held out, the batches of all, and the answers to these."""
    common.on_workers(docs.sparkSession)
    rows = told(docs)
    segments = math.ceil((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / SEGMENT) or 1
    made = common.saved(batched(rows, segments), "batches", compression="zstd")
    asked = made.where(F.col("segment") != ITSELF).select("segment", "batch", "words", "word_counts", "pairs", "pair_counts")
    answers = common.saved(answered(asked), "answers", compression="zstd")
    stored = answers.where(F.col("batch") == ITSELF)
    sums = stored.agg(F.sum("n"), F.sum("v")).first()
    return Model(stored.select("segment", "size", "bits"), segments, int(sums[0] or 0), int(sums[1] or 0)), made, answers


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row."""
    model, made, answers = learnt(docs)
    n, v = model.n, model.v
    # with no training tokens every count is zero and so is what they are divided by
    denominator = n + 0.5 * (v + 1)

    def scores(itself: tuple, got: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, _, words, doc_ids, held_out, sizes, numbers = itself[:7]
        h, out, sizes = np.frombuffer(words, "<u8"), unplaned(numbers), np.array(sizes)
        c, levels, both = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*got), ("<i8", np.uint8, np.uint8)))
        logs = logs_of(h, out, sizes, lambda *_: (levels, both), n, v)
        base, known = np.log10((c + 0.5) / denominator), c > 0
        starts = np.cumsum(sizes) - sizes
        sums = [np.add.reduceat(x, starts) for x in (known[out].astype(np.int64), base[out], logs)]
        yield from common.emit(SCORES, [doc_ids, held_out, sizes, sums[0], np.full(len(sizes), n), sums[1], sums[2]])

    return gathered(made, answers.where(F.col("batch") != ITSELF), scores, SCORES_DDL)


def gathered(made: DataFrame, answers: DataFrame, scores, ddl: str) -> DataFrame:
    """What ``scores`` gives for each batch's row and the answers to it, in the order of the segments."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        itself, got = None, []
        for rows in batches:
            for row in zip(*(c.to_pylist() for c in rows.columns)):
                if row[1] == ITSELF:
                    if itself:
                        yield from scores(itself, got)
                    itself, got = row, []
                else:
                    got.append(row[7:])
        if itself:
            yield from scores(itself, got)

    itself = made.where(F.col("segment") == ITSELF).select("batch", "segment", "words", "doc_ids", "held_out", "sizes", "tokens")
    given = answers.select("batch", "segment", "counts", "word_levels", "pair_levels")
    met = itself.unionByName(given, allowMissingColumns=True).select("batch", "segment", "words", "doc_ids", "held_out", "sizes", "tokens", "counts", "word_levels", "pair_levels")
    return met.repartition("batch").sortWithinPartitions("batch", "segment").mapInArrow(of, ddl)


RESCORES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("score", pa.float64())])
RESCORES_DDL = "doc_id long, n_tokens long, n_known long, score double"


def sums_of(h: np.ndarray, out: np.ndarray, sizes: np.ndarray, doc_ids: list, levels: np.ndarray, both: np.ndarray, n: int, v: int) -> Iterator[pa.RecordBatch]:
    logs, starts = logs_of(h, out, sizes, lambda *_: (levels, both), n, v), np.cumsum(sizes) - sizes
    yield from common.emit(RESCORES, [doc_ids, sizes, np.add.reduceat((levels > 0)[out].astype(np.int64), starts), np.add.reduceat(logs, starts)])


def rescored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, score of documents under a stored filter; n_known are tokens that the filter holds."""
    spark = docs.sparkSession
    common.on_workers(spark)
    n, v, segments = model.n, model.v, model.segments
    rows = told(docs).withColumn("held_out", F.lit(True))
    if (model.rows.agg(F.sum(F.octet_length("bits"))).first()[0] or 0) <= BROADCAST:
        sent = spark.sparkContext.broadcast({r.segment: (r["size"], bytes(r.bits)) for r in model.rows.collect()})

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {k: Filter.stored(*x) for k, x in sent.value.items()}

            def probed(x: np.ndarray, low: bool) -> np.ndarray:
                cuts = np.searchsorted(segment_of(x, segments), np.arange(segments + 1))
                found = np.zeros(len(x), np.uint8)
                for k, bloom in filters.items():
                    part = x[cuts[k] : cuts[k + 1]]
                    found[cuts[k] : cuts[k + 1]] = bloom.levels(part & np.uint64(0xFFFFFFFF) if low else part)
                return found

            for batch in common.slices(batches, 20_000, BATCH):
                h, out, sizes = tokens(batch.column(2))
                p = np.unique(pairs(h, out, before(out, sizes, int(np.searchsorted(h, END)))))
                yield from sums_of(h, out, sizes, batch.column(0).to_pylist(), probed(h, False), probed(p, True), n, v)

        return rows.mapInArrow(of, RESCORES_DDL)

    made = common.saved(batched(rows, segments), "batches", compression="zstd")
    asked = made.where(F.col("segment") != ITSELF).select("segment", "batch", "words", "pairs")
    both = model.rows.withColumn("batch", F.lit(ITSELF).cast("long")).unionByName(asked, allowMissingColumns=True)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, bloom = None, None
        for rows in batches:
            for s, batch, size, bits, words, two in zip(*(c.to_pylist() for c in rows.columns)):
                if s != segment:
                    segment, bloom = s, None
                if batch == ITSELF:
                    bloom = Filter.stored(size, bits)
                    continue
                h, p = np.frombuffer(words, "<u8"), np.frombuffer(two, "<u4").astype(np.uint64)
                # a segment that nothing fell into holds nothing
                levels = [bloom.levels(x) if bloom else np.zeros(len(x), np.uint8) for x in (h, p)]
                yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip([s, batch, None, *(x.tobytes() for x in levels), None, None, None, None], ANSWERS)], schema=ANSWERS)

    answers = both.select("segment", "batch", "size", "bits", "words", "pairs").repartition("segment").sortWithinPartitions("segment", "batch").mapInArrow(answer, ANSWERS_DDL)

    def scores(itself: tuple, got: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, _, words, doc_ids, _, sizes, numbers = itself[:7]
        levels, two = (np.frombuffer(b"".join(x), np.uint8) for x in list(zip(*got))[1:])
        yield from sums_of(np.frombuffer(words, "<u8"), unplaned(numbers), np.array(sizes), doc_ids, levels, two, n, v)

    return gathered(made, answers, scores, RESCORES_DDL)
