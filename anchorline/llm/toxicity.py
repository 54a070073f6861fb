"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents are labels; every other document, whatever it holds, is
unlabelled.  With p the share of toxic documents (the class prior), the risk of a
classifier f is estimated without negatives as

    p E_toxic[loss(f)] + max(0, E_unlabelled[loss(-f)] - p E_toxic[loss(-f)])

where the second part stands for the risk on clean documents; where it falls below zero
the classifier has begun to learn the sample by heart, and a step is taken against it.

1. A document is the set of its words and of their runs of five letters, hashed into
   ``BUCKETS``.  Over all training documents it is counted in how many each bucket
   occurs, and in how many of the confirmed ones.
2. Buckets are kept whose count among the confirmed surely exceeds what the whole corpus
   makes likely and of whose documents, by the prior, half or more are toxic, with the
   logarithm of the ratio between confirmed and clean documents; the clean share is
   what is left of the corpus after the prior's part.
3. ``CLASSIFIERS`` logistic classifiers are trained with numpy, each in one task on a
   share of the sample of its own; the score is the sigmoid of their mean.

Bounded are: the confirmed ids that are used (about ``CONFIRMED``, so that they can be
broadcast), the unlabelled documents a classifier is fitted on (about ``UNLABELLED`` in
all), and the model (``BUCKETS`` numbers).  Counts cover every training document, and
every whole text is scored.

Defined results: a null or empty text has no features and gets the score of such a text,
which is at most the prior; without confirmed documents all scores are 0; a null id
counts as empty text in the split and has no label; repeated rows each get a row; a
document is confirmed if any of its labels says so; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS, LETTERS = 1 << 18, 5
CONFIRMED, UNLABELLED, CLASSIFIERS = 50_000, 40_000, 4
#: Standard deviations by which a bucket must exceed what is likely; pseudo-documents on both sides of a ratio.
SURE, PSEUDO = 4.0, 0.5
STEPS, RATE, DECAY = 400, 0.05, 1e-5
#: Share of a bucket's log ratio that the classifiers begin with: runs of one word say the same thing several times.
START = 0.3
MOST_PRIOR = 0.9
FOLDS, HELD_OUT = 5, 0
#: Texts that are cut at once.
AT_ONCE = 2000
SEED = 42
COUNTS = pa.schema([("bucket", pa.int32()), ("confirmed", pa.int64()), ("every", pa.int64())])
FEATURES = pa.schema([("confirmed", pa.bool_()), ("unlabelled", pa.bool_()), ("share", pa.int64()), ("features", pa.list_(pa.int32()))])
FEATURES_DDL = "confirmed boolean, unlabelled boolean, share long, features array<int>"
SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the runs of letters in them, ends marked, word by word; where each word's begin.

    The empty pieces at a text's ends are words without buckets.
    """
    there = np.flatnonzero(np.fromiter(map(len, words), np.int64, len(words)))
    whole = np.fromiter((xxhash.xxh64_intdigest(words[i].encode("utf-8", "surrogatepass"), SEED) for i in there), np.uint64, len(there))
    c = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    number = np.cumsum(c == ord("<")) - 1
    n = max(0, len(c) - LETTERS + 1)
    inside = np.flatnonzero(number[:n] == number[LETTERS - 1 :][:n])
    h = np.zeros(len(inside), np.uint64)
    for k in range(LETTERS):
        h = (h ^ c[inside + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    owner = np.concatenate([there, number[inside]])
    order = np.argsort(owner, kind="stable")
    found = np.concatenate([whole, h])[order] % np.uint64(BUCKETS)
    return found.astype(np.int64), np.searchsorted(owner[order], np.arange(len(words) + 1))


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words, the number of the word at every place, and where each text's begin."""
    # a copy that begins at its buffers' beginning, as not every function minds a slice's offset
    texts = pc.take(pc.fill_null(texts.cast(pa.large_string()), ""), pa.array(np.arange(len(texts))))
    found = pc.utf8_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}\p{N}]+", " "))
    bounds = found.offsets.to_numpy()
    pieces = found.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).dictionary_encode()
    return pieces.dictionary.to_pylist(), pieces.indices.to_numpy(), bounds - bounds[0]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def features(texts: pa.Array, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct buckets, of the ``kept`` ones, in each text, and where each text's begin."""
    words, at, bounds = cut(texts)
    found, starts = grams(words)
    there = kept[found]
    before = np.concatenate([[0], np.cumsum(there)])
    found, starts = found[there], before[starts]
    sizes = np.diff(starts)[at]
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    met = np.flatnonzero(sizes)
    pair = np.unique(np.repeat(row[met], sizes[met]) * BUCKETS + found[ranges(starts[at[met]], sizes[met])])
    return pair % BUCKETS, np.searchsorted(pair // BUCKETS, np.arange(len(texts) + 1))


def counted(train: DataFrame) -> pd.DataFrame:
    """In how many documents, and confirmed ones, each bucket occurs; at -1 the numbers of documents."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in common.slices(batches, AT_ONCE):
            words, at, bounds = cut(batch.column(1))
            found, starts = grams(words)
            sizes = np.diff(starts)
            for confirmed, low, high in zip(batch.column(0).to_pylist(), bounds, bounds[1:]):
                mine = at[low:high]
                buckets = found[ranges(starts[mine], sizes[mine])]
                # adds one to a bucket however often it is named
                held[1][buckets] += 1
                if confirmed:
                    held[0][buckets] += 1
                held[:, -1] += confirmed, 1
        there = np.flatnonzero(held[1])
        yield from common.emit(COUNTS, [np.where(there == BUCKETS, -1, there), held[0, there], held[1, there]])

    sums = train.select("confirmed", "text").mapInArrow(of, "bucket int, confirmed long, every long")
    return sums.groupBy("bucket").agg(F.sum("confirmed").alias("confirmed"), F.sum("every").alias("every")).toPandas().set_index("bucket")


def ratios(counts: pd.DataFrame, prior: float) -> np.ndarray:
    """Log ratio of every bucket that speaks for a toxic document, zero for the others."""
    out = np.zeros(BUCKETS)
    if -1 not in counts.index or not counts.loc[-1, "confirmed"]:
        return out
    n, m = counts.loc[-1, "confirmed"], counts.loc[-1, "every"]
    counts = counts.drop(index=-1)
    there, every = counts["confirmed"].to_numpy(float), counts["every"].to_numpy(float)
    likely = n * every / m
    # by the prior, at least half of the documents with the bucket are toxic
    sure = (there - likely >= SURE * np.sqrt(likely + 1)) & (prior * there / n >= 0.5 * every / m)
    clean = np.maximum(0, every / m - prior * there / n) / (1 - prior)
    ratio = np.log((there / n + PSEUDO / n) / (clean + PSEUDO / n))
    out[counts.index.to_numpy()[sure]] = np.maximum(ratio[sure], 0)
    return out


def risk_step(f: np.ndarray, toxic: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The estimate of the risk, and its gradient in f; where the clean part is below zero, what undoes that part.

    The loss is the sigmoid of -f: it is bounded, so far points that the prior does not account for cannot outweigh the rest.
    """
    sigmoid = 1 / (1 + np.exp(-np.clip(f, -50, 50)))
    of_toxic, of_rest = toxic / max(1, toxic.sum()), unlabelled / max(1, unlabelled.sum())
    steep = sigmoid * (1 - sigmoid)
    clean = float((of_rest - prior * of_toxic) @ sigmoid)
    slope = (of_rest - prior * of_toxic) * steep
    risk = prior * float(of_toxic @ (1 - sigmoid)) + max(0.0, clean)
    return risk, -slope if clean < 0 else slope - prior * of_toxic * steep


def trained(rows: list[np.ndarray], toxic: np.ndarray, unlabelled: np.ndarray, log_ratios: np.ndarray, prior: float) -> np.ndarray:
    """Weights of the buckets and, last, the bias: Adam on the risk, from the naive weights."""
    used, flat = np.unique(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), return_inverse=True)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    lift = log_ratios[used]
    w = np.append(np.full(len(used), START), np.log(prior / (1 - prior)))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        f = np.bincount(row, (w[:-1] * lift)[flat], len(rows)) + w[-1]
        _, slope = risk_step(f, toxic, unlabelled, prior)
        g = np.append(np.bincount(flat, slope[row], len(used)) * lift, slope.sum()) + DECAY * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w[:-1] = np.maximum(w[:-1], 0)  # what is kept speaks for toxic, in long texts too
    out = np.append(log_ratios, w[-1])
    out[used] = w[:-1] * lift
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the buckets, and what a text without features has; None where nothing is known of toxic texts."""

    weights: np.ndarray
    bias: float | None

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.bias is None:
            return np.zeros(len(texts))
        found, starts = features(texts, self.weights != 0)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[found])])
        return 1 / (1 + np.exp(-np.clip(sums[starts[1:]] - sums[starts[:-1]] + self.bias, -50, 50)))


def picked(what: Column, seed: str, share: float) -> Column:
    return F.pmod(F.xxhash64(what, F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def learn(train: DataFrame, labels: DataFrame) -> Model:
    """From rows (doc_id, text) and labels (doc_id, toxic) of training documents."""
    spark = train.sparkSession
    common.on_workers(spark)
    told = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    n, toxic = told.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic:
        return Model(np.zeros(BUCKETS), None)
    prior = min(MOST_PRIOR, toxic / n)
    ids = told.where("toxic = 1").select("doc_id", F.lit(True).alias("_toxic")).where(picked(F.col("doc_id"), "confirmed", CONFIRMED / toxic))
    known = train.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left").withColumn("confirmed", F.coalesce("_toxic", F.lit(False))).drop("_toxic")
    counts = counted(known)
    log_ratios = ratios(counts, prior)
    kept = log_ratios > 0
    if not kept.any():
        return Model(np.zeros(BUCKETS), float(np.log(prior / (1 - prior))))
    row = F.xxhash64("doc_id", "text")
    sample = known.withColumn("unlabelled", picked(row, "unlabelled", UNLABELLED / counts.loc[-1, "every"])).where("confirmed OR unlabelled")
    sent = spark.sparkContext.broadcast(kept)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, AT_ONCE):
            found, starts = features(batch.column(3), sent.value)
            yield from common.emit(FEATURES, [*batch.columns[:3], pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(found, pa.int32()))])

    share = F.pmod(F.xxhash64(row, F.lit("share")), F.lit(CLASSIFIERS)).alias("share")

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # in an order of their own, so that reruns agree
        rows = rows.assign(features=[tuple(x) for x in rows["features"]]).sort_values(["confirmed", "unlabelled", "features"])
        if not rows["confirmed"].any() or not rows["unlabelled"].any():
            return pd.DataFrame({"share": [], "weights": []})
        w = trained([np.array(x, np.int64) for x in rows["features"]], rows["confirmed"].to_numpy(float), rows["unlabelled"].to_numpy(float), log_ratios, prior)
        return pd.DataFrame({"share": [key[0]], "weights": [w.tolist()]})

    found = sample.select("confirmed", "unlabelled", share, "text").mapInArrow(of, FEATURES_DDL).groupBy("share").applyInPandas(fit, "share long, weights array<double>").orderBy("share").collect()
    naive = np.append(START * log_ratios, np.log(prior / (1 - prior)))
    mean = np.mean([r.weights for r in found] or [naive], axis=0)
    return Model(mean[:-1], float(mean[-1]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) for each row."""
    spark = docs.sparkSession
    common.on_workers(spark)
    sent = spark.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, AT_ONCE):
            scores = sent.value.scores(batch.column(1))
            yield from common.emit(SCORES, [batch.column(0), scores, (scores >= 0.5).astype(np.int32)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, "doc_id long, score double, predicted int")


def op13(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = common.crc_of_id(F.col("doc_id")) % FOLDS == HELD_OUT
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(~held_out)
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(~held_out)
    return scored(docs, learn(train, told)).select("doc_id", held_out.alias("held_out"), "score", "predicted")
