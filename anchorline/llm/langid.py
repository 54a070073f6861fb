"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed character n-grams (one to three letters of the
lower-case text, everything that is no letter being a gap), weighted by log term
frequency and inverse document frequency and normalised.  Each language is learnt
as several centroids by spherical k-means; a text gets the language of the
centroid of the greatest cosine.  A text whose cosine is far below what the
centroid's own members have is flagged as rejected.

The document frequencies cover every training document.  The clustering is fitted
on a bounded sample, about ``SAMPLE`` documents of each language, picked by a hash
of their ids.  What is broadcast has ``CLUSTERS`` times ``BUCKETS`` numbers for
each language, and there are as many languages as labels.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as
is every text if there is nothing to learn from; a null id counts as empty text
in the split; repeated rows each get a row; a very long text is read whole, its vector is
no longer than another's; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS, CLUSTERS, SAMPLE, ROUNDS = 1 << 13, 4, 500, 12
FOLDS, HELD_OUT = 5, 0
#: A text is rejected below this share of the cosine that all but a hundredth of the centroid's members reach.
REJECT = 0.6
UND = "und"
GAP = 32
MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
LETTER = np.array([chr(i).isalpha() for i in range(0x3000)])

CENTROIDS = "lang string, cluster int, usual double, centroid array<float>"
PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams and how often each occurs."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    known = LETTER[np.minimum(c, len(LETTER) - 1)] | (c >= len(LETTER))
    c = np.where(known, c, GAP).astype(np.uint32)
    c = np.concatenate([[GAP], c, [GAP]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != GAP) | (c[:-1] != GAP)])]  # gaps are one character
    one = c[c != GAP] * MULTIPLIERS[0]
    two = c[:-1] * MULTIPLIERS[1] + c[1:] * MULTIPLIERS[0]
    three = c[:-2] * MULTIPLIERS[2] + c[1:-1] * MULTIPLIERS[1] + c[2:] * MULTIPLIERS[0] if len(c) > 2 else c[:0]
    h = np.concatenate([one, two ^ np.uint32(0x5BD1E995), three ^ np.uint32(0x27D4EB2F)])
    found = np.bincount((h * np.uint32(0x9E3779B1)) >> np.uint32(33 - BUCKETS.bit_length()), minlength=BUCKETS)
    at = np.flatnonzero(found)
    return at, found[at]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and normalised weights."""
    at, n = grams(text)
    w = (1 + np.log(n)) * idf[at]
    size = np.sqrt((w * w).sum())
    return at, (w / size if size else w).astype(np.float32)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Inverse document frequency of every bucket, over all texts."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS + 1, np.int64)  # the last counts the documents
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is not None:
                    held[grams(text)[0]] += 1
                    held[-1] += 1
        yield from common.emit(schema, [np.arange(BUCKETS + 1), held])

    total = np.zeros(BUCKETS + 1)
    for r in texts.mapInArrow(of, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r.bucket] = r.n
    return np.log((1 + total[-1]) / (1 + total[:-1])) + 1


def clustered(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids of unit length, and each row's cluster; starts from rows far from each other."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(chosen) < min(k, len(x)):
        near = (x @ x[chosen].T).max(axis=1)
        if near.min() > 0.999:
            break
        chosen.append(int(np.argmin(near)))
    centres = x[chosen]
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        centres = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres, np.argmax(x @ centres.T, axis=1)


class Model:
    def __init__(self, idf: np.ndarray, langs: list[str], usual: np.ndarray, centroids: np.ndarray):
        self.idf, self.langs, self.usual = idf, langs, usual
        self.by_bucket = np.ascontiguousarray(centroids.T)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.langs or not has_letter(text):
            return UND, 0.0, True
        at, w = vector(text, self.idf)
        cosine = w @ self.by_bucket[at]
        best = int(np.argmax(cosine))
        return self.langs[best], float(min(1.0, max(0.0, cosine[best]))), bool(cosine[best] < REJECT * self.usual[best])


def learn(train: DataFrame) -> Model:
    """From rows (doc_id, text, lang) without null languages."""
    spark = train.sparkSession
    common.on_workers(spark)
    train = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    idf = document_frequencies(train.select("text"))
    sizes = train.groupBy("lang").agg(F.count("*").alias("n"))
    shares = common.saved(sizes.select(F.col("lang").alias("of"), F.least(F.lit(1.0), SAMPLE / F.col("n")).alias("share")), "shares")
    picked = train.join(F.broadcast(shares), F.col("lang") == F.col("of"))  # one row a language
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    sample = picked.where(draw < F.col("share")).select("lang", "doc_id", "text")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[[has_letter(t) for t in rows["text"]]]
        rows = rows.assign(tie=[xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in rows["text"]]).sort_values(["doc_id", "tie"])
        if not len(rows):
            return pd.DataFrame({"lang": [], "cluster": [], "usual": [], "centroid": []})
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for row, text in zip(x, rows["text"]):
            at, w = vector(text, idf)
            row[at] = w
        centres, own = clustered(x, CLUSTERS)
        near = (x * centres[own]).sum(axis=1)
        usual = [float(np.quantile(near[own == j], 0.01)) if (own == j).any() else 1.0 for j in range(len(centres))]
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "cluster": range(len(centres)), "usual": usual, "centroid": list(centres)})

    found = sample.groupBy("lang").applyInPandas(fit, CENTROIDS).orderBy("lang", "cluster").collect()
    centroids = np.array([r.centroid for r in found], np.float32).reshape(-1, BUCKETS)
    return Model(idf, [r.lang for r in found], np.array([r.usual for r in found]), centroids)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    spark = docs.sparkSession
    common.on_workers(spark)
    sent = spark.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in common.slices(batches):
            rows = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield from common.emit(PREDICTED, [batch.column(0), *zip(*rows)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, "doc_id long, lang_pred string, score double, rejected boolean")


def op4(docs: DataFrame) -> DataFrame:
    held_out = common.crc_of_id(F.col("doc_id")) % FOLDS == HELD_OUT
    train = docs.where(~held_out).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return predicted(docs, learn(train)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
