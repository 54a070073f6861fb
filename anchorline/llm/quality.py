"""Quality rules with a log-likelihood ratio of hashed word n-grams; DataFrame functions only.

Two multinomials over hashed words and word pairs are counted: one over the
trusted documents (labelled quality 1 and toxic 0), one over the whole corpus.  A
document's score is the mean of log(trusted / raw) over its n-grams, and it is
kept where the score reaches a fixed threshold and the plain rules pass.

The trusted side is the one bounded sample: of the trusted labels those whose
hashed id falls under a share, about ``TRUSTED`` in all, so that their ids can be
broadcast.  The raw side counts every document.  The table of weights has
``BUCKETS`` entries whatever the input.

Defined results: null and empty texts have no words and fail the plain rules; a very long
text is measured whole, its words in one row; repeated rows
get equal results; without trusted labels every weight is zero; an empty table
gives no rows; columns other than ``doc_id`` and ``text`` only pass through
``filtered``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS, TRUSTED = 1 << 15, 100_000
#: Mean log ratio from which a document is kept; pseudo-count on both sides of a ratio.
THRESHOLD, PSEUDO = -0.07, 20.0
MIN_WORDS, MAX_REPEATED = 50, 50


def pairs_of(values: Column, n: Column, join) -> Column:
    """join(v[i], v[i+1]) for all neighbours."""
    m = F.greatest(n - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), m), F.slice(values, F.lit(2), m), join)


def hashed(docs: DataFrame) -> DataFrame:
    """With _words, _n, _h (hashes of the words) and _pairs (hashes of neighbours)."""
    cut = docs.withColumn("_words", common.words(F.col("text").cast("string")))
    cut = cut.withColumn("_n", F.size("_words")).withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    return cut.withColumn("_pairs", pairs_of(F.col("_h"), F.col("_n"), lambda a, b: F.xxhash64(a, b)))


def bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def gram_rows(docs: DataFrame, *keep: str) -> DataFrame:
    """(keep, bucket): a row for each word and each pair of neighbours, hashed as rows in generated code, not inside arrays."""
    cut = docs.select(*keep, common.words(F.col("text").cast("string")).alias("_words"))
    both = cut.select(*keep, F.explode(F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", F.lit(2), F.size("_words")).alias("b"))).alias("_z"))
    hashes = both.select(*keep, F.xxhash64("_z.a").alias("a"), F.when(F.col("_z.b").isNotNull(), F.xxhash64("_z.b")).alias("b"))
    pair = F.when(F.col("b").isNotNull(), bucket(F.xxhash64("a", "b")))
    return hashes.select(*keep, F.explode(F.array(bucket(F.col("a")), pair)).alias("bucket")).where("bucket IS NOT NULL")


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = labels.where("quality = 1 AND toxic = 0").select(F.col("doc_id").cast("long").alias("doc_id"))
    share = min(1.0, TRUSTED / max(1, good.count()))
    return good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()


def weights(docs: DataFrame, labels: DataFrame) -> list[float]:
    """The log ratio of every bucket."""
    ids = F.broadcast(trusted_ids(labels).withColumn("_trusted", F.lit(1)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left")
    counts = (
        gram_rows(texts.withColumn("t", F.coalesce("_trusted", F.lit(0))), "t")
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("t").alias("trusted")).collect()
    )
    raw, trusted = sum(r.raw for r in counts), sum(r.trusted for r in counts)
    found = [0.0] * BUCKETS
    for r in counts:
        if trusted:
            found[r.bucket] = round(math.log((r.trusted + PSEUDO) / (trusted * r.raw / raw + PSEUDO)), 6)
    return found


def repeated_words(n: Column) -> DataFrame:
    """How many words lie in a run of three words that the text has more than once."""
    ordered = F.col("_ordered")
    twice = F.flatten(pairs_of(ordered, F.size(ordered), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
    covered = F.array_distinct(F.flatten(F.transform(F.array_distinct(twice), lambda i: F.array(i, i + 1, i + 2))))
    return F.size(covered).cast("long")


def measured(docs: DataFrame, log_ratios: list[float]) -> DataFrame:
    """``docs`` with the plain measures, ``score``, ``base_failed`` and ``kept``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{common.BLANKS[1:-1]}]"))
    table = F.from_json(F.lit("[" + ",".join(map(str, log_ratios)) + "]"), "array<double>")
    df = hashed(docs).withColumns({"_lines": lines, "_threes": pairs_of(F.col("_pairs"), F.size("_pairs"), lambda a, b: F.xxhash64(a, b))})
    df = df.withColumn("_ordered", F.when(F.size(F.array_distinct("_threes")) < F.size("_threes"), F.sort_array(F.transform("_threes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    weighed = lambda s, h: s + F.get(table, bucket(h))
    df = df.withColumns({
        "n_words": F.col("_n").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(F.when(F.col("_ordered").isNotNull(), repeated_words(F.col("_n"))), F.lit(0).cast("long")),
        "score": F.round(F.aggregate("_pairs", F.aggregate("_h", F.lit(0.0), weighed), weighed) / F.greatest(F.size("_h") + F.size("_pairs"), F.lit(1)), 9),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= THRESHOLD))


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = measured(docs.select("doc_id", "text"), weights(docs, labels))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    inner = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    # the task's number keeps the filter above the measures: pushed below them it would work them out anew for every element
    found = measured(inner, weights(docs, labels)).withColumn("_task", F.spark_partition_id())
    return found.where("kept AND _task >= 0").select("_row.*")
