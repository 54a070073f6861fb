import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from anchorline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    threes = list(zip(words, words[1:], words[2:]))
    often = Counter(threes)
    covered = {i + k for i, t in enumerate(threes) if often[t] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def some_texts():
    rng = random.Random(8)
    words = ["a", "b", "cé", "d|", "x\xa0y", "<#", "the", *(f"w{i}" for i in range(60))]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b"]
    texts = ["".join(rng.choice(words[: rng.choice([3, 20, 67])]) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 2, 3, 49, 50, 200]))) for _ in range(150)]
    return texts + [None, "", " \n", "a", " a b a b a b", "x\nx\n\n\nx", "spam " * 20000, "# & $\x85b", "😀 " * 60]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")


def test_plain_measures(spark, labels):
    texts = some_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.op8(df, labels).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id]), texts[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_scores_against_brute_force(spark, labels):
    texts = some_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bits = {tuple(r.w): r.h for r in spark.createDataFrame([(list(w),) for w in sorted({w for t in texts for w in WORD.findall(t or "")} and {(w,) for t in texts for w in WORD.findall(t or "")})], "w array<string>").select("w", F.xxhash64(F.col("w")[0]).alias("h")).collect()}
    pairs = sorted({(bits[(a,)], bits[(b,)]) for t in texts for a, b in zip(WORD.findall(t or ""), WORD.findall(t or "")[1:])})
    both = {(r.a, r.b): r.h for r in spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}

    def grams(t):
        h = [bits[(w,)] for w in WORD.findall(t or "")]
        return [x % quality.BUCKETS for x in h] + [both[p] % quality.BUCKETS for p in zip(h, h[1:])]

    import math
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    raw, trusted = Counter(), Counter()
    for i, t in enumerate(texts):
        raw.update(grams(t))
        trusted.update(grams(t) if i in good else [])
    n, m = sum(raw.values()), sum(trusted.values())
    w = {b: math.log((trusted[b] + quality.PSEUDO) / (m * raw[b] / n + quality.PSEUDO)) for b in raw}
    for r in quality.op8(df, labels).collect():
        g = grams(texts[r.doc_id])
        want = sum(w[b] for b in g) / len(g) if g else 0
        assert abs(r.score - want) < 2e-6
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)


def test_filter_keeps_rows_whole(spark, labels):
    good = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(1, good, "a", 5), (1, good, "b", 6), (2, "short", "c", 7), (None, None, None, None)], "doc_id long, text string, score string, _n int")
    out = quality.filtered(df, labels)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, good, "a", 5), (1, good, "b", 6)]


def test_nothing_to_learn_from(spark, labels):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(80)))], "doc_id long, text string")
    none = labels.limit(0)
    assert [(r.kept, r.score) for r in quality.op8(df, none).collect()] == [(True, 0.0)]
    assert quality.op8(df.limit(0), none).count() == 0
