import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from anchorline.llm import lm_bloom as lm

DDL = "doc_id long, text string"


def toks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) + ["\n"]


def corpus(n=150):
    rng = random.Random(5)
    words = [f"w{int(rng.expovariate(0.05))}" for _ in range(300)] + ["É", "The", "the"]
    return [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 8, 90])))) for i in range(n)] + [(900, None), (901, "never seen before"), (902, "x " * 9000)]


def check(spark):
    rows = corpus()
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in train for w in toks(t))
    n, v = sum(c.values()), len(c)
    out = {r.doc_id: r for r in lm.scored(spark.createDataFrame(rows, DDL).repartition(4)).collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        r, w = out[i], toks(t)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 1) and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == (len(w), sum(c[x] > 0 for x in w))
        assert abs(r.base_score - sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) < 1e-6 * len(w)
        assert r.score < 0
    return out


def test_base_scores(spark):
    check(spark)


def test_base_scores_over_many_batches_and_segments(spark, monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 900)
    monkeypatch.setattr(lm, "SEGMENT", 2000)
    check(spark)


def test_filter_holds_what_was_put_in():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**62, size=30000).astype(np.uint64)
    c = rng.zipf(1.7, size=30000).clip(1, 10**6)
    bloom = lm.Filter(h, c)
    levels = bloom.levels(h).astype(int)
    assert (levels >= lm.level_of(c)).all()
    assert (levels > lm.level_of(c)).mean() < 0.05
    assert (bloom.levels(rng.integers(0, 2**62, size=20000).astype(np.uint64)) > 0).mean() < 0.05
    assert (lm.Filter(h[:0], c[:0]).levels(h) == 0).all()


def test_pairs_lift_the_likelihood_of_held_out_text(spark):
    rng = random.Random(2)
    follow = {i: rng.sample(range(200), 3) for i in range(200)}
    def text():
        w, out = rng.randrange(200), []
        for _ in range(120):
            out.append(f"t{w}")
            w = rng.choice(follow[w])
        return " ".join(out)
    out = [r for r in lm.scored(spark.createDataFrame([(i, text()) for i in range(200)], DDL)).collect() if r.held_out]
    assert out and all(r.score > r.base_score + 10 for r in out)


def test_edges(spark):
    assert lm.scored(spark.createDataFrame([], DDL)).count() == 0
    df = spark.createDataFrame([(1, "a b", 1), (1, "a b", 2), (None, "a", 3)], DDL + ", h int")
    rows = lm.scored(df).collect()
    assert len(rows) == 3 and {r.n_tokens for r in rows} == {3, 2}
    alone = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    [r] = lm.scored(spark.createDataFrame([(alone, "only held out")], DDL)).collect()
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 4)


def counts_of(rows):
    train = [toks(t) for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    return Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["\n", *t], t))


def pair_hash(a, b):
    h = lm.hashed([a.encode(), b.encode()])
    return int(lm.pairs(h, np.array([1]), np.array([0]))[0])


class Plain:
    """The model in plain Python, with levels read from a filter built here of the same n-grams."""

    def __init__(self, rows):
        self.c, self.two = counts_of(rows)
        self.n, self.v = sum(self.c.values()), len(self.c)
        hashes = [int(lm.hashed([w.encode()])[0]) for w in self.c] + [pair_hash(*p) & 0xFFFFFFFF for p in self.two]
        # pairs with the same low bits are one
        total = Counter()
        for h, x in zip(hashes, [*self.c.values(), *self.two.values()]):
            total[h] += x
        self.filter = lm.Filter(np.array(list(total), np.uint64), np.array(list(total.values())))

    def level(self, h):
        return int(self.filter.levels(np.array([h], np.uint64))[0])

    def probability(self, a, b):
        low = lambda q: math.ceil(lm.BASE ** (q - 1)) if q else 0
        high = lambda q: max(low(q), math.ceil(lm.BASE**q) - 1)
        cap = int(lm.level_of(np.array([self.n]))[0]) if self.n else 0
        of = lambda w: min(cap, self.level(int(lm.hashed([w.encode()])[0])))
        first, second = of(a), of(b)
        both = min(self.level(pair_hash(a, b) & 0xFFFFFFFF), first, second)
        single = (low(second) + 0.5) / (self.n + 0.5 * (self.v + 1))
        return lm.PAIR_WEIGHT * low(both) / high(first) + (1 - lm.PAIR_WEIGHT) * single if first else single

    def score(self, text):
        t = toks(text)
        return sum(math.log10(self.probability(a, b)) for a, b in zip(["\n", *t], t))


def test_scores_are_those_of_the_filters_levels(spark):
    rows = corpus(120)
    plain = Plain(rows)
    for r in lm.scored(spark.createDataFrame(rows, DDL).repartition(4)).collect():
        assert abs(r.score - plain.score(dict(rows)[r.doc_id])) < 1e-6


def test_scores_are_log_probabilities_for_poor_corpora(spark):
    for texts in ([None] * 8, [""] * 12, [""] * 18, [""] * 27, ["a"] * 40, ["a a a a a"] * 9, ["a b"] * 3 + [""] * 30):
        for r in lm.scored(spark.createDataFrame(list(enumerate(texts)), DDL)).collect():
            assert r.score < 0


def test_probabilities_after_a_history_sum_to_at_most_one():
    plain = Plain(corpus(200))
    # what the filter holds by chance is not the model's: probabilities from levels of the true counts
    words = list(plain.c)
    q = lambda x: lm.level_of(np.array(x)) * (np.array(x) > 0)
    own = q([plain.c[w] for w in words])
    for a in [*words[:40], "\n", "unseen"]:
        both = q([plain.two[a, w] for w in words])
        got = lm.likelihood(both, np.full(len(words), q([plain.c[a]])[0]), own, plain.n, plain.v)
        unseen = lm.likelihood(np.zeros(1, int), q([plain.c[a]]), np.zeros(1, int), plain.n, plain.v)
        assert 0.3 < got.sum() + unseen.sum() <= 1 + 1e-12


def test_a_stored_filter_scores_other_documents(spark, monkeypatch):
    rows = corpus(200)
    docs = spark.createDataFrame(rows, DDL)
    for segment, broadcast in ((lm.SEGMENT, lm.BROADCAST), (2000, lm.BROADCAST), (2000, -1)):
        monkeypatch.setattr(lm, "SEGMENT", segment)
        monkeypatch.setattr(lm, "BROADCAST", broadcast)
        model, _, _ = lm.learnt(docs)
        own = {r.doc_id: r for r in lm.scored(docs).collect()}
        again = lm.rescored(docs, model).collect()
        assert len(again) == len(rows)
        for r in again:
            assert abs(r.score - own[r.doc_id].score) < 1e-9 and r.n_tokens == own[r.doc_id].n_tokens and r.n_known >= own[r.doc_id].n_known
        other = lm.rescored(spark.createDataFrame([(1, "w1 w2"), (2, None), (None, "unheard of")], DDL), model).collect()
        assert len(other) == 3 and all(r.score < 0 for r in other)
        assert lm.rescored(spark.createDataFrame([], DDL), model).count() == 0


def test_held_out_copies_are_told_apart(spark):
    """One training document is enough for the model to know a text."""
    rng = random.Random(9)
    text = lambda: " ".join(f"u{rng.randrange(3000)}" for _ in range(80))
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, text()) for i in range(400)]
    twice = [(i, rows[i - 1][1]) for i in held if i - 1 not in held and i]
    rows = {**dict(rows), **dict(twice)}
    out = {r.doc_id: r.score - r.base_score for r in lm.scored(spark.createDataFrame(list(rows.items()), DDL)).collect()}
    again = {i for i, _ in twice}
    assert again and min(out[i] for i in again) > max(out[i] for i in held if i not in again)
