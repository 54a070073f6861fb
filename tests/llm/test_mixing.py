import random
import re
from collections import defaultdict

import pytest

from anchorline.llm import mixing

DDL = "doc_id long, source string, text string"


def slow_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= 2 * sizes[s]
        open_ -= over
    return target


def corpus(n=900):
    rng = random.Random(6)
    names = ["a", "b", "c", "é", "z", "Z", None]
    rows = [(i, names[min(int(rng.expovariate(0.7)), 6)], " ".join(["w"] * int(rng.choice([0, 1, 5, 40, 300])))) for i in range(n)]
    return rows + [(5000, "a", None), (5001, "empty", ""), (5002, "empty", None)]


@pytest.fixture
def small_groups(monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 25)
    monkeypatch.setattr(mixing, "FAN_IN", 4)


def test_targets_copies_and_reruns(spark, small_groups):
    rows = corpus()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, _, t in rows}
    of = {i: s for i, s, _ in rows}
    by = defaultdict(int)
    for i in size:
        by[of[i]] += size[i]
    want = slow_targets(by)
    df = spark.createDataFrame(rows, DDL)
    out = {r.doc_id: r for r in mixing.op9(df).collect()}
    assert set(out) == set(size)
    taken = defaultdict(int)
    for i, r in out.items():
        assert r.size == size[i] and r.source_size == by[of[i]] and abs(r.target - want[of[i]]) < 1e-6 * (1 + want[of[i]])
        assert r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[of[i]] += r.taken
    for s in by:
        assert abs(taken[s] - want[s]) <= 300  # one document at most is rounded without a partner
    again = {r.doc_id: r.taken for r in mixing.op9(df.repartition(7)).collect()}
    assert again == {i: r.taken for i, r in out.items()}


@pytest.mark.parametrize("seed", range(6))
def test_limits_are_reshared(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i:02}": int(rng.expovariate(0.02) ** 1.5) for i in range(rng.randint(1, 12))} | ({None: 40} if seed % 2 else {})
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = slow_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_levels_and_one_group_agree_on_the_words(spark, monkeypatch):
    rows = [(i, "s" if i % 3 else "t", "w " * (1 + i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, DDL)
    one = mixing.op9(df).groupBy("source_size").sum("taken").collect()
    monkeypatch.setattr(mixing, "GROUP", 10)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    many = mixing.op9(df).groupBy("source_size").sum("taken").collect()
    for a, b in zip(sorted(one), sorted(many)):
        assert abs(a[1] - b[1]) <= 14


def test_pivotal_keeps_sum_and_expectation():
    rng = random.Random(1)
    totals = [0.0] * 9
    sizes = [3, 10, 1, 8, 8, 40, 2, 5, 6]
    parts = [0.3, 0.5, 0.9, 0.25, 0.6, 0.5, 0.1, 0.45, 0.7]
    for trial in range(4000):
        out = mixing.pivotal(sizes, parts, [rng.getrandbits(40) for _ in sizes])
        assert sum(0 < p < 1 for p in out) <= 1
        assert abs(sum(a * p for a, p in zip(sizes, out)) - sum(a * p for a, p in zip(sizes, parts))) < 1e-6
        totals = [t + p for t, p in zip(totals, out)]
    assert all(abs(t / 4000 - p) < 0.03 for t, p in zip(totals, parts))


def test_mixed_rows(spark, small_groups):
    rows = [(i, "s" if i % 3 else None, "w " * (1 + i % 7), i) for i in range(60)] + [(None, "s", "w w", 1), (3, None, "more", 2), (3, None, "more", 2)]
    df = spark.createDataFrame(rows, DDL + ", copies int")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    n = defaultdict(int)
    for r in out.collect():
        n[tuple(r)] += 1
    assert set(n) <= set(rows) and max(n.values()) <= 4
    taken = sum(len(k[2].split()) * v for k, v in n.items())
    assert abs(taken - 1.5 * sum(len(r[2].split()) for r in rows)) <= 30


def test_rows_without_ids_are_split(spark):
    rows = [(None, "s", f"a{i} b c d") for i in range(200)] + [(i, "t", "w " * 9) for i in range(100)]
    out = mixing.op9(spark.createDataFrame(rows, DDL)).collect()
    assert len(out) == 300
    by = defaultdict(int)
    for r in out:
        by[r.doc_id is None] += r.taken
    target = {r.doc_id is None: r.target for r in out}
    assert all(abs(by[k] - target[k]) <= 9 for k in by)
    taken = mixing.mixed(spark.createDataFrame(rows, DDL)).where("doc_id IS NULL").count()
    assert abs(4 * taken - target[True]) <= 4


def test_very_long_text(spark):
    rows = [(1, "s", "w " * 300_000), (2, "s", "w"), (3, "t", "w " * 50)]
    out = {r.doc_id: r for r in mixing.op9(spark.createDataFrame(rows, DDL)).collect()}
    assert out[1].size == 300_000 and out[1].taken <= 600_000


def test_empty(spark):
    df = spark.createDataFrame([], DDL)
    assert mixing.op9(df).count() == 0 and mixing.mixed(df).count() == 0
    assert [r.taken for r in mixing.op9(spark.createDataFrame([(1, "s", None)], DDL)).collect()] == [0]
