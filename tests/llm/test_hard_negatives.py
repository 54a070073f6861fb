import random
from collections import defaultdict

import numpy as np
import pytest

from anchorline.llm import hard_negatives as hn

DDL = "vec_id long, label int, embedding array<float>"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, relabel=True, step=100):
    """All pairs in plain Python; of repeated ids the least row counts."""
    held = {}
    for i, label, e in rows:
        if i is None or label is None or e is None or not all(c is not None and np.isfinite(c) for c in e):
            continue
        label = (label + 1) % 10 if relabel and i % 7 == 0 else label
        one = (label, [int(np.floor(256 * float(np.float32(c)))) for c in e])
        held[i] = min(held.get(i, one), one)
    out = []
    for a, (label, x) in held.items():
        if a % step:
            continue
        each = sorted((-sum(p * q for p, q in zip(x, y)), i, m == label) for i, (m, y) in held.items() if i != a)
        for s, i, _ in [e for e in each if e[2]][:5]:
            near = [(-n, j) for n, j, same in each if not same and 30 * -s <= 100 * -n <= 90 * -s][:10]
            out += [(a, i, k, j, -s, n) for k, (n, j) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    return sorted(tuple(r[c] for c in COLUMNS) for r in hn.op11(spark.createDataFrame(rows, DDL)).collect())


def vectors(n, seed=1, labels=10):
    rng = random.Random(seed)
    return [(i, rng.randrange(labels), [rng.gauss(0.1, 1) for _ in range(6)]) for i in range(n)]


def test_against_all_pairs(spark):
    rows = vectors(700)
    assert mined(spark, rows) == brute(rows) != []


def test_blocks_and_partitions_do_not_matter(spark, monkeypatch):
    rows = vectors(400, 2)
    monkeypatch.setattr(hn, "ROWS", 23)
    monkeypatch.setattr(hn, "AT_ONCE", 2)
    assert mined(spark, rows) == brute(rows) != []


def test_a_hot_label_ties_and_equal_vectors(spark):
    rows = [(i, 3 if i % 3 else i % 10, [(i % 5 + 1) / 5, 0.0]) for i in range(600)]
    assert mined(spark, rows) == brute(rows) != []


def test_nulls_repeats_and_odd_rows(spark):
    rows = vectors(300, 3)
    rows += [(None, 1, [0.1] * 6), (100, 1, None), (200, None, [0.1] * 6), (900, 2, [float("nan")] * 6), (901, 2, [float("inf")] * 6), (902, 2, [0.1, None]), (903, 4, []), (904, 5, [1.0])]
    rows += [rows[0], rows[0], (rows[1][0], rows[1][1], [2.0] * 6), (100, 0, [0.5] * 6)]
    assert mined(spark, rows) == brute(rows) != []


def test_empty_table_clashing_columns_and_an_anchor_alone(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0]), (5, 2, [1.0])]) == []
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in vectors(300)], DDL + ", score int, windows string, block int")
    assert sorted(tuple(r[c] for c in COLUMNS) for r in hn.op11(df).collect()) == brute(vectors(300))


def test_negative_and_zero_scores(spark):
    rows = [(0, 1, [1.0, 0.0]), *((i, 1 + i % 2, [-0.5 if i < 40 else 0.0, 1.0]) for i in range(1, 80) if i % 7)]
    assert mined(spark, rows) == brute(rows)


def test_keys_sort_as_their_parts():
    rng = random.Random(4)
    parts = [(rng.randint(-5, 5) * 10**12, rng.randint(-5, 5), rng.randint(0, 1), rng.randint(-9, 9)) for _ in range(500)]
    assert sorted(parts, key=lambda p: hn.packed(*p)) == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_the_stream_holds_no_rows():
    def keys():
        for anchor in range(3):
            yield hn.packed(anchor, 1000, hn.POSITIVE, 1)
            for i in range(2000):
                yield hn.packed(anchor, 950 - i // 10, hn.NEGATIVE, 10 + i)
    out = defaultdict(list)
    for a, p, rank, n, ps, ns in hn.streamed(keys(), 4, 30, 90):
        out[a].append((p, rank, n, ps, ns))
    assert out == {a: [(1, k, 509 + k, 1000, 900) for k in range(1, 5)] for a in range(3)}


def test_exact_products_and_overflow():
    a = np.array([[2**30, 1]]), np.array([[2**30, -1], [3, 5]])
    assert hn.product(*a).tolist() == [[2**60 - 1, 3 * 2**30 + 5]]
    with pytest.raises(OverflowError):
        hn.product(np.array([[2**40]]), np.array([[2**40]]))
