"""Pairs by blocks against all pairs, with several blocks and equal templates."""

import math
import random

import pytest

from anchorline.operators import blocks, joins, pairing
from anchorline.plans import registry

UNITS = "probe int, unit_id long, template array<double>, x double, y double"


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(8)
    kinds = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)] + [[0.0] * 6, [1.0, 2.0]]
    rows = [(u % 2, u, [v + (u % 3) * rng.choice([0.0, 0.1]) for v in kinds[u % 14]], rng.random() * 90, float(u % 14)) for u in range(300)]
    few = [(k, u, t, x if u % 5 else 1.0, y) for k, u, t, x, y in rows[:120]]
    return few[::2], few[1::2], rows


def cosine(a, b):
    if len(a) != len(b) or not any(a) or not any(b):
        return None
    return sum(p * q for p, q in zip(a, b)) / math.sqrt(sum(p * p for p in a) * sum(q * q for q in b))


def test_pairs_and_rounds(spark, sides, monkeypatch):
    a, b = (spark.createDataFrame([(0, *r[1:]) for r in s], UNITS) for s in sides[:2])
    monkeypatch.setattr(blocks, "BLOCK", 25)
    want = {(p[1], q[1]): cosine(p[2], q[2]) for p in sides[0] for q in sides[1]}
    got = {(r.unit_a, r.unit_b): r.cos for r in blocks.pairs(a, b, ["probe"]).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())
    pairs = blocks.pairs(a, b, ["probe"])
    every = {(r.unit_a, r.unit_b) for r in joins.mutual_best(pairs, ["probe"], "unit_a", "unit_b", "sim").collect()}
    assert {(r.unit_a, r.unit_b) for r in blocks.mutual_best(a, b, ["probe"]).collect()} == every


def test_links_are_few_and_join_the_same_units(spark, sides, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 40)
    units = spark.createDataFrame([r for r in sides[2] if r[0] == 0], UNITS)
    n, found = units.count(), pairing.merge_edges(units, ["probe"], 0.9)
    root = {r.node: r.root for r in pairing.groups(found).collect()}
    rows, least = [r for r in sides[2] if r[0] == 0], {}
    for i, r in enumerate(rows):
        joined = {least[q[1]] for q in rows[:i] if (c := cosine(r[2], q[2])) is not None and round(c, 6) >= 0.9}
        name = min(joined | {r[1]})
        least = {k: name if v in joined else v for k, v in least.items()} | {r[1]: name}
    assert all(root.get(u, u) == v for u, v in least.items()) and len(set(least.values())) > 3
    assert found.count() <= 2 * n * math.ceil(n / blocks.BLOCK)


@pytest.mark.parametrize("name", ["similarity_bands", "close_units", "merge_units", "pair_bands", "pairing_summary", "unit_pairs", "unit_similarity"])
def test_all_are_compared_by_blocks(monkeypatch, spark, name):
    asked, met = [], blocks.met
    monkeypatch.setattr(blocks, "met", lambda *x: asked.append(x) or met(*x))
    registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert asked


def test_rounds_and_the_order_of_the_rest_agree(spark, monkeypatch):
    """With ties, chains and missing scores: all in rounds, all in order, and rounds first."""
    rng = random.Random(3)
    rows = [(k, a, b, rng.choice([None, 0.5, float(rng.randrange(6)), float(a + b)])) for k in range(3) for a in range(14) for b in range(12) if rng.random() < 0.6]
    pairs, found = spark.createDataFrame(rows, "k int, a long, b long, s double"), []
    for last in (0, 150, 1 << 18):
        monkeypatch.setattr(joins, "LAST", last)
        found.append(sorted((r.k, r.a, r.b) for r in joins.mutual_best(pairs, ["k"], "a", "b", "s").collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) > 20


def test_a_short_rest_is_not_paired_by_rounds(spark):
    """A chain in which every pair waits for the one before took a round each."""
    rows = [(0, i // 2 + i % 2, i // 2, float(100 - i)) for i in range(60)]
    group = "short-rest"
    spark.sparkContext.setJobGroup(group, group)
    found = joins.mutual_best(spark.createDataFrame(rows, "k int, a long, b long, s double"), ["k"], "a", "b", "s").collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert len(found) == 30 and jobs < 15


def test_what_the_product_leaves_out_is_below_the_least(monkeypatch):
    """Every pair of the fold, with blends just at the least, templates without a value, of other lengths and of extreme sizes."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(4)
    kinds = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(40)] + [None, [], [None, 1.0], [0.0] * 6, [1e-170] * 6, [1e160] * 6, [1.0] * 5, [float("inf")] * 6, [float("nan"), 1.0]]
    table = lambda ts: pa.table({"unit_id": list(range(len(ts))), "template": pa.array(ts, pa.list_(pa.float64())), "x": [0.5 * i for i in range(len(ts))], "y": [0.0] * len(ts)})
    for x, y in ((kinds, kinds[::-1]), (kinds[:40], kinds[:30])):
        x, y = blocks.Side(table(x)), blocks.Side(table(y))
        with np.errstate(all="ignore"):
            whole = blocks.compared(x, y, slice(0, 128))[2]
            for least in (0.6, float(np.nanmax(whole)), float(np.nanmedian(whole)), 0.2):
                i, j = blocks.likely(x, y, slice(0, 128), least)
                held = blocks._measured(x, y, i, j)[2] >= least
                assert sorted(zip(i[held].tolist(), j[held].tolist())) == sorted(zip(*(v.tolist() for v in np.nonzero(whole >= least))))
    few = blocks.likely(x, y, slice(0, 128), 0.6)
    assert 0 < len(few[0]) < 0.6 * whole.size
