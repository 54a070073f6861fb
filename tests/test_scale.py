"""Operators that avoid all pairs, one task for a key, or one task for all: against brute force, and their plans."""

import math
import random
import re
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorline.functions import ranks, stats
from anchorline.operators import joins, matching, neighbours, pairing, population

UNITS = "probe int, unit_id long, template array<double>, x double, y double"


def probe_units(n, seed=1, first=0, jitter=0.05):
    """Units along a probe with two to a site; a template is large on the channels near its site only."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        site = i // 2
        template = [0.0] * (8 * (n // 2 + 2))
        for c in range(12):
            template[8 * site + c] = math.sin(c + i % 2) + rng.gauss(0, jitter)
        rows.append((0, first + i, template, rng.random() * 10, site * 20.0 + rng.random()))
    return rows


def similarity(a, b):
    x, y = np.array(a[2]), np.array(b[2])
    c = x @ y / np.sqrt((x @ x) * (y @ y)) if x.any() and y.any() else -1
    d = math.dist(a[3:], b[3:])
    return c, d, 0.7 * c + 0.3 * math.exp(-d / 100)


@pytest.mark.parametrize("least", [0.35, 0.6, 0.75, 0.95])
def test_similar_pairs_are_all_pairs_above_the_bound(spark, least):
    rng = random.Random(int(100 * least))
    a, b = probe_units(24, 1), probe_units(24, 2, 100)
    more = [(1, i, [rng.gauss(0, 1) for _ in range(20)], rng.random() * 200, rng.random() * 200) for i in range(20)]
    a += more + [(1, 90, [0.0] * 20, 0.0, 0.0), (2, 91, [1.0], 0.0, 0.0)]
    b += [(k, i + 500, [v + rng.gauss(0, 0.6) for v in t], x, y) for k, i, t, x, y in more]
    got = {(r.unit_a, r.unit_b): r.sim for r in neighbours.similar_pairs(spark.createDataFrame(a, UNITS), spark.createDataFrame(b, UNITS), ["probe"], least).collect()}
    want = {(p[1], q[1]): s for p, q in product(a, b) if p[0] == q[0] and (s := similarity(p, q)[2]) >= least}
    assert got.keys() == want.keys() != set() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_candidates_grow_with_the_units_at_one_density(spark):
    n = {}
    for size in (40, 80, 160):
        a, b = (spark.createDataFrame(probe_units(size, s), UNITS) for s in (1, 2))
        n[size] = neighbours.candidates(a, b, ["probe"], (0.6 - 0.3) / 0.7).count()
    assert n[40] < 40 * 40 / 2 and n[80] <= 2.3 * n[40] and n[160] <= 2.3 * n[80]


def test_pairs_of_the_pruned_join_are_those_of_all_pairs(spark):
    a, b = (spark.createDataFrame(probe_units(20, s, 100 * s, 0.4), UNITS) for s in (1, 2))
    every = joins.mutual_best(pairing.similarities(a, b, ["probe"]), ["probe"], "unit_a", "unit_b", "sim").collect()
    want = {(r.unit_a, r.unit_b, r.sim >= pairing.MATCHED) for r in every}
    assert {(r.unit_a, r.unit_b, r.matched) for r in pairing.pair_units(a, b, ["probe"], rest=True).collect()} == want
    assert {(r.unit_a, r.unit_b, r.matched) for r in pairing.pair_units(a, b, ["probe"]).collect()} == {w for w in want if w[2]}
    assert pairing.pair_units(a, b.limit(0), ["probe"]).count() == 0


def test_similarity_plan_has_no_join_on_the_keys_alone(spark):
    a = spark.createDataFrame(probe_units(6), UNITS)
    plan = neighbours.similar_pairs(a, a, ["probe"], 0.6)._jdf.queryExecution().optimizedPlan().toString()
    joins_on = [line for line in plan.split("\n") if "Join Inner" in line]
    assert len(joins_on) == 3 and all("_part" in x or "unit_" in x for x in joins_on)


@pytest.mark.parametrize("k", [1, 3, 7])
def test_nearest_places_against_brute_force(spark, k):
    rng = random.Random(k)
    rows = [(0, i, rng.random() * 10, rng.random() * 3) for i in range(80)]
    rows += [(0, 100 + i, 1000.0 * i, -50.0) for i in range(3)]  # far from all others
    rows += [(1, i, float(i // 3), 0.0) for i in range(30)]  # on a line, with ties and equal places
    rows += [(2, i, 5.0, 5.0) for i in range(4)] + [(3, 1, 0.0, 0.0)]  # one place, one channel
    got = sorted(tuple(r) for r in neighbours.nearest(spark.createDataFrame(rows, "p int, c long, x double, y double"), ["p"], "c", k).collect())
    want = []
    for p, c, x, y in rows:
        near = sorted((math.dist((x, y), (v, w)), d) for q, d, v, w in rows if q == p and d != c)[:k]
        want += [(p, c, d, dist, i) for i, (dist, d) in enumerate(near, 1)]
    assert got == [pytest.approx(w) for w in sorted(want)]


def test_nearest_joins_cells_only(spark):
    rows = spark.range(3000).select(F.lit(0).alias("p"), F.col("id").alias("c"), (F.col("id") % 60).alias("x"), (F.col("id") / 60).cast("long").alias("y"))
    found = neighbours.nearest(rows, ["p"], "c", 4)
    assert found.count() == 12000 and found.agg(F.max("d")).first()[0] <= 2


def matches(a, b, tolerance):
    """Plain: the earliest a first, each to the nearest unused b."""
    free, hits = sorted(b), 0
    for x in sorted(a):
        near = min((y for y in free if abs(y - x) <= tolerance), key=lambda y: (abs(y - x), y), default=None)
        if near is not None:
            free.remove(near)
            hits += 1
    return hits


@pytest.mark.parametrize("width", [None, 400])
def test_dense_trains_over_many_buckets(spark, width):
    rng = random.Random(width or 0)
    trains = {k: ([rng.randrange(-300, 1500) for _ in range(rng.randint(1, 400))], [rng.randrange(-300, 1500) for _ in range(rng.randint(1, 400))]) for k in range(12)}
    trains[90] = ([7 * i for i in range(300)], [7 * i + 6 for i in range(300)])  # one choice decides all later ones
    trains[91] = ([5] * 20, [5] * 12 + [18] * 3)
    trains[92], trains[93] = ([1], []), ([], [2])
    a, b = (spark.createDataFrame([(k, t) for k, v in trains.items() for t in v[i]], "k int, t long") for i in (0, 1))
    got = {r.k: r.tp for r in matching.spike_matches(a, b, ["k"], 15, width).collect()}
    assert got == {k: matches(*v, 15) for k, v in trains.items()}


def test_a_dense_train_is_cut_into_bounded_buckets(spark):
    a = spark.range(40_000).select(F.lit(1).alias("k"), (F.col("id") * 10).alias("t"))
    b = spark.range(40_000).select(F.lit(1).alias("k"), (F.col("id") * 10 + 4).alias("t"))
    most = matching.bucketed(a, b, ["k"], 30, 64 * 30).agg(F.max(F.size("xs")), F.max(F.size("ys")), F.count("*")).first()
    assert most[0] <= 192 and most[1] <= 200 and most[2] > 200
    assert matching.spike_matches(a, b, ["k"], 30).first().tp == 40_000


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ranks_over_partitions(spark, keys):
    rng = random.Random(3)
    rows = [(i % 3, float(rng.randrange(40))) for i in range(500)] + [(1, None), (9, 2.5), (2, float("-inf"))]
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    got = ranks.with_average_rank(df, "v", keys, "r")
    want = df.withColumn("r", F.when(F.col("v").isNotNull(), stats.average_rank("v", [*keys, F.col("v").isNull()])))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_sums_before(spark):
    for n in (1, 2, 7, 64):
        rows = [(k, i, i * i + k) for k in (0, 1) for i in range(0, n, 1 + k)]
        got = {(r.k, r.at): r.before for r in ranks.sums_before(spark.createDataFrame(rows, "k int, at int, v long"), ["k"], "at", "v", max(1, (n - 1).bit_length())).collect()}
        assert got == {(k, i): sum(v for q, j, v in rows if q == k and j < i) for k, i, _ in rows}


@pytest.mark.parametrize("width", [1, 7, 1000, joins.BUCKET])
def test_anchors_are_carried_over_buckets(spark, width):
    rng = random.Random(width)
    points = [(rng.choice(["a", "b", None, "z"]), i, rng.randrange(-100, 300)) for i in range(300)]
    anchors = [(rng.choice(["a", "b", None]), rng.randrange(-50, 200), f"n{rng.randrange(99):02}" if rng.random() < 0.9 else None) for _ in range(40)]
    got = joins.anchor_before(spark.createDataFrame(points, "s string, id int, t long"), spark.createDataFrame(anchors, "s string, at long, name string"), ["s"], "t", "name", "at", width)
    want = {i: max(((at, n) for q, at, n in anchors if q == s and at <= t and n is not None), default=(0, None))[1] for s, i, t in points}
    assert {r.id: r.name for r in got.collect()} == want


def test_no_window_orders_a_whole_session(spark):
    df = spark.createDataFrame([("s", 1)], "s string, t long")
    plan = joins.anchor_before(df, df.select("s", F.col("t").alias("at"), F.col("t").alias("n")), ["s"], "t", "n", "at")._jdf.queryExecution().optimizedPlan().toString()
    by = [re.search(r"\], \[([^\]]*)\], \[[^\]]*\]$", line)[1] for line in plan.split("\n") if "Window [" in line]
    # the rows by session and bucket; by session one row for each bucket
    assert sorted("_bucket" in b for b in by) == [False, True]


@pytest.mark.parametrize("tile", [3, 128])
def test_matrix_by_tiles(spark, tile):
    rng = random.Random(4)
    rows = [(g, f"s{s}", u, rng.gauss(0, 1)) for g in (0, 1) for s in range(11) for u in range(17) if rng.random() < 0.8] + [(0, "flat", u, 1.0) for u in range(17)] + [(1, "alone", 99, 1.0), (1, "alone", 98, 2.0)]
    got = {(r.g, r.stim_a, r.stim_b): r.r for r in population.rsm(spark.createDataFrame(rows, "g int, stim string, unit int, value double"), ["g"], tile).collect()}
    z = {}
    for g in (0, 1):
        for s in {r[1] for r in rows if r[0] == g} - {"flat"}:
            v = {u: x for q, n, u, x in rows if (q, n) == (g, s)}
            m = np.mean(list(v.values()))
            size = math.sqrt(sum((x - m) ** 2 for x in v.values()))
            z[g, s] = {u: (x - m) / size for u, x in v.items()}
    want = {(g, s, t): sum(x * w[u] for u, x in v.items() if u in w) for ((g, s), v), ((h, t), w) in product(z.items(), z.items()) if g == h and s > t and v.keys() & w.keys()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_a_run_numbers_its_events_once(spark, monkeypatch):
    """run_events reads the numbered events and the changes of their code back; neither is made anew for each table that uses it."""
    from anchorline.plans import audits

    made = []
    table = audits.runs.stimulus_table
    monkeypatch.setattr(audits.runs, "stimulus_table", lambda codes, behaviour, *rest: made.extend((codes, behaviour)) or table(codes, behaviour, *rest))
    audits.run_events(spark, "/root/testdata/sf0.001")
    assert len(made) == 2 and not any("Window" in x._jdf.queryExecution().optimizedPlan().toString() for x in made)
