"""Literal cases with known answers, brute-force twins, and plans."""

import random

import pytest
from pyspark.sql import functions as F

from anchorline.functions import stats
from anchorline.operators import clocks, curation, joins, pairing, raster, signal, trials
from anchorline.plans import fixtures, registry

MS = 1000


def spikes(spark, times, unit=1):
    return spark.createDataFrame([("s", "p", unit, int(t)) for t in times], "session string, probe string, unit_id long, t_us long")


def onsets(spark, times):
    return spark.createDataFrame([("s", i, int(t)) for i, t in enumerate(times)], "session string, trial_id long, t_us long")


def test_one_spike_lands_in_its_bin(spark):
    [cell] = raster.raster(spikes(spark, [1_100_000]), onsets(spark, [1_000_000]), 50 * MS, 300 * MS, MS).collect()
    assert (cell.bin, cell.n) == (150, 1)


def test_equal_spikes_saturate(spark):
    [cell] = raster.raster(spikes(spark, [1_100_000] * 300), onsets(spark, [1_000_000]), 50 * MS, 300 * MS, MS).collect()
    assert cell.n == 255


def test_window_is_half_open(spark):
    cells = raster.raster(spikes(spark, [950_000, 949_999, 1_300_000, 1_299_999]), onsets(spark, [1_000_000]), 50 * MS, 300 * MS, MS).collect()
    assert sorted(c.bin for c in cells) == [0, 349]


def test_range_join_shifts_and_negative_times(spark):
    rng = random.Random(1)
    points, anchors = [rng.randrange(-5000, 5000) for _ in range(300)], [rng.randrange(-5000, 5000) for _ in range(40)]
    for shift in (0, -777, 10**12):
        a = spark.createDataFrame([("k", t + shift) for t in points], "k string, t long")
        b = spark.createDataFrame([("k", t + shift - 100, t + shift + 250) for t in anchors], "k string, low long, high long")
        n = joins.bucketed_range_join(a, b, ["k"], "t", "low", "high", 350).count()
        assert n == sum(y - 100 <= x < y + 250 for x in points for y in anchors)


def score(spark, times, starts):
    cells = raster.raster(spikes(spark, times), onsets(spark, starts), 50 * MS, 300 * MS, 10 * MS, most=None)
    rows = raster.consistency(cells, raster.trial_counts(onsets(spark, starts)), 35, 5).collect()
    return rows[0].score if rows else None


def test_identical_trials_score_one(spark):
    starts = [i * 1_000_000 for i in range(1, 11)]
    assert abs(score(spark, [t + 95 * MS for t in starts], starts) - 1) < 1e-9


def test_scores_that_are_null(spark):
    starts = [i * 1_000_000 for i in range(1, 11)]
    assert score(spark, [t + 95 * MS for t in starts[:3]], starts[:3]) is None
    assert score(spark, [t - 20 * MS for t in starts], starts) is None


def test_alternating_trials_score_low(spark):
    starts = [i * 1_000_000 for i in range(1, 11)]
    assert score(spark, [t + (100 if i % 2 else 250) * MS for i, t in enumerate(starts)], starts) < 0.6


def pulses(spark, a, b):
    return spark.createDataFrame([("s", "nidq", float(t)) for t in a] + [("s", "imec0", float(t)) for t in b], "session string, stream string, t double")


@pytest.mark.parametrize("change,a,b", [(lambda t: t, 1, 0), (lambda t: t - 0.5, 1, 0.5), (lambda t: t / 1.01, 1.01, 0)])
def test_clock_fits(spark, change, a, b):
    base = list(range(20))
    [r] = clocks.clock_fits(pulses(spark, base, [change(t) for t in base]), "nidq", 1.5, 0.5).collect()
    assert abs(r.a - a) < 1e-9 and abs(r.b - b) < 1e-9 and r.residual_ms < 1e-6 and r.status == "ok"


def test_missing_pulses_are_put_back(spark):
    base = list(range(20))
    [r] = clocks.clock_fits(pulses(spark, base, [t for t in base if t not in (7, 8, 12)]), "nidq", 1.5, 0.5).collect()
    assert (r.n_repaired, r.status) == (3, "ok") and abs(r.a - 1) < 1e-9


def test_strict_fit_raises(spark):
    with pytest.raises(Exception, match="counts_differ"):
        clocks.clock_fits(pulses(spark, range(9), range(5)), "nidq", 1.5, 0.5, strict=True).collect()


def test_edges_over_chunk_bounds(spark):
    rng = random.Random(4)
    words = [rng.randrange(16) for _ in range(230)]
    chunks = spark.createDataFrame([("s", i, words[i : i + 17]) for i in range(0, 230, 17)], "session string, start_sample long, data array<int>")
    got = sorted(r.sample for r in trials.rising_edges(chunks, 2).collect())
    assert got == [i for i in range(1, 230) if words[i] >> 2 & 1 and not words[i - 1] >> 2 & 1]
    codes = sorted((r.sample, r.value) for r in trials.code_changes(chunks, (3, 0)).collect())
    code = [(w >> 3 & 1) | (w & 1) << 1 for w in words]
    assert codes == [(i, code[i]) for i in range(1, 230) if code[i] != code[i - 1]]


def step_signal(falling=False, at=120):
    return [(1000 if (i % 1000 >= at) != falling else 0) for i in range(5000)]


def calibrate(spark, data, centres):
    chunks = spark.createDataFrame([("s", i, i * 500, data[i * 500 : i * 500 + 500]) for i in range(len(data) // 500)], "session string, chunk_id long, start_sample long, data array<int>").withColumn("data", F.transform("data", lambda v: signal.volts(v.cast("double"), 5.0)))
    rows = spark.createDataFrame([("s", i, c) for i, c in enumerate(centres)], "session string, trial_id int, centre int")
    return {r.trial_id: r for r in signal.calibrated(chunks, rows, ["session"], 50, 100, (60, 80), 500, 1.0).collect()}


@pytest.mark.parametrize("falling", [False, True])
def test_step_after_the_trigger(spark, falling):
    out = calibrate(spark, step_signal(falling), [1100, 2100, 3100, None, 20, 4990])
    assert [out[i].flag for i in range(6)] == [0, 0, 0, 2, 2, 2]
    assert [out[i].latency_ms for i in range(3)] == [20.0, 20.0, 20.0]


def test_dead_signal(spark):
    assert all(r.dead and r.flag == 3 for r in calibrate(spark, [5] * 5000, [1100, 2100]).values())


def brute_matches(a, b, tolerance):
    free, hits = sorted(b), 0
    for x in sorted(a):
        near = min(free, key=lambda y: (abs(y - x), y), default=None)
        if near is not None and abs(near - x) <= tolerance:
            free.remove(near)
            hits += 1
    return hits


def test_spike_matches_against_brute_force(spark):
    rng = random.Random(8)
    trains = {k: ([rng.randrange(2000) for _ in range(rng.randint(1, 60))], [rng.randrange(2000) for _ in range(rng.randint(1, 60))]) for k in range(40)}
    a, b = (spark.createDataFrame([(k, t) for k, v in trains.items() for t in v[i]], "k int, t long") for i in (0, 1))
    got = {r.k: r.tp for r in pairing.spike_matches(a, b, ["k"], 15).collect()}
    assert got == {k: brute_matches(*v, 15) for k, v in trains.items()}


def test_mutual_best_is_greedy_by_similarity(spark):
    rng = random.Random(2)
    sims = [(0, i, j, rng.random()) for i in range(12) for j in range(15)]
    found = {(r.a, r.b) for r in joins.mutual_best(spark.createDataFrame(sims, "k int, a int, b int, s double"), ["k"], "a", "b", "s").collect()}
    want, left, right = set(), set(), set()
    for _, i, j, s in sorted(sims, key=lambda x: -x[3]):
        if i not in left and j not in right:
            want.add((i, j))
            left.add(i)
            right.add(j)
    assert found == want


def test_mutual_best_pairs_all_copies_and_ties(spark):
    rng = random.Random(4)
    sims = [(0, i, 100 + j, 1.0) for i in range(60) for j in range(60)]
    sims += [(1, i, j, float(rng.randrange(3))) for i in range(14) for j in range(11) if rng.random() < 0.7]
    found = {(r.k, r.a, r.b) for r in joins.mutual_best(spark.createDataFrame(sims, "k int, a int, b int, s double"), ["k"], "a", "b", "s").collect()}
    want, left, right = set(), set(), set()
    for k, i, j, _ in sorted(sims, key=lambda x: (x[0], -x[3], x[1], x[2])):
        if (k, i) not in left and (k, j) not in right:
            want.add((k, i, j))
            left.add((k, i))
            right.add((k, j))
    assert found == want and sum(k == 0 for k, _, _ in found) == 60


def test_updates(spark):
    units = spark.createDataFrame([(1, "SUA", True), (2, "MUA", True)], "unit_id long, unittype string, is_visual boolean")
    updates = spark.createDataFrame([(1, "MUA", False, None), (2, "MUA", None, False), (99, "SUA", None, None)], "unit_id long, unittype string, is_visual boolean, keep boolean")
    assert [tuple(r) for r in joins.update_join(units, updates, "unit_id", flags=("is_visual",)).collect()] == [(1, "MUA", False)]
    assert [r.unit_id for r in joins.unknown_updates(units, updates, "unit_id").collect()] == [99]


def test_exact_rank_sum_for_few_trials(spark):
    rows = spark.createDataFrame([(1, v, int(v < 8), int(v >= 8), 8) for v in range(16)], "k int, v long, b int, r int, trials int")
    assert stats.rank_sum(rows, ["k"], "v", "b", "r", "trials").first().responsive
    few = spark.createDataFrame([(1, v, int(v < 6), int(v >= 6), 6) for v in range(12)], "k int, v long, b int, r int, trials int")
    assert not stats.rank_sum(few, ["k"], "v", "b", "r", "trials").first().responsive


def test_labels_and_booleans(spark):
    from anchorline.sources import recordings

    df = spark.createDataFrame([("Good", "[1.5, -2]", " Yes "), ("other", "[ 3  4e1 ]", "")], "l string, v string, b string")
    assert [r[0] for r in df.select(curation.mapped(F.col("l"), curation.LABELS, "NOISE")).collect()] == ["SUA", "NOISE"]
    assert [r[0] for r in df.select(recordings.vector(F.col("v"))).collect()] == [[1.5, -2.0], [3.0, 40.0]]
    assert [r[0] for r in df.select(recordings.tolerant_boolean(F.col("b"))).collect()] == [True, None]
    with pytest.raises(Exception, match="not a boolean"):
        df.select(recordings.tolerant_boolean(F.col("l"))).collect()


@pytest.mark.parametrize("name", ["psth", "consistency_score", "match_in_trial", "clock_fit", "calibrate"])
def test_no_nested_loops_and_no_single_partition(spark, name):
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "SinglePartition" not in plan


def test_scan_reads_only_what_is_used(spark):
    plan = fixtures.spikes(spark, "/root/testdata/sf0.001").select("t_us")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan and "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,signup))]" in plan
