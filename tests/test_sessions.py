"""Behaviour tables, several sessions, and the checks between stages: literal cases."""

import pytest
from pyspark.sql import functions as F

from anchorline.operators import audit, clocks, projections, raster, sessions
from anchorline.sources import recordings

MS = 1000


def test_rates_count_the_trials_of_their_own_session(spark):
    spikes = spark.createDataFrame([(s, "p", u, 1_100_000) for s, u in (("a", 1), ("b", 2))] + [("a", "p", 3, 99_000_000)], "session string, probe string, unit_id long, t_us long")
    onsets = spark.createDataFrame([("a", 1, 1_000_000, 0), ("b", 2, 1_000_000, 0), ("b", 3, 50_000_000, 0)], "session string, trial_id long, t_us long, stim_index long")
    cells = raster.raster(spikes, onsets, 0, 1_000_000, 1_000_000)
    trials = raster.trial_counts(onsets)
    assert {r.unit_id: r.rate_hz for r in raster.psth(cells, trials, 1.0).collect()} == {1: 1.0, 2: 0.5}
    counts = raster.window_counts(cells, 0, 1)
    stats = {r.unit_id: (r.n_spikes, r.mean_count) for r in raster.unit_stats(counts, trials, spikes).collect()}
    assert stats == {1: (1, 1.0), 2: (1, 0.5), 3: (0, 0.0)}
    assert {r.unit_id: r.rate_hz for r in raster.stim_rates(counts, onsets, 1.0, spikes).collect()} == {1: 1.0, 2: 0.5, 3: 0.0}
    scores = {r.unit_id: (r.responsive, r.score) for r in raster.score_units(spikes, onsets, 50 * MS, 300 * MS, 10 * MS).collect()}
    assert scores[3] == (False, None) and set(scores) == {1, 2, 3}


def test_cells_are_read_once(spark):
    spikes = spark.createDataFrame([("a", "p", 1, 1_100_000)], "session string, probe string, unit_id long, t_us long")
    onsets = spark.createDataFrame([("a", 1, 1_000_000)], "session string, trial_id long, t_us long")
    cells = raster.raster(spikes, onsets, 50 * MS, 300 * MS, 10 * MS, None)
    trials = raster.trial_counts(onsets)
    for found in (raster.consistency(cells, trials, 35, 5), raster.responsiveness(cells, trials, 5)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("_bucket") and plan.count("Generate explode(sequence(") == 1


def test_shifted_fits_are_not_used(spark):
    rows = [("s", "nidq", float(t)) for t in range(9)] + [("s", "imec0", float(t)) for t in range(5)] + [("s", "imec1", t + 1.0) for t in (0, 1, 2, 4, 5, 6, 7, 8)]
    fits = {r.stream: r for r in clocks.clock_fits(spark.createDataFrame(rows, "session string, stream string, t double"), "nidq", 1.5, 5.0).collect()}
    assert (fits["imec0"].status, fits["imec0"].a, fits["imec0"].b) == ("counts_differ", None, None)
    assert (fits["imec1"].status, fits["imec1"].n_repaired) == ("ok", 1) and abs(fits["imec1"].b + 1) < 1e-9


def test_manifest_in_two_vaults(spark):
    wanted = spark.createDataFrame([("x.tsv",), ("y.tsv",)], "name string")
    found = spark.createDataFrame([("/a/v1/x.tsv", 1), ("/a/v2/x.tsv", 1), ("/a/v10/y.tsv", 1)], "path string, length long")
    got = {r.name: (r.path, r.source) for r in recordings.resolved(wanted, found, ["/a/v1", "/a/v2"]).collect()}
    assert got == {"x.tsv": ("/a/v1/x.tsv", "vault:/a/v1(multi)"), "y.tsv": (None, "vault_miss")}


def test_nidq_pairs(spark):
    found = spark.createDataFrame([("/r/a.nidq.bin", 4), ("/r/a.nidq.meta", 4), ("/r/b.nidq.bin", 4), ("/r/a.imec0.ap.bin", 4)], "path string, length long")
    assert {r.stem: r.status for r in recordings.pairs_of(found).collect()} == {"/r/a.nidq": "ok", "/r/b.nidq": "meta_missing"}


def test_behavior_events(spark):
    trials = spark.createDataFrame([("s", 1, True), ("s", 2, None)], "session string, trial_id long, trial_valid boolean")
    onsets = spark.createDataFrame([("s", 1, 3.0, 12.5, 0)], "session string, trial_id long, onset_s double, latency_ms double, flag int")
    fits = spark.createDataFrame([("s", "imec0", 2.0, 1.0), ("s", "imec1", None, None)], "session string, stream string, a double, b double")
    [r] = sessions.behavior_events(trials, onsets, fits, spark.createDataFrame([("s", "set")], "session string, dataset_name string")).collect()
    assert (r.trial_id, r.onset_by_probe, r.dataset_name, r.latency_ms) == (1, '{"imec0":1.0}', "set", 12.5)
    [r] = sessions.behavior_events(trials, onsets, fits.limit(0), spark.createDataFrame([], "session string, dataset_name string")).collect()
    assert (r.onset_by_probe, r.dataset_name) == ("{}", None)


def test_units_need_their_columns(spark):
    with pytest.raises(ValueError):
        sessions.unit_problems(spark.createDataFrame([(1,)], "unit_id long"))
    with pytest.raises(ValueError):
        sessions.probe_key(spark.createDataFrame([(1,)], "unit_id long"))
    rows = spark.createDataFrame([("a", [1.0]), ("a", []), ("b", []), ("c", None), (None, [1.0])], "probe_id string, spike_times array<double>")
    assert {r.probe_id: r.problem for r in sessions.unit_problems(rows).collect()} == {"b": "no_spikes", "c": "no_spikes", None: "no_probe"}


def test_channels(spark):
    bad = spark.createDataFrame([("p", 2)], "probe string, channel long")
    assert sessions.without_channels(spark.createDataFrame([("p", 1), ("p", 2), ("q", 2)], "probe string, channel long"), bad).count() == 2
    windows = spark.createDataFrame([("p", c, i, v) for c, vs in enumerate(([0.0, 1.0, 2.0], [1.0, 1.0, 1.0], [0.0, 2.0, 4.0], [5.0, 3.0, 0.0])) for i, v in enumerate(vs)], "probe string, channel long, i int, v double")
    got = {r.channel: r.status for r in sessions.unlike_neighbours(windows, windows.select("probe", "channel").distinct()).collect()}
    assert got[1] == "dead" and got[3] == "noisy"


def test_stimuli_out_of_range_raise(spark):
    manifest = spark.createDataFrame([(1, "a"), (3, "c")], "stim_index long, stim_name string")
    onsets = lambda *x: spark.createDataFrame([(i,) for i in x], "stim_index long")
    assert {r.stim_index: r.stim_name for r in sessions.named_stims(onsets(0, 1, 2, 3), manifest).collect()} == {0: "", 1: "a", 2: "", 3: "c"}
    for wrong in (-1, 4):
        with pytest.raises(Exception, match="out of range"):
            sessions.named_stims(onsets(wrong), manifest).collect()


def test_gates(spark):
    given = spark.createDataFrame([("a", True), ("b", True), ("c", None), ("d", True)], "session string, readable boolean")
    streams = spark.createDataFrame([("a", 1, True, 2), ("b", 1, None, 2), ("d", 1, True, 0)], "session string, stream long, verified boolean, files long")
    assert {r.session: r.reason for r in sessions.safe_to_delete(given, streams).collect()} == {"a": "", "b": "unverified", "c": "unreadable", "d": "no_files"}
    limits = spark.createDataFrame([("x", 0.5), ("y", 1.5), ("z", None), ("n", float("nan"))], "name string, value double")
    assert {r.name for r in sessions.out_of_range(limits).collect()} == {"y", "z", "n"}


def test_a_sliced_run_without_spikes_raises(spark):
    rows = spark.createDataFrame([(1, 30)], "unit_id long, sample long")
    assert projections.moved_in_time(rows, 2.0, 10.0).first().t == 5.0
    with pytest.raises(Exception, match="no units were found"):
        projections.moved_in_time(rows.where("sample < 0"), 2.0, 10.0).collect()


def test_a_manifest_without_names_has_no_index(spark):
    onsets = spark.createDataFrame([(1, 1)], "trial_id long, stim_index long")
    none = spark.createDataFrame([], "stim_index long, stim_name string")
    with pytest.raises(Exception, match="out of range"):
        sessions.named_stims(onsets, none).collect()
    assert sessions.named_stims(onsets.withColumn("stim_index", F.lit(0).cast("long")), none).first().stim_name == ""


def test_repeated_labels_give_one_unit(spark):
    spikes = spark.createDataFrame([("s", "p", 1, 5)], "session string, probe string, unit_id long, t long")
    labels = spark.createDataFrame([("s", "p", 1, "mua"), ("s", "p", 1, "good"), ("s", "p", 2, "mua")], "session string, probe string, unit_id long, label string")
    assert sorted((r.unit_id, r.n_spikes, r.label, r.status) for r in sessions.imported_sorting(spikes, labels).collect()) == [(1, 1, "good", "pass"), (2, 0, "mua", "warn")]


def test_missing_ranges(spark):
    expected = spark.createDataFrame([("whole", 300), ("short", 300), ("holed", 300), ("missing", 70), ("late", 300), ("long", 100)], "stream string, n_samples long")
    chunks = [("whole", 200, 100), ("whole", 0, 150), ("whole", 100, 100), ("short", 0, 120), ("holed", 0, 50), ("holed", 60, 20), ("holed", 70, 230), ("late", 500, 10), ("long", 0, 400), ("other", 0, 9), ("missing", 5, 0)]
    got = sorted(tuple(r) for r in audit.missing_ranges(expected, spark.createDataFrame(chunks, "stream string, start long, n long")).collect())
    assert got == [("holed", 50, 60, "hole"), ("late", 0, 300, "hole"), ("missing", 0, 70, "missing"), ("short", 120, 300, "short")]


def test_audits_of_ragged_tables(spark):
    one = spark.createDataFrame([("a", 1.5, None), ("b", 2.5, "x")], "session string, t double, note string")
    two = spark.createDataFrame([("a", 7)], "session string, code long")
    rows = audit.audit_rows({"stimulus": one, "event": two})
    got = sorted(tuple(r) for r in rows.select("session", "kind", audit.audited("t", "double"), audit.audited("note", "string"), audit.audited("code", "long")).collect())
    assert got == [("a", "event", None, None, 7), ("a", "stimulus", 1.5, None, None), ("b", "stimulus", 2.5, "x", None)]


def test_probe_times_and_bounds(spark):
    rows = spark.createDataFrame([('{"imec0": 1.5}',), ('{"imec1": 2}',), (None,)], "j string")
    assert [r.t for r in audit.probe_times(rows, "j", "imec0").collect()] == [1.5, None, None]
    with pytest.raises(Exception, match="no time of imec0"):
        audit.probe_times(rows, "j", "imec0", "error").collect()
    ddl = "layer string, metric string, op string, bound double"
    merged = audit.merged_bounds(spark.createDataFrame([("mua", "snr", "greater", 5.0), ("mua", "snr", "less", 9.0), ("noise", "n", "less", 1.0)], ddl), spark.createDataFrame([("mua", "snr", "greater", 4.0), ("noise", "n", "less", None), ("mua", "drift", "less", 2.0)], ddl))
    assert sorted(tuple(r) for r in merged.collect()) == [("mua", "drift", "less", 2.0), ("mua", "snr", "greater", 4.0), ("mua", "snr", "less", 9.0)]


def test_export_windows_come_from_the_first_valid_trial(spark):
    spikes = spark.createDataFrame([("a", p, 1, t * MS) for p in ("p", "q") for t in (949, 950, 999, 1000, 1029, 1030, 2010)], "session string, probe string, unit_id long, t_us long")
    rows = [("a", 1, None, {"p": 1000 * MS}, 900 * MS, 900 * MS), ("a", 2, True, {"p": 1000 * MS}, 20 * MS + 999, 10 * MS), ("a", 3, True, {"p": None, "q": 2000 * MS}, 500 * MS, 500 * MS), ("a", 4, False, {"p": 2000 * MS}, 1, 1), ("b", 5, True, {"p": 1000 * MS}, None, 1)]
    trials = spark.createDataFrame(rows, "session string, trial_id long, valid boolean, onsets map<string, long>, onset_us long, offset_us long")
    found = sorted((r.probe, r.trial_id, r.bin, r.n) for r in raster.probe_rasters(spikes, trials, 50 * MS, MS).collect())
    assert found == [("p", 2, b, 1) for b in (0, 49, 50, 79)] + [("q", 3, 60, 1)]
    assert raster.probe_rasters(spikes, trials.where("trial_id = 4"), 50 * MS, MS).count() == 0
    both = spikes.unionByName(spikes).where("probe = 'q' AND t_us = 2010000")
    assert [r.n for r in raster.probe_rasters(both, trials, 50 * MS, MS, 1).collect()] == [1]


def test_missing_validity_counts_as_told(spark):
    trials = spark.createDataFrame([(1, True), (2, False), (3, None)], "trial_id long, valid boolean")
    ids = lambda df: sorted(r.trial_id for r in df.collect())
    assert ids(raster.valid_trials(trials)) == [1] and ids(raster.valid_trials(trials, missing=True)) == [1, 3]
    assert ids(raster.valid_trials(trials.drop("valid"))) == [] and ids(raster.valid_trials(trials.drop("valid"), missing=True)) == [1, 2, 3]


def test_logged_trials_keep_their_schema(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"session": "a", "trial_id": 1, "events": [{"code": "5", "time": 0.5}], "analog": {"eye": [1, 2.5]}, "more": 7}\n{"trial_id": 2}\n')
    rows = {r.trial_id: r for r in recordings.behaviour_trials(spark, str(tmp_path)).collect()}
    assert rows[1].events[0].time == 0.5 and rows[1].analog == {"eye": [1.0, 2.5]} and rows[1].valid is None
    assert rows[2].events is None and rows[2].session is None
    (tmp_path / "u.json").write_text('{"session": "a"}\n')
    with pytest.raises(Exception, match="no trial_id"):
        recordings.behaviour_trials(spark, str(tmp_path)).collect()
    (tmp_path / "u.json").write_text('{"trial_id": "x"\n')
    with pytest.raises(Exception):
        recordings.behaviour_trials(spark, str(tmp_path)).collect()


def test_probes_without_units_warn(spark):
    probes = spark.createDataFrame([("p",), ("q",), ("q",)], "probe_id string")
    units = spark.createDataFrame([("p", 1), ("p", 2), ("r", 3)], "probe_id string, unit_id long")
    assert sorted(tuple(r) for r in sessions.units_per_probe(probes, units).collect()) == [("p", 2, "pass"), ("q", 0, "warn")]
