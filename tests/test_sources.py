from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from anchorline.sources import commits, sinks
from anchorline.sources import recordings as r


@pytest.fixture
def recording(tmp_path):
    for probe, size in ((0, 40), (1, 80), (3, 8)):
        folder = tmp_path / f"run_imec{probe}"
        folder.mkdir()
        if probe != 3:
            (folder / f"run_g0_t0.imec{probe}.ap.bin").write_bytes(b"\0" * size)
        (folder / f"run_g0_t0.imec{probe}.ap.meta").write_text(f"# head\n\nimSampRate=30000\nfileSizeBytes=40\nnote=a=b\nfileCreateTime=2024-03-0{probe + 1}T10:11:12\nbroken\n")
    return str(tmp_path)


def test_catalog_headers_and_checks(spark, recording):
    found = r.catalog(spark, recording)
    assert [(x.probe, x.bin_bytes) for x in found.collect()] == [(0, 40), (1, 80), (3, None)]
    heads = r.headers(spark, f"{recording}/*/*.meta")
    assert {x.value for x in heads.where("key = 'note'").collect()} == {"a=b"}
    assert heads.where("key = 'broken'").isEmpty()
    wide = r.wide(heads, ["imSampRate", "fileSizeBytes", "fileCreateTime"]).withColumn("probe", F.regexp_extract("path", r"_imec(\d+)", 1).cast("int"))
    status = {(x.probe, x.check): x.status for x in r.checks(found.join(wide.drop("path"), "probe")).collect()}
    assert status[0, "size_matches"] == "pass" and status[1, "size_matches"] == "fail" and status[3, "bin_present"] == "fail"
    dates = {x.probe: x.d for x in wide.select("probe", r.recording_date(F.col("fileCreateTime")).alias("d")).collect()}
    assert dates == {0: "240301", 1: "240302", 3: "240304"}


def test_samples_source(spark, tmp_path):
    data = np.arange(3 * 1000, dtype="<i2")
    path = tmp_path / "x.bin"
    path.write_bytes(data.tobytes())
    spark.dataSource.register(r.SampleSource)
    chunks = spark.read.format("samples").options(path=str(path), channels="3", chunk="300", chunks="2").load()
    rows = sorted(chunks.collect(), key=lambda x: x.chunk_id)
    assert {x.channel for x in rows} == {-1}
    assert [(x.chunk_id, x.start_sample, x.n_samples) for x in rows] == [(0, 0, 300), (1, 300, 300), (2, 600, 300), (3, 900, 100)]
    assert sum((x.data for x in rows), []) == data.tolist()
    one = sorted(r.channel(chunks, 1, 3).collect())
    assert sum((x.data for x in one), []) == data[1::3].tolist()


def test_a_slice_reads_its_partitions_only(spark, tmp_path):
    data = np.arange(3 * 1000, dtype="<i2")
    path = tmp_path / "x.bin"
    path.write_bytes(data.tobytes())
    # 0.35 s to 0.7 s at 1000 Hz, read from a URI
    sliced = r.sample_slice(spark, path.as_uri(), 3, 1000.0, 0.35, 0.7, [2, 0], chunk="100", chunks="1")
    assert sliced.rdd.getNumPartitions() == 4
    rows = sorted(sliced.collect(), key=lambda x: (x.channel, x.start_sample))
    assert [(x.channel, x.start_sample, x.n_samples) for x in rows] == [(c, t, n) for c in (0, 2) for t, n in ((350, 50), (400, 100), (500, 100), (600, 100))]
    assert sum((x.data for x in rows[4:]), []) == data[2::3][350:700].tolist()
    assert r.sample_slice(spark, str(path), 3, 1000.0, 0.95, 9.0, [1], chunk="100").first().data == data[1::3][950:].tolist()
    assert r.sample_slice(spark, str(path), 3, 1000.0, 5.0, 9.0, [1]).count() == 0
    assert r.sample_slice(spark, str(path), 3, 1000.0, 0.0, 9.0, [7]).count() == 0
    with pytest.raises(ValueError, match="slice"):
        r.sample_slice(spark, str(path), 3, 1000.0, 2.0, 1.0, [1])


def test_manifest_and_resolution(spark, tmp_path):
    for vault in ("v1", "v2"):
        (tmp_path / vault / "a").mkdir(parents=True)
        (tmp_path / vault / "a" / "set.tsv").write_text("FileName\tx\n007.png\t1\nNA\t2\n")
    (tmp_path / "v2" / "only.tsv").write_text("FileName\nq\n")
    (tmp_path / "v2" / "a" / "only.tsv").write_text("FileName\nq\n")
    assert [tuple(x) for x in r.manifest(spark, str(tmp_path / "v1/a/set.tsv")).collect()] == [(1, "007.png"), (2, "NA")]
    names = [str(tmp_path / "v1/a/set.tsv"), "C:\\d\\set.tsv", "only.tsv", "none.tsv", ""]
    out = r.resolved(spark.createDataFrame([(n,) for n in names], "name string"), r.files(spark, str(tmp_path), "*.tsv"), [str(tmp_path / "v1"), str(tmp_path / "v2")])
    got = {x.name: x.source for x in out.collect()}
    assert got == {names[0]: "direct", names[1]: f"vault:{tmp_path}/v1(multi)", "only.tsv": f"vault:{tmp_path}/v2(multi)", "none.tsv": "vault_miss", "": "no_dataset_name"}


def test_spike_samples_round_half_to_even(spark):
    units = spark.createDataFrame([("p", 1, [0.5, 1.5, 2.25])], "probe_id string, unit_id long, spike_times array<double>")
    rates = spark.createDataFrame([("p", 1.0)], "probe_id string, rate double")
    assert sorted(x.sample for x in r.spike_samples(units, rates).collect()) == [0, 2, 2]
    with pytest.raises(Exception, match="no sampling rate"):
        r.spike_samples(units, rates.limit(0)).collect()


def test_unit_updates_file(spark, tmp_path):
    good = tmp_path / "u.csv"
    good.write_text("unit_id,keep\n1,true\n2,no\n")
    assert r.unit_updates(spark, str(good)).count() == 2
    good.write_text("unit_id,keep\n1,true\n1,no\n")
    with pytest.raises(ValueError, match="twice"):
        r.unit_updates(spark, str(good))


def test_sinks(spark, tmp_path):
    events = spark.createDataFrame([(1, None, None), (2, 200.0, False)], "trial_id long, duration_ms double, trial_valid boolean")
    onsets = spark.createDataFrame([(1, "imec0", 1.0), (1, "imec1", 1.5), (2, "imec0", 2.0)], "trial_id long, probe_id string, t_s double")
    rows = {x.trial_id: x for x in sinks.trials_table(events, onsets, ["imec0", "imec1"], "imec0").collect()}
    assert (rows[1].start_time, rows[1].stop_time, rows[1].stim_onset_imec1, rows[1].trial_valid) == (1.0, 1.15, 1.5, True)
    assert (rows[2].stop_time, rows[2].stim_onset_imec1, rows[2].trial_valid) == (2.2, None, False)
    eye = spark.createDataFrame([("s", 2, 0), ("s", 2, 1), ("s", 1, 0)], "session string, trial_id long, i long")
    assert sorted((x.trial_id, x["index"]) for x in sinks.eye_series(eye).collect()) == [(1, 0), (2, 1), (2, 2)]
    path = commits.commit_version(events, str(tmp_path / "o"))
    assert sinks.expected_rows(spark.read.parquet(path), 2).first().status == "pass"


def test_next_versions_and_reports(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "unit_id long, note string")
    new = spark.createDataFrame([(2, "B", True), (3, "C", False), (9, "x", True)], "unit_id long, note string, keep boolean")
    assert commits.versions(spark, root) == []
    assert [tuple(r) for r in sinks.write_update(rows, new, "unit_id", root).collect()] == [("v001", 3, 2, 1)]
    assert commits.versions(spark, root) == [1]
    assert sorted(tuple(r) for r in spark.read.parquet(f"{root}/version=v001").collect()) == [(1, "a"), (2, "B")]


def test_two_writers_get_two_versions(spark, tmp_path):
    root = str(tmp_path / "versions")
    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(lambda i: commits.commit_version(spark.range(i, i + 10), root), range(4)))
    assert len(set(paths)) == 4 and commits.versions(spark, root) == [1, 2, 3, 4]
    assert sorted(spark.read.parquet(p).agg(F.min("id")).first()[0] for p in paths) == [0, 1, 2, 3]
    assert spark.read.parquet(root).count() == 40


def test_a_failing_task_leaves_no_version(spark, tmp_path):
    root = str(tmp_path / "versions")
    bad = spark.range(0, 100, 1, 4).withColumn("x", F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.lit("a")))
    with pytest.raises(Exception, match="broken"):
        commits.commit_version(bad, root)
    assert commits.versions(spark, root) == [] and not [p for p in (tmp_path / "versions").iterdir() if p.is_dir()]
    assert commits.commit_version(spark.range(3), root).endswith("version=v001")
    (tmp_path / "versions" / "_claim-v002").touch()  # of a writer that died
    assert commits.commit_version(spark.range(3), root).endswith("version=v003")


def test_result_tables(spark, tmp_path):
    units = spark.createDataFrame([(1, 0.5, None), (2, None, True)], "unit_id long, score double, is_visual boolean")
    assert sorted(tuple(x) for x in spark.read.parquet(sinks.write_scores(units, str(tmp_path / "s"))).collect()) == [(1, 0.5, False), (2, None, True)]
    with pytest.raises(ValueError, match="snr"):
        sinks.write_metrics(units, str(tmp_path / "m"), ["unit_id", "snr"])
    merged = spark.createDataFrame([(1, [1, 4]), (2, [])], "unit_id long, merged_from array<long>")
    manifest = spark.createDataFrame([("/v/a.tsv", "vault:/v")], "path string, source string")
    [row] = sinks.merge_log(merged, {"least": 0.9}, manifest).collect()
    assert (row.new_id, row.merged_from, row.config, row.manifest) == (1, [1, 4], '{"least": 0.9}', "vault:/v /v/a.tsv")
    assert sinks.merge_log(merged, {}).first().manifest is None


def test_a_mode_needs_its_rows(spark):
    found = spark.createDataFrame([("s0", 3, 4), ("s1", 2, 0)], "session string, n_units long, n_trials long")
    assert r.require_mode(found, "units").count() == 2
    with pytest.raises(Exception, match="no trials in session s1"):
        r.require_mode(found, "trials").collect()


def test_a_manifest_in_many_partitions_keeps_its_order(spark, tmp_path):
    path = tmp_path / "many.tsv"
    path.write_text("FileName\tx\n" + "".join(f"img{i:05}.png\t{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = r.manifest(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(x.stim_index, x.stim_name) for x in got] == [(i + 1, f"img{i:05}.png") for i in range(5000)]
