"""Queries over sources and sinks: tables are written to the shared folder in the files' forms and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import safe_corr
from ..operators import joins
from ..operators import projections as pr
from ..operators import sessions as s
from ..operators import signal
from ..sources import recordings as r
from ..sources import sinks
from ..sources.commits import hadoop_files
from . import alignment
from . import fixtures as f
from .sessions import _units, _written, shared_path

RATE, TAPS = 30_000.0, 31
UPDATED = "CASE WHEN s_suppkey % 3 = 0 THEN 'yes' WHEN s_suppkey % 3 = 1 THEN 'F' ELSE ' 1.0 ' END"


def recording_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3, SRC-4, SRC-5: a header file for each nation's customers; nations of one region are the probes of a session."""
    sums = f.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    k = F.col("c_nationkey")
    line = lambda name, value: F.concat(F.lit(f"{name}="), value.cast("string"))
    lines = F.array(
        F.lit("# made by a recorder"), F.lit("  "), F.lit("no separator"), F.lit("note=a=b"), line(" nSavedChans ", F.lit(385)), line("imSampRate", F.lit(30000)),
        line("fileSizeBytes", F.col("n") * 23_100_000), F.when(k % 3 > 0, line("fileTimeSecs", F.col("n") * 10)).otherwise(F.lit("")),
        line("fileCreateTime", F.when(k % 5 == 0, F.lit("2024-03-01")).otherwise(F.lit("2024-03-01T10:20:30"))))
    path = _headers(sums.select("c_nationkey", F.explode(lines).alias("value")))
    found = r.wide(r.headers(spark, path), ["nSavedChans", "imSampRate", "fileSizeBytes", "fileTimeSecs", "fileCreateTime", "note"])
    seconds = r.duration_s(F.col("fileTimeSecs"), F.col("fileSizeBytes").cast("double"), F.col("nSavedChans").cast("int"), F.col("imSampRate").cast("double"))
    probes = found.select(F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("long").alias("probe"), "note", r.recording_date(F.col("fileCreateTime")).alias("recorded"), F.round(seconds, 6).alias("duration_s"))
    longest = r.session_durations(probes.withColumn("session", F.col("probe") % 4), ["session"]).select("session", F.col("duration_s").alias("session_s"), "n_probes")
    return probes.withColumn("session", F.col("probe") % 4).join(longest, "session")


def _headers(lines: DataFrame) -> str:
    path = shared_path(lines.sparkSession, "headers")
    lines.repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    return path


def _recording(lines: DataFrame) -> str:
    """Files <folder>/<name> of the rows (folder, name, value), a line each, in a new folder."""
    spark = lines.sparkSession
    made, root = shared_path(spark, "lines"), shared_path(spark, "recording")
    lines.repartition("folder", "name").sortWithinPartitions("folder", "name", "at").drop("at").write.partitionBy("folder", "name").text(made)
    parts = r.files(spark, made, "part-*").select("path", F.regexp_extract("path", "folder=([^/]*)/name=([^/]*)/", 1).alias("folder"), F.regexp_extract("path", "folder=([^/]*)/name=([^/]*)/", 2).alias("name")).collect()
    fs, path = hadoop_files(spark, root)
    for part in parts:  # one for each file of a recording
        fs.mkdirs(path(f"{root}/{part.folder}"))
        fs.rename(path(part.path), path(f"{root}/{part.folder}/{part.name}"))
    return root


def recording_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1, SRC-2, QC-1: nations as probes, some without samples or header, some whose header gives another size; regions as digital streams."""
    k = F.col("n_nationkey")
    nations, regions = f.table(spark, sf_dir, "nation"), f.table(spark, sf_dir, "region")
    at = F.posexplode("lines").alias("at", "value")
    folder, stem = F.concat(F.lit("run_imec"), k), F.concat(F.lit("run_t0.imec"), k)
    bins = nations.where(k % 4 > 0).select(folder.alias("folder"), F.concat(stem, F.lit(".ap.bin")).alias("name"), F.array(F.rpad(F.lit("x"), F.lit(10) + k.cast("int"), F.lit("x"))).alias("lines"))
    size = F.lit(11) + k + F.when(k % 3 == 0, 1).otherwise(0)
    head = F.array(F.lit("# head"), F.when(k % 7 > 0, "imSampRate=30000").otherwise("none"), F.concat(F.lit("fileSizeBytes="), size))
    metas = nations.where(k % 5 > 0).select(folder.alias("folder"), F.concat(stem, F.lit(".ap.meta")).alias("name"), head.alias("lines"))
    kinds = F.when(F.col("r_regionkey") % 3 == 0, F.array(F.lit("bin"))).when(F.col("r_regionkey") % 3 == 1, F.array(F.lit("meta"))).otherwise(F.array(F.lit("bin"), F.lit("meta")))
    nidq = regions.select(F.lit("digital").alias("folder"), F.explode(kinds).alias("kind"), F.col("r_regionkey")).select("folder", F.concat(F.lit("r"), "r_regionkey", F.lit(".nidq."), "kind").alias("name"), F.array(F.lit("x")).alias("lines"))
    root = _recording(bins.unionByName(metas).unionByName(nidq).select("folder", "name", at))
    heads = r.wide(r.headers(spark, f"{root}/*/*.ap.meta"), ["imSampRate", "fileSizeBytes"]).withColumn("probe", F.regexp_extract("path", r"_imec(\d+)", 1).cast("int")).drop("path")
    probes = r.checks(r.catalog(spark, root).join(heads, "probe", "left")).select(F.col("probe").cast("string").alias("name"), F.col("check").alias("test"), "status")
    streams = r.pairs_of(r.files(spark, root, "*.nidq.*")).select(F.regexp_extract("stem", "([^/]*)[.]nidq$", 1).alias("name"), F.lit("pair").alias("test"), "status")
    return probes.unionByName(streams)


def sample_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6, SRC-7, SIG-10: nations' names as the bytes of a recording of two channels, of which one is read from 30 s to 171.3 s."""
    names = f.table(spark, sf_dir, "nation").select(F.lit("run_imec0").alias("folder"), F.lit("run.ap.bin").alias("name"), F.col("n_nationkey").alias("at"), F.rpad(F.lit(""), 399, F.col("n_name")).alias("value"))
    root = _recording(names)
    found = r.sample_slice(spark, f"{root}/run_imec0/run.ap.bin", 2, 10.0, 30.0, 171.3, [1], chunk="128", chunks="4")
    return found.select("start_sample", F.posexplode("data").alias("i", "v")).select((F.col("start_sample") + F.col("i")).alias("sample"), F.col("v").cast("int").alias("v"))


def gated_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14: the sessions that pass the gate of the mode that needs units and trials."""
    found = dataset_summary(spark, sf_dir)
    return r.require_mode(found.where("can_score"), "trials").select("session", "n_units", "n_trials")


def manifest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-16, JN-5: nations' names as a tab-separated manifest, looked up by customers."""
    names = f.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("FileName")).coalesce(1).sortWithinPartitions("n_nationkey")
    path = shared_path(spark, "manifest")
    names.select("FileName", "n_nationkey").write.option("sep", "\t").option("header", "true").csv(path)
    onsets = f.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + 1).cast("long").alias("stim_index"))
    return onsets.join(r.manifest(spark, path), "stim_index").groupBy("stim_index", "stim_name").agg(F.count("*").alias("n"))


def resolved_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-17: brands as files in three roots, two of which are vaults."""
    brand = F.concat(F.replace("p_brand", F.lit("#"), F.lit("")), F.lit(".tsv"))
    parts = f.table(spark, sf_dir, "part")
    found = parts.where("p_size % 7 = 0").select(F.concat(F.lit("/v"), F.pmod("p_partkey", F.lit(3)).cast("string"), F.lit("/"), F.pmod("p_size", F.lit(2)).cast("string"), F.lit("/"), brand).alias("path")).distinct()
    direct = F.concat(F.lit("/v2/"), F.pmod("p_size", F.lit(2)).cast("string"), F.lit("/"), brand)
    wanted = parts.select(F.when(F.col("p_size") == 49, direct).when(F.col("p_size") == 1, " ").otherwise(F.concat(F.lit("D:\\set\\"), brand)).alias("name")).distinct()
    return r.resolved(wanted, found, ["/v0", "/v1/"])


def spike_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12: customers' spikes; the rate is that of their market segment."""
    units = _units(spark, sf_dir).where("probe_id IS NOT NULL")
    rates = units.select("probe_id").distinct().withColumn("rate", F.length("probe_id") * 1000.5)
    found = r.spike_samples(units, rates)
    return found.groupBy("probe_id", "unit_id").agg(F.count("*").alias("n"), F.sum("sample").alias("sum_sample"))


def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13, SRC-14: customers as units and orders as trials of a nation."""
    customers = f.table(spark, sf_dir, "customer")
    units = customers.where("c_nationkey % 5 > 0").select(F.col("c_nationkey").alias("session"), F.col("c_mktsegment").alias("probe_id"))
    trials = f.table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).where("c_nationkey % 4 > 0").select(F.col("c_nationkey").alias("session"))
    return r.summary(units, trials).withColumn("probes", F.array_join("probes", "+"))


def unit_update_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-18, PRJ-9: suppliers' updates from a CSV file, with booleans of several spellings."""
    rows = f.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("unit_id"), F.expr(UPDATED).alias("keep"), F.concat(F.lit("note "), "s_nationkey").alias("note"))
    found = r.unit_updates(spark, _written(rows, "updates", "csv"))
    return found.select("unit_id", r.tolerant_boolean(F.col("keep")).alias("keep"), "note")


def vector_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-10: vectors as texts with commas or with blanks, and back."""
    form = F.when(F.col("vec_id") % 2 == 0, ", ").otherwise("  ")
    rows = f.table(spark, sf_dir, "embeddings").select("vec_id", F.concat(F.lit("[ "), F.expr("array_join(transform(embedding, x -> cast(cast(x as double) as string)), CASE WHEN vec_id % 2 = 0 THEN ', ' ELSE '  ' END)"), F.lit(" ]")).alias("t"), form.alias("form"))
    back = rows.select("vec_id", r.vector(F.col("t")).alias("v"))
    return back.select("vec_id", F.size("v").cast("long").alias("n"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 5).alias("sum"))


def written_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-6: orders as trials with an onset on each probe."""
    orders = f.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    onset = lambda p, add, has: orders.where(has).select(k.alias("trial_id"), F.lit(p).alias("probe_id"), (F.col("o_totalprice") + add).cast("double").alias("t_s"))
    events = orders.select(k.alias("trial_id"), F.when(k % 3 > 0, (k % 100).cast("double")).alias("duration_ms"), F.when(k % 5 > 0, k % 2 == 0).alias("trial_valid"))
    out = sinks.trials_table(events, onset("imec0", 0, F.lit(True)).unionByName(onset("imec1", 1, k % 4 > 0)), ["imec0", "imec1"], "imec0")
    back = spark.read.parquet(_written(out, "trials"))
    return back.select("trial_id", "trial_valid", *(F.round(c, 5).alias(c) for c in ("stim_onset_imec0", "stim_onset_imec1", "start_time", "stop_time")))


def written_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-7: units with nested spike times and templates of one width, a folder for each session and probe (SK-5)."""
    spikes = f.spikes(spark, sf_dir)
    keys = ["session", "probe", "unit_id"]
    metrics = spikes.groupBy(*keys).agg(F.avg("amplitude").alias("amplitude")).withColumn("template", sinks.padded(F.array("amplitude"), 3))
    path = shared_path(spark, "units")
    sinks.write_sessions(sinks.units_table(spikes.where("amplitude > 0"), metrics, keys), path)
    times = F.col("spike_times_us")
    return spark.read.parquet(path).select(*keys, F.size(times).cast("long").alias("n"), F.get(times, F.lit(0)).alias("first_us"), F.get(times, F.size(times) - 1).alias("last_us"), F.size("template").cast("long").alias("width"))


def written_eye(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-10, ST-5: a vector is a trial's block of eye samples; trials of a label follow each other."""
    eye = f.table(spark, sf_dir, "embeddings").select(F.col("label").alias("session"), F.col("vec_id").alias("trial_id"), F.posexplode("embedding").alias("i", "x"))
    back = spark.read.parquet(_written(sinks.eye_series(eye, 4.0), "eye"))
    return back.groupBy("session", "trial_id").agg(F.min("index").alias("first"), F.max("index").alias("last"), F.max("rate").alias("rate"))


def sync_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-1, AG-46: the fits of a session as JSON text, written and read back."""
    onsets = f.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("session"))
    back = spark.read.parquet(_written(sinks.sync_audit(alignment._fits(spark, sf_dir), onsets), "sync"))
    rows = F.from_json("fits", "array<struct<stream string, status string>>")
    return back.select("session", "n_trials", F.array_join(F.transform(rows, lambda x: F.concat(x["stream"], F.lit(":"), x["status"])), ",").alias("fits"))


def versioned_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-12, SK-8, QC-8: two rounds of updates written one after another, with their report rows."""
    root = shared_path(spark, "versions")
    rows = f.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("unit_id"), F.col("s_nationkey").cast("long").alias("score"))
    updates = lambda step: rows.where(F.col("unit_id") % step == 0).select((F.col("unit_id") + F.when(F.col("unit_id") % 10 == 0, 1_000_000_000).otherwise(0)).alias("unit_id"), (F.col("score") + 1).alias("score"), (F.col("score") > 5).alias("keep"))
    return sinks.write_update(rows, updates(2), "unit_id", root).unionByName(sinks.write_update(rows, updates(3), "unit_id", root))


def moved_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-19, PRJ-2: lines as spikes of a sliced run, put back into the whole recording, with the quantity as a raw sample."""
    rows = f.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("unit_id"), F.col("l_orderkey").alias("sample"), signal.volts(F.col("l_quantity").cast("double"), 5.0).alias("v"))
    return pr.moved_in_time(rows, 120.0, RATE).groupBy("unit_id").agg(F.count("*").alias("n"), F.round(F.sum("t"), 4).alias("sum_t"), F.round(F.sum("v") * 1000, 6).alias("sum_mv"))


def band_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIG-2: 300 to 6000 Hz over the vectors of a label as chunks of one channel."""
    rows = f.table(spark, sf_dir, "embeddings")
    order = F.struct("label", "vec_id")
    chunks = joins.ordinal(rows.select(order.alias("o"), F.col("label").alias("channel"), F.col("embedding").alias("data")), ["channel"], ["o"])
    chunks = chunks.select("channel", (F.col("ord") - 1).cast("long").alias("chunk_id"), ((F.col("ord") - 1) * 64).cast("long").alias("start_sample"), F.lit(64).cast("long").alias("n_samples"), F.transform("data", lambda x: x.cast("double")).alias("data"))
    out = signal.filtered(chunks, ["channel"], signal.band_pass(300.0, 6000.0, RATE, TAPS))
    return out.groupBy("channel").agg(F.count("*").alias("n"), F.round(F.sum(F.aggregate("data", F.lit(0.0), lambda a, x: a + x * x)), 4).alias("power"))


def rate_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-36: correlation over hours of a day of two runs' rates per unit, clicks against views."""
    rows = f.table(spark, sf_dir, "events").where("event_type IN ('click', 'view')").select("user_id", F.pmod(F.floor(f.micros("ts") / f.HOUR), F.lit(24)).alias("hour"), "event_type")
    cells = rows.groupBy("user_id", "hour").agg(F.count_if(F.col("event_type") == "click").cast("double").alias("a"), F.count_if(F.col("event_type") == "view").cast("double").alias("b"))
    grid = rows.select("user_id").distinct().withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23)).cast("array<long>")))
    whole = grid.join(cells, ["user_id", "hour"], "left").fillna(0.0, ["a", "b"])
    return whole.groupBy(F.col("user_id").alias("unit_id")).agg(F.round(safe_corr(F.col("a"), F.col("b")), 6).alias("r"))


QUERIES = {q.__name__: q for q in (recording_headers, recording_catalog, sample_slice, gated_sessions, manifest_names, resolved_names, spike_samples, dataset_summary, unit_update_file, vector_texts, written_trials, written_units, written_eye, sync_reports, versioned_updates, moved_spikes, band_passed, rate_agreement)}

_BRAND = "replace(p_brand, '#', '') || '.tsv'"
#: The kernel as SQL text; it is a list of parameters.
_KERNEL = "[" + ", ".join(map(repr, signal.band_pass(300.0, 6000.0, RATE, TAPS))) + "]"

SQL = {
    "recording_headers": """WITH p AS (SELECT c_nationkey AS probe, c_nationkey % 4 AS session, count(*) AS n FROM customer GROUP BY ALL), d AS (SELECT *, round(CASE WHEN probe % 3 > 0 THEN n * 10.0 ELSE n * 23100000 / 770.0 / 30000 END, 6) AS duration_s FROM p)
      SELECT CAST(session AS BIGINT) AS session, CAST(probe AS BIGINT) AS probe, 'a=b' AS note, CASE WHEN probe % 5 > 0 THEN '240301' END AS recorded, duration_s, max(duration_s) OVER (PARTITION BY session) AS session_s, count(*) OVER (PARTITION BY session) AS n_probes FROM d""",
    "manifest_names": "SELECT CAST(n_nationkey + 1 AS BIGINT) AS stim_index, n_name AS stim_name, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL",
    "resolved_names": f"""WITH found AS (SELECT DISTINCT '/v' || (p_partkey % 3) || '/' || (p_size % 2) || '/' || {_BRAND} AS path, {_BRAND} AS file FROM part WHERE p_size % 7 = 0),
      wanted AS (SELECT DISTINCT CASE p_size WHEN 49 THEN '/v2/' || (p_size % 2) || '/' || {_BRAND} WHEN 1 THEN ' ' ELSE 'D:\\set\\' || {_BRAND} END AS name, CASE WHEN p_size <> 1 THEN {_BRAND} END AS file FROM part),
      v AS (SELECT file, count(*) AS n, min(path) AS path FROM found WHERE path < '/v2' GROUP BY ALL)
      SELECT name, CASE WHEN f.path IS NOT NULL THEN f.path ELSE v.path END AS path, CASE WHEN trim(name) = '' THEN 'no_dataset_name' WHEN f.path IS NOT NULL THEN 'direct' WHEN v.n > 1 THEN 'vault:' || (CASE WHEN v.path < '/v1' THEN '/v0' ELSE '/v1/' END) || '(multi)' WHEN v.n = 1 THEN 'vault:' || (CASE WHEN v.path < '/v1' THEN '/v0' ELSE '/v1/' END) ELSE 'vault_miss' END AS source
      FROM wanted w LEFT JOIN found f ON f.path = w.name LEFT JOIN v ON v.file = w.file""",
    "recording_catalog": """WITH p AS (SELECT n_nationkey AS k, n_nationkey % 4 > 0 AS b, n_nationkey % 5 > 0 AS m FROM nation)
      SELECT CAST(k AS VARCHAR) AS name, c.test AS test, CASE WHEN CASE c.test WHEN 'bin_present' THEN b WHEN 'meta_present' THEN m WHEN 'size_matches' THEN b AND m AND k % 3 > 0 ELSE m AND k % 7 > 0 END THEN 'pass' ELSE 'fail' END AS status
      FROM p, (VALUES ('bin_present'), ('meta_present'), ('size_matches'), ('rate_present')) c(test) WHERE b OR m
      UNION ALL SELECT 'r' || r_regionkey, 'pair', CASE r_regionkey % 3 WHEN 0 THEN 'meta_missing' WHEN 1 THEN 'bin_missing' ELSE 'ok' END FROM region""",
    "sample_slice": """WITH t AS (SELECT string_agg(rpad('', 399, n_name) || chr(10), '' ORDER BY n_nationkey) AS t FROM nation)
      SELECT s AS sample, CAST(ascii(substr(t, 4 * s + 3, 1)) + 256 * ascii(substr(t, 4 * s + 4, 1)) AS INT) AS v FROM t, (SELECT unnest(range(300, 1713)) AS s)""",
    "gated_sessions": """SELECT session, n_units, n_trials FROM (SELECT c_nationkey AS session, count(*) AS n_units FROM customer WHERE c_nationkey % 5 > 0 GROUP BY ALL)
      JOIN (SELECT c_nationkey AS session, count(*) AS n_trials FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 4 > 0 GROUP BY ALL) USING (session)""",
    "spike_samples": "WITH u AS (SELECT c_mktsegment AS probe_id, c_custkey AS unit_id, unnest(range(1, c_custkey % 7 + 2)) AS t FROM customer WHERE c_acctbal > 0 AND c_custkey % 9 > 0) SELECT probe_id, unit_id, count(*) AS n, CAST(sum(round_even(t * length(probe_id) * 1000.5, 0)) AS BIGINT) AS sum_sample FROM u GROUP BY ALL",
    "dataset_summary": """WITH u AS (SELECT c_nationkey AS session, count(*) AS n, string_agg(DISTINCT c_mktsegment, '+' ORDER BY c_mktsegment) AS probes FROM customer WHERE c_nationkey % 5 > 0 GROUP BY ALL), t AS (SELECT c_nationkey AS session, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 4 > 0 GROUP BY ALL)
      SELECT session, coalesce(u.n, 0) AS n_units, coalesce(probes, '') AS probes, coalesce(t.n, 0) AS n_trials, coalesce(u.n, 0) > 0 AND coalesce(t.n, 0) > 0 AS can_score FROM u FULL JOIN t USING (session)""",
    "unit_update_file": "SELECT s_suppkey AS unit_id, s_suppkey % 3 <> 1 AS keep, 'note ' || s_nationkey AS note FROM supplier",
    "vector_texts": "SELECT vec_id, len(embedding) AS n, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS sum FROM embeddings",
    "written_trials": """SELECT o_orderkey AS trial_id, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 2 = 0 ELSE true END AS trial_valid, round(CAST(o_totalprice AS DOUBLE), 5) AS stim_onset_imec0, CASE WHEN o_orderkey % 4 > 0 THEN round(CAST(o_totalprice AS DOUBLE) + 1, 5) END AS stim_onset_imec1,
      round(CAST(o_totalprice AS DOUBLE), 5) AS start_time, round(CAST(o_totalprice AS DOUBLE) + (CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 100 ELSE 150 END) / 1000.0, 5) AS stop_time FROM orders""",
    "written_units": f"WITH {f.SPIKES_SQL} SELECT session, probe, unit_id, count(*) FILTER (amplitude > 0) AS n, min(t_us) FILTER (amplitude > 0) AS first_us, max(t_us) FILTER (amplitude > 0) AS last_us, CAST(3 AS BIGINT) AS width FROM spikes GROUP BY ALL",
    "written_eye": "WITH e AS (SELECT label AS session, vec_id AS trial_id, len(embedding) AS n, sum(len(embedding)) OVER (PARTITION BY label ORDER BY vec_id) AS upto FROM embeddings) SELECT session, trial_id, CAST(upto - n AS BIGINT) AS first, CAST(upto - 1 AS BIGINT) AS last, CAST(250 AS DOUBLE) AS rate FROM e",
    "sync_reports": f"SELECT session, n_trials, string_agg(stream || ':' || status, ',' ORDER BY stream) AS fits FROM ({alignment.SQL['clock_fit']}) JOIN (SELECT o_orderpriority AS session, count(*) AS n_trials FROM orders GROUP BY ALL) USING (session) GROUP BY ALL",
    "versioned_updates": "SELECT v AS version, count(*) AS rows_before, count(*) - count(*) FILTER (s_suppkey % k = 0 AND s_suppkey % 10 > 0 AND s_nationkey <= 5) AS rows_after, count(*) FILTER (s_suppkey % k = 0 AND s_suppkey % 10 = 0) AS unknown FROM supplier, (VALUES ('v001', 2), ('v002', 3)) x(v, k) GROUP BY ALL",
    "moved_spikes": f"SELECT l_suppkey AS unit_id, count(*) AS n, round(sum(l_orderkey / {RATE} + 120), 4) AS sum_t, round(sum(CAST(l_quantity AS DOUBLE) * 5 / 32768) * 1000, 6) AS sum_mv FROM lineitem GROUP BY ALL",
    "band_passed": f"""WITH l AS (SELECT label AS channel, CAST(e AS DOUBLE) AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id, i) AS k FROM (SELECT label, vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)), w AS (SELECT unnest({_KERNEL}) AS w, generate_subscripts({_KERNEL}, 1) - {TAPS // 2 + 1} AS o),
      y AS (SELECT a.channel, a.k, sum(b.v * w) AS y FROM l a CROSS JOIN w JOIN l b ON b.channel = a.channel AND b.k = a.k + o GROUP BY ALL) SELECT channel, count(*) // 64 AS n, round(sum(y * y), 4) AS power FROM y GROUP BY ALL""",
    "rate_agreement": f"""WITH e AS (SELECT user_id, epoch_us(ts) // {f.HOUR} % 24 AS hour, event_type FROM events WHERE event_type IN ('click', 'view')), c AS (SELECT user_id, hour, count(*) FILTER (event_type = 'click') AS a, count(*) FILTER (event_type = 'view') AS b FROM e GROUP BY ALL),
      g AS (SELECT user_id, h.range AS hour FROM (SELECT DISTINCT user_id FROM e), range(24) h) SELECT g.user_id AS unit_id, CASE WHEN var_pop(coalesce(a, 0)) > 0 AND var_pop(coalesce(b, 0)) > 0 THEN round(corr(coalesce(a, 0), coalesce(b, 0)), 6) END AS r FROM g LEFT JOIN c USING (user_id, hour) GROUP BY g.user_id""",
}
