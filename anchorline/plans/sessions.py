"""Queries over behaviour tables, units, channels and the checks between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins
from ..operators import sessions as s
from ..session import with_checkpoints
from ..sources import recordings, sinks
from ..sources.commits import commit_version
from . import alignment
from . import fixtures as f


def _trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a trial; its turns are the events and the lengths of their texts an analog channel of their role."""
    turn = F.struct("turn", F.col("role").alias("code"), F.col("turn").alias("time"), F.length("text").alias("n"))
    rows = f.table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("trial_id")).agg(F.array_sort(F.collect_list(turn)).alias("events"))
    channel = lambda role: F.transform(F.filter("events", lambda e: e["code"] == role), lambda e: e["n"])
    return rows.select("trial_id", "events", F.create_map(F.lit("user"), channel("user"), F.lit("system"), channel("system")).alias("analog"))


def behaviour_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8: nested trials, summed up."""
    return _trials(spark, sf_dir).select("trial_id", F.size("events").cast("long").alias("n_events"), F.element_at("events", 1)["code"].alias("first_code"), F.element_at("events", -1)["time"].cast("long").alias("last_time"))


def logged_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8: conversations logged as trials in JSON lines, read back with the trials' schema; some lack a channel, a variable or their validity."""
    k = F.col("trial_id")
    event = lambda e: F.struct(e["code"].alias("code"), e["time"].cast("double").alias("time"))
    doubles = F.transform_values("analog", lambda _, v: F.transform(v, lambda x: x.cast("double")))
    trials = _trials(spark, sf_dir).select(
        F.concat(F.lit("s"), k % 3).alias("session"), k, F.when(k % 7 > 0, k % 5 > 0).alias("valid"), F.transform("events", event).alias("events"),
        F.when(k % 4 > 0, doubles).alias("analog"), F.when(k % 2 > 0, F.create_map(F.lit("stim"), (k % 10).cast("string"))).alias("vars"))
    back = recordings.behaviour_trials(spark, _written(trials, "trials", "json"))
    total = F.aggregate(F.coalesce(F.col("analog")["user"], F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return back.select("session", "trial_id", "valid", F.size("events").cast("long").alias("n_events"), F.element_at("events", -1)["time"].alias("last_time"), total.alias("user_chars"), F.col("vars")["stim"].alias("stim"))


def analog_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9: trials without the channel have no rows."""
    return s.analog(_trials(spark, sf_dir), "system", keys=("trial_id",)).select("trial_id", F.col("i").cast("long").alias("i"), F.col("value").cast("long").alias("value"))


def code_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1."""
    return s.code_times(_trials(spark, sf_dir), ["assistant"], ("trial_id",)).select("trial_id", F.col("time").cast("long").alias("time"))


def behavior_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-5, SK-2: days of orders as stimuli, in every probe's clock, written and read back."""
    pulses = alignment._pulses(spark, sf_dir).where("stream = 'nidq'")
    onsets = pulses.select("session", F.col("t").cast("long").alias("trial_id"), F.col("t").alias("onset_s"), F.pmod(F.col("t"), F.lit(40.0)).alias("latency_ms"), F.when(F.pmod(F.col("t").cast("long"), F.lit(11)) == 0, 2).otherwise(0).alias("flag"))
    rows = onsets.select("session", "trial_id").withColumn("trial_valid", F.pmod("trial_id", F.lit(5)) > 0)
    names = rows.select("session").distinct().withColumn("dataset_name", F.concat(F.lit("set-"), F.substring("session", 1, 1)))
    path = _written(s.behavior_events(rows, onsets, alignment._fits(spark, sf_dir), names), "behavior_events")
    back = spark.read.parquet(path)
    clock = lambda p: F.round(F.get_json_object("onset_by_probe", f"$.{p}").cast("double"), 4).alias(p)
    return back.select("session", "trial_id", "trial_valid", "onset_s", "latency_ms", F.col("flag").cast("long").alias("flag"), "dataset_name", clock("imec0"), clock("imec1"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared one."""
    import uuid

    with_checkpoints(spark)
    return f"{(spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, name: str, form: str = "parquet") -> str:
    """Writes a table to a new folder of the shared one."""
    path = shared_path(df.sparkSession, name)
    writer = df.write.option("header", "true") if form == "csv" else df.write
    getattr(writer, form)(path)
    return path


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are units of their market segment; those in debt have no spikes."""
    n = F.when(F.col("c_acctbal") > 0, F.pmod("c_custkey", F.lit(7)) + 1).otherwise(0)
    times = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: i.cast("double"))).otherwise(F.array().cast("array<double>"))
    return f.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit_id"), F.when(F.pmod("c_custkey", F.lit(9)) > 0, F.col("c_mktsegment")).alias("probe_id"), F.col("c_nationkey").cast("string").alias("electrode_group_name"), times.alias("spike_times"), "c_acctbal")


def unit_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11: the probes of one nation's units that cannot be read."""
    return s.unit_problems(_units(spark, sf_dir).withColumn("probe_id", F.when(F.col("probe_id").isNotNull(), F.concat_ws("/", "probe_id", "electrode_group_name"))))


def unit_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-43."""
    return s.probe_key(_units(spark, sf_dir)).groupBy("probe").agg(F.count("*").alias("n_units"))


def imported_sorting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10: line items are spikes of their supplier, suppliers have labels."""
    spikes = f.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("unit_id"))
    labels = f.table(spark, sf_dir, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("unit_id"), F.when(F.col("s_acctbal") > 0, "good").otherwise("mua").alias("label"))
    return s.imported_sorting(spikes, labels, ("unit_id",))


def _channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("long").alias("series"), F.col("s_suppkey").alias("channel"), F.when(F.pmod("s_suppkey", F.lit(50)) > 0, F.col("s_acctbal")).alias("x"), F.col("s_suppkey").cast("double").alias("y"))


def channel_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-15: nations declare their number of suppliers, every fifth one wrongly."""
    channels = _channels(spark, sf_dir)
    series = channels.groupBy("series").agg((F.count("*") + (F.pmod("series", F.lit(5)) == 0).cast("int")).alias("n_channels"))
    return s.channel_locations(channels, series).select("series", F.size("locations").cast("long").alias("n"), F.round(F.aggregate("locations", F.lit(0.0), lambda a, e: a + e["x"]), 4).alias("sum_x"))


def electrodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-17: suppliers are the electrodes of their nation's probe, but those of every third nation."""
    table = _channels(spark, sf_dir).where("series % 3 <> 0").select(F.col("series").alias("probe"), F.col("channel").alias("electrode"))
    probes = f.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("probe"), (F.col("n_regionkey") + 1).alias("n_channels"))
    return s.electrodes(table, probes)


def chosen_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-6, ST-1: customers in the order of their orders' prices, one row for each order."""
    wanted = f.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("unit_id"), F.col("o_orderkey").alias("ord"))
    return s.chosen(_units(spark, sf_dir).select("unit_id", "probe_id"), wanted).orderBy("ord")


def kept_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIG-5: suppliers without those of a negative balance."""
    channels = _channels(spark, sf_dir).select(F.col("series").alias("probe"), "channel", "x")
    return s.without_channels(channels, channels.where("x < 0")).select("probe", "channel")


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-21: customers as subjects; a third has a blank weight."""
    rows = f.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("species"), F.when(F.pmod("c_custkey", F.lit(3)) > 0, F.col("c_nationkey").cast("string")).otherwise(" ").alias("weight"), "c_acctbal")
    return s.subject(rows)


def trace_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIG-9: a vector is a window."""
    rows = f.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("trial_id"), F.posexplode("embedding").alias("i", "v")).withColumn("v", F.col("v").cast("double"))
    out = s.trace_variants(rows, ("trial_id",))
    return out.groupBy("trial_id").agg(F.count("*").alias("n"), *(F.round(F.sum(c), 4).alias(c) for c in ("z", "delta", "abs_delta", "upright")))


def unlike_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIG-4: a vector is a channel of its label's probe."""
    rows = f.table(spark, sf_dir, "embeddings").select(F.col("label").alias("probe"), F.col("vec_id").alias("channel"), F.posexplode("embedding").alias("i", "v")).withColumn("v", F.col("v").cast("double"))
    return s.unlike_neighbours(rows, rows.select("probe", "channel").distinct()).withColumn("r", F.round("r", 5))


def metrics_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-3: metrics and labels written as CSV with a header and read back."""
    units = _units(spark, sf_dir).select("unit_id", F.size("spike_times").alias("n_spikes"), F.col("c_acctbal").alias("snr"), F.when(F.col("c_acctbal") > 5000, "good").otherwise("mua").alias("label"))
    return spark.read.option("header", "true").schema("unit_id long, n_spikes int, snr double, label string").csv(sinks.write_metrics(units, shared_path(spark, "quality_metrics"), ["unit_id", "snr"]))


def written_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-4: scores written as Parquet and read back."""
    units = _units(spark, sf_dir).select("unit_id", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 10000).alias("score"), (F.col("c_acctbal") > 4000).alias("is_visual"))
    return spark.read.parquet(sinks.write_scores(units, shared_path(spark, "unit_scores")))


def merge_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-9: which units became one, as an append table with the run's settings."""
    rows = f.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("group")).agg(F.array_sort(F.collect_list("c_custkey")).alias("ids")).where(F.size("ids") > 1)
    log = sinks.merge_log(rows.select(F.element_at("ids", 1).alias("unit_id"), F.col("ids").alias("merged_from")), {"least_similarity": 0.9})
    back = spark.read.parquet(commit_version(log, shared_path(spark, "merge_log")))
    return back.select("new_id", F.array_join("merged_from", ",").alias("merged_from"), F.size("merged_from").cast("long").alias("units"))


def sorter_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-11: amplitudes and template ids beside the spikes, a folder for each probe."""
    spikes = f.spikes(spark, sf_dir).withColumn("template_id", F.pmod("unit_id", F.lit(4)))
    return spark.read.parquet(sinks.write_sorter_columns(spikes, shared_path(spark, "sorter"))).groupBy("probe", "template_id").agg(F.count("*").alias("n"), F.round(F.sum("amplitude"), 3).alias("sum_amplitude"))


def curated_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QC-3: probes whose units have metrics and were kept."""
    units = s.probe_key(_units(spark, sf_dir)).withColumn("kept", F.col("c_acctbal") > 9000)
    metrics = units.where("probe <> 'BUILDING'").select("probe", "unit_id", F.col("c_acctbal").alias("snr"))
    return s.curated(metrics, units, ["snr"])


def thresholds_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QC-6: balances as ratios of 8000."""
    return s.out_of_range(f.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), (F.col("s_acctbal") / 8000).alias("value"))).withColumn("value", F.round("value", 6))


def stage_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QC-10: every nation should have a supplier, a customer and a customer in debt."""
    nations = f.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("probe"), F.explode(F.array(F.lit("preprocessed"), F.lit("templates"), F.lit("final"))).alias("output"))
    have = f.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("probe"), F.lit("preprocessed").alias("output"), F.lit(1).alias("bytes"))
    customers = f.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("probe"), F.explode(F.array(F.struct(F.lit("templates").alias("output"), F.lit(1).alias("bytes")), F.struct(F.lit("final").alias("output"), (F.col("c_acctbal") < -900).cast("int").alias("bytes")))).alias("e")).select("probe", "e.*")
    return s.stage_outputs(nations, have.unionByName(customers))


def safe_to_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QC-9, OP-14: orders are sessions, their lines the streams."""
    orders = f.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("session"), (F.col("o_orderstatus") != "P").alias("readable"))
    streams = f.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("session"), F.col("l_linenumber").alias("stream"), (F.col("l_discount") < 0.08).alias("verified"), F.when(F.col("l_linenumber") > 1, F.col("l_quantity").cast("int")).alias("files"))
    return s.safe_to_delete(orders, streams)


def copy_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-15: first, middle and last vectors of a label against a copy in which every ninth differs and every fourteenth lacks."""
    rows = f.table(spark, sf_dir, "embeddings").select(F.col("label").alias("stream"), F.col("vec_id"))
    source = joins.ordinal(rows, ["stream"], ["vec_id"], "n").select("stream", (F.col("n") - 1).alias("chunk"), F.col("vec_id").cast("string").alias("digest"), "vec_id")
    copy = source.where("vec_id % 14 <> 0").withColumn("digest", F.when(F.pmod("vec_id", F.lit(9)) == 0, "x").otherwise(F.col("digest")))
    return s.copy_chunks(source, copy, full=False)


def named_stims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-5: line numbers as stimuli; the manifest knows the regions."""
    onsets = f.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("trial_id"), F.col("n_regionkey").cast("long").alias("stim_index"))
    manifest = f.table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("stim_index"), F.col("r_name").alias("stim_name")).where("stim_index NOT IN (0, 2)")
    return s.named_stims(onsets, manifest).select("trial_id", "stim_index", "stim_name")


QUERIES = {q.__name__: q for q in (behaviour_trials, logged_trials, analog_channel, code_times, behavior_events, unit_problems, unit_probes, imported_sorting, channel_locations, electrodes, chosen_units, kept_channels, subjects, trace_variants, unlike_neighbours, metrics_csv, written_scores, merge_log, sorter_columns, curated_probes, thresholds_out_of_range, stage_outputs, safe_to_delete, copy_chunks, named_stims)}

_UNITS = """units AS (SELECT c_custkey AS unit_id, CASE WHEN c_custkey % 9 > 0 THEN c_mktsegment END AS probe_id, CAST(c_nationkey AS VARCHAR) AS electrode_group_name, CASE WHEN c_acctbal > 0 THEN c_custkey % 7 + 1 ELSE 0 END AS n_spikes, c_acctbal FROM customer)"""
_WINDOWS = "w AS (SELECT vec_id, label, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"

SQL = {
    "logged_trials": "SELECT 's' || (conv_id % 3) AS session, conv_id AS trial_id, CASE WHEN conv_id % 7 > 0 THEN conv_id % 5 > 0 END AS valid, count(*) AS n_events, CAST(max(turn) AS DOUBLE) AS last_time, CASE WHEN conv_id % 4 > 0 THEN coalesce(sum(length(text)) FILTER (role = 'user'), 0) ELSE 0 END + 0.0::DOUBLE AS user_chars, CASE WHEN conv_id % 2 > 0 THEN CAST(conv_id % 10 AS VARCHAR) END AS stim FROM conversations GROUP BY conv_id",
    "behaviour_trials": "SELECT conv_id AS trial_id, count(*) AS n_events, min_by(role, turn) AS first_code, max(turn) AS last_time FROM conversations GROUP BY conv_id",
    "analog_channel": "SELECT conv_id AS trial_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, length(text) AS value FROM conversations WHERE role = 'system'",
    "code_times": "SELECT conv_id AS trial_id, turn AS time FROM conversations WHERE role = 'assistant'",
    "behavior_events": f"""WITH {alignment._PULSES}, {alignment._FITS}, good AS (SELECT * FROM fit WHERE n = nr)
      SELECT p.session, CAST(t AS BIGINT) AS trial_id, (CAST(t AS BIGINT) % 5 + 5) % 5 > 0 AS trial_valid, t AS onset_s, (t % 40 + 40) % 40 AS latency_ms, CASE WHEN CAST(t AS BIGINT) % 11 = 0 THEN 2 ELSE 0 END AS flag, 'set-' || substr(p.session, 1, 1) AS dataset_name,
        round((t - g.b) / g.a, 4) AS imec0, round((t - h.b) / h.a, 4) AS imec1
      FROM pulses p LEFT JOIN good g ON g.session = p.session AND g.stream = 'imec0' LEFT JOIN good h ON h.session = p.session AND h.stream = 'imec1' WHERE p.stream = 'nidq'""",
    "unit_problems": f"WITH {_UNITS}, k AS (SELECT CASE WHEN probe_id IS NOT NULL THEN probe_id || '/' || electrode_group_name END AS probe_id, count(*) AS n, count(*) FILTER (n_spikes = 0) AS empty FROM units GROUP BY 1) SELECT probe_id, CASE WHEN probe_id IS NULL THEN 'no_probe' ELSE 'no_spikes' END AS problem FROM k WHERE probe_id IS NULL OR n = empty",
    "unit_probes": f"WITH {_UNITS} SELECT coalesce(probe_id, electrode_group_name) AS probe, count(*) AS n_units FROM units GROUP BY 1",
    "imported_sorting": "WITH c AS (SELECT l_suppkey AS unit_id, count(*) AS n FROM lineitem GROUP BY 1), l AS (SELECT s_suppkey AS unit_id, CASE WHEN s_acctbal > 0 THEN 'good' ELSE 'mua' END AS label FROM supplier WHERE s_suppkey % 4 <> 0) SELECT unit_id, coalesce(n, 0) AS n_spikes, coalesce(label, 'unsorted') AS label, CASE WHEN n IS NULL THEN 'warn' ELSE 'pass' END AS status FROM c FULL JOIN l USING (unit_id)",
    "channel_locations": "SELECT CAST(s_nationkey AS BIGINT) AS series, CASE WHEN fine THEN n ELSE NULL END AS n, CASE WHEN fine THEN x END AS sum_x FROM (SELECT s_nationkey, count(*) AS n, round(sum(s_acctbal), 4) AS x, s_nationkey % 5 <> 0 AND count(*) FILTER (s_suppkey % 50 = 0) = 0 AS fine FROM supplier GROUP BY s_nationkey)",
    "electrodes": "WITH own AS (SELECT CAST(s_nationkey AS BIGINT) AS probe, s_suppkey AS electrode FROM supplier WHERE s_nationkey % 3 <> 0) SELECT probe, row_number() OVER (PARTITION BY probe ORDER BY electrode) - 1 AS position, electrode FROM own UNION ALL SELECT n_nationkey, i, i FROM nation, LATERAL (SELECT unnest(range(n_regionkey + 1)) AS i) WHERE n_nationkey NOT IN (SELECT probe FROM own)",
    "chosen_units": f"WITH {_UNITS} SELECT unit_id, o_orderkey AS ord, probe_id FROM orders JOIN units ON unit_id = o_custkey",
    "kept_channels": "SELECT CAST(s_nationkey AS BIGINT) AS probe, s_suppkey AS channel FROM supplier WHERE NOT coalesce(CASE WHEN s_suppkey % 50 > 0 THEN s_acctbal END < 0, false)",
    "subjects": "SELECT c_custkey AS subject_id, c_mktsegment AS species, CASE WHEN c_custkey % 3 > 0 THEN CAST(c_nationkey AS VARCHAR) END AS weight FROM customer",
    "trace_variants": f"""WITH {_WINDOWS}, z AS (SELECT vec_id, i, CASE WHEN stddev_pop(v) OVER p > 0 THEN (v - avg(v) OVER p) / stddev_pop(v) OVER p ELSE 0 END AS z FROM w WINDOW p AS (PARTITION BY vec_id)),
      d AS (SELECT *, z - first(z) OVER (PARTITION BY vec_id ORDER BY i) AS delta FROM z), g AS (SELECT vec_id, arg_max(sign(delta), abs(delta)) AS s FROM d GROUP BY ALL)
      SELECT vec_id AS trial_id, count(*) AS n, round(sum(z), 4) AS z, round(sum(delta), 4) AS delta, round(sum(abs(delta)), 4) AS abs_delta, round(sum(z * CASE WHEN s < 0 THEN -1 ELSE 1 END), 4) AS upright FROM d JOIN g USING (vec_id) GROUP BY vec_id""",
    "unlike_neighbours": f"""WITH {_WINDOWS}, c AS (SELECT label, vec_id, lag(vec_id) OVER o AS a, lead(vec_id) OVER o AS b FROM (SELECT DISTINCT label, vec_id FROM w) WINDOW o AS (PARTITION BY label ORDER BY vec_id)),
      n AS (SELECT c.label, c.vec_id, w.i, median(w.v) AS m FROM c JOIN w ON w.label = c.label AND w.vec_id IN (c.a, c.b) GROUP BY ALL),
      k AS (SELECT w.label, w.vec_id, var_pop(v) AS own, var_pop(m) AS other, covar_pop(v, m) AS shared FROM w LEFT JOIN n USING (label, vec_id, i) GROUP BY ALL), r AS (SELECT *, CASE WHEN own > 1e-18 AND other > 1e-18 THEN shared / sqrt(own * other) END AS r FROM k)
      SELECT label AS probe, vec_id AS channel, round(r, 5) AS r, CASE WHEN own <= 1e-18 THEN 'dead' WHEN r < 0.5 THEN 'noisy' ELSE 'good' END AS status FROM r""",
    "metrics_csv": f"WITH {_UNITS} SELECT unit_id, CAST(n_spikes AS INT) AS n_spikes, c_acctbal AS snr, CASE WHEN c_acctbal > 5000 THEN 'good' ELSE 'mua' END AS label FROM units",
    "written_scores": "SELECT c_custkey AS unit_id, CASE WHEN c_acctbal > 0 THEN c_acctbal / 10000 END AS score, c_acctbal > 4000 AS is_visual FROM customer",
    "merge_log": "SELECT min(c_custkey) AS new_id, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS merged_from, count(*) AS units FROM customer GROUP BY c_nationkey HAVING count(*) > 1",
    "sorter_columns": f"WITH {f.SPIKES_SQL} SELECT probe, unit_id % 4 AS template_id, count(*) AS n, round(sum(amplitude), 3) AS sum_amplitude FROM spikes GROUP BY ALL",
    "curated_probes": f"""WITH {_UNITS}, u AS (SELECT coalesce(probe_id, electrode_group_name) AS probe, count(*) FILTER (c_acctbal > 9000) AS kept FROM units GROUP BY 1),
      j AS (SELECT probe, CASE WHEN probe = 'BUILDING' THEN 'no_metrics' WHEN kept = 0 THEN 'no_units_kept' ELSE '' END AS reason FROM u) SELECT probe, CASE WHEN reason = '' THEN 'pass' ELSE 'fail' END AS status, reason FROM j""",
    "thresholds_out_of_range": "SELECT s_name AS name, round(s_acctbal / 8000, 6) AS value FROM supplier WHERE s_acctbal / 8000 < 0 OR s_acctbal / 8000 > 1",
    "stage_outputs": """WITH h AS (SELECT s_nationkey AS probe, 'preprocessed' AS output, 1 AS bytes FROM supplier UNION ALL SELECT c_nationkey, 'templates', 1 FROM customer UNION ALL SELECT c_nationkey, 'final', CASE WHEN c_acctbal < -900 THEN 1 ELSE 0 END FROM customer),
      g AS (SELECT probe, output, sum(bytes) AS bytes FROM h GROUP BY ALL) SELECT n_nationkey AS probe, o.output, CASE WHEN bytes IS NULL THEN 'missing' WHEN bytes <= 0 THEN 'empty' ELSE 'pass' END AS status FROM nation CROSS JOIN (VALUES ('preprocessed'), ('templates'), ('final')) o(output) LEFT JOIN g ON g.probe = n_nationkey AND g.output = o.output""",
    "safe_to_delete": """WITH g AS (SELECT l_orderkey, sum(CASE WHEN l_linenumber > 1 THEN CAST(trunc(l_quantity) AS INT) ELSE 0 END) AS files, count(*) FILTER (NOT l_discount < 0.08) AS open FROM lineitem GROUP BY 1),
      j AS (SELECT o_orderkey AS session, CASE WHEN o_orderstatus = 'P' THEN 'unreadable' WHEN coalesce(files, 0) = 0 THEN 'no_files' WHEN open > 0 THEN 'unverified' ELSE '' END AS reason FROM orders LEFT JOIN g ON l_orderkey = o_orderkey) SELECT session, reason = '' AS safe, reason FROM j""",
    "copy_chunks": """WITH n AS (SELECT label AS stream, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS chunk, count(*) OVER (PARTITION BY label) - 1 AS last FROM embeddings)
      SELECT stream, count(*) AS compared, count(*) FILTER (vec_id % 9 = 0 OR vec_id % 14 = 0) AS differing FROM n WHERE chunk IN (0, last // 2, last) GROUP BY stream""",
    "named_stims": "SELECT n_nationkey AS trial_id, CAST(n_regionkey AS BIGINT) AS stim_index, CASE WHEN n_regionkey NOT IN (0, 2) THEN r_name ELSE '' END AS stim_name FROM nation JOIN region ON r_regionkey = n_regionkey",
}
