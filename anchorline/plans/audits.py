"""Queries over what runs say about themselves: rewrite lists, audits, agreement of runs, thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, clocks, joins, runs, trials
from ..operators import pairing as p
from ..operators import population as pop
from ..operators import sessions as s
from ..sources import sinks
from . import alignment, curations
from . import fixtures as f
from . import populations as pops
from .sessions import _trials, _written


def rewrite_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-16: orders are streams and their lines chunks of 100 samples; some are not there, some are cut, some hold other bytes."""
    lines = f.table(spark, sf_dir, "lineitem")
    orders = f.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("stream"))
    sizes = lines.groupBy(F.col("l_orderkey").alias("stream")).agg((F.max("l_linenumber") * 100).cast("long").alias("n_samples"))
    expected = orders.join(sizes, "stream", "left").select("stream", F.coalesce("n_samples", F.lit(50)).alias("n_samples"))
    kept = lines.where("l_partkey % 5 <> 0 AND l_suppkey % 11 <> 0")
    present = kept.select(F.col("l_orderkey").alias("stream"), ((F.col("l_linenumber") - 1) * 100).cast("long").alias("start"), F.when(F.col("l_partkey") % 7 == 0, 60).otherwise(100).cast("long").alias("n"))
    return audit.missing_ranges(expected, present)


def audit_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-46: fits, stimulus rows and code triples of a session in one table of VARIANT; sessions from 3 on lack the latency."""
    fits = alignment._fits(spark, sf_dir).select("session", "stream", "a", "b", "residual_ms", "status")
    pulses = alignment._pulses(spark, sf_dir).where("stream = 'nidq'")
    latency = F.when(F.substring("session", 1, 1) < "3", F.pmod(F.col("t"), F.lit(40.0)))
    onsets = pulses.select("session", F.col("t").cast("long").alias("trial_id"), F.col("t").alias("pd_onset_nidq_s"), (F.col("t") + 0.25).alias("ec_onset_nidq_s"), latency.alias("latency_ms"))
    triples = pulses.where("t > 500").select("session", F.col("t").alias("time_s"), F.pmod(F.col("t").cast("long"), F.lit(8)).alias("code"), F.pmod(F.col("t").cast("long"), F.lit(3)).alias("bit"))
    back = spark.read.parquet(_written(audit.audit_rows({"fit": fits, "stimulus": onsets, "event": triples}), "audit"))
    number = lambda name: audit.audited(name, "double")
    return back.groupBy("session", "kind").agg(
        F.count("*").alias("n"), F.count(number("latency_ms")).alias("n_latency"), F.round(F.sum(number("ec_onset_nidq_s") - number("pd_onset_nidq_s")), 4).alias("moved_s"),
        F.count_if(audit.audited("status", "string") == "ok").alias("n_ok"), F.sum(audit.audited("code", "long")).alias("sum_code"))


def agreement_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-36: F1 of clicks and views of each user, by three kinds of users and over all."""
    rows = f.table(spark, sf_dir, "events").select(F.col("user_id").alias("unit_id"), f.micros("ts").alias("t"), "event_type")
    a, b = (rows.where(F.col("event_type") == x).select("unit_id", "t") for x in ("click", "view"))
    pairs = p.agreement(a, b, ["unit_id"], pops.HALF_HOUR).withColumn("unittype", F.concat(F.lit("u"), F.col("unit_id") % 3))
    found = audit.agreement_summary(pairs, "f1", "unittype", (0.05, 0.1))
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c not in ("unittype", "n")})


_N_UNITS = 64


def matched_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-49, JN-12: even against odd vectors, whose unit u is unit 63 - u of the other run; every third is paired."""
    rows = pops._rows(spark, sf_dir).withColumn("valid", F.when(F.col("trial") % 7 > 0, F.col("trial") % 5 > 0))
    other = rows.where("trial % 2 = 1").withColumn("unit", _N_UNITS - 1 - F.col("unit"))
    units = rows.select("unit").distinct().where("unit % 3 = 0")
    pairs = units.select(F.col("unit").alias("unit_a"), (_N_UNITS - 1 - F.col("unit")).alias("unit_b"))
    found = audit.matched_subset(rows.where("trial % 2 = 0"), other, pairs)
    return found.withColumns({c: F.round(c, 6) for c in ("pearson", "spearman")})


def overridden_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-27: suppliers' balances as default bounds by region, some replaced, added or taken away by nations."""
    layer = F.when(F.col("s_suppkey") % 2 == 0, "mua").otherwise("noise")
    metric, op = F.concat(F.lit("m"), F.col("s_nationkey")), F.when(F.col("s_suppkey") % 3 == 0, "less").otherwise("greater")
    defaults = f.table(spark, sf_dir, "supplier").groupBy(layer.alias("layer"), metric.alias("metric"), op.alias("op")).agg(F.max("s_acctbal").alias("bound"))
    k = F.col("n_nationkey")
    overrides = f.table(spark, sf_dir, "nation").select(F.lit("mua").alias("layer"), F.concat(F.lit("m"), k).alias("metric"), F.when(k % 2 == 0, "less").otherwise("greater").alias("op"), F.when(k % 3 > 0, k.cast("double")).alias("bound"))
    return audit.merged_bounds(defaults, overrides)


def first_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-8: users by their first event."""
    return audit.distinct_in_order(f.table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").orderBy("event_id")


def probe_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4: times by probe as JSON text, of which some probes are missing."""
    k = F.col("o_orderkey")
    text = F.to_json(F.create_map(F.when(k % 3 > 0, "imec0").otherwise("imec1"), (k % 100).cast("double")))
    return audit.probe_times(f.table(spark, sf_dir, "orders").select(k.alias("trial_id"), text.alias("onsets")), "onsets", "imec0").select("trial_id", "t")


RUN = runs.RunSettings(trial_code=1, stim_code=4, code_rate=2.0, signal_rate=1.0, chunk_size=curations.CHUNK, pre=5, post=10, high=(2, 5), delay_ms=-5.0)


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-2, OP-3, OP-4, OP-1, OP-5 in one run: a user's events as coded samples with zeros between them, a behaviour log that lacks one event in ten, the values as photodiode and the views as pulses."""
    codes = alignment._codes(spark, sf_dir)
    numbered = joins.ordinal(codes, ["session"], ["t_us", "event_id"], "s").withColumn("s", (F.col("s") - 1).cast("long"))
    numbered = spark.read.parquet(_written(numbered, "run_numbered"))  # six tables come from it: numbered once
    words = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("s", "code"))), lambda x: F.array(x["code"], F.lit(0))))
    coded = numbered.groupBy("session", F.expr(f"s div {curations.CHUNK}").alias("chunk_id")).agg((2 * F.min("s")).alias("start_sample"), words.alias("data"))
    logged = numbered.where("event_id % 10 <> 0")
    behaviour = logged.where("code = 1").select("session", F.col("event_id").alias("trial_id"), "s")
    given = joins.anchor_before(logged.where("code = 4").select("session", F.col("event_id").alias("stim"), F.col("s").alias("order_key")), behaviour, ["session"], "order_key", "trial_id", "s", 64).where("trial_id IS NOT NULL")
    base = numbered.where("code = 8").select("session", F.col("s").cast("double").alias("t"))
    pulses = base.withColumn("stream", F.lit("nidq")).unionByName(base.select("session", (F.col("t") * 1.0001 + 0.5).alias("t"), F.lit("imec0").alias("stream")))
    names = behaviour.select("session").distinct().withColumn("dataset_name", F.concat(F.lit("set-"), F.col("session") % 4))
    changes = spark.read.parquet(_written(trials.code_changes(coded, range(5)), "run_changes"))
    out = runs.stimulus_table(changes, behaviour.select("session", "trial_id"), given, curations._signal(spark, sf_dir), clocks.clock_fits(pulses, "nidq", 1e12, 5.0), names, RUN)
    back = spark.read.parquet(_written(out, "run_events"))
    probe = F.get_json_object("onset_by_probe", "$.imec0").cast("double")
    return back.select("session", "trial_id", "trial", F.col("j").cast("long").alias("j"), F.round("onset_s", 6).alias("onset_s"), F.round("latency_ms", 6).alias("latency_ms"), F.col("flag").cast("long").alias("flag"), "dataset_name", F.round(probe, 4).alias("imec0_s"))


def split_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-41: halves of the even vectors."""
    found = pop.split_ablation(pops._rows(spark, sf_dir).where("trial % 2 = 0"), pops.SEEDS, pops.FRACTIONS, pops.UNITS)
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


def chosen_code_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1: the assistant's turns of the conversations in a list."""
    nested = _trials(spark, sf_dir)
    return s.code_times(nested, ["assistant"], ("trial_id",), nested.where("trial_id % 3 = 0")).select("trial_id", F.col("time").cast("long").alias("time"))


def session_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-45, AG-48: nations as sessions, customers as units scored by their balance, orders as trials."""
    customers = f.table(spark, sf_dir, "customer")
    score = F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal") / 10000)
    units = customers.where("c_nationkey % 6 > 0").select(F.col("c_nationkey").alias("session"), F.col("c_custkey").alias("unit_id"), score.alias("score"))
    orders = f.table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).where("c_nationkey % 5 > 0").select(F.col("c_nationkey").alias("session"), F.col("o_orderkey").alias("trial_id"))
    eye = orders.withColumn("interval_ms", F.when(F.col("trial_id") % 3 > 0, (F.col("trial_id") % 10).cast("double")))
    return s.session_report(orders, units, eye, 0.1).withColumn("mean_score", F.round("mean_score", 8))


def merged_units_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-7, SK-5: units with what they were merged from, of the probes that are written."""
    spikes, keys = f.spikes(spark, sf_dir), ["session", "probe", "unit_id"]
    metrics = spikes.groupBy(*keys).agg(F.count("*").alias("n"))
    merged = metrics.where("unit_id % 4 = 0").select(*keys, F.array("unit_id", F.col("unit_id") + 1).alias("merged_from"))
    trials = f.onsets(spark, sf_dir).select("session", ((F.col("session") != "s1") & F.col("valid")).alias("valid"))
    shown = metrics.withColumn("unit_id", F.when(~((F.col("session") == "s2") & (F.col("probe") == "imec1")), F.col("unit_id")))
    status = sinks.writable(shown, trials)
    table = sinks.units_table(spikes, metrics, keys, merged).join(status, ["session", "probe"])
    back = spark.read.parquet(_written(table, "units"))
    return back.select(*keys, "n", F.array_join("merged_from", ",").alias("merged_from"), F.size("spike_times_us").cast("long").alias("n_times"), "status")


def probe_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK-1: a row for each probe."""
    back = spark.read.parquet(_written(sinks.probe_fits(alignment._fits(spark, sf_dir)), "fits"))
    return back.select("session", "probe", F.round("residual_ms", 3).alias("residual_ms"), "n_repaired", "status", "usable")


QUERIES = {q.__name__: q for q in (rewrite_list, audit_fields, agreement_quartiles, matched_subset, overridden_bounds, first_occurrences, probe_times, run_events, split_ablation, chosen_code_times, session_report, merged_units_table, probe_fits)}

_KEYS = "units, trials"
_TAGGED = """{n} AS (SELECT u.units, t.trials, stim, unit, value FROM (SELECT *, CASE WHEN trial % 7 > 0 THEN trial % 5 > 0 END AS valid FROM long WHERE trial % 2 = {i}) l,
  (VALUES ('full'), ('matched')) u(units), (VALUES ('all'), ('valid')) t(trials) WHERE (u.units = 'full' OR {paired}) AND (t.trials = 'all' OR valid))"""

SQL = {
    "rewrite_list": """WITH e AS (SELECT o_orderkey AS stream, coalesce(max(l_linenumber) * 100, 50) AS n_samples FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
      p AS (SELECT l_orderkey AS stream, (l_linenumber - 1) * 100 AS s, (l_linenumber - 1) * 100 + CASE WHEN l_partkey % 7 = 0 THEN 60 ELSE 100 END AS t FROM lineitem WHERE l_partkey % 5 <> 0 AND l_suppkey % 11 <> 0),
      g AS (SELECT p.stream, s, n_samples, coalesce(max(t) OVER (PARTITION BY p.stream ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM p JOIN e ON e.stream = p.stream),
      m AS (SELECT e.stream, n_samples, max(t) AS t FROM e LEFT JOIN p ON p.stream = e.stream GROUP BY ALL)
      SELECT stream, CAST(c AS BIGINT) AS first, CAST(least(s, n_samples) AS BIGINT) AS last, 'hole' AS reason FROM g WHERE s > c AND c < n_samples
      UNION ALL SELECT stream, CAST(coalesce(t, 0) AS BIGINT), CAST(n_samples AS BIGINT), CASE WHEN t IS NULL THEN 'missing' ELSE 'short' END FROM m WHERE coalesce(t, 0) < n_samples""",
    "audit_fields": f"""WITH {alignment._PULSES}, {alignment._FITS}, q AS (SELECT * FROM pulses WHERE stream = 'nidq'),
      st AS (SELECT CASE WHEN pairs < 2 THEN 'too_few_pulses' WHEN n <> nr THEN 'counts_differ' WHEN r > 5 THEN 'residual_too_large' ELSE 'ok' END AS status, session FROM fit JOIN residuals USING (session, stream))
      SELECT session, 'fit' AS kind, count(*) AS n, 0 AS n_latency, CAST(NULL AS DOUBLE) AS moved_s, count(*) FILTER (status = 'ok') AS n_ok, CAST(NULL AS BIGINT) AS sum_code FROM st GROUP BY ALL
      UNION ALL SELECT session, 'stimulus', count(*), count(*) FILTER (session < '3'), round(0.25 * count(*), 4), 0, NULL FROM q GROUP BY ALL
      UNION ALL SELECT session, 'event', count(*), 0, NULL, 0, CAST(sum(CAST(t AS BIGINT) % 8) AS BIGINT) FROM q WHERE t > 500 GROUP BY ALL""",
    "agreement_quartiles": pops.SQL["spike_agreement"].replace("SELECT unit_id, n_a, n_b, tp, round(", ", ag AS (SELECT unit_id, 2 * tp / (n_a + n_b) AS f1, round(", 1) + """)
      SELECT unittype, count(f1) AS n, round(quantile_cont(f1, 0.25), 6) AS p25, round(quantile_cont(f1, 0.5), 6) AS p50, round(quantile_cont(f1, 0.75), 6) AS p75, round(count(*) FILTER (f1 >= 0.05) / count(*), 6) AS share_5, round(count(*) FILTER (f1 >= 0.1) / count(*), 6) AS share_10
      FROM (SELECT unnest(['u' || unit_id % 3, 'ALL']) AS unittype, f1 FROM ag) GROUP BY unittype""",
    # unit u of the even run is paired with the odd run's unit u under its other name; full matrices do not depend on names
    "matched_subset": f"WITH {pops._ROWS}, {_TAGGED.format(n='e', i=0, paired='unit % 3 = 0')}, {_TAGGED.format(n='o', i=1, paired='unit % 3 = 0')}, {pops._rsm_sql('e', _KEYS)}, {pops._rsm_sql('o', _KEYS)}, {pops._CMP('r_e', 'r_o', 'units, trials, ')} SELECT units, trials, count(*) AS n, round(corr(ra, rb), 6) AS pearson, round(corr(ka, kb), 6) AS spearman FROM ranks GROUP BY ALL",
    "run_events": f"""WITH ev AS (SELECT user_id AS session, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS s FROM events),
      bt AS (SELECT session, event_id AS trial_id, s, row_number() OVER (PARTITION BY session ORDER BY event_id) AS k, count(*) OVER (PARTITION BY session) AS n FROM ev WHERE event_type = 'signup' AND event_id % 10 <> 0),
      ct AS (SELECT session, 2 * s AS t, row_number() OVER (PARTITION BY session ORDER BY s) AS k, count(*) OVER (PARTITION BY session) AS m FROM ev WHERE event_type = 'signup' AND s > 0),
      pl AS (SELECT bt.session, trial_id, t FROM bt JOIN ct ON bt.session = ct.session AND bt.k = ct.k WHERE abs(n - m) <= 1),
      gi AS (SELECT c.session, b.trial_id, c.event_id AS stim, c.s AS g FROM (SELECT * FROM ev WHERE event_type = 'click' AND event_id % 10 <> 0) c ASOF JOIN bt b ON c.session = b.session AND c.s >= b.s),
      ed AS (SELECT c.session, p.trial_id, c.t FROM (SELECT session, 2 * s AS t FROM ev WHERE event_type = 'click' AND s > 0) c ASOF JOIN pl p ON c.session = p.session AND c.t >= p.t),
      gn AS (SELECT *, row_number() OVER (PARTITION BY session, trial_id ORDER BY g) AS j, count(*) OVER (PARTITION BY session, trial_id) AS ng FROM gi),
      en AS (SELECT *, row_number() OVER (PARTITION BY session, trial_id ORDER BY t) AS j, count(*) OVER (PARTITION BY session, trial_id) AS ne FROM ed), es AS (SELECT DISTINCT session, trial_id, ne FROM en),
      ma AS (SELECT gn.session, gn.trial_id AS trial, stim AS trial_id, gn.j, CASE WHEN abs(ng - coalesce(es.ne, 0)) <= 1 THEN en.t END AS t FROM gn LEFT JOIN en USING (session, trial_id, j) LEFT JOIN es ON es.session = gn.session AND es.trial_id = gn.trial_id),
      {curations._SIG[: curations._SIG.index("ons AS")]} ons AS (SELECT ma.session, dead, n, trial_id, t // 2 AS centre FROM ma JOIN sizes ON sizes.session = ma.session), {curations._SIG[curations._SIG.index("win AS"):]},
      fl AS (SELECT o.session, o.trial_id, CASE WHEN centre IS NULL OR centre - 5 < 0 OR centre + 10 > n THEN 2 WHEN first IS NULL THEN 3 WHEN early THEN 1 ELSE 0 END AS flag, first FROM ons o LEFT JOIN hit USING (session, trial_id)),
      la AS (SELECT *, CASE WHEN flag = 0 THEN first * 1000.0 - 5.0 END AS latency FROM fl), vi AS (SELECT session FROM ev WHERE event_type = 'view' GROUP BY session HAVING count(*) > 1)
      SELECT ma.session, ma.trial_id, trial, j, round(t / 2.0 + coalesce(latency, 0) / 1000, 6) AS onset_s, round(latency, 6) AS latency_ms, CAST(flag AS BIGINT) AS flag, 'set-' || (ma.session % 4) AS dataset_name,
        CASE WHEN vi.session IS NOT NULL THEN round((t / 2.0 + coalesce(latency, 0) / 1000) * 1.0001 + 0.5, 4) END AS imec0_s
      FROM ma JOIN la USING (session, trial_id) LEFT JOIN vi ON vi.session = ma.session""",
    "split_ablation": pops.SQL["ablation"].split("e AS (SELECT * EXCLUDE")[0].replace("l.stim, l.unit, value FROM", "l.stim, l.trial, l.unit, value FROM") + f"""hf AS (SELECT * EXCLUDE (run, trial), dense_rank() OVER (PARTITION BY seed, fraction, units, stim ORDER BY md5(seed || ':' || trial), trial) % 2 AS h FROM kept WHERE run = 0),
      e AS (SELECT * EXCLUDE (h) FROM hf WHERE h = 1), o AS (SELECT * EXCLUDE (h) FROM hf WHERE h = 0), {pops._rsm_sql('e', 'seed, fraction, units')}, {pops._rsm_sql('o', 'seed, fraction, units')},
      m AS (SELECT seed, fraction, units, corr(a.r, b.r) AS x FROM r_e a JOIN r_o b USING (seed, fraction, units, stim_a, stim_b) GROUP BY ALL) SELECT fraction, units, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS sd, count(x) AS n FROM m GROUP BY ALL""",
    "chosen_code_times": "SELECT conv_id AS trial_id, turn AS time FROM conversations WHERE role = 'assistant' AND conv_id % 3 = 0",
    "session_report": """WITH u AS (SELECT c_nationkey AS session, count(*) AS n_units, avg(CASE WHEN c_custkey % 5 > 0 THEN c_acctbal / 10000 END) AS mean_score, count(*) FILTER (c_custkey % 5 = 0) AS n_null, count(*) FILTER (c_custkey % 5 > 0 AND c_acctbal / 10000 < 0.1) AS n_suspicious FROM customer WHERE c_nationkey % 6 > 0 GROUP BY ALL),
      o AS (SELECT c_nationkey AS session, o_orderkey AS k FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 5 > 0), t AS (SELECT session, count(*) AS n_trials FROM o GROUP BY ALL), e AS (SELECT session, CAST(min(k) FILTER (k % 3 > 0) % 10 AS DOUBLE) AS interval_ms FROM o GROUP BY ALL)
      SELECT coalesce(t.session, u.session) AS session, coalesce(n_trials, 0) AS n_trials, coalesce(n_units, 0) AS n_units, round(mean_score, 8) AS mean_score, coalesce(n_null, 0) AS n_null, coalesce(n_suspicious, 0) AS n_suspicious, interval_ms FROM t FULL JOIN u ON t.session = u.session LEFT JOIN e ON e.session = coalesce(t.session, u.session)""",
    "merged_units_table": f"""WITH {f.SPIKES_SQL}, {f.ONSETS_SQL}, t AS (SELECT session, count(*) FILTER (session <> 's1' AND valid) AS n FROM onsets GROUP BY ALL)
      SELECT s.session, probe, unit_id, count(*) AS n, CASE WHEN unit_id % 4 = 0 THEN unit_id || ',' || (unit_id + 1) ELSE '' END AS merged_from, count(*) AS n_times,
        CASE WHEN s.session = 's2' AND probe = 'imec1' THEN 'skip_no_units' WHEN coalesce(any_value(t.n), 0) = 0 THEN 'skip_no_trials' ELSE 'write' END AS status FROM spikes s LEFT JOIN t ON t.session = s.session GROUP BY s.session, probe, unit_id""",
    "probe_fits": "SELECT session, stream AS probe, residual_ms, n_repaired, status, status = 'ok' AND a IS NOT NULL AS usable FROM (" + alignment.SQL["clock_fit"] + ")",
    "overridden_bounds": """WITH d AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'mua' ELSE 'noise' END AS layer, 'm' || s_nationkey AS metric, CASE WHEN s_suppkey % 3 = 0 THEN 'less' ELSE 'greater' END AS op, max(s_acctbal) AS bound FROM supplier GROUP BY ALL),
      o AS (SELECT 'mua' AS layer, 'm' || n_nationkey AS metric, CASE WHEN n_nationkey % 2 = 0 THEN 'less' ELSE 'greater' END AS op, CASE WHEN n_nationkey % 3 > 0 THEN CAST(n_nationkey AS DOUBLE) END AS bound FROM nation)
      SELECT layer, metric, op, bound FROM o WHERE bound IS NOT NULL UNION ALL SELECT layer, metric, op, bound FROM d WHERE NOT EXISTS (FROM o WHERE o.layer = d.layer AND o.metric = d.metric AND o.op = d.op)""",
    "first_occurrences": "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL",
    "probe_times": "SELECT o_orderkey AS trial_id, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 100 AS DOUBLE) END AS t FROM orders",
}
