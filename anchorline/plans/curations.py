"""Queries over unit quality, signals, updates and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import curation as c
from ..operators import joins, signal
from ..operators import sessions as s
from . import fixtures as f

DAYS, MONTHS = 2520.0, 84
METRICS = ("n", "firing_rate", "presence_ratio", "isi_violations_ratio", "rp_contamination", "amplitude_median", "amplitude_cutoff", "snr")
BOUNDS = [("NOISE", "presence_ratio", "greater", 0.6), ("NOISE", "n", "greater", 40.0), ("MUA", "isi_violations_ratio", "less", 0.03), ("MUA", "snr", "greater", 1.5), ("MUA", "amplitude_cutoff", "abs", 0.2)]


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("double")
    rows = f.table(spark, sf_dir, "lineitem").select("l_suppkey", day.alias("d"), "l_extendedprice")
    return c.quality_metrics(rows, "l_suppkey", "d", "l_extendedprice", MONTHS, DAYS)


_METRICS = f"""s AS (SELECT l_suppkey, CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS d, l_extendedprice AS p FROM lineitem),
g AS (SELECT *, d - lag(d) OVER (PARTITION BY l_suppkey ORDER BY d) AS gap FROM s), md AS (SELECT l_suppkey, median(p) AS m FROM s GROUP BY ALL),
q AS (SELECT l_suppkey, count(*) AS n, count(*) FILTER (gap < 2) AS nv, count(DISTINCT floor(d * {MONTHS} / {DAYS})) AS occ, any_value(m) AS amplitude_median, avg(p) / nullif(stddev_pop(p), 0) AS snr, avg(CASE WHEN p < 0.25 * m THEN 1.0 ELSE 0.0 END) AS amplitude_cutoff FROM g JOIN md USING (l_suppkey) GROUP BY ALL),
metrics AS (SELECT l_suppkey, n, n / {DAYS}::DOUBLE AS firing_rate, occ / {MONTHS}::DOUBLE AS presence_ratio, nv * {DAYS}::DOUBLE / (2.0 * n * n * 2.0) AS isi_violations_ratio, 1 - sqrt(greatest(0, 1 - nv * ({DAYS}::DOUBLE - 2.0 * n * 2.0) / (CAST(n AS DOUBLE) * n * 2.0))) AS rp_contamination, amplitude_median, amplitude_cutoff, snr FROM q)"""
_CLASS = "classed AS (SELECT *, CASE WHEN presence_ratio < 0.6 OR coalesce(amplitude_cutoff > 0.2, false) THEN 'NOISE' WHEN isi_violations_ratio <= 0.03 AND snr >= 1.5 THEN 'SUA' WHEN snr >= 1.5 THEN 'MUA' ELSE 'NOISE' END AS unittype FROM metrics)"
_BOUNDS = "bounds AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{o}', {v}::DOUBLE)" for a, b, o, v in BOUNDS) + ") t(layer, metric, op, bound))"
_FAILED = "longm AS (SELECT l_suppkey, unnest(['presence_ratio', 'n', 'isi_violations_ratio', 'snr', 'amplitude_cutoff']) AS metric, unnest([presence_ratio, CAST(n AS DOUBLE), isi_violations_ratio, snr, amplitude_cutoff]) AS value FROM metrics), failed AS (SELECT l_suppkey, layer, metric FROM longm JOIN bounds USING (metric) WHERE NOT coalesce(CASE op WHEN 'greater' THEN value > bound WHEN 'less' THEN value < bound ELSE abs(value) < bound END, true))"


def _rounded(df: DataFrame, names) -> DataFrame:
    return df.withColumns({n: F.round(n, 7) for n in names})


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-25, OP-8."""
    return _rounded(_metrics(spark, sf_dir), METRICS[1:])


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.classified(_metrics(spark, sf_dir), 0.03, 0.2, 0.6, 1.5)


def classify_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-26, PRJ-5, PRJ-6, PRJ-20."""
    number = c.mapped(F.col("unittype"), c.NUMBERS, 0)
    back = c.mapped(F.col("unittype"), {v: k for k, v in c.LABELS.items()}, "noise")
    return _classified(spark, sf_dir).select("l_suppkey", "unittype", number.alias("number"), back.alias("label"))


def _thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BOUNDS, "layer string, metric string, op string, bound double")


def threshold_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-27."""
    return c.labelled(_metrics(spark, sf_dir), "l_suppkey", _thresholds(spark), ("NOISE", "MUA"), "SUA")


def label_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-50."""
    return c.overlaps(c.failures(_metrics(spark, sf_dir), "l_suppkey", _thresholds(spark)), "l_suppkey")


def unit_type_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-23."""
    return c.shares(_classified(spark, sf_dir), "unittype").withColumn("share", F.round("share", 8))


def metric_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-21."""
    return c.histogram(_metrics(spark, sf_dir), "amplitude_median")


def quantile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-38."""
    rows = f.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return c.quantile_summary(rows, "l_returnflag", "l_linestatus", "l_quantity")


def ks_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-39: prices by line status for each return flag."""
    rows = f.table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag", "l_extendedprice")
    return _rounded(stats.ks_statistic(rows, ["l_linestatus"], "l_extendedprice", "l_returnflag", "A", "R"), ("d",)).drop("p")


def _eye(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("trial_id").orderBy("ts", "event_id")
    rows = f.table(spark, sf_dir, "events").select(F.col("user_id").alias("trial_id"), "ts", "event_id", (F.col("value") / 50 - 5).alias("x"), (f.k_of() / 10.0 - 5).alias("y"))
    return rows.withColumn("i", F.row_number().over(order) - 1).drop("ts", "event_id")


_EYE = "eye AS (SELECT user_id AS trial_id, value / 50 - 5 AS x, CAST(json_extract(props, '$.k') AS INT) / 10.0::DOUBLE - 5 AS y, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)"


def gaze_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-22."""
    return c.density(_eye(spark, sf_dir), "x", "y", 40, 8.0)


def fixation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-33, OP-9: samples 5 to 25 of each user; users divisible by seven have no timing."""
    eye = _eye(spark, sf_dir)
    trials = f.table(spark, sf_dir, "events").select(F.col("user_id").alias("trial_id")).distinct().withColumn("onset_ms", F.when(F.col("trial_id") % 7 > 0, 10.0)).withColumn("duration_ms", F.lit(41.0)).withColumn("valid", F.lit(True))
    return c.fixation(trials, eye, 2.0, 5.0, 0.5).withColumn("ratio", F.round("ratio", 8))


CHUNK = 50


def _signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("session").orderBy("ts", "event_id")
    rows = f.table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), "ts", "event_id", "value").withColumn("i", F.row_number().over(order) - 1)
    return rows.groupBy("session", F.expr(f"i div {CHUNK}").alias("chunk_id")).agg(F.min("i").cast("long").alias("start_sample"), F.count("*").alias("n_samples"), F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda x: x["value"]).alias("data"))


def _onsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = f.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("session")).agg(F.count("*").alias("n"))
    return n.select("session", F.explode(F.sequence(F.lit(0), F.expr("n div 12"))).alias("trial_id")).select("session", "trial_id", F.when(F.col("trial_id") % 5 != 3, F.col("trial_id") * 12).alias("centre"))


_SIG = """sig AS (SELECT user_id AS session, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS s FROM events), sizes AS (SELECT session, count(*) AS n, var_pop(v) < 1e-6 AS dead FROM sig GROUP BY ALL),
ons AS (SELECT session, dead, n, CAST(t AS INT) AS trial_id, CASE WHEN t % 5 <> 3 THEN t * 12 END AS centre FROM sizes, LATERAL (SELECT unnest(range(0, n // 12 + 1)) AS t)),
win AS (SELECT o.session, trial_id, s - (centre - 5) AS o, v FROM ons o JOIN sig USING (session) WHERE centre - 5 >= 0 AND centre + 10 <= n AND s >= centre - 5 AND s < centre + 10),
zs AS (SELECT *, (v - avg(v) OVER w) / stddev_pop(v) OVER w AS z FROM win WINDOW w AS (PARTITION BY session, trial_id)),
st AS (SELECT *, z - lag(z) OVER (PARTITION BY session, trial_id ORDER BY o) AS step FROM zs WHERE z IS NOT NULL),
way AS (SELECT session, trial_id, arg_max(step, round(abs(step), 9) * 1000 - o / 1e9) AS w FROM st WHERE step IS NOT NULL GROUP BY ALL),
zz AS (SELECT st.*, CASE WHEN w < 0 THEN -z ELSE z END AS y FROM st JOIN way USING (session, trial_id)),
lev AS (SELECT session, 0.1 * avg(y) FILTER (o < 5) + 0.9 * avg(y) FILTER (o >= 7 AND o < 10) AS thr FROM zz GROUP BY ALL),
hit AS (SELECT session, trial_id, min(o - 5) FILTER (y > thr AND o >= 5) AS first, coalesce(bool_or(y > thr) FILTER (o < 5), false) AS early FROM zz JOIN lev USING (session) GROUP BY ALL)"""


def calibrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-4, SIG-7, SIG-8, WN-6, WN-7, AG-31, AG-32."""
    found = signal.calibrated(_signal(spark, sf_dir), _onsets(spark, sf_dir), ["session"], 5, 10, (2, 5), CHUNK, 2.0, -5.0)
    return found


def trace_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-34, SIG-7."""
    onsets = _onsets(spark, sf_dir).where("centre >= 5")
    rows = signal.windows(_signal(spark, sf_dir), onsets, ["session"], 5, 10, CHUNK)
    return _rounded(signal.band(rows, ["session"]), ("mean", "sd"))


def time_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-7, SIG-10: samples 30 to 69 of each user."""
    return signal.sliced(_signal(spark, sf_dir), 30, 70).select("session", F.posexplode("data").alias("i", "v"), "start_sample").select("session", (F.col("start_sample") + F.col("i")).alias("sample"), "v")


def smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIG-1, SIG-2: a kernel of five over chunks with halos."""
    out = signal.filtered(_signal(spark, sf_dir), ["session"], (0.1, 0.2, 0.4, 0.2, 0.1))
    return out.select("session", (F.col("chunk_id") * CHUNK).alias("s"), F.posexplode("data").alias("i", "v")).select("session", (F.col("s") + F.col("i")).alias("sample"), F.round("v", 7).alias("v"))


def common_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIG-3, SIG-6: the vectors' elements as channels, less the median of each sample."""
    rows = f.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("channel", "v")).withColumn("v", F.col("v").cast("double") * 20000)
    return signal.referenced(rows, ["vec_id"], "v").select("vec_id", "channel", signal.saturated_int16(F.round("v", 3)).cast("int").alias("v"))


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = f.table(spark, sf_dir, "part").where("p_partkey % 7 = 0")
    return rows.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_brand"), F.lit("*"))).alias("p_brand"), F.when(F.col("p_partkey") % 3 == 0, True).alias("visual"), (F.col("p_partkey") % 35 != 0).alias("keep"))


def apply_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-6, OP-12."""
    parts = f.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", (F.col("p_size") > 25).alias("visual"))
    return joins.update_join(parts, _updates(spark, sf_dir), "p_partkey", flags=("visual",))


def unknown_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-7: updates of parts that are not among the small ones."""
    return joins.unknown_updates(f.table(spark, sf_dir, "part").where("p_size <= 25"), _updates(spark, sf_dir), "p_partkey").select("p_partkey")


def stim_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-5: nations as the 1-based manifest of customers; 0 and unknown numbers have no name."""
    names = f.table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).alias("i"), "n_name")
    rows = f.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 30).cast("int").alias("stim_index"))
    return rows.join(names, rows["stim_index"] == names["i"], "left").select("c_custkey", "stim_index", F.coalesce("n_name", F.lit("")).alias("stim_name"))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-7, QC-4: customers declared against customers with orders."""
    found = f.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return joins.reconcile(f.table(spark, sf_dir, "customer").where("c_custkey % 11 > 0"), found, "c_custkey")


def verify_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-15, JN-16, OP-14: a copy of the documents with one in 97 altered and one in 101 missing."""
    rows = f.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    copy = rows.where("doc_id % 101 > 0").select("doc_id", F.when(F.col("doc_id") % 97 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")).alias("copy"))
    both = rows.join(copy, "doc_id", "full_outer")
    status = F.when(F.col("copy").isNull(), "missing").when((F.xxhash64("text") == F.xxhash64("copy")) & (F.col("text") == F.col("copy")), "equal").otherwise("differs")
    return both.groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


def units_per_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QC-5, QC-8, SRC-13: suppliers with lines of each nation, as units of a probe."""
    active = f.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    units = f.table(spark, sf_dir, "supplier").join(active, "s_suppkey").select(F.col("s_nationkey").alias("n_nationkey"))
    return s.units_per_probe(f.table(spark, sf_dir, "nation"), units, "n_nationkey")


QUERIES = {q.__name__: q for q in (quality_metrics, classify_units, threshold_labels, label_overlaps, unit_type_shares, metric_histogram, quantile_summary, ks_test, gaze_density, fixation, calibrate, trace_band, time_slice, smoothed, common_reference, apply_updates, unknown_updates, stim_names, reconcile, verify_copy, units_per_probe)}

SQL = {
    "quality_metrics": f"WITH {_METRICS} SELECT l_suppkey, n, " + ", ".join(f"round({m}, 7) AS {m}" for m in METRICS[1:]) + " FROM metrics",
    "classify_units": f"WITH {_METRICS}, {_CLASS} SELECT l_suppkey, unittype, CASE unittype WHEN 'SUA' THEN 1 WHEN 'MUA' THEN 2 ELSE 3 END AS number, CASE unittype WHEN 'SUA' THEN 'good' WHEN 'MUA' THEN 'mua' ELSE 'noise' END AS label FROM classed",
    "threshold_labels": f"WITH {_METRICS}, {_BOUNDS}, {_FAILED} SELECT m.l_suppkey, CASE WHEN bool_or(layer = 'NOISE') THEN 'NOISE' WHEN bool_or(layer = 'MUA') THEN 'MUA' ELSE 'SUA' END AS label FROM metrics m LEFT JOIN failed USING (l_suppkey) GROUP BY ALL",
    "label_overlaps": f"WITH {_METRICS}, {_BOUNDS}, {_FAILED} SELECT metrics, count(*) AS n_units FROM (SELECT l_suppkey, string_agg(DISTINCT metric, '+' ORDER BY metric) AS metrics FROM failed GROUP BY l_suppkey) GROUP BY ALL",
    "unit_type_shares": f"WITH {_METRICS}, {_CLASS} SELECT unittype, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 8) AS share FROM classed GROUP BY unittype",
    "metric_histogram": f"WITH {_METRICS}, e AS (SELECT min(amplitude_median) AS lo, max(amplitude_median) AS hi, least(30, greatest(5, count(*))) AS b FROM metrics) SELECT CAST(least(b - 1, floor((amplitude_median - lo) / ((hi - lo) / b))) AS INT) AS bin, count(*) AS n FROM metrics, e GROUP BY 1",
    "quantile_summary": "SELECT l_returnflag, CASE WHEN grouping(l_linestatus) = 1 THEN 'ALL' ELSE l_linestatus END AS l_linestatus, count(l_quantity) AS n, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.75) AS p75 FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag))",
    "ks_test": "WITH v AS (SELECT l_linestatus, l_extendedprice AS v, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'R') AS b FROM lineitem GROUP BY ALL), g AS (SELECT l_linestatus, a, b, abs(sum(a) OVER w / CAST(sum(a) OVER p AS DOUBLE) - sum(b) OVER w / CAST(sum(b) OVER p AS DOUBLE)) AS d FROM v WINDOW w AS (PARTITION BY l_linestatus ORDER BY v), p AS (PARTITION BY l_linestatus)) SELECT l_linestatus, round(max(d), 7) AS d, CAST(sum(a) AS BIGINT) AS n1, CAST(sum(b) AS BIGINT) AS n2 FROM g GROUP BY ALL",
    "gaze_density": f"WITH {_EYE} SELECT CAST(least(39, floor((x + 8) * 40 / 16)) AS INT) AS ix, CAST(least(39, floor((y + 8) * 40 / 16)) AS INT) AS iy, count(*) AS n FROM eye WHERE x BETWEEN -8 AND 8 AND y BETWEEN -8 AND 8 GROUP BY ALL",
    "fixation": f"WITH {_EYE}, r AS (SELECT trial_id, avg(CASE WHEN sqrt(x * x + y * y) < 5 THEN 1.0 ELSE 0.0 END) FILTER (trial_id % 7 > 0 AND i >= 5 AND i < 25) AS o, avg(CASE WHEN sqrt(x * x + y * y) < 5 THEN 1.0 ELSE 0.0 END) AS a FROM eye GROUP BY ALL) SELECT trial_id, round(coalesce(o, a), 8) AS ratio, coalesce(o, a) > 0.5 AS valid FROM r",
    "calibrate": f"WITH {_SIG}, j AS (SELECT o.session, o.trial_id, o.dead, CASE WHEN centre IS NULL OR centre - 5 < 0 OR centre + 10 > n THEN 2 WHEN first IS NULL THEN 3 WHEN early THEN 1 ELSE 0 END AS flag, first FROM ons o LEFT JOIN hit USING (session, trial_id)) SELECT session, trial_id, flag, CASE WHEN flag = 0 THEN first * 2.0 - 5.0 END AS latency_ms, dead FROM j",
    "trace_band": f"WITH {_SIG}, w2 AS (SELECT o.session, trial_id, s - (centre - 5) AS o, v FROM ons o JOIN sig USING (session) WHERE centre >= 5 AND s >= centre - 5 AND s < centre + 10) SELECT session, o AS offset, round(avg(v), 7) AS mean, round(stddev_pop(v), 7) AS sd, count(*) AS n FROM w2 GROUP BY ALL",
    "time_slice": f"WITH {_SIG} SELECT session, s AS sample, v FROM sig WHERE s >= 30 AND s < 70",
    "smoothed": f"WITH {_SIG} SELECT session, s AS sample, round(0.1 * lag(v, 2, 0.0) OVER w + 0.2 * lag(v, 1, 0.0) OVER w + 0.4 * v + 0.2 * lead(v, 1, 0.0) OVER w + 0.1 * lead(v, 2, 0.0) OVER w, 7) AS v FROM sig WINDOW w AS (PARTITION BY session ORDER BY s)",
    "common_reference": "WITH l AS (SELECT vec_id, CAST(i AS INT) AS channel, CAST(embedding[i + 1] AS DOUBLE) * 20000 AS v FROM embeddings, range(64) r(i)), m AS (SELECT vec_id, median(v) AS m FROM l GROUP BY ALL) SELECT vec_id, channel, CAST(greatest(-32768, least(32767, round_even(round(v - m, 3), 0))) AS INT) AS v FROM l JOIN m USING (vec_id)",
    "apply_updates": "SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_brand WHEN p_partkey % 2 = 0 THEN p_brand || '*' END AS p_brand, p_size, CASE WHEN p_partkey % 7 <> 0 THEN p_size > 25 ELSE p_partkey % 3 = 0 END AS visual FROM part WHERE p_partkey % 35 <> 0",
    "unknown_updates": "SELECT p_partkey FROM part WHERE p_partkey % 7 = 0 AND p_size > 25",
    "stim_names": "SELECT c_custkey, CAST(c_custkey % 30 AS INT) AS stim_index, coalesce(n_name, '') AS stim_name FROM customer LEFT JOIN nation ON n_nationkey + 1 = c_custkey % 30",
    "reconcile": "WITH d AS (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey % 11 > 0), o AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders) SELECT coalesce(d.c_custkey, o.c_custkey) AS c_custkey, CASE WHEN d.c_custkey IS NULL THEN 'found_only' ELSE 'declared_only' END AS side FROM d FULL JOIN o USING (c_custkey) WHERE d.c_custkey IS NULL OR o.c_custkey IS NULL",
    "verify_copy": "SELECT CASE WHEN doc_id % 101 = 0 THEN 'missing' WHEN doc_id % 97 = 0 THEN 'differs' ELSE 'equal' END AS status, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1",
    "units_per_probe": "SELECT n_nationkey, count(s_suppkey) AS n_units, CASE WHEN count(s_suppkey) > 0 THEN 'pass' ELSE 'warn' END AS status FROM nation LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)) ON s_nationkey = n_nationkey GROUP BY ALL",
}
