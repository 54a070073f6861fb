"""Queries for exports, templates, summaries and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import population, signal
from ..operators import projections as p
from ..operators import sweeps
from . import curations, event_locked, populations
from . import fixtures as f


def json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4: the events' properties in long form."""
    rows = f.table(spark, sf_dir, "events").select("event_id", F.explode(p.json_map(F.col("props"))).alias("key", "value"))
    return rows


def marker_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-11, AG-42: by each user's number of events."""
    from pyspark.sql import Window

    rates = f.table(spark, sf_dir, "events").groupBy((F.col("user_id") % 7).alias("probe"), "user_id").agg(F.count("*").alias("n"))
    top = F.max("n").over(Window.partitionBy("probe"))
    return rates.withColumn("size", F.round(p.marker_size(F.col("n"), top, 4.0, 40.0), 7))


def region_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-13: customers' market segments in the order of their keys, by nation."""
    rows = p.region_key(f.table(spark, sf_dir, "customer"), ["c_nationkey"], "c_custkey", "c_mktsegment")
    return rows.select("c_nationkey", F.md5(F.col("region").cast("binary")).alias("digest"), F.length("region").alias("size"))


def safe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-14: the number at the end of a brand where there is one after the third letter."""
    return f.table(spark, sf_dir, "part").select("p_partkey", p.safe_id(F.substring("p_brand", 7, 9), F.col("p_partkey")).alias("id"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.table(spark, sf_dir, "embeddings")


def unit_prop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-7, WN-4."""
    rows = p.unit_prop(_vectors(spark, sf_dir), "label", "vec_id", "embedding")
    return rows.select("label", "row", "ks_id", F.round(F.col("unit_pos")[0].cast("double"), 6).alias("x"), F.round(F.col("unit_pos")[1].cast("double"), 6).alias("y"))


def trial_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-8."""
    return p.trial_record(f.onsets(spark, sf_dir))


def new_unit_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-19: users as units of two probes."""
    units = f.spikes(spark, sf_dir).select("probe", "unit_id").distinct()
    return p.new_ids(units, "probe", "unit_id")


def peak_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-15, PRJ-16: place of the greatest element and the sum of what is around it."""
    at = p.peak(F.col("embedding"))
    rows = _vectors(spark, sf_dir).withColumn("peak", at)
    part = p.cropped(F.col("embedding"), F.col("peak"), 3, 5)
    return rows.select("vec_id", "peak", F.size(part).alias("n"), F.round(F.aggregate(part, F.lit(0.0), lambda s, v: s + v.cast("double")), 5).alias("total"))


def mean_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-24."""
    rows = p.mean_template(_vectors(spark, sf_dir), "label", "embedding")
    return rows.withColumn("mean", F.round("mean", 6))


def psth_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-14."""
    parts = sweeps.bin_parts(f.spikes(spark, sf_dir), f.onsets(spark, sf_dir), f.PRE, sweeps.bin_edges(f.PRE, f.POST, f.BIN), by=p.half(0))
    return p.courses_reliability(parts, f.BINS).withColumn("r", F.round("r", 6))


def paired_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-40: units' reliability in even and in odd vectors."""
    rows = populations._rows(spark, sf_dir)
    a, b = (population.unit_reliability(rows.where(F.col("trial") % 2 == i), (0,), 5).select("unit", F.col("reliability").alias(n)) for i, n in ((0, "a"), (1, "b")))
    return a.join(b, "unit").agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n"), F.round(stats.safe_corr(F.col("a"), F.col("b")), 5).alias("r"))


def first_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-47: the first event type, other than a signup, of each user."""
    rows = f.table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") != "signup", F.col("event_type")).otherwise("").alias("name"))
    return p.first_name(rows, ["user_id"], "name", "event_id")


def median_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-3, AG-18."""
    rows = f.table(spark, sf_dir, "events").select("user_id", "value", f.k_of().cast("double").alias("k"))
    return p.median_window(rows, ["user_id"], "value", "k").withColumns({c: F.round(c, 6) for c in ("window", "longest")})


def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-45, AG-48."""
    onsets, spikes = f.onsets(spark, sf_dir), f.spikes(spark, sf_dir)
    t = onsets.groupBy("session").agg(F.count("*").alias("n_trials"), F.count_if(~F.coalesce("valid", F.lit(True))).alias("n_invalid"), F.countDistinct("stim_index").alias("n_stims"))
    u = spikes.groupBy("session").agg(F.count("*").alias("n_spikes"), F.countDistinct("probe", "unit_id").alias("n_units"))
    return t.join(u, "session")


def realigned_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-18: traces around the onsets moved by half a sample and by two."""
    onsets = curations._onsets(spark, sf_dir).where("centre >= 5")
    rows = signal.windows(curations._signal(spark, sf_dir), onsets, ["session"], 5, 10, curations.CHUNK)
    moved = onsets.select("session", "trial_id", F.when(F.col("trial_id") % 2 == 0, 0.5).otherwise(2.0).alias("latency"))
    return signal.realigned(rows, moved, ["session"]).withColumn("v", F.round("v", 6))


def run_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST-4, ST-6, ST-7, ST-8: sizes of union, intersection and differences of two months' users."""
    rows = f.table(spark, sf_dir, "events").select("user_id", "event_type")
    a, b = (rows.where(F.col("event_type") == x).select("user_id") for x in ("signup", "purchase"))
    sets = {"union": a.unionByName(b), "distinct": a.unionByName(b).distinct(), "both": a.intersect(b), "first_only": a.exceptAll(b), "second_only": b.join(a, "user_id", "left_anti")}
    parts = [df.groupBy().agg(F.lit(name).alias("kind"), F.count("*").alias("n"), F.sum("user_id").alias("total")) for name, df in sets.items()]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


QUERIES = {q.__name__: q for q in (json_map, marker_sizes, region_keys, safe_ids, unit_prop, trial_record, new_unit_ids, peak_channels, mean_templates, psth_reliability, paired_reliability, first_names, median_windows, session_summary, realigned_traces, run_union)}

_REL = """t{i} AS (SELECT DISTINCT stim, trial FROM long WHERE trial % 2 = {i}), n{i} AS (SELECT *, row_number() OVER (PARTITION BY stim ORDER BY md5('0:' || trial), trial) AS rn, count(*) OVER (PARTITION BY stim) AS c FROM t{i}),
h{i} AS (SELECT unit, stim, avg(value) FILTER (rn <= c // 2) AS a, avg(value) FILTER (rn > c // 2) AS b FROM long JOIN n{i} USING (stim, trial) GROUP BY ALL),
r{i} AS (SELECT unit, CASE WHEN r > -1 AND r <> 0 THEN 2 * r / (1 + r) END AS r FROM (SELECT unit, CASE WHEN count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) >= 5 THEN corr(a, b) END AS r FROM h{i} GROUP BY ALL))"""

SQL = {
    "json_map": "SELECT event_id, 'k' AS key, CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events",
    "marker_sizes": "WITH c AS (SELECT user_id % 7 AS probe, user_id, count(*) AS n FROM events GROUP BY ALL) SELECT *, round(4.0 + 36.0 * ln(1 + n) / ln(1 + max(n) OVER (PARTITION BY probe)), 7) AS size FROM c",
    "region_keys": "SELECT c_nationkey, md5(r) AS digest, CAST(length(r) AS INT) AS size FROM (SELECT c_nationkey, string_agg(c_mktsegment, '-' ORDER BY c_custkey) AS r FROM customer GROUP BY c_nationkey)",
    "safe_ids": "SELECT p_partkey, coalesce(TRY_CAST(substr(p_brand, 7, 9) AS BIGINT), p_partkey) AS id FROM part",
    "unit_prop": "SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS row, vec_id AS ks_id, round(CAST(embedding[1] AS DOUBLE), 6) AS x, round(CAST(embedding[2] AS DOUBLE), 6) AS y FROM embeddings",
    "trial_record": f"WITH {f.ONSETS_SQL} SELECT trial_id, t_us, stim_index, '' AS stim_name, coalesce(valid, true) AS fix_success FROM onsets",
    "new_unit_ids": f"WITH {f.SPIKES_SQL} SELECT probe, unit_id, row_number() OVER (ORDER BY probe, unit_id) AS new_id, 'UNCLASSIFIED' AS unittype, CAST(NULL AS DOUBLE) AS score FROM (SELECT DISTINCT probe, unit_id FROM spikes)",
    "peak_channels": "WITH l AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, range(64) r(i)), k AS (SELECT vec_id, i AS peak FROM l QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY abs(v) DESC, i) = 1) SELECT vec_id, CAST(peak AS INT) AS peak, count(*) AS n, round(sum(v), 5) AS total FROM l JOIN k USING (vec_id) WHERE i >= peak - 3 AND i < peak + 5 GROUP BY vec_id, peak",
    "mean_templates": f"WITH {populations._ROWS} SELECT stim AS label, unit AS sample, round(avg(value), 6) AS mean, count(*) AS n FROM long GROUP BY ALL",
    "psth_reliability": f"""{f.WITH_CELLS}, h AS (SELECT {event_locked.UNIT}, bin, sum(CASE WHEN CAST('0x' || substr(md5('0:' || trial_id), 1, 1) AS INT) % 2 = 0 THEN n ELSE 0 END) AS a, sum(CASE WHEN CAST('0x' || substr(md5('0:' || trial_id), 1, 1) AS INT) % 2 = 1 THEN n ELSE 0 END) AS b FROM cells GROUP BY ALL),
      g AS (SELECT u.*, CAST(range AS INT) AS bin FROM (SELECT DISTINCT {event_locked.UNIT} FROM h) u, range({f.BINS})), full_ AS (SELECT g.*, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM g LEFT JOIN h USING (session, probe, unit_id, bin))
      SELECT session, probe, unit_id, round(CASE WHEN var_pop(a) > 1e-18 AND var_pop(b) > 1e-18 THEN corr(a, b) END, 6) AS r FROM full_ GROUP BY ALL""",
    "paired_reliability": f"WITH {populations._ROWS}, {_REL.format(i=0)}, {_REL.format(i=1)} SELECT count(*) FILTER (a.r IS NOT NULL AND b.r IS NOT NULL) AS n, round(corr(a.r, b.r), 5) AS r FROM r0 a JOIN r1 b USING (unit)",
    "first_names": "SELECT user_id, arg_min(event_type, event_id) FILTER (event_type <> 'signup') AS name, count(DISTINCT event_type) FILTER (event_type <> 'signup') > 1 AS varies FROM events GROUP BY ALL",
    "median_windows": "SELECT user_id, round(median(value) + median(k), 6) AS \"window\", round(max(value + k), 6) AS longest FROM (SELECT user_id, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY user_id",
    "session_summary": f"WITH {f.SPIKES_SQL}, {f.ONSETS_SQL}, t AS (SELECT session, count(*) AS n_trials, count(*) FILTER (NOT coalesce(valid, true)) AS n_invalid, count(DISTINCT stim_index) AS n_stims FROM onsets GROUP BY ALL), u AS (SELECT session, count(*) AS n_spikes, count(DISTINCT unit_id) AS n_units FROM spikes GROUP BY ALL) SELECT * FROM t JOIN u USING (session)",
    "realigned_traces": f"WITH {curations._SIG}, w2 AS (SELECT o.session, trial_id, s - (centre - 5) AS o, v FROM ons o JOIN sig USING (session) WHERE centre >= 5 AND s >= centre - 5 AND s < centre + 10), n AS (SELECT *, lead(v) OVER (PARTITION BY session, trial_id ORDER BY o) AS nx FROM w2) SELECT session, trial_id, CAST(CASE WHEN trial_id % 2 = 0 THEN o ELSE o - 2 END AS INT) AS offset, round(CASE WHEN trial_id % 2 = 0 THEN v * 0.5 + nx * 0.5 ELSE v END, 6) AS v FROM n WHERE trial_id % 2 = 0 OR o >= 2",
    "run_union": "WITH a AS (SELECT user_id FROM events WHERE event_type = 'signup'), b AS (SELECT user_id FROM events WHERE event_type = 'purchase'), s AS (SELECT 'union' AS kind, user_id FROM a UNION ALL SELECT 'union', user_id FROM b UNION ALL SELECT 'distinct', user_id FROM (SELECT user_id FROM a UNION SELECT user_id FROM b) UNION ALL SELECT 'both', user_id FROM (SELECT user_id FROM a INTERSECT SELECT user_id FROM b) UNION ALL SELECT 'first_only', user_id FROM (SELECT user_id FROM a EXCEPT ALL SELECT user_id FROM b) UNION ALL SELECT 'second_only', user_id FROM b WHERE user_id NOT IN (SELECT user_id FROM a)), k AS (SELECT unnest(['union', 'distinct', 'both', 'first_only', 'second_only']) AS kind) SELECT kind, count(user_id) AS n, CAST(sum(user_id) AS BIGINT) AS total FROM k LEFT JOIN s USING (kind) GROUP BY kind",
}
