"""Queries over clocks, digital codes and trial matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import clocks, joins, trials
from . import fixtures as f

THRESHOLD, CHUNK = 1.5, 100


def _pulses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with an order of each priority; probe clocks are slower and jitter by the day."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("double")
    days = f.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("session"), day.alias("d")).distinct()
    streams = F.array(F.struct(F.lit("nidq").alias("stream"), F.col("d").alias("t")), F.struct(F.lit("imec0").alias("stream"), (F.col("d") * 1.00001 + 0.5 + (F.col("d") % 7) * 1e-5).alias("t")), F.struct(F.lit("imec1").alias("stream"), (F.col("d") * 0.9999 - 2.0).alias("t")))
    return days.select("session", F.explode(streams).alias("p")).select("session", "p.*")


_PULSES = """days AS (SELECT DISTINCT o_orderpriority AS session, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS d FROM orders),
pulses AS (SELECT session, 'nidq' AS stream, d AS t FROM days UNION ALL SELECT session, 'imec0', d * 1.00001::DOUBLE + 0.5::DOUBLE + (d % 7) * 1e-5 FROM days UNION ALL SELECT session, 'imec1', d * 0.9999::DOUBLE - 2.0::DOUBLE FROM days),
gaps AS (SELECT *, t - lag(t) OVER (PARTITION BY session, stream ORDER BY t) AS gap FROM pulses),
typical AS (SELECT session, stream, median(gap) AS m FROM gaps GROUP BY ALL),
holes AS (SELECT g.*, CAST(round_even(gap / m, 0) AS INT) - 1 AS n FROM gaps g JOIN typical USING (session, stream) WHERE gap > 1.5),
whole AS (SELECT session, stream, t, false AS added FROM pulses UNION ALL SELECT session, stream, t - gap + i * gap / (n + 1), true FROM holes, LATERAL (SELECT unnest(range(1, n + 1)) AS i) WHERE n >= 1)"""
_FITS = """numbered AS (SELECT *, row_number() OVER (PARTITION BY session, stream ORDER BY t) AS o, count(*) OVER (PARTITION BY session, stream) AS n FROM whole),
paired AS (SELECT a.session, a.stream, a.t AS x, b.t AS y, a.n, b.n AS nr FROM numbered a JOIN numbered b ON a.session = b.session AND a.o = b.o AND b.stream = 'nidq' WHERE a.stream <> 'nidq'),
fit AS (SELECT session, stream, count(*) AS pairs, any_value(n) AS n, any_value(nr) AS nr, CASE WHEN var_pop(x) > 0 THEN regr_slope(y, x) END AS a, CASE WHEN var_pop(x) > 0 THEN regr_intercept(y, x) END AS b FROM paired GROUP BY ALL),
residuals AS (SELECT session, stream, sqrt(avg((y - (a * x + b)) * (y - (a * x + b)))) * 1000 AS r FROM paired JOIN fit USING (session, stream) GROUP BY ALL)"""


def pulse_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-1, AG-35: count, longest and median gap of each train."""
    gaps = clocks.intervals(_pulses(spark, sf_dir))
    return gaps.groupBy("session", "stream").agg(F.count("*").alias("n"), F.round(F.max("gap"), 6).alias("longest"), F.round(F.median("gap"), 6).alias("typical"), F.count_if(F.col("gap") <= 0).alias("not_rising"))


def gap_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-2."""
    whole = clocks.repaired(_pulses(spark, sf_dir), THRESHOLD)
    return whole.groupBy("session", "stream").agg(F.count("*").alias("n"), F.count_if("added").alias("added"), F.round(F.sum("t"), 3).alias("sum_t"))


def _fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clocks.clock_fits(_pulses(spark, sf_dir), "nidq", THRESHOLD, 5.0)


def clock_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-1: JN-3, AG-28."""
    return _fits(spark, sf_dir).withColumns({"a": F.round("a", 7), "b": F.round("b", 4), "residual_ms": F.round("residual_ms", 3)})


def clock_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-3: the reference pulses in every probe's clock."""
    base = _pulses(spark, sf_dir).where("stream = 'nidq'").select("session", "t")
    out = clocks.transformed(base, _fits(spark, sf_dir), inverse=True)
    return out.groupBy("session", "stream").agg(F.count("*").alias("n"), F.round(F.avg("t_out"), 4).alias("mean_t"))


CODE = {"signup": 1, "error": 2, "click": 4, "view": 8, "purchase": 16}


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.create_map(*(F.lit(x) for kv in CODE.items() for x in kv)), F.col("event_type"))
    return f.table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), "event_id", f.micros("ts").alias("t_us"), code.alias("code"))


_CODES = "codes AS (SELECT user_id AS session, event_id, epoch_us(ts) AS t_us, CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN 2 WHEN 'click' THEN 4 WHEN 'view' THEN 8 WHEN 'purchase' THEN 16 END AS code FROM events), bhv AS (SELECT * FROM codes WHERE event_id % 10 <> 0)"


def _behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes(spark, sf_dir).where("event_id % 10 <> 0")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each user in order of time, CHUNK to a row."""
    order = Window.partitionBy("session").orderBy("ts", "event_id")
    rows = f.table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), "ts", "event_id", f.k_of().alias("w"))
    rows = rows.withColumn("i", F.row_number().over(order) - 1).withColumn("chunk_id", F.expr(f"i div {CHUNK // 4}"))
    data = F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"])
    return rows.groupBy("session", "chunk_id").agg(F.min("i").cast("long").alias("start_sample"), data.alias("data"))


_SAMPLES = "samples AS (SELECT user_id AS session, CAST(json_extract(props, '$.k') AS INT) AS w, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sample FROM events)"


def bit_repack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-1: bits 6, 0 and 3 of the word."""
    return f.table(spark, sf_dir, "events").select("event_id", trials.repacked(f.k_of(), (6, 0, 3)).alias("code"))


def rising_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-2."""
    return trials.rising_edges(_chunks(spark, sf_dir), 3).select("session", "sample")


def code_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-2, FLT-3."""
    return trials.code_changes(_chunks(spark, sf_dir), (6, 5, 3)).withColumnRenamed("value", "code")


def trial_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-29: per user, against the thinned behaviour side."""
    n = _behaviour(spark, sf_dir).groupBy("session").agg(F.count_if(F.col("code") == 1).alias("n"))
    return trials.trial_bit(_codes(spark, sf_dir), n, 2)


def stim_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-30: against the full count of clicks of users with an even id, one less for the others."""
    n = _codes(spark, sf_dir).groupBy("session").agg((F.count_if(F.col("code") == 4) - F.col("session") % 2).alias("n"))
    return trials.stim_bit(_codes(spark, sf_dir), n, n.select("session", F.lit(0).alias("bit")))


def edges_in_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-2, WN-5: each click and the signup that began last."""
    codes = _codes(spark, sf_dir)
    starts = codes.where("code = 1").select("session", F.col("event_id").alias("trial_id"), F.col("t_us").alias("start_us"))
    return joins.anchor_before(codes.where("code = 4").select("session", "event_id", "t_us"), starts, ["session"], "t_us", "trial_id", "start_us")


def ordinal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-3, ST-2: k-th behaviour signup to the k-th coded one, both cut to the shorter."""
    a = _behaviour(spark, sf_dir).where("code = 1").select("session", F.col("event_id").alias("bhv_id"), F.col("t_us").alias("bhv_us"))
    b = _codes(spark, sf_dir).where("code = 1").select("session", F.col("event_id").alias("code_id"), F.col("t_us").alias("code_us"))
    return trials.truncated(a, b, ["session"], ["bhv_us"], ["code_us"], 1).select("session", "ord", "bhv_id", "code_id", "status")


def _match(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    codes, given = _codes(spark, sf_dir), _behaviour(spark, sf_dir)
    starts = codes.where("code = 1").select("session", F.col("event_id").alias("trial_id"), "t_us")
    stims = joins.anchor_before(given.where("code = 4").select("session", F.col("event_id").alias("stim"), "t_us"), starts.withColumnRenamed("t_us", "s"), ["session"], "t_us", "trial_id", "s")
    stims = stims.where("trial_id IS NOT NULL").select("session", "trial_id", "stim", F.col("t_us").alias("order_key"))
    return starts, trials.matched_in_trial(stims, codes.where("code = 4").select("session", "t_us"), starts, 1)


def match_in_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-4."""
    return _match(spark, sf_dir)[1]


def trial_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-3: a row per stimulus; trials without one stay."""
    starts, matched = _match(spark, sf_dir)
    return trials.expanded(starts.select("session", "trial_id", F.col("t_us").alias("start_us")), matched)


def events_per_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-20."""
    found = edges_in_trials(spark, sf_dir).where("trial_id IS NOT NULL").groupBy("session", "trial_id").agg(F.count("*").alias("n_events"))
    return found.groupBy("n_events").agg(F.count("*").alias("n_trials"))


def monotonic_onsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QC-7: on the times by value of the event's number, which is in order, and by its word, which is not."""
    rows = f.table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), "event_id", f.k_of().alias("k"))
    return trials.reversals(rows, ["session"], "event_id", "k")


def event_code_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1: nested turns of conversations, exploded and filtered on one role."""
    nested = f.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("events"))
    return nested.select(F.col("conv_id").alias("trial_id"), F.explode("events").alias("e")).where("e.role = 'assistant'").select("trial_id", F.col("e.turn").alias("time"))


QUERIES = {q.__name__: q for q in (pulse_intervals, gap_repair, clock_fit, clock_transform, bit_repack, rising_edges, code_changes, trial_bit, stim_bit, edges_in_trials, ordinal_pairs, match_in_trial, trial_rows, events_per_trial, monotonic_onsets, event_code_times)}

_BITS = lambda w, bits: " + ".join(f"((({w} >> {b}) & 1) << {i})" for i, b in enumerate(bits))
_EDGES = "starts AS (SELECT session, event_id AS trial_id, t_us AS s FROM codes WHERE code = 1), placed AS (SELECT c.session, c.event_id, c.t_us, s.trial_id FROM (SELECT * FROM codes WHERE code = 4) c ASOF LEFT JOIN starts s ON c.session = s.session AND c.t_us >= s.s)"
_MATCH = """given AS (SELECT b.session, s.trial_id, b.event_id AS stim, b.t_us AS g FROM (SELECT * FROM bhv WHERE code = 4) b ASOF JOIN starts s ON b.session = s.session AND b.t_us >= s.s),
gn AS (SELECT *, row_number() OVER (PARTITION BY session, trial_id ORDER BY g) AS j, count(*) OVER (PARTITION BY session, trial_id) AS ng FROM given),
en AS (SELECT *, row_number() OVER (PARTITION BY session, trial_id ORDER BY t_us) AS j, count(*) OVER (PARTITION BY session, trial_id) AS ne FROM placed WHERE trial_id IS NOT NULL),
sizes AS (SELECT DISTINCT session, trial_id, ne FROM en),
matched AS (SELECT gn.session, gn.trial_id, stim, gn.j, CASE WHEN abs(ng - coalesce(sizes.ne, 0)) <= 1 THEN en.t_us END AS t_us FROM gn LEFT JOIN en USING (session, trial_id, j) LEFT JOIN sizes ON sizes.session = gn.session AND sizes.trial_id = gn.trial_id)"""

SQL = {
    "pulse_intervals": f"WITH {_PULSES} SELECT session, stream, count(*) AS n, round(max(gap), 6) AS longest, round(median(gap), 6) AS typical, count(*) FILTER (gap <= 0) AS not_rising FROM gaps GROUP BY ALL",
    "gap_repair": f"WITH {_PULSES} SELECT session, stream, count(*) AS n, count(*) FILTER (added) AS added, round(sum(t), 3) AS sum_t FROM whole GROUP BY ALL",
    "clock_fit": f"WITH {_PULSES}, {_FITS} SELECT session, stream, round(CASE WHEN n = nr THEN a END, 7) AS a, round(CASE WHEN n = nr THEN b END, 4) AS b, round(r, 3) AS residual_ms, (SELECT count(*) FILTER (added) FROM whole w WHERE w.session = fit.session AND w.stream IN (fit.stream, 'nidq')) AS n_repaired, CASE WHEN pairs < 2 THEN 'too_few_pulses' WHEN n <> nr THEN 'counts_differ' WHEN r > 5 THEN 'residual_too_large' ELSE 'ok' END AS status FROM fit JOIN residuals USING (session, stream)",
    "clock_transform": f"WITH {_PULSES}, {_FITS} SELECT p.session, fit.stream, count(*) AS n, round(avg(CASE WHEN fit.n = nr THEN (t - b) / a END), 4) AS mean_t FROM pulses p JOIN fit ON fit.session = p.session WHERE p.stream = 'nidq' GROUP BY ALL",
    "bit_repack": f"SELECT event_id, {_BITS('k', (6, 0, 3))} AS code FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)",
    "rising_edges": f"WITH {_SAMPLES} SELECT session, sample FROM (SELECT *, (w >> 3) & 1 AS b, lag((w >> 3) & 1) OVER (PARTITION BY session ORDER BY sample) AS p FROM samples) WHERE b = 1 AND p = 0",
    "code_changes": f"WITH {_SAMPLES} SELECT session, sample, c AS code FROM (SELECT *, lag(c) OVER (PARTITION BY session ORDER BY sample) AS p FROM (SELECT *, {_BITS('w', (6, 5, 3))} AS c FROM samples)) WHERE c <> p",
    "trial_bit": f"WITH {_CODES}, n AS (SELECT session, count(*) FILTER (code = 1) AS n FROM bhv GROUP BY ALL), c AS (SELECT n.session, n, CAST(b.range AS INT) AS bit, (SELECT count(*) FROM codes WHERE codes.session = n.session AND code = CAST(1 << b.range AS INT)) AS codes FROM n, range(8) b) SELECT session, bit, codes, CASE WHEN abs(codes - n) <= 2 THEN 'ok' ELSE 'no_bit' END AS status FROM c QUALIFY row_number() OVER (PARTITION BY session ORDER BY abs(codes - n), bit) = 1",
    "stim_bit": f"WITH {_CODES}, n AS (SELECT session, count(*) FILTER (code = 4) - session % 2 AS n FROM codes GROUP BY session), c AS (SELECT session, CAST(log2(code) AS INT) AS bit, count(*) AS codes FROM codes GROUP BY ALL) SELECT n.session, coalesce(min(bit), -1) AS bit FROM n LEFT JOIN c ON c.session = n.session AND codes = n AND bit <> 0 GROUP BY n.session",
    "edges_in_trials": f"WITH {_CODES}, {_EDGES} SELECT session, event_id, t_us, trial_id FROM placed",
    "ordinal_pairs": f"WITH {_CODES}, a AS (SELECT session, event_id AS bhv_id, row_number() OVER w AS ord, count(*) OVER (PARTITION BY session) AS n FROM bhv WHERE code = 1 WINDOW w AS (PARTITION BY session ORDER BY t_us)), b AS (SELECT session, event_id AS code_id, row_number() OVER w AS ord, count(*) OVER (PARTITION BY session) AS m FROM codes WHERE code = 1 WINDOW w AS (PARTITION BY session ORDER BY t_us)) SELECT session, ord, bhv_id, code_id, CASE WHEN abs(n - m) <= 1 THEN 'ok' ELSE 'counts_differ' END AS status FROM a JOIN b USING (session, ord)",
    "match_in_trial": f"WITH {_CODES}, {_EDGES}, {_MATCH} SELECT session, trial_id, stim, j, t_us FROM matched",
    "trial_rows": f"WITH {_CODES}, {_EDGES}, {_MATCH} SELECT s.session, s.trial_id, s.s AS start_us, stim, j, t_us FROM starts s LEFT JOIN matched m ON m.session = s.session AND m.trial_id = s.trial_id",
    "events_per_trial": f"WITH {_CODES}, {_EDGES} SELECT n_events, count(*) AS n_trials FROM (SELECT session, trial_id, count(*) AS n_events FROM placed WHERE trial_id IS NOT NULL GROUP BY ALL) GROUP BY ALL",
    "monotonic_onsets": "SELECT session, count(*) AS n, count(*) FILTER (d <= 0) AS reversals FROM (SELECT user_id AS session, CAST(json_extract(props, '$.k') AS INT) - lag(CAST(json_extract(props, '$.k') AS INT)) OVER (PARTITION BY user_id ORDER BY event_id) AS d FROM events) GROUP BY ALL",
    "event_code_times": "SELECT conv_id AS trial_id, turn AS time FROM conversations WHERE role = 'assistant'",
}
