"""Queries over spikes around onsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import raster as r
from ..operators import sweeps
from . import fixtures as f
from .fixtures import BIN, BINS, POST, PRE, PRE_BINS, WITH_CELLS

BIN_S = BIN / 1e6
UNIT = "session, probe, unit_id"
#: Bins of the response window that rates are taken over.
FIRST, LAST = 6, 24
WINDOW_S = (LAST - FIRST) * BIN_S


def _of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    return f.spikes(spark, sf_dir), f.onsets(spark, sf_dir), PRE


#: Bounds of the raster's bins and of the response window, from the windows' start.
EDGES, WINDOW = sweeps.bin_edges(PRE, POST, BIN), [FIRST * BIN, LAST * BIN]


def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-1: how many spikes each unit has beside all onsets."""
    return sweeps.window_sums(*_of(spark, sf_dir), POST)


def event_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-1."""
    return r.raster(*_of(spark, sf_dir), POST, BIN)


def export_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-2: valid trials only; a trial whose validity is missing is left out."""
    onsets = f.onsets(spark, sf_dir).where(F.col("valid").eqNullSafe(True))
    return r.raster(f.spikes(spark, sf_dir), onsets, PRE, POST, BIN)


def probe_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-2, FLT-4: onsets in two clocks, of which imec0 lacks those of stimulus 3; the first valid trial of a session sets the length."""
    clocks = F.create_map(F.lit("imec0"), F.when(F.col("stim_index") != 3, F.col("t_us")), F.lit("imec1"), F.col("t_us") + 20_000)
    trials = f.onsets(spark, sf_dir).withColumns({"onsets": clocks, "onset_us": (F.col("trial_id") % 3 + 20) * BIN + 7, "offset_us": F.lit(5 * BIN)})
    return r.probe_rasters(f.spikes(spark, sf_dir), trials, PRE, BIN)


def psth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-5, OP-6."""
    sums = sweeps.by_bin(sweeps.bin_sums(*_of(spark, sf_dir), EDGES, r.MOST))
    return r.course_rates(sums, r.trial_counts(f.onsets(spark, sf_dir)), BIN_S).withColumn("rate_hz", F.round("rate_hz", 9))


def psth_preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-6: each unit's rate course for its preferred stimulus and the mean course over stimuli."""
    onsets = f.onsets(spark, sf_dir)
    sums = sweeps.bin_sums(*_of(spark, sf_dir), EDGES, r.MOST, F.col("stim_index"))
    found = r.preferred_courses(sums.withColumn("by", F.col("by").cast("int")), onsets, BINS, FIRST, LAST, BIN_S)
    return found.withColumns({c: F.round(c, 8) for c in ("preferred_hz", "mean_hz")})


def rebinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-17: four bins to one."""
    return sweeps.cells(*_of(spark, sf_dir), EDGES[: BINS // 4 * 4 + 1 : 4])


def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-7."""
    return sweeps.cells(*_of(spark, sf_dir), WINDOW, also={"rate_hz": F.round(F.col("n") / WINDOW_S, 9)}).drop("bin")


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    spikes, onsets, _ = _of(spark, sf_dir)
    hit = sweeps.bin_sums(spikes, onsets, PRE, WINDOW, by=F.col("stim_index"))
    return r.rates_of(hit.select(*r.UNIT, F.col("by").cast("int").alias("stim_index"), F.col("n")[0].alias("n")), onsets, WINDOW_S, spikes)


def stim_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-8."""
    return _rates(spark, sf_dir).withColumn("rate_hz", F.round("rate_hz", 9))


def unit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-11, AG-42."""
    found = r.stats_of(sweeps.histogram(*_of(spark, sf_dir), [tuple(WINDOW)]), r.trial_counts(f.onsets(spark, sf_dir)), f.spikes(spark, sf_dir))
    return found.withColumns({c: F.round(c, 8) for c in ("mean_count", "snr")})


def selectivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-12."""
    return r.selectivity(_rates(spark, sf_dir)).withColumn("selectivity", F.round("selectivity", 8))


def consistency_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-16."""
    found = r.swept_consistency(*_of(spark, sf_dir), POST, BIN)
    return found.withColumn("score", F.round("score", 9))


def responsiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-17."""
    found = r.swept_responsiveness(*_of(spark, sf_dir), POST, BIN)
    return found.withColumns({c: F.round(c, 7) for c in ("mean_base", "mean_response", "z")})


def top_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-7, WN-8: the five first units of each probe."""
    scores = r.score_units(*_of(spark, sf_dir), POST, BIN).withColumn("score", F.round("score", 9))
    return r.top_units(scores, 5).select(*r.UNIT, "responsive", "score", "rank")


def stim_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-19: valid trials per stimulus; missing validity counts as valid here."""
    return r.stim_coverage(f.onsets(spark, sf_dir))


def raster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-4: share of empty cells of each probe's raster and the layout it asks for."""
    filled = sweeps.bin_sums(*_of(spark, sf_dir), EDGES, 1).withColumn("filled", F.aggregate("n", F.lit(0).cast("long"), lambda x, v: x + v))
    return r.layouts(filled, r.trial_counts(f.onsets(spark, sf_dir)), BINS).withColumn("zero_share", F.round("zero_share", 9))


def valid_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-4: the three readings of a missing validity."""
    v = F.col("valid")
    return f.onsets(spark, sf_dir).agg(F.count_if(v.eqNullSafe(True)).alias("strict"), F.count_if(F.coalesce(v, F.lit(True))).alias("missing_is_valid"), F.count_if(v.isNull()).alias("missing"))


QUERIES = {q.__name__: q for q in (range_join, event_raster, export_raster, probe_rasters, psth, psth_preferred, rebinned, window_counts, stim_rates, unit_stats, selectivity, consistency_score, responsiveness, top_units, stim_coverage, raster_stats, valid_filters)}

_COUNTS = f"counts AS (SELECT {UNIT}, trial_id, sum(n) AS n FROM cells WHERE bin >= {FIRST} AND bin < {LAST} GROUP BY ALL)"
_RATES = f"""rates AS (SELECT u.session, u.probe, u.unit_id, p.stim_index, p.trials, coalesce(h.n, 0) / (p.trials * {WINDOW_S}) AS rate_hz
  FROM (SELECT DISTINCT {UNIT} FROM spikes) u JOIN (SELECT session, stim_index, count(*) AS trials FROM onsets GROUP BY ALL) p USING (session)
  LEFT JOIN (SELECT c.session, probe, unit_id, stim_index, sum(n) AS n FROM counts c JOIN onsets USING (session, trial_id) GROUP BY ALL) h USING (session, probe, unit_id, stim_index))"""
_TRIALS = "per_session AS (SELECT session, count(*) AS n_trials FROM onsets GROUP BY ALL)"
_SCORE = f"""{_TRIALS}, grid AS (SELECT t.*, coalesce(c.n, 0) AS n, b.bin FROM (SELECT DISTINCT {UNIT}, trial_id FROM cells) t CROSS JOIN (SELECT CAST(range AS INT) AS bin FROM range({BINS})) b
    LEFT JOIN cells c ON c.unit_id = t.unit_id AND c.probe = t.probe AND c.trial_id = t.trial_id AND c.bin = b.bin),
  ranked AS (SELECT *, rank() OVER (PARTITION BY unit_id, trial_id ORDER BY n) + (count(*) OVER (PARTITION BY unit_id, trial_id, n) - 1) / 2.0 - {(BINS + 1) / 2} AS d FROM grid),
  lengths AS (SELECT unit_id, trial_id, sqrt(sum(d * d)) AS norm FROM ranked GROUP BY ALL HAVING sum(d * d) > 1e-9),
  sums AS (SELECT unit_id, bin, sum(d / norm) AS s FROM ranked JOIN lengths USING (unit_id, trial_id) GROUP BY ALL),
  scored AS (SELECT unit_id, sum(s * s) AS q FROM sums GROUP BY ALL),
  varied AS (SELECT unit_id, count(*) AS m FROM lengths GROUP BY ALL),
  gate AS (SELECT {UNIT}, sum(CASE WHEN bin < {PRE_BINS} THEN n ELSE 0 END) / {PRE_BINS}.0 AS b, sum(CASE WHEN bin >= {PRE_BINS} THEN n ELSE 0 END) / {BINS - PRE_BINS}.0 AS r FROM cells GROUP BY ALL),
  consistent AS (SELECT {UNIT}, round(CASE WHEN n_trials >= 5 AND r > b AND m >= 2 THEN (q - m) / (m * (m - 1.0)) END, 9) AS score
    FROM gate JOIN per_session USING (session) LEFT JOIN scored USING (unit_id) LEFT JOIN varied USING (unit_id))"""
_TEST = f"""sides AS (SELECT {UNIT}, trial_id, sum(CASE WHEN bin < {PRE_BINS} THEN n ELSE 0 END) AS b, sum(CASE WHEN bin >= {PRE_BINS} THEN n ELSE 0 END) AS r FROM cells GROUP BY ALL),
  units AS (SELECT DISTINCT {UNIT} FROM cells),
  trials AS (SELECT u.*, o.trial_id, coalesce(b, 0) AS b, coalesce(r, 0) AS r FROM units u JOIN onsets o USING (session) LEFT JOIN sides s USING (session, probe, unit_id, trial_id)),
  pooled AS (SELECT {UNIT}, 0 AS side, b AS v FROM trials UNION ALL SELECT {UNIT}, 1, r FROM trials),
  ranks AS (SELECT *, rank() OVER (PARTITION BY unit_id ORDER BY v) + (count(*) OVER (PARTITION BY unit_id, v) - 1) / 2.0 AS rk FROM pooled),
  ties AS (SELECT unit_id, sum(CAST(t AS DOUBLE) * t * t - t) AS ties, max(t) AS most FROM (SELECT unit_id, v, count(*) AS t FROM pooled GROUP BY ALL) GROUP BY ALL),
  stats AS (SELECT {UNIT}, count(*) / 2.0 AS n, sum(CASE WHEN side = 0 THEN rk END) AS rb, avg(CASE WHEN side = 0 THEN v END) AS mb, avg(CASE WHEN side = 1 THEN v END) AS mr FROM ranks GROUP BY ALL),
  tested AS (SELECT *, rb - n * (n + 1) / 2 AS u, sqrt(n * n / 12 * ((2 * n + 1) - ties / (2 * n * (2 * n - 1)))) AS s FROM stats JOIN ties USING (unit_id)),
  judged AS (SELECT {UNIT}, round(mb, 7) AS mean_base, round(mr, 7) AS mean_response, u, round(CASE WHEN s > 0 THEN (n * n - u - n * n / 2 - 0.5) / s END, 7) AS z,
    n >= 5 AND mr > mb AND (CASE WHEN n <= 8 AND most = 1 THEN (n > 6 AND ((n <= 7 AND u <= 1) OR (n > 7 AND u <= 4))) ELSE coalesce((n * n - u - n * n / 2 - 0.5) / s > 3.090232306167813, false) END) AS responsive FROM tested)"""

SQL = {
    "range_join": f"WITH {f.SPIKES_SQL}, {f.ONSETS_SQL} SELECT s.session, probe, unit_id, count(*) AS n, CAST(sum(s.t_us - (o.t_us - {PRE})) AS BIGINT) AS sum_dt_us FROM spikes s JOIN onsets o ON s.session = o.session AND s.t_us >= o.t_us - {PRE} AND s.t_us < o.t_us + {POST} GROUP BY ALL",
    "event_raster": f"{WITH_CELLS} SELECT {UNIT}, trial_id, bin, least(n, 255) AS n FROM cells",
    "probe_rasters": f"""WITH {f.SPIKES_SQL}, {f.ONSETS_SQL}, len AS (SELECT session, {PRE} + (arg_min(trial_id % 3, trial_id) + 25) * {BIN} AS length FROM onsets WHERE valid GROUP BY session),
  clocks AS (SELECT session, 'imec0' AS probe, trial_id, t_us FROM onsets WHERE valid AND stim_index <> 3 UNION ALL SELECT session, 'imec1', trial_id, t_us + 20000 FROM onsets WHERE valid)
  SELECT s.session, s.probe, unit_id, trial_id, CAST((s.t_us - o.t_us + {PRE}) // {BIN} AS INT) AS bin, least(count(*), 255) AS n FROM spikes s JOIN clocks o ON s.session = o.session AND s.probe = o.probe
  JOIN len l ON l.session = s.session WHERE s.t_us >= o.t_us - {PRE} AND s.t_us < o.t_us - {PRE} + length GROUP BY ALL""",
    "export_raster": f"{WITH_CELLS} SELECT {UNIT}, trial_id, bin, least(n, 255) AS n FROM cells WHERE trial_id IN (SELECT trial_id FROM onsets WHERE valid)",
    "psth": f"{WITH_CELLS}, {_TRIALS} SELECT {UNIT}, bin, CAST(sum(least(n, 255)) AS BIGINT) AS n_spikes, round(sum(least(n, 255)) / (any_value(n_trials) * {BIN_S}), 9) AS rate_hz FROM cells JOIN per_session USING (session) GROUP BY ALL",
    "psth_preferred": f"""{WITH_CELLS}, per AS (SELECT session, stim_index, count(*) AS trials FROM onsets GROUP BY ALL), stims AS (SELECT session, count(*) AS n_stims FROM per GROUP BY ALL),
      by_stim AS (SELECT c.session, probe, unit_id, stim_index, bin, sum(least(n, 255)) / (any_value(trials) * {BIN_S}) AS rate FROM cells c JOIN onsets o USING (session, trial_id) JOIN per USING (session, stim_index) GROUP BY ALL),
      windowed AS (SELECT {UNIT}, stim_index, round(sum(rate), 9) AS rate FROM by_stim WHERE bin >= {FIRST} AND bin < {LAST} GROUP BY ALL),
      best AS (SELECT {UNIT}, stim_index AS preferred FROM windowed QUALIFY row_number() OVER (PARTITION BY {UNIT} ORDER BY rate DESC, stim_index) = 1)
      SELECT session, probe, unit_id, preferred, bin, round(coalesce(sum(CASE WHEN stim_index = preferred THEN rate END), 0), 8) AS preferred_hz, round(sum(rate) / any_value(n_stims), 8) AS mean_hz
      FROM by_stim JOIN stims USING (session) JOIN best USING (session, probe, unit_id) GROUP BY ALL""",
    "rebinned": f"{WITH_CELLS} SELECT {UNIT}, trial_id, CAST(bin // 4 AS INT) AS bin, CAST(sum(n) AS BIGINT) AS n FROM cells WHERE bin < {BINS // 4 * 4} GROUP BY {UNIT}, trial_id, bin // 4",
    "window_counts": f"{WITH_CELLS}, {_COUNTS} SELECT {UNIT}, trial_id, CAST(n AS BIGINT) AS n, round(n / {WINDOW_S}, 9) AS rate_hz FROM counts",
    "stim_rates": f"{WITH_CELLS}, {_COUNTS}, {_RATES} SELECT session, probe, unit_id, stim_index, trials, round(rate_hz, 9) AS rate_hz FROM rates",
    "unit_stats": f"""{WITH_CELLS}, {_COUNTS}, {_TRIALS}, units AS (SELECT DISTINCT {UNIT} FROM spikes),
      m AS (SELECT u.session, u.probe, u.unit_id, coalesce(sum(n), 0) AS n_spikes, count(n) AS n_active, coalesce(sum(n), 0) / CAST(any_value(n_trials) AS DOUBLE) AS mean, coalesce(sum(n * n), 0) / CAST(any_value(n_trials) AS DOUBLE) AS sq
        FROM units u JOIN per_session USING (session) LEFT JOIN counts c ON c.unit_id = u.unit_id AND c.probe = u.probe AND c.session = u.session GROUP BY ALL)
      SELECT {UNIT}, CAST(n_spikes AS BIGINT) AS n_spikes, n_active, round(mean, 8) AS mean_count, round(CASE WHEN sq - mean * mean > 1e-12 THEN mean / sqrt(sq - mean * mean) END, 8) AS snr FROM m""",
    "selectivity": f"{WITH_CELLS}, {_COUNTS}, {_RATES} SELECT {UNIT}, round(CASE WHEN max(rate_hz) + avg(rate_hz) > 1e-9 THEN (max(rate_hz) - avg(rate_hz)) / (max(rate_hz) + avg(rate_hz)) ELSE 0 END, 8) AS selectivity FROM rates GROUP BY ALL",
    "consistency_score": f"{WITH_CELLS}, {_SCORE} SELECT session, probe, unit_id, score FROM consistent",
    "responsiveness": f"{WITH_CELLS}, {_TEST} SELECT session, probe, unit_id, mean_base, mean_response, u, z, responsive FROM judged",
    "top_units": f"{WITH_CELLS}, {_SCORE}, {_TEST} SELECT session, probe, unit_id, coalesce(responsive, false) AS responsive, score, row_number() OVER (PARTITION BY session, probe ORDER BY coalesce(responsive, false) DESC, score DESC NULLS LAST, unit_id) AS rank FROM (SELECT DISTINCT {UNIT} FROM spikes) LEFT JOIN consistent USING (session, probe, unit_id) LEFT JOIN judged USING (session, probe, unit_id) QUALIFY rank <= 5",
    "stim_coverage": f"WITH {f.ONSETS_SQL} SELECT stim_index, count(*) AS n_trials FROM onsets WHERE coalesce(valid, true) GROUP BY ALL",
    "raster_stats": f"{WITH_CELLS}, {_TRIALS}, p AS (SELECT session, probe, count(*) AS filled, count(DISTINCT unit_id) AS units FROM cells GROUP BY ALL), q AS (SELECT *, 1 - filled / CAST(units * n_trials * {BINS} AS DOUBLE) AS share FROM p JOIN per_session USING (session)) SELECT session, probe, filled, units, round(share, 9) AS zero_share, CASE WHEN share >= 0.5 THEN 'coo' ELSE 'dense' END AS layout FROM q",
    "valid_filters": f"WITH {f.ONSETS_SQL} SELECT count(*) FILTER (valid) AS strict, count(*) FILTER (coalesce(valid, true)) AS missing_is_valid, count(*) FILTER (valid IS NULL) AS missing FROM onsets",
}
