"""Queries over embeddings as stimulus-by-unit tables and as units of two runs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks
from ..operators import neighbours as near
from ..operators import pairing as p
from ..operators import population as pop
from . import fixtures as f

SEEDS = (0, 1, 2)
FRACTIONS, UNITS = (0.5, 1.0), (16, 64)
CLOSE = 0.35
HALF_HOUR = 30 * 60 * 1_000_000


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stim, trial, unit, value) of the vectors' elements."""
    return f.table(spark, sf_dir, "embeddings").select(F.col("label").alias("stim"), F.col("vec_id").alias("trial"), F.posexplode("embedding").alias("unit", "v")).select("stim", "trial", "unit", F.col("v").cast("double").alias("value"))


_ROWS = "long AS (SELECT label AS stim, vec_id AS trial, CAST(i AS INT) AS unit, CAST(embedding[i + 1] AS DOUBLE) AS value FROM embeddings, range(64) r(i))"


def _rsm_sql(source: str, keys: str = "") -> str:
    """CTEs m_, z_ and r_ of a source with columns (keys, stim, unit, value)."""
    k = keys + ", " if keys else ""
    on = f"a.unit = b.unit AND a.stim > b.stim" + "".join(f" AND a.{x.strip()} = b.{x.strip()}" for x in keys.split(",") if x.strip())
    a = "".join(f"a.{x.strip()}, " for x in keys.split(",") if x.strip())
    return f"""m_{source} AS (SELECT {k}stim, unit, avg(value) AS v FROM {source} GROUP BY ALL),
z_{source} AS (SELECT {k}stim, unit, (v - avg(v) OVER w) / nullif(sqrt(sum(v * v) OVER w - sum(v) OVER w * sum(v) OVER w / count(*) OVER w), 0) AS z FROM m_{source} WINDOW w AS (PARTITION BY {k}stim)),
r_{source} AS (SELECT {a}a.stim AS stim_a, b.stim AS stim_b, sum(a.z * b.z) AS r FROM z_{source} a JOIN z_{source} b ON {on} GROUP BY ALL)"""


def mean_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-8 on vectors."""
    return pop.means(_rows(spark, sf_dir)).withColumn("value", F.round("value", 8))


def varying_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-5."""
    return pop.varying(pop.means(_rows(spark, sf_dir))).groupBy("unit").agg(F.count("*").alias("n"))


def rsm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-9."""
    return pop.rsm(pop.means(_rows(spark, sf_dir))).withColumn("r", F.round("r", 7))


def compare_rsm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-10, AG-49: vectors with even against odd numbers."""
    rows = _rows(spark, sf_dir)
    a, b = (pop.rsm(pop.means(rows.where(F.col("trial") % 2 == i))) for i in (0, 1))
    return pop.compared(a, b).withColumns({c: F.round(c, 6) for c in ("pearson", "spearman")})


def unit_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-13, PRJ-12, WN-9."""
    return pop.unit_reliability(_rows(spark, sf_dir), SEEDS).withColumn("reliability", F.round("reliability", 6))


def rsm_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-15."""
    return pop.rsm_reliability(_rows(spark, sf_dir), SEEDS).withColumns({c: F.round(c, 6) for c in ("pearson", "spearman")})


def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-41: even against odd vectors."""
    rows = _rows(spark, sf_dir)
    found = pop.ablation(rows.where("trial % 2 = 0"), rows.where("trial % 2 = 1"), SEEDS, FRACTIONS, UNITS)
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


def _units(spark: SparkSession, sf_dir: str, odd: int | None = None) -> DataFrame:
    rows = f.table(spark, sf_dir, "embeddings")
    rows = rows if odd is None else rows.where(F.col("vec_id") % 2 == odd)
    return rows.select(F.col("label").alias("probe"), F.col("vec_id").alias("unit_id"), F.col("embedding").alias("template"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


_SIMS = """units AS (SELECT label AS probe, vec_id AS unit_id, embedding AS e, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
sims AS (SELECT a.probe, a.unit_id AS unit_a, b.unit_id AS unit_b, list_cosine_similarity(CAST(a.e AS DOUBLE[]), CAST(b.e AS DOUBLE[])) AS c, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM units a JOIN units b ON a.probe = b.probe AND a.unit_id % 2 = 0 AND b.unit_id % 2 = 1)"""


def unit_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-8."""
    return p.similarities(_units(spark, sf_dir, 0), _units(spark, sf_dir, 1), ["probe"]).withColumns({c: F.round(c, 6) for c in ("cos", "d_xy", "sim")})


def unit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-9, OP-11: one to one by iterated mutual best; the SQL takes the rounds by recursion."""
    return p.pair_units(_units(spark, sf_dir, 0), _units(spark, sf_dir, 1), ["probe"], rest=True).select("probe", "unit_a", "unit_b", F.round("sim", 6).alias("sim"), "matched")


def pairing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-37."""
    a, b = _units(spark, sf_dir, 0), _units(spark, sf_dir, 1)
    return p.pairing_summary(p.pair_units(a, b, ["probe"]), a, b, ["probe"]).withColumns({c: F.round(c, 8) for c in ("median_sim", "median_d")})


def nearest_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-14."""
    rows = _units(spark, sf_dir).select("probe", F.col("unit_id").alias("channel"), "x", "y")
    return near.nearest(rows, ["probe"], "channel", 3).withColumn("d", F.round("d", 6))


def similarity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-10: three pairs of each band, in the order of a hash."""
    from hashlib import md5

    from pyspark.sql import Window

    from ..functions.stats import hash_order

    def band(cos: np.ndarray) -> np.ndarray:
        c = np.nan_to_num(np.floor(np.abs(cos) * 1e6 + 0.5) / 1e6 * np.sign(cos), nan=-9.0)
        return np.select([c >= 0.3, c >= 0.1, c >= 0], [3, 2, 1], 0)

    digest = lambda a, b: md5(b"0:%d:%d" % (a, b)).digest()
    rows = blocks.first_pairs(_units(spark, sf_dir, 0), _units(spark, sf_dir, 1), ["probe"], band, 3, digest)
    order = Window.partitionBy("band").orderBy(hash_order(0, "unit_a", "unit_b"))
    named = F.element_at(F.array(*map(F.lit, ("none", "low", "middle", "high"))), F.col("band") + 1)
    return rows.withColumn("band", named).withColumn("rank", F.row_number().over(order)).where("rank <= 3").select("band", "unit_a", "unit_b", "rank")


def close_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-8 above a least similarity: the pairs of any two units that reach it, found in blocks."""
    return blocks.pairs(_units(spark, sf_dir, 0), _units(spark, sf_dir, 1), ["probe"], p.MATCHED).withColumns({c: F.round(c, 6) for c in ("cos", "d_xy", "sim")})


def pair_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN-10 on the pairs: examples of each band and of the units without a pair."""
    a, b = _units(spark, sf_dir, 0), _units(spark, sf_dir, 1)
    return p.pair_bands(p.pair_units(a, b, ["probe"]), a, ["probe"], 3)


def merge_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG-44, OP-13, JN-13."""
    every = _units(spark, sf_dir)
    edges = p.merge_edges(every, ["probe"], CLOSE)
    return p.merged_units(every.select("unit_id"), edges)


def spike_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-10, AG-36: clicks against views of each user, half an hour apart at most; the SQL takes the clicks one by one."""
    rows = f.table(spark, sf_dir, "events").select(F.col("user_id").alias("unit_id"), f.micros("ts").alias("t"), "event_type")
    a, b = (rows.where(F.col("event_type") == x).select("unit_id", "t") for x in ("click", "view"))
    return p.agreement(a, b, ["unit_id"], HALF_HOUR).withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


_BEST = "row_number() OVER (PARTITION BY probe, unit_a ORDER BY sim DESC, unit_b) = 1 AND row_number() OVER (PARTITION BY probe, unit_b ORDER BY sim DESC, unit_a) = 1 AS taken"
_PAIRS = f"""WITH RECURSIVE {_SIMS}, s AS (SELECT probe, unit_a, unit_b, 0.7 * c + 0.3 * exp(-d / 100) AS sim, d FROM sims),
rounds AS (SELECT *, {_BEST} FROM s UNION ALL SELECT *, {_BEST} FROM (SELECT probe, unit_a, unit_b, sim, d FROM (SELECT *, bool_or(taken) OVER (PARTITION BY probe, unit_a) AS ta, bool_or(taken) OVER (PARTITION BY probe, unit_b) AS tb FROM rounds) WHERE NOT ta AND NOT tb)),
pairs AS (SELECT probe, unit_a, unit_b, sim, d, sim >= 0.6 AS matched FROM rounds WHERE taken)"""

QUERIES = {q.__name__: q for q in (mean_rates, varying_units, rsm, compare_rsm, unit_reliability, rsm_reliability, ablation, unit_similarity, unit_pairs, pairing_summary, nearest_channels, similarity_bands, close_units, pair_bands, merge_units, spike_agreement)}

_SEEDS = "seeds AS (SELECT CAST(range AS INT) AS seed FROM range(3))"
_CMP = lambda a, b, keys: f"""pairs AS (SELECT {keys}a.stim_a, a.stim_b, a.r AS ra, b.r AS rb FROM {a} a JOIN {b} b USING ({keys}stim_a, stim_b)),
ranks AS (SELECT *, rank() OVER (PARTITION BY {keys or '1,'} 1 ORDER BY ra) + (count(*) OVER (PARTITION BY {keys or '1,'} ra) - 1) / 2.0 AS ka, rank() OVER (PARTITION BY {keys or '1,'} 1 ORDER BY rb) + (count(*) OVER (PARTITION BY {keys or '1,'} rb) - 1) / 2.0 AS kb FROM pairs)"""  # noqa: E731

SQL = {
    "mean_rates": f"WITH {_ROWS} SELECT stim, unit, round(avg(value), 8) AS value FROM long GROUP BY ALL",
    "varying_units": f"WITH {_ROWS}, m AS (SELECT stim, unit, avg(value) AS v FROM long GROUP BY ALL) SELECT unit, count(*) AS n FROM m GROUP BY unit HAVING var_pop(v) > 1e-18",
    "rsm": f"WITH {_ROWS}, {_rsm_sql('long')} SELECT stim_a, stim_b, round(r, 7) AS r FROM r_long",
    "compare_rsm": f"WITH {_ROWS}, e AS (SELECT * FROM long WHERE trial % 2 = 0), o AS (SELECT * FROM long WHERE trial % 2 = 1), {_rsm_sql('e')}, {_rsm_sql('o')}, {_CMP('r_e', 'r_o', '')} SELECT count(*) AS n, round(corr(ra, rb), 6) AS pearson, round(corr(ka, kb), 6) AS spearman FROM ranks",
    "unit_reliability": f"""WITH {_ROWS}, {_SEEDS}, t AS (SELECT DISTINCT stim, trial FROM long), n AS (SELECT *, row_number() OVER (PARTITION BY seed, stim ORDER BY md5(seed || ':' || trial), trial) AS rn, count(*) OVER (PARTITION BY seed, stim) AS c FROM t, seeds),
      h AS (SELECT seed, unit, stim, avg(value) FILTER (rn <= c // 2) AS a, avg(value) FILTER (rn > c // 2) AS b FROM long JOIN n USING (stim, trial) GROUP BY ALL),
      r AS (SELECT seed, unit, CASE WHEN count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) >= 5 AND var_pop(a) FILTER (b IS NOT NULL) > 1e-18 AND var_pop(b) FILTER (a IS NOT NULL) > 1e-18 THEN corr(a, b) END AS r FROM h GROUP BY ALL),
      s AS (SELECT unit, CASE WHEN r > -1 THEN 2 * r / (1 + r) END AS r FROM r) SELECT unit, round(avg(CASE WHEN r <> 0 THEN r END), 6) AS reliability, count(r) AS n_seeds FROM s GROUP BY ALL""",
    "rsm_reliability": f"""WITH {_ROWS}, {_SEEDS}, t AS (SELECT DISTINCT stim, trial FROM long), n AS (SELECT *, row_number() OVER (PARTITION BY seed, stim ORDER BY md5(seed || ':' || trial), trial) AS rn FROM t, seeds),
      a AS (SELECT seed, stim, unit, value FROM long JOIN n USING (stim, trial) WHERE rn % 2 = 1), b AS (SELECT seed, stim, unit, value FROM long JOIN n USING (stim, trial) WHERE rn % 2 = 0), {_rsm_sql('a', 'seed')}, {_rsm_sql('b', 'seed')}, {_CMP('r_a', 'r_b', 'seed, ')}
      SELECT seed, count(*) AS n, round(corr(ra, rb), 6) AS pearson, round(corr(ka, kb), 6) AS spearman FROM ranks GROUP BY ALL""",
    "ablation": f"""WITH {_ROWS}, {_SEEDS}, grid AS (SELECT seed, f.fraction, u.units FROM seeds, (SELECT unnest([0.5::DOUBLE, 1.0::DOUBLE]) AS fraction) f, (SELECT unnest([16, 64]) AS units) u),
      t AS (SELECT DISTINCT stim, trial, trial % 2 AS run FROM long), tn AS (SELECT *, row_number() OVER (PARTITION BY run, seed, stim ORDER BY md5(seed || ':' || trial), trial) AS rn, count(*) OVER (PARTITION BY run, seed, stim) AS c FROM t, seeds),
      un AS (SELECT seed, unit, row_number() OVER (PARTITION BY seed ORDER BY md5(seed || ':' || unit), unit) AS un FROM (SELECT DISTINCT unit FROM long), seeds),
      kept AS (SELECT run, g.seed, fraction, units, l.stim, l.unit, value FROM long l JOIN tn USING (stim, trial) JOIN un ON un.seed = tn.seed AND un.unit = l.unit JOIN grid g ON g.seed = tn.seed AND un.un <= g.units AND rn <= greatest(2, ceil(g.fraction * c))),
      e AS (SELECT * EXCLUDE (run) FROM kept WHERE run = 0), o AS (SELECT * EXCLUDE (run) FROM kept WHERE run = 1), {_rsm_sql('e', 'seed, fraction, units')}, {_rsm_sql('o', 'seed, fraction, units')},
      m AS (SELECT seed, fraction, units, corr(a.r, b.r) AS x FROM r_e a JOIN r_o b USING (seed, fraction, units, stim_a, stim_b) GROUP BY ALL) SELECT fraction, units, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS sd, count(x) AS n FROM m GROUP BY ALL""",
    "unit_similarity": f"WITH {_SIMS} SELECT probe, unit_a, unit_b, round(c, 6) AS cos, round(d, 6) AS d_xy, round(0.7 * c + 0.3 * exp(-d / 100), 6) AS sim FROM sims",
    "close_units": f"WITH {_SIMS} SELECT probe, unit_a, unit_b, round(c, 6) AS cos, round(d, 6) AS d_xy, round(0.7 * c + 0.3 * exp(-d / 100), 6) AS sim FROM sims WHERE 0.7 * c + 0.3 * exp(-d / 100) >= 0.6",
    "pair_bands": f"""{_PAIRS}, b AS (SELECT CASE WHEN c >= 0.97 THEN 'same' WHEN c >= 0.85 THEN 'alike' WHEN c >= 0.6 THEN 'like' ELSE 'unlike' END AS band, p.probe, p.unit_a, p.unit_b FROM pairs p JOIN sims USING (probe, unit_a, unit_b) WHERE matched
      UNION ALL SELECT 'unmatched', probe, unit_id, NULL FROM units u WHERE unit_id % 2 = 0 AND NOT EXISTS (FROM pairs p WHERE p.probe = u.probe AND unit_a = unit_id AND matched))
      SELECT band, probe, unit_a, unit_b, row_number() OVER (PARTITION BY band ORDER BY md5('0:' || probe || ':' || unit_a), probe, unit_a) AS rank FROM b QUALIFY rank <= 3""",
    "unit_pairs": f"{_PAIRS} SELECT probe, unit_a, unit_b, round(sim, 6) AS sim, matched FROM pairs",
    "pairing_summary": f"""{_PAIRS}, n AS (SELECT probe, count(*) FILTER (unit_id % 2 = 0) AS na, count(*) FILTER (unit_id % 2 = 1) AS nb FROM units GROUP BY ALL),
      m AS (SELECT probe, count(*) AS k, median(sim) AS sim, median(d) AS d FROM pairs WHERE matched GROUP BY ALL)
      SELECT n.probe, coalesce(k, 0) AS matched, na - coalesce(k, 0) AS a_only, nb - coalesce(k, 0) AS b_only, round(sim, 8) AS median_sim, round(m.d, 8) AS median_d FROM n LEFT JOIN m ON n.probe = m.probe""",
    "spike_agreement": f"""WITH RECURSIVE e AS (SELECT user_id AS unit_id, epoch_us(ts) AS t, event_type FROM events),
      a AS (SELECT unit_id, t, row_number() OVER (PARTITION BY unit_id ORDER BY t) AS k FROM e WHERE event_type = 'click'), na AS (SELECT unit_id, count(*) AS n_a FROM a GROUP BY ALL),
      b AS (SELECT unit_id, list({{'t': t, 'i': i}}) AS rest, count(*) AS n_b FROM (SELECT unit_id, t, row_number() OVER (PARTITION BY unit_id ORDER BY t) AS i FROM e WHERE event_type = 'view') GROUP BY ALL),
      r AS (SELECT unit_id, CAST(0 AS BIGINT) AS k, rest, CAST(0 AS BIGINT) AS tp FROM b UNION ALL
        SELECT unit_id, k, CASE WHEN best IS NULL THEN rest ELSE list_filter(rest, lambda x: x.i <> best.i) END, tp + CASE WHEN best IS NULL THEN 0 ELSE 1 END
        FROM (SELECT r.unit_id, a.k, r.rest, r.tp, list_min(list_transform(list_filter(r.rest, lambda x: abs(x.t - a.t) <= {HALF_HOUR}), lambda x: {{'d': abs(x.t - a.t), 'i': x.i}})) AS best FROM r JOIN a ON a.unit_id = r.unit_id AND a.k = r.k + 1)),
      h AS (SELECT unit_id, max(tp) AS tp FROM r GROUP BY ALL)
      SELECT unit_id, n_a, n_b, tp, round(tp / n_a, 6) AS precision, round(tp / n_b, 6) AS recall, round(2 * tp / (n_a + n_b), 6) AS f1 FROM na JOIN b USING (unit_id) JOIN h USING (unit_id)""",
    "nearest_channels": "WITH u AS (SELECT label AS probe, vec_id AS channel, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings), d AS (SELECT a.probe, a.channel, b.channel AS near, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d FROM u a JOIN u b ON a.probe = b.probe AND a.channel <> b.channel) SELECT probe, channel, near, round(d, 6) AS d, row_number() OVER (PARTITION BY probe, channel ORDER BY d, near) AS rank FROM d QUALIFY rank <= 3",
    "similarity_bands": f"WITH {_SIMS}, b AS (SELECT *, CASE WHEN round(c, 6) >= 0.3 THEN 'high' WHEN round(c, 6) >= 0.1 THEN 'middle' WHEN round(c, 6) >= 0 THEN 'low' ELSE 'none' END AS band FROM sims) SELECT band, unit_a, unit_b, row_number() OVER (PARTITION BY band ORDER BY md5('0:' || unit_a || ':' || unit_b)) AS rank FROM b QUALIFY rank <= 3",
    "merge_units": f"""WITH RECURSIVE e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id AND round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) >= {CLOSE}),
      reach(node, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.b, reach.root FROM reach JOIN e ON reach.node = e.a WHERE reach.root < e.b), least AS (SELECT node, min(root) AS root FROM reach GROUP BY ALL)
      SELECT root AS unit_id, CASE WHEN count(*) > 1 THEN list(node ORDER BY node) ELSE CAST([] AS BIGINT[]) END AS merged_from FROM least GROUP BY root""",
}
