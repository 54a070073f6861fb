"""The operators' tables made from the driver's tables; the SQL twins are the *_SQL strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR = 3_600_000_000
PRE, POST, BIN = HOUR, 6 * HOUR, HOUR // 6
BINS, PRE_BINS = (PRE + POST) // BIN, PRE // BIN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def k_of(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def session() -> Column:
    """Users are dealt over three sessions."""
    return F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string"))


def spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type <> 'signup'")
    return rows.select(session().alias("session"), F.concat(F.lit("imec"), (F.col("user_id") % 2).cast("string")).alias("probe"), F.col("user_id").alias("unit_id"), micros("ts").alias("t_us"), F.col("value").alias("amplitude"))


def onsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_type = 'signup'")
    k = k_of()
    return rows.select(session().alias("session"), F.col("event_id").alias("trial_id"), micros("ts").alias("t_us"), (k % 10).alias("stim_index"), F.when(k != 50, k >= 10).alias("valid"))


SPIKES_SQL = "spikes AS (SELECT 's' || (user_id % 3) AS session, 'imec' || (user_id % 2) AS probe, user_id AS unit_id, epoch_us(ts) AS t_us, value AS amplitude FROM events WHERE event_type <> 'signup')"
ONSETS_SQL = """onsets AS (SELECT 's' || (user_id % 3) AS session, event_id AS trial_id, epoch_us(ts) AS t_us, k % 10 AS stim_index, CASE WHEN k <> 50 THEN k >= 10 END AS valid
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events WHERE event_type = 'signup'))"""
CELLS_SQL = f"""cells AS (SELECT s.session, probe, unit_id, trial_id, CAST((s.t_us - (o.t_us - {PRE})) // {BIN} AS INT) AS bin, count(*) AS n
  FROM spikes s JOIN onsets o ON s.session = o.session AND s.t_us >= o.t_us - {PRE} AND s.t_us < o.t_us + {POST} GROUP BY ALL)"""
WITH_CELLS = f"WITH {SPIKES_SQL}, {ONSETS_SQL}, {CELLS_SQL}"
