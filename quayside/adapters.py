"""Vessel tracks out of the driver's tables, which hold no positions: each user is a vessel that moves among twelve ports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.s2 import s2_token

N_PORTS = 12


def ports(spark: SparkSession) -> DataFrame:
    """k, lat, lon, s2id: the twelve ports."""
    p = spark.range(N_PORTS).select(F.col("id").alias("k"), (F.col("id") * 5 - 29.5).alias("lat"), (F.col("id") * 20 - 119.5).alias("lon"))
    return p.withColumn("s2id", s2_token(F.col("lat"), F.col("lon"), 14))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ssvid, vessel_id, seg_id, timestamp, lat, lon, speed, event_type, and the helpers c and d."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("timestamp"), F.round(F.col("value") * 100).cast("long").alias("c"))
    e = e.withColumn("d", F.unix_date(F.to_date("timestamp")).cast("long") - 19723)
    e = e.withColumn("k", (F.col("user_id") + F.floor(F.col("d") / 3)) % N_PORTS)
    m, s = F.col("c") % 10, F.col("c") % 7
    off = F.when(m < 6, (F.col("c") % 4) * 0.001).when(m == 6, 0.03).when(m == 7, 0.0315).otherwise(0.3)
    speed = F.when(s < 2, 0.1).when(s == 2, 0.3).when(s == 3, 0.45).otherwise((F.col("c") % 150) / 10.0)
    return e.select(
        "event_id",
        F.col("user_id").cast("string").alias("ssvid"), F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("vessel_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.floor(F.col("d") / 10).cast("string")).alias("seg_id"),
        "timestamp", (F.col("k") * 5 - 29.5 + off).alias("lat"), (F.col("k") * 20 - 119.5).cast("double").alias("lon"), speed.alias("speed"), "event_type", "c", "d",
    )


#: The same in SQL: CTEs trk and prt.
TRACKS_SQL = """
e0 AS (SELECT event_id, user_id, event_type, CAST(ts AS TIMESTAMP) AS ts, CAST(round(value * 100) AS BIGINT) AS c, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS d FROM events),
e1 AS (SELECT *, (user_id + d // 3) % 12 AS k FROM e0),
trk AS (SELECT event_id, CAST(user_id AS VARCHAR) AS ssvid, 'v' || user_id AS vessel_id, user_id || '-' || (d // 10) AS seg_id, ts, CAST(ts AS DATE) AS day,
  CAST(k * 5 - 29.5 AS DOUBLE) + CASE WHEN c % 10 < 6 THEN CAST(c % 4 AS DOUBLE) * CAST(0.001 AS DOUBLE) WHEN c % 10 = 6 THEN CAST(0.03 AS DOUBLE) WHEN c % 10 = 7 THEN CAST(0.0315 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END AS lat,
  CAST(k * 20 - 119.5 AS DOUBLE) AS lon,
  CASE WHEN c % 7 < 2 THEN CAST(0.1 AS DOUBLE) WHEN c % 7 = 2 THEN CAST(0.3 AS DOUBLE) WHEN c % 7 = 3 THEN CAST(0.45 AS DOUBLE) ELSE CAST(c % 150 AS DOUBLE) / 10 END AS speed, event_type, c, d FROM e1),
prt AS (SELECT k, CAST(k * 5 - 29.5 AS DOUBLE) AS lat, CAST(k * 20 - 119.5 AS DOUBLE) AS lon FROM range(12) t(k))"""
