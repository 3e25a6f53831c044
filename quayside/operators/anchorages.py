"""Anchorages: cells in which enough vessels have been stationary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.names import is_valid_name, normalize_name


def _most_frequent(counts: DataFrame) -> DataFrame:
    """(s2id, name, n) -> the most frequent name, of equal ones the least."""
    return counts.groupBy("s2id").agg(F.min_by("name", F.struct(-F.col("n"), F.col("name"))).alias("top_destination"))


def top_destinations(stationary: DataFrame) -> DataFrame:
    """(s2id, top_destination): the most frequent valid normalised destination, of equal ones the least name."""
    named = stationary.withColumn("name", normalize_name(F.col("destination"))).where(is_valid_name(F.col("name")))
    return _most_frequent(named.groupBy("s2id", "name").agg(F.count(F.lit(1)).alias("n")))


def find_anchorages(marks: DataFrame, fishing: DataFrame, min_vessels: int, key: str = "ident") -> DataFrame:
    """Anchorages from cell_marks; cells without a stationary period are none. Counts are exact.

    fishing: one column, the ids of fishing vessels. Sets are reduced step by step - to (cell, vessel, day and name), to (cell, vessel), to
    the cell - so a hot cell is spread over its vessels before it is summed."""
    fish = fishing.select(F.col(fishing.columns[0]).alias(key), F.lit(True).alias("_fish")).where(F.col(key).isNotNull()).distinct()
    stay, one = F.col("stay"), F.lit(1)
    name = normalize_name(stay["destination"])
    m = marks.withColumn("name", F.when(is_valid_name(name), name))
    parts = m.groupBy("s2id", key, "moved", "name").agg(
        F.count(stay).alias("visits"), F.sum(stay["lat"]).alias("lat"), F.sum(stay["lon"]).alias("lon"), F.sum(stay["duration_us"] / F.lit(86400e6)).alias("days"), F.sum(F.pow(stay["rms_drift_radius"], F.lit(2))).alias("drift")
    )
    by_vessel = parts.groupBy("s2id", key).agg(F.sum("visits").alias("visits"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"), F.sum("days").alias("days"), F.sum("drift").alias("drift"), F.count("moved").alias("active_days"))
    v = by_vessel.join(fish, key, "left").withColumns({"_fish": F.coalesce("_fish", F.lit(False)) & (F.col("visits") > 0), "_here": F.col("visits") > 0})
    cells = v.groupBy("s2id").agg(
        (F.sum("lat") / F.sum("visits")).alias("lat"), (F.sum("lon") / F.sum("visits")).alias("lon"), F.sum("visits").alias("total_visits"), F.sqrt(F.sum("drift") / F.sum("visits")).alias("drift_radius"),
        F.count_if("_here").alias("unique_stationary_ssvid"), F.count_if("_fish").alias("unique_stationary_fishing_ssvid"), F.count_if(F.col("active_days") > 0).alias("unique_active_ssvid"), F.count(one).alias("unique_total_ssvid"),
        F.sum("days").alias("stationary_ssvid_days"), F.sum(F.when(F.col("_fish"), F.col("days")).otherwise(0.0)).alias("stationary_fishing_ssvid_days"), F.sum("active_days").cast("double").alias("active_ssvid_days"),
    ).where(F.col("unique_stationary_ssvid") >= min_vessels)
    named = parts.where("name is not null").groupBy("s2id", "name").agg(F.sum("visits").alias("n"))
    out = cells.join(_most_frequent(named), "s2id", "left").withColumn("top_destination", F.coalesce("top_destination", F.lit("")))
    return out.select("lat", "lon", "total_visits", "drift_radius", "top_destination", *(c for c in cells.columns if c.startswith("unique") or c.endswith("days")), "s2id")
