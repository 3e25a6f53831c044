"""Nearest anchorage of each position among those in its own and the touching visit cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.config import VISIT_LEVEL
from quayside.functions.geo import haversine_km
from quayside.functions.s2 import cell_key, neighbour_keys


def anchorages_by_cell(anchorages: DataFrame, level: int = VISIT_LEVEL) -> DataFrame:
    """(cell, near): each cell with the anchorages in it and around it. anchorages: s2id, lat, lon."""
    a = anchorages.select(F.struct("s2id", "lat", "lon").alias("a"), F.explode(neighbour_keys(F.col("lat"), F.col("lon"), level)).alias("cell"))
    return a.groupBy("cell").agg(F.collect_list("a").alias("near"))


def tag_nearest(positions: DataFrame, anchorages: DataFrame, level: int = VISIT_LEVEL) -> DataFrame:
    """Adds port_s2id, port_dist, port_lat, port_lon; null where no anchorage is in reach. Ties go to the least s2id.

    An equi-join on the cell, one row of anchorages for each: positions are neither multiplied nor grouped again. Without a
    hint, the cell table is broadcast only while its size is under Spark's threshold."""
    p = positions.withColumn("_cell", cell_key(F.col("lat"), F.col("lon"), level))
    d = p.join(anchorages_by_cell(anchorages, level), F.col("_cell") == F.col("cell"), "left")
    here = lambda a: F.struct(haversine_km(F.col("lat"), F.col("lon"), a["lat"], a["lon"]).alias("dist"), a["s2id"].alias("s2id"), a["lat"].alias("lat"), a["lon"].alias("lon"))
    d = d.withColumn("_port", F.array_min(F.transform("near", here)))
    d = d.withColumns({"port_s2id": F.col("_port.s2id"), "port_dist": F.col("_port.dist"), "port_lat": F.col("_port.lat"), "port_lon": F.col("_port.lon")})
    return d.drop("_cell", "cell", "near", "_port")
