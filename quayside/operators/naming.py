"""Names of anchorages: from port lists in order of priority, overrides, countries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.config import ANCHORAGE_LEVEL, VISIT_LEVEL, Config
from quayside.functions.geo import haversine_km
from quayside.functions.names import normalize_label
from quayside.functions.s2 import cell_key, neighbour_keys, s2_token
from quayside.operators.polygons import with_polygon


def nearest_listed_port(anchorages: DataFrame, ports: DataFrame, config: Config) -> DataFrame:
    """anchorages with the struct port (source, iso3, label, sublabel) or null: of the first list that has a port within the label
    distance, the nearest one, of equal ones the last in the list. The sublabel is blank beyond its own distance.

    ports: source, list_no, row_no, iso3, label, sublabel, lat, lon. The label distance is far below a visit cell's width, so the
    join on the cell and its neighbours misses none."""
    p = ports.select(F.struct("source", "list_no", "row_no", "iso3", "label", "sublabel", "lat", "lon").alias("p"), F.explode(neighbour_keys(F.col("lat"), F.col("lon"), VISIT_LEVEL)).alias("_cell"))
    p = p.groupBy("_cell").agg(F.collect_list("p").alias("_ports"))
    d = anchorages.withColumn("_cell", cell_key(F.col("lat"), F.col("lon"), VISIT_LEVEL)).join(p, "_cell", "left")
    rank = lambda x: F.struct(x["list_no"].alias("list_no"), haversine_km(F.col("lat"), F.col("lon"), x["lat"], x["lon"]).alias("dist"), (-x["row_no"]).alias("later"), x.alias("p"))
    best = F.array_min(F.filter(F.transform("_ports", rank), lambda x: x["dist"] <= config.label_km))
    d = d.withColumn("_best", best)
    sub = F.when(F.col("_best.dist") <= config.sublabel_km, F.col("_best.p.sublabel")).otherwise("")
    port = F.when(F.col("_best").isNotNull(), F.struct(F.col("_best.p.source").alias("source"), F.col("_best.p.iso3").alias("iso3"), F.col("_best.p.label").alias("label"), sub.alias("sublabel")))
    return d.withColumn("port", port).drop("_cell", "_ports", "_best")


def add_labels(anchorages: DataFrame, ports: DataFrame, config: Config) -> DataFrame:
    """label, sublabel, iso3, label_source: from the lists, else the top destination, else the cell id."""
    d = nearest_listed_port(anchorages, ports, config)
    label = normalize_label(F.when(F.col("port").isNotNull(), F.col("port.label")).otherwise(F.col("top_destination")))
    d = d.withColumns({"label": label, "sublabel": normalize_label(F.col("port.sublabel")), "iso3": normalize_label(F.col("port.iso3")), "label_source": F.coalesce("port.source", F.lit("top_destination"))})
    return d.withColumn("label", F.coalesce(F.nullif("label", F.lit("")), F.col("s2id"))).drop("port")


def add_countries(named: DataFrame, polygons: DataFrame, config: Config) -> DataFrame:
    """iso3 from polygons where there is none; Chinese labels not from the override list become cell ids."""
    d = with_polygon(named, polygons, "_p", F.col("iso3").isNull()).withColumn("iso3", F.coalesce("iso3", F.nullif(F.col("_p.iso3"), F.lit("-")))).drop("_p")
    china = F.coalesce((F.col("iso3") == "CHN") & (F.col("label_source") != config.override_source), F.lit(False))
    return d.withColumns({"label": F.when(china, F.col("s2id")).otherwise(F.col("label")), "label_source": F.when(china, "china_s2id_override").otherwise(F.col("label_source"))})


def with_overrides(named: DataFrame, overrides: DataFrame, config: Config, used: DataFrame | None = None) -> DataFrame:
    """Adds the override rows whose cell no anchorage has, and drops what the override list marks REMOVE.

    overrides: iso3, label, sublabel, lat, lon. Their iso3 is taken as it stands. used: a table with the s2id of all anchorages,
    so that the named ones are not worked out twice."""
    taken = (named if used is None else used).select("s2id")
    o = overrides.withColumn("s2id", s2_token(F.col("lat"), F.col("lon"), ANCHORAGE_LEVEL)).join(taken, "s2id", "left_anti")
    o = o.select("s2id", "lat", "lon", normalize_label(F.col("label")).alias("label"), normalize_label(F.col("sublabel")).alias("sublabel"), "iso3", F.lit(config.override_source).alias("label_source"))
    gone = F.col("label").eqNullSafe(F.lit("REMOVE")) & F.col("label_source").eqNullSafe(F.lit(config.override_source))
    return named.unionByName(o, allowMissingColumns=True).where(~gone)


def name_anchorages(anchorages: DataFrame, ports: DataFrame, overrides: DataFrame, polygons: DataFrame, config: Config) -> DataFrame:
    return with_overrides(add_countries(add_labels(anchorages, ports, config), polygons, config), overrides, config, anchorages)
