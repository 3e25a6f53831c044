"""Points in polygons: countries and docks.

Polygons are a table of (file_order, iso_ter1, iso_sov1, rings), a ring an array of (lon, lat). Each is dealt to the tiles of a
coarse grid that its bounds touch, with those of its edges that can matter to a point there; a point meets one row, its tile's,
and an even-odd count over the edges decides. Points are neither multiplied nor regrouped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = 5.0
#: Rounding of a coordinate to its tile; edges this near to a tile's border belong to both sides.
MARGIN = 1e-6


def iso3_of(ter: Column, sov: Column) -> Column:
    return F.coalesce(F.nullif(ter, F.lit("")), sov)


def edges_of(rings: Column) -> Column:
    """The edges (a, b) of all rings; an open ring is closed."""

    def edges(ring: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(ring) - 1), lambda i: F.named_struct(F.lit("a"), F.get(ring, i), F.lit("b"), F.coalesce(F.get(ring, i + 1), F.get(ring, F.lit(0)))))

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 0), edges))


def contains(edges: Column, lon: Column, lat: Column) -> Column:
    """Whether a point is inside or on the boundary. Only edges at its latitude and not west of it count."""

    def side(e: Column) -> Column:
        return (e["b"]["lon"] - e["a"]["lon"]) * (lat - e["a"]["lat"]) - (e["b"]["lat"] - e["a"]["lat"]) * (lon - e["a"]["lon"])

    def on(e: Column) -> Column:
        within = lon.between(F.least(e["a"]["lon"], e["b"]["lon"]), F.greatest(e["a"]["lon"], e["b"]["lon"])) & lat.between(F.least(e["a"]["lat"], e["b"]["lat"]), F.greatest(e["a"]["lat"], e["b"]["lat"]))
        return within & (side(e) == 0)

    def crosses(e: Column) -> Column:
        up = (e["a"]["lat"] <= lat) & (e["b"]["lat"] > lat) & (side(e) > 0)
        down = (e["b"]["lat"] <= lat) & (e["a"]["lat"] > lat) & (side(e) < 0)
        return up | down

    return F.exists(edges, on) | (F.size(F.filter(edges, crosses)) % 2 == 1)


def _tile(x: Column) -> Column:
    return F.floor(x / F.lit(TILE)).cast("int")


def _tiles(polygons: DataFrame) -> DataFrame:
    """(_x, _y, _polygons): for each tile the polygons that touch it, with the edges of its latitudes that do not end west of it."""
    flat = F.flatten("rings")
    lo = lambda c: F.array_min(F.transform(flat, lambda p: p[c]))
    hi = lambda c: F.array_max(F.transform(flat, lambda p: p[c]))
    xs, ys = (F.sequence(_tile(lo(c)), _tile(hi(c))) for c in ("lon", "lat"))
    p = polygons.where(F.size(flat) > 0).select("file_order", iso3_of(F.col("iso_ter1"), F.col("iso_sov1")).alias("iso3"), edges_of(F.col("rings")).alias("edges"), xs.alias("_xs"), F.explode(ys).alias("_y"))
    south = F.col("_y") * TILE
    band = F.filter("edges", lambda e: (F.greatest(e["a"]["lat"], e["b"]["lat"]) >= south - MARGIN) & (F.least(e["a"]["lat"], e["b"]["lat"]) <= south + TILE + MARGIN))
    p = p.select("file_order", "iso3", band.alias("edges"), "_y", F.explode("_xs").alias("_x"))
    east = F.filter("edges", lambda e: F.greatest(e["a"]["lon"], e["b"]["lon"]) >= F.col("_x") * TILE - MARGIN)
    p = p.select("_x", "_y", F.struct("file_order", "iso3", east.alias("edges")).alias("p")).where(F.size("p.edges") > 0)
    return p.groupBy("_x", "_y").agg(F.collect_list("p").alias("_polygons"))


def with_polygon(points: DataFrame, polygons: DataFrame, column: str, wanted: Column | None = None) -> DataFrame:
    """points with a struct (file_order, iso3) of the first polygon in file order that holds each; null where none does, or where
    wanted is not true: such points are not looked up."""
    lat, lon = F.col("lat"), F.col("lon")
    d = points.withColumns({"_x": _tile(lon), "_y": _tile(lat)}).join(_tiles(polygons), ["_x", "_y"], "left")
    hit = F.transform(F.filter("_polygons", lambda p: contains(p["edges"], lon, lat)), lambda p: F.named_struct(F.lit("file_order"), p["file_order"], F.lit("iso3"), p["iso3"]))
    first = F.array_min(hit)
    return d.withColumn(column, first if wanted is None else F.when(wanted, first)).drop("_x", "_y", "_polygons")


def first_polygon(points: DataFrame, polygons: DataFrame, id_col: str = "s2id") -> DataFrame:
    """(id, file_order, iso3) of the first polygon in file order that holds each point; points in none are left out."""
    d = with_polygon(points.select(id_col, "lat", "lon"), polygons, "_p").where(F.col("_p").isNotNull())
    return d.select(id_col, "_p.file_order", "_p.iso3")


def at_dock(anchorages: DataFrame, land: DataFrame) -> DataFrame:
    """anchorages with at_dock: whether they lie within a polygon of (buffered) land."""
    return with_polygon(anchorages, land, "_p").withColumn("at_dock", F.col("_p").isNotNull()).drop("_p")
