"""Inputs of the entry points."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import ANCHORAGE_LEVEL
from quayside.functions.s2 import s2_token
from quayside.operators.records import segment_destination

PORT_LIST = "iso3 string, label string, sublabel string, lat double, lon double, category string"


def query_source(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def in_days(ts: Column, start: dt.date, end: dt.date) -> Column:
    """Inclusive UTC days as a plain range of the column, so that it reaches the scan."""
    return (ts >= F.lit(dt.datetime.combine(start, dt.time()))) & (ts < F.lit(dt.datetime.combine(end + dt.timedelta(days=1), dt.time())))


def day_chunks(start: dt.date, end: dt.date, days: int = 1000) -> list[tuple[dt.date, dt.date]]:
    """A range as inclusive chunks; kept for callers that submit queries to other systems. Scans here need none."""
    out, at = [], start
    while at <= end:
        out.append((at, min(end, at + dt.timedelta(days=days - 1))))
        at += dt.timedelta(days=days)
    return out


def segment_destinations(segments: DataFrame) -> DataFrame:
    return segments.select("seg_id", "day", segment_destination(F.col("destinations")).alias("destination"))


def anchorage_positions(positions: DataFrame, segments: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Positions with their segment's destination of the day."""
    p = positions.where(in_days(F.col("timestamp"), start, end) & F.col("seg_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("speed").isNotNull())
    p = p.withColumn("day", F.to_date("timestamp"))
    d = segment_destinations(segments).where(F.col("day").between(F.lit(start), F.lit(end)))
    return p.join(d, ["seg_id", "day"]).select(F.col("ssvid").alias("ident"), "lat", "lon", "timestamp", "destination", "speed")


def thinning_positions(positions: DataFrame, start: dt.date, end: dt.date, ssvids: DataFrame | list[str] | str | None = None) -> DataFrame:
    """Positions of the range, of all vessels or of those wanted: a table, a list, or the text of a SQL list or subquery."""
    p = positions.where(in_days(F.col("timestamp"), start, end))
    if isinstance(ssvids, str):
        p = p.where(F.expr(f"ssvid IN ({ssvids})"))
    elif isinstance(ssvids, DataFrame):
        p = p.join(ssvids.select(F.col(ssvids.columns[0]).alias("ssvid")), "ssvid", "left_semi")
    elif ssvids is not None:
        p = p.where(F.col("ssvid").isin(ssvids))
    return p.select(F.col("seg_id").alias("ident"), "ssvid", "lat", "lon", "speed", "timestamp")


def not_in(rows: DataFrame, column: str, bad: DataFrame) -> DataFrame:
    """SQL's NOT IN: a null on either side is unknown, so one null in the list leaves nothing, and an empty list leaves all."""
    ids = bad.select(F.col(bad.columns[0]).alias("_bad"))
    marks = ids.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_bad").isNull()).alias("nulls")).first()
    if marks["n"] == 0:
        return rows
    if marks["nulls"]:
        return rows.where(F.lit(False))
    return rows.where(F.col(column).isNotNull()).join(ids, F.col(column) == F.col("_bad"), "left_anti")


def visit_messages(thinned: DataFrame, vessel_ids: DataFrame, start: dt.date, end: dt.date, bad_segments: DataFrame | None = None) -> DataFrame:
    """Thinned messages with vessel ids. A segment that is twice in the map gives its messages twice."""
    d = thinned.where(in_days(F.col("timestamp"), start, end)).join(vessel_ids.select("seg_id", "ssvid", "vessel_id"), F.col("identifier") == F.col("seg_id")).drop("identifier")
    return d if bad_segments is None else not_in(d, "seg_id", bad_segments)


def anchorage_source(named: DataFrame) -> DataFrame:
    return named.select(F.col("lat"), F.col("lon"), F.col("s2id"), F.col("label"))


def filter_text(spark: SparkSession, given: str) -> str:
    """A filter as it is given, or the content of the file that @path names."""
    return spark.read.text(given[1:], wholetext=True).first()["value"].strip() if given.startswith("@") else given


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("ssvid")).where("ssvid != ''")


def port_list(spark: SparkSession, path: str, list_no: int = 0) -> DataFrame:
    """A port list in CSV; a bad number stops the read. row_no is the place in the file."""
    rows = spark.read.csv(path, schema=PORT_LIST, header=True, mode="FAILFAST", multiLine=True).select("iso3", "label", "sublabel", "lat", "lon")
    name = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    return rows.withColumns({"source": F.lit(name), "list_no": F.lit(list_no), "row_no": F.monotonically_increasing_id()})


def override_list(spark: SparkSession, path: str) -> DataFrame:
    return port_list(spark, path).withColumn("s2id", s2_token(F.col("lat"), F.col("lon"), ANCHORAGE_LEVEL))


def polygons(spark: SparkSession, path: str) -> DataFrame:
    """Parquet of (file_order, iso_ter1, iso_sov1, rings)."""
    return spark.read.parquet(path).select("file_order", "iso_ter1", "iso_sov1", "rings")


def geojson_polygons(spark: SparkSession, path: str) -> DataFrame:
    """A GeoJSON feature collection of Polygons and MultiPolygons with properties ISO_TER1 and ISO_SOV1."""
    schema = "features array<struct<properties:struct<ISO_TER1:string,ISO_SOV1:string>,geometry:struct<type:string,coordinates:string>>>"
    f = spark.read.json(path, schema=schema, multiLine=True).select(F.posexplode("features").alias("file_order", "f"))
    one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.flatten(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>"))
    rings = F.when(F.col("f.geometry.type") == "MultiPolygon", many).otherwise(one)
    as_points = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))))
    return f.select("file_order", F.col("f.properties.ISO_TER1").alias("iso_ter1"), F.col("f.properties.ISO_SOV1").alias("iso_sov1"), as_points.alias("rings"))
