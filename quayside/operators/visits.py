"""Port visits from port events, and voyages from visits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.config import Config
from quayside.functions.geo import flat_nm
from quayside.functions.ids import trip_id, visit_id
from quayside.operators.events import ENTRY, EXIT, GAP_BEGIN, GAP_END, STOP_BEGIN, STOP_END, TYPE_ORDER

_TIES = ("anchorage_id", "lat", "lon", "vessel_lat", "vessel_lon", "ssvid", "seg_id")


def type_order(kind: Column) -> Column:
    at = F.array_position(F.array(*map(F.lit, TYPE_ORDER)), kind)
    return F.when(at > 0, at).otherwise(F.raise_error(F.concat(F.lit("unknown event type "), F.coalesce(kind, F.lit("null")))).cast("bigint"))


def confidence(has_stop_or_gap: Column, has_entry: Column, has_exit: Column) -> Column:
    return (
        F.when(has_stop_or_gap & has_entry & has_exit, 4).when(has_stop_or_gap & (has_entry | has_exit), 3).when(has_stop_or_gap, 2).when(has_entry | has_exit, 1)
        .otherwise(F.raise_error(F.lit("a visit has none of the expected event types")).cast("int"))
    )


def sessionise(events: DataFrame, max_interseg_nm: float) -> DataFrame:
    """Adds seq, an event's place in its vessel's order, and visit_no: a visit starts at an entry, after an exit, and
    where the ports of two segments are farther apart than max_interseg_nm."""
    order = [F.col("timestamp"), F.col("_order"), *(F.col(c).asc_nulls_first() for c in _TIES)]
    w = Window.partitionBy("vessel_id").orderBy(*order)
    d = events.withColumn("_order", type_order(F.col("event_type"))).withColumn("seq", F.row_number().over(w))
    lag = lambda c: F.lag(c).over(w)
    far = (lag("seg_id") != F.col("seg_id")) & (flat_nm(lag("lat"), lag("lon"), F.col("lat"), F.col("lon")) > max_interseg_nm)
    starts = (F.col("seq") == 1) | (F.col("event_type") == ENTRY) | (lag("event_type") == EXIT) | F.coalesce(far, F.lit(False))
    d = d.withColumn("_starts", F.coalesce(starts, F.lit(False)).cast("int"))
    return d.withColumn("visit_no", F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_order", "_starts")


def port_visits(events: DataFrame, config: Config) -> DataFrame:
    """One row for each visit. Its confidence counts all events; its event array the first and last max_events / 2."""
    d = sessionise(events, config.max_interseg_nm)
    visit = Window.partitionBy("vessel_id", "visit_no")
    half = config.max_events // 2
    d = d.withColumns({"_n": F.count(F.lit(1)).over(visit), "_nth": F.row_number().over(visit.orderBy("seq"))})
    shown = (F.col("_n") <= config.max_events) | (F.col("_nth") <= half) | (F.col("_nth") > F.col("_n") - half)
    nested = F.struct("seq", "seg_id", "timestamp", "lat", "lon", "vessel_lat", "vessel_lon", "anchorage_id", "event_type")
    end = F.struct("timestamp", "lat", "lon", "anchorage_id")
    has = lambda *kinds: F.bool_or(F.col("event_type").isin(*kinds))
    v = d.groupBy("vessel_id", "visit_no").agg(
        F.first("visit_ssvid").alias("ssvid"),
        F.min_by(end, "seq").alias("start"),
        F.max_by(end, "seq").alias("end"),
        F.count(F.lit(1)).alias("n_events"),
        has(STOP_BEGIN, STOP_END, GAP_BEGIN, GAP_END).alias("_still"),
        has(ENTRY).alias("_entry"),
        has(EXIT).alias("_exit"),
        F.sort_array(F.collect_list(F.when(shown, nested))).alias("events"),
    )
    hours = (F.unix_micros("end.timestamp") - F.unix_micros("start.timestamp")) / F.lit(3.6e9)
    bare = F.transform("events", lambda e: e.dropFields("seq"))
    return v.select(
        visit_id(F.col("vessel_id"), F.col("start.timestamp"), F.col("start.lon"), F.col("start.lat")).alias("visit_id"),
        "ssvid", "vessel_id",
        *(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("start", "end") for c in ("timestamp", "lat", "lon", "anchorage_id")),
        hours.alias("duration_hrs"), bare.alias("events"), confidence(F.col("_still"), F.col("_entry"), F.col("_exit")).cast("long").alias("confidence"), F.col("n_events"),
    )


def drop_new_fields(visits: DataFrame) -> DataFrame:
    return visits.drop("ssvid", "duration_hrs", "confidence")


def visits_ended_since(visits: DataFrame, first: dt.date, min_confidence: int = 2) -> DataFrame:
    return visits.where((F.to_date("end_timestamp") >= F.lit(first)) & (F.col("confidence") >= min_confidence))


def voyages(visits: DataFrame, min_confidence: int) -> DataFrame:
    """The way from each visit to the vessel's next: n visits make n + 1 voyages, the first without a start, the last without
    an end. Visits of null vessels stand alone. A window and an appended tail row take the place of a self-join."""
    ended = F.to_timestamp(F.lit("1979-01-01"))  # end of dummy visits in old tables
    v = visits.where((F.col("confidence") >= min_confidence) & (F.col("end_timestamp") != ended))
    w = Window.partitionBy("vessel_id").orderBy("start_timestamp", "end_timestamp", "visit_id")
    row = F.struct("ssvid", "vessel_id", "visit_id", "start_timestamp", "start_anchorage_id", "end_timestamp", "end_anchorage_id", "confidence")
    known = F.col("vessel_id").isNotNull()
    v = v.select(row.alias("now"), F.when(known, F.lag(row).over(w)).alias("before"), (~known | F.lead(F.lit(1)).over(w).isNull()).alias("tail"))
    none = F.lit(None).cast(v.schema["now"].dataType)
    pair = F.struct(F.col("before").alias("p"), F.col("now").alias("n"))
    pairs = F.when(F.col("tail"), F.array(pair, F.struct(F.col("now").alias("p"), none.alias("n")))).otherwise(F.array(pair))
    v = v.select(F.explode(pairs).alias("x")).select("x.*")
    either = lambda c: F.coalesce(F.col(f"n.{c}"), F.col(f"p.{c}"))
    return v.select(
        either("ssvid").alias("ssvid"), either("vessel_id").alias("vessel_id"),
        F.col("p.end_timestamp").alias("trip_start"), F.col("n.start_timestamp").alias("trip_end"),
        F.col("p.end_anchorage_id").alias("trip_start_anchorage_id"), F.col("n.start_anchorage_id").alias("trip_end_anchorage_id"),
        F.col("p.visit_id").alias("trip_start_visit_id"), F.col("n.visit_id").alias("trip_end_visit_id"),
        F.col("p.confidence").alias("trip_start_confidence"), F.col("n.confidence").alias("trip_end_confidence"),
        trip_id(either("ssvid"), either("vessel_id"), F.col("p.end_timestamp")).alias("trip_id"),
    )
