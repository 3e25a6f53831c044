"""Port events of each vessel: entry, exit, stops and gaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.config import Config
from quayside.operators.state import AT_SEA, IN_PORT, STOPPED, with_states

ENTRY, EXIT, STOP_BEGIN, STOP_END, GAP_BEGIN, GAP_END = "PORT_ENTRY", "PORT_EXIT", "PORT_STOP_BEGIN", "PORT_STOP_END", "PORT_GAP_BEGIN", "PORT_GAP_END"
#: Events between two states; equal states have none.
TRANSITIONS = {
    (AT_SEA, IN_PORT): (ENTRY,),
    (AT_SEA, STOPPED): (ENTRY, STOP_BEGIN),
    (IN_PORT, AT_SEA): (EXIT,),
    (IN_PORT, STOPPED): (STOP_BEGIN,),
    (STOPPED, AT_SEA): (STOP_END, EXIT),
    (STOPPED, IN_PORT): (STOP_END,),
}
#: Order of events at one time.
TYPE_ORDER = (ENTRY, GAP_BEGIN, GAP_END, STOP_BEGIN, STOP_END, EXIT)
RECORD_ORDER = ("timestamp", "seg_id", "speed", "lat", "lon")


def transition_events(before: Column, now: Column) -> Column:
    out = F.lit(None).cast("array<string>")
    for (a, b), names in TRANSITIONS.items():
        out = F.when((before == a) & (now == b), F.array(*map(F.lit, names))).otherwise(out)
    return F.coalesce(out, F.array().cast("array<string>"))


def with_event_context(records: DataFrame, config: Config) -> DataFrame:
    """States, the state and time before, whether it is the last record, and the active port: that of the last record in port."""
    by = [F.col(c).asc_nulls_first() for c in RECORD_ORDER]
    w = Window.partitionBy("vessel_id").orderBy(*by)
    d = with_states(records, config, ("vessel_id",), RECORD_ORDER)
    port = F.when(F.col("in_port"), F.struct("port_s2id", "port_lat", "port_lon"))
    return d.withColumns(
        {
            "last_state": F.lag("state").over(w),
            "last_timestamp": F.lag("timestamp").over(w),
            "is_last": F.lead(F.lit(1)).over(w).isNull(),
            "active": F.last(port, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )


def gap_found(config: Config) -> Column:
    long = F.unix_micros("timestamp") - F.unix_micros("last_timestamp") >= config.min_gap * 60_000_000
    return F.coalesce(F.col("last_state").isin(IN_PORT, STOPPED) & F.col("is_possible_gap_end") & long, F.lit(False))


def port_events(records: DataFrame, config: Config, end_date: dt.date) -> DataFrame:
    """Events of every vessel up to end_date. One exchange on vessel_id; the windows and the explode after it share it."""
    d = with_event_context(records, config)
    micros = config.min_gap * 60_000_000
    last_possible = int((dt.datetime.combine(end_date, dt.time(), dt.UTC) + dt.timedelta(days=1)).timestamp() * 1_000_000) - 1

    def event(kind: Column, at: Column, lat: Column, lon: Column, before: Column) -> Column:
        return F.struct(kind.alias("event_type"), at.alias("timestamp"), lat.alias("vessel_lat"), lon.alias("vessel_lon"), before.alias("last_timestamp"))

    nowhere = F.lit(None).cast("double")
    after_gap = lambda ts: F.timestamp_micros(F.unix_micros(ts) + F.lit(micros))
    own, before = F.col("timestamp"), F.col("last_timestamp")
    none = F.array().cast("array<struct<event_type:string,timestamp:timestamp,vessel_lat:double,vessel_lon:double,last_timestamp:timestamp>>")
    gap = F.when(gap_found(config), F.array(event(F.lit(GAP_END), own, F.col("lat"), F.col("lon"), before), event(F.lit(GAP_BEGIN), after_gap(before), nowhere, nowhere, before))).otherwise(none)
    moves = F.transform(transition_events(F.col("last_state"), F.col("state")), lambda k: event(k, own, F.col("lat"), F.col("lon"), before))
    open_gap = F.col("is_last") & F.col("state").isin(IN_PORT, STOPPED) & (F.lit(last_possible) - F.unix_micros(own) >= micros)
    tail = F.when(open_gap, F.array(event(F.lit(GAP_BEGIN), after_gap(own), nowhere, nowhere, own))).otherwise(none)
    d = d.withColumn("_at", F.row_number().over(Window.partitionBy("vessel_id").orderBy(*(F.col(c).asc_nulls_first() for c in RECORD_ORDER))))
    e = d.select("vessel_id", "ssvid", "seg_id", "active", "_at", F.posexplode(F.concat(gap, moves, tail)).alias("_nth", "e"))
    # One ssvid for all of a vessel's visits: that of the first event emitted.
    e = e.withColumn("visit_ssvid", F.first("ssvid").over(Window.partitionBy("vessel_id").orderBy("_at", "_nth").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return e.select(
        "vessel_id", "ssvid", "visit_ssvid", "seg_id", "e.event_type", "e.timestamp", "e.last_timestamp",
        F.col("active.port_s2id").alias("anchorage_id"), F.col("active.port_lat").alias("lat"), F.col("active.port_lon").alias("lon"), "e.vessel_lat", "e.vessel_lon",
    )
