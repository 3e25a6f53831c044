"""Ids made from other columns, and the run-length land mask."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc(ts: Column) -> Column:
    """ISO text of a timestamp (session time zone UTC); the fraction only if there is one."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def visit_id(vessel_id: Column, ts: Column, lon: Column, lat: Column) -> Column:
    return F.md5(F.concat_ws("-", vessel_id, iso_utc(ts), lon.cast("string"), lat.cast("string")))


def trip_id(ssvid: Column, vessel_id: Column, trip_start: Column) -> Column:
    """ssvid-vessel_id, and the start in milliseconds as 12 hexadecimal digits if there is one. Null if an id is null."""
    stem = F.concat(ssvid, F.lit("-"), vessel_id)
    tail = F.lpad(F.lower(F.hex(F.unix_millis(trip_start))), 12, "0")
    return F.when(trip_start.isNull(), stem).otherwise(F.concat(stem, F.lit("-"), tail))


def mask_hit(transitions: Column, column: Column) -> Column:
    """Whether a raster column is set, from the sorted columns at which its row changes."""
    return F.size(F.filter(transitions, lambda t: t <= column)) % 2 == 1


def mask_row(bits: Column) -> Column:
    """The columns at which a row of booleans changes, the first against false."""
    return F.filter(F.transform(bits, lambda b, i: F.when(b != F.coalesce(F.get(bits, i - 1), F.lit(False)), i)), lambda x: x.isNotNull())


def mask_lookup(transitions: Column, lat: Column, lon: Column, rows: int, columns: int) -> Column:
    """mask_hit for a point of a whole-globe raster, false outside its bounds."""
    inside = lat.between(-90, 90) & lon.between(-180, 180)
    col = F.least(F.lit(columns - 1), F.floor((lon + 180) / 360 * columns)).cast("int")
    return inside & mask_hit(transitions, col)


def mask_row_index(lat: Column, rows: int) -> Column:
    return F.least(F.lit(rows - 1), F.floor((90 - lat) / 180 * rows)).cast("int")


def day_list(start: Column, end: Column) -> Column:
    """The days from start up to but not with end."""
    return F.when(start < end, F.sequence(start, F.date_sub(end, 1))).otherwise(F.array().cast("array<date>"))
