"""Stationary periods of a track.

A period's anchor is its first record; a record farther than `max_km` from it starts the next one. That fold reads each vessel's
sorted records as a stream and only numbers the periods, so it holds one anchor; all else is native."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.config import ANCHORAGE_LEVEL, EARTH_KM, Config
from quayside.functions.geo import haversine_km
from quayside.functions.s2 import s2_token
from quayside.operators.thinning import ordered_scan

_ORDER = ("timestamp", "speed", "lat", "lon")


def number_periods(records: DataFrame, max_km: float, key: str = "ident") -> DataFrame:
    """Adds period: 0, 1, ... along each key's records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, anchor, period = None, (0.0, 0.0), 0
        for b in batches:
            keys = b.column(key).to_pylist()
            lat, lon = np.radians(b.column("lat").to_numpy(zero_copy_only=False)), np.radians(b.column("lon").to_numpy(zero_copy_only=False))
            cos, out = np.cos(lat), []
            for i, k in enumerate(keys):
                if k != current:
                    current, anchor, period = k, (lat[i], lon[i], cos[i]), 0
                else:
                    h = np.sin((lat[i] - anchor[0]) / 2) ** 2 + anchor[2] * cos[i] * np.sin((lon[i] - anchor[1]) / 2) ** 2
                    if 2 * EARTH_KM * np.arcsin(np.sqrt(min(h, 1.0))) > max_km:
                        anchor, period = (lat[i], lon[i], cos[i]), period + 1
                out.append(period)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], [*b.schema.names, "period"])

    return ordered_scan(records, key, _ORDER).mapInArrow(run, records.schema.add("period", "long"))


def with_periods(numbered: DataFrame, min_minutes: int, key: str = "ident") -> DataFrame:
    """Beside each record its period: still (longer than min_minutes and not its key's last), first and last (in the period), and
    the struct period_stats: mean place, start, duration, first destination, count, root mean square distance from the mean place.

    All windows are within a key, so one exchange serves them."""
    whole = Window.partitionBy(key, "period")
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    along = whole.orderBy(*order)
    d = numbered.withColumns(
        {
            "_lat": F.avg("lat").over(whole), "_lon": F.avg("lon").over(whole), "_start": F.min("timestamp").over(whole), "_end": F.max("timestamp").over(whole), "_n": F.count(F.lit(1)).over(whole),
            "first": F.row_number().over(along) == 1, "last": F.lead(F.lit(1)).over(along).isNull(), "_to": F.first("destination").over(along), "_final": F.max("period").over(Window.partitionBy(key)),
        }
    )
    away = F.pow(haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")), F.lit(2))
    d = d.withColumns({"_rms": F.sqrt(F.avg(away).over(whole)), "_us": F.unix_micros("_end") - F.unix_micros("_start")})
    stats = F.struct(F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), F.col("_start").alias("start_time"), F.col("_end").alias("end_time"), F.col("_us").alias("duration_us"), F.col("_to").alias("destination"), F.col("_n").alias("n"), F.col("_rms").alias("rms_drift_radius"))
    d = d.withColumns({"still": (F.col("_us") > min_minutes * 60_000_000) & (F.col("period") < F.col("_final")), "period_stats": stats})
    return d.drop("_lat", "_lon", "_start", "_end", "_n", "_to", "_final", "_rms", "_us")


def stationary_periods(periods: DataFrame, key: str = "ident") -> DataFrame:
    """One row for each stationary period, with the cell of its mean place."""
    p = periods.where(F.col("still") & F.col("first")).select(key, "period", "period_stats.*")
    return p.withColumn("s2id", s2_token(F.col("lat"), F.col("lon"), ANCHORAGE_LEVEL))


def active_records(periods: DataFrame) -> DataFrame:
    """All records outside stationary periods, and the first and last of each inside, with their cells."""
    a = periods.where(~F.col("still") | F.col("first") | F.col("last")).drop("still", "first", "last", "period", "period_stats")
    return a.withColumn("s2id", s2_token(F.col("lat"), F.col("lon"), ANCHORAGE_LEVEL))


def number_and_measure(records: DataFrame, config: Config, key: str = "ident") -> DataFrame:
    return with_periods(number_periods(records, config.stationary_km, key), config.stationary_minutes, key)


def split_on_movement(records: DataFrame, config: Config, key: str = "ident") -> tuple[DataFrame, DataFrame]:
    """(stationary, active), each with s2id: of the mean place, and of the record."""
    p = number_and_measure(records, config, key)
    return stationary_periods(p, key), active_records(p)


def cell_marks(periods: DataFrame, key: str = "ident") -> DataFrame:
    """Both sides of the split as one table, so that nothing before it runs twice: s2id, the key, stay (a period's struct, or
    null) and moved (the UTC day of an active record, or null)."""
    cell = lambda lat, lon: s2_token(lat, lon, ANCHORAGE_LEVEL)
    stay, none = F.col("period_stats"), F.lit(None).cast("date")
    at_rest = F.struct(cell(stay["lat"], stay["lon"]).alias("s2id"), stay.alias("stay"), none.alias("moved"))
    on_move = F.struct(cell(F.col("lat"), F.col("lon")).alias("s2id"), F.lit(None).cast(periods.schema["period_stats"].dataType).alias("stay"), F.to_date("timestamp").alias("moved"))
    both = F.filter(F.array(F.when(F.col("still") & F.col("first"), at_rest), F.when(~F.col("still") | F.col("first") | F.col("last"), on_move)), lambda m: m.isNotNull())
    return periods.select(key, F.explode(both).alias("m")).select(key, "m.*")
