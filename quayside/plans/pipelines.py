"""The five entry points, each one plan from its inputs to its output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.config import Config
from quayside.operators.anchorages import find_anchorages
from quayside.operators.events import port_events
from quayside.operators.naming import name_anchorages
from quayside.operators.nearest import tag_nearest
from quayside.operators.records import create_records, create_tagged_records_by_day, dedup_by_timestamp, long_enough, only_locations
from quayside.operators.stationary import cell_marks, number_and_measure
from quayside.operators.thinning import greedy_thin, smart_thin
from quayside.operators.visits import port_visits, voyages
from quayside.sources.scans import anchorage_positions, thinning_positions, visit_messages

__all__ = ["anchorages", "name_anchorages", "thin_port_messages", "visits", "generate_voyages"]


def anchorages(positions: DataFrame, segments: DataFrame, fishing: DataFrame, config: Config, start: dt.date, end: dt.date, legacy_destination: bool = False) -> DataFrame:
    """Unnamed anchorages from positions and daily segment destinations.

    The segment's destination is carried to the position; legacy_destination writes "" everywhere, as older tables have it."""
    r = only_locations(create_records(anchorage_positions(positions, segments, start, end))).drop("kind")
    r = long_enough(dedup_by_timestamp(r, "ident"), config.min_positions, "ident")
    r = r.withColumn("destination", F.lit("") if legacy_destination else F.coalesce("destination", F.lit("")))
    return find_anchorages(cell_marks(number_and_measure(greedy_thin(r), config)), fishing, config.min_vessels)


def thin_port_messages(positions: DataFrame, named: DataFrame, config: Config, start: dt.date, end: dt.date, ssvids: DataFrame | list[str] | str | None = None) -> DataFrame:
    """Positions with the nearest anchorage, thinned to those that port events depend on. The nearest join comes before the
    windows, so these share one exchange on segment and day."""
    r = create_tagged_records_by_day(create_records(thinning_positions(positions, start, end, ssvids)))
    d = smart_thin(tag_nearest(r, named.select("s2id", "lat", "lon")), config, "ident")
    return d.select(F.col("ident").alias("identifier"), "timestamp", "lon", "lat", "speed", "is_possible_gap_end", "port_s2id", "port_dist", "port_lon", "port_lat")


def visits(thinned: DataFrame, vessel_ids: DataFrame, config: Config, start: dt.date, end: dt.date, bad_segments: DataFrame | None = None) -> DataFrame:
    return port_visits(port_events(visit_messages(thinned, vessel_ids, start, end, bad_segments), config, end), config)


def generate_voyages(port_visit_rows: DataFrame, min_confidence: int = 2) -> DataFrame:
    if min_confidence not in (2, 3, 4):
        raise ValueError("min_confidence is 2, 3 or 4")
    return voyages(port_visit_rows, min_confidence)
