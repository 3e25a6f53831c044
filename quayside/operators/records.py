"""From raw messages to ordered, tagged position records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.config import MAX_SPEED

POSITION_ORDER = ("timestamp", "speed", "lat", "lon")


def is_location_message() -> Column:
    return F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("speed").isNotNull()


def has_valid_location() -> Column:
    return F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & F.col("speed").between(0, MAX_SPEED)


def has_destination() -> Column:
    return F.coalesce(F.col("destination") != "", F.lit(False))


def classify() -> Column:
    """location, info or invalid."""
    location = F.coalesce(is_location_message() & has_valid_location(), F.lit(False))
    return F.when(location, "location").when(has_destination(), "info").otherwise("invalid")


def create_records(messages: DataFrame, defaults: dict[str, object] | None = None, key: str = "ident") -> DataFrame:
    """Adds kind; missing columns get their defaults, null idents and invalid rows are dropped."""
    for name, value in ({"destination": None} | (defaults or {})).items():
        if name not in messages.columns:
            messages = messages.withColumn(name, F.lit(value).cast("string") if value is None else F.lit(value))
    return messages.withColumn("kind", classify()).where(F.col(key).isNotNull() & (F.col("kind") != "invalid"))


def only_locations(records: DataFrame) -> DataFrame:
    return records.where(F.col("kind") == "location")


def dedup_by_timestamp(records: DataFrame, *keys: str) -> DataFrame:
    """The first record of each key and timestamp, in order of speed, lat, lon.

    The window is that of tagging and thinning, so all of them share one exchange and one sort."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).asc_nulls_first() for c in POSITION_ORDER))
    return records.withColumn("_before", F.lag("timestamp").over(w)).where(~F.col("timestamp").eqNullSafe(F.col("_before")) | F.col("_before").isNull()).drop("_before")


def long_enough(records: DataFrame, minimum: int, *keys: str) -> DataFrame:
    """Records of keys that have at least `minimum` of them.

    A count beside the rows, joined on the key: unlike a window it never holds a key's rows in one task."""
    n = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= minimum).drop("_n")
    return records.join(n, list(keys), "left_semi")


def tag_records(records: DataFrame, *keys: str, legacy_destination: bool = False) -> DataFrame:
    """Each location with the destination of the last info record before it (at first ""); info records go."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).asc_nulls_first() for c in POSITION_ORDER)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.lit("") if legacy_destination else F.coalesce(F.last(F.when(F.col("kind") == "info", F.col("destination")), ignorenulls=True).over(w), F.lit(""))
    return records.withColumn("destination", last).where("kind = 'location'")


def with_day(records: DataFrame) -> DataFrame:
    return records.withColumn("day", F.to_date("timestamp"))


def create_tagged_records(messages: DataFrame, minimum: int, key: str = "ident") -> DataFrame:
    """Dedup, minimum count, tag; greedy thinning follows in `thinning`."""
    return tag_records(long_enough(dedup_by_timestamp(messages, key), minimum, key), key)


def create_tagged_records_by_day(messages: DataFrame, key: str = "ident") -> DataFrame:
    return tag_records(dedup_by_timestamp(with_day(messages), key, "day"), key, "day")


def segment_destination(destinations: Column) -> Column:
    """Of an array of (value, count), the value of the largest count, of equal ones the largest value; null if empty."""
    return F.array_max(F.transform(destinations, lambda d: F.struct(d["count"].alias("count"), d["value"].alias("value"))))["value"]


def mean_or_zero(x: Column) -> Column:
    return F.coalesce(F.avg(x), F.lit(0.0))
