"""Live positions: an extension of the batch engine, which has no streams of its own.

The stateless steps (classes, nearest anchorage) run on a stream as they are. Repeats of a message within the watermark are
dropped by Structured Streaming's own state. Port events stay in batch: their order within a day decides them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.nearest import tag_nearest
from quayside.operators.records import create_records, only_locations


def tag_live(messages: DataFrame, anchorages: DataFrame, late: str = "1 hour") -> DataFrame:
    """A stream of messages (ident, timestamp, lat, lon, speed) as located records with their nearest anchorage.

    anchorages is a batch table of (s2id, lat, lon), read anew for each micro-batch."""
    once = messages.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["ident", "timestamp"])
    return tag_nearest(only_locations(create_records(once)), anchorages)


def write_live(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return records.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
