"""Thinning of tracks: greedy by time, and smart thinning that keeps what later steps can tell apart."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.config import THIN_SECONDS, Config
from quayside.operators.state import with_states


def ordered_scan(records: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """Each key's rows in one partition and in order: the fold below then reads them as a stream and holds none."""
    return records.repartition(F.col(key)).sortWithinPartitions(key, *(F.col(c).asc_nulls_first() for c in order))


def greedy_thin(records: DataFrame, key: str = "ident", seconds: int = THIN_SECONDS) -> DataFrame:
    """Keeps a record if at least `seconds` have passed since the last kept one of its key.

    A fold over a sorted stream; its only state is the last kept time."""
    step = seconds * 1_000_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, kept_at = None, 0
        for b in batches:
            keys, ts = b.column("_k").to_pylist(), b.column("_t").to_numpy(zero_copy_only=False)
            keep = np.zeros(len(ts), bool)
            for i, (k, t) in enumerate(zip(keys, ts.tolist(), strict=True)):
                if k != current or t - kept_at >= step:
                    current, kept_at, keep[i] = k, t, True
            yield b.filter(pa.array(keep)).select(names)

    names = records.columns
    rows = ordered_scan(records.withColumns({"_k": F.col(key).cast("string"), "_t": F.unix_micros("timestamp")}), "_k", ("_t", "speed", "lat", "lon"))
    return rows.mapInArrow(run, records.schema)


def smart_thin(records: DataFrame, config: Config, key: str = "seg_id") -> DataFrame:
    """Per key and day: the first and last record, both sides of every change of state and of every gap.

    records have port_dist and the other nearest-port columns. State starts anew each day."""
    group = (key, "day")
    order = [F.col(c).asc_nulls_first() for c in ("timestamp", "speed", "lat", "lon")]
    w = Window.partitionBy(*group).orderBy(*order)
    rows = records if "day" in records.columns else records.withColumn("day", F.to_date("timestamp"))
    d = with_states(rows, config, group, ("timestamp", "speed", "lat", "lon"))
    gap_after = F.unix_micros("timestamp") - F.unix_micros(F.lag("timestamp").over(w)) >= config.min_gap * 60_000_000
    d = d.withColumns(
        {
            "_first": F.row_number().over(w) == 1,
            "_last": F.lead(F.lit(1)).over(w).isNull(),
            "_gap": F.coalesce(gap_after, F.lit(False)),
            "_turn": F.coalesce(F.lag("state").over(w) != F.col("state"), F.lit(False)),
        }
    )
    ahead = lambda c: F.coalesce(F.lead(c).over(w), F.lit(False))
    d = d.withColumn("_keep", F.col("_first") | F.col("_last") | F.col("_turn") | F.col("_gap") | ahead("_turn") | ahead("_gap"))
    d = d.withColumn("is_possible_gap_end", F.col("_first") | F.col("_gap"))
    return d.where("_keep").drop("_first", "_last", "_gap", "_turn", "_keep", "in_port", "stopped", "state")
