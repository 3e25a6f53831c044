"""In-port and stopped states of a track, as windows only.

Both are hysteresis: a definite reading sets the state, one in the band between the limits keeps it. Carrying the last definite
reading forward is a window. A stop carries through the band only while every record since the last definite speed was in
port, as leaving port ends it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.config import Config

AT_SEA, IN_PORT, STOPPED = "AT_SEA", "IN_PORT", "STOPPED"


def with_states(records: DataFrame, config: Config, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds in_port, stopped and state. records have port_dist (null: no port near) and speed."""
    by = [F.col(c).asc_nulls_first() for c in order]
    upto = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dist, speed = F.col("port_dist"), F.col("speed")
    near = F.when(dist <= config.entry_km, True).when((dist > config.entry_km) & (dist < config.exit_km), None).otherwise(False)
    still = F.when(speed <= config.stop_begin, True).when(speed >= config.stop_end, False)
    d = records.withColumns({"_still": still, "in_port": F.coalesce(F.last(near, ignorenulls=True).over(upto), F.lit(False))})
    d = d.withColumn("_run", F.count("_still").over(upto))
    run = Window.partitionBy(*keys, "_run").orderBy(*by)
    before = F.min("in_port").over(run.rowsBetween(Window.unboundedPreceding, -1))
    begun = F.first("_still").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("stopped", F.coalesce(begun & (F.col("_still").isNotNull() | before), F.lit(False)))
    return d.withColumn("state", combined_state(F.col("in_port"), F.col("stopped"))).drop("_still", "_run")


def combined_state(in_port: Column, stopped: Column) -> Column:
    return F.when(~in_port, AT_SEA).when(stopped, STOPPED).otherwise(IN_PORT)
