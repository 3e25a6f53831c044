"""Contiguous shards of near-equal bytes, from global prefix sums that no single task computes.

Rows are put in ascending order of their id over range partitions; each partition's total is known from one small
aggregate, the running sum inside a partition from a window over that partition only. A row goes to the shard in which the
middle of its bytes falls when the whole table is cut at equal byte targets, so no shard differs from its target by more
than the largest row.

Defined cases: a null text has no bytes (crc32 0) and counts with its overhead alone; null ids come first; rows with equal ids
are ordered by crc32, then size; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import byte_size, shuffle_partitions, stage

OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, n_shards: int = 40, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard (null under this law)."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    rows = stage(
        docs.select(
            F.col("doc_id"),
            (byte_size("text") + F.lit(overhead)).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        ),
        "shard-sizes",
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    ranged = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
    # The partition number becomes data here: a later re-run of a task can't move a row.
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "shard-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("total"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ranged.withColumns({"upto": F.sum("size").over(inside), "nth": F.count(F.lit(1)).over(inside)})
    # One row for each range partition: bounded by the partition count, not by the data.
    placed = running.join(F.broadcast(totals), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("rows_before") + F.col("nth") - 1).alias("global_row"),
        # Exact up to 10^17 bytes: the middle of a row times the number of shards, over the total.
        F.expr(f"least({n_shards - 1}, cast((2 * (bytes_before + upto) - size) * {n_shards} div (2 * greatest(total, 1)) as int))").alias("shard"),
    )
    first = placed.groupBy("shard").agg(F.min("global_row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("global_row") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
