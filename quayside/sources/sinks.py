"""Outputs of the entry points, and table management."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"INTEGER": T.LongType(), "FLOAT": T.DoubleType(), "TIMESTAMP": T.TimestampType(), "STRING": T.StringType(), "DATE": T.DateType(), "BOOL": T.BooleanType()}


def write_thinned(messages: DataFrame, path: str) -> None:
    """One folder for each UTC day; only the days present are replaced."""
    d = messages.withColumn("date", F.to_date("timestamp"))
    d.repartition(F.col("date"), F.pmod(F.xxhash64("identifier"), F.lit(16))).sortWithinPartitions("date", "identifier", "timestamp").write.option("partitionOverwriteMode", "dynamic").partitionBy("date").mode("overwrite").parquet(path)


def write_visits(visits: DataFrame, path: str) -> None:
    """By month of the end, clustered by vessel."""
    d = visits.withColumn("month", F.to_date(F.date_trunc("month", "end_timestamp")))
    d.repartition(F.col("month"), F.pmod(F.xxhash64("vessel_id"), F.lit(16))).sortWithinPartitions("month", "ssvid", "vessel_id", "start_timestamp").write.partitionBy("month").mode("overwrite").parquet(path)


def write_table(rows: DataFrame, path: str) -> None:
    """Replaces the whole table: anchorages, named anchorages, voyages."""
    rows.write.mode("overwrite").parquet(path)


def clear_days(spark: SparkSession, table: str, column: str, start: str, end: str) -> None:
    """Empties the partitions of a catalog table from start to end, both included."""
    from datetime import date

    names = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    for n in names:
        day = n.split("=", 1)[1]
        if date.fromisoformat(start) <= date.fromisoformat(day) <= date.fromisoformat(end):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = DATE'{day}')")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, description: str = "", labels: dict[str, str] | None = None, partition: str | None = None) -> None:
    """Makes the table if it is missing, and brings its description and labels up to date."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet" + (f" PARTITIONED BY ({partition})" if partition else ""))
    props = {"comment": description} | (labels or {})
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{_sql(k)} = {_sql(v)}' for k, v in props.items())})")


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def query_into(spark: SparkSession, query: str, name: str, overwrite: bool = False) -> None:
    spark.sql(query).write.insertInto(name, overwrite=overwrite)


class SchemaBuilder:
    """Schemas field by field, of the types that the tables use."""

    def __init__(self) -> None:
        self.schema = T.StructType()

    def add(self, name: str, kind: str, mode: str = "REQUIRED", description: str | None = None) -> SchemaBuilder:
        if kind not in _TYPES:
            raise ValueError(f"unknown type {kind}")
        base: T.DataType = T.ArrayType(_TYPES[kind]) if mode == "REPEATED" else _TYPES[kind]
        self.schema.add(name, base, mode != "REQUIRED", {"comment": description} if description else None)
        return self


def schema_from_json(fields: list[dict]) -> T.StructType:
    """A list of {name, type, mode, description, fields} as a schema; records nest."""
    out = T.StructType()
    for f in fields:
        kind: T.DataType = schema_from_json(f["fields"]) if f["type"] == "RECORD" else _TYPES[f["type"]]
        mode = f.get("mode", "NULLABLE")
        out.add(f["name"], T.ArrayType(kind) if mode == "REPEATED" else kind, mode != "REQUIRED", {"comment": f["description"]} if f.get("description") else None)
    return out
