"""What the operators of this package share: word rules, the staging of intermediate tables, table access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_STAGED: list[str] = []
_PATHS: dict[int, tuple[DataFrame, str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column | str) -> Column:
    """The words of a text as an array; none for null."""
    return F.regexp_extract_all(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), F.lit(WORD), F.lit(0))


def byte_size(text: Column | str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: what the cluster names. Where none is named, a temporary one in local mode,
    as in tests; on a cluster, whose executors would each write to a disk of their own, an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isEmpty():
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quayside-"))
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
    return found.get().rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts the lineage, fixes what
    depends on a run (partition numbers, random order), and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quayside-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = (out, path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def unstage(*tables: DataFrame) -> None:
    """Deletes tables made by stage() that no later result reads: whatever was made of them has been staged itself."""
    for t in tables:
        _, path = _PATHS.pop(id(t), (None, None))
        if path is not None:
            _STAGED.remove(path)
            _delete(t.sparkSession, path)


def clear_staged(spark: SparkSession) -> int:
    """Deletes the tables staged so far; call it when the results that read them have been written. Their number."""
    n = len(_STAGED)
    _PATHS.clear()
    while _STAGED:
        _delete(spark, _STAGED.pop())
    return n


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
