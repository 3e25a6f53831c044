"""Gives the executors this package, so that Python functions work on a cluster where only the driver has it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application; a small archive of the package's modules."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="quayside-"), "quayside.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _SENT.add(app)


def shipped(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """f(spark, ...) with the package sent first."""

    @wraps(f)
    def run(spark: SparkSession, *args: object) -> DataFrame:
        ship(spark)
        return f(spark, *args)

    return run
