"""Send this package to executors that don't have it on their path."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's modules to the application, once; Spark hands them to every executor."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    top = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp()) / "kelpline.zip"
    with zipfile.ZipFile(at, "w") as out:
        for p in sorted(top.rglob("*.py")):
            out.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(at))
    _SENT.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
