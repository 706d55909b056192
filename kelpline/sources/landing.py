"""Source relations as landed: a folder for each dataset, release and batch, of which a build reads exactly one."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.functions.identities import dataset_run_id, ingestion_batch_id, source_object_id
from kelpline.sinks.release import create_only, exists

#: Ids are folder names; one that begins with a letter is never taken for a number.
_ID = re.compile(r"[A-Za-z][A-Za-z0-9_.=-]*")
CONTRACT_VERSION = "source-v1"


def batch_of(spark: SparkSession, release: str) -> str:
    """The id of the batch that loads a release, as its content says."""
    return spark.range(1).select(ingestion_batch_id(F.lit(release))).first()[0]


def _at(base: str, dataset: str, release: str, batch: str) -> str:
    if not all(_ID.fullmatch(x) for x in (release, batch)):
        raise ValueError("ids of a release and a batch begin with a letter, and have letters, digits and . _ - =")
    return f"{base}/{dataset}/source_release_id={release}/ingestion_batch_id={batch}"


def land(frames: dict[str, DataFrame], base: str, release: str, batch: str) -> dict[str, str]:
    """Write every relation of a release, each with its dataset_run_id: LOADED or REPLAY for each; other rows under the same ids are a Conflict."""
    out = {}
    for name, df in frames.items():
        source = source_object_id(F.lit(release), F.lit(name), F.lit(release))
        run = dataset_run_id(F.lit(batch), source, F.lit(name), F.lit(CONTRACT_VERSION))
        out[name] = create_only(df.withColumn("dataset_run_id", run), _at(base, name, release, batch))
    return out


def landed(spark: SparkSession, base: str, names: list[str], release: str, batch: str) -> dict[str, DataFrame]:
    """The relations of one release and batch, by filters on the folders' names: no file of another is listed as a split or read.

    A landing has one run, so that release, batch and run are constants of the frame, and shuffles don't carry them with every row.
    """
    out = {}
    for name in names:
        if not exists(spark, f"{_at(base, name, release, batch)}/_SUCCESS"):
            raise ValueError(f"{name} of {release}, {batch} is not there")
        rows = spark.read.parquet(f"{base}/{name}").where((F.col("source_release_id") == release) & (F.col("ingestion_batch_id") == batch))
        run = rows.select("dataset_run_id").first()
        out[name] = rows.withColumns({"dataset_run_id": F.lit(run[0] if run else None).cast("string"), "source_release_id": F.lit(release), "ingestion_batch_id": F.lit(batch)})
    return out
