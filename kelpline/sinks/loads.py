"""Loads of objects into a table, each once, with a ledger of what was loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.sinks.release import Conflict, exists

LEDGER = "event_id string, object_key string, object_sha256 string, status string, rows_parsed bigint, rows_loaded bigint"


def ledger_of(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], LEDGER)


def load_objects(rows: DataFrame, target: str, ledger: str) -> DataFrame:
    """Load the rows of objects (object_key, object_sha256 and more) that the ledger doesn't have, into a folder an object.

    One row an object: LOADED with rows_parsed and rows_loaded, as counted in what was given and in what was written, or REPLAY_SKIPPED with zeros. An object
    whose digest differs from the ledger's, or that comes with two, is a Conflict, and nothing is loaded. An object's folder is replaced as a whole, and
    the ledger is written after it: a load that was cut off is made again and leaves each row once. For one load at a time.
    """
    spark = rows.sparkSession
    known = ledger_of(spark, ledger).where("status = 'LOADED'").select("object_key", F.col("object_sha256").alias("known_sha256"))
    objects = rows.groupBy("object_key").agg(F.count("*").alias("rows_parsed"), F.min("object_sha256").alias("object_sha256"), F.max("object_sha256").alias("other_sha256"))
    objects = objects.join(known, "object_key", "left")
    bad = objects.where((F.col("object_sha256") != F.col("other_sha256")) | (F.col("object_sha256") != F.col("known_sha256"))).orderBy("object_key").first()
    if bad is not None:
        raise Conflict(f"{bad['object_key']} comes with another digest")
    fresh = rows.join(known, "object_key", "left_anti")
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("object_key").parquet(target)
    zero = F.lit(0).cast("bigint")
    event = F.sha2(F.concat_ws(":", F.octet_length("object_key").cast("string"), "object_key", "object_sha256").cast("binary"), 256)
    counts = loaded_rows(spark, rows, target).groupBy("object_key").agg(F.count("*").alias("n"))
    done = objects.where("known_sha256 is null").join(counts, "object_key").select(event.alias("event_id"), "object_key", "object_sha256", F.lit("LOADED").alias("status"), "rows_parsed", F.col("n").alias("rows_loaded"))
    # what was skipped is told by the state before this load's own events are there
    skipped = objects.where("known_sha256 is not null").select("object_key").collect()  # a row an object
    done.write.mode("append").parquet(ledger)
    report = rows.groupBy("object_key").agg(F.count("*").alias("rows_parsed"))
    again = spark.createDataFrame(skipped, "object_key string").withColumn("again", F.lit(True))
    report = report.join(again, "object_key", "left").join(ledger_of(spark, ledger).select("object_key", "rows_loaded"), "object_key")
    skip = F.col("again").isNotNull()
    return report.select("object_key", F.when(skip, "REPLAY_SKIPPED").otherwise("LOADED").alias("status"), F.when(skip, zero).otherwise(F.col("rows_parsed")).alias("rows_parsed"), F.when(skip, zero).otherwise(F.col("rows_loaded")).alias("rows_loaded"))


def loaded_rows(spark: SparkSession, like: DataFrame, target: str) -> DataFrame:
    """The table, with the columns of the rows that were loaded."""
    return spark.read.schema(like.schema).parquet(target).select(like.columns)
