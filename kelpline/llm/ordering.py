"""Places of rows in a global order, found by range partitions: no task holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.llm.common import Scratch, small

#: monotonically_increasing_id() puts the partition above this bit.
PARTITION_BIT = 33


def in_order(scratch: Scratch, df: DataFrame, *keys: Column, at: str = "at", dealt_by: list[Column] | None = None) -> DataFrame:
    """df saved with `at`, which ascends in the order of the keys: the partition, and below it the place in it.

    The partitions are ranges of `dealt_by`, by default the keys; given, they must be such that rows in the order of the keys
    are in their order too, as a prefix of the keys is.
    """
    ranged = df.repartitionByRange(*(dealt_by or keys)).sortWithinPartitions(*keys)
    return scratch.save(ranged.withColumn(at, F.monotonically_increasing_id()))


def places(scratch: Scratch, ordered: DataFrame, group: str) -> DataFrame:
    """Rows of in_order(), sorted by `group` first, with `index` (from 0) and `total` of their group instead of `at`.

    Offsets come from one row a group and partition, so that a group of any size is spread over its partitions.
    """
    part = F.shiftright("at", PARTITION_BIT).alias("part")
    runs = ordered.groupBy(group, part).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_group = Window.partitionBy(group)
    before = F.sum("n").over(of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col(group).alias("group_"), F.col("part").alias("part_"), (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(of_group).alias("total"))
    runs = small(scratch.save(runs))
    joined = ordered.join(runs, ordered[group].eqNullSafe(runs["group_"]) & (F.shiftright("at", PARTITION_BIT) == runs["part_"]))
    return joined.withColumn("index", F.col("at") + F.col("shift")).drop("at", "group_", "part_", "shift")
