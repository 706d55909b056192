"""Exact checks of multisets against each other, each in one shuffle of signed counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PartitionBroken(RuntimeError):
    """Source, facts and exclusions that don't fit, with how often."""


def _counted(frames: dict[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """How often each key is in each of the frames; a null is a value like others."""
    one = lambda own: [F.lit(int(n == own)).cast("bigint").alias(f"n_{n}") for n in frames]
    rows = reduce(DataFrame.unionByName, [df.select(*key, *one(n)) for n, df in frames.items()])
    return rows.groupBy(*key).agg(*[F.sum(f"n_{n}").alias(f"n_{n}") for n in frames])


def partition_issues(source: DataFrame, parts: dict[str, DataFrame], key: Sequence[str]) -> DataFrame:
    """Keys by which the parts are no exact partition of the source: the key, its count in each (n_source, n_<part>) and `issues`.

    GAP: in the source and no part; STRANGER: in a part and not in the source; OVERLAP: in several parts; REPEATED: more than once in the source or in a part.
    No rows: every key of the source is once in it and once in exactly one part. One shuffle, with counts added up before it, and no set differences.
    """
    counts = _counted({"source": source} | parts, key)
    own = [F.col(f"n_{p}") for p in parts]
    met = reduce(lambda a, b: a + b, [(n > 0).cast("int") for n in own])
    most = reduce(lambda a, b: a | b, [n > 1 for n in [F.col("n_source"), *own]])
    n = F.col("n_source")
    issues = F.array_compact(F.array(F.when((n > 0) & (met == 0), "GAP"), F.when(n == 0, "STRANGER"), F.when(met > 1, "OVERLAP"), F.when(most, "REPEATED")))
    return counts.withColumn("issues", issues).where(F.size("issues") > 0)


def partition_result(source: DataFrame, facts: DataFrame, excluded: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: source_count, fact_count and excluded_count of an exact partition. Anything else fails with FACT_PARTITION_BROKEN as it is read."""
    counts = _counted({"source": source, "facts": facts, "excluded": excluded}, key)
    fits = (F.col("n_source") == 1) & (F.col("n_facts") + F.col("n_excluded") == 1)
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    total = F.when(F.count_if(~fits) > 0, F.raise_error(F.lit("FACT_PARTITION_BROKEN")).cast("bigint")).otherwise(n("n_source"))
    return counts.agg(total.alias("source_count"), n("n_facts").alias("fact_count"), n("n_excluded").alias("excluded_count"))


def membership_issues(wanted: DataFrame, found: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with MISSING (wanted and not found), UNEXPECTED (found and not wanted) or REPEATED (in either); no rows: both are one set."""
    w, f = F.col("n_wanted"), F.col("n_found")
    issue = F.when(f == 0, "MISSING").when(w == 0, "UNEXPECTED").when((w > 1) | (f > 1), "REPEATED")
    return _counted({"wanted": wanted, "found": found}, key).withColumn("issue", issue).where("issue is not null").select(*key, "issue")
