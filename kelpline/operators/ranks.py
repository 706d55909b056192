"""Exact order statistics of groups of any size, and the roll-up of a service's invocations."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keep = Callable[[str, DataFrame], DataFrame]


def beside(a: DataFrame, b: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """a joined with b on columns that may be null; b's own are left out."""
    renamed = b.withColumnsRenamed({c: f"{c}__" for c in by})
    on = reduce(lambda x, y: x & y, [a[c].eqNullSafe(renamed[f"{c}__"]) for c in by], F.lit(True))
    return a.join(renamed, on, how).drop(*[f"{c}__" for c in by])


def nearest_ranks(df: DataFrame, by: Sequence[str], value: str, fraction: str, keep: Keep, name: str = "nearest_rank") -> DataFrame:
    """For each group the least value that at least `fraction` of its values (nulls aside) don't exceed; by need not be unique or not null.

    Equal values are counted first, before any shuffle. Their counts are laid out in ranges of (group, value) and kept; a range is about one
    partition. One row for each group and range tells in which range the rank lies, and only that range is gone through, in order. So no task
    has more of a group than a range of it, and no buffer holds a group's values.
    """
    part = Decimal(fraction)
    if not 0 < part <= 1:
        raise ValueError("the fraction lies above 0, and at 1 at most")
    numerator, denominator = part.as_integer_ratio()
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("value_")).agg(F.count("*").alias("n_"))
    counts = keep(f"{name}-{uuid.uuid4().hex}", counts.repartitionByRange(*by, "value_").withColumn("range_", F.spark_partition_id()))
    ranges = counts.groupBy(*by, "range_").agg(F.sum("n_").alias("n_"))
    of = Window.partitionBy(*by)
    upto = F.sum("n_").over(of.orderBy("range_").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranges = ranges.select(*by, "range_", F.col("n_").alias("size_"), upto.alias("upto_"), F.sum("n_").over(of).cast("decimal(20,0)").alias("total_"))
    rank = F.expr(f"cast((total_ * {numerator} + {denominator - 1}) div {denominator} as bigint)")
    ranges = ranges.withColumn("rank_", rank).where((F.col("upto_") >= F.col("rank_")) & (F.col("upto_") - F.col("size_") < F.col("rank_")))
    ranges = ranges.select(*by, "range_", (F.col("upto_") - F.col("size_")).alias("before_"), "rank_")
    rows = beside(counts, ranges, [*by, "range_"])
    within = F.sum("n_").over(of.orderBy("value_").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reached = rows.withColumn("at_", F.col("before_") + within).where(F.col("at_") >= F.col("rank_"))
    return reached.groupBy(*by).agg(F.min("value_").alias(name))


# What may become of an invocation.
STATES = ("SUCCEEDED", "FAILED", "QUARANTINED")


def _raised(condition: Column, code: str, otherwise: Column, kind: str) -> Column:
    return F.when(condition, F.raise_error(F.lit(code)).cast(kind)).otherwise(otherwise)


def invocation_rollup(calls: DataFrame, by: Sequence[str], keep: Keep) -> DataFrame:
    """calls (by, invocation_id, state, input_tokens, output_tokens, cost, latency, error_code) by group: counts of each state, tokens, cost, latency
    and its nearest-rank 95th percentile, and the errors as an array of (code, n) in the order of codes.

    A negative number, a state of another name, an error without a code or a code without an error fails with AI_ENRICHMENT_OBSERVABILITY_INVALID, a repeated
    invocation_id of a group with AI_ENRICHMENT_OBSERVABILITY_DUPLICATE_INVOCATION. Sums are exact if the columns are.
    """
    numbers = ("input_tokens", "output_tokens", "cost", "latency")
    bad = ~F.coalesce(F.col("state").isin(*STATES), F.lit(False)) | ((F.col("state") == "SUCCEEDED") != F.col("error_code").isNull())
    for c in numbers:
        bad = bad | F.coalesce(F.col(c) < 0, F.lit(True))
    # by invocation first, so that repeats are seen without a set of all ids in one task
    each = calls.groupBy(*by, "invocation_id", "state", "error_code").agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"), *[F.sum(c).alias(c) for c in numbers])
    codes = each.groupBy(*by, "invocation_id").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.max("state").alias("state"), F.max("error_code").alias("code"), *[F.sum(c).alias(c) for c in numbers])
    by_code = codes.groupBy(*by, "code").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("bad").alias("bad"), *[F.count_if(F.col("state") == s).alias(s) for s in STATES], *[F.sum(c).alias(c) for c in numbers],
    )
    n = _raised(F.sum("bad") > 0, "AI_ENRICHMENT_OBSERVABILITY_INVALID", _raised(F.max("most") > 1, "AI_ENRICHMENT_OBSERVABILITY_DUPLICATE_INVOCATION", F.sum("n"), "bigint"), "bigint")
    errors = F.array_sort(F.collect_list(F.when(F.col("code").isNotNull(), F.struct("code", "n"))))  # a group's codes, not its calls
    out = by_code.groupBy(*by).agg(n.alias("invocations"), *[F.sum(s).alias(f"{s.lower()}_invocations") for s in STATES], *[F.sum(c).alias(f"total_{c}") for c in numbers], errors.alias("errors"))
    return beside(out, nearest_ranks(calls, by, "latency", "0.95", keep, "p95_latency"), by, "left")


def reconciled(rollup: DataFrame, ledger: DataFrame, by: Sequence[str]) -> DataFrame:
    """The roll-up, if each group's successes and cost are those of the ledger (by, valid_count, committed); else it fails with the code of what differs."""
    j = beside(rollup, ledger, by, "left")
    differs = lambda a, b: ~F.coalesce(F.col(a) == F.col(b), F.lit(False))
    n = _raised(differs("succeeded_invocations", "valid_count"), "AI_ENRICHMENT_OBSERVABILITY_COVERAGE_MISMATCH", F.col("invocations"), "bigint")
    n = _raised(differs("total_cost", "committed"), "AI_ENRICHMENT_OBSERVABILITY_BUDGET_MISMATCH", n, "bigint")
    return j.withColumn("invocations", n).select(*rollup.columns)


def cohort(orders: DataFrame, identity: str, lifetime: str) -> DataFrame:
    """One row for orders with the identity of their customer (null: unknown) and its orders over a lifetime: customers, those with several orders,
    their share (null without customers) and the orders of unknown customers. An identity with two lifetimes, or none, fails with COHORT_CONFLICT.

    Identities are brought down to a row each before they are counted, so no set of them is held in one task.
    """
    each = orders.groupBy(identity).agg(F.count("*").alias("n"), F.min(lifetime).alias("low"), F.max(lifetime).alias("high"), F.count_if(F.col(lifetime).isNull()).alias("unknown"))
    known = F.col(identity).isNotNull()
    conflict = F.count_if(known & (~F.col("low").eqNullSafe(F.col("high")) | (F.col("unknown") > 0)))
    n = F.count_if(known)
    customers = F.when(conflict > 0, F.raise_error(F.lit("COHORT_CONFLICT")).cast("bigint")).otherwise(n)
    repeats = F.count_if(known & (F.col("low") > 1))
    share = (repeats.cast("decimal(20,0)") / F.nullif(n, F.lit(0)).cast("decimal(20,0)")).cast("decimal(38,6)")
    return each.agg(customers.alias("customer_count"), repeats.alias("repeat_customer_count"), share.alias("repeat_customer_rate"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("unknown_customer_order_count"))
