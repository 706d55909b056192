"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of times that its documents are repeated: its target share of all
characters over its own share. A document's count is the inverse of the Poisson distribution with that mean, at
a uniform number from a hash of the seed and its id; it is exploded by its count, and all copies are put in
an order by another hash, over ranges of that hash. So a run can be repeated exactly, and no task draws numbers.

Target shares are given, by source, or follow from the sources' sizes to the power of `alpha` (1: as
they are; 0: all equal). With given shares, sources that aren't named get none.

Only one row for each source is gathered. If the steps of all are more than 4 * `common.BROADCAST_ROWS` numbers, the join is shuffled, salted
by `SALTS`, as one source may hold much of all rows.

Defined cases: null text has no characters; it is drawn like others. A null source is a source of its own (named by None).
A null doc_id draws as an empty id. Rows that repeat a doc_id draw alike, and their copies follow each other
by text. A source without characters gets no share and its documents a rate of 1. A text of any length counts whole. Extra columns pass
through `mix`; one with the name of `info` is refused. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.llm.common import BROADCAST_ROWS, Scratch, free, unused
from kelpline.llm.spans import let

SEED, ALPHA, SALTS = 20, 0.5, 16


def uniform(seed: int, what: str, doc_id: Column) -> Column:
    """13 hexadecimal digits of an MD5: a whole number below 16^13."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(what), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")


def with_steps(rates: DataFrame) -> DataFrame:
    """rates (source, rate) with `least`, a number of copies, and `steps`: the probabilities of at most least, least + 1, ... copies.

    They begin 12 standard deviations below the mean, where nothing is lost that a double could show, and end where less than 2^-53 is left;
    so a rate r takes some 24 * sqrt(r) of them, summed up by one window for each source.
    """
    rate, k = F.col("rate"), F.col("k")
    low = F.floor(rate - 12 * F.sqrt(rate) - 40).cast("bigint")
    low = F.when((rate > 0) & (low > 100), low).otherwise(F.lit(0).cast("bigint"))
    high = F.when(rate > 0, F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    rows = rates.select("source", "rate", low.alias("least"), F.explode(F.sequence(low, high)).alias("k"))
    x = F.greatest(F.col("least"), F.lit(1)).cast("double")
    # Stirling's series for the logarithm of the factorial; from 100 on its error is below a double's
    factorial = x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x)
    first = F.when(F.col("least") > 0, x * F.log(rate) - factorial).otherwise(0.0) - rate
    w = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log = F.sum(F.when(k == F.col("least"), first).otherwise(F.log(rate) - F.log(k.cast("double")))).over(w)
    rows = rows.withColumn("p", F.when(rate > 0, F.exp(log)).otherwise(1.0)).withColumn("p", F.sum("p").over(w))
    steps = F.transform(F.array_sort(F.collect_list(F.struct("k", "p"))), lambda s: s["p"])
    return rows.groupBy("source").agg(F.first("rate").alias("rate"), F.first("least").alias("least"), steps.alias("steps"))


def rates(docs: DataFrame, targets: dict[str | None, float] | None = None, alpha: float = ALPHA) -> DataFrame:
    """source, n_docs, chars, rate: one row for each source."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).alias("chars"))
    if targets is None:
        weight = F.when(F.col("chars") > 0, F.pow(F.col("chars").cast("double"), F.lit(alpha))).otherwise(0.0)
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items()], "source string, w double").withColumnRenamed("source", "s")
        sizes = sizes.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")  # as many rows as the caller named
        weight = F.when(F.col("chars") > 0, F.coalesce("w", F.lit(0.0))).otherwise(0.0)
    totals = sizes.withColumn("w_", weight).agg(F.sum("chars").alias("all"), F.sum("w_").alias("ws"))
    out = sizes.withColumn("w_", weight).crossJoin(F.broadcast(totals))  # totals: one row
    rate = F.when(F.col("chars") > 0, F.col("w_") / F.col("ws") * F.col("all") / F.col("chars")).otherwise(1.0)
    return out.select("source", "n_docs", "chars", rate.alias("rate"))


def mix(docs: DataFrame, targets: dict[str | None, float] | None = None, alpha: float = ALPHA, seed: int = SEED, info: str | None = None) -> DataFrame:
    """The copies, in shuffled order, with all columns of docs; info: the name of one more column, a struct of n_copies, copy and place."""
    if info is not None:
        free(docs, info)
    scratch = Scratch(docs.sparkSession, "mixing")
    table = scratch.save(with_steps(rates(docs, targets, alpha)))
    steps, least, n, copy, place = (unused(docs, x) for x in ("steps_", "least_", "n_", "copy_", "place_"))
    table = table.select(F.col("source").alias(source := unused(docs, "source_")), F.col("least").alias(least), F.col("steps").alias(steps))
    # rows hold an array each, whose lengths count
    if (table.agg(F.sum(F.size(steps) + 10)).first()[0] or 0) <= BROADCAST_ROWS * 4:
        out = docs.join(F.broadcast(table), F.col(source).eqNullSafe(docs["source"]))
    else:
        salt = unused(docs, "salt_")
        left = docs.withColumn(salt, F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)))
        right = table.withColumn(f"{salt}r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = left.join(right, left["source"].eqNullSafe(right[source]) & (left[salt] == right[f"{salt}r"]))
    u = uniform(seed, "count", docs["doc_id"]).cast("double") / F.lit(float(16**13))
    out = out.select(*[docs[c] for c in docs.columns], (F.col(least) + let(u, lambda x: F.size(F.filter(F.col(steps), lambda p: p <= x)))).alias(n)).where(F.col(n) > 0)
    out = out.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n))))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col(copy).cast("string"))
    out = out.withColumn(place, uniform(seed, "place", key))
    shuffled = out.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), place).sortWithinPartitions(place, "text")
    if info is None:
        return shuffled.select(*docs.columns)
    return shuffled.select(*docs.columns, F.struct(F.col(n).cast("bigint").alias("n_copies"), F.col(copy).cast("bigint").alias("copy"), F.col(place).alias("place")).alias(info))


