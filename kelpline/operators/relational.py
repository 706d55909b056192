"""Relational operators that the models share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpline.functions.columns import weight_units


#: Rows that a task sorts or counts by key within some 50 MB.
PART_ROWS = 200_000


def parts_of(rows: DataFrame) -> int:
    """Partitions of at most some PART_ROWS rows. It counts the rows, for which Parquet needs no column."""
    return -(-rows.count() // PART_ROWS)


def dealt(rows: DataFrame, by: str, parts: int) -> DataFrame:
    """rows dealt by a column, in so many partitions, which are then left as they are.

    Partitions that Spark joins have up to 64 MB of compressed bytes, and rows many times as large in memory: sorts and hash tables spill. A few partitions are
    left to Spark.
    """
    return rows.repartition(parts, by) if parts > 4 else rows.repartition(by)


def latest_revision(df: DataFrame, keys: Sequence[str], effective_at: str | None = None) -> DataFrame:
    """One row for each key: the last by effective_at (if given), load time, row number and hash."""
    order = ([F.col(effective_at).desc_nulls_last()] if effective_at else []) + [F.col(c).desc() for c in ("ingested_at", "source_row_number", "record_hash")]
    return df.withColumn("source_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("source_rank = 1").drop("source_rank")


def revision_dispositions(df: DataFrame, keys: Sequence[str], effective_at: str) -> DataFrame:
    """CURRENT, LATE_SUPERSEDED or CORRECTION_SUPERSEDED for each revision; exact repeats are one row with their count.

    Late is what took effect before the current revision did; what took effect at the same time was corrected.
    """
    order = ("ingested_at", "source_row_number", "record_hash")
    once = df.groupBy(*keys, effective_at, *order).agg((F.count("*") - 1).alias("replays"))
    w = Window.partitionBy(*keys).orderBy(F.col(effective_at).desc_nulls_last(), *[F.col(c).desc() for c in order])
    ranked = once.withColumn("revision_rank", F.row_number().over(w))
    late = F.coalesce(F.col(effective_at) < F.first(effective_at).over(w), F.col(effective_at).isNull())
    return ranked.withColumn("disposition", F.when(F.col("revision_rank") == 1, "CURRENT").when(late, "LATE_SUPERSEDED").otherwise("CORRECTION_SUPERSEDED"))


def join_as_of(facts: DataFrame, history: DataFrame, on: str, event_at: str, key: str, unknown: Column, columns: Sequence[str] = ()) -> DataFrame:
    """facts with the key of the version of `history` that holds at event_at, and the unknown member's where none does.

    history: on, key, effective_from, effective_to (null: open; half-open ranges without overlaps).
    """
    h = history.select(F.col(on).alias("h_on"), F.col(key).alias("h_key"), F.col("effective_from").alias("h_from"), F.coalesce("effective_to", F.expr("timestamp_ntz '9999-12-31 00:00:00'")).alias("h_to"), *columns)
    holds = (facts[on] == h["h_on"]) & (facts[event_at] >= h["h_from"]) & (facts[event_at] < h["h_to"])
    return facts.join(h, holds, "left").withColumn(key, F.coalesce("h_key", unknown)).drop("h_on", "h_key", "h_from", "h_to")


def join_as_of_sorted(facts: DataFrame, history: DataFrame, on: str, event_at: str, key: str, unknown: Column, part: str = "day", refuse: bool = False) -> DataFrame:
    """As join_as_of, for keys of many versions: events and versions are put in one order of time, and each event takes the last version before it.

    A key's rows are split by `part` of time, so that no key is one task; the last version of the parts before is carried over
    by a window of one row for each key and part. Events without a key get the unknown member without a shuffle; versions without one are left out.
    refuse: a version that begins before another of its key ends, or that ends before it begins, fails the join as it is read (HISTORY_OVERLAPS); the
    greatest end so far comes from the same windows.
    """
    keyless = facts.where(F.col(on).isNull()).withColumn(key, unknown)
    facts, history = facts.where(F.col(on).isNotNull()), history.where(F.col(on).isNotNull())
    version = F.struct(F.col(key).alias("key"), F.coalesce("effective_to", F.expr("timestamp_ntz '9999-12-31 00:00:00'")).alias("to"))
    fact = F.struct(*[F.col(c) for c in facts.columns])
    events = facts.select(F.col(on).alias("on"), F.col(event_at).cast("timestamp_ntz").alias("at"), F.lit(None).cast(history.select(version.alias("v")).schema[0].dataType).alias("v"), fact.alias("fact"))
    versions = history.select(F.col(on).alias("on"), F.col("effective_from").cast("timestamp_ntz").alias("at"), version.alias("v"), F.lit(None).cast(events.schema["fact"].dataType).alias("fact"))
    rows = events.unionByName(versions).withColumn("part", F.date_trunc(part, "at"))
    # versions that begin at one time: the last of them to end holds
    lasts = rows.groupBy("on", "part").agg(F.max_by("v", F.when(F.col("v").isNotNull(), F.struct("at", "v.to"))).alias("last"), F.max("v.to").alias("end"))
    parts_before = Window.partitionBy("on").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.select(F.col("on").alias("on_"), F.col("part").alias("part_"), F.last("last", ignorenulls=True).over(parts_before).alias("before"), F.max("end").over(parts_before).alias("end_before"))
    in_order = Window.partitionBy("on", "part").orderBy("at", F.col("fact").isNotNull(), F.col("v.to"))
    own = F.last("v", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ended = F.max("v.to").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumns({"own": own, "ended": ended}) if refuse else rows.withColumn("own", own).where("fact is not null")
    placed = placed.join(lasts, placed["on"].eqNullSafe(lasts["on_"]) & placed["part"].eqNullSafe(lasts["part_"]), "left").withColumn("own", F.coalesce("own", "before"))
    found = F.coalesce(F.when(F.col("at") < F.col("own.to"), F.col("own.key")), unknown)
    if refuse:
        bad = F.col("fact").isNull() & F.coalesce((F.greatest("ended", "end_before") > F.col("at")) | (F.col("v.to") <= F.col("at")) | F.col("at").isNull(), F.lit(False))
        placed = placed.withColumn("bad", bad).where(F.col("fact").isNotNull() | F.col("bad"))
        found = F.when(F.col("bad"), F.raise_error(F.lit("HISTORY_OVERLAPS")).cast(placed.schema["own"].dataType["key"].dataType)).otherwise(found)
    return placed.select("fact.*", found.alias(key)).unionByName(keyless)


def history_overlaps(history: DataFrame, on: str) -> DataFrame:
    """Versions that begin before the one before them ends. A window over neighbours, in place of a self-join."""
    w = Window.partitionBy(on).orderBy("effective_from", F.col("effective_to").asc_nulls_last())
    end = F.max(F.coalesce("effective_to", F.expr("timestamp_ntz '9999-12-31 00:00:00'"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return history.withColumn("previous_end", end).where(F.col("effective_from") < F.col("previous_end"))


def allocate_evenly(parents: DataFrame, children: DataFrame, on: str, parent_key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each parent's weight of 1 over its children, in units of 10^-18; the last gets the rest. No child: one row of weight 1.

    A parent_key of several columns with `on` among them needs no other shuffle than the join's.
    """
    rows = parents.join(children, on, "left")
    w = Window.partitionBy(*([parent_key] if isinstance(parent_key, str) else parent_key))
    n = F.count(order[-1]).over(w).cast("bigint")
    at = F.row_number().over(w.orderBy(*[F.col(c).asc_nulls_last() for c in order])).cast("bigint")
    rows = rows.withColumn("item_count", n).withColumn("ordinal", at)
    return rows.withColumn("weight_units", weight_units(F.col("ordinal"), F.col("item_count")))


def told_apart(text: Column) -> Column:
    """A text with its number of bytes in front, or `-` for null: several of them joined are never those of other values."""
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """relation, row_count and a digest of the rows that doesn't depend on their order, and counts repeats.

    The rows' MD5, over the texts of their values in the order of the columns' names, is summed up in two halves of 52 bits.
    """
    h = F.md5(F.concat(*[told_apart(F.col(c).cast("string")) for c in sorted(df.columns)]).cast("binary"))
    half = lambda at: F.coalesce(F.sum(F.conv(F.substring("h", at, 13), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").cast("string")
    n = F.count("*")
    return df.select(h.alias("h")).agg(F.lit(name).alias("relation"), n.alias("row_count"), F.sha2(F.concat_ws(":", n.cast("string"), half(1), half(14)).cast("binary"), 256).alias("content_hash"))


def compare_fingerprints(a: DataFrame, b: DataFrame) -> DataFrame:
    """Relations that differ: missing on a side, ROW_COUNT or CONTENT_HASH."""
    j = a.alias("a").join(b.alias("b"), "relation", "full")
    issue = F.when(F.col("a.row_count").isNull() | F.col("b.row_count").isNull(), "MISSING").when(F.col("a.row_count") != F.col("b.row_count"), "ROW_COUNT").when(F.col("a.content_hash") != F.col("b.content_hash"), "CONTENT_HASH")
    return j.select("relation", issue.alias("issue")).where("issue is not null")


def top_k(vectors: DataFrame, query: Sequence[float], k: int, metric: str = "l2", where: Column | None = None) -> DataFrame:
    """The k nearest vectors (1 to 100) by squared L2 or cosine distance; ties by id. Other dimensions are an error."""
    if not 1 <= k <= 100:
        raise ValueError("k must be 1 to 100")
    if where is not None:
        vectors = vectors.where(where)
    v, q = F.transform("embedding", lambda x: x.cast("double")), F.array(*[F.lit(float(x)) for x in query])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    if metric == "l2":
        d = F.aggregate(F.zip_with(v, q, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    elif metric == "cosine":
        d = F.lit(1.0) - dot(v, q) / F.sqrt(dot(v, v) * dot(q, q))
    else:
        raise ValueError("metric is l2 or cosine")
    checked = F.when(F.size("embedding") == len(query), d).otherwise(F.raise_error(F.lit("vectors differ in dimension")).cast("double"))
    return vectors.withColumn("distance", checked).orderBy("distance", "vec_id").limit(k)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with rows of new in the place of those with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def append_unseen(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new whose key old lacks: what an append-only ledger may take."""
    return new.dropDuplicates([key]).join(old.select(key), key, "left_anti")


def failing(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition isn't true; null counts as a failure."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def not_unique(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def digest(*columns: str) -> Column:
    """16 bytes that stand for the values of these columns, so that long keys needn't be shuffled; null only for a single column's null."""
    text = F.concat(*[told_apart(F.col(c).cast("string")) for c in columns]) if len(columns) > 1 else F.col(columns[0]).cast("string")
    return F.unhex(F.md5(text.cast("binary")))


def orphan_counts(relations: Mapping[str, DataFrame], keys: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """child, column_name, parent and orphans of each relationship (child, its column, parent and its key), in one shuffle: every relation is read once.

    A row gives the digest of its own key, if it is a parent, and of each key that refers to another; digests are counted by parent and place.
    """
    parents = sorted({(p, q) for _, _, p, q in keys})
    places, roles = {}, {}
    for c, k, p, q in keys:
        at = parents.index((p, q))
        places[c, k, p] = at, sum(a == at for a, _ in places.values())
        roles.setdefault(c, []).append((k, *places[c, k, p]))
    for at, (p, q) in enumerate(parents):
        roles.setdefault(p, []).append((q, at, None))
    wide = range(1 + max(n for _, n in places.values()))
    one = lambda column, at, n: F.struct(F.lit(at).alias("at"), digest(column).alias("key"), F.lit(n is None).alias("own"), F.lit(n).cast("int").alias("n"))
    rows = reduce(DataFrame.union, [relations[name].select(F.explode(F.array(*[one(*r) for r in own])).alias("r")).select("r.*") for name, own in roles.items()])
    met = rows.where("key is not null").groupBy("at", "key").agg(F.max("own").alias("own"), *[F.count_if(F.col("n") == n).alias(f"n{n}") for n in wide])
    lost = met.where("not own")
    counts = lost.agg(*[F.coalesce(F.sum(F.when(F.col("at") == at, F.col(f"n{n}"))), F.lit(0)).cast("bigint").alias(f"r{i}") for i, (at, n) in enumerate(places.values())])
    told = [F.struct(F.lit(c).alias("child"), F.lit(k).alias("column_name"), F.lit(p).alias("parent"), F.col(f"r{i}").alias("orphans")) for i, (c, k, p) in enumerate(places)]
    return counts.select(F.explode(F.array(*told)).alias("r")).select("r.*")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")
