"""A table of vectors with metadata: upserts of one dimension and version, and searches of one release."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.operators.relational import top_k, upsert

#: What a search is held to: each vector names the table it was made from, its index's version and its data's release.
AUTHORITY = ("source_table", "index_version", "data_release_id")


def checked_batch(batch: DataFrame, index_version: str) -> DataFrame:
    """batch (vec_id, embedding, AUTHORITY), which fails as it is read if it is empty, has another index_version, several dimensions, or a vec_id twice."""
    facts = batch.groupBy("vec_id").agg(F.count("*").alias("n"), F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high"), F.count_if(~F.col("index_version").eqNullSafe(F.lit(index_version))).alias("foreign"))
    facts = facts.agg(F.count("*").alias("n"), F.max("n").alias("most"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("foreign").alias("foreign"))
    wrong = (
        F.when(F.col("foreign") > 0, "INDEX_VERSION_MISMATCH").when((F.col("low") != F.col("high")) | (F.col("low") < 1), "DIMENSIONS_DIFFER").when(F.col("most") > 1, "VECTOR_ID_REPEATED")
    )
    fine = facts.select(F.when(wrong.isNotNull(), F.raise_error(wrong).cast("boolean")).otherwise(F.lit(True)).alias("fine_"))
    # a join with an empty batch would evaluate nothing, so that case has a row of its own
    none = F.when(F.col("n") == 0, F.raise_error(F.lit("VECTORS_EMPTY")).cast("boolean")).otherwise(F.lit(False))
    empty = facts.where(none).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema])
    return batch.crossJoin(F.broadcast(fine)).where("fine_").drop("fine_").unionByName(empty)  # with one row


def upserted(stored: DataFrame, batch: DataFrame, index_version: str) -> DataFrame:
    """stored with the batch's vectors in the place of those of the same id."""
    return upsert(stored, checked_batch(batch, index_version), "vec_id")


def search(vectors: DataFrame, query: Sequence[float], k: int, authority: dict[str, str], metric: str = "l2", where: Column | None = None) -> DataFrame:
    """The k nearest vectors of one table, index version and release. Each found row is held against these once more, and fails with AUTHORITY_INVALID if it differs."""
    if set(authority) != set(AUTHORITY):
        raise ValueError(f"authority names {', '.join(AUTHORITY)}")
    own = where if where is not None else F.lit(True)
    for c, value in authority.items():
        own = own & (F.col(c) == value)
    found = top_k(vectors, query, k, metric, own)
    same = F.lit(True)
    for c, value in authority.items():
        same = same & F.col(c).eqNullSafe(F.lit(value))
    return found.withColumn("distance", F.when(same, F.col("distance")).otherwise(F.raise_error(F.lit("AUTHORITY_INVALID")).cast("double")))
