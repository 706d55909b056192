"""Source files processed against their contract: each record's disposition, raw rows, quarantine, and a report that adds up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.functions.identities import record_id
from kelpline.operators.validate import Dataset, canonical_hash, validate

PLACE = ("source_file", "source_row_number", "byte_start", "byte_end")
#: What becomes of a record; a structural fault ends its file.
OUTCOMES = ("NEW", "REPLAY", "DUPLICATE", "REJECTED", "PARSE_FAILED")


def processed(records: DataFrame, dataset: Dataset, history: DataFrame) -> DataFrame:
    """records (the contract's columns as text, PLACE, error_code; each file up to its first fault) with typed values, errors,
    record_hash and disposition, and `payload`, the texts as JSON with sorted keys.

    history: record_hash of what was accepted before. The first record of a hash in a file is NEW or a REPLAY of history, others are DUPLICATEs.
    A fault is PARSE_FAILED, and FILE_FAILED if it lies before the first data row.
    """
    names = [f.name for f in dataset.fields]
    payload = F.to_json(F.struct(*[F.col(n) for n in sorted(names)]), {"ignoreNullFields": "false"})
    rows = validate(records.withColumn("payload", F.when(F.col("error_code").isNull(), payload)), dataset)
    fault, bad = F.col("error_code").isNotNull(), F.size("errors") > 0
    rows = rows.withColumn("record_hash", F.when(~fault & ~bad, canonical_hash(dataset)))
    # the first of each hash by one aggregate, combined before its shuffle, and not by a window over all records of a hash
    firsts = rows.where("record_hash is not null").groupBy(F.col("source_file").alias("file_"), F.col("record_hash").alias("hash_")).agg(F.min("source_row_number").alias("first_row"))
    seen = history.select(F.col("record_hash").alias("hash_")).distinct().withColumn("seen", F.lit(True))
    firsts = firsts.join(seen, "hash_", "left")
    j = rows.join(firsts, (rows["source_file"] == firsts["file_"]) & (rows["record_hash"] == firsts["hash_"]), "left").drop("file_", "hash_")
    state = (
        F.when(fault, F.when(F.coalesce("source_row_number", F.lit(0)) >= 2, "PARSE_FAILED").otherwise("FILE_FAILED")).when(bad, "REJECTED")
        .when(F.col("source_row_number") > F.col("first_row"), "DUPLICATE").when(F.col("seen"), "REPLAY").otherwise("NEW")
    )
    return j.withColumn("disposition", state).drop("first_row", "seen")


def raw_rows(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """The new records with their typed values, place and hash."""
    return rows.where("disposition = 'NEW'").select(*[f.name for f in dataset.fields], *PLACE, "record_hash")


def quarantine_rows(rows: DataFrame, dataset: Dataset, source_object: Column) -> DataFrame:
    """What was not accepted: place, record_id, raw_reference, all codes with their columns, and the payload.

    error_code is the first code in the order of columns; a duplicate names the columns of the identity. A record of no bytes and a fault have no
    record_id.
    """
    bad = rows.where("disposition in ('REJECTED', 'DUPLICATE', 'PARSE_FAILED', 'FILE_FAILED')")
    place = [F.col(c) for c in PLACE[1:]]
    is_fault, twice = F.col("error_code").isNotNull(), F.col("disposition") == "DUPLICATE"
    none = F.array().cast("array<string>")
    codes = F.when(is_fault, F.array("error_code")).when(twice, F.array(F.lit("DUPLICATE_RECORD"))).otherwise(F.transform("errors", lambda e: e["code"]))
    columns = F.when(is_fault, none).when(twice, F.array(*map(F.lit, dataset.identity))).otherwise(F.transform("errors", lambda e: e["column_name"]))
    text = lambda c: F.col(c).cast("string")
    where = F.when(is_fault, F.concat(F.lit("#row="), F.coalesce(text("source_row_number"), F.lit("0")))).otherwise(F.concat(F.lit("#bytes="), text("byte_start"), F.lit(":"), text("byte_end")))
    out = bad.select(*PLACE, F.when(~is_fault, record_id(source_object, *place)).alias("record_id"), F.concat(source_object, where).alias("raw_reference"), codes.alias("error_codes"), columns.alias("error_columns"), F.col("payload").alias("raw_payload"), "disposition")
    return out.withColumn("error_code", F.element_at("error_codes", 1))


def reports(rows: DataFrame) -> DataFrame:
    """A row for each file: observed and what became of it, file_failures, status; fails if the outcomes don't add up to the observed rows."""
    is_ = lambda *of: F.count_if(F.col("disposition").isin(*of))
    data_row = F.coalesce("source_row_number", F.lit(0)) >= 2
    counts = rows.groupBy("source_file").agg(
        F.count_if(data_row).alias("observed_rows"), *[is_(o).alias(f"{o.lower()}_rows") for o in OUTCOMES], is_("PARSE_FAILED", "FILE_FAILED").alias("file_failures"),
    )
    explained = sum((F.col(f"{o.lower()}_rows") for o in OUTCOMES), F.lit(0))
    held_back = F.col("rejected_rows") + F.col("duplicate_rows") + F.col("file_failures")
    observed = F.when(F.col("observed_rows") == explained, F.col("observed_rows")).otherwise(F.raise_error(F.lit("INGESTION_RECONCILIATION_FAILED")).cast("bigint"))
    return counts.withColumn("observed_rows", observed).withColumn("status", F.when(held_back > 0, "QUARANTINED").otherwise("VALIDATED"))
