"""Ids by content: a name space and the SHA-256 of compact JSON with sorted keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prefix of each kind's ids.
PREFIXES = {"source_object": "srcobj", "ingestion_batch": "batch", "dataset_run": "dsrun", "attempt": "attempt", "record": "record"}


def content_id(kind: str, version: str = "ingestion-id-v1", **fields: Column) -> Column:
    """The id of what the fields say. Texts become JSON strings and numbers stay numbers; a null field gives no id."""
    missing = F.lit(False)
    for c in fields.values():
        missing = missing | c.isNull()
    inner = F.to_json(F.struct(*[fields[n].alias(n) for n in sorted(fields)]))
    payload = F.concat(F.lit('{"fields":'), inner, F.lit(f',"kind":"{kind}","version":"{version}"}}'))
    return F.when(~missing, F.concat(F.lit(f"{PREFIXES[kind]}_"), F.sha2(payload.cast("binary"), 256)))


def source_object_id(release: Column, file_name: Column, sha256: Column) -> Column:
    return content_id("source_object", file_name=file_name, source_object_sha256=sha256, source_release_id=release)


def ingestion_batch_id(release: Column) -> Column:
    return content_id("ingestion_batch", source_release_id=release)


def dataset_run_id(batch: Column, source_object: Column, dataset: Column, contract_version: Column) -> Column:
    return content_id("dataset_run", contract_version=contract_version, dataset_name=dataset, ingestion_batch_id=batch, source_object_id=source_object)


def attempt_id(run: Column, number: Column) -> Column:
    """The id of a retry; numbers from 1."""
    return content_id("attempt", attempt_number=F.when(number >= 1, number), dataset_run_id=run)


def record_id(source_object: Column, row: Column, byte_start: Column, byte_end: Column) -> Column:
    """The id of a record by its place in a file; rows from 2, and ranges that aren't empty."""
    return content_id("record", byte_end=F.when(byte_end > byte_start, byte_end), byte_start=byte_start, source_object_id=source_object, source_row_number=F.when(row >= 2, row))
