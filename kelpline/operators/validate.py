"""Validation of source rows against dataset contracts, dispositions and reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """A source column: its kind (string, integer, decimal, timestamp) and what values may be."""

    name: str
    kind: str
    nullable: bool = False
    low: int | None = None
    high: int | None = None
    positive: bool = False
    allowed: tuple[str, ...] = ()
    pattern: str = ""


@dataclass(frozen=True)
class Dataset:
    name: str
    identity: tuple[str, ...]
    fields: tuple[Field, ...]
    unique: bool = True

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, KINDS[f.kind], True) for f in self.fields])


KINDS = {"string": T.StringType(), "integer": T.LongType(), "decimal": T.DecimalType(38, 18), "timestamp": T.TimestampNTZType()}
ZIP, STATE = "^[0-9]{5}$", "^[A-Z]{2}$"
# The nine files and their columns, in order.
STATUSES = ("approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped", "unavailable")
PAYMENTS = ("boleto", "credit_card", "debit_card", "not_defined", "voucher")
s, i, d, t = "string", "integer", "decimal", "timestamp"
CONTRACTS = {
    x.name: x
    for x in (
        Dataset("customers", ("customer_id",), (Field("customer_id", s), Field("customer_unique_id", s), Field("customer_zip_code_prefix", s, pattern=ZIP), Field("customer_city", s), Field("customer_state", s, pattern=STATE))),
        Dataset("geolocation", ("geolocation_zip_code_prefix",), (Field("geolocation_zip_code_prefix", s, pattern=ZIP), Field("geolocation_lat", d, low=-90, high=90), Field("geolocation_lng", d, low=-180, high=180), Field("geolocation_city", s), Field("geolocation_state", s, pattern=STATE)), unique=False),
        Dataset("order_items", ("order_id", "order_item_id"), (Field("order_id", s), Field("order_item_id", i, positive=True), Field("product_id", s), Field("seller_id", s), Field("shipping_limit_date", t), Field("price", d, low=0), Field("freight_value", d, low=0))),
        Dataset("order_payments", ("order_id", "payment_sequential"), (Field("order_id", s), Field("payment_sequential", i, positive=True), Field("payment_type", s, allowed=PAYMENTS), Field("payment_installments", i, low=0), Field("payment_value", d, low=0))),
        Dataset("order_reviews", ("review_id", "order_id"), (Field("review_id", s), Field("order_id", s), Field("review_score", i, low=1, high=5), Field("review_comment_title", s, True), Field("review_comment_message", s, True), Field("review_creation_date", t), Field("review_answer_timestamp", t))),
        Dataset("orders", ("order_id",), (Field("order_id", s), Field("customer_id", s), Field("order_status", s, allowed=STATUSES), Field("order_purchase_timestamp", t), Field("order_approved_at", t, True), Field("order_delivered_carrier_date", t, True), Field("order_delivered_customer_date", t, True), Field("order_estimated_delivery_date", t))),
        Dataset("products", ("product_id",), (Field("product_id", s), Field("product_category_name", s, True), *[Field(f"product_{n}", i, True, low=0) for n in ("name_lenght", "description_lenght", "photos_qty")], *[Field(f"product_{n}", d, True, low=0) for n in ("weight_g", "length_cm", "height_cm", "width_cm")])),
        Dataset("sellers", ("seller_id",), (Field("seller_id", s), Field("seller_zip_code_prefix", s, pattern=ZIP), Field("seller_city", s), Field("seller_state", s, pattern=STATE))),
        Dataset("category_translation", ("product_category_name",), (Field("product_category_name", s), Field("product_category_name_english", s))),
    )
}
del s, i, d, t
_INTEGER, _DECIMAL, _TIME = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
#: A time whose fields may lack their zero, or a day that has a space in its place, with any white space between day and hour.
_LOOSE_TIME = r"^([0-9]{4})-(1[0-2]|0?[1-9])-(3[01]|[12][0-9]|0?[1-9]| [1-9])\s+(2[0-3]|[01]?[0-9]):([0-5]?[0-9]):([0-5]?[0-9])$"


def typed(f: Field, c: Column) -> Column:
    """The value of the field's kind, or null if it can't be read so."""
    if f.kind == "integer":
        return F.when(c.rlike(_INTEGER), c.try_cast("bigint"))
    if f.kind == "decimal":
        # white space around a number and underscores in it don't count; read with four places more, then rounded to the even neighbour
        c = F.replace(F.regexp_replace(c, r"^\s+|\s+$", ""), F.lit("_"), F.lit(""))
        return F.when(c.rlike(_DECIMAL), F.bround(c.try_cast("decimal(38,22)"), 18).cast("decimal(38,18)"))
    if f.kind == "timestamp":
        part = lambda i: F.lpad(F.trim(F.regexp_extract(c, _LOOSE_TIME, i)), 2, "0")
        loose = F.concat(F.regexp_extract(c, _LOOSE_TIME, 1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit(" "), part(4), F.lit(":"), part(5), F.lit(":"), part(6))
        return F.when(c.startswith("0000"), None).when(c.rlike(_TIME), c.try_cast("timestamp_ntz")).when(c.rlike(_LOOSE_TIME), loose.try_cast("timestamp_ntz"))
    return c


def error_code(f: Field, c: Column) -> Column:
    """The field's error, or null. Empty text is a missing value."""
    value = typed(f, c)
    code = F.when(F.coalesce(c, F.lit("")) == "", None if f.nullable else F.lit("FIELD_REQUIRED"))
    if f.kind != "string":
        code = code.when(value.isNull(), f"{f.kind.upper()}_INVALID")
    bad = None
    if f.low is not None or f.high is not None or f.positive:
        bad = (value < f.low) if f.low is not None else F.lit(False)
        bad = bad | (value > f.high) if f.high is not None else bad
        bad = bad | (value <= 0) if f.positive else bad
        code = code.when(bad, "RANGE_INVALID")
    if f.allowed:
        code = code.when(~c.isin(*f.allowed), "VALUE_NOT_ALLOWED")
    if f.pattern:
        code = code.when(~c.rlike(f.pattern), "FORMAT_INVALID")
    return code


def validate(raw: DataFrame, dataset: Dataset) -> DataFrame:
    """raw (text columns) with typed values, and `errors`: struct(code, column_name) of every failed field, in column order."""
    errors = F.array_compact(F.array(*[F.when((e := error_code(f, F.col(f.name))).isNotNull(), F.struct(e.alias("code"), F.lit(f.name).alias("column_name"))) for f in dataset.fields]))
    own = {f.name: F.when(F.col(f.name) != "", typed(f, F.col(f.name))) for f in dataset.fields}
    rest = [F.col(c) for c in raw.columns if c not in own]
    return raw.select(*rest, errors.alias("errors"), *[v.alias(n) for n, v in own.items()])


def error_histogram(validated: DataFrame) -> DataFrame:
    return validated.select(F.explode("errors").alias("e")).groupBy(F.col("e.code").alias("code"), F.col("e.column_name").alias("column_name")).agg(F.count("*").alias("n"))


def record_hash(columns: list[str]) -> Column:
    """SHA-256 over all values in order, nulls told apart from empty texts. For typed values with exact text forms."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"}).cast("binary"), 256)


def dispositions(rows: DataFrame, history: DataFrame, hash_column: str, order: list[str]) -> DataFrame:
    """REJECTED, DUPLICATE (seen earlier in this file), REPLAY (in the history) or NEW for each row."""
    rank = F.row_number().over(Window.partitionBy(hash_column, F.size("errors") > 0).orderBy(*order))
    seen = history.select(F.col(hash_column), F.lit(True).alias("in_history")).distinct()
    j = rows.withColumn("nth", rank).join(seen, hash_column, "left")
    state = F.when(F.size("errors") > 0, "REJECTED").when(F.col("nth") > 1, "DUPLICATE").when(F.col("in_history"), "REPLAY").otherwise("NEW")
    return j.withColumn("disposition", state).drop("nth", "in_history")


def quarantined(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rejected and repeated rows with all codes, their payload and a partition: the first code in column order."""
    codes = F.when(F.col("disposition") == "DUPLICATE", F.array(F.lit("DUPLICATE_RECORD"))).otherwise(F.transform("errors", lambda e: e["code"]))
    bad = rows.where("disposition in ('REJECTED', 'DUPLICATE')").withColumn("error_codes", codes)
    return bad.select("*", F.element_at("error_codes", 1).alias("error_code"), F.to_json(F.struct(*columns)).alias("raw_payload"))


COUNTS = ("source_observed_rows", "source_new_rows", "source_replay_rows", "source_duplicate_rows", "source_rejected_rows", "source_parse_failed_rows", "raw_rows", "raw_bytes", "stored_bytes", "loaded_rows", "bronze_rows", "bronze_distinct_hashes")
HASHES = ("source_sha256", "archived_sha256", "raw_sha256", "stored_sha256")


def reconcile(inputs: DataFrame) -> DataFrame:
    """inputs (dataset_name, COUNTS, HASHES, loaded_before) with `issues`, one row for each dataset of the contracts that is there,
    and a row without a name if they aren't all there once. Negative counts and malformed hashes are an error."""
    c = F.col
    bad = F.lit(False)
    for n in COUNTS:
        bad = bad | F.coalesce(c(n) < 0, F.lit(True))
    for n in HASHES:
        bad = bad | ~F.coalesce(c(n).rlike("^[0-9a-f]{64}$"), F.lit(False))
    explained = sum((c(f"source_{n}_rows") for n in ("new", "replay", "duplicate", "rejected", "parse_failed")), F.lit(0))
    issues = F.array_compact(F.array(*[F.when(differ, code) for differ, code in (
        (c("source_observed_rows") != explained, "RECON_SOURCE_DISPOSITION_MISMATCH"), (c("source_sha256") != c("archived_sha256"), "RECON_SOURCE_ARCHIVE_HASH_MISMATCH"), (c("raw_rows") != c("source_new_rows"), "RECON_RAW_ROW_MISMATCH"),
        (c("raw_bytes") != c("stored_bytes"), "RECON_RAW_R2_BYTES_MISMATCH"), (c("raw_sha256") != c("stored_sha256"), "RECON_RAW_R2_HASH_MISMATCH"), (c("loaded_rows") != F.when(c("loaded_before"), 0).otherwise(c("raw_rows")), "RECON_COPY_ROW_MISMATCH"),
        (c("bronze_rows") != c("raw_rows"), "RECON_BRONZE_ROW_MISMATCH"), (c("bronze_distinct_hashes") != c("bronze_rows"), "RECON_BRONZE_DUPLICATE_EFFECT"),
    )]))
    own = inputs.where(c("dataset_name").isin(*CONTRACTS)).select("dataset_name", F.when(bad, F.raise_error(F.lit("RECONCILIATION_INPUT_INVALID")).cast("array<string>")).otherwise(issues).alias("issues"))
    whole = inputs.agg((F.count("*") == len(CONTRACTS)) & (F.count_distinct(F.when(c("dataset_name").isin(*CONTRACTS), c("dataset_name"))) == len(CONTRACTS))).toDF("whole")
    return own.unionByName(whole.where("not whole").select(F.lit(None).cast("string").alias("dataset_name"), F.array(F.lit("RECON_DATASET_SET_MISMATCH")).alias("issues")))


def file_verdict(validated: DataFrame, dataset: Dataset, declared_rows: int) -> DataFrame:
    """One row for a file: observed, accepted, rejected and repeated rows, and ROW_COUNT_MISMATCH or DUPLICATE_IDENTITY.

    Identities are counted among accepted rows, and only where the contract has them unique.
    """
    if declared_rows < 0:
        raise ValueError("declared_rows must not be negative")
    ok = F.size("errors") == 0
    # one row for each identity first, so that no file is one task
    by = validated.groupBy(ok.alias("ok"), *dataset.identity).agg(F.count("*").alias("n"))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    repeated = n(F.when(F.col("ok"), F.col("n") - 1)) if dataset.unique else F.lit(0).cast("bigint")
    out = by.agg(n("n").alias("observed_rows"), n(F.when(F.col("ok"), F.col("n"))).alias("accepted_rows"), n(F.when(~F.col("ok"), F.col("n"))).alias("rejected_rows"), repeated.alias("duplicate_rows"))
    errors = F.array_compact(F.array(F.when(F.col("observed_rows") != declared_rows, "ROW_COUNT_MISMATCH"), F.when(F.col("duplicate_rows") > 0, "DUPLICATE_IDENTITY")))
    return out.select(F.lit(dataset.name).alias("dataset_name"), "*", errors.alias("file_errors"))


def alerts(runs: DataFrame, most_quarantined: float = 0.05) -> DataFrame:
    """runs (run_state, accepted_rows, bronze_rows, quarantined_rows, source_rows, task_errors, suspended) with the codes of their alerts."""
    if not 0 <= most_quarantined <= 1:
        raise ValueError("the rate lies between 0 and 1")
    c = F.col
    codes = F.array_compact(F.array(
        F.when((c("run_state") != "RECONCILED") | (c("accepted_rows") != c("bronze_rows")), "RECONCILIATION_FAILED"),
        F.when(c("quarantined_rows") > F.lit(most_quarantined) * c("source_rows"), "QUARANTINE_RATE_HIGH"),
        F.when(c("task_errors") > 0, "TASK_ERRORS_PRESENT"), F.when(~c("suspended"), "WAREHOUSE_CLEANUP_REQUIRED"),
    ))
    return runs.withColumn("alerts", codes)


@F.pandas_udf(T.StringType())
def _composed(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFC")


def canonical_text(f: Field, c: Column) -> Column:
    """A typed value as JSON: texts composed (NFC), decimals without trailing zeros, times to the second, null as null."""
    if f.kind == "integer":
        value = c.cast("string")
    elif f.kind == "decimal":
        plain = c.cast("string")
        plain = F.when(plain.contains("."), F.rtrim(F.rtrim(plain, F.lit("0")), F.lit("."))).otherwise(plain)
        value = F.concat(F.lit('"'), F.when(plain.isin("-0", ""), "0").otherwise(plain), F.lit('"'))
    elif f.kind == "timestamp":
        value = F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit('"'))
    else:
        # only texts beyond ASCII may need to be composed; a UDF gets all rows, so it gets a null in place of the others
        plain = c.rlike(r"^[\x00-\x7f]*$")
        nfc = F.when(plain, c).otherwise(_composed(F.when(~plain, c)))
        json = F.to_json(F.array(nfc))
        value = F.when(c.isNotNull(), F.substring(json, F.lit(2), F.length(json) - 2))
    return F.coalesce(value, F.lit("null"))


def canonical_hash(dataset: Dataset, version: str = "record-hash-v1") -> Column:
    """SHA-256 of a record's typed values in the contract's order, as compact JSON with sorted keys."""
    values = [F.concat(F.lit(f'["{f.name}",'), canonical_text(f, F.col(f.name)), F.lit("]")) for f in dataset.fields]
    text = F.concat(F.lit(f'{{"contract":"{version}","dataset_name":"{dataset.name}","values":['), F.concat_ws(",", *values), F.lit("]}"))
    return F.sha2(text.cast("binary"), 256)


DQ_VERSION = "dq-gate-v1"


def quality_gate(findings: DataFrame, rule: list[str]) -> DataFrame:
    """One row for findings (severity, the rule's columns, n): status PASS, PASS_WITH_FINDINGS or BLOCKED, the failures of each severity, and a
    fingerprint of the status and of all rules with their counts, in no order of rows.

    findings has a row a rule, some dozens; a repeated rule fails with DQ_FINDING_REPEATED, and a severity of another name with DQ_FINDING_INVALID.
    """
    c = F.col
    failures = lambda s: F.coalesce(F.sum(F.when(c("severity") == s, c("n"))), F.lit(0)).cast("bigint")
    names = F.array_sort(F.collect_list(F.to_json(F.array(c("severity"), *[c(x).cast("string") for x in rule], c("n").cast("string")))))
    keys = F.collect_set(F.struct("severity", *rule))
    bad = F.count_if(~F.coalesce(c("severity").isin("CRITICAL", "QUARANTINE", "WARN") & (c("n") > 0), F.lit(False)))
    one = findings.agg(F.count("*").alias("rules"), F.size(keys).alias("different"), bad.alias("bad"), names.alias("names"), *[failures(s).alias(f"{s.lower()}_failures") for s in ("CRITICAL", "WARN", "QUARANTINE")])
    status = F.when(c("critical_failures") > 0, "BLOCKED").when(c("rules") > 0, "PASS_WITH_FINDINGS").otherwise("PASS")
    checked = F.when(c("bad") > 0, F.raise_error(F.lit("DQ_FINDING_INVALID")).cast("string")).when(c("rules") != c("different"), F.raise_error(F.lit("DQ_FINDING_REPEATED")).cast("string")).otherwise(status)
    text = F.concat(F.lit(f'{{"contract_version":"{DQ_VERSION}","findings":['), F.array_join("names", ","), F.lit('],"status":"'), c("status"), F.lit('"}'))
    out = one.withColumn("status", checked)
    return out.select("status", "critical_failures", "warn_failures", "quarantine_failures", F.sha2(text.cast("binary"), 256).alias("fingerprint"))
