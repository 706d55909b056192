"""What every model promises: its grain, which columns may be null, their kinds and its version; checked in the pass that writes it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.operators.relational import digest

VERSION = "model_contract_version"


class ContractBroken(RuntimeError):
    """A model that doesn't keep its contract, with what is wrong."""


@dataclass(frozen=True)
class Model:
    grain: tuple[str, ...]
    nullable: tuple[str, ...] = ()
    #: Conditions that every row has to meet.
    checks: tuple[str, ...] = ()

    @staticmethod
    def version(name: str) -> str:
        return f"{name.replace('_', '-')}-v1"


_LEAD = ("delivery_lead_seconds", "delivery_delay_seconds", "is_on_time_delivery")
_MART = ("on_time_delivery_rate", "average_delivery_lead_seconds", "average_delivery_delay_seconds")
#: The lineage of a row from no source, as of an unknown member, is null.
_UNKNOWN = ("source_release_id", "ingestion_batch_id", "dataset_run_id")
MODELS: dict[str, Model] = {
    "sil_category_translation": Model(("product_category_name",)),
    "sil_customer": Model(("customer_id",), checks=("length(repeat_customer_key) = 64",)),
    "sil_geolocation_zip": Model(("geolocation_zip_prefix",), ("centroid_latitude", "centroid_longitude"), ("source_point_count > 0", "valid_coordinate_count + invalid_coordinate_count = source_point_count")),
    "sil_order": Model(("order_id",), ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", *_LEAD), ("delivery_lead_seconds >= 0",)),
    "sil_order_item": Model(("order_id", "order_item_id")),
    "sil_order_payment": Model(("order_id", "payment_sequential")),
    "sil_order_review": Model(("review_id", "order_id"), ("response_latency_seconds",), ("review_text_length >= 0",)),
    "sil_product": Model(("product_id",), tuple(f"product_{c}" for c in ("name_length", "description_length", "photos_qty", "weight_g", "length_cm", "height_cm", "width_cm"))),
    "sil_seller": Model(("seller_id",)),
    "sil_unknown_member": Model(("entity_type",), checks=("length(unknown_member_key) = 64",)),
    "sil_dq_quarantine": Model(("dq_event_id",)),
    "dim_date": Model(("date_key",)),
    "dim_geography": Model(("geography_key",), ("centroid_latitude", "centroid_longitude", "effective_to", *_UNKNOWN)),
    "dim_customer": Model(("customer_key",), ("effective_to", *_UNKNOWN)),
    "dim_product": Model(("product_key",), ("effective_to", *_UNKNOWN)),
    "dim_seller": Model(("seller_key",), ("effective_to", *_UNKNOWN)),
    "fact_order": Model(("order_key",), ("order_delivered_customer_date", "delivered_date_key", *_LEAD), ("order_count = 1",)),
    "fact_order_item": Model(("order_item_key",), checks=("item_count = 1", "price > 0", "freight_value >= 0")),
    "fact_payment": Model(("payment_key",), checks=("payment_count = 1", "payment_value >= 0")),
    "fact_review_base": Model(("review_key",), ("response_latency_seconds",), ("review_score between 1 and 5",)),
    "bridge_review_item": Model(("attribution_key",), ("order_item_key",), ("allocation_weight > 0", "allocation_weight <= 1")),
    "mart_order_delivery": Model(("period_month", "geography_key"), _MART, ("order_count > 0", "on_time_delivery_rate between 0 and 1")),
    "mart_product_review": Model(("period_month", "product_key"), ("average_review_score",), ("average_review_score between 1 and 5",)),
    "mart_seller_performance": Model(("period_month", "seller_key"), ("average_review_score", *_MART), ("on_time_delivery_rate between 0 and 1",)),
    "mart_customer_overview": Model(("period_month", "geography_key"), ("repeat_customer_rate",), ("repeat_customer_rate between 0 and 1",)),
}
#: Kinds of columns by the letters of the registry.
_KINDS = {"i": T.IntegralType, "d": (T.DecimalType, T.DoubleType), "s": (T.DateType, T.TimestampType, T.TimestampNTZType), "": (T.StringType, T.BooleanType)}


def _kinds_hold(name: str, df: DataFrame, columns: dict[str, str]) -> None:
    wrong = [c for c, kind in columns.items() if c not in df.columns or not isinstance(df.schema[c].dataType, _KINDS[kind])]
    if wrong:
        raise ContractBroken(f"{name}: missing or of another kind: {', '.join(wrong)}")


def enforced(name: str, df: DataFrame, columns: dict[str, str], write: Callable[[DataFrame], DataFrame], drop: Callable[[], None] | None = None) -> DataFrame:
    """write(df with its contract's version), which returns what was written, if it keeps the model's contract; else ContractBroken.

    columns: name and kind of those that it must have. Kinds are checked before the write, nulls and conditions are counted by an observation
    in the pass that writes. A null meets a condition. Then drop() is called for what was written in vain.
    """
    model = MODELS[name]
    _kinds_hold(name, df, columns)
    counts = {f"null {c}": F.count_if(F.col(c).isNull()) for c in columns if c not in model.nullable}
    counts |= {f"not {c}": F.count_if(~F.coalesce(F.expr(c), F.lit(True))) for c in model.checks}
    seen = Observation(name)
    out = write(df.withColumn(VERSION, F.lit(Model.version(name))).observe(seen, *[n.alias(k) for k, n in counts.items()]))
    broken = {k: n for k, n in seen.get.items() if n}
    if broken:
        if drop is not None:
            drop()
        raise ContractBroken(f"{name}: {', '.join(f'{k} ({n} rows)' for k, n in sorted(broken.items()))}")
    return out


def guarded(name: str, df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with its contract's version, for a model that isn't written but made as it is read: a value that breaks the contract fails the read of its column.

    Kinds are checked at once. A check is of the first column that it names.
    """
    model = MODELS[name]
    _kinds_hold(name, df, columns)
    broken = {c: [(f"null {c}", F.col(c).isNull())] if c not in model.nullable else [] for c in columns}
    for check in model.checks:
        broken.setdefault(check.split()[0], []).append((f"not {check}", ~F.coalesce(F.expr(check), F.lit(True))))
    out = {}
    for c, faults in broken.items():
        value = F.col(c)
        for told, wrong in faults:
            value = F.when(wrong, F.raise_error(F.lit(f"ContractBroken: {name}: {told}")).cast(df.schema[c].dataType)).otherwise(value)
        if faults:
            out[c] = value
    return df.withColumns(out | {VERSION: F.lit(Model.version(name))})


def measured(name: str, df: DataFrame, read: bool) -> DataFrame:
    """One row: model, n_rows, repeated (grains of several rows) and the contract's version, if all rows have it. df is read once; grains are dealt by their digests.

    read: all columns are, so that those that guard themselves are checked.
    """
    own = F.xxhash64(*df.columns) if read else F.lit(0).cast("bigint")
    rows = df.select(digest(*MODELS[name].grain).alias("grain"), own.alias("read"), (~F.col(VERSION).eqNullSafe(Model.version(name))).alias("other"))
    grains = rows.groupBy("grain").agg(F.count("*").alias("n"), F.bit_xor("read").alias("read"), F.count_if("other").alias("other"))
    a = grains.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 1).alias("repeated"), F.bit_xor("read").alias("read"), F.sum("other").alias("other"))
    n = F.when((F.col("n") == 0) | F.col("read").isNotNull(), F.col("n"))  # without its use the columns wouldn't be read
    return a.select(F.lit(name).alias("model"), n.alias("n_rows"), "repeated", F.when(F.col("other") == 0, Model.version(name)).alias(VERSION))


def repeated_grains(name: str, written: DataFrame) -> DataFrame:
    """Grains of a written model that have several rows. It reads the grain's columns only."""
    return written.groupBy(*MODELS[name].grain).agg(F.count("*").alias("n")).where("n > 1")
