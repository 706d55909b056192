"""The driver's tables as the nine source relations of the commerce model.

Each relation has its columns and lineage: record_hash (SHA-256 of all its values), source_row_number and
ingested_at, which a revision rank orders by. Money is decimal(18,2) before any sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.operators.relational import dealt, parts_of, told_apart

RELEASE = "release-1"
LOADED = "2024-01-01 00:00:00"
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _text(c: str, kind: str) -> Column:
    c_ = F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind.startswith("timestamp") else F.col(c).cast("string")
    return told_apart(c_)


#: Columns that say where a row is from, and are no values of it.
LOAD = ("record_hash", "source_row_number", "ingested_at", "source_release_id", "ingestion_batch_id", "dataset_run_id")


def record_digest(df: DataFrame, columns: Sequence[str] = ()) -> Column:
    """SHA-256 of a row's values: of these columns, or all but those of its load."""
    return F.sha2(F.concat(*[_text(c, k) for c, k in df.dtypes if (c in columns if columns else c not in LOAD)]).cast("binary"), 256)


def rehashed(df: DataFrame, by: str | None = None, columns: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """df with record_hash made anew, of 64 letters a row that so needn't be stored. by: rows are dealt by this column before, and the hash isn't shuffled.

    parts: in so many partitions, if rows of another frame are dealt alike; else as many as df's rows need.
    """
    rows = df.drop("record_hash")
    rows = dealt(rows, by, parts_of(rows) if parts is None else parts) if by else rows
    return rows.withColumn("record_hash", record_digest(rows, columns))


def with_lineage(df: DataFrame, row: Column, day: Column) -> DataFrame:
    """Adds record_hash over all columns, source_row_number and ingested_at."""
    digest = record_digest(df)
    loaded = F.expr(f"timestamp_ntz '{LOADED}'") + F.make_dt_interval(days=day.cast("int"))
    return df.select("*", digest.alias("record_hash"), row.cast("bigint").alias("source_row_number"), loaded.alias("ingested_at"))


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine relations by name."""
    t = lambda name: table(spark, sf_dir, name)
    nation = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    place = lambda key, p: nation.select(F.col("n_nationkey").alias(key), F.concat(F.lit(" "), F.lower("n_name")).alias(f"{p}_city"), F.col("r_name").alias(f"{p}_state"))

    customers = t("customer").join(place("c_nationkey", "customer"), "c_nationkey").select(
        F.col("c_custkey").cast("string").alias("customer_id"), (F.col("c_custkey") % 1000).cast("string").alias("customer_unique_id"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"), "customer_city", "customer_state", F.col("c_custkey").alias("k"),
    )
    points = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i")
    geo = nation.select("*", points).select(
        F.col("n_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
        (F.col("n_nationkey") * 4 - 45 + F.when((F.col("i") == 3) & (F.col("n_nationkey") % 5 == 0), 1000).otherwise(F.col("i"))).cast("decimal(18,2)").alias("geolocation_lat"),
        (F.col("n_nationkey") * 7 - 80 + F.col("i") * 2 + F.when(F.col("n_nationkey") == 7, 5000).otherwise(0)).cast("decimal(18,2)").alias("geolocation_lng"),
        F.when((F.col("i") == 2) & (F.col("n_nationkey") % 3 == 0), F.concat("n_name", F.lit(" old"))).otherwise(F.col("n_name")).alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    )
    # dealt before they are grouped: a hash table of all orders in a task's rows spills
    ships = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    shipped = dealt(ships, "o_orderkey", parts_of(ships)).groupBy("o_orderkey").agg(F.max("l_shipdate").alias("shipped"))
    o = F.col("o_orderkey")
    orders = t("orders").join(shipped, "o_orderkey", "left").select(
        o.cast("string").alias("order_id"),
        F.when(o % 97 == 0, F.concat(F.lit("gone-"), F.col("o_custkey").cast("string"))).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(o % 101 == 0, "lost").when(F.col("o_orderstatus") == "F", " Delivered").when(F.col("o_orderstatus") == "O", "shipped").otherwise("canceled").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        (F.col("o_orderdate") + F.expr("interval 1 hour")).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("interval 2500 days")).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F", F.col("shipped")).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("interval 60 days")).alias("order_estimated_delivery_date"), o.alias("k"),
    )
    items = t("lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").cast("bigint").alias("order_item_id"), F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"), F.col("l_shipdate").alias("shipping_limit_date"),
        F.when(F.col("l_partkey") % 211 == 0, F.lit(0).cast("decimal(18,2)")).otherwise(money("l_extendedprice")).alias("price"), money("l_tax").alias("freight_value"),
    )
    payments = t("orders").select(
        F.when(o % 89 == 0, F.concat(F.lit("gone-"), o.cast("string"))).otherwise(o.cast("string")).alias("order_id"), F.lit(1).cast("bigint").alias("payment_sequential"),
        F.element_at(F.array(*map(F.lit, ("credit_card", " Boleto", "VOUCHER ", "debit_card"))), (o % 4 + 1).cast("int")).alias("payment_type"),
        F.when(o % 107 == 0, -1).otherwise(o % 10 + 1).cast("bigint").alias("payment_installments"), F.when(o % 103 == 0, -money("o_totalprice")).otherwise(money("o_totalprice")).cast("decimal(18,2)").alias("payment_value"),
    )
    texts = t("documents").select(F.col("doc_id").alias("o_orderkey"), "text")
    reviews = t("orders").join(texts, "o_orderkey", "left").select(
        F.concat(F.lit("r"), o.cast("string")).alias("review_id"), F.when(o % 83 == 0, F.concat(F.lit("gone-"), o.cast("string"))).otherwise(o.cast("string")).alias("order_id"),
        (o % 5 + 1).cast("bigint").alias("review_score"), F.when(o % 7 == 0, F.lit(" good ")).alias("review_comment_title"), F.col("text").alias("review_comment_message"),
        (F.col("o_orderdate") + F.expr("interval 61 days")).alias("review_creation_date"),
        (F.col("o_orderdate") + F.expr("interval 60 days") + F.make_dt_interval(days=(o % 9).cast("int"))).alias("review_answer_timestamp"),
    )
    products = t("part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.when(F.col("p_size") % 10 == 0, F.lit(None)).otherwise(F.upper("p_type")).alias("product_category_name"),
        F.length("p_name").cast("bigint").alias("product_name_lenght"), F.length("p_type").cast("bigint").alias("product_description_lenght"), F.col("p_size").cast("bigint").alias("product_photos_qty"), money("p_retailprice").alias("product_weight_g"),
        *[(F.col("p_size") * k).cast("decimal(18,2)").alias(f"product_{n}_cm") for k, n in ((2, "length"), (3, "height"), (4, "width"))],
    )
    translation = t("part").select(F.upper("p_type").alias("product_category_name"), F.concat(F.lit("en "), F.lower("p_type")).alias("product_category_name_english")).distinct().where(~F.col("product_category_name").contains("A"))
    sellers = t("supplier").join(place("s_nationkey", "seller"), "s_nationkey").select(
        F.col("s_suppkey").cast("string").alias("seller_id"), (F.col("s_nationkey") + F.when(F.col("s_suppkey") % 20 == 0, 90000).otherwise(0)).cast("string").alias("seller_zip_code_prefix"), "seller_city", "seller_state", F.col("s_suppkey").alias("k"),
    )
    zero = F.lit(0)
    return {
        "customers": with_lineage(customers.drop("k"), zero, zero),
        "geolocation": with_lineage(geo, zero, zero),
        "orders": with_lineage(orders.drop("k"), zero, zero),
        "order_items": with_lineage(items, F.length("product_id"), F.length("seller_id")),
        "order_payments": with_lineage(payments, zero, zero),
        "order_reviews": with_lineage(reviews, zero, zero),
        "products": with_lineage(products, zero, zero),
        "category_translation": with_lineage(translation, zero, zero),
        "sellers": with_lineage(sellers.drop("k"), zero, zero),
    }
