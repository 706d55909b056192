"""What the models write and shuffle, and the sums that they take without their long keys."""

import decimal
import re

import pytest
from pyspark.sql import functions as F

from kelpline import registry, registry_checks
from kelpline.functions.columns import shown_average
from kelpline.plans import contracts, gold, silver
from kelpline.sinks.release import kept_in
from kelpline.sources.commerce import bronze

SF = "/root/testdata/sf0.001"


def test_marts_are_reconciled_as_published(spark):
    """60,000 thirds with 6 places lack 0.02 of what the bridge has."""
    third = F.lit(decimal.Decimal("0.333333333333333333"))
    rows = spark.range(60_000)
    amounts = {c: F.lit(1).cast("decimal(18,2)").alias(c) for c in ("price", "freight_value", "item_total_value", "payment_value", "gross_merchandise_value")}
    columns = [F.lit("o").alias("order_id"), *amounts.values(), *[F.lit(1).alias(c) for c in ("order_count", "item_count", "review_score")], *[F.lit(True).alias(c) for c in ("order_parent_exists", "response_interval_valid")], F.lit("VALID").alias("amount_quality_status"), F.lit("IN_SCOPE").alias("analysis_scope_status")]
    m = {side[0]: rows.select(*columns, *[third.alias(c) for c in ("allocation_weight", "allocated_review_count", "allocated_review_score")]) for _, a, b in registry_checks.CHECKS for side in (a, b)}
    holds = {r.check_name: r.holds for r in registry_checks.reconciled(m, spark.range(1).select(F.lit("o").alias("order_id"))).collect()}
    assert {n for n, ok in holds.items() if not ok} == {"PRODUCT_REVIEW_COUNT", "PRODUCT_REVIEW_SCORE", "SELLER_REVIEW_COUNT", "SELLER_REVIEW_SCORE"}


def test_averages_end_in_the_digit_that_sql_shows(spark):
    """of quotients as large as seconds of years, some of each hundred."""
    import duckdb

    rows = [(86_400 * (190_000 + 7 * i) * (1 if i % 3 else -1), 100 + i) for i in range(500)] + [(16010352000, 143), (5, 0), (None, 3), (1, 2_000_000)]
    shown = spark.createDataFrame(rows, "t long, n long").select("t", "n", shown_average(F.col("t"), F.col("n")).cast("double").alias("a"))
    sql = lambda t, n: duckdb.execute("SELECT round(?::BIGINT::DOUBLE / nullif(?::BIGINT, 0), 6)", [t, n]).fetchone()[0]
    assert [r.a for r in shown.collect()] == [sql(t, n) for t, n in rows]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Models of orders with several products and sellers that no dimension has, reviewed orders without items, and orders without reviews."""
    b = bronze(spark, SF)
    number = lambda c: F.col(c).try_cast("bigint")
    few = {"products": number("product_id") % 3 != 0, "sellers": number("seller_id") % 2 == 0, "order_items": number("order_id") % 5 != 0, "order_reviews": F.coalesce(number("order_id") % 7 != 0, F.lit(True)), "customers": number("customer_id") % 4 != 0}
    runs = lambda df: df.withColumns({c: F.lit("r") for c in silver.RUN})
    keep = kept_in(spark, f"file://{tmp_path_factory.mktemp('odd')}")
    return registry.release_models(spark, {n: runs(keep(n, df.where(few[n]) if n in few else df)) for n, df in b.items()}, f"file://{tmp_path_factory.mktemp('models')}", "r")


@pytest.mark.parametrize("mart,key", [("mart_product_review", "product_key"), ("mart_seller_performance", "seller_key")])
def test_marts_are_the_sums_of_facts_and_bridge(spark, odd, mart, key):
    month = odd["fact_order"].join(odd["dim_date"].select(F.col("date_key").alias("purchase_date_key"), F.col("month_start_date").alias("period_month")), "purchase_date_key").select("order_key", "period_month")
    items = odd["fact_order_item"].join(month, "order_key").groupBy("period_month", key).agg(F.count_distinct("order_key").alias("order_count"), F.count("*").alias("item_count"), F.sum("price").alias("gross_merchandise_value"))
    reviews = odd["bridge_review_item"].join(month, "order_key").groupBy("period_month", key).agg(F.sum("allocation_weight").alias("allocated_review_count"), F.sum("allocated_review_score").alias("allocated_review_score"))
    names = ["period_month", key, "order_count", "item_count", "gross_merchandise_value", "allocated_review_count", "allocated_review_score"]
    rows = lambda df: sorted(tuple(str(r[c]) if c in names[:2] else decimal.Decimal(r[c] or 0) for c in names) for r in df.select(*names).collect())
    assert rows(odd[mart]) == rows(items.join(reviews, ["period_month", key], "full"))
    unknown = odd["dim_product" if key == "product_key" else "dim_seller"].where("product_id = '__UNKNOWN__'" if key == "product_key" else "seller_id = '__UNKNOWN__'").first()[key]
    assert odd[mart].where(F.col(key) == unknown).count() > 1


def test_facts_and_large_marts_are_not_written(spark, odd, tmp_path):
    """64 letters for each key of each row were most of the disk."""
    at = f"file://{tmp_path}/models"
    sources = {n: df.withColumns({c: F.lit("r") for c in silver.RUN}) for n, df in bronze(spark, SF).items()}
    m = registry.release_models(spark, sources, at, "r")
    for name in registry.READ_ONLY:
        assert not m[name].isEmpty()
    written = {p.name for p in (tmp_path / "models").iterdir()}
    assert not written & set(registry.READ_ONLY) and {"sil_order", "sil_order_item", "dim_product"} <= written
    kinds = {n: dict(spark.read.parquet(f"{at}/{n}").dtypes).get("record_hash") for n in written if n.startswith("sil_")}
    assert kinds["sil_order"] == "binary" and kinds["sil_order_item"] is None and "string" not in kinds.values()
    for name in ("order", "order_item", "order_review", "seller"):  # the hash that is made anew is the one that was left out
        own = silver.build(spark, sources)[name].select("record_hash")
        assert own.exceptAll(m[f"sil_{name}"].select("record_hash")).isEmpty()


@pytest.mark.parametrize("name", ["mart_product_review", "mart_seller_performance", "mart_order_delivery", "mart_customer_overview"])
def test_rows_of_marts_are_not_dealt_by_long_keys(spark, odd, name):
    """They were joined and grouped by order_key, product_key and seller_key."""
    s = silver.Lazy({n: lambda _, n=n: odd[f"sil_{n}"] for n in ("order", "order_item", "order_payment", "order_review")})
    g = silver.Lazy({n: lambda _, n=n: odd[n] for n in ("dim_date", "dim_geography", "dim_customer", "dim_product", "dim_seller")})
    plan = getattr(gold, name)(g, s)._jdf.queryExecution().executedPlan().toString()
    dealt = [x.split(")")[0] for x in plan.split("hashpartitioning(")[1:]]
    assert dealt and not [x for x in dealt if re.search(r"\b(order|product|seller|customer)_key#", x)]


def test_a_model_that_is_not_written_keeps_its_contract(spark):
    df = spark.createDataFrame([("f1", 1.0), (None, 1.0), ("f3", -1.0)], "payment_key string, payment_value double").withColumn("payment_count", F.lit(1))
    columns = {"payment_key": "", "payment_value": "d"}
    out = contracts.guarded("fact_payment", df, columns)
    assert out.count() == 3 and {r[0] for r in out.select(contracts.VERSION).collect()} == {"fact-payment-v1"}
    for column, told in (("payment_key", "null payment_key"), ("payment_value", "not payment_value >= 0")):
        with pytest.raises(Exception, match=f"ContractBroken: fact_payment: {told}"):
            out.select(column).collect()
    with pytest.raises(contracts.ContractBroken, match="of another kind: payment_value"):
        contracts.guarded("fact_payment", df, columns | {"payment_value": "i"})
    assert contracts.guarded("fact_payment", df.where("payment_key = 'f1'"), columns).collect()[0]["payment_value"] == 1.0
