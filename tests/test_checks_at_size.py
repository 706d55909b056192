"""Checks over all models read each relation once, and shuffle no long keys and no constants."""

import pytest
from pyspark.sql import functions as F

from kelpline.operators import relational as R
from kelpline.plans import contracts, gold, silver
from kelpline.sources import landing
from kelpline.sources.commerce import bronze


def _counted(df, seen):
    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema)


def test_orphans_of_all_keys_are_counted_in_one_read_of_each_relation(spark):
    """a relation was read once for each of its keys and children."""
    seen = {n: spark.sparkContext.accumulator(0) for n in ("a", "b", "c")}
    rows = {
        "a": spark.createDataFrame([("k1", 1), ("k2", 2), (None, 3)], "a_key string, day long"),
        "b": spark.createDataFrame([("b1", "k1", 1), ("b2", "gone", 1), ("b3", "gone", 9), ("b4", None, None)], "b_key string, a_key string, day long"),
        "c": spark.createDataFrame([("b1", "k2"), ("b9", "k2"), ("k1", "b1")], "b_key string, a_key string"),
    }
    keys = [("b", "a_key", "a", "a_key"), ("b", "day", "a", "day"), ("c", "b_key", "b", "b_key"), ("c", "a_key", "a", "a_key")]
    wanted = [(c, k, p, R.orphans(rows[c], k, rows[p], q).count()) for c, k, p, q in keys]
    assert [n for *_, n in wanted] == [2, 1, 2, 1]
    found = R.orphan_counts({n: _counted(df, seen[n]) for n, df in rows.items()}, keys)
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)
    assert {n: a.value for n, a in seen.items()} == {"a": 3, "b": 4, "c": 3}
    none = R.orphan_counts({n: df.limit(0) for n, df in rows.items()}, keys).collect()
    assert len(none) == 4 and {r["orphans"] for r in none} == {0}


def test_a_model_is_measured_in_one_read(spark):
    """rows and repeated grains were two reads, and grains were dealt by their long keys."""
    seen = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([("f1", 1.0), ("f1", 2.0), ("f2", 1.0), (None, 1.0), (None, 1.0)], "payment_key string, payment_value double").withColumn(contracts.VERSION, F.lit("fact-payment-v1"))
    assert tuple(contracts.measured("fact_payment", _counted(rows, seen), True).first()) == ("fact_payment", 5, contracts.repeated_grains("fact_payment", rows).count(), "fact-payment-v1")
    assert seen.value == 5
    mixed = rows.unionByName(rows.withColumn(contracts.VERSION, F.lit("other")))
    assert contracts.measured("fact_payment", mixed, False).first()[contracts.VERSION] is None
    two = spark.createDataFrame([("a", "b1"), ("ab", "1"), ("a", None)], "period_month string, geography_key string").withColumn(contracts.VERSION, F.lit("mart-order-delivery-v1"))
    assert contracts.measured("mart_order_delivery", two, False).first()["repeated"] == 0
    assert tuple(contracts.measured("fact_payment", rows.limit(0), True).first()) == ("fact_payment", 0, 0, None)


def test_a_measured_model_that_breaks_its_contract_fails(spark):
    rows = contracts.guarded("fact_payment", spark.createDataFrame([("f1", -1.0)], "payment_key string, payment_value double").withColumn("payment_count", F.lit(1)), {"payment_key": "", "payment_value": "d"})
    with pytest.raises(Exception, match="ContractBroken: fact_payment: not payment_value >= 0"):
        contracts.measured("fact_payment", rows, True).collect()


def test_shuffles_carry_no_constants_and_no_long_product_keys(spark, tmp_path):
    """Ids of a release, batch and run went with every row, and product_key as 64 letters."""
    sources = bronze(spark, "/root/testdata/sf0.001")
    landing.land(sources, f"file://{tmp_path}", "r1", "batch_r1")
    s = silver.build(spark, landing.landed(spark, f"file://{tmp_path}", list(sources), "r1", "batch_r1"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    for name in ("order", "order_item", "order_payment", "order_review", "product"):
        plan = s[name]._jdf.queryExecution().executedPlan().toString()
        read = [x.split("]")[0] for x in plan.split("FileScan parquet [")[1:]]
        assert read and not [x for x in read if "dataset_run_id" in x], name
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    stored = {r[0] for r in spark.read.parquet(f"file://{tmp_path}/orders").select("dataset_run_id").distinct().collect()}
    assert {r[0] for r in s["order"].select("dataset_run_id").distinct().collect()} == stored and len(stored) == 1
    g = gold.build(s, release="r1")
    for name in ("fact_order_item", "bridge_review_item"):
        plan = g[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "unhex(" in plan, name  # of product_key, which is made in the same projection here


def test_idle_workers_give_back_the_memory_of_batches(monkeypatch):
    """pipeline: workers kept what Arrow's pool had held for batches of earlier stages."""
    import pyarrow as pa

    from kelpline.llm import common

    class Pool:
        released = 0

        def release_unused(self):
            self.released += 1

    pool = Pool()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    assert [x.to_pylist() for x in common.slices(pa.array(["ab", None, "cd"]), 3)] == [["ab", None], ["cd"]] and pool.released == 1
