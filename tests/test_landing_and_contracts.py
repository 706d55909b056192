"""One release and batch of several, and models that break their contract."""

import pytest
from pyspark.sql import functions as F

from kelpline.functions.identities import dataset_run_id, ingestion_batch_id, source_object_id
from kelpline.operators.relational import fingerprint
from kelpline.plans import contracts, gold, silver
from kelpline.sinks.release import Conflict, create_only, kept_in
from kelpline.sources import landing
from kelpline.sources.commerce import bronze

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('landing')}"
    frames = bronze(spark, SF)
    for release in ("r1", "r2"):
        own = {n: df.limit(3) if release == "r2" else df for n, df in frames.items()}
        assert set(landing.land(own, at, release, f"batch_{release}").values()) == {"LOADED"}
    return at


def test_every_scan_of_every_model_is_pruned_to_a_release_and_batch(spark, base):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    b = landing.landed(spark, base, list(bronze(spark, SF)), "r1", "batch_r1")
    s = silver.build(spark, b)
    g = gold.build(s, release="r1")
    for frames in (s, g):
        for name in frames.names():
            if name in ("unknown_member",):
                continue
            plan = frames[name]._jdf.queryExecution().executedPlan().toString()
            filters = [x.split("PartitionFilters: [")[1].split("]")[0] for x in plan.split("FileScan parquet")[1:]]
            assert filters and all("= r1)" in x and "= batch_r1)" in x for x in filters), name
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_files_of_the_other_release_are_not_read(spark, base, tmp_path):
    import pathlib
    import shutil

    at = tmp_path / "copy"
    shutil.copytree(base.removeprefix("file://"), at)
    for p in pathlib.Path(at).rglob("source_release_id=r2/**/*.parquet"):
        p.write_bytes(b"not parquet")
    names = list(bronze(spark, SF))
    b = landing.landed(spark, f"file://{at}", names, "r1", "batch_r1")
    assert gold.build(silver.build(spark, b))["mart_order_delivery"].count() == 1008
    assert {r[0] for df in b.values() for r in df.select("source_release_id").distinct().collect()} == {"r1"}


def test_a_release_that_is_not_there_or_is_landed_again(spark, base):
    with pytest.raises(ValueError, match="not there"):
        landing.landed(spark, base, ["orders"], "r3", "batch_r3")
    with pytest.raises(ValueError, match="begin with a letter"):
        landing.landed(spark, base, ["orders"], "1", "batch_r1")
    orders = bronze(spark, SF)["orders"]
    assert landing.land({"orders": orders}, base, "r1", "batch_r1") == {"orders": "REPLAY"}
    with pytest.raises(Conflict):
        landing.land({"orders": orders.limit(5)}, base, "r1", "batch_r1")


def test_lineage_is_what_the_ids_say(spark, base):
    b = landing.landed(spark, base, ["sellers"], "r1", "batch_r1")
    run = dataset_run_id(F.lit("batch_r1"), source_object_id(F.lit("r1"), F.lit("sellers"), F.lit("r1")), F.lit("sellers"), F.lit(landing.CONTRACT_VERSION))
    assert b["sellers"].where(F.col("dataset_run_id") != run).isEmpty()
    assert landing.batch_of(spark, "r1") == spark.range(1).select(ingestion_batch_id(F.lit("r1"))).first()[0]


GOOD = [("f1", "a", 1.0, "voucher"), ("f2", "b", 0.0, "boleto")]
COLUMNS = {"payment_key": "", "order_id": "", "payment_value": "d", "payment_type": ""}


def _write(spark, tmp_path, rows, name="fact_payment", columns=COLUMNS):
    df = spark.createDataFrame(rows, "payment_key string, order_id string, payment_value double, payment_type string").withColumn("payment_count", F.lit(1))
    keep, dropped = kept_in(spark, f"file://{tmp_path}"), []
    try:
        return contracts.enforced(name, df, columns, lambda x: keep(name, x), lambda: dropped.append(1)), dropped
    except contracts.ContractBroken as e:
        return str(e), dropped


def test_a_contract_is_checked_as_the_model_is_written(spark, tmp_path):
    out, dropped = _write(spark, tmp_path, GOOD)
    assert {r[contracts.VERSION] for r in out.collect()} == {"fact-payment-v1"} and not dropped
    assert contracts.repeated_grains("fact_payment", out).isEmpty()
    told, dropped = _write(spark, tmp_path, [*GOOD, (None, "c", -1.0, None), (None, "d", None, "voucher")])
    assert told == "fact_payment: not payment_value >= 0 (1 rows), null payment_key (2 rows), null payment_type (1 rows), null payment_value (1 rows)" and dropped
    assert _write(spark, tmp_path, GOOD, columns=COLUMNS | {"payment_value": "i", "gone": ""})[0] == "fact_payment: missing or of another kind: payment_value, gone"
    repeated = _write(spark, tmp_path, [*GOOD, GOOD[0]])[0]
    assert [tuple(r) for r in contracts.repeated_grains("fact_payment", repeated).collect()] == [("f1", 2)]


def test_the_check_reads_its_model_once(spark, tmp_path):
    """Counted by an accumulator in the only scan."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(GOOD, "payment_key string, order_id string, payment_value double, payment_type string").mapInArrow(count, "payment_key string, order_id string, payment_value double, payment_type string")
    keep = kept_in(spark, f"file://{tmp_path}")
    contracts.enforced("fact_payment", df.withColumn("payment_count", F.lit(1)), COLUMNS, lambda x: keep("fact_payment", x))
    assert seen.value == len(GOOD)


def test_null_is_no_tilde(spark, tmp_path):
    """Tables that a separator or a mark for null would take for one another."""
    rows = [[("1", None)], [("1", "~")], [("1", "-")], [("1\x1f2", "")], [("1", "2\x1f")], [("", "12:x")], [("12:x", "")]]
    found = [fingerprint(spark.createDataFrame(r, "a string, b string"), "x").first()["content_hash"] for r in rows]
    assert len(set(found)) == len(rows)
    create_only(spark.createDataFrame(rows[0], "a string, b string"), f"file://{tmp_path}/t")
    with pytest.raises(Conflict):
        create_only(spark.createDataFrame(rows[1], "a string, b string"), f"file://{tmp_path}/t")
