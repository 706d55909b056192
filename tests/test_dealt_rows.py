"""Rows are dealt in as many partitions as they need, so that no sort or hash table of a task grows with the tables."""

import pytest
from pyspark.sql import functions as F

from kelpline.operators import relational
from kelpline.plans import silver
from kelpline.registry_ingest import _two_releases
from kelpline.sources.commerce import bronze

SF = "/root/testdata/sf0.001"
NAMES = ("order", "order_item", "order_payment", "order_review")


def _classified(spark):
    b = bronze(spark, SF)
    return b, silver.build(spark, {n: df.withColumns({c: F.lit("r") for c in silver.RUN}) for n, df in b.items()})


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(relational, "PART_ROWS", 100)


def _largest(df) -> int:
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("name", NAMES)
def test_no_task_has_many_rows(spark, few, name):
    assert _largest(_classified(spark)[1][name]) < 350


@pytest.mark.parametrize("name", NAMES)
def test_parts_change_no_row(spark, monkeypatch, name):
    prints = []
    for rows in (100, 10**9):
        monkeypatch.setattr(relational, "PART_ROWS", rows)
        prints.append(relational.fingerprint(_classified(spark)[1][name], name).first())
    assert prints[0] == prints[1] and prints[0].row_count > 0


def test_items_are_counted_where_their_orders_lie(spark, few):
    """Items and orders are dealt alike before any aggregate or join, so that no other shuffle deals them by order_id."""
    dealt = [line for line in _classified(spark)[1]["order"]._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(dealt) == 2 and all("REPARTITION_BY_NUM" in line for line in dealt), dealt


def test_tables_of_dates_and_of_a_later_release_are_written_in_small_parts(spark, few):
    """What dim_date (F24) and release_sil_order_item (F25) build: each task writes a file."""
    m = _two_releases(spark, SF)
    assert m["dim_date"].count() > 1
    for name in ("sil_order", "sil_order_item", "sil_order_review"):
        files, rows = len(m[name].inputFiles()), m[name].count()
        assert rows / files < 200, (name, rows, files)
