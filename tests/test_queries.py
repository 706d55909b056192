"""Every query with SQL gives the rows that its SQL gives."""

import pytest

from kelpline import registry
from tests.compare import duck, rows_of, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    names, rows = rows_of(registry.queries()[name](spark, SF))
    assert (names, rows) == sql_rows(con, registry.oracle_sql()[name])


def test_fingerprints_do_not_depend_on_partitions(spark):
    from kelpline.operators import relational

    df = spark.read.parquet(f"{SF}/orders.parquet")
    a, b = (relational.fingerprint(x, "orders").collect() for x in (df, df.repartition(7)))
    assert a == b


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
