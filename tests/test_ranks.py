"""Nearest ranks by ranges, and roll-ups, against plain Python."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kelpline.operators import ranks
from kelpline.sinks.release import kept_in


@pytest.fixture
def keep(spark, tmp_path):
    return kept_in(spark, f"file://{tmp_path}")


@pytest.mark.parametrize("fraction", ["0.95", "0.5", "1", "0.001", "0.333"])
def test_nearest_ranks(spark, keep, fraction):
    rng = random.Random(fraction)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(200)])) for _ in range(3000)] + [("hot", 7)] * 2000 + [("one", 5), ("none", None)] + [("wide", i) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(7)
    want = {}
    for g in {g for g, v in rows if v is not None}:
        own = sorted(v for x, v in rows if x == g and v is not None)
        want[g] = own[math.ceil(Decimal(fraction) * len(own)) - 1]
    assert {r.g: r.nearest_rank for r in ranks.nearest_ranks(df, ["g"], "v", fraction, keep).collect()} == want


def test_only_the_range_of_the_rank_is_gone_through(spark, keep):
    """One group over many ranges: the rows behind the join are those of one of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = []
        df = spark.range(40_000).select(F.lit("g").alias("g"), F.col("id").alias("v"))
        out = ranks.nearest_ranks(df, ["g"], "v", "0.95", lambda n, x: kept.append(keep(n, x)) or kept[-1])
        assert out.first()["nearest_rank"] == 37_999
        sizes = [r["count"] for r in kept[0].groupBy("range_").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 15_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


CALLS = "g string, invocation_id string, state string, input_tokens bigint, output_tokens bigint, cost decimal(18,2), latency bigint, error_code string"
GOOD = [("x", f"i{i}", "SUCCEEDED", i, 2 * i, Decimal(i), 10 * i, None) for i in range(1, 31)] + [("x", "j1", "FAILED", 0, 0, Decimal(0), 5, "B"), ("x", "j2", "QUARANTINED", 1, 1, Decimal(1), 6, "A"), ("x", "j3", "FAILED", 0, 0, Decimal(0), 7, "B")]


def test_rollup(spark, keep):
    out = ranks.invocation_rollup(spark.createDataFrame(GOOD, CALLS), ["g"], keep)
    (r,) = out.collect()
    assert (r.invocations, r.succeeded_invocations, r.failed_invocations, r.quarantined_invocations) == (33, 30, 2, 1)
    assert (r.total_input_tokens, r.total_output_tokens, r.total_cost, r.total_latency) == (466, 931, Decimal(466), 4668)
    assert r.p95_latency == sorted(c[6] for c in GOOD)[math.ceil(33 * 0.95) - 1] and [tuple(e) for e in r.errors] == [("A", 1), ("B", 2)]
    ledger = lambda n, cost: spark.createDataFrame([("x", n, Decimal(cost))], "g string, valid_count bigint, committed decimal(18,2)")
    assert ranks.reconciled(out, ledger(30, 466), ["g"]).first()["invocations"] == 33
    for bad, code in ((ledger(29, 466), "COVERAGE_MISMATCH"), (ledger(30, 465), "BUDGET_MISMATCH"), (ledger(30, 466).limit(0), "MISMATCH")):
        with pytest.raises(Exception, match=code):
            ranks.reconciled(out, bad, ["g"]).collect()


@pytest.mark.parametrize(
    ("row", "code"),
    [
        (("x", "i1", "SUCCEEDED", 1, 1, Decimal(1), 1, None), "DUPLICATE_INVOCATION"), (("x", "i1", "FAILED", 1, 1, Decimal(1), 1, "A"), "DUPLICATE_INVOCATION"), (("x", "n", "SUCCEEDED", -1, 1, Decimal(1), 1, None), "INVALID"),
        (("x", "n", "FAILED", 1, 1, Decimal(1), 1, None), "INVALID"), (("x", "n", "SUCCEEDED", 1, 1, Decimal(1), 1, "A"), "INVALID"), (("x", "n", "other", 1, 1, Decimal(1), 1, "A"), "INVALID"), (("x", "n", "SUCCEEDED", 1, None, Decimal(1), 1, None), "INVALID"),
    ],
)
def test_what_a_rollup_refuses(spark, keep, row, code):
    with pytest.raises(Exception, match=code):
        ranks.invocation_rollup(spark.createDataFrame([*GOOD, row], CALLS), ["g"], keep).collect()


def test_cohort(spark):
    rows = [("a", 2), ("a", 2), ("b", 1), (None, 9), (None, 3), ("c", 5)]
    frame = lambda r: spark.createDataFrame(r, "who string, lifetime bigint")
    assert tuple(ranks.cohort(frame(rows), "who", "lifetime").first()) == (3, 2, Decimal("0.666667"), 2)
    assert tuple(ranks.cohort(frame(rows).limit(0), "who", "lifetime").first()) == (0, 0, None, 0)
    for bad in (("a", 3), ("a", None)):
        with pytest.raises(Exception, match="COHORT_CONFLICT"):
            ranks.cohort(frame([*rows, bad]), "who", "lifetime").collect()


def test_fields_are_read_as_python_reads_them(spark):
    from datetime import datetime
    from decimal import InvalidOperation

    from kelpline.operators import validate as V

    times = ["2020-01-01 01:02:03", "2020-1-1 1:1:1", "2020-01- 5 01:02:03", "2020-01-01  01:02:03", "2020-02-30 00:00:00", "2019-2-29 0:0:0", "2020-13-01 00:00:00", "2020-01-01 24:00:00", "2020-01-01 00:60:00", "20-01-01 00:00:00", "2020-01-01T00:00:00", "2020-01-01 00:00", " 2020-01-01 00:00:00", "2020-01-01 00:00:00 ", "0000-01-01 00:00:00", "2020-00-01 00:00:00", "2020-01-00 00:00:00", "9999-12-31 23:59:59", "2020-10-1 10:1:59"]
    numbers = ["1", "-1.5", "+.5", "5.", "1e3", "1E-2", " 7 ", "1_000.25", "1_0_", "", ".", "1e", "NaN", "Infinity", "0x1", "1,5", "\t2\n", "1 2", "--1"]
    kinds = {"timestamp": (times, lambda x: datetime.strptime(x, "%Y-%m-%d %H:%M:%S")), "decimal": (numbers, Decimal)}
    for kind, (values, read) in kinds.items():
        found = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in values], "x string").select("x", V.typed(V.Field("x", kind), F.col("x"))).collect()}
        for x in values:
            try:
                want = read(x)
                want = None if kind == "decimal" and not want.is_finite() else want
            except (ValueError, InvalidOperation):
                want = None
            assert found[x] == want, (kind, x)
