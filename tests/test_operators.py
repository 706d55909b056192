"""Operators against brute force and stated cases."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kelpline.operators import annotations as A
from kelpline.operators import relational as R
from kelpline.operators import text as X
from kelpline.operators import validate as V
from kelpline.sinks.release import Conflict, Releases, shared_folder


def _digest(*parts):
    return hashlib.sha256(":".join(map(str, parts)).encode()).hexdigest()


@pytest.mark.parametrize("count", [1, 5, 12, 40, 97])
def test_stratified_sample_equals_the_greedy_loop(spark, count):
    rng = random.Random(4)
    rows = [(i, rng.choice("aaaaab"), rng.choice("xyz")) for i in range(97)]
    groups = defaultdict(list)
    for i, a, b in sorted(rows, key=lambda r: _digest("s", r[0])):
        groups[a, b].append(i)
    taken = dict.fromkeys(groups, 0)
    name = {g: _digest("s", *g) for g in groups}
    for g in sorted(groups, key=name.get)[:count]:
        taken[g] = 1
    while sum(taken.values()) < count:
        g = max((g for g in groups if taken[g] < len(groups[g])), key=lambda g: (len(groups[g]) * count / len(rows) - taken[g], name[g]))
        taken[g] += 1
    expected = sorted(i for g, n in taken.items() for i in groups[g][:n])
    df = spark.createDataFrame(rows, "i int, a string, b string")
    assert sorted(r.i for r in A.stratified_sample(df, "i", ["a", "b"], count, "s").collect()) == expected


def test_rank_in_a_stratum_is_by_hash(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "k") for i in range(500)], "i int, s string")
    rows = A.ranked(df, ["s"], A.digest("z", F.col("i")), "i").collect()
    for s in (None, "k"):
        own = sorted((r for r in rows if r.s == s), key=lambda r: r.stratum_rank)
        assert [r.stratum_rank for r in own] == list(range(1, len(own) + 1))
        assert [r.i for r in own] == sorted((r.i for r in own), key=lambda i: _digest("z", i))


def test_revisions(spark):
    rows = [("k", "2024-01-02 00:00:00", "2024-01-03 00:00:00", 1, "first"), ("k", "2024-01-02 00:00:00", "2024-01-03 01:00:00", 2, "correction"), ("k", "2024-01-01 00:00:00", "2024-01-05 00:00:00", 3, "late"), ("k", "2024-01-01 00:00:00", "2024-01-05 00:00:00", 3, "late")]
    df = spark.createDataFrame(rows, "k string, at string, ingested string, source_row_number int, record_hash string").select("k", F.col("at").cast("timestamp_ntz").alias("at"), F.col("ingested").cast("timestamp_ntz").alias("ingested_at"), "source_row_number", "record_hash")
    out = {r.record_hash: (r.disposition, r.replays) for r in R.revision_dispositions(df, ["k"], "at").collect()}
    assert out == {"correction": ("CURRENT", 0), "first": ("CORRECTION_SUPERSEDED", 0), "late": ("LATE_SUPERSEDED", 1)}
    new = spark.createDataFrame([("k", 2), ("n", 3)], "k string, v int")
    assert sorted(tuple(r) for r in R.upsert(spark.createDataFrame([("k", 1), ("o", 1)], "k string, v int"), new, "k").collect()) == [("k", 2), ("n", 3), ("o", 1)]


def test_as_of_by_order_equals_the_range_join(spark):
    rng = random.Random(9)
    versions = [(k, i, a, a + rng.choice([1, 30, 200]) if rng.random() < 0.9 else None) for k in "ab" for i, a in enumerate(sorted(rng.sample(range(2000), 60)))]
    # half-open ranges without overlaps: each ends where the next begins, or before
    ends = [(k, i, a, min(e, versions[n + 1][2]) if n + 1 < len(versions) and versions[n + 1][0] == k and e is not None else (versions[n + 1][2] if n + 1 < len(versions) and versions[n + 1][0] == k else e)) for n, (k, i, a, e) in enumerate(versions)]
    hours = lambda c: F.expr("timestamp_ntz '2024-01-01 00:00:00'") + F.make_dt_interval(hours=F.col(c))
    h = spark.createDataFrame(ends, "k string, v int, a int, e int").select("k", "v", hours("a").alias("effective_from"), hours("e").alias("effective_to"))
    facts = spark.createDataFrame([(i, rng.choice(["a", "b", "c", None]), rng.randrange(-50, 2300)) for i in range(800)], "i int, k string, t int").select("i", "k", hours("t").alias("t"))
    one, two = (sorted((r.i, r.v) for r in f(facts, h, "k", "t", "v", F.lit(-1)).select("i", "v").collect()) for f in (R.join_as_of, R.join_as_of_sorted))
    assert len(one) == 800 and one == two and len({v for _, v in one}) > 20
    golden = spark.createDataFrame([("k", 1, "2020-01-01 00:00:00", "2021-01-01 00:00:00"), ("k", 2, "2021-01-01 00:00:00", None)], "k string, v int, f string, u string")
    golden = golden.select("k", "v", F.col("f").cast("timestamp_ntz").alias("effective_from"), F.col("u").cast("timestamp_ntz").alias("effective_to"))
    events = spark.createDataFrame([(1, "k", "2020-12-31 23:59:59"), (2, "k", "2021-01-01 00:00:00"), (3, "k", "2019-12-31 00:00:00")], "i int, k string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert [tuple(r) for r in R.join_as_of_sorted(events, golden, "k", "t", "v", F.lit(-1)).orderBy("i").select("v").collect()] == [(1,), (2,), (-1,)]


def test_logs_are_redacted(spark):
    text = "mail a.b@x.org, see www.site.com/a and https://y.z, card 4111 1111 1111 1111, call +55 (11) 91234-5678, id 12ab"
    df = spark.createDataFrame([(text, {"Password": "x", "note": "a@b.co", "other": None}), ("x" * 2000, {})], "t string, m map<string,string>")
    rows = df.select(X.redact_log(F.col("t")).alias("t"), X.redact_event(F.col("m")).alias("m")).collect()
    assert rows[0].t == "mail [EMAIL], see [URL] and [URL] card [PAYMENT], call [PHONE], id 12ab"
    assert rows[0].m == {"Password": "[REDACTED]", "note": "[EMAIL]", "other": None}
    assert rows[1].t == "x" * 1024 + "..."


def test_f1_and_gate(spark):
    perfect = spark.createDataFrame([(["a", "b"], ["b", "a"]), ([], [])], "t array<string>, p array<string>")
    none = spark.createDataFrame([([], [])], "t array<string>, p array<string>")
    half = spark.createDataFrame([(["a"], ["b"]), (["a"], ["a"])], "t array<string>, p array<string>")
    assert [tuple(A.set_f1(d, "t", "p").first()) for d in (perfect, none)] == [(1.0, 1.0)] * 2
    assert tuple(round(x, 6) for x in A.set_f1(half, "t", "p").first()) == (round((2 / 3 + 0) / 2, 6), 0.5)
    report = spark.createDataFrame([(0.9, 0.8, 0.7, 1.0), (0.9, 0.8, 0.75, 1.0)], "sentiment_macro_f1 double, aspect_macro_f1 double, topic_micro_f1 double, schema_pass_rate double")
    assert [(r.status, r.codes) for r in A.gate(report).collect()] == [("BLOCKED", ["AI_TOPIC_MICRO_F1_BELOW_GATE"]), ("PASSED", ["AI_QUALITY_GATE_PASSED"])]
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "t string, p string")
    out = X.macro_micro_f1(X.f1_by_class(pairs, "t", "p")).first()
    assert (out.n_classes, round(out.macro_f1, 6), round(out.micro_f1, 6)) == (2, round(2 / 3, 6), round(2 / 3, 6))


def test_malformed_responses(spark):
    good = '{"sentiment":"mixed","confidence":0,"aspect_sentiments":[],"topics":[],"summary":"s","highlights":[]}'
    bad = [None, "", "[]", "null", good + "x", good + good, f"{good},{good}", f"{good}],[{good}", good.replace('"topics":[]', '"topics":[null]'), good.replace('"highlights":[]', '"highlights":[" "]'), good.replace('"summary":"s"', '"summary":5'), good.replace('"summary":"s"', f'"summary":"{"s" * 501}"'), good.replace(',"topics":[]', "")]
    df = spark.createDataFrame([(p,) for p in [good, *bad]], "p string")
    assert [r.response is not None for r in A.validated_responses(df, "p").collect()] == [True] + [False] * len(bad)


def test_reconciliation_input(spark):
    inputs = spark.range(1).select(F.lit("orders").alias("dataset_name"), *[F.lit(-1 if c == "raw_rows" else 1).alias(c) for c in V.COUNTS], *[F.lit("0" * 64).alias(c) for c in V.HASHES], F.lit(False).alias("loaded_before"))
    with pytest.raises(Exception, match="RECONCILIATION_INPUT_INVALID"):
        V.reconcile(inputs).collect()


def test_an_invalid_candidate_is_revoked(spark):
    releases = Releases(spark, shared_folder(spark, "test"))
    for c in ("a", "b"):
        releases.build(c, {"x": spark.range(3)})
    assert releases.activate("a", 0) == 1 and releases.invalidate("b", 1) == 1
    assert releases.invalidate("a", 1) == 2 and releases.active() is None
    for c in ("a", "b"):
        with pytest.raises(Conflict, match="invalid"):
            releases.activate(c, 2)
    with pytest.raises(Conflict, match="invalid"):
        releases.rollback(2)


def test_fingerprint_sees_values_and_repeats_but_no_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    same = R.compare_fingerprints(R.fingerprint(a, "r"), R.fingerprint(a.orderBy(F.desc("i")).select("s", "i"), "r"))
    assert same.isEmpty()
    for other in (a.unionByName(a.limit(1)), a.withColumn("s", F.lit("x")), a.limit(0)):
        assert not R.compare_fingerprints(R.fingerprint(a, "r"), R.fingerprint(other, "r")).isEmpty()
