"""Exact partitions, set equality, strict histories, samples that are too large, and files of different headers."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kelpline.operators import annotations as A
from kelpline.operators import partitions as P
from kelpline.operators import relational as R
from kelpline.operators import validate as V
from kelpline.sinks.release import kept_in
from kelpline.sources import bounded_csv as B


def _frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def test_an_exact_partition(spark):
    source, facts, gone = (_frame(spark, x) for x in (["one", "two", None], [None, "one"], ["two"]))
    assert tuple(P.partition_result(source, facts, gone, ["k"]).first()) == (3, 2, 1)
    assert P.partition_issues(source, {"facts": facts, "excluded": gone}, ["k"]).isEmpty()
    empty = _frame(spark, []).limit(0)
    assert tuple(P.partition_result(empty, empty, empty, ["k"]).first()) == (0, 0, 0)


@pytest.mark.parametrize(
    ("source", "facts", "gone", "issues"),
    [
        (["a", "b", "c"], ["a"], ["c"], {("b", "GAP")}), (["a", "b", "c"], ["a", "a"], ["b", "c"], {("a", "REPEATED")}), (["a"], ["a"], ["a"], {("a", "OVERLAP")}), (["a"], ["a", "x"], [], {("x", "STRANGER")}),
        (["a", "a"], ["a"], [], {("a", "REPEATED")}), ([], ["x", "x"], ["x"], {("x", "STRANGER"), ("x", "OVERLAP"), ("x", "REPEATED")}), ([None], [], [], {(None, "GAP")}),
    ],
)
def test_each_break_has_its_row(spark, source, facts, gone, issues):
    source, facts, gone = (_frame(spark, x) for x in (source, facts, gone))
    found = P.partition_issues(source, {"facts": facts, "excluded": gone}, ["k"]).select("k", F.explode("issues")).collect()
    assert {tuple(r) for r in found} == issues
    with pytest.raises(Exception, match="FACT_PARTITION_BROKEN"):
        P.partition_result(source, facts, gone, ["k"]).collect()


def test_issues_against_counters(spark):
    rng = random.Random(8)
    draw = lambda n: [rng.choice([*"abcdefghij", None]) for _ in range(n)]
    for n in (3, 8, 20):
        s, a, b = draw(n), draw(n // 2), draw(n // 2)
        x, y, z = Counter(s), Counter(a), Counter(b)
        want = set()
        for k in {*s, *a, *b}:
            flags = ((x[k] and not y[k] and not z[k], "GAP"), (not x[k], "STRANGER"), (y[k] and z[k], "OVERLAP"), (max(x[k], y[k], z[k]) > 1, "REPEATED"))
            want |= {(k, name) for on, name in flags if on}
        found = P.partition_issues(_frame(spark, s), {"a": _frame(spark, a), "b": _frame(spark, b)}, ["k"]).select("k", F.explode("issues")).collect()
        assert {tuple(r) for r in found} == want


def test_one_shuffle(spark):
    df = _frame(spark, ["a", "b"])
    plan = P.partition_issues(df, {"a": df, "b": df}, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_membership(spark):
    found = P.membership_issues(_frame(spark, ["a", "b", "c", None]), _frame(spark, ["b", "c", "c", "d", None]), ["k"])
    assert {tuple(r) for r in found.collect()} == {("a", "MISSING"), ("d", "UNEXPECTED"), ("c", "REPEATED")}


def _history(spark, rows):
    h = spark.createDataFrame(rows, "k string, v int, f string, u string")
    return h.select("k", "v", F.col("f").cast("timestamp_ntz").alias("effective_from"), F.col("u").cast("timestamp_ntz").alias("effective_to"))


GOOD = [("k", 1, "2020-01-01", "2021-01-01"), ("k", 2, "2021-01-01", "2021-03-01"), ("k", 3, "2021-05-01", None), ("o", 9, "2020-06-01", None), (None, 7, "2019-01-01", None), (None, 8, "2019-01-01", None)]
EVENTS = [(1, "k", "2020-12-31 23:59:59"), (2, "k", "2021-01-01"), (3, "k", "2019-12-31"), (4, None, "2020-01-01"), (5, "k", "2021-04-01"), (6, "o", "2030-01-01"), (7, "k", None), (8, None, None)]


@pytest.mark.parametrize("part", ["day", "year"])
@pytest.mark.parametrize("refuse", [True, False])
def test_as_of_with_null_keys(spark, part, refuse):
    events = spark.createDataFrame(EVENTS, "i int, k string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = R.join_as_of_sorted(events, _history(spark, GOOD), "k", "t", "v", F.lit(-1), part, refuse)
    want = {1: 1, 2: 2, 3: -1, 4: -1, 5: -1, 6: 9, 7: -1, 8: -1}
    assert {r.i: r.v for r in out.collect()} == want and out.count() == len(EVENTS)
    assert {r.i: r.v for r in R.join_as_of(events, _history(spark, GOOD), "k", "t", "v", F.lit(-1)).collect()} == want


@pytest.mark.parametrize("part", ["day", "year"])
@pytest.mark.parametrize("bad", [("k", 4, "2020-06-01", "2020-07-01"), ("k", 4, "2020-01-01", "2021-01-01"), ("k", 4, "2021-02-28", "2021-03-02"), ("k", 4, "2025-01-01", None), ("o", 4, "2020-05-01", "2020-05-01"), ("n", 4, "2021-05-01", "2021-04-01"), ("o", 4, "1999-01-01", "2020-06-02")])
def test_histories_that_are_refused(spark, part, bad):
    events = spark.createDataFrame(EVENTS[:1], "i int, k string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    with pytest.raises(Exception, match="HISTORY_OVERLAPS"):
        R.join_as_of_sorted(events, _history(spark, [*GOOD, bad]), "k", "t", "v", F.lit(-1), part, True).collect()


def test_a_sample_beyond_the_rows(spark):
    df = spark.range(5).withColumn("s", F.col("id") % 2)
    assert A.stratified_sample(df, "id", ["s"], 5, "x").count() == 5
    for n in (0, 6):
        with pytest.raises(ValueError, match="SELECTION_INVALID"):
            A.stratified_sample(df, "id", ["s"], n, "x")


def test_ascii_texts_are_not_composed(spark):
    """Only texts beyond ASCII go through Python, and all hash as Python says."""
    import hashlib
    import json
    import unicodedata

    texts = ["plain", "é", "é", "", "日本", 'q"\n', None]
    d = V.Dataset("d", ("a",), (V.Field("a", "string"),))
    rows = spark.createDataFrame([(t,) for t in texts], "a string").select("a", V.canonical_hash(d).alias("h")).collect()
    for r in rows:
        value = None if r.a is None else unicodedata.normalize("NFC", r.a)
        text = json.dumps({"contract": "record-hash-v1", "dataset_name": "d", "values": [["a", value]]}, ensure_ascii=False, separators=(",", ":"))
        assert r.h == hashlib.sha256(text.encode()).hexdigest(), r.a


@pytest.mark.parametrize("size", [7, 1 << 20])
def test_files_of_different_headers(spark, tmp_path, size):
    bodies = {
        "a.csv": "id,note,x\n1,NA,z\n\n2,\"b\n,\"\n3,,\n", "b.csv": "x,note,more,id\n,n,,4\n5\n6,7,8,9,10\n", "c.csv": 'note,id\n"open,1\n',
    }
    for n, b in bodies.items():
        (tmp_path / n).write_text(b)
    keep = kept_in(spark, f"file://{tmp_path}/kept")
    rows = B.subset_records(spark, f"file://{tmp_path}", ["id", "note"], keep, pattern="?.csv", range_bytes=size).collect()
    assert sorted((r.source_file[-5], r.source_row_number, r.id, r.note) for r in rows) == [("a", 2, "1", None), ("a", 4, "2", "b\n,"), ("a", 5, "3", None), ("b", 2, "4", "n"), ("b", 3, None, None), ("b", 4, "9", "7")]
    raw = B.subset_records(spark, f"file://{tmp_path}", ["id", "note"], keep, nulls=(), pattern="a.csv", range_bytes=size).collect()
    assert sorted((r.id, r.note) for r in raw) == [("1", "NA"), ("2", "b\n,"), ("3", "")]
    with pytest.raises(B.HeaderInvalid, match="^c.csv$"):
        B.subset_records(spark, f"file://{tmp_path}", ["x"], keep, pattern="?.csv")
