"""Loads with a ledger, upserts and searches of vectors, and the gate over findings."""

import hashlib
import json

import pytest


from kelpline.operators import validate as V
from kelpline.operators import vectors as X
from kelpline.sinks import loads
from kelpline.sinks.release import Conflict

ROWS = "object_key string, object_sha256 string, v int"


def _load(spark, at, rows):
    return {r.object_key: (r.status, r.rows_parsed, r.rows_loaded) for r in loads.load_objects(spark.createDataFrame(rows, ROWS), f"{at}/target", f"{at}/ledger").collect()}


def test_each_object_is_loaded_once(spark, tmp_path):
    at = f"file://{tmp_path}"
    a, b = [("raw/a=1/x", "h1", i) for i in range(3)], [("07", "h2", 9)]
    assert _load(spark, at, a) == {"raw/a=1/x": ("LOADED", 3, 3)}
    assert _load(spark, at, a + b) == {"raw/a=1/x": ("REPLAY_SKIPPED", 0, 0), "07": ("LOADED", 1, 1)}
    there = loads.loaded_rows(spark, spark.createDataFrame(a, ROWS), f"{at}/target")
    assert sorted(map(tuple, there.collect())) == sorted(a + b) and loads.ledger_of(spark, f"{at}/ledger").count() == 2
    for bad in ([("07", "other", 1)], [("new", "h1", 1), ("new", "h2", 1)]):
        with pytest.raises(Conflict):
            _load(spark, at, bad)
    assert there.count() == 4 and loads.ledger_of(spark, f"{at}/ledger").count() == 2


def test_a_load_cut_off_before_its_ledger_leaves_rows_once(spark, tmp_path):
    at = f"file://{tmp_path}"
    rows = [("k", "h", i) for i in range(4)]
    spark.createDataFrame(rows[:2], ROWS).write.partitionBy("object_key").parquet(f"{at}/target")  # killed here
    assert _load(spark, at, rows) == {"k": ("LOADED", 4, 4)}
    assert loads.loaded_rows(spark, spark.createDataFrame(rows, ROWS), f"{at}/target").count() == 4


VECTORS = "vec_id int, embedding array<double>, source_table string, index_version string, data_release_id string"


def _vectors(spark, *rows):
    return spark.createDataFrame([(i, e, "t", v, r) for i, e, v, r in rows], VECTORS)


def test_upserts_and_searches(spark):
    stored = _vectors(spark, (1, [0.0, 0.0], "v1", "r1"), (2, [5.0, 5.0], "v1", "r1"), (3, [0.1, 0.0], "v1", "r2"))
    both = X.upserted(stored, _vectors(spark, (2, [1.0, 0.0], "v1", "r1"), (4, [9.0, 9.0], "v1", "r1")), "v1")
    assert {r.vec_id: r.embedding for r in both.collect()} == {1: [0, 0], 2: [1, 0], 3: [0.1, 0], 4: [9, 9]}
    own = {"source_table": "t", "index_version": "v1", "data_release_id": "r1"}
    assert [(r.vec_id, r.distance) for r in X.search(both, [0.0, 0.0], 2, own).collect()] == [(1, 0.0), (2, 1.0)]
    assert X.search(both, [0.0, 0.0], 2, own | {"data_release_id": "none"}).isEmpty()
    with pytest.raises(ValueError, match="authority names"):
        X.search(both, [0.0, 0.0], 2, {"source_table": "t"})
    with pytest.raises(Exception, match="differ in dimension"):
        X.search(both, [0.0], 2, own).collect()


@pytest.mark.parametrize(
    ("rows", "code"),
    [
        ([], "VECTORS_EMPTY"), ([(1, [1.0], "v1", "r"), (2, [1.0, 2.0], "v1", "r")], "DIMENSIONS_DIFFER"), ([(1, [], "v1", "r")], "DIMENSIONS_DIFFER"),
        ([(1, [1.0], "v2", "r")], "INDEX_VERSION_MISMATCH"), ([(1, [1.0], None, "r")], "INDEX_VERSION_MISMATCH"), ([(1, [1.0], "v1", "r"), (1, [2.0], "v1", "r")], "VECTOR_ID_REPEATED"),
    ],
)
def test_batches_that_are_refused(spark, rows, code):
    with pytest.raises(Exception, match=code):
        stored = _vectors(spark, (9, [1.0], "v1", "r"))
        X.upserted(stored, _vectors(spark, *rows) if rows else stored.limit(0), "v1").collect()


def _gate(spark, *findings):
    return V.quality_gate(spark.createDataFrame(list(findings), "severity string, model string, code string, n bigint"), ["model", "code"])


def test_the_gate_over_findings(spark):
    some = [("WARN", "m", "A", 2), ("QUARANTINE", "m", "B", 3)]
    r = _gate(spark, *some).first()
    text = json.dumps({"contract_version": V.DQ_VERSION, "findings": sorted([s, m, c, str(n)] for s, m, c, n in some), "status": "PASS_WITH_FINDINGS"}, separators=(",", ":"))
    assert tuple(r) == ("PASS_WITH_FINDINGS", 0, 2, 3, hashlib.sha256(text.encode()).hexdigest())
    assert _gate(spark, *some[::-1]).first() == r and _gate(spark, *some, ("CRITICAL", "m", "C", 1)).first()["status"] == "BLOCKED"
    none = V.quality_gate(spark.createDataFrame(some, "severity string, model string, code string, n bigint").limit(0), ["model", "code"]).first()
    assert tuple(none)[:4] == ("PASS", 0, 0, 0)
    for bad, code in ((("WARN", "m", "A", 5), "REPEATED"), (("other", "m", "Z", 5), "INVALID"), (("WARN", "m", "Z", 0), "INVALID")):
        with pytest.raises(Exception, match=f"DQ_FINDING_{code}"):
            _gate(spark, *some, bad).collect()
