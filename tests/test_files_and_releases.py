"""Source files, create-only sinks, ledgers and the release pointer."""

import pytest
from pyspark.sql import functions as F

from kelpline.operators.validate import CONTRACTS, Dataset, Field
from kelpline.sinks import release
from kelpline.sources import files

NAMES = "product_category_name string, product_category_name_english string"
ODD = [(' a "b" ', "x,\ny"), ("ç", "line\n\nend"), ("plain", "p")]


@pytest.fixture
def csv(spark, tmp_path):
    files.write_csv(spark.createDataFrame(ODD, NAMES).coalesce(1), f"{tmp_path}/in")
    return f"{tmp_path}/in"


def test_csv_keeps_quotes_line_ends_and_rows(spark, csv):
    rows = files.read_csv(spark, csv, CONTRACTS["category_translation"]).orderBy("source_row_number").collect()
    assert [(r[0], r[1]) for r in rows] == ODD and [r["source_row_number"] for r in rows] == [2, 3, 4]


def test_other_header_fails(spark, csv):
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, csv, CONTRACTS["orders"]).collect()


PAIR = Dataset("pairs", ("key",), (Field("key", "string"), Field("text", "string", True)))
# body, most bytes of a record, and for each record its values, row, code, and its bytes
BODIES = [
    (b'\xef\xbb\xbfkey,text\r\n1,"hello\nworld"\r\n2,plain', 99, [("1", "hello\nworld", 2, None, b'1,"hello\nworld"'), ("2", "plain", 3, None, b"2,plain")]),
    (b'key,text\n1,"a ""quoted"" value"\n', 99, [("1", 'a "quoted" value', 2, None, b'1,"a ""quoted"" value"')]),
    (b"key,text\n1,\xff\n", 99, [(None, None, 2, "CSV_ENCODING_INVALID", b"1,\xff")]),
    (b'key,text\n1,"open\n2,b\n', 99, [(None, None, 2, "CSV_MALFORMED", b'1,"open\n2,b')]),
    (b'key,text\n\n"1"x,b\n', 99, [(None, None, 2, "CSV_MALFORMED", b""), (None, None, 3, "CSV_MALFORMED", b'"1"x,b')]),
    (b"key,text\n1,ok,extra\n2\n", 99, [(None, None, 2, "CSV_FIELD_COUNT_MISMATCH", b"1,ok,extra"), (None, None, 3, "CSV_FIELD_COUNT_MISMATCH", b"2")]),
    (b"wrong,text\n1,ok\n", 99, [(None, None, 1, "CSV_HEADER_MISMATCH", b"wrong,text")]),
    (b"key,text\r\n1," + b"x" * 30 + b"\r\n", 32, [("1", "x" * 30, 2, None, b"1," + b"x" * 30)]),
    (b'key,text\n1,"' + b"x\n" * 20 + b'"\n2,b\n', 32, [(None, None, 2, "CSV_RECORD_TOO_LARGE", b'1,"' + b"x\n" * 20 + b'"'), ("2", "b", 3, None, b"2,b")]),
    (b'key,text\n"x,","y"",\r\n"\n"""a"""," b "', 99, [("x,", 'y",\r\n', 2, None, b'"x,","y"",\r\n"'), ('"a"', " b ", 3, None, b'"""a"""," b "')]),
]


@pytest.mark.parametrize("split", [5, 1 << 27])
def test_csv_records_have_their_bytes_in_whatever_splits(spark, tmp_path, split):
    for i, (body, _, _) in enumerate(BODIES):
        (tmp_path / f"{i}.csv").write_bytes(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        for most in (32, 99):
            found = {}
            for r in files.csv_records(spark, f"file://{tmp_path}", PAIR, most).orderBy("source_file", "source_row_number").collect():
                body = BODIES[i := int(r["source_file"].split("/")[-1][:-4])][0]
                found.setdefault(i, []).append((r["key"], r["text"], r["source_row_number"], r["error_code"], body[r["byte_start"] : r["byte_end"]]))
            wanted = {i: rows for i, (_, cap, rows) in enumerate(BODIES) if cap == most}
            assert {i: found[i] for i in wanted} == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_bad_record_fails_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(BODIES[2][0])
    with pytest.raises(Exception, match="CSV_ENCODING_INVALID at row 2"):
        files.read_csv(spark, str(tmp_path), PAIR).count()


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"product_category_name": "a"}\n')
    assert [tuple(r) for r in files.read_jsonl(spark, str(tmp_path), CONTRACTS["category_translation"]).collect()] == [("a", None)]


def test_snapshot_names_sizes_and_id(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"abc")
    (tmp_path / "b.csv").write_bytes(b"b")
    (tmp_path / "c.csv").write_bytes(b"")
    found = files.snapshot(spark, str(tmp_path))
    rows = {r["file_name"]: (r["n_bytes"], r["sha256"][:8]) for r in found.collect()}
    assert rows == {"a.csv": (3, "ba7816bf"), "b.csv": (1, "3e23e816")}
    first = files.release_id(found).first()
    (tmp_path / "b.csv").write_bytes(b"1")
    assert first["n_files"] == 2 and files.release_id(files.snapshot(spark, str(tmp_path))).first()[0] != first[0]
    assert {tuple(r) for r in files.file_set_issues(found, ["a.csv", "c.csv"]).collect()} == {("b.csv", "UNEXPECTED"), ("c.csv", "MISSING")}


def test_releases_are_new_replays_or_conflicts(spark):
    columns = "source_release_id string, file_name string, n_bytes long, sha256 string"
    known = spark.createDataFrame([("a", "x", 1, "h"), ("a", "y", 2, None), ("b", "x", 1, "h"), ("c", "x", 1, "h"), ("c", "z", 1, "h"), ("other", "x", 1, "h")], columns)
    new = spark.createDataFrame([("a", "x", 1, "h"), ("a", "y", 2, None), ("b", "x", 1, "i"), ("c", "x", 1, "h"), ("d", "x", 1, "h")], columns)
    assert {tuple(r) for r in files.classify_releases(known, new).collect()} == {("a", "REPLAY"), ("b", "CONFLICT"), ("c", "CONFLICT"), ("d", "NEW_CANDIDATE")}
    assert files.classify_releases(known, new.limit(0)).isEmpty()


def test_create_only(spark, tmp_path):
    df = spark.range(10)
    assert [release.create_only(x, f"{tmp_path}/t") for x in (df, df.repartition(3))] == ["LOADED", "REPLAY"]
    with pytest.raises(release.Conflict):
        release.create_only(spark.range(11), f"{tmp_path}/t")


def test_ledger_takes_each_key_once(spark, tmp_path):
    at = f"{tmp_path}/ledger"
    release.append_ledger(spark.range(3), at, "id")
    release.append_ledger(spark.range(1, 5).union(spark.range(1, 5)), at, "id")
    assert sorted(r[0] for r in spark.read.parquet(at).collect()) == [0, 1, 2, 3, 4]


def test_pointer_moves_only_from_the_expected_version(spark, tmp_path):
    r = release.Releases(spark, f"file://{tmp_path}")
    for name, n in (("a", 1), ("b", 2)):
        r.build(name, {"m": spark.range(n)})
    assert r.active() is None and r.activate("a", 0) == 1 and r.activate("b", 1) == 2
    assert r.resolve("m")["m"].count() == 2
    for bad in (lambda: r.activate("a", 1), lambda: r.activate("none", 2)):
        with pytest.raises(release.Conflict):
            bad()
    assert r.rollback(2) == 3 and r.active() == "a" and r.resolve("m")["m"].count() == 1
    assert [tuple(x) for x in r.differences("a", "b").collect()] == [("m", "ROW_COUNT")]
    assert r.activate(None, 3) == 4 and r.active() is None


def test_freshness(spark):
    at = lambda *days: spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("timestamp_ntz").alias("ingested_at"))
    now = F.lit("2024-03-01").cast("timestamp_ntz")
    assert [release.freshness(at(*d), now=now).first()["status"] for d in (["2024-02-20", "2020-01-01"], ["2024-01-20"], ["2023-01-01"], [])] == ["PASS", "WARN", "ERROR", "ERROR"]
