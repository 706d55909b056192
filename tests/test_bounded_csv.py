"""Files read in byte ranges: places, faults that end a file, bounded memory; and what becomes of their records."""

import csv
import io
import json
import random
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kelpline.functions.identities import record_id
from kelpline.operators import ingest
from kelpline.operators.validate import CONTRACTS, canonical_hash, validate
from kelpline.sinks.release import kept_in
from kelpline.sources import bounded_csv as B
from kelpline.sources import stores
from tests.test_files_and_releases import BODIES, PAIR

NAMES = ["key", "text"]


def _one_pass(body: bytes, most: int) -> list[tuple]:
    """All records by a plain reader, byte for byte, and the fault that ends the file."""
    if not body:
        return [(None, B.EMPTY)]
    out, row, start, at, quotes = [], 1, 0, 0, 0

    def record(end: int):
        raw = body[start:end]
        raw = raw[:-1] if at < len(body) and raw.endswith(b"\r") else raw
        if len(raw) > most:
            return B.LARGE, raw
        try:
            text = raw.decode("utf-8-sig" if row == 1 else "utf-8")
        except UnicodeDecodeError:
            return B.ENCODING, raw
        try:
            rows = list(csv.reader(io.StringIO(text, newline=""), strict=True))
        except csv.Error:
            return B.MALFORMED, raw
        if len(rows) != 1:
            return B.MALFORMED, raw
        if row == 1:
            return (None if rows[0] == NAMES else B.HEADER), raw
        return (None, raw, *rows[0]) if len(rows[0]) == len(NAMES) else (B.FIELDS, raw)

    while at <= len(body):
        if at == len(body):
            if start == at:
                return out
            held = body[start:]
            code = B.LARGE if len(held) > most + (held.endswith(b"\r") and quotes % 2 == 0) else B.MALFORMED if quotes % 2 else B.LARGE if len(held) > most else None
            found = (code, held) if code else record(at)
        elif body[at] == 0x0A and quotes % 2 == 0:
            found = record(at)
        else:
            quotes += body[at] == 0x22
            at += 1
            held = body[start:at]
            if len(held) > most + (held.endswith(b"\r") and quotes % 2 == 0):
                return [*out, (row, B.LARGE)]
            continue
        if found[0]:
            return [*out, (row, found[0])]
        if row > 1:
            out.append((row, start, start + len(found[1]), *found[2:]))
        row, at = row + 1, at + 1
        start = at
    return out


def _ranges(body: bytes, size: int) -> list[tuple]:
    """start, end, whether it begins in quotes, and the number of its first record."""
    out = []
    for start in range(0, len(body), size):
        before = body[: max(start - 1, 0)]
        quotes, opened = 0, 1 if start else 0
        for c in before:
            quotes += c == 0x22
            opened += c == 0x0A and quotes % 2 == 0
        out.append((start, min(start + size, len(body)), quotes % 2, opened + 1))
    return out


def _in_ranges(path: str, body: bytes, most: int, size: int, chunk: int) -> list[tuple]:
    rows, faults = [], []
    for start, end, inside, first in _ranges(body, size):
        try:
            for r, s, e, v in B.parsed(B.raw_records(path, len(body), start, end, inside, first, most, chunk), NAMES):
                rows.append((r, s, e, *v))
        except B.Fault as f:
            faults.append((f.row, f.code))
    cut = min(faults, default=None)
    return [r for r in rows if cut is None or r[0] < cut[0]] + ([cut] if cut else [])


PIECES = st.lists(st.sampled_from([b'"', b'""', b",", b"\n", b"\r\n", b"\r", b"a", b"1,b\n", b'"x\ny",z\n', b"\xff", "é".encode(), b"k,v", b"xxxxxxxxxxxxxxxxxxxx"]), max_size=14)


@settings(max_examples=400, deadline=None)
@given(PIECES, st.sampled_from([1, 2, 3, 7, 1000]), st.sampled_from([1, 3, 64]), st.sampled_from([8, 12, 99]))
def test_ranges_read_what_one_pass_reads(tmp_path_factory, pieces, size, chunk, most):
    body = b"key,text\n" + b"".join(pieces)
    at = tmp_path_factory.mktemp("one") / "a.csv"
    at.write_bytes(body)
    assert _in_ranges(str(at), body, most, size, chunk) == _one_pass(body, most)


@pytest.mark.parametrize("size", [1, 5, 1 << 20])
def test_spark_ranges(spark, tmp_path, size):
    rng = random.Random(size)
    bodies = [b for b, _, _ in BODIES] + [b"", b"key,text", b"key,text\n"]
    bodies += [b"key,text\n" + b"".join(rng.choice([b"1,b\n", b'"x\ny",z\n', b'"a""",\r\n', b"1,b\n", b"1\n" if i > 5 else b"2,\n"]) for i in range(12)) for _ in range(6)]
    for i, body in enumerate(bodies):
        (tmp_path / f"{i:02}.csv").write_bytes(body)
    found: dict = {i: [] for i in range(len(bodies))}
    got = B.until_fault(B.range_records(spark, f"file://{tmp_path}", PAIR, most_bytes=32, range_bytes=size, chunk=max(size // 2, 1)))
    for r in sorted(got.collect(), key=lambda r: (r.source_file, r.source_row_number or 0)):
        found[int(r.source_file[-6:-4])].append((r.source_row_number, r.error_code) if r.error_code else (r.source_row_number, r.byte_start, r.byte_end, r.key, r.text))
    assert found == {i: _one_pass(b, 32) for i, b in enumerate(bodies)}


def test_a_line_of_any_length_needs_no_more_than_the_cap(tmp_path):
    at, most = tmp_path / "a.csv", 1 << 20
    with at.open("wb") as f:
        f.write(b"key,text\n1,")
        for _ in range(64):
            f.write(b"x" * most)
        f.write(b"\n2,b\n")
    size = at.stat().st_size
    tracemalloc.start()
    with pytest.raises(B.Fault) as fault:
        list(B.parsed(B.raw_records(str(at), size, 0, size, 0, 1, most, 1 << 16), NAMES))
    _, peak = tracemalloc.get_traced_memory()
    # a range in the middle of the line holds nothing at all
    tracemalloc.reset_peak()
    assert list(B.raw_records(str(at), size, 20 * most, 21 * most, 0, 3, most, 1 << 16)) == []
    _, inside = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert (fault.value.code, fault.value.row) == (B.LARGE, 2) and peak < 5 * most and inside < 3 * most


def test_many_rows_stay_in_bounded_memory(tmp_path):
    at = tmp_path / "a.csv"
    at.write_bytes(b"key,text\n" + b"".join(f"{i:05},-23.5505\n".encode() for i in range(100_000)))
    tracemalloc.start()
    n = sum(1 for _ in B.parsed(B.raw_records(str(at), at.stat().st_size, 0, at.stat().st_size, 0, 1, 1024, 16_384), NAMES))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n == 100_000 and peak < 2_000_000


REVIEWS = CONTRACTS["order_reviews"]
HEAD = ",".join(f.name for f in REVIEWS.fields)
ROWS = [
    'review-1,order-1,5,Bom,"ótimo\nproduto",2018-01-01 00:00:00,2018-01-02 00:00:00', "review-2,order-2,9,,,2018-01-01 00:00:00,2018-01-02 00:00:00",
    'review-1,order-1,5,Bom,"ótimo\nproduto",2018-01-01 00:00:00,2018-01-02 00:00:00', "review-3,order-3,4,Bom,rápida,2018-02-01 00:00:00,2018-02-02 03:04:05",
]


def _process(spark, folder, history, **options):
    records = B.read(spark, f"file://{folder}", REVIEWS, kept_in(spark, f"file://{folder}/kept-{random.random()}"), pattern="in*.csv", **options)
    return ingest.processed(records, REVIEWS, history)


def _history(spark):
    old = spark.createDataFrame([("review-3", "order-3", "+4", "Bom", "rápida", "2018-02-01 00:00:00", "2018-02-02 03:04:05")], [f.name for f in REVIEWS.fields])
    return validate(old, REVIEWS).select(canonical_hash(REVIEWS).alias("record_hash"))  # another spelling of the same values


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_outcomes_of_a_file(spark, tmp_path, size):
    (tmp_path / "in.csv").write_text("\n".join([HEAD, *ROWS]) + "\n", encoding="utf-8")
    rows = _process(spark, tmp_path, _history(spark), range_bytes=size)
    (r,) = ingest.reports(rows).collect()
    assert (r.observed_rows, r.new_rows, r.replay_rows, r.duplicate_rows, r.rejected_rows, r.parse_failed_rows, r.file_failures, r.status) == (4, 1, 1, 1, 1, 0, 0, "QUARANTINED")
    assert [(x.review_score, x.review_comment_message) for x in ingest.raw_rows(rows, REVIEWS).collect()] == [(5, "ótimo\nproduto")]
    body = (tmp_path / "in.csv").read_bytes()
    bad = {x.source_row_number: x for x in ingest.quarantine_rows(rows, REVIEWS, F.lit("srcobj_1")).collect()}
    assert {n: (x.error_code, x.error_columns) for n, x in bad.items()} == {3: ("RANGE_INVALID", ["review_score"]), 4: ("DUPLICATE_RECORD", ["review_id", "order_id"])}
    x = bad[4]
    assert body[x.byte_start : x.byte_end].decode() == ROWS[2] and x.raw_reference == f"srcobj_1#bytes={x.byte_start}:{x.byte_end}"
    assert json.loads(x.raw_payload)["review_comment_message"] == "ótimo\nproduto" and list(json.loads(x.raw_payload)) == sorted(f.name for f in REVIEWS.fields)
    assert spark.range(1).select(record_id(F.lit("srcobj_1"), F.lit(4), F.lit(x.byte_start), F.lit(x.byte_end))).first()[0] == x.record_id


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_rows_behind_a_fault_are_not_observed(spark, tmp_path, size):
    (tmp_path / "in1.csv").write_text("\n".join([HEAD, ROWS[0], ROWS[3] + ",one more", ROWS[1]]))
    (tmp_path / "in2.csv").write_text("\n".join(["other", ROWS[0]]))
    (tmp_path / "in3.csv").write_text("")
    (tmp_path / "in4.csv").write_text(HEAD)
    rows = _process(spark, tmp_path, _history(spark).limit(0), range_bytes=size)
    found = {x.source_file[-7:-4]: (x.observed_rows, x.new_rows, x.parse_failed_rows, x.file_failures, x.status) for x in ingest.reports(rows).collect()}
    # a file of a header only has no records, and so no report
    assert found == {"in1": (2, 1, 1, 1, "QUARANTINED"), "in2": (0, 0, 0, 1, "QUARANTINED"), "in3": (0, 0, 0, 1, "QUARANTINED")}
    faults = {(x.source_file[-7:-4], x.error_code, x.raw_reference, x.record_id) for x in ingest.quarantine_rows(rows, REVIEWS, F.lit("o")).collect()}
    assert faults == {("in1", B.FIELDS, "o#row=3", None), ("in2", B.HEADER, "o#row=1", None), ("in3", B.EMPTY, "o#row=0", None)}


def test_identities_of_files(spark, tmp_path):
    import hashlib

    big = b"x" * (stores.HEADER_BYTES + 1) + b"\n"
    for name, body in (("a.csv", b"\xef\xbb\xbfkey,text\r\n1,2\n"), ("b.csv", b""), ("c.csv", big), ("d.csv", b"\xff\n"), ("sub/e.csv", b'"k\ney",x\n')):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    (tmp_path / "link.csv").symlink_to(tmp_path / "a.csv")
    (tmp_path / "_hidden.csv").write_bytes(b"h")
    rows = {r.file_name: r for r in stores.identities(spark, f"file://{tmp_path}").collect()}
    assert {n: (r.n_bytes, r.header, r.linked) for n, r in rows.items()} == {
        "a.csv": (17, NAMES, False), "b.csv": (0, None, False), "c.csv": (len(big), None, False), "d.csv": (2, None, False), "e.csv": (9, ["k"], False), "link.csv": (0, None, True),
    }
    assert rows["c.csv"].sha256 == hashlib.sha256(big).hexdigest() and rows["link.csv"].sha256 is None
    assert stores.identities(spark, f"file://{tmp_path}", "none*").count() == 0


def test_a_digest_needs_a_chunk_of_memory(tmp_path):
    at = tmp_path / "big"
    with at.open("wb") as f:
        f.truncate(200 << 20)
    reader = stores._Identities({"path": str(at)})
    tracemalloc.start()
    (row,) = list(reader.read(stores._File(str(at), 200 << 20)))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert row[2] == 200 << 20 and row[5] is None and peak < 4 * stores.CHUNK
