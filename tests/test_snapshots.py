"""Snapshots of files: what a discovery says of each, and commits that are cut off, repeated or in conflict."""

import hashlib
import json

import pytest

from kelpline.sources import snapshots as S
from kelpline.sources import stores

HEAD = b"key,text\n"
CONTRACT = S.Contract({f"{n}.csv": ["key", "text"] for n in "abc"})


def _manifest(files: dict[str, bytes], /, **other) -> bytes:
    said = [{"filename": n, "rows": max(b.count(b"\n") - 1, 0), "bytes": len(b), "sha256": hashlib.sha256(b).hexdigest()} for n, b in files.items()]
    return json.dumps({"schema_version": "1", "manifest_version": "manifest-v1", "contract_version": "source-v1", "data_class": "public", "source": "s", "source_contract": "commerce", "seed": 1, "files": said} | other).encode()


@pytest.fixture
def good(tmp_path):
    files = {f"{n}.csv": HEAD + f"1,{n}\n".encode() * i for i, n in enumerate("abc", 1)}
    at = tmp_path / "in"
    at.mkdir()
    for n, b in files.items():
        (at / n).write_bytes(b)
    (at / S.MANIFEST).write_bytes(_manifest(files))
    return at, files


def _codes(spark, at, contract=CONTRACT):
    return {r.file_name: r.code for r in S.discovered(spark, f"file://{at}", contract).collect()}


def test_a_good_snapshot(spark, good):
    at, files = good
    found = S.accepted(S.discovered(spark, f"file://{at}", CONTRACT))
    assert {r.file_name: (r.n_bytes, r.sha256, r.declared_rows) for r in found.collect()} == {n: (len(b), hashlib.sha256(b).hexdigest(), b.count(b"\n") - 1) for n, b in files.items()}
    text = json.dumps([{"bytes": len(b), "file_name": n, "sha256": hashlib.sha256(b).hexdigest()} for n, b in sorted(files.items())], separators=(",", ":"), sort_keys=True)
    assert S.release_id(found).first()["source_release_id"] == "release_" + hashlib.sha256(text.encode()).hexdigest()


def test_every_fault_of_a_file(spark, good):
    at, files = good
    cases = [
        (lambda: (at / "a.csv").write_bytes(files["a.csv"] + b"x"), {"a.csv": S.SIZE}), (lambda: (at / "a.csv").write_bytes(files["a.csv"].replace(b"1", b"2")), {"a.csv": S.CHECKSUM}),
        (lambda: (at / "b.csv").unlink(), {"b.csv": S.MISSING}), (lambda: (at / "d.csv").write_bytes(b"x"), {"d.csv": S.EXTRA}),
        (lambda: ((at / "sub").mkdir(), (at / "sub" / "a.csv").write_bytes(b"x")), {"sub/a.csv": S.EXTRA}), (lambda: ((at / "c.csv").unlink(), (at / "c.csv").symlink_to(at / "a.csv")), {"c.csv": S.UNSAFE}),
    ]
    for fault, codes in cases:
        fault()
        assert {n: c for n, c in _codes(spark, at).items() if c} == codes
        with pytest.raises(S.SnapshotError) as e:
            S.accepted(S.discovered(spark, f"file://{at}", CONTRACT))
        assert [(e.value.file_name, e.value.code)] == list(codes.items())
        for p in (at / "d.csv", at / "sub" / "a.csv", at / "c.csv"):
            p.unlink(missing_ok=True)
        if (at / "sub").exists():
            (at / "sub").rmdir()
        for n, b in files.items():
            (at / n).write_bytes(b)
    for body, code in ((b"other,text\n", S.HEADER), (b"no line end", S.NO_HEADER), (b"\xff\n", S.NO_HEADER), (b"x" * stores.HEADER_BYTES + b"\n", S.HEADER), (b"x" * (stores.HEADER_BYTES + 1) + b"\n", S.NO_HEADER)):
        (at / "a.csv").write_bytes(body)
        (at / S.MANIFEST).write_bytes(_manifest(files | {"a.csv": body}))
        assert _codes(spark, at)["a.csv"] == code
    (at / S.MANIFEST).write_bytes(_manifest({n: files[n] for n in ("b.csv", "c.csv")} | {"z.csv": b"x\n"}))
    assert _codes(spark, at) == {"a.csv": S.SET, "b.csv": None, "c.csv": None, "z.csv": S.SET}


@pytest.mark.parametrize(
    ("text", "code"),
    [
        (b"{", S.INVALID), (b"[]", S.INVALID), (b"\xff", S.INVALID), (b'{"files": [1]}', S.INVALID), (_manifest({"a.csv": b"x"}, extra=1), S.INVALID), (_manifest({"A.csv": b"x"}), S.INVALID), (_manifest({"a.csv": b""}), S.INVALID),
        (_manifest({}, contract_version="source-v2"), S.INVALID), (_manifest({}, source=None), S.INVALID), (_manifest({}, seed="1"), S.INVALID), (b" " * (S.MANIFEST_BYTES + 1), S.INVALID),
        (_manifest({}, files=[{"filename": "a.csv"}, {"filename": "a.csv"}]), S.TWICE), (_manifest({"a.csv": b"x"}).replace(b'"rows": 0', b'"rows": true'), S.INVALID),
    ],
)
def test_manifests_that_are_refused(text, code):
    with pytest.raises(S.SnapshotError) as e:
        S.manifest_of(text, CONTRACT)
    assert e.value.code == code


def test_no_manifest(spark, tmp_path):
    with pytest.raises(S.SnapshotError, match=S.NO_MANIFEST):
        S.discovered(spark, f"file://{tmp_path}", CONTRACT)
    with pytest.raises(S.SnapshotError, match=S.NO_MANIFEST):
        S.committed(spark, f"file://{tmp_path}", "r1")


def test_a_commit_that_was_cut_off_goes_on(spark, good, tmp_path):
    at, files = good
    base = f"file://{tmp_path}/base"
    found = stores.identities(spark, f"file://{at}", "*.csv")
    S.copied(found.where("file_name = 'b.csv'"), f"{base}/source/r1").collect()  # killed here
    with pytest.raises(S.SnapshotError, match=S.NO_MANIFEST):
        S.committed(spark, base, "r1")
    first = (tmp_path / "base/source/r1/b.csv").stat().st_mtime_ns
    assert S.commit(found, base, "r1") == {"UPLOADED": 3, "REPLAYED": 1} and (tmp_path / "base/source/r1/b.csv").stat().st_mtime_ns == first
    assert S.commit(found, base, "r1") == {"UPLOADED": 0, "REPLAYED": 4}
    assert {r.file_name for r in S.committed(spark, base, "r1").collect()} == set(files) and not list((tmp_path / "base/source").rglob(".*[0-9a-f]"))


def test_commits_that_conflict(spark, good, tmp_path):
    at, _ = good
    base = f"file://{tmp_path}/base"
    found = stores.identities(spark, f"file://{at}", "*.csv")
    with pytest.raises(S.SnapshotError, match="DUPLICATE_FILE_NAME:a.csv"):
        S.commit(found.unionByName(found.where("file_name = 'a.csv'")), base, "r1")
    S.commit(found, base, "r1")
    with pytest.raises(S.SnapshotError, match="MANIFEST_CONFLICT"):
        S.commit(found.where("file_name <> 'a.csv'"), base, "r1")
    (at / "a.csv").write_bytes(b"other")
    with pytest.raises(S.SnapshotError, match="OBJECT_CONFLICT:a.csv"):
        S.commit(stores.identities(spark, f"file://{at}", "*.csv"), base, "r1")
    stale = spark.createDataFrame([(f"file://{at}/a.csv", "new.csv", 5, "0" * 64)], "path string, file_name string, n_bytes bigint, sha256 string")
    with pytest.raises(S.SnapshotError, match="INTEGRITY_FAILED:new.csv"):
        S.commit(stale, base, "r2")
    assert not (tmp_path / "base/manifests/r2.json").exists() and not list((tmp_path / "base/source/r2").glob("*"))
    (tmp_path / "base/source/r1/b.csv").write_bytes(b"changed")
    with pytest.raises(Exception, match="SOURCE_INTEGRITY_FAILED:b.csv"):
        S.committed(spark, base, "r1").collect()
