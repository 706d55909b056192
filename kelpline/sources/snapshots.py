"""Snapshots of source files: discovered against a completion manifest, and committed file by file with the manifest last.

Digests, headers and copies are made on executors in chunks. The driver handles names and the manifest, which is at most 1 MiB.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.sources import stores

MANIFEST = "manifest.json"
MANIFEST_BYTES = 1 << 20
# The codes of a discovery, in the order in which they are found.
UNSAFE, NO_MANIFEST, MISSING, EXTRA, INVALID, TWICE, SET, SIZE, CHECKSUM, NO_HEADER, HEADER = (
    "UNSAFE_SOURCE_ENTRY", "COMPLETION_MANIFEST_MISSING", "MISSING_REQUIRED_FILE", "EXTRA_SOURCE_ENTRY", "COMPLETION_MANIFEST_INVALID", "DUPLICATE_MANIFEST_FILE", "MANIFEST_FILE_SET_MISMATCH",
    "FILE_SIZE_MISMATCH", "FILE_CHECKSUM_MISMATCH", "HEADER_INVALID", "HEADER_MISMATCH",
)
_FILE = {"filename": r"[a-z0-9_]+\.csv", "sha256": r"[0-9a-f]{64}"}
_TEXTS = ("schema_version", "manifest_version", "contract_version", "data_class", "source", "source_contract")
DECLARED = "file_name string, declared_rows bigint, declared_bytes bigint, declared_sha256 string"


class SnapshotError(RuntimeError):
    """A code, and the file it is about."""

    def __init__(self, code: str, file_name: str | None = None):
        super().__init__(f"{code}:{file_name}" if file_name else code)
        self.code, self.file_name = code, file_name


@dataclass(frozen=True)
class Contract:
    """The files of a snapshot with their headers, and what its manifest has to say of itself."""

    headers: dict[str, list[str]]
    contract_version: str = "source-v1"
    manifest_version: str = "manifest-v1"
    source_contract: str = "commerce"


def _head(path: str, most: int) -> bytes | None:
    """At most so many bytes and one more of a file; null if there is none."""
    try:
        return b"".join(stores.chunks(path, 0, most + 1))
    except FileNotFoundError:
        return None


def manifest_of(text: bytes, contract: Contract) -> list[tuple]:
    """file name, rows, bytes and digest of each file that a completion manifest declares."""
    if len(text) > MANIFEST_BYTES:
        raise SnapshotError(INVALID)
    try:
        found = json.loads(text)
    except ValueError:
        raise SnapshotError(INVALID) from None
    if not isinstance(found, dict) or not isinstance(found.get("files"), list) or not all(isinstance(f, dict) for f in found["files"]):
        raise SnapshotError(INVALID)
    files = found["files"]
    names = [f.get("filename") for f in files]
    if any(n in names[:i] for i, n in enumerate(names)):
        raise SnapshotError(TWICE)
    whole = lambda x, least: isinstance(x, int) and not isinstance(x, bool) and x >= least
    good = set(found) - {"seed"} == {*_TEXTS, "files"} and all(isinstance(found[k], str) for k in _TEXTS) and (found.get("seed") is None or whole(found["seed"], -(1 << 63)))
    for f in files:
        good = good and set(f) == {*_FILE, "rows", "bytes"} and all(isinstance(f[k], str) and re.fullmatch(p, f[k]) for k, p in _FILE.items()) and whole(f["rows"], 0) and whole(f["bytes"], 1)
    if not good or any(found[k] != getattr(contract, k) for k in ("contract_version", "manifest_version", "source_contract")):
        raise SnapshotError(INVALID)
    return [(f["filename"], f["rows"], f["bytes"], f["sha256"]) for f in files]


def _with_codes(found: DataFrame, declared: DataFrame, contract: Contract, names: Column) -> DataFrame:
    spark = found.sparkSession
    wanted = spark.createDataFrame([(n, h) for n, h in contract.headers.items()], "file_name string, expected array<string>")
    own = found.select(names.alias("file_name"), "n_bytes", "sha256", "linked", "header", F.lit(True).alias("found"))
    j = own.join(F.broadcast(wanted.withColumn("wanted", F.lit(True))), "file_name", "full").join(F.broadcast(declared.withColumn("declared", F.lit(True))), "file_name", "full")
    c = F.col
    code = (
        F.when(c("linked"), UNSAFE).when(c("wanted") & c("found").isNull(), MISSING).when(c("found") & c("wanted").isNull(), EXTRA).when(c("wanted").isNull() | c("declared").isNull(), SET)
        .when(c("n_bytes") != c("declared_bytes"), SIZE).when(c("sha256") != c("declared_sha256"), CHECKSUM).when(c("header").isNull(), NO_HEADER).when(c("header") != c("expected"), HEADER)
    )
    return j.select("file_name", "n_bytes", "sha256", "declared_rows", code.alias("code"))


def discovered(spark: SparkSession, folder: str, contract: Contract) -> DataFrame:
    """file_name, n_bytes, sha256, declared_rows and code of every file found, wanted or declared; a null code: it is as declared.

    Each file has the first code that holds. A manifest that is missing, too large or of another form fails at once, as links beside it do not.
    Files of folders below are extra. Names that begin with a dot or underscore are not seen.
    """
    text = _head(f"{folder}/{MANIFEST}", MANIFEST_BYTES)
    if text is None:
        raise SnapshotError(NO_MANIFEST)
    if stores.is_link(f"{folder}/{MANIFEST}"):
        raise SnapshotError(UNSAFE)
    declared = spark.createDataFrame(manifest_of(text, contract), DECLARED)
    found = stores.identities(spark, folder)
    below = F.substring_index("path", f"{posixpath.basename(folder.rstrip('/'))}/", -1)
    return _with_codes(found.where(below != MANIFEST), declared, contract, below)


def accepted(found: DataFrame) -> DataFrame:
    """The files of a discovery, if all are as declared; else the first code, in the order of codes and names, as an error."""
    order = (UNSAFE, MISSING, EXTRA, SET, SIZE, CHECKSUM, NO_HEADER, HEADER)
    place = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(order) for x in (c, i)]), F.col("code"))
    worst = found.where("code is not null").agg(F.min(F.struct(place.alias("place"), "file_name", "code")).alias("w")).first()["w"]
    if worst is not None:
        raise SnapshotError(worst["code"], worst["file_name"])
    return found.drop("code")


def release_id(files: DataFrame, prefix: str = "release") -> DataFrame:
    """One row: the id of a release by the names, sizes and digests of its files, as sorted compact JSON."""
    one = F.struct("file_name", F.struct(F.col("n_bytes").alias("bytes"), "file_name", "sha256").alias("f"))
    text = F.to_json(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["f"]))
    return files.agg(F.concat(F.lit(f"{prefix}_"), F.sha2(text.cast("binary"), 256)).alias("source_release_id"), F.count("*").alias("n_files"))


_OUTCOME = T.StructType([T.StructField(n, k) for n, k in (("file_name", T.StringType()), ("n_bytes", T.LongType()), ("sha256", T.StringType()), ("outcome", T.StringType()))])


def _digest(path: str) -> tuple[int, str]:
    import hashlib

    h, n = hashlib.sha256(), 0
    for got in stores.chunks(path):
        h.update(got)
        n += len(got)
    return n, h.hexdigest()


def _copied(source: str, target: str, n_bytes: int, sha256: str) -> str:
    """UPLOADED, REPLAYED if the target has the same bytes, OBJECT_CONFLICT if others, INTEGRITY_FAILED if the copy or the source differs from what was to be copied.

    The copy is made under another name, read back, and then renamed: what bears the target's name is whole.
    """
    store, at = stores.store_of(target)
    if store.get_file_info(at).type.name == "File":
        return "REPLAYED" if _digest(target) == (n_bytes, sha256) else "OBJECT_CONFLICT"
    store.create_dir(posixpath.dirname(at), recursive=True)
    part = f"{posixpath.dirname(at)}/.{posixpath.basename(at)}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        for got in stores.chunks(source):
            out.write(got)
    if _digest(target[: len(target) - len(at)] + part) != (n_bytes, sha256):
        store.delete_file(part)
        return "INTEGRITY_FAILED"
    store.move(part, at)
    return "UPLOADED"


def copied(files: DataFrame, target: str) -> DataFrame:
    """Copy files (path, file_name, n_bytes, sha256) below `target`, each by a task of its own: file_name, n_bytes, sha256 and outcome.

    It copies as it is evaluated, and a file that is there is verified and not written: an evaluation cut off or repeated does no harm.
    """

    def copy(batches):
        for b in batches:
            rows = b.to_pylist()
            out = [(r["file_name"], r["n_bytes"], r["sha256"], _copied(r["path"], f"{target}/{r['file_name']}", r["n_bytes"], r["sha256"])) for r in rows]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()))], ["file_name", "n_bytes", "sha256", "outcome"])

    return files.select("path", "file_name", "n_bytes", "sha256").repartition(F.col("file_name")).mapInArrow(copy, _OUTCOME)


def commit(files: DataFrame, base: str, release: str) -> dict[str, int]:
    """Commit the files (path, file_name, n_bytes, sha256) of a release: base/source/<release>/<file>, and base/manifests/<release>.json last.

    How many were UPLOADED and how many REPLAYED, the manifest included. Repeated names, other bytes under a name, or another manifest under the id are errors,
    and leave no new manifest; a commit that was cut off goes on where it stopped.
    """
    spark = files.sparkSession
    rows = sorted(files.select("file_name", "path", "n_bytes", "sha256").collect())  # a row a file; so that digests are made once
    for a, b in zip(rows, rows[1:]):
        if a["file_name"] == b["file_name"]:
            raise SnapshotError("DUPLICATE_FILE_NAME", a["file_name"])
    listed = spark.createDataFrame(rows, "file_name string, path string, n_bytes bigint, sha256 string")
    done = sorted((r.file_name, r.n_bytes, r.sha256, r.outcome) for r in copied(listed, f"{base}/source/{release}").collect())
    for name, _, _, outcome in done:
        if outcome not in ("UPLOADED", "REPLAYED"):
            raise SnapshotError(f"SOURCE_UPLOAD_{outcome}", name)
    text = json.dumps({"source_release_id": release, "files": [{"file_name": n, "bytes": b, "sha256": s} for n, b, s, _ in done]}, sort_keys=True, indent=1).encode()
    outcome = put(spark, f"{base}/manifests/{release}.json", text)
    counts = {"UPLOADED": 0, "REPLAYED": 0}
    for *_, o in [*done, (None, None, None, outcome)]:
        counts[o] += 1
    return counts


def put(spark: SparkSession, path: str, text: bytes) -> str:
    """Create a small file as a whole, by a rename that doesn't overwrite; a file of other bytes is a conflict."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
        out = fs.create(part, False)
        out.write(bytearray(text))
        out.close()
        if not fs.exists(p) and fs.rename(part, p):
            return "UPLOADED"
        fs.delete(part, False)
    if _head(path, 64 * MANIFEST_BYTES) != text:
        raise SnapshotError("SOURCE_UPLOAD_MANIFEST_CONFLICT")
    return "REPLAYED"


def committed(spark: SparkSession, base: str, release: str) -> DataFrame:
    """path, file_name, n_bytes and sha256 of a release's files, checked against its manifest; a release without one is not there.

    A file that is missing, extra or other than the manifest says is an error as the frame is read.
    """
    text = _head(f"{base}/manifests/{release}.json", 64 * MANIFEST_BYTES)
    if text is None:
        raise SnapshotError(NO_MANIFEST)
    declared = spark.createDataFrame([(f["file_name"], f["bytes"], f["sha256"]) for f in json.loads(text)["files"]], "file_name string, bytes bigint, digest string")
    found = stores.identities(spark, f"{base}/source/{release}")
    j = found.select("path", "file_name", "n_bytes", "sha256").join(F.broadcast(declared), "file_name", "full")
    same = F.coalesce((F.col("n_bytes") == F.col("bytes")) & (F.col("sha256") == F.col("digest")), F.lit(False))
    path = F.when(same, F.col("path")).otherwise(F.raise_error(F.concat(F.lit("SOURCE_INTEGRITY_FAILED:"), "file_name")).cast("string"))
    return j.select(path.alias("path"), "file_name", "n_bytes", "sha256")
