"""Sinks: create-only Parquet partitions, quarantine, append-only ledgers, and released versions of the models."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kelpline.operators.relational import append_unseen, compare_fingerprints, fingerprint


class Conflict(RuntimeError):
    """What is there differs from what was to be written."""


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; a local session without it gets one in /tmp."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file:///tmp/kelpline"
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def kept_in(spark: SparkSession, folder: str):
    """A function that writes a frame below the folder under its name and returns it as read back. The folder goes with the driver."""
    fs, p = _fs(spark, folder)
    fs.mkdirs(p)
    fs.deleteOnExit(p)

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return keep


def file_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Length and time of change of a file or folder; (0, 0) if there is none."""
    fs, p = _fs(spark, path)
    return (fs.getContentSummary(p).getLength(), fs.getFileStatus(p).getModificationTime()) if fs.exists(p) else (0, 0)


def create_only(df: DataFrame, path: str) -> str:
    """Write df unless the path holds a finished table: LOADED, REPLAY if that has the same rows, else Conflict.

    Parquet's committer puts _SUCCESS last; a folder without it is a write that was cut off, and is written anew.
    """
    spark = df.sparkSession
    if exists(spark, f"{path}/_SUCCESS"):
        if compare_fingerprints(fingerprint(df, "x"), fingerprint(spark.read.schema(df.schema).parquet(path), "x")).isEmpty():
            return "REPLAY"
        raise Conflict(f"{path} holds other rows")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return "LOADED"


def raw_path(base: str, dataset: str, release: str, batch: str) -> str:
    return f"{base}/raw/{dataset}/source_release_id={release}/batch_id={batch}"


def write_raw(df: DataFrame, base: str, dataset: str, release: str, batch: str) -> str:
    """One batch of accepted rows; readers prune to a release and a batch by the folder's names."""
    return create_only(df, raw_path(base, dataset, release, batch))


def write_quarantine(df: DataFrame, base: str, dataset: str, batch: str) -> None:
    """Rejected rows, in folders by error_code; writing the same batch again replaces it."""
    df.write.mode("overwrite").partitionBy("error_code").parquet(f"{base}/quarantine/{dataset}/batch_id={batch}")


def append_ledger(new: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the ledger lacks. For one writer at a time."""
    spark = new.sparkSession
    if exists(spark, path):
        new = append_unseen(spark.read.schema(new.schema).parquet(path), new, key)
    else:
        new = new.dropDuplicates([key])
    new.write.mode("append").parquet(path)


class Releases:
    """Candidates of all models, and a versioned pointer to the one that is active.

    base/candidates/<id>/<model> holds tables, base/pointer/<version>.json what was active since when.
    A pointer's version is a file that only one writer can create, so that two activations that expect the same version
    can't both win. (On stores without atomic create, run one activation at a time.)
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def build(self, candidate: str, models: dict[str, DataFrame]) -> DataFrame:
        """Write all models of a candidate; relation, row_count and content_hash of each as written."""
        out = None
        for name, df in models.items():
            create_only(df, f"{self.base}/candidates/{candidate}/{name}")
            f = fingerprint(self.spark.read.schema(df.schema).parquet(f"{self.base}/candidates/{candidate}/{name}"), name)
            out = f if out is None else out.unionByName(f)
        create_only(out, f"{self.base}/candidates/{candidate}/_manifest")
        return self.manifest(candidate)

    def manifest(self, candidate: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/candidates/{candidate}/_manifest")

    def version(self) -> int:
        """The pointer's version; 0: nothing is active."""
        fs, p = _fs(self.spark, f"{self.base}/pointer")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json")), default=0)

    def _pointer(self, version: int) -> str:
        return f"{self.base}/pointer/{version:09d}.json"

    def active(self) -> str | None:
        """The active candidate, or None."""
        version = self.version()
        return self.at(version) if version else None

    def at(self, version: int) -> str | None:
        return json.loads(self.spark.read.text(self._pointer(version), wholetext=True).first()[0])["candidate"]

    def activate(self, candidate: str | None, expected: int) -> int:
        """Make a built candidate (None: none) active if the pointer is still at `expected`; the new version."""
        if candidate is not None and not exists(self.spark, f"{self.base}/candidates/{candidate}/_manifest/_SUCCESS"):
            raise Conflict(f"{candidate} is not built")
        if candidate is not None and candidate in self.invalid():
            raise Conflict(f"{candidate} is invalid")
        if self.version() != expected:
            raise Conflict(f"the pointer is at {self.version()}, not {expected}")
        fs, p = _fs(self.spark, self._pointer(expected + 1))
        try:
            out = fs.create(p, False)
        except Exception as e:
            raise Conflict(f"version {expected + 1} was taken") from e
        out.write(bytearray(json.dumps({"candidate": candidate}).encode()))
        out.close()
        return expected + 1

    def rollback(self, expected: int) -> int:
        """Activate what was active before the pointer's present version."""
        if expected < 2:
            raise Conflict("nothing was active before")
        return self.activate(self.at(expected - 1), expected)

    def invalid(self) -> set[str]:
        """Candidates that may not be activated any more."""
        fs, p = _fs(self.spark, f"{self.base}/invalid")
        return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()

    def invalidate(self, candidate: str, expected: int) -> int:
        """Mark a candidate for good, and revoke the pointer if it is active; the pointer's version."""
        fs, p = _fs(self.spark, f"{self.base}/invalid/{candidate}")
        fs.create(p, True).close()
        return self.activate(None, expected) if self.active() == candidate else self.version()

    def resolve(self, *names: str) -> dict[str, DataFrame]:
        """Models of one release: the pointer is read once, so that all are of the same candidate."""
        candidate = self.active()
        if candidate is None:
            raise Conflict("nothing is active")
        return {n: self.spark.read.parquet(f"{self.base}/candidates/{candidate}/{n}") for n in names}

    def differences(self, a: str, b: str) -> DataFrame:
        """Relations that two candidates don't have alike: a full build against a replay."""
        return compare_fingerprints(self.manifest(a), self.manifest(b))


def activation_eligibility(definitions: DataFrame, expected: DataFrame, refs: DataFrame, events: DataFrame) -> DataFrame:
    """For each release: object_ref_count, how many of the expected relations it refers to, how many of these passed their
    last test, and whether it may be activated.

    definitions: release_id and candidate of each layer as layer and candidate_id; expected: layer and name; refs: release_id,
    layer, name, object; events: candidate_id, layer, object, state, event_at and event_id. expected has some dozens of rows.
    """
    w = Window.partitionBy("candidate_id", "layer", "object").orderBy(F.col("event_at").desc(), F.col("event_id").desc())
    last = events.withColumn("nth", F.row_number().over(w)).where("nth = 1").select("candidate_id", "layer", "object", "state")
    wanted = definitions.join(F.broadcast(expected), "layer")
    found = wanted.join(refs, ["release_id", "layer", "name"], "left").join(last, ["candidate_id", "layer", "object"], "left")
    counts = found.groupBy("release_id").agg(F.count("*").alias("expected"), F.count("object").alias("matched_count"), F.count_if(F.col("state") == "TEST_PASSED").alias("passed_count"))
    all_refs = refs.groupBy("release_id").agg(F.count("*").alias("object_ref_count"))
    out = counts.join(all_refs, "release_id", "left").withColumn("object_ref_count", F.coalesce("object_ref_count", F.lit(0).cast("bigint")))
    n = F.col("expected")
    return out.select("release_id", "object_ref_count", "matched_count", "passed_count", ((F.col("object_ref_count") == n) & (F.col("matched_count") == n) & (F.col("passed_count") == n)).alias("eligible"))


def freshness(df: DataFrame, warn_days: int = 30, error_days: int = 90, now=None) -> DataFrame:
    """One row: the last ingested_at and PASS, WARN or ERROR by its age; a table without rows is an ERROR."""
    now = F.current_timestamp() if now is None else now
    age = F.timestamp_diff("DAY", F.col("last_ingested_at"), now.cast("timestamp_ntz"))
    status = F.when(age.isNull() | (age >= error_days), "ERROR").when(age >= warn_days, "WARN").otherwise("PASS")
    return df.agg(F.max("ingested_at").alias("last_ingested_at")).withColumn("status", status)
