"""What the operators of this folder share: the shared folder, saved tables, and checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a few dozen bytes that may be broadcast; more take a shuffled join.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.

    Only a local session, as in tests, gets one of its own.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:///tmp/checkpoints"


_MADE: ContextVar[list | None] = ContextVar("made", default=None)


class Scratch:
    """A new folder below the shared one. Tables saved there cut the lineage and survive lost executors.

    As a context manager it is deleted if the block fails. What a result still reads is deleted when the session's
    file system is closed at the driver's end, or by the end of a cleared() block.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        fs, p = self._fs(self.path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        if (made := _MADE.get()) is not None:
            made.append(self)

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            self.clear()

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        at = f"{self.path}/{self.n}"
        df.write.parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._kept_at = at
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete saved tables that nothing reads any more."""
        for t in tables:
            fs, p = self._fs(t._kept_at)
            fs.delete(p, True)

    def clear(self) -> None:
        fs, p = self._fs(self.path)
        fs.delete(p, True)


@contextmanager
def cleared() -> Iterator[None]:
    """Folders made inside are deleted at the end: for work whose result has been saved elsewhere."""
    made: list[Scratch] = []
    before = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(before)
        for s in made:
            s.clear()


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A saved table with a hint to broadcast it if a count finds at most `limit` rows; else as it is."""
    if df.count() > limit:
        return df
    out = F.broadcast(df)
    out._kept_at = getattr(df, "_kept_at", None)
    return out


def row_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def free(df: DataFrame, name: str) -> str:
    """`name`, if no column is called so, in any case of letters; else an error, as a result would hide or double what is there."""
    if unused(df, name) != name:
        raise ValueError(f"there is a column {name!r}: give the result another name")
    return name


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """Parts of a string column of about `most` bytes each; a longer text is a part of its own.

    After the last, what Arrow's pool holds of earlier batches goes back to the system, as idle workers would keep it.
    """
    lengths = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    sizes = pc.fill_null(pc.binary_length(lengths), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, x in enumerate(sizes):
        if i > start and size + x > most:
            yield column.slice(start, i - start)
            start, size = i, 0
        size += int(x)
    if start < len(column):
        yield column.slice(start)
    pa.default_memory_pool().release_unused()
