"""CSV records of a contract from byte ranges: bounded memory whatever the lines, exact places, and a file ends at its first fault.

1. Each byte range counts its quotes and line ends (stores.FileRanges). Running sums over the ranges of a file tell whether
   a range begins inside quotes, and the number of its first record.
2. Each range reads the records that begin in it, in chunks, and a record that goes on beyond it to its end. It holds a record of at most the cap,
   a chunk, and the rows of one batch. It stops at its first fault.
3. The first fault of a file cuts off all its later rows, whichever range they were read in. To read nothing twice, what the ranges
   gave is kept in the caller's folder first.
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.operators.validate import Dataset
from kelpline.sources import stores

#: A record may have so many bytes, without its line end.
MOST_BYTES = 8 << 20
CHUNK = 1 << 18
RANGE_BYTES = 16 << 20
BATCH_ROWS, BATCH_BYTES = 10_000, 8 << 20

# Codes of faults that end a file.
EMPTY, HEADER, ENCODING, MALFORMED, FIELDS, LARGE = (
    "CSV_FILE_EMPTY", "CSV_HEADER_MISMATCH", "CSV_ENCODING_INVALID", "CSV_MALFORMED", "CSV_FIELD_COUNT_MISMATCH", "CSV_RECORD_TOO_LARGE",
)


class Fault(Exception):
    """A code, and the row it was met in."""

    def __init__(self, code: str, row: int | None, start: int | None = None):
        super().__init__(code)
        self.code, self.row, self.start = code, row, start


def _line_ends(got: bytes, inside: int) -> tuple[list[int], int]:
    """Places of line ends outside quotes, and whether the bytes end inside quotes."""
    x = np.frombuffer(got, np.uint8)
    state = (np.cumsum(x == 0x22) + inside) % 2
    return np.nonzero((x == 0x0A) & (state == 0))[0].tolist(), int(state[-1])


def raw_records(path: str, size: int, start: int, end: int, inside: int, row: int, most: int, chunk: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Row, half-open place and bytes of the records that begin in a range; `inside`: whether the byte before it, or the file's first, is in quotes.

    `row` is the number of the first of them.
    """
    at = max(start - 1, 0)
    opened = 0 if start == 0 else None  # where the present record begins; None: it began in an earlier range
    held = bytearray()
    for got in stores.chunks(path, at, None, chunk):
        ends, inside = _line_ends(got, inside)
        done = 0
        for k in ends:
            if opened is not None:
                held += got[done:k]
                cut = held.endswith(b"\r")
                if len(held) - cut > most:
                    raise Fault(LARGE, row, opened)
                yield row, opened, opened + len(held) - cut, bytes(held[: len(held) - cut])
                row += 1
            held.clear()
            opened, done = at + k + 1, k + 1
            if opened >= end:
                return
        if opened is not None:
            held += got[done:]
            if len(held) > most + 1 or (len(held) == most + 1 and (inside or held[-1] != 0x0D)):
                raise Fault(LARGE, row, opened)
        at += len(got)
        if opened is None and at >= end:
            return
    if opened is not None and opened < size:
        if inside:
            raise Fault(MALFORMED, row, opened)
        if len(held) > most:
            raise Fault(LARGE, row, opened)
        yield row, opened, size, bytes(held)


def _decoded(raw: bytes, row: int, start: int) -> str:
    try:
        return raw.decode("utf-8-sig" if row == 1 else "utf-8")
    except UnicodeDecodeError:
        raise Fault(ENCODING, row, start) from None


def parsed(records: Iterator[tuple[int, int, int, bytes]], names: list[str], lenient: bool = False) -> Iterator[tuple[int, int, int, list[str | None]]]:
    """The values of raw records; the header is checked and left out. A Fault ends it.

    lenient: empty records are passed over, missing fields are null, and what is beyond the names is left out.
    """
    taken: list = []
    left = 0  # lines of the record that the reader hasn't asked for

    def texts():
        nonlocal left
        for row, start, end, raw in records:
            text = _decoded(raw, row, start)
            taken.append((row, start, end, raw))
            lines = list(io.StringIO(text, newline="")) if "\r" in text else [text]
            for left in range(len(lines) - 1, -1, -1):
                yield lines[len(lines) - 1 - left]

    reader = csv.reader(texts(), strict=True)
    while True:
        taken.clear()
        try:
            values = next(reader)
        except StopIteration:
            return
        except (Fault, csv.Error):
            if not taken:
                raise
            raise Fault(MALFORMED, *taken[0][:2]) from None
        row, start, end, raw = taken[0]
        # an empty record, several rows in one, or one that opens a field without closing it, so that the reader went on to the next
        if len(taken) > 1 or left or not raw and not lenient:
            raise Fault(MALFORMED, row, start)
        if lenient and row > 1:
            values = [*values, *[None] * (len(names) - len(values))][: len(names)] if values else None
            if values is None:
                continue
        if row == 1:
            if values != names:
                raise Fault(HEADER, row, start)
        elif len(values) != len(names):
            raise Fault(FIELDS, row, start)
        else:
            yield row, start, end, values


def _with_state(ranges: DataFrame) -> DataFrame:
    """`inside` and `row` of each range, from the ranges of its file before it."""
    w = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    quoted = ranges.withColumn("inside", F.coalesce(F.sum("quotes").over(w), zero) % 2)
    opens = F.when(F.col("inside") == 0, F.col("even_ends")).otherwise(F.col("odd_ends"))
    # the first range has the file's first record besides those behind line ends
    opens = opens + (F.col("start") == 0).cast("bigint")
    return quoted.withColumn("opens", opens).withColumn("row", F.coalesce(F.sum("opens").over(w), zero) + 1)


def range_records(spark: SparkSession, folder: str, dataset: Dataset, pattern: str = "*.csv", most_bytes: int = MOST_BYTES, range_bytes: int = RANGE_BYTES, chunk: int = CHUNK) -> DataFrame:
    """What each range gives: the contract's columns as text, source_file, source_row_number, byte_start, byte_end, error_code.

    A row with an error_code is a fault, with no values and no byte_end, and maybe rows of later ranges follow it: see until_fault.
    """
    names = [f.name for f in dataset.fields]
    found = _with_state(stores.ranges(spark, folder, pattern, range_bytes)).withColumn("header", F.array(*map(F.lit, names)))
    return _records(found, names, most_bytes, chunk, stores.count_ranges(folder, pattern, range_bytes))


def _records(found: DataFrame, names: list[str], most_bytes: int, chunk: int, n_ranges: int, lenient: bool = False) -> DataFrame:
    """range_records of ranges with their state, and the header of their file, which has all names in any order among others."""
    own = T.StructType([T.StructField(n, T.StringType()) for n in names])
    place = T.StructType([T.StructField("source_file", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("source_row_number", "byte_start", "byte_end")], T.StructField("error_code", T.StringType())])
    out = T.StructType([*own, *place])
    kinds = pa.schema([*[(n, pa.string()) for n in names], ("source_file", pa.string()), *[(n, pa.int64()) for n in ("source_row_number", "byte_start", "byte_end")], ("error_code", pa.string())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    def read(batches):
        for b in batches:
            for r in b.to_pylist():
                rows, held = [], 0
                try:
                    if r["size"] == 0:
                        raise Fault(EMPTY, None)
                    raw = raw_records(r["path"], r["size"], r["start"], r["end"], r["inside"], r["row"], most_bytes, chunk)
                    place = [r["header"].index(n) for n in names]
                    for row, start, end, values in parsed(raw, r["header"], lenient):
                        rows.append((*[values[i] for i in place], r["path"], row, start, end, None))
                        held += end - start
                        if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                            yield batch(rows)
                            rows, held = [], 0
                except Fault as fault:
                    rows.append((*[None] * len(names), r["path"], fault.row, fault.start, None, fault.code))
                if rows:
                    yield batch(rows)

    found = found.select("path", "size", "start", "end", "inside", "row", "header")
    # a file's ranges lie in one partition after the sums: deal them out again. Without a number Spark joins the partitions, as the rows of ranges are few, and
    # one task reads all files; with twice as many partitions as ranges, up to some for each core, few have several
    parts = min(2 * n_ranges, 8 * found.sparkSession.sparkContext.defaultParallelism)
    return found.repartition(parts, F.col("path"), F.col("start")).mapInArrow(read, out)


def until_fault(records: DataFrame) -> DataFrame:
    """The rows of each file up to its first fault, that included."""
    faults = records.where("error_code is not null").groupBy(F.col("source_file").alias("file_")).agg(F.min(F.coalesce("source_row_number", F.lit(0))).alias("fault_row"))
    j = records.join(faults, records["source_file"] == faults["file_"], "left")
    return j.where(F.col("fault_row").isNull() | (F.coalesce("source_row_number", F.lit(0)) <= F.col("fault_row"))).drop("file_", "fault_row")


def read(spark: SparkSession, folder: str, dataset: Dataset, keep, **options) -> DataFrame:
    """The records of all files of a folder, each up to its first fault. keep(name, frame) writes a frame and reads it back."""
    return until_fault(keep(f"records-{uuid.uuid4().hex}", range_records(spark, folder, dataset, **options)))


class HeaderInvalid(RuntimeError):
    """Files whose headers can't be read, or lack a required column, by name."""


def subset_records(spark: SparkSession, folder: str, required: list[str], keep, nulls: tuple[str, ...] = ("", "NA"), pattern: str = "*.csv", most_bytes: int = MOST_BYTES, range_bytes: int = RANGE_BYTES, chunk: int = CHUNK) -> DataFrame:
    """The required columns of CSV files whose headers have them in any order, among any others: text, null for `nulls` and missing fields; with source_file
    and source_row_number. All files are read in one scan, each by its own header.

    A header is read from a bounded prefix of its file. A file without all required columns fails the call with HeaderInvalid before
    any row is read. A file with a structural fault ends there, as in `read`; a fault's row is left out.
    """
    heads = keep(f"headers-{uuid.uuid4().hex}", stores.identities(spark, folder, pattern).select(F.col("path").alias("path_"), "file_name", "header"))
    lacks = F.col("header").isNull() | (F.size(F.array_except(F.array(*map(F.lit, required)), "header")) > 0)
    bad = [r["file_name"] for r in heads.where(lacks).select("file_name").orderBy("file_name").limit(10).collect()]
    if bad:
        raise HeaderInvalid(", ".join(bad))
    found = _with_state(stores.ranges(spark, folder, pattern, range_bytes))
    found = found.join(heads.select("path_", "header"), found["path"] == F.col("path_"))
    rows = until_fault(keep(f"subset-{uuid.uuid4().hex}", _records(found, required, most_bytes, chunk, stores.count_ranges(folder, pattern, range_bytes), lenient=True))).where("error_code is null")
    values = [F.when(~F.col(c).isin(*nulls), F.col(c)).alias(c) for c in required] if nulls else [F.col(c) for c in required]
    return rows.select(*values, "source_file", "source_row_number")
