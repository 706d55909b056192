"""Source files: CSV and JSONL of a dataset contract, and the listing of a snapshot of files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.operators.validate import Dataset

#: Quotes are doubled inside quoted fields, which may hold line ends; spaces belong to the values.
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


#: A record may have as many bytes.
MOST_BYTES = 8 << 20


def _texts(dataset: Dataset) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in dataset.fields])


def _lines(spark: SparkSession, path: str, header: Callable[[Column], Column]) -> DataFrame:
    """Lines with their place in the file and in quotes, whatever splits they were read in, and what `header` says of the file's first.

    Within a split places are running sums; a frame of one row for each split carries them over.
    """
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    rows = spark.read.option("lineSep", "\n").text(path).select("value", file.alias("file"), block.alias("block"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), F.octet_length("value").cast("bigint").alias("n"), quotes.cast("bigint").alias("quotes"))
    w = Window.partitionBy("file", "block").orderBy("at")
    before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("bigint")
    rows = rows.select("*", F.coalesce(F.sum(F.col("n") + 1).over(before), zero).alias("offset"), F.coalesce(F.sum("quotes").over(before), zero).alias("quoted"))
    outside = F.col("quoted") % 2 == 0
    # which lines open a record depends on the quotes of earlier splits: both cases are counted, as n and last place of such lines
    cases = [F.struct(F.count_if(c).over(upto).alias("n"), F.max(F.when(c, F.col("offset"))).over(upto).alias("at")) for c in (outside, ~outside)]
    rows = rows.select("*", cases[0].alias("even"), cases[1].alias("odd"))

    cases = [F.struct(F.count_if(c).alias("n"), F.max(F.when(c, F.col("offset"))).alias("at")) for c in (outside, ~outside)]
    first = F.max(F.when((F.col("block") == 0) & (F.col("offset") == 0), F.col("value"))).alias("first")
    # with the same columns as the lines themselves, so that both come from one scan and one shuffle
    blocks = rows.groupBy("file", "block").agg(first, F.max("size").alias("b_size"), F.sum(F.col("n") + 1).alias("b_bytes"), F.sum("quotes").alias("b_quotes"), cases[0].alias("b_even"), cases[1].alias("b_odd"))
    of_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = lambda c: F.coalesce(F.sum(c).over(of_file), zero)
    blocks = blocks.select("*", carried("b_bytes").alias("c_bytes"), carried("b_quotes").alias("c_quotes"), (F.sum("b_bytes").over(Window.partitionBy("file")) < F.col("b_size")).alias("marked"))
    case = F.when(F.col("c_quotes") % 2 == 0, F.col("b_even")).otherwise(F.col("b_odd"))
    blocks = blocks.select("*", case.alias("case"))
    blocks = blocks.select("file", "block", "c_bytes", "c_quotes", carried("case.n").alias("c_rows"), F.max(F.col("c_bytes") + F.col("case.at")).over(of_file).alias("c_opened"), "marked", header(F.max("first").over(Window.partitionBy("file"))).alias("header"))

    # the reader leaves out a byte order mark: then the lines are three bytes short of the file
    mark = F.when(F.col("marked"), 3).otherwise(0)
    start = F.col("c_bytes") + F.col("offset")
    end = start + mark + F.col("n")
    case = F.when(F.col("c_quotes") % 2 == 0, F.col("even")).otherwise(F.col("odd"))
    opened = F.coalesce(F.col("c_bytes") + case["at"], F.col("c_opened"))
    moved = lambda at: F.when(at > 0, at + mark).otherwise(zero)
    return rows.join(blocks, ["file", "block"]).select(
        "file", (F.col("c_rows") + case["n"]).alias("row"), moved(opened).alias("opened"), moved(start).alias("start"), end.alias("end"), (end < F.col("size")).alias("ended"), "value",
        "header", ((F.col("c_quotes") + F.col("quoted")) % 2 == 0).alias("opens"), ((F.col("c_quotes") + F.col("quoted") + F.col("quotes")) % 2 == 0).alias("closes"),
    )


def _bare(record: Column) -> Column:
    """What is left of a record if doubled quotes go, and each quoted field is a single quote."""
    return F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), r'(?<![^,])"[^"]*"', '"')


def _fields(bare: Column) -> Column:
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def csv_records(spark: SparkSession, path: str, dataset: Dataset, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The records of CSV files as text columns, with source_file, source_row_number (the header is row 1, and not among them),
    byte_start and byte_end (half open, without the line end) and error_code.

    A record with an error has nulls for values; of a file whose header isn't the contract's, there is only row 1 with its error.
    Files are read in splits, and only records over several lines are gathered, up to most_bytes each: beyond, they are too large.
    Spark lists no empty files.
    """
    schema = ", ".join(f"{f.name} string" for f in dataset.fields)
    parsed = lambda c: F.from_csv(c, schema, {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV.items() if k != "header"})
    names = F.array(*[F.lit(f.name) for f in dataset.fields])

    def header(line: Column) -> Column:
        line = F.rtrim(line, F.lit("\r"))
        values = parsed(line)
        return F.coalesce((_fields(_bare(line)) == len(dataset.fields)) & (F.array(*[values[f.name] for f in dataset.fields]) == names), F.lit(False))

    lines = _lines(spark, path, header)
    whole = F.col("opens") & F.col("closes")
    size = F.col("end") - F.col("start")
    kept = ["file", "row", "start", "end", "ended", "closes", "header"]
    # texts beyond the cap, which may go on to the end of a file, are left out before any are gathered
    fits = F.when(F.col("end") - F.col("opened") <= most_bytes + 1, F.col("value"))
    one = lines.where(whole).select(*kept, fits.alias("record"))
    parts = lines.where(~whole).groupBy("file", "row").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max_by("ended", "end").alias("ended"), F.max_by("closes", "end").alias("closes"), F.first("header").alias("header"),
        F.array_sort(F.collect_list(F.when(fits.isNotNull(), F.struct("start", fits.alias("value"))))).alias("lines"),
    )
    more = parts.select(*kept, F.when(F.col("closes") & (size <= most_bytes + 1), F.array_join("lines.value", "\n")).alias("record"))

    # a carriage return before the line end is no part of a record
    cut = F.coalesce(F.col("ended") & F.endswith("record", F.lit("\r")), F.lit(False))
    record = F.when(cut, F.expr("substring(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    records = one.unionByName(more).where("header or row = 1").select("file", "row", "header", "start", (F.col("end") - cut.cast("int")).alias("end"), "closes", record.alias("record"))
    bare = _bare(F.col("record"))
    error = (
        F.when(~F.col("header"), "CSV_HEADER_MISMATCH").when(size > most_bytes, "CSV_RECORD_TOO_LARGE").when(~F.col("closes"), "CSV_MALFORMED").when(~F.is_valid_utf8("record"), "CSV_ENCODING_INVALID")
        .when((F.col("record") == "") | bare.rlike(r'(?<![^,])"[^,\r]|\n|\r(?s:.)'), "CSV_MALFORMED").when(_fields(bare) != len(dataset.fields), "CSV_FIELD_COUNT_MISMATCH")
    )
    out = records.select("*", error.alias("error_code"), parsed("record").alias("values")).where("row > 1 or not header")
    own = [F.when(F.col("error_code").isNull(), F.col(f"values.{f.name}")).alias(f.name) for f in dataset.fields]
    return out.select(*own, F.col("file").alias("source_file"), F.col("row").alias("source_row_number"), F.col("start").alias("byte_start"), F.col("end").alias("byte_end"), "error_code")


def read_csv(spark: SparkSession, path: str, dataset: Dataset, most_bytes: int = MOST_BYTES) -> DataFrame:
    """As csv_records, but a record with an error, or another header, fails the read with its code and row."""
    rows = csv_records(spark, path, dataset, most_bytes)
    fails = F.raise_error(F.concat("error_code", F.lit(" at row "), F.col("source_row_number").cast("string"))).cast("boolean")
    # a column of random numbers keeps the optimiser from trying this on parts of records, before joins
    return rows.withColumn("any", F.rand()).where(F.when(F.col("error_code").isNull(), F.col("any") >= 0).otherwise(fails)).drop("any", "error_code")


def read_jsonl(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """One object a line, its values as text; a line that is none fails, a missing value is null."""
    return spark.read.options(mode="FAILFAST").schema(_texts(dataset)).json(path)


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    df.write.options(**CSV, quoteAll=True).partitionBy(*by).csv(path)


def snapshot(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """file_name, n_bytes and sha256 of each file of a folder; the files are hashed where they are read (up to 2 GB each).

    Spark lists no empty files; such a file counts as missing.
    """
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def release_id(files: DataFrame) -> DataFrame:
    """One row: the id of a snapshot, a hash of the sorted names, sizes and hashes of its files (a contract's few)."""
    line = F.concat_ws(":", "file_name", F.col("n_bytes").cast("string"), "sha256")
    return files.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n").cast("binary"), 256).alias("source_release_id"), F.count("*").alias("n_files"))


def file_set_issues(files: DataFrame, expected: list[str]) -> DataFrame:
    """MISSING and UNEXPECTED files."""
    names = files.sparkSession.createDataFrame([(n,) for n in expected], "file_name string").withColumn("wanted", F.lit(True))
    j = files.select("file_name", F.lit(True).alias("found")).join(names, "file_name", "full")
    return j.select("file_name", F.when(F.col("found").isNull(), "MISSING").when(F.col("wanted").isNull(), "UNEXPECTED").alias("issue")).where("issue is not null")


def classify_releases(known: DataFrame, candidates: DataFrame, stable: Sequence[str] = ("n_bytes", "sha256")) -> DataFrame:
    """For each release of candidates: NEW_CANDIDATE, REPLAY of the known one of that id, or CONFLICT if a file is missing, is new or
    differs in a stable column.

    Both: source_release_id, file_name and the stable columns, one row a file. Other columns, as dates of creation, don't count.
    """
    key = ["source_release_id", "file_name"]
    side = lambda df, name: df.select(*key, F.struct(*stable).alias(name))
    ids = candidates.select("source_release_id").distinct()
    old = side(known, "old").join(ids, "source_release_id", "left_semi")
    j = old.join(side(candidates, "new"), key, "full").groupBy("source_release_id").agg(F.count("old").alias("n_old"), F.count_if(~F.col("old").eqNullSafe(F.col("new"))).alias("n_differ"))
    return j.select("source_release_id", F.when(F.col("n_old") == 0, "NEW_CANDIDATE").when(F.col("n_differ") == 0, "REPLAY").otherwise("CONFLICT").alias("disposition"))
