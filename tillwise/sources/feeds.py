"""Raw CSV feeds: batch reader with file-order ordinal, and the CSV sink."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.text import null_if_token
from tillwise.schemas import STAR, Table

# Where a row stood in the feed; keep-first operators order by it.
ORDINAL = "_ordinal"

# Whether the row had too few or too many cells.
MALFORMED = "_malformed"
_CORRUPT = "_corrupt_record"

# Where a row was read: URI of the file, start of the split, number that grows within the split.
FILE, SPLIT, NTH = "_feed_file", "_split_start", "_nth"

# Quotes are doubled inside a quoted cell, as spreadsheets and pandas write them.
CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    # A file's header must name the columns of the schema in its order.
    "enforceSchema": "false",
    # Pruned columns are not parsed, and a row's cells would not be counted.
    "columnPruning": "false",
}
_PLAIN = {k: CSV_OPTIONS[k] for k in ("header", "encoding", "quote", "escape")}


_LINES = 16  # of a file are looked at for its header
_ALONE = 1 << 40  # bytes; files are not packed together below it


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not blank; the rest of the file is not read.

    Leaving a file early ends the worker, so each task starts a new one: Arrow alone is quick to load, pandas is not.
    """
    for batch in batches:
        for i, line in enumerate(batch.column("value").to_pylist()):
            if line.strip():
                yield batch.slice(i, 1)
                return


def headers(spark: SparkSession, paths: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files under ``paths`` by the columns their headers name, as URIs. Files without any line are left out.

    A task opens one file and stops at its first line. What the driver gets is the list of files, which it holds for
    every scan anyway.
    """
    # settings of a session of its own: one file to a task, a few lines to a batch
    probe = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        probe.conf.set(f"spark.sql.files.{key}", str(_ALONE))
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_LINES))
    lines = probe.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.where("file_block_start = 0").select("value", "file_path")
    found: dict[tuple[str, ...], list[str]] = {}
    for line, file in sorted(tuple(r) for r in lines.mapInArrow(_first_lines, "value string, file_path string").collect()):
        found.setdefault(tuple(next(csv.reader([line]))), []).append(file)
    return found


def csv_schema(table: Table, header: tuple[str, ...]) -> T.StructType:
    """The feed's columns in the order of a header, plus the one that receives the text of a malformed row.

    Columns are found by name; a missing, an unknown or a repeated one is an error.
    """
    missing = [c for c in table.columns if c not in header]
    unknown = [c for i, c in enumerate(header) if c not in table.columns or c in header[:i]]
    if missing or unknown:
        raise ValueError(f"{table.name}: missing columns {missing}, unknown columns {unknown}")
    return T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])


def literal(path: str) -> str:
    """``path`` with no character of it a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def scan(spark: SparkSession, feed: str, files: dict[tuple[str, ...], list[str]], multiline: bool = False) -> DataFrame:
    """Rows of ``files`` (by header) as text columns, with malformed mark, file, split and number within the split.

    Files of the same header are one scan, so there are as many scans as orders of columns.
    """
    table = STAR[feed]
    scans = []
    for header, uris in (files or {(): []}).items():
        reader = spark.read.schema(csv_schema(table, header)).options(**CSV_OPTIONS)
        raw = reader.option("multiLine", str(multiline).lower()).csv([literal(unquote(u)) for u in uris])
        scans.append(raw.select(
            *table.columns, is_malformed().alias(MALFORMED), F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_block_start").alias(SPLIT), F.monotonically_increasing_id().alias(NTH),
        ))
    return reduce(DataFrame.unionByName, scans)


def is_malformed() -> Column:
    return F.col(_CORRUPT).isNotNull()


def in_path_order(path: Column) -> Column:
    """Sort key for part files: folder and name, numbers by value, so part-99999 comes before part-100000."""
    name = F.substring_index(path, "/", -2)
    padded = F.regexp_replace(name, r"(\d+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, r"\d*(\d{20})(?!\d)", "$1")


def _tail(path: Column) -> Column:
    return F.substring_index(path, "/", -2)


def path_orders(names: DataFrame) -> DataFrame:
    """(_tail, _order) for each file among ``names`` (path): its folder and name, and the sort key of these."""
    tails = names.select(_tail(F.col("path")).alias("_tail")).distinct()
    return tails.withColumn("_order", in_path_order(F.col("_tail")))


def with_path_order(rows: DataFrame, path: Column, orders: DataFrame, into: str) -> DataFrame:
    """``rows`` with the sort key of their file, looked up: the patterns behind it run once a file and not once a row.

    ``orders`` has a row for each file, which the driver holds for the scan anyway. It says nothing of its size, so
    without the hint all rows would be shuffled to their few file names.
    """
    found = rows.withColumn("_tail", _tail(path)).join(F.broadcast(orders), "_tail", "left")
    return found.withColumn(into, F.coalesce("_order", in_path_order(F.col("_tail")))).drop("_tail", "_order")


def path_places(spark: SparkSession, files: list[str]) -> DataFrame:
    """(_tail, _place) for each of the files: the place of its sort key among theirs, a number where the key is long."""
    orders = path_orders(spark.createDataFrame([(f,) for f in files], "path string")).collect()
    # by code point, which is Spark's order too; files of the same folder and name share a place
    places = {order: i for i, order in enumerate(sorted({r["_order"] for r in orders}))}
    return spark.createDataFrame([(r["_tail"], places[r["_order"]]) for r in orders], "_tail string, _place int")


def normalise(raw: DataFrame, table: Table) -> DataFrame:
    """Null tokens in the feed columns become nulls; other columns (the ordinal) pass through."""
    return raw.withColumns({c: null_if_token(F.col(c)) for c in table.columns})


def read_feed(spark: SparkSession, feed: str, path: str, multiline: bool = False) -> DataFrame:
    """Read one feed (a file or a directory of files) as text columns, ordinal and malformed mark.

    Columns are read by the names in the header of each file, so files may have them in different orders. Rows are
    numbered by file name, position of the split in the file, and row within the split.
    ``monotonically_increasing_id`` alone would follow the scan's packing of splits into tasks,
    which goes by size. ``multiline`` allows line breaks inside quoted cells, at the price of one
    task per file.
    """
    table = STAR[feed]
    found = headers(spark, path)
    places = path_places(spark, [f for files in found.values() for f in files])
    rows = scan(spark, feed, found, multiline).withColumn("_tail", _tail(F.col(FILE))).join(F.broadcast(places), "_tail", "left")
    # rows are shuffled and sorted with their ordinal
    ordinal = F.struct(F.col("_place").alias("file"), F.col(SPLIT).alias("split"), F.col(NTH).alias("row"))
    return normalise(rows.select(*table.columns, ordinal.alias(ORDINAL), MALFORMED), table)


def write_feed(df: DataFrame, path: str, max_rows_per_file: int = 0) -> None:
    """Write text columns as gzipped CSV with a header; cells keep their surrounding spaces.

    ``max_rows_per_file`` of 0 means one file per task. Readers tell by the name of a file that it is packed; such a file
    is read by one task, as are its lines in order.
    """
    (
        df.drop(ORDINAL, MALFORMED)
        .write.mode("overwrite")
        .options(**_PLAIN)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxRecordsPerFile", max_rows_per_file)
        .option("compression", "gzip")
        .csv(path)
    )
