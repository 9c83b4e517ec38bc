"""What several operators need: whole tables, the fixed folds, and tokens of very long texts in pieces."""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python task holds: Spark's default of 64 MB of text per Arrow batch is several hundred MB of objects."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id, which then belongs to no held-out fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def in_fold(doc_id: Column, folds: int, remainder: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == remainder, F.lit(False))


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes, cut at ASCII blanks."""
    start = 0
    while start < len(data):
        stop = start + size
        if stop < len(data):
            blank = _SPACE.search(data, stop)
            stop = blank.start() if blank else len(data)
        yield data[start:stop]
        start = stop


def token_pieces(data: bytes) -> Iterator[list[bytes]]:
    """Words between ASCII blanks, in lists of bounded size; no word is cut."""
    return (piece.split() for piece in pieces(data))


def lowered(text: str | None) -> bytes:
    """UTF-8 with only A-Z lower-cased; an unset text is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def shared(spark: SparkSession, value) -> Callable[[], object]:
    """``value`` for tasks, sent once to each executor. Instances of this package's classes travel by value."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list = []

    def get():
        if not held:
            held.append(pickle.loads(sent.value))
        return held[0]

    return get
