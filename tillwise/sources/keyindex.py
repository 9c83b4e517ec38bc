"""A persistent index of a table's keys: for each key where its row stood in the feed, and the month that holds it.

The index is a table of the store, cut into ``BUCKETS`` by hash. Every write adds a folder of entries and, beside it, a
Bloom filter of its keys, as rows: 64 bits for about five keys, found by bucket and block. A lookup reads the filters
first and then only those folders of those buckets that may hold one of its keys; new keys mostly need none. A key may
have several entries, as a row can give way to one that stood earlier; the earliest counts. Beyond ``MOST_WRITES`` the
entries are merged to one per key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.sources import snapshots
from tillwise.sources.snapshots import Manifest, Parts

BUCKETS = 64
BITS_PER_KEY = 12
MOST_WRITES = 16

ENTRIES, FILTERS = "keys", "key_filters"
_BUCKET = "bucket"
_BLOCK_BITS = 64

# Where a row stood: file, split, row. Unset for rows of which only the table is known; these came first.
PLACE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("split", T.LongType()), T.StructField("row", T.LongType())
])
ENTRY = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("place", PLACE), T.StructField("month", T.StringType())
])
_STORED = T.StructType([*ENTRY.fields, T.StructField(_BUCKET, T.IntegerType())])
_FILTER = T.StructType([
    T.StructField("write", T.StringType()), T.StructField("in_bucket", T.IntegerType()),
    T.StructField("block", T.LongType()), T.StructField("bits", T.LongType()),
])


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _mask(key: Column) -> Column:
    """The four bits of a key in its block."""
    spread = F.xxhash64(key, F.lit("bits"))
    places = [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(_BLOCK_BITS - 1).cast("int") for i in range(4)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), blocks)


@dataclass(frozen=True)
class Entries:
    """Entries written but in no manifest yet."""

    parts: Parts
    filters: Parts
    write: str
    blocks: int

    def into(self, manifest: Manifest, merged: bool = False) -> Manifest:
        """The manifest with these entries added, or with them alone."""
        old = Manifest() if merged else manifest
        parts = snapshots.added(old.tables.get(ENTRIES, {}), self.parts)
        filters = snapshots.added(old.tables.get(FILTERS, {}), self.filters)
        writes = {**old.notes.get(ENTRIES, {}), self.write: self.blocks}
        return manifest.with_table(ENTRIES, parts).with_table(FILTERS, filters).with_note(ENTRIES, writes)


def forgotten(manifest: Manifest) -> Manifest:
    """The manifest without an index, as after a write that did not keep it."""
    return manifest.with_table(ENTRIES, None).with_table(FILTERS, None).with_note(ENTRIES, {})


def write(entries: DataFrame, root: str) -> Entries:
    """Write (key, place, month), one row per key, and the filter of the keys."""
    spark = entries.sparkSession
    rows = entries.select("key", F.col("place").cast(PLACE).alias("place"), "month").withColumn(_BUCKET, bucket_of(F.col("key")))
    # one file per bucket unless it is large
    parts = snapshots.write_folder(rows.hint("rebalance", _BUCKET), root, _BUCKET)
    written = snapshots.read_parts(spark, root, parts, _STORED)
    count = written.count()
    blocks = max(1, -(-count * BITS_PER_KEY // (_BLOCK_BITS * BUCKETS)))
    name = next((own[0].split("/")[1] for own in parts.values()), "none")
    key = F.col("key")
    filters = written.select(
        F.lit(name).alias("write"), F.col(_BUCKET).alias("in_bucket"), _block(key, F.lit(blocks)).alias("block"), _mask(key).alias("mask")
    )
    filters = filters.groupBy("write", "in_bucket", "block").agg(F.bit_or("mask").alias("bits"))
    return Entries(parts, snapshots.write_folder(filters, root), name, blocks)


def touched(spark: SparkSession, root: str, manifest: Manifest, keys: DataFrame) -> Parts:
    """The folders of entries, by bucket, that may hold one of ``keys`` (key)."""
    writes = manifest.notes.get(ENTRIES, {})
    if not writes:
        return {}
    each = F.explode(F.array(*[F.struct(F.lit(w).alias("write"), F.lit(b).cast("long").alias("blocks")) for w, b in writes.items()]))
    key = F.col("key")
    asked = keys.select(key, bucket_of(key).alias("in_bucket"), _mask(key).alias("mask"), each.alias("w"))
    asked = asked.select("in_bucket", "mask", F.col("w.write").alias("write"), _block(key, F.col("w.blocks")).alias("block"))
    filters = snapshots.read(spark, root, FILTERS, _FILTER, manifest)
    maybe = asked.join(filters, ["write", "in_bucket", "block"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    # at most one row for each bucket and write
    found = maybe.select("in_bucket", "write").distinct().collect()
    hit = {(str(r["in_bucket"]), r["write"]) for r in found}
    parts = manifest.tables.get(ENTRIES, {})
    some = {b: [f for f in own if (b, f.split("/")[1]) in hit] for b, own in parts.items()}
    return {b: own for b, own in some.items() if own}


def lookup(spark: SparkSession, root: str, manifest: Manifest, keys: DataFrame) -> DataFrame:
    """(key, place, month) of those of ``keys`` (key) that the index has, one row each."""
    entries = snapshots.read_parts(spark, root, touched(spark, root, manifest, keys), _STORED)
    found = entries.join(keys.select("key"), "key", "left_semi")
    first = found.groupBy("key").agg(F.min(F.struct("place", "month")).alias("first"))
    return first.select("key", "first.place", "first.month")


def merged(spark: SparkSession, root: str, manifest: Manifest) -> Manifest:
    """The manifest with its entries in one write, if there are many."""
    if len(manifest.notes.get(ENTRIES, {})) <= MOST_WRITES:
        return manifest
    every = snapshots.read(spark, root, ENTRIES, _STORED, manifest)
    first = every.groupBy("key").agg(F.min(F.struct("place", "month")).alias("first"))
    return write(first.select("key", "first.place", "first.month"), root).into(manifest, merged=True)
