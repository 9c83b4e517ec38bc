"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points on a ring of 64-bit hashes. A row starts at the first point
clockwise of its own hash; a shard that is full passes the row on to the next shard clockwise. All rows
between two neighbouring points walk the same way, so the walk is settled on *counts per arc* (a table
bounded by shards x virtual nodes, whatever the number of rows) and the rows only look up their part.

With ``slack=0`` the capacities sum to the number of rows, so shard counts differ by one at most.

Defined results: a null or repeated key is hashed together with its text, so it is a row like any other;
a null text has size 16 and the checksum of the empty text; an empty table gives an empty table;
exact copies of a row are interchangeable; other columns, whatever their names, pass unread.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.text import table, text_crc
from tillwise.sources.scratch import materialise

ROW_BYTES = 16


def ring(n_shards: int, virtual_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted points (signed 64 bit) and the shard that owns each."""
    owners = np.repeat(np.arange(n_shards), virtual_nodes)
    names = (f"{s}/{v}" for s in range(n_shards) for v in range(virtual_nodes))
    points = np.array(
        [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "big", signed=True) for n in names],
        dtype=np.int64,
    )
    order = np.lexsort((owners, points))
    return points[order], owners[order]


def capacities(rows: int, n_shards: int, slack: float) -> list[int]:
    """The bound of each shard; they sum to ``rows`` at least."""
    if slack:
        return [-int(-rows * (1 + slack) // n_shards)] * n_shards
    return [rows // n_shards + (s < rows % n_shards) for s in range(n_shards)]


def settle(counts: dict[int, int], owners: np.ndarray, caps: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Parts (arc, first rank, end rank, shard, first slot).

    Step d offers what is left of every arc to the d-th distinct shard clockwise of it, arcs in ring order.
    """
    left, free, parts = dict(counts), list(caps), []
    at = {a: (a, {int(owners[a])}) for a in left}
    slots = [0] * len(caps)
    while left:
        for arc in sorted(left):
            shard = int(owners[at[arc][0]])
            if took := min(left[arc], free[shard]):
                done = counts[arc] - left[arc]
                parts.append((arc, done, done + took, shard, slots[shard]))
                free[shard] -= took
                slots[shard] += took
                left[arc] -= took
        left = {a: n for a, n in left.items() if n}
        for arc in left:
            point, seen = at[arc]
            while int(owners[point]) in seen:
                point = (point + 1) % len(owners)
            seen.add(int(owners[point]))
            at[arc] = (point, seen)
    return parts


def place(
    rows: DataFrame, key: str, tie: list[str], n_shards: int = 40, virtual_nodes: int = 64, slack: float = 0.0
) -> DataFrame:
    """``rows`` with int ``shard`` and long ``slot`` (gapless from 0 in each shard). Reads ``rows`` twice."""
    spark = rows.sparkSession
    points, owners = ring(n_shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, position.to_numpy(np.int64)) % len(points))

    placed = rows.withColumn("__at", F.xxhash64(key, *tie)).withColumn("__arc", arc_of("__at"))
    # at most one row for each virtual node
    counts = {r["__arc"]: r["n"] for r in placed.groupBy("__arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = settle(counts, owners, capacities(sum(counts.values()), n_shards, slack))
    schema = "__part_arc int, __from long, __to long, shard int, __base long"
    lookup = spark.createDataFrame(parts, schema)
    rank = F.row_number().over(Window.partitionBy("__arc").orderBy("__at", key, *tie)) - 1
    ranked = placed.drop("shard", "slot").withColumn("__rank", rank.cast("long"))
    inside = (
        (F.col("__arc") == F.col("__part_arc")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to"))
    )
    # bounded by virtual nodes x shards, not by rows
    out = ranked.join(F.broadcast(lookup), inside).withColumn("slot", F.col("__base") + F.col("__rank") - F.col("__from"))
    return out.drop("__at", "__arc", "__rank", "__part_arc", "__from", "__to", "__base")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size in UTF-8 bytes plus 16, and the text's checksum."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    return docs.select("doc_id", size.alias("size"), text_crc(F.col("text")).alias("text_crc32"))


def op2_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 under the law ``rows``."""
    sizes = materialise(measured(table(spark, sf_dir, "documents")), "sizes")
    return place(sizes, "doc_id", ["text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document with its shard and slot."""
    sized = docs.withColumn("__crc", text_crc(F.col("text")))
    return place(sized, "doc_id", ["__crc"]).drop("__crc")
