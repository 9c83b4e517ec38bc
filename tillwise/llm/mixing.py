"""Mix sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: each source gets its share by weight, at most ``most`` times its own size; what is cut off goes
   to the others by weight. Whole passes over a source come first, the rest is a prefix of the source in
   hash order, cut where it comes nearest to the target.
2. The words taken from a source are cut into blocks of equal length along that order. The blocks of all
   sources are quotas at the root of a binary tree over the output shards; every node draws, without
   replacement, how many blocks of each source go left. So each leaf holds an equal number of blocks, the
   quotas are met exactly, and the draw is that of a full shuffle of blocks.
3. Each source's blocks are permuted and dealt to the leaves without overlap; rows are shuffled inside a
   shard by a seeded hash.

The driver sees one number per source, and one per block; blocks are a parameter, not a function of rows.
A source may hold any part of the rows: it is cut into ``CELLS`` hash ranges before anything is ordered.

Defined results: a null text and a text of blanks have size 0 and take 0; a null source is a source of its
own, last; equal rows are interchangeable; an empty table, or one without words, takes nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.text import small_batches, table, text_crc, token_pieces
from tillwise.sources.scratch import materialise

WEIGHTS = (3.0, 1.0, 2.0)
CELL_BITS = 10


@F.pandas_udf(T.LongType())
def word_count(texts: pd.Series) -> pd.Series:
    """Runs without ASCII blanks; 0 for null."""
    return pd.Series(
        [sum(map(len, token_pieces(t.encode("utf-8", "surrogatepass")))) if t else 0 for t in texts], dtype="int64"
    )


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Words wanted of each source: ``share`` of all words by weight, none above ``most`` times its size."""
    caps = [most * s for s in sizes]
    out = [0.0] * len(sizes)
    left, open_ = min(share * sum(sizes), sum(caps)), [i for i, s in enumerate(sizes) if s]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if caps[i] <= unit * weights[i]]
        for i in full or open_:
            out[i] = caps[i] if full else unit * weights[i]
        left -= sum(caps[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)] if full else []
    return out


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows)."""
    if shards == 1:
        return quotas[None, :]
    half = shards // 2
    total = int(quotas.sum())
    go_left = rng.multivariate_hypergeometric(quotas, total * half // shards, method="marginals")
    return np.vstack([split_tree(go_left, half, rng), split_tree(quotas - go_left, shards - half, rng)])


def draw(
    found: list[tuple[str | None, int]], share: float, most: float, weights, shards: int, blocks: int, seed: int
) -> list[tuple]:
    """One line per source: name, size, target, whole passes, words beyond them, block length, shard of each block."""
    found = sorted(found, key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, most)
    length = max(1, -(-int(np.ceil(sum(wanted))) // blocks))
    # one block more than the target fills: a document belongs to the block that it begins in
    quotas = np.array([int(t) // length + 1 for t in wanted], dtype=np.int64)
    rng = np.random.default_rng(seed)
    leaves = split_tree(quotas, shards, rng) if found else None
    lines = []
    for i, ((name, size), target) in enumerate(zip(found, wanted, strict=True)):
        whole = int(target // size) if size else 0
        deal = rng.permutation(np.repeat(np.arange(shards), leaves[:, i]))
        lines.append((name, size, target, whole, target - whole * size, length, [int(s) for s in deal]))
    return lines


def mixed(
    rows: DataFrame, tie: list[str], share: float = 1.5, most: float = 2.0, weights=WEIGHTS,
    shards: int = 16, blocks: int = 1024, seed: int = 7,
) -> DataFrame:
    """``rows`` (with ``source`` and long ``__size``) and what the mix takes of them.

    Adds __source_size, __target, __taken and __shards, the output shard of every copy. ``tie`` names the
    columns that tell rows apart. ``rows`` is read twice: once for the sums, once for the rows.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("__key", F.xxhash64(*tie, F.lit(seed)))
    keyed = keyed.withColumn("__cell", F.shiftrightunsigned("__key", 64 - CELL_BITS))
    # summed by cell first, so that a hot source is many groups
    cells = keyed.groupBy("source", "__cell").agg(F.sum("__size").cast("long").alias("__n"))
    cells = materialise(cells, "mix-cells")
    found = [(r["source"], r["n"]) for r in cells.groupBy("source").agg(F.sum("__n").alias("n")).collect()]
    lines = draw(found, share, most, weights, shards, blocks, seed)
    sources = spark.createDataFrame(
        lines, "__name string, __source_size long, __target double, __whole int, __rest double, __length long, __deal array<int>"
    )
    earlier = Window.partitionBy("source").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start")
    starts = cells.select(F.col("source").alias("__of"), F.col("__cell").alias("__in"), start)
    inner = Window.partitionBy("source", "__cell").orderBy("__key", *tie, "__size")
    run = F.coalesce(F.sum("__size").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    same = F.col("source").eqNullSafe(F.col("__of")) & (F.col("__cell") == F.col("__in"))
    at = keyed.withColumn("__run", run).join(starts, same)
    # one row for each source; the blocks in it are a parameter
    at = at.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("__name")))
    at = at.withColumn("__begin", F.col("__start") + F.col("__run"))
    extra = (F.col("__begin") + F.col("__size") / 2 <= F.col("__rest")).cast("int")
    at = at.withColumn("__copies", F.when(F.col("__size") > 0, F.col("__whole") + extra).otherwise(0))
    block = lambda p: F.floor((p * F.col("__source_size") + F.col("__begin")) / F.col("__length")).cast("int")
    passes = F.filter(F.sequence(F.lit(0), F.lit(int(most))), lambda p: p < F.col("__copies"))
    at = at.withColumn("__shards", F.transform(passes, lambda p: F.get(F.col("__deal"), block(p))))
    return at.withColumn("__taken", F.col("__copies") * F.col("__size")).drop(
        "__cell", "__run", "__of", "__in", "__start", "__name", "__whole", "__rest", "__length", "__deal", "__begin", "__copies"
    )


def sized(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.withColumn("__size", word_count("text"))


def op6_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, sf_dir, "documents")
    narrow = sized(docs).select("doc_id", "source", "__size", text_crc(F.col("text")).alias("__crc"))
    out = mixed(materialise(narrow, "mix-sizes"), ["doc_id", "__crc"])
    names = ["size", "source_size", "target", "taken"]
    shards = F.array_join(F.col("__shards").cast("array<string>"), ",").alias("shards")
    return out.select("doc_id", *[F.col(f"__{n}").alias(n) for n in names], shards)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents the mix takes, one row per copy, grouped by output shard and shuffled in it."""
    taken = mixed(sized(docs).withColumn("__crc", text_crc(F.col("text"))), ["doc_id", "__crc"])
    each = taken.select(*docs.columns, "__key", F.posexplode("__shards").alias("__pass", "__shard"))
    each = each.withColumn("__order", F.xxhash64("__key", "__pass"))
    # a shard is split by the leading bits of its order, so none is one task
    each = each.repartition("__shard", F.shiftrightunsigned("__order", 61)).sortWithinPartitions("__shard", "__order")
    return each.select(*docs.columns)
