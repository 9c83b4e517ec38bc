"""SimHash fingerprints, linked by a self-join of binary tries.

A trie over all distinct fingerprints is walked as a table of node pairs: every step goes some bits deeper
on both sides, adds the bits in which the two prefixes differ, and drops the pair once it has more than
``budget``. Pairs of two copies of one leaf are not worth a step and are dropped too.

Two fingerprints that differ in at most ``budget`` bits agree in one of ``budget + 1`` parts of their bits.
So the fingerprint is rotated to begin with each part in turn, and the walk allows no difference in that
part: the pairs at its end are nodes with themselves, instead of all pairs of shallow nodes. Documents with
one fingerprint are one leaf, and a leaf has a bounded number of partners (2080 for two of 64 bits),
so a group of any size yields links in proportion to its leaves, never all its pairs.

Components are found by hooking and pointer jumping over the links, in tables.

Defined results: null and blank texts have fingerprint zero and are linked like any other; a component is
named by its smallest non-null doc_id, null if it has none; repeated rows share a component; an empty
table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.text import lowered, small_batches, table, token_pieces
from tillwise.sources.scratch import materialise

SHINGLE = 3
BITS = 64
BUDGET = 2
DEPTHS = (21, 30, 39, 48, 57, 64)


def shingle_hashes(data: bytes, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of every run of ``width`` words, repeats included; a shorter text is one run."""
    digest = xxhash.xxh64_intdigest
    tail: list[bytes] = []
    some = False
    for piece in token_pieces(data):
        words = tail + piece
        if len(words) >= width:
            runs = map(b" ".join, zip(*(words[i:] for i in range(width))))
            yield np.fromiter((digest(r, 42) for r in runs), np.uint64, len(words) - width + 1)
            some = True
        tail = words[max(0, len(words) - width + 1) :]
    if tail and not some:
        yield np.array([digest(b" ".join(tail), 42)], np.uint64)


def bit_sums(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set (columns, lowest first) between the starts (rows)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int32)


def fingerprints(texts: list[str | None], width: int = SHINGLE, batch: int = 1 << 18) -> np.ndarray:
    """One unsigned fingerprint per text. Long texts are summed in pieces."""
    sums = np.zeros((len(texts), BITS), np.int64)
    counts = np.zeros(len(texts), np.int64)
    parts: list[np.ndarray] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if parts:
            lengths = np.array([len(p) for p in parts])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            np.add.at(sums, owner, bit_sums(np.concatenate(parts), starts))
            np.add.at(counts, owner, lengths)
        parts.clear()
        owner.clear()
        held = 0

    for i, text in enumerate(texts):
        for hashes in shingle_hashes(lowered(text), width):
            parts.append(hashes)
            owner.append(i)
            held += len(hashes)
            if held >= batch:
                flush()
    flush()
    ones = (2 * sums > counts[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()


@F.pandas_udf(T.LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series(fingerprints(texts.tolist()).astype(np.int64))


def _rotate(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by)) if by else fp


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, BITS - depth) if depth < BITS else key


def near_pairs(leaves: DataFrame, budget: int = BUDGET, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
    """Pairs (a, b), a below b, of distinct fingerprints ``fp`` that differ in at most ``budget`` bits."""
    turns = [BITS * i // (budget + 1) for i in range(budget + 1)]
    if depths[0] > min(b - a for a, b in zip(turns, [*turns[1:], BITS], strict=True)):
        raise ValueError("the first depth must lie within the shortest part")
    rotated = F.array(*[F.struct(F.lit(i).alias("turn"), _rotate(F.col("fp"), t).alias("key")) for i, t in enumerate(turns)])
    keys = leaves.select(F.inline(rotated)).withColumn("node", _prefix(F.col("key"), depths[0]))
    # leaves alone below their first node have no partner in this rotation
    shared = keys.groupBy("turn", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("turn", "node")
    trie = materialise(keys.join(shared, ["turn", "node"]).select("turn", "key"), "trie")
    pairs = trie.select("turn", _prefix(F.col("key"), depths[0]).alias("a")).distinct()
    pairs = pairs.select("turn", "a", F.col("a").alias("b"), F.lit(0).alias("bits"))
    for depth, deeper in zip(depths, depths[1:], strict=False):
        children = trie.groupBy(
            "turn", _prefix(F.col("key"), depth).alias("node"), _prefix(F.col("key"), deeper).alias("child")
        ).agg(F.count(F.lit(1)).alias("leaves"))
        left = children.select("turn", F.col("node").alias("a"), F.col("child").alias("x"), "leaves")
        right = children.select("turn", F.col("node").alias("b"), F.col("child").alias("y"))
        apart = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))).alias("bits")
        # the prefixes hold all bits so far, so their difference is the sum accumulated on the way down
        step = pairs.select("turn", "a", "b").join(left, ["turn", "a"]).join(right, ["turn", "b"])
        kept = (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= budget) & (
            (F.col("a") < F.col("b")) | (F.col("x") < F.col("y")) | ((F.col("x") == F.col("y")) & (F.col("leaves") > 1))
        )
        pairs = step.where(kept).select("turn", F.col("x").alias("a"), F.col("y").alias("b"), apart)
    back = lambda c: F.coalesce(
        *[F.when(F.col("turn") == i, _rotate(F.col(c), (BITS - t) % BITS)) for i, t in enumerate(turns)]
    )
    ends = pairs.where("a != b").select(back("a").alias("p"), back("b").alias("q"))
    return ends.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of ``pairs``; the root is the smallest node of its component."""
    both = materialise(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    seen = None
    while True:
        total = labels.agg(F.sum(F.col("root").cast("decimal(38,0)")), F.count(F.lit(1))).head()
        if total == seen or not total[1]:
            return labels
        seen = total
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        high = labels.join(up, "root").select("node", "root", "top")
        # every node tells its neighbours, and they their root, of the smallest root that it knows
        said = both.join(high.select(F.col("node").alias("b"), F.col("top").alias("offer")), "b")
        heard = said.groupBy("a").agg(F.min("offer").alias("offer"))
        told = high.join(heard.withColumnRenamed("a", "node"), "node")
        best = told.select("node", F.least("top", "offer").alias("root")).unionByName(
            told.select(F.col("root").alias("node"), F.least("top", "offer").alias("root"))
        )
        labels = materialise(best.groupBy("node").agg(F.min("root").alias("root")), "roots")


def linked(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) of every distinct ``fp``; ``prints`` has doc_id and fp."""
    leaves = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "leaves")
    found = components(near_pairs(leaves)).select(F.col("node").alias("fp"), "root")
    roots = leaves.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    names = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return roots.join(names, "root").select("fp", "root", "component_id")


def op7_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    prints = materialise(docs.select("doc_id", fingerprint("text").alias("fp")), "prints")
    out = prints.join(linked(prints), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id stays (then the smallest text hash)."""
    small_batches(spark)
    prints = docs.select("doc_id", F.xxhash64("text").alias("__text"), fingerprint("text").alias("fp"))
    prints = materialise(prints, "prints")
    groups = prints.join(linked(prints).select("fp", "root"), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unset"), "doc_id", "__text"))
    stays = groups.groupBy("root").agg(first.alias("s")).select(F.col("s.doc_id").alias("__id"), F.col("s.__text").alias("__hash"))
    marked = docs.withColumn("__text", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    kept = marked.join(stays, same, "left_semi")
    # rows that repeat id and text: one of them
    nth = F.row_number().over(Window.partitionBy("doc_id", "__text").orderBy("__text"))
    return kept.withColumn("__nth", nth).where("__nth = 1").select(*docs.columns)
