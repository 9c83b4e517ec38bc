"""MinHash fingerprints: universal hash permutations over word shingles, in numpy.

A text's shingles are runs of ``WIDTH`` words. Each of ``PERMUTATIONS`` functions (a x + b) maps the shingle
hashes anew and keeps the smallest; the share of equal minima of two texts estimates the Jaccard similarity of
their shingle sets. A fingerprint keeps 16 bits of each minimum, as hex.

``near_duplicates`` joins bands of the minima and verifies the exact Jaccard similarity of every two members of
a bucket. Texts with equal sets of shingles are one member; a large bucket is dealt into blocks, each two of
which meet in a task of their own, where similarities are counted as a product of matrices, so that no pair
becomes a row. A pair counts in the first bucket it shares.

``edited_pairs`` gives each text its successor by descending doc_id. Texts are dealt once, by ranges of the
id, and the first document of each range also goes to the range before it; nothing else meets.

Defined results: a null text is empty; a text without words has the fingerprint of no shingles, equal only to
itself; a text of fewer words than a shingle has one shingle; repeated ids follow one another by text hash;
null ids come last; a single document is its own successor; an empty table gives an empty table; extra columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.simhash import components
from tillwise.llm.text import lowered, small_batches, table, token_pieces
from tillwise.sources.scratch import materialise

WIDTH = 5
PERMUTATIONS = 128
BANDS = 32
SIMILAR = 0.8
_CHUNK = 1 << 15
_CACHE = 1 << 20
BLOCK = 256  # members, and
HELD = 1 << 20  # shingles of a block, about
_COLUMNS = 1 << 12
BROADCAST = 500_000  # texts, by their hash


class Hashes(dict):
    """64-bit hash of each word met, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


def _spread(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` word hashes."""
    n = len(words) - width + 1
    out = words[:n].copy()
    for i in range(1, width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[i : n + i]
    return _spread(out)


def shingle_sets(text: str | None, known: Hashes, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Shingle hashes of a text, in pieces of bounded size."""
    tail, some = np.empty(0, np.uint64), False
    for piece in token_pieces(lowered(text)):
        words = np.fromiter(map(known.__getitem__, piece), np.uint64, len(piece))
        words = np.concatenate([tail, words]) if len(tail) else words
        if len(words) >= width:
            some = True
            yield _shingles(words, width)
        tail = words[max(0, len(words) - width + 1) :]
    if len(tail) and not some:
        yield _shingles(tail, len(tail))


class Signer:
    """Signatures of many texts at a time."""

    def __init__(self, permutations: int = PERMUTATIONS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, permutations, np.uint64)
        self.known = Hashes()

    def sign(self, texts: list[str | None]) -> np.ndarray:
        """The smallest 32-bit value per text (rows) and permutation (columns); all ones without shingles."""
        out = np.full((len(texts), len(self.a)), np.uint64(0xFFFFFFFFFFFFFFFF))
        parts, owners, held = [], [], 0
        for i, text in enumerate(texts):
            for hashes in shingle_sets(text, self.known):
                for at in range(0, len(hashes), _CHUNK):
                    parts.append(hashes[at : at + _CHUNK])
                    owners.append(i)
                    held += len(parts[-1])
                    if held >= _CHUNK:
                        self._fold(out, parts, owners)
                        parts, owners, held = [], [], 0
        if parts:
            self._fold(out, parts, owners)
        return (out >> np.uint64(32)).astype(np.uint32)

    def _fold(self, out: np.ndarray, parts: list[np.ndarray], owners: list[int]) -> None:
        x = np.concatenate(parts) >> np.uint64(32)
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
        buffer = np.empty_like(x)
        low = np.empty((len(parts), len(self.a)), np.uint64)
        for p in range(len(self.a)):
            np.multiply(x, self.a[p], out=buffer)
            buffer += self.b[p]
            low[:, p] = np.minimum.reduceat(buffer, starts)
        np.minimum.at(out, np.array(owners), low)


def as_hex(signature: np.ndarray) -> str:
    """16 bits of each minimum."""
    return (signature & 0xFFFF).astype(">u2").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    return float(((one & 0xFFFF) == (other & 0xFFFF)).mean())


_SIGNED = T.StructType([
    T.StructField("same", T.LongType()), T.StructField("size", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
])


@F.pandas_udf(_SIGNED)
def _signed(text: pd.Series) -> pd.DataFrame:
    """Hash and size of each text's set of shingles, and its band keys."""
    signer = Signer()
    low = signer.sign(text.tolist()).reshape(len(text), BANDS, PERMUTATIONS // BANDS)
    bands = [[xxhash.xxh64_intdigest(b.tobytes(), k) - (1 << 63) for k, b in enumerate(each)] for each in low]
    sets = [_distinct(t, signer.known) for t in text]
    same = [xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63) for x in sets]
    return pd.DataFrame({"same": same, "size": [len(x) for x in sets], "bands": bands})


@F.pandas_udf(T.ArrayType(T.LongType()))
def _sets(text: pd.Series) -> pd.Series:
    known = Hashes()
    return pd.Series([_distinct(t, known) for t in text])


def _distinct(text: str | None, known: Hashes) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_sets(text, known)])).view(np.int64)


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each of ``left`` shares with each of ``right`` (places in ``sets``)."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
    out = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + _COLUMNS])
        has = np.zeros((len(sets), _COLUMNS), np.float32)
        has[owner[lo:hi], column[lo:hi] - at] = 1
        out += (has[left] @ has[right].T).astype(np.int64)
    return out


def _judge(frame: pd.DataFrame, similar: float) -> pd.DataFrame:
    """(same, root, links) of the members of two blocks of a bucket that are similar to one of the other block.

    A pair counts in the first of its buckets only.
    """
    i, j, band = (int(frame[c].iloc[0]) for c in ("i", "j", "band"))
    block, weight, labels = (frame[c].to_numpy(np.int64) for c in ("block", "weight", "same"))
    sets = [np.asarray(x, np.int64) for x in frame["shingles"]]
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    size = np.array([len(x) for x in sets])
    both = _common(sets, left, right)
    near = both >= similar * (size[left][:, None] + size[right][None, :] - both)
    keys, there = np.zeros((len(sets), BANDS), np.int64), np.zeros((len(sets), BANDS), bool)
    for at, (bands, values) in enumerate(zip(frame["bands"], frame["keys"], strict=True)):
        keys[at, bands], there[at, bands] = values, True
    for k in range(band):
        before = (keys[left, k][:, None] == keys[right, k][None, :]) & there[left, k][:, None] & there[right, k][None, :]
        near &= ~before
    if i == j:
        np.fill_diagonal(near, False)
    links = np.zeros(len(sets), np.int64)
    links[left] += near @ weight[right]
    if i != j:
        links[right] += near.T @ weight[left]
    roots, top = labels.copy(), np.iinfo(np.int64).max
    while True:
        old = roots.copy()
        if near.size:
            roots[left] = np.minimum(roots[left], np.where(near, roots[right][None, :], top).min(1))
            roots[right] = np.minimum(roots[right], np.where(near, roots[left][:, None], top).min(0))
        if (old == roots).all():
            break
    hit = links > 0
    return pd.DataFrame({"same": labels[hit], "root": roots[hit], "links": links[hit]})


def similar_sets(rows: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """(same, root, links) from each pair of blocks: a smaller linked set, and how many texts are linked."""
    open_ = sets.where("size > 0").select("same", "size", F.posexplode("bands").alias("band", "key"))
    # buckets of the same members are one: the first
    who = [F.bit_xor(F.xxhash64("same", F.lit(seed))).alias(f"who{seed}") for seed in (1, 2)]
    buckets = open_.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), *who)
    firsts = buckets.where("n > 1").groupBy("n", "total", "who1", "who2").agg(F.min(F.struct("band", "key")).alias("b"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / HELD)).cast("long")
    kept = materialise(firsts.select("b.band", "b.key", blocks.alias("blocks")), "buckets")
    members = open_.join(kept, ["band", "key"]).groupBy("same").agg(F.collect_list(F.struct("band", "key", "blocks")).alias("in"))
    members = materialise(members.join(sets.select("same", "node", "weight"), "same"), "members")
    names = members.select("node")
    names = F.broadcast(names) if names.count() <= BROADCAST else names
    texts = rows.join(names, "node").select("node", "text").dropDuplicates(["node"])
    each = texts.select("node", _sets("text").alias("shingles")).join(members, "node")
    each = each.select("same", "weight", "shingles", F.col("in.band").alias("bands"), F.col("in.key").alias("keys"), F.explode("in").alias("b"))
    block = F.pmod(F.xxhash64("same", F.lit(3)), F.col("b.blocks"))
    each = each.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b.blocks") - 1)))
    each = each.select(
        "same", "weight", "shingles", "bands", "keys", "block", F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"), "b.band", "b.key",
    )
    judge = lambda frame: _judge(frame, similar)
    return each.groupBy("band", "key", "i", "j").applyInPandas(judge, "same long, root long, links long")


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id, n_links) of every row: its class's smallest doc_id, and the texts linked to its own.

    A text is known by its 64-bit hash, and so is its set of shingles; texts of equal sets are linked. Texts
    without words are equal to one another and link to no other.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    prints = materialise(rows.select("doc_id", "node", _signed("text").alias("s")).select("doc_id", "node", "s.*"), "signatures")
    # copies first: a row for each text, then for each set
    least, of = F.min("doc_id").alias("doc_id"), [F.first("size").alias("size"), F.first("bands").alias("bands")]
    texts = prints.groupBy("node", "same").agg(least, *of)
    sets = texts.groupBy("same").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("doc_id").alias("doc_id"), *of)
    sets = materialise(sets, "sets")
    found = materialise(similar_sets(rows, sets, similar), "near")
    links = found.groupBy("same").agg(F.sum("links").alias("links"))
    roots = components(found.where("same != root").select(F.col("root").alias("a"), F.col("same").alias("b")).distinct())
    placed = sets.select("same", "size", "weight", "doc_id").join(links, "same", "left")
    placed = placed.join(roots.withColumnRenamed("node", "same"), "same", "left").withColumn("root", F.coalesce("root", "same"))
    placed = materialise(placed, "placed")
    names = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    n_links = F.when(F.col("size") > 0, F.col("weight") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("long")
    # written, so that Spark can split a text that many rows repeat
    verdicts = materialise(placed.join(names, "root").select("same", "class_id", n_links.alias("n_links")), "verdicts")
    return prints.select("doc_id", "same").join(verdicts, "same").select("doc_id", "class_id", "n_links")


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the beginning of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def dealt(docs: DataFrame) -> DataFrame:
    """Rows (part, peek, doc_id, text) in order of part, peek and descending id.

    Each part is a range of ids; its peek rows are the documents that follow its last one.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)
    top, found = ids.agg(F.max("doc_id"), cuts).head()
    # part k begins at starts[k - 1], descending; bounded by the number of partitions
    starts = np.array(sorted({int(c) for c in found or []} - {top}, reverse=True), np.int64)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def parts_of(doc_id: pd.Series) -> pd.Series:
        out = []
        for i in doc_id:
            if i is None:
                out.append([len(starts)])
                continue
            i = int(i)
            part = len(starts) - int(np.searchsorted(starts[::-1], i, "left"))
            out.append([part, *([-part] if part and starts[part - 1] == i else []), *([-len(starts) - 1] if i == top else [])])
        return pd.Series(out)

    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if top is None:
        each = each.withColumn("at", F.explode(F.array(F.lit(0), F.lit(-1))))
    else:
        # ids go through Python as text: beside a null, pandas would make them floats
        each = each.withColumn("at", F.explode(parts_of(F.col("doc_id").cast("string"))))
    peek = F.col("at") < 0
    each = each.select(F.when(peek, -F.col("at") - 1).otherwise(F.col("at")).alias("part"), peek.alias("peek"), "doc_id", "text")
    order = ["part", "peek", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    sorted_rows = each.repartition(parts, "part").sortWithinPartitions(*order)
    return sorted_rows.withColumn("doc_id", F.col("doc_id").cast("string"))


RESULT = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A result row for every row that is no peek row, from it and the row after it."""
    signer = Signer()
    last = None
    for frame in frames:
        rows = list(zip(frame["part"], frame["peek"], frame["doc_id"], frame["text"], signer.sign(frame["text"].tolist()), strict=True))
        pairs = []
        for row in rows:
            if last is not None and not last[1] and last[0] == row[0]:
                pairs.append((last, row))
            last = row
        changed = [edited(a[3], b[3]) for a, b in pairs]
        signs = signer.sign(changed)
        yield pd.DataFrame({
            "doc_id": [a[2] for a, _ in pairs],
            "n_chars": np.array([len(a[3]) for a, _ in pairs], np.int64),
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [as_hex(a[4]) for a, _ in pairs],
            "edited_fingerprint": [as_hex(s) for s in signs],
            "near_edited": np.array([likeness(a[4], s) for (a, _), s in zip(pairs, signs, strict=True)], float),
            "near_next": np.array([likeness(a[4], b[4]) for a, b in pairs], float),
        })


def op10_minhash_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, beside its edited text's and the next document's."""
    small_batches(spark)
    out = dealt(table(spark, sf_dir, "documents")).mapInPandas(compared, RESULT)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document, and how many texts are linked to its own."""
    small_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))
