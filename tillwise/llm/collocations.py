"""Phrase collocations by dynamic itemset counting: lengths are counted together in cyclic scans of shards.

Documents are dealt once into ``SHARDS`` shards, which are scanned in turn, again and again. Words are counted from
the first scan on. A longer phrase becomes active as soon as both phrases of one word less within it have reached the
threshold in the shards seen so far, wherever in the cycle that happens, and is counted in the scans of one full cycle
from then on. Scanning ends when no active phrase has shards left. A phrase that reaches the threshold has parts that
do, so every such phrase is found.

How that is spread:

- What tasks must know to tell active phrases is which shorter ones have reached the threshold, and in which scan.
  Each scan's new ones are a Bloom filter per length, of at most ``FILTER_BITS`` bits whatever the corpus, sent to the
  executors once. A false hit only makes a task count a phrase that nobody asked for.
- Tasks take the words of a batch as Arrow dictionary codes and count phrases of codes, so a phrase comes out once
  per batch however often it occurs. A task has few batches of a language, so Spark adds up after the shuffle only. While
  it is open which phrases reach the threshold, they travel as hashes of 93 bits and their length.
- The state holds one row per hash in progress: its count, the shards in that count (a shard never counts twice), the
  last scan that counts it, and the scan in which it reached the threshold. It is written anew after each scan; a hash
  whose scans are over without reaching the threshold is dropped, also if some shards did not have it.
- What has reached the threshold is counted once more by its text, and these counts decide and are reported.

The report scores each phrase by its weakest cut, leaves out what a longer phrase covers, and ranks by language in two
steps, so that no task sees all phrases of one language.

Defined results: a null text has no words; a null lang is ``und`` (and shares it with rows that say so); repeated rows
and ids count each; a document may be of any length, it is read in pieces of which each repeats the last words of the
one before; ties in score go to the larger count, then to the phrase in byte order; a language without candidates and
an empty table give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.text import pieces, shared, small_batches, table
from tillwise.sources.scratch import discard, materialise, scratch_path

LEAST = 30
LONGEST = 4
SHARDS = 2
TOP = 2000
SCALE = 2_000_000
COVER = (80, 100)  # a longer phrase covers a shorter one from this share of its count on
FILTER_BITS = 1 << 26  # at most, per length and scan
_PER_MEMBER = 16
_SALTS = 64
_BATCH = 4 << 20
_LONG = 1 << 20

# A-Z become lower case, the ends of pieces a line feed, tabs a blank; all are single bytes in UTF-8.
_BETWEEN = b"\n "
_FOLD = bytes(range(256)).lower().translate(bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n "))
_IN_WORD = bytes(byte not in _BETWEEN for byte in range(256))
_HASHED = "h long, g int, fresh long, until int"
_STATE = "h long, g int, n long, shards int, reached int, until int"
_COUNTED = "lang string, phrase string, k int, n long"


def _mix(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes (two columns) of phrases from those of their heads and last words."""
    x = head * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


# Where a hash has its bits: three slices of it.
_SLICES = (0, 18, 37)


@dataclass
class Filter:
    """Bloom filter of the phrases of one length that reached the threshold in one scan."""

    scan: int
    bits: int
    words: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for shift in _SLICES:
            at = (hashes >> np.uint64(shift)) & np.uint64(self.bits - 1)
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


@dataclass
class Scan:
    """What a task needs for one scan of a shard, or for the last one (``number`` is None), which counts by text."""

    number: int | None
    shards: int
    longest: int
    filters: dict[int, list[Callable[[], Filter]]] = field(default_factory=dict)

    def masks(self, k: int, hashes: np.ndarray) -> np.ndarray:
        """For each hash (its first column counts), a bit for every scan in which it may have reached the threshold; one 0 more at the end."""
        out, hashes = np.zeros(len(hashes) + 1, np.uint64), hashes[:, 0]
        for get in self.filters.get(k, []):
            one = get()
            out[:-1] |= one.has(hashes).astype(np.uint64) << np.uint64(one.scan)
        return out

    def window(self) -> np.uint64:
        """The scans whose news start a cycle that is not over."""
        return np.uint64(sum(1 << j for j in range(max(0, self.number - self.shards), self.number)))

    def until(self, masks: np.ndarray) -> np.ndarray:
        """The last scan that counts a phrase, unless there is more news: its latest news is the highest bit."""
        return np.frexp(masks.astype(np.float64))[1] - 1 + self.shards


def _hashed(k: int, hashes: np.ndarray, counts: np.ndarray, until: np.ndarray) -> pa.RecordBatch:
    more = (hashes[:, 1] >> np.uint64(32)).astype(np.uint32) & np.uint32(0xFFFFFFF8) | np.uint32(k)
    columns = [np.ascontiguousarray(hashes[:, 0]).view(np.int64), more.view(np.int32), counts.astype(np.int64), until.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "g", "fresh", "until"])


def _named(lang: str, k: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    n = len(counts)
    columns = [pa.repeat(lang, n), phrases.view(pa.string()), pa.array(np.full(n, k, np.int32)), pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "k", "n"])


def count_batch(lang: str, folded: bytes, carried: int, scan: Scan) -> Iterator[pa.RecordBatch]:
    """Counts of words and phrases in texts of one language; the first ``carried`` words were counted before."""
    folded = b"\n" + folded + b"\n"
    inside = np.frombuffer(folded.translate(_IN_WORD), np.uint8)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if len(starts) <= carried:
        return
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(folded.translate(None, _BETWEEN))]
    encoded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    codes, words = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    digests = map(xxhash.xxh3_128_digest, words.to_pylist(), repeat(seed))
    own = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    masks, exact = scan.masks(1, own), scan.number is None
    if exact:
        yield _named(lang, 0, pa.array([b""]), np.array([len(codes) - carried]))
    if exact or scan.number < scan.shards:
        counts = np.bincount(codes[carried:], minlength=len(words))
        out = np.flatnonzero((counts > 0) & (masks[:-1] != 0) if exact else counts > 0)
        yield _named(lang, 1, words.take(pa.array(out)), counts[out]) if exact else _hashed(1, own[out], counts[out], np.full(len(out), scan.shards - 1))
    # whether the next word is of the same piece
    same = np.ones(len(starts) + 1, bool)
    same[np.searchsorted(starts, np.flatnonzero(np.frombuffer(folded, np.uint8) == 10))] = False
    same = same[1:-1]
    # the phrases of k - 1 words: a number at each position (-1: none that may be frequent), hashes and masks by number
    numbers, hashes = codes, own
    for k in range(2, scan.longest + 1):
        here = masks[numbers]
        both = (here[:-1] != 0) & (here[1:] != 0)
        at = np.flatnonzero(both & same if k == 2 else both)
        if not len(at):
            return
        each, kinds = pd.factorize(numbers[at] * len(words) + codes[at + k - 1])
        first = np.empty(len(kinds), np.int64)
        first[each[::-1]] = at[::-1]
        counts = np.bincount(each[at + k > carried], minlength=len(kinds))
        head, tail = numbers[first], numbers[first + 1]
        hashed = _mix(hashes[head], own[codes[first + k - 1]])
        new = scan.masks(k, hashed) if exact or k < scan.longest else None
        if exact:
            out = np.flatnonzero((counts > 0) & (new[:-1] != 0))
            parts = [words.take(pa.array(codes[first[out] + j])) for j in range(k)]
            yield _named(lang, k, pc.binary_join_element_wise(*parts, b" "), counts[out])
        else:
            news = masks[head] | masks[tail]
            out = np.flatnonzero((counts > 0) & (news & scan.window() != 0))
            yield _hashed(k, hashed[out], counts[out], scan.until(news[out]))
        if k < scan.longest:
            numbers = np.full(len(numbers) - 1, -1, np.int64)
            numbers[at] = each
            hashes, masks = hashed, new


def _long(lang: str, text: bytes, scan: Scan) -> Iterator[pa.RecordBatch]:
    """Counts of one long text, piece by piece."""
    tail: list[bytes] = []
    for part in pieces(text, _LONG):
        folded = b" ".join([*tail, b""]) + part.translate(_FOLD)
        yield from count_batch(lang, folded, len(tail), scan)
        # only the last line can go on
        tail = folded[folded.rfind(b"\n") + 1 :].split()[1 - scan.longest :]


def counted(batches: Iterator[pa.RecordBatch], scan: Scan) -> Iterator[pa.RecordBatch]:
    """Counts of all rows (lang, text), a few megabytes of one language at a time."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    flush = lambda lang: count_batch(lang, b"\n".join(held.pop(lang)).translate(_FOLD), 0, scan)
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
            if len(text) > _LONG:
                yield from _long(lang, text, scan)
                continue
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            if sizes[lang] >= _BATCH or sum(sizes.values()) >= 2 * _BATCH:
                most = max(sizes, key=sizes.get)
                del sizes[most]
                yield from flush(most)
    for lang in list(held):
        yield from flush(lang)


def _length() -> Column:
    """The length of a phrase is in its second hash."""
    return F.col("g").bitwiseAND(7)


def _stepped(state: DataFrame | None, counts: DataFrame, scan: Scan, least: int) -> DataFrame:
    """The state after a scan: counts of shards that were not in it are added."""
    bit = 1 << scan.number % scan.shards
    new = counts.selectExpr("h", "g", "fresh", "until", "0L AS n", "0 AS shards", "CAST(NULL AS INT) AS reached")
    if state is not None:
        new = new.unionByName(state.withColumn("fresh", F.lit(0).cast("long")))
    # the rows of a task are nearly all different, so they are not added up before they are dealt
    merged = new.repartition("h", "g").groupBy("h", "g").agg(
        F.sum("fresh").alias("fresh"), F.max("until").alias("until"), F.max("n").alias("n"),
        F.max("shards").alias("shards"), F.max("reached").alias("reached"),
    )
    adds = (F.col("fresh") > 0) & (F.col("shards").bitwiseAND(bit) == 0)
    merged = merged.select(
        "h", "g", (F.col("n") + F.when(adds, F.col("fresh")).otherwise(0)).alias("n"),
        F.when(adds, F.col("shards") + bit).otherwise(F.col("shards")).alias("shards"), "reached", "until",
    )
    merged = merged.withColumn("reached", F.coalesce("reached", F.when(F.col("n") >= least, scan.number)))
    # in progress: not all shards are in the count, and it will be counted again
    going = (F.col("shards") != (1 << scan.shards) - 1) & (F.col("until") > scan.number)
    return merged.where(F.col("reached").isNotNull() | going)


def _news(state: DataFrame, number: int) -> dict[int, Filter]:
    """A filter for each length of the phrases that have just reached the threshold."""
    new = state.where(F.col("reached") == number).select("h", _length().alias("k"))
    found = {r["k"]: r["n"] for r in new.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {k: min(FILTER_BITS, max(1 << 10, 1 << (n * _PER_MEMBER - 1).bit_length())) for k, n in found.items()}
    if not sizes:
        return {}
    low = F.lit(None)
    for k, bits in sizes.items():
        low = F.when(F.col("k") == k, F.lit(bits - 1)).otherwise(low)
    places = F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(low.cast("long")) for s in _SLICES])
    placed = new.select("k", F.explode(places).alias("place"))
    one = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    words = placed.groupBy("k", F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("value"))
    # at most FILTER_BITS / 64 rows for each length
    rows, out = words.toPandas(), {}
    for k, bits in sizes.items():
        own = rows[rows["k"] == k]
        value = np.zeros(bits // 64, np.uint64)
        value[own["word"].to_numpy()] = own["value"].to_numpy().astype(np.int64).view(np.uint64)
        out[k] = Filter(number, bits, value)
    return out


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, k, n) of every phrase of 1 to ``longest`` words that occurs ``least`` times in a language.

    Rows with k = 0 have the number of all word occurrences of a language.
    """
    if not 2 <= longest <= 7:
        raise ValueError("phrases have 2 to 7 words")
    spark = docs.sparkSession
    small_batches(spark)
    path = scratch_path(spark, "phrase-shards")
    rows = docs.where(F.length("text") > 0).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), "text",
        F.pmod(F.xxhash64("text", "doc_id"), F.lit(shards)).cast("int").alias("shard"),
    )
    rows.write.partitionBy("shard").parquet(path)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(path)
    filters: dict[int, list] = {}
    state, held, latest = None, None, -shards
    for number in range(longest * shards):
        if number >= shards and latest < number - shards:
            break  # nothing that became frequent has its cycle ahead
        scan = Scan(number, shards, longest, filters)
        shard = dealt.where(F.col("shard") == number % shards).select("lang", "text")
        counts = shard.mapInArrow(lambda batches, scan=scan: counted(batches, scan), _HASHED)
        written = scratch_path(spark, "phrase-state")
        _stepped(state, counts, scan, least).write.parquet(written)
        if held:
            discard(spark, held)
        state, held = spark.read.schema(_STATE).parquet(written), written
        for k, one in _news(state, number).items():
            filters = {**filters, k: [*filters.get(k, []), shared(spark, one)]}
            latest = number
    scan = Scan(None, shards, longest, filters)
    exact = dealt.select("lang", "text").mapInArrow(lambda batches: counted(batches, scan), _COUNTED)
    exact = exact.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.max("k").alias("k"), F.sum("n").alias("n"))
    exact = materialise(exact.where((F.col("k") == 0) | (F.col("n") >= least)), "phrase-counts")
    discard(spark, held)
    discard(spark, path)
    return exact


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def collocations(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language, from ``frequent_phrases``."""
    counts = phrases.where("k > 0").select("lang", "phrase", "n")
    totals = phrases.where("k = 0").select("lang", F.col("n").alias("total"))
    longer = phrases.where("k > 1").withColumn("words", F.split("phrase", " "))
    run = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = longer.select(
        "lang", "phrase", "k", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    )
    cuts = cuts.select(
        "lang", "phrase", "k", "a", "cut", run(F.lit(1), F.col("cut")).alias("head"),
        run(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    score = F.call_function("div", _wide("a") * F.lit(SCALE).cast("decimal(7,0)"), _wide("l") + _wide("r"))
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.max("k").alias("k"), F.max("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("least")
    )
    # every run of two words or more within a longer phrase, with the largest count around it
    lengths = F.sequence(F.lit(2), F.col("k") - 1)
    starts = F.transform(lengths, lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: run(i, m)))
    inner = longer.where("k > 2").select("lang", F.explode(F.flatten(starts)).alias("phrase"), "n")
    around = inner.groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    kept = weakest.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (_wide("around") * COVER[1] < _wide("a") * COVER[0])
    )
    kept = kept.select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    some = kept.withColumn("salt", salt).withColumn("nth", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    few = some.where(F.col("nth") <= top).drop("salt", "nth")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    best = ranked.where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations(frequent_phrases(table(spark, sf_dir, "documents")))


SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text <> ''),
lines AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
runs AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lines),
sized AS (
    SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM runs),
f AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS n
    FROM sized GROUP BY ALL HAVING k = 1 OR count(*) >= 30),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
scored AS (
    SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.n AS l, y.n AS r, (2000000 * c.a) // (x.n + y.n) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_starts AS (SELECT lang, a, w, k, unnest(range(1, k)) AS i FROM candidates WHERE k > 2),
inner_runs AS (SELECT lang, a, w, k, i, unnest(range(2, least(k - 1, k - i + 1) + 1)) AS m FROM inner_starts),
around AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS around FROM inner_runs GROUP BY ALL),
kept AS (
    SELECT s.* FROM weakest s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
    WHERE o.around IS NULL OR 100 * o.around < 80 * s.a),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
    CAST(r AS BIGINT) AS r, totals.n AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000"""
