"""Benchmark decontamination by a prefix-filtered join; DataFrame functions only.

A window is a run of ``window`` consecutive words of a benchmark item (all of a shorter one). To occur in a
document all its shingles must occur there, so it needs a prefix of one shingle only: its rarest.

1. One pass over the documents finds the positions of all benchmark shingles. That index is small beside the
   texts; the rarity order comes from its counts, over all documents.
2. Each window joins the index on its rarest shingle. The shingle's place in the window says where the
   window would begin (positional bound), which must leave room for the whole window (length bound).
3. What is left is verified: shingles that cover the window without a gap must stand at their exact places.

The benchmark's shingles are broadcast only if there are at most ``BROADCAST``; a bigger benchmark is joined by
a shuffle whose hot shingles adaptive execution splits.

Defined results: null and wordless texts have no words, hits or items and are clean; items without words
have no window; repeated items count once; rows that repeat id and text are judged alike, rows that repeat
the id only are judged each on its text; an empty benchmark finds nothing; extra columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.text import table
from tillwise.sources.scratch import materialise

WINDOW = 13
SHINGLE = 3
BROADCAST = 500_000  # shingles, some 50 MB
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ["__id", "__hash"]


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, _BREAKS), "")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, content, parts, length): every window of every item."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    length = F.least(F.size("w"), F.lit(window))
    each = items.withColumn("length", length).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("length"))))
    parts = F.slice("w", F.col("at") + 1, F.col("length"))
    return each.select("item_id", F.concat_ws(" ", parts).alias("content"), parts.alias("parts"), "length").distinct()


def shingles(wins: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(content, length, width, place, shingle) of every distinct window."""
    each = wins.select("content", "parts", "length").dropDuplicates(["content"])
    each = each.withColumn("width", F.least("length", F.lit(width)))
    each = each.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("width"))))
    token = F.concat_ws(" ", F.slice("parts", F.col("place") + 1, F.col("width")))
    return each.select("content", "length", "width", "place", token.alias("shingle"))


def index(docs: DataFrame, tokens: DataFrame, widths: list[int]) -> DataFrame:
    """Where ``tokens`` (shingle) occur in ``docs``: __id, __hash, n_words, pos, shingle.

    Every document also gets one row without shingle, which carries its number of words.
    """
    each = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id"), F.xxhash64("doc_id", "text").alias("__hash"),
        "doc_id", words(F.col("text")).alias("w"),
    )
    zipped = F.arrays_zip(*[F.slice("w", i + 1, F.greatest(F.size("w"), F.lit(1))).alias(f"w{i}") for i in range(max(widths))])
    # the last element is a null, so that a document without any match keeps its row
    each = each.select(*_KEY, "doc_id", F.size("w").alias("n_words"), F.posexplode(F.array_append(zipped, F.lit(None))))
    runs = [
        F.concat(F.col("col.w0"), *[x for i in range(1, n) for x in (F.lit(" "), F.col(f"col.w{i}"))]) for n in widths
    ]
    last = F.col("col").isNull()
    # the closing row has no run, and is not repeated for each width
    every = F.when(last, F.array(F.lit(None).cast("string"))).otherwise(F.array(*runs))
    each = each.withColumn("run", runs[0] if len(runs) == 1 else F.explode(every))
    found = each.select(*_KEY, "doc_id", "n_words", "pos", "run", last.alias("last")).join(
        tokens, F.col("run") == F.col("shingle"), "left"
    )
    found = found.where("last or shingle is not null")
    return found.select(*_KEY, "doc_id", "n_words", F.when(~F.col("last"), F.col("pos")).alias("pos"), "shingle")


def occurrences(spots: DataFrame, tokens: DataFrame) -> DataFrame:
    """(__id, __hash, start, length, content): every place where a window occurs, verified."""
    hits = spots.where("shingle is not null").drop("doc_id").distinct()
    rarity = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    # a window with a shingle that occurs nowhere drops out here
    rarest = F.min(F.struct("seen", "shingle", "place")).alias("r")
    complete = F.count("seen") == F.count(F.lit(1))
    ranked = tokens.join(rarity, "shingle", "left").groupBy("content", "length").agg(rarest, complete.alias("complete"))
    prefix = ranked.where("complete").select("content", "length", "r.shingle", "r.place")
    start = F.col("pos") - F.col("place")
    likely = hits.join(prefix, "shingle").withColumn("start", start)
    likely = likely.where("start >= 0 and start + length <= n_words").select(*_KEY, "start", "length", "content")
    cover = tokens.where("place % width = 0 or place = length - width").select("content", "place", "shingle")
    needed = likely.join(cover, "content").withColumn("pos", F.col("start") + F.col("place"))
    present = hits.select(*_KEY, "pos", "shingle", F.lit(1).alias("there"))
    checked = needed.join(present, [*_KEY, "pos", "shingle"], "left")
    whole = F.count("there") == F.count(F.lit(1))
    return checked.groupBy(*_KEY, "start", "length", "content").agg(whole.alias("whole")).where("whole").drop("whole")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, __id, __hash, n_words, n_hit, n_items, items, contaminated."""
    wins = materialise(windows(benchmark), "windows")
    tokens = materialise(shingles(wins), "shingles")
    # at most SHINGLE values
    widths = sorted(r["width"] for r in tokens.select("width").distinct().collect()) or [SHINGLE]
    names = tokens.select("shingle").distinct()
    names = F.broadcast(names) if names.count() <= BROADCAST else names
    spots = materialise(index(docs, names, widths), "spots")
    found = materialise(occurrences(spots, tokens), "occurrences")
    end = F.col("start") + F.col("length")
    before = Window.partitionBy(*_KEY).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), reached))
    covered = found.select(*_KEY, "start", "length").distinct().withColumn("fresh", fresh)
    n_hit = covered.groupBy(*_KEY).agg(F.sum("fresh").cast("long").alias("n_hit"))
    held = found.select(*_KEY, "content").distinct().join(wins.select("content", "item_id"), "content")
    items = held.groupBy(*_KEY).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    rows = spots.where("pos is null").select(*_KEY, "doc_id", F.col("n_words").cast("long").alias("n_words"))
    rows = rows.join(n_hit.join(items, _KEY), _KEY, "left")
    rows = rows.withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    rows = rows.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    dirty = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return rows.withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", dirty)


def op3_prefix_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    sha = F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256")
    return out.select("doc_id", "n_words", "n_hit", "n_items", sha, "contaminated")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go."""
    dirty = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    dirty = dirty.select(F.col("doc_id").alias("__id"), F.col("__hash").alias("__of")).distinct()
    marked = docs.withColumn("__hash", F.xxhash64("doc_id", "text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__of"))
    return marked.join(dirty, same, "left_anti").select(*docs.columns)


_SQL_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[p + 1:p + least(13, len(w))], ' ') AS content
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 12, 1))) AS p FROM i WHERE len(w) > 0)
),
dw AS (
  SELECT rid, p, k, array_to_string(w[p + 1:p + k], ' ') AS content
  FROM (SELECT rid, w, k, unnest(range(0, len(w) - k + 1)) AS p
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)
),
hit AS (SELECT DISTINCT rid, p, dw.k, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.content = iw.content),
places AS (
  SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(p, p + k)) AS x FROM hit) GROUP BY rid
),
names AS (
  SELECT rid, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS name FROM hit) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN names USING (rid)
"""
