"""Repeated runs of lines, found with a suffix array over line numbers; DataFrame functions only.

Every document is its sequence of lines that hold a word. Lines that occur once cannot be in a repeated run, so
only the islands of lines that occur again are kept (narrow rows, without text).

1. Prefix doubling: the rank of a position by its first line, then by pairs of ranks at distance 1, 2, 4, ...
   A rank is the place of the position's interval in the suffix array, that is the number of suffixes that
   sort before it by their first 2^k lines. Each round sorts the distinct pairs by ranges and sums their
   counts within and across the ranges, so a line that a third of the corpus holds is spread like any other.
2. Intervals of a common prefix: two runs of n lines are equal if their first and their last 2^k lines have
   equal ranks, 2^k <= n < 2^(k+1). For every line the shortest run from it, and up to it, of ``least`` words
   is looked up so; runs with equal ranks are one interval, and all but the first in document order are copies.
   A repeated run of ``least`` words or more is the union of such runs, so all its lines are found, and no other.
3. The lines of copies are deleted. The first copy, by doc_id and line, stays.

A run of ``least`` words has at most ``least`` lines, so the number of rounds is a constant (6 for 50 words).

Defined results: null and empty texts have one empty line and keep it; lines without a word are kept and do
not break a run; null ids come last in document order; rows that repeat id and text are one document with
one result, rows that repeat the id only follow by the text's hash; lines are told apart by 128 bits of hash;
an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.text import table
from tillwise.sources.scratch import materialise

LEAST = 50
_BLANKS = r"[\x20\x09-\x0D]+"
_DOC = ["doc_id", "hash"]


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, hash, seq (among lines with a word), line, h1, h2, n_words."""
    each = F.transform(F.split(_text(F.col("text")), "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    worded = F.filter(each, lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(
        "doc_id", F.xxhash64("doc_id", _text(F.col("text"))).alias("hash"), F.posexplode(worded).alias("seq", "s")
    )
    words = F.size(F.array_remove(F.split("s.x", _BLANKS), ""))
    return rows.select(
        *_DOC, "seq", "s.line", F.xxhash64("s.x").alias("h1"), F.xxhash64("s.x", F.lit(1)).alias("h2"), words.alias("n_words")
    )


def suffix_ranks(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """(by, rank) of the distinct ``by``: how many ``rows`` sort before them."""
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    ranged = counts.repartitionByRange(*by).withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, label)  # now a row's range is fixed
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per range
    starts = ranged.groupBy("part").agg(F.sum("n").alias("n")).select("part", before(Window.orderBy("part")).alias("start"))
    inner = ranged.withColumn("inner", before(Window.partitionBy("part").orderBy(*by)))
    return inner.join(starts, "part").select(*by, (F.col("start") + F.col("inner")).alias("rank"))


def _rejoin(rows: DataFrame, ranks: DataFrame, by: list[str], name: str) -> DataFrame:
    return rows.join(ranks.withColumnRenamed("rank", name), by).drop(*by)


def repeated_islands(docs: DataFrame, label: str = "lines") -> DataFrame:
    """Lines that occur again, with their island: a run of such lines in one document."""
    every = materialise(lines(docs), label)
    again = every.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # written, so that both sides of the join are shuffled for it: only then can Spark split a hot line
    again = materialise(again, "again")
    kept = every.join(again, ["h1", "h2"]).dropDuplicates([*_DOC, "seq"])
    nth = F.row_number().over(Window.partitionBy(*_DOC).orderBy("seq"))
    return kept.withColumn("island", F.col("seq") - nth)


def ranked(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """``rows`` with ``ranks``: by the first 1, 2, 4, ... lines; null where the island ends before."""
    island = Window.partitionBy(*_DOC, "island").orderBy("seq")
    out = _rejoin(rows, suffix_ranks(rows, ["h1", "h2"], "rank-0"), ["h1", "h2"], "r0")
    names, reach = ["r0"], 1
    while 2 * reach <= least:
        last, name = names[-1], f"r{len(names)}"
        paired = out.withColumn("a", F.col(last)).withColumn("b", F.lead(last, reach).over(island))
        paired = materialise(paired, f"pairs-{len(names)}")
        whole = paired.where("a is not null and b is not null")
        # a pair that stands once is in no repeated run of this length, but still sorts among the others
        out = paired.join(suffix_ranks(whole, ["a", "b"], name).withColumnRenamed("rank", name), ["a", "b"], "left").drop("a", "b")
        names.append(name)
        reach *= 2
    return out.withColumn("ranks", F.array(*names)).drop(*names)


def copies(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, hash, first, last) in seq: runs of ``least`` words or more that stand earlier too. Repeats possible."""
    island = Window.partitionBy(*_DOC, "island")
    end = F.sum("n_words").over(island.orderBy("seq"))
    rows = rows.withColumn("end", end).withColumn("begin", F.col("end") - F.col("n_words"))
    rows = rows.withColumn("whole", F.max("end").over(island))
    ahead = F.count(F.lit(1)).over(island.orderBy("begin").rangeBetween(0, least - 1))
    behind = F.count(F.lit(1)).over(island.orderBy("end").rangeBetween(-(least - 1), 0))
    rows = materialise(rows.withColumn("ahead", ahead).withColumn("behind", behind), "ranked-lines")
    seq = F.col("seq")
    onward = rows.where(F.col("whole") - F.col("begin") >= least).select(*_DOC, seq.alias("first"), (seq + F.col("ahead") - 1).alias("last"))
    back = rows.where(F.col("end") >= least).select(*_DOC, (seq - F.col("behind") + 1).alias("first"), seq.alias("last"))
    runs = onward.unionByName(back).distinct()
    n = F.col("last") - F.col("first") + 1
    level = F.floor(F.log2(n + 0.5)).cast("int")
    runs = runs.withColumn("n", n).withColumn("level", level)
    # where the last 2^level lines of the run begin
    runs = runs.withColumn("tail", F.col("last") - F.pow(F.lit(2), F.col("level")).cast("long") + 1)
    same = lambda of, place: [F.col("t.doc_id").eqNullSafe(F.col("o.doc_id")), F.col("t.hash") == F.col("o.hash"), F.col(f"t.{place}") == F.col("o.seq")]
    ranks = rows.select(*_DOC, "seq", "ranks").alias("o")
    keyed = runs.alias("t").join(ranks, same("o", "first")).select("t.*", F.get("o.ranks", F.col("t.level")).alias("a"))
    keyed = keyed.alias("t").join(ranks, same("o", "tail")).select("t.*", F.get("o.ranks", F.col("t.level")).alias("b"))
    keyed = keyed.withColumn("place", F.struct(F.col("doc_id").isNull().alias("unset"), *_DOC, "first"))
    firsts = keyed.groupBy("n", "a", "b").agg(F.min("place").alias("origin"), F.count(F.lit(1)).alias("seen"))
    firsts = materialise(firsts.where("seen > 1").drop("seen"), "firsts")  # written for the same reason
    found = keyed.join(firsts, ["n", "a", "b"])
    return found.where("place > origin").select(*_DOC, "first", "last")


def deletions(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, hash, gone, gone_words): numbers of the lines to delete, ascending, and their words."""
    rows = materialise(ranked(repeated_islands(docs), least), "suffixes")
    runs = copies(rows, least)
    hit = runs.select(*_DOC, F.explode(F.sequence("first", "last")).alias("seq")).distinct()
    same = F.col("h.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("h.hash") == F.col("r.hash")) & (F.col("h.seq") == F.col("r.seq"))
    named = hit.alias("h").join(rows.alias("r"), same).select("h.doc_id", "h.hash", "r.line", "r.n_words")
    return named.groupBy(*_DOC).agg(
        F.sort_array(F.collect_list("line")).alias("gone"), F.sum("n_words").cast("long").alias("gone_words")
    )


def deduplicated(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_deleted, deleted_words and the text that is left, for every row of ``docs``."""
    gone = deletions(docs, least).select(F.col("doc_id").alias("of"), F.col("hash").alias("of_hash"), "gone", "gone_words")
    rows = docs.select("doc_id", _text(F.col("text")).alias("text"), F.xxhash64("doc_id", _text(F.col("text"))).alias("hash"))
    both = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("of_hash")), "left")
    # a generator, so that the lines are split once and not for every line
    split = both.select("doc_id", "text", "gone", "gone_words", F.explode(F.array(F.split("text", "\n"))).alias("w"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("w") - 1), F.col("gone"))
    left = F.array_join(F.transform(stays, lambda i: F.get(F.col("w"), i)), "\n")
    return split.select(
        "doc_id", F.size("w").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"),
        F.coalesce("gone_words", F.lit(0)).cast("long").alias("deleted_words"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"),
    )


def op5_suffix_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup deletes from every document, and the checksum of what is left."""
    out = deduplicated(table(spark, sf_dir, "documents"))
    return out.withColumn("kept_sha256", F.sha2(F.col("text").cast("binary"), 256)).drop("text")


SQL = """
WITH l AS (
  SELECT doc_id, line, x, len(list_filter(regexp_split_to_array(x, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS n_words
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM documents)
),
q AS (
  SELECT *, row_number() OVER d AS seq, sum(n_words) OVER d AS stop, sum(n_words) OVER d - n_words AS start
  FROM l WHERE n_words > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY line)
),
runs AS (
  SELECT doc_id, seq AS a, seq - 1 + count(*) OVER (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING) AS b
  FROM q
  UNION
  SELECT doc_id, seq + 1 - count(*) OVER (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN 49 PRECEDING AND CURRENT ROW), seq
  FROM q
),
fit AS (
  SELECT r.doc_id, a, b, string_agg(x, chr(10) ORDER BY seq) AS content
  FROM runs r JOIN q ON q.doc_id = r.doc_id AND seq BETWEEN a AND b
  GROUP BY r.doc_id, a, b HAVING sum(n_words) >= 50
),
again AS (
  SELECT doc_id, a, b FROM (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, a) AS nth FROM fit) WHERE nth > 1
),
gone AS (SELECT DISTINCT q.doc_id, line FROM again g JOIN q ON q.doc_id = g.doc_id AND seq BETWEEN a AND b)
SELECT l.doc_id, count(*) AS n_lines, count(g.line) AS n_deleted,
  CAST(coalesce(sum(n_words) FILTER (g.line IS NOT NULL), 0) AS BIGINT) AS deleted_words,
  sha256(coalesce(string_agg(x, chr(10) ORDER BY l.line) FILTER (g.line IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line
GROUP BY l.doc_id
"""
