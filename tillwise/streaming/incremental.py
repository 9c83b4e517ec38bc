"""Incremental load: new feed files are appended in bounded batches, exactly once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import month_label
from tillwise.operators.cleanse import REJECT, ROW, accepted, marked, row_bits, type_transactions
from tillwise.operators.joins import look_up
from tillwise.plans.load import DIMENSIONS, READ, Hot, rejects_table, repair
from tillwise.schemas import STAR
from tillwise.sources import keyindex, snapshots
from tillwise.sources.feeds import FILE, MALFORMED, NTH, ORDINAL, SPLIT, headers, literal, normalise, path_orders, scan, with_path_order
from tillwise.sources.scratch import discard, materialise
from tillwise.sources.warehouse import FACTS, MONTH, REJECTS, indexed, part_of, read_months, read_table, written

_KEY = STAR[FACTS].key

# What Spark's source of whole files declares.
_LISTED = "path string, modificationTime timestamp, length long, content binary"

# Note of the store: for each stream, how far it is in the tables: number of a listing, and how many of its files by name.
BATCHES = "batches"

_LISTING = 100_000  # names at most that the driver gets at a time
BATCH_BYTES = 256 << 20  # of files; a batch grows no further
_GROWTH = 8  # of the number of files from a batch to the next; each batch has some forty jobs of its own


def _cut(files: list[tuple[str, int]], first: int) -> Iterator[list[str]]:
    """Names of (name, bytes) in batches: ``first`` files, twice, four times, then eight times as many as before each time, while
    they fit ``BATCH_BYTES``.

    So many small files that wait together are few batches, as each has costs of its own, while the bytes of a batch stay
    bounded. ``first`` files are taken whatever their size.
    """
    at, most = 0, first
    while at < len(files):
        some, held = [], 0
        for name, size in files[at : at + most]:
            if len(some) >= first and held + size > BATCH_BYTES:
                break
            some.append(name)
            held += size
        yield some
        at, most = at + len(some), most * (2 if most < 4 * first else _GROWTH)


def _behind(state: snapshots.Manifest, checkpoint: str, listing: int) -> int:
    """How many files of a listing, in the order of their names, are in the tables already."""
    done = state.notes.get(BATCHES, {}).get(checkpoint, [-1, 0])
    # a store of before has the number alone: all of the listing is in
    last, files = done if isinstance(done, list) else (done, _LISTING)
    return files if last == listing else _LISTING * (last > listing)


def _new_files(
    spark: SparkSession, raw_dir: str, root: str, checkpoint: str, files_per_batch: int,
    take: Callable[[list[str], str, snapshots.Manifest], snapshots.Manifest],
) -> None:
    """Have ``take`` put the new files of a folder into the store under ``root``, batch by batch, then stop.

    The stream has the names and sizes of files only: their content is not asked for, so nothing is read here, and each
    batch can read its files by their own headers. ``take`` gets the files, a name for the batch and the state, and
    returns the new state, which is committed with the place reached. A listing that did not end is gone through again
    with the same files, from that place on.
    """

    def each(rows: DataFrame, listing: int) -> None:
        # at most ``_LISTING`` names; the source may give one of them twice
        files = sorted({(r.path, r.length) for r in rows.collect()})
        at = _behind(snapshots.current(spark, root), checkpoint, listing)
        for paths in _cut(files[at:], files_per_batch):
            state = take(paths, f"batch={listing}-{at}", snapshots.current(spark, root))
            at += len(paths)
            done = {**state.notes.get(BATCHES, {}), checkpoint: [listing, at]}
            snapshots.commit(spark, root, state.with_note(BATCHES, done))

    names = spark.readStream.format("binaryFile").schema(_LISTED).option("maxFilesPerTrigger", _LISTING)
    found = names.load(raw_dir).select("path", "length")
    (
        found.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _rows_of(spark: SparkSession, feed: str, paths: list[str], multiline: bool) -> DataFrame | None:
    """Rows of files as text, with malformed mark, file, split and number; nothing if all are empty."""
    found = headers(spark, [literal(p) for p in paths])
    return normalise(scan(spark, feed, found, multiline), STAR[feed]) if found else None


def load_new_files(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    landing: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    multiline: bool = False,
) -> None:
    """Bring the fact table under ``root`` up to date with the files not yet seen, then stop.

    After any number of batches the table has the rows that one load of all files would have: for each id, in whichever
    month, the acceptable row that stands first in the feed, by file order. Each batch types its own files only and
    appends to the months it has rows for; the first takes ``files_per_batch`` files, see ``_cut``. An index of keys tells
    which ids the table has; only the buckets that may hold an id of the batch are read. If an id comes again from a file
    that stands before the one it was loaded from, the old row gives way: its month is written anew, the only case in
    which old rows are read.

    Facts, index, rows left out and counts change together, with the place the stream has reached, so a batch that dies
    leaves nothing, and one that Spark runs again after its commit is passed over. Rows are judged by the dimensions of the
    time. ``landing`` holds the typed rows of the batch under way.
    """

    def take(paths: list[str], batch: str, state: snapshots.Manifest) -> snapshots.Manifest:
        rows = _rows_of(spark, FACTS, paths, multiline)
        if rows is None:
            return state
        place = F.struct(F.col(FILE).alias("file"), F.col(SPLIT).alias("split"), F.col(NTH).alias("row"))
        state = _taken(rows.withColumn(ORDINAL, place).drop(NTH), root, f"{landing}/{batch}", state)
        discard(spark, f"{landing}/{batch}")
        return state

    _new_files(spark, raw_dir, root, checkpoint, files_per_batch, take)


def _taken(raw: DataFrame, root: str, folder: str, state: snapshots.Manifest) -> snapshots.Manifest:
    """The state of the store with a batch of raw rows in it; everything is written, nothing committed."""
    spark = raw.sparkSession
    state = indexed(spark, root, state)
    dimensions = {name: read_table(spark, root, name, state) for name in DIMENSIONS}
    counted = Observation()
    # written with the rows, so that a number stays with its row
    typed = type_transactions(raw).withColumns({MONTH: month_label(F.col("transaction_date")), ROW: F.monotonically_increasing_id()})
    typed.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
    landed = spark.read.schema(typed.schema).parquet(folder)
    # one row for each file of the batch
    files = path_orders(landed.select(F.col(f"{ORDINAL}.file").alias("path")).distinct())
    landed = with_path_order(landed, F.col(f"{ORDINAL}.file"), files, FILE)
    landed = landed.withColumn(ORDINAL, F.col(ORDINAL).withField("file", F.col(FILE))).drop(FILE)

    # the verdict on each row, on few columns
    sold = dimensions["products"].select("product_id", F.lit(True).alias("_sold"))
    found = look_up(landed.select(_KEY, ORDINAL, MONTH, ROW, "product_id", REJECT), sold, "product_id", F.col(_KEY))
    reason = F.coalesce(REJECT, F.when(F.col("_sold").isNull(), F.lit("product_id: unknown")))
    judged = materialise(found.select(_KEY, ORDINAL, MONTH, ROW, reason.alias("reason")), "batch-verdicts")
    good = judged.where(F.col("reason").isNull())
    first = good.groupBy(F.col(_KEY).alias("key")).agg(F.min(F.struct(ORDINAL, MONTH)).alias("first"))
    first = materialise(first.select("key", F.col(f"first.{ORDINAL}").alias("place"), F.col(f"first.{MONTH}").alias("month")), "batch-keys")
    known = keyindex.lookup(spark, root, state, first)
    known = known.select("key", F.lit(True).alias("known"), F.col("place").alias("old_place"), F.col("month").alias("old_month"))
    # rows of which no place is known came before all files
    claims = first.join(known, "key", "left").where(F.col("known").isNull() | (F.col("place") < F.col("old_place")))
    claims = materialise(claims, "batch-claims")

    # narrow rows meet the claims; the hint, as places are packed so well that by the size of their files they would be
    # gathered on the driver for a broadcast
    places = claims.select(F.col("key").alias(_KEY), F.col("place").alias(ORDINAL), F.lit(True).alias("_wins")).hint("merge")
    ruled = materialise(good.join(places, [_KEY, ORDINAL], "left").select(_KEY, ROW, "_wins"), "batch-ruled")
    bits = materialise(row_bits(ruled.where("_wins")), "batch-bits")
    hot = Hot()
    hot.rows = counted.get["rows"]
    winners = accepted(marked(landed, bits, "_wins", hot.rows)).where("_wins")
    # rows of a batch are of all months: without the column they are spread by month before they are written
    fresh = written(repair(winners, dimensions["customers"], dimensions["stores"], hot).drop(MONTH), root, FACTS)
    facts = snapshots.added(_given_way(spark, root, state, claims), fresh)

    again = ruled.where(F.col("_wins").isNull()).select(F.col(_KEY).alias("row_key"), F.lit(f"{_KEY}: repeated").alias("reason"))
    gone = claims.where("known").select(F.col("key").alias("row_key"), F.lit(f"{_KEY}: repeated").alias("reason"))
    wrong = judged.where(F.col("reason").isNotNull()).select(F.col(_KEY).alias("row_key"), "reason")
    lost = wrong.unionByName(again).unionByName(gone).select(F.lit(FACTS).alias("feed"), "row_key", "reason")
    rejects = snapshots.write_folder(lost.select(REJECTS.names), root)

    state = keyindex.write(claims, root).into(state)
    state = keyindex.merged(spark, root, state)
    state = state.with_table(FACTS, facts)
    name, read = rejects_table(FACTS), state.notes.get(READ, {})
    state = state.with_table(name, snapshots.added(state.tables.get(name, {}), rejects))
    return state.with_note(READ, {**read, FACTS: read.get(FACTS, 0) + counted.get["rows"]})


def _given_way(spark: SparkSession, root: str, state: snapshots.Manifest, claims: DataFrame) -> snapshots.Parts:
    """Parts of the fact table without rows whose id a claim takes over; only their months are read."""
    moved = claims.where("known")
    # one value per calendar month
    months = [r["old_month"] for r in moved.select("old_month").distinct().collect()]
    parts = state.tables.get(FACTS, {})
    if not months:
        return parts
    left = read_months(spark, root, months, state).join(moved.select(F.col("key").alias(_KEY)), _KEY, "left_anti")
    others = {v: own for v, own in parts.items() if v not in {part_of(m) for m in months}}
    return {**others, **written(left.drop(MONTH), root, FACTS)}


def land_feed(
    spark: SparkSession,
    feed: str,
    raw_dir: str,
    landing: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    multiline: bool = False,
) -> None:
    """Append the rows of all files not yet seen to the landing table, then stop.

    Each batch of files is a plain map, without shuffle, into a folder of its own. The landing table is a snapshot: the
    folder and the place the stream has reached are committed together, so a run that dies is resumed by the next one without
    losing or repeating a file.
    """

    def take(paths: list[str], batch: str, state: snapshots.Manifest) -> snapshots.Manifest:
        rows = _rows_of(spark, feed, paths, multiline)
        if rows is None:
            return state
        return state.with_table(feed, snapshots.added(state.tables.get(feed, {}), snapshots.write_folder(rows, landing)))

    _new_files(spark, raw_dir, landing, checkpoint, files_per_batch, take)


def landed(spark: SparkSession, feed: str, landing: str) -> DataFrame:
    """Everything landed so far, like ``read_feed``: text columns, malformed mark, ordinal."""
    schema = STAR[feed].raw.add(MALFORMED, "boolean").add(FILE, "string").add(SPLIT, "long").add(NTH, "long")
    written = snapshots.read(spark, landing, feed, schema)
    orders = path_orders(written.select(F.col(FILE).alias("path")).distinct())
    rows = with_path_order(written, F.col(FILE), orders, "_of")
    return rows.select(*STAR[feed].columns, MALFORMED, F.struct("_of", SPLIT, NTH).alias(ORDINAL))
