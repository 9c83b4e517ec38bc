"""Load the four raw feeds into the star schema and account for every row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.dates import month_label
from tillwise.operators import quality
from tillwise.operators.cleanse import (
    MARKED, PASS, REJECT, ROW, TYPERS, accepted, in_range, left_out, marked, rejected, row_bits, row_ranges,
)
from tillwise.operators.joins import fits_broadcast, hot_of, top_keys
from tillwise.operators.narrow import Hot, repair, with_sold
from tillwise.schemas import FOREIGN_KEYS, STAR
from tillwise.sources import snapshots
from tillwise.sources.feeds import read_feed
from tillwise.sources.scratch import FOLDER, materialise
from tillwise.sources.warehouse import MONTH, REJECTS, placed, read_table, row_counts, write_table, written

DIMENSIONS = ["customers", "products", "stores"]

READ = "rows read"  # note of the store: rows of each feed that came in

AUDITS = "audits"  # note of the store: what the last whole load measured of each feed


def rejects_table(feed: str) -> str:
    """Name of the table of rows that a feed's load left out."""
    return f"rejects-{feed}"


def read_feeds(spark: SparkSession, raw_dir: str, multiline: bool = False) -> dict[str, DataFrame]:
    """The raw feeds, each a folder (or file) named after its table."""
    return {name: read_feed(spark, name, f"{raw_dir.rstrip('/')}/{name}", multiline) for name in STAR}


def load_dimensions(feeds: dict[str, DataFrame], root: str, strict: bool = False, audit: bool = False) -> None:
    """Clean and write the dimensions among ``feeds``, and what of them is left out."""
    for name in [n for n in DIMENSIONS if n in feeds]:
        if strict and name != "customers":
            _refuse_duplicates(name, feeds[name])
        _load(feeds[name], root, name, strict, audit=audit)


def load_transactions(
    raw: DataFrame, root: str, strict: bool = False, mode: str = "overwrite", audit: bool = False
) -> None:
    """Conform the facts to the dimensions already loaded and write them by month, and what is left out."""
    dimensions = {name: read_table(raw.sparkSession, root, name) for name in DIMENSIONS}
    _load(raw, root, "transactions", strict, dimensions, mode, audit)


def _load(
    raw: DataFrame, root: str, name: str, strict: bool, dimensions: dict[str, DataFrame] | None = None, mode: str = "overwrite",
    audit: bool = False,
) -> None:
    """Load one feed: its table, the rows left out and the count of rows change together.

    The feed is parsed once: typed rows are written with a number each. What is left out beyond their own cells (unknown
    products, repeated ids) is a table of row numbers, also made once; the table is all other rows. Whole rows get what is
    found out about them as a bit each (see ``marked``) and are not shuffled: the typed facts are written in twelve
    folders by month of the year, so a task that reads one of them writes to few months. Bits are broadcast, so they go
    through the driver: of more than ``PASS`` rows the table is written in passes over ranges of row numbers.
    """
    spark, key = raw.sparkSession, STAR[name].key
    counted, found = Observation(f"raw {name}"), Observation(f"audit {name}")
    if audit:
        raw = raw.observe(found, *quality.measures(name))
    typed = TYPERS[name](raw)
    # frequent keys of the dimensions that are joined by a shuffle
    shuffled = [k for k, owner in FOREIGN_KEYS.items() if dimensions and not fits_broadcast(dimensions[owner])]
    typed = typed.observe(counted, F.count(F.lit(1)).alias("rows"), *[top_keys(k).alias(k) for k in shuffled])
    # written with the rows, so that a number stays with its row
    typed = typed.withColumn(ROW, F.monotonically_increasing_id())
    if dimensions:
        # facts of the same month of any year together: of a hundred years a task meets a hundred months at most
        typed = typed.withColumn(FOLDER, F.month("transaction_date"))
    typed = materialise(typed, f"typed-{name}")
    read = counted.get["rows"]
    hot = Hot({k: hot_of(counted.get[k], read) for k in shuffled})
    hot.rows = read
    if strict:
        worst = typed.where(F.col(REJECT).isNotNull()).select(REJECT).head()
        if worst:
            raise ValueError(f"rejected row, {worst[0]}")
    unknown = None
    rows = typed
    if dimensions:
        rows = with_sold(typed, dimensions["products"], key, hot.get("product_id"), read)
        unknown = F.when(F.col("_sold").isNull(), F.lit("product_id: unknown"))
    out = materialise(left_out(rows, key, unknown), f"out-{name}")
    bits = materialise(row_bits(out), f"out-bits-{name}")
    wrong = rejected(typed, name).unionByName(out.select(F.lit(name).alias("feed"), "row_key", "reason"))
    wrong = wrong.select([F.col(c).cast("string").alias(c) for c in REJECTS.names])
    lost = snapshots.write_folder(wrong, root)
    parts: snapshots.Parts = {}
    # bits go through the driver: those of a range of rows at a time, into the same folder
    ranges = row_ranges(typed, PASS) if read > PASS and mode != "append" else [(None, None, read)]
    for first, last, hot.rows in ranges:
        some = (typed, bits) if first is None else in_range(typed, bits, first, last)
        kept = accepted(marked(*some, "_out", hot.rows)).where("NOT _out")
        if dimensions:
            kept = repair(kept, dimensions["customers"], dimensions["stores"], hot)
        if mode == "append":
            write_table(kept, root, name, mode)
            continue
        # not shuffled since they were written by season, so they still lie by month
        shown = {MONTH: month_label("transaction_date")} if dimensions and hot.rows <= MARKED else {}
        parts = written(kept.withColumns(shown) if shown else kept, root, name, *([parts] if parts else []))
    audited = {}
    if audit:
        # ids that come again are counted in the written rows: one narrow column
        audited = {**found.get, **quality.repeated_ids(typed, name)}

    def recorded(state: snapshots.Manifest) -> snapshots.Manifest:
        new = placed(state, name, parts) if mode != "append" else state
        new = new.with_table(rejects_table(name), lost)
        new = new.with_note(READ, {**new.notes.get(READ, {}), name: read})
        audits = {k: v for k, v in new.notes.get(AUDITS, {}).items() if k != name}
        return new.with_note(AUDITS, {**audits, name: audited} if audit else audits)

    snapshots.change(spark, root, recorded)


def load_star(
    spark: SparkSession, raw_dir: str, root: str, strict: bool = False, multiline: bool = False, audit: bool = False
) -> dict[str, DataFrame]:
    """Load everything, dimensions before facts, over whatever an earlier load left.

    Lenient by default: rows that cannot be loaded are left out, see ``rejects`` and ``accounting``.
    ``strict`` fails on the first row with a bad cell, and on a product or store id that comes twice; a table
    that fails keeps its old rows. ``multiline`` allows line breaks inside quoted cells. ``audit`` measures the feeds
    while they are typed, see ``audits``.
    """
    feeds = read_feeds(spark, raw_dir, multiline)
    load_dimensions(feeds, root, strict, audit)
    load_transactions(feeds["transactions"], root, strict, audit=audit)
    state = snapshots.current(spark, root)
    return {name: read_table(spark, root, name, state) for name in STAR}


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """(feed, row_key, reason) of every row that is not in the tables: of the last load, and of all batches since."""
    state = snapshots.current(spark, root)
    return reduce(
        DataFrame.unionByName, [snapshots.read(spark, root, rejects_table(n), REJECTS, state) for n in STAR]
    )


def accounting(spark: SparkSession, root: str) -> DataFrame:
    """(feed, cause, row_count): rows read, rows loaded, and rows left out by reason, since the last whole load."""
    state = snapshots.current(spark, root)
    read = [(feed, "read", count) for feed, count in sorted(state.notes.get(READ, {}).items())]
    kind = T.StructType([T.StructField("feed", T.StringType()), T.StructField("cause", T.StringType()), T.StructField("row_count", T.LongType())])
    kept = row_counts({name: read_table(spark, root, name, state) for name in STAR if name in state.tables})
    lost = rejects(spark, root).groupBy("feed", F.col("reason").alias("cause")).agg(F.count(F.lit(1)).alias("row_count"))
    return (
        spark.createDataFrame(read, kind)
        .unionByName(kept.select(F.col("table_name").alias("feed"), F.lit("loaded").alias("cause"), "row_count"))
        .unionByName(lost)
    )


def audits(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """What ``quality`` reports of the feeds, as the last whole load measured it: nothing is read again.

    By name: ``missing_keys``, ``too_long``, ``too_large`` and ``defects``, for the feeds that were loaded with ``audit``.
    """
    return quality.reports(spark, snapshots.current(spark, root).notes.get(AUDITS, {}))


def _refuse_duplicates(name: str, raw: DataFrame) -> None:
    twice = quality.duplicate_keys({name: raw}).limit(1).collect()
    if twice:
        raise ValueError(f"{name}: {STAR[name].key} {twice[0].row_key} comes {twice[0].copies} times")


def all_rejected(feeds: dict[str, DataFrame]) -> DataFrame:
    """(feed, row_key, reason) of every row with a cell that cannot be loaded, straight from the feeds."""
    return reduce(DataFrame.unionByName, [rejected(TYPERS[n](df), n) for n, df in feeds.items()])


def load_audit(feeds: dict[str, DataFrame], loaded: dict[str, DataFrame]) -> DataFrame:
    """(feed, raw_rows, loaded_rows, dropped) per feed."""
    raw = row_counts(feeds).withColumnRenamed("row_count", "raw_rows")
    kept = row_counts(loaded).withColumnRenamed("row_count", "loaded_rows")
    return raw.join(kept, "table_name").select(
        F.col("table_name").alias("feed"),
        "raw_rows",
        "loaded_rows",
        (F.col("raw_rows") - F.col("loaded_rows")).alias("dropped"),
    )
