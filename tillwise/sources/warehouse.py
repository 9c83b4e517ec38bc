"""Typed tables in one store of snapshots: create, append, replace, read, count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.dates import month_label
from tillwise.schemas import STAR, Table
from tillwise.sources import keyindex, snapshots
from tillwise.sources.snapshots import NULL_PART, WHOLE, Manifest, Parts

# Partition column of the fact table.
MONTH = "transaction_month"

FACTS = "transactions"
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in ("feed", "row_key", "reason")])


def to_declared(df: DataFrame, table: Table) -> DataFrame:
    """Columns in declared order and type; nothing else gets through."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in table.stored])


def _fact_layout(df: DataFrame) -> DataFrame:
    """Add the month and spread rows by it.

    Without the rebalance every task of the last shuffle would open a file in every month. The hint
    lets adaptive execution split a month that is too big for one task and join those too small.
    """
    return df.withColumn(MONTH, month_label("transaction_date")).hint("rebalance", MONTH)


def written(df: DataFrame, root: str, name: str, beside: Parts | None = None) -> Parts:
    """Write rows of a star table into the store, in no table yet; the facts by month. ``beside`` is as for ``write_folder``.

    Facts that show their month, as those of ``read_table`` do, are taken to lie by month: each task has rows of few, so
    they are written without a shuffle. Drop the column where a shuffle or many appends have mixed the months, which would
    make more and smaller files; the rows are the same.
    """
    typed, more = to_declared(df, STAR[name]), {"beside": beside} if beside else {}
    if name == FACTS:
        dated = typed.withColumn(MONTH, month_label("transaction_date")) if MONTH in df.columns else _fact_layout(typed)
        return snapshots.write_folder(dated, root, MONTH, **more)
    return snapshots.write_folder(typed, root, **more)


def write_table(df: DataFrame, root: str, name: str, mode: str = "overwrite") -> None:
    """Write a star table. ``overwrite`` makes a repeated load idempotent, ``append`` adds rows with new keys.

    Overwriting replaces the whole table, also months the new rows do not have. Appending leaves out rows whose key the
    table has, in whichever month, so it can be repeated; among the new rows themselves keys are unique. Either way the
    table changes when all new rows are written, so a job that dies leaves it as it was.
    """
    spark = df.sparkSession
    if mode == "append":
        _append(df, root, name)
        return
    parts = written(df, root, name)
    snapshots.change(spark, root, lambda m: placed(m, name, parts))


def placed(manifest: Manifest, name: str, parts: Parts) -> Manifest:
    """The manifest with a star table replaced; an index of the old facts is forgotten."""
    new = manifest.with_table(name, parts)
    return keyindex.forgotten(new) if name == FACTS else new


def _append(df: DataFrame, root: str, name: str) -> None:
    spark, key = df.sparkSession, STAR[name].key
    state = snapshots.current(spark, root)
    if name != FACTS:
        # a dimension stays one folder, which the catalog can point at
        old = read_table(spark, root, name, state)
        new = to_declared(df, STAR[name]).join(old.select(key), key, "left_anti")
        parts = written(old.unionByName(new), root, name)
        snapshots.commit(spark, root, state.with_table(name, parts))
        return
    state = indexed(spark, root, state)
    typed = to_declared(df, STAR[name])
    if keyindex.ENTRIES in state.tables:
        keys = typed.where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
        known = keyindex.lookup(spark, root, state, keys).select(F.col("key").alias(key))
        typed = typed.join(known, key, "left_anti")
    # without an index the table is empty, and the rows need not meet it
    parts = written(typed, root, name)
    # the index gets the rows that were written, not another evaluation of them
    rows = snapshots.read_parts(spark, root, parts, _schema(name))
    entries = keyindex.write(key_entries(rows), root)
    facts = snapshots.added(state.tables.get(name, {}), parts)
    new = entries.into(state.with_table(name, facts))
    snapshots.commit(spark, root, keyindex.merged(spark, root, new))


def key_entries(facts: DataFrame) -> DataFrame:
    """Index entries of fact rows whose place in a feed is not known."""
    rows = facts.where(F.col(STAR[FACTS].key).isNotNull())
    return rows.select(F.col(STAR[FACTS].key).alias("key"), F.lit(None).cast(keyindex.PLACE).alias("place"), F.col(MONTH).alias("month"))


def indexed(spark: SparkSession, root: str, state: Manifest) -> Manifest:
    """The state with an index of the facts, built from the table where there is none. Nothing is committed."""
    if keyindex.ENTRIES in state.tables or not state.tables.get(FACTS):
        return state
    return keyindex.write(key_entries(read_table(spark, root, FACTS, state)), root).into(state)


def replace_months(df: DataFrame, root: str) -> None:
    """Put the rows in place of the months present in ``df``; other months stay as they are."""
    parts = written(df, root, FACTS)
    snapshots.change(df.sparkSession, root, lambda m: placed(m, FACTS, {**m.tables.get(FACTS, {}), **parts}))


def part_of(month: str | None) -> str:
    """The part of the fact table that holds a month; rows without a date are a month of their own, None."""
    return NULL_PART if month is None else month


def in_months(months: list[str | None]) -> Column:
    """Whether a row is of one of the months."""
    dated = F.col(MONTH).isin([m for m in months if m is not None])
    return dated | F.col(MONTH).isNull() if None in months else dated


def _schema(name: str) -> T.StructType:
    schema = STAR[name].stored
    return schema.add(MONTH, "string") if name == FACTS else schema


def read_table(spark: SparkSession, root: str, name: str, manifest: Manifest | None = None) -> DataFrame:
    """A star table with its declared columns; the fact table also shows its month for pruning.

    The rows are those of the newest manifest, or of the one given; later writes do not change the frame.
    """
    return snapshots.read(spark, root, name, _schema(name), manifest)


def read_months(spark: SparkSession, root: str, months: list[str | None], manifest: Manifest) -> DataFrame:
    """The facts of some months; the others are not even listed."""
    parts = manifest.tables.get(FACTS, {})
    wanted = {part_of(m) for m in months}
    return read_parts_of(spark, root, {v: own for v, own in parts.items() if v in wanted})


def read_parts_of(spark: SparkSession, root: str, parts: Parts) -> DataFrame:
    """The facts in the given parts of their table."""
    return snapshots.read_parts(spark, root, parts, _schema(FACTS))


def compact_months(spark: SparkSession, root: str, most_folders: int = 1) -> None:
    """Write months anew that have more folders than that, as after many appends."""
    state = snapshots.current(spark, root)
    parts = state.tables.get(FACTS, {})
    many = [v for v, own in parts.items() if len(own) > most_folders]
    if many:
        rows = snapshots.read_parts(spark, root, {v: parts[v] for v in many}, _schema(FACTS)).drop(MONTH)
        snapshots.commit(spark, root, state.with_table(FACTS, {**parts, **written(rows, root, FACTS)}))


def create_tables(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Register the four tables, as they are now, in the catalog. VARCHAR limits then hold for SQL inserts too.

    The catalog points at the folders of one state of the store; register again to see a later one.
    """
    compact_months(spark, root)
    state, base = snapshots.current(spark, root), root.rstrip("/")
    prefix = f"{database}." if database else ""
    for name, table in STAR.items():
        parts = state.tables.get(name, {})
        if name != FACTS:
            spark.sql(table.ddl(f"{base}/{parts[WHOLE][0]}" if parts else f"{base}/data/none-{name}", None, prefix))
            continue
        spark.sql(table.ddl(f"{base}/data", MONTH, prefix))
        for value, (folder,) in parts.items():
            shown = "NULL" if value == NULL_PART else f"'{value}'"
            spark.sql(f"ALTER TABLE {prefix}{name} ADD PARTITION ({MONTH}={shown}) LOCATION '{base}/{folder}'")


def drop_tables(spark: SparkSession, database: str | None = None) -> None:
    """Forget the four tables, the referring one first; files of external tables stay."""
    prefix = f"{database}." if database else ""
    for name in reversed(STAR):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")


_DERIVED = "rows"


def replace_table(df: DataFrame, target: str, fmt: str = "snapshot", **options: str) -> None:
    """Write a derived table in place of what was there.

    ``target`` is a folder, to be read by ``read_derived``; the old rows stay until all new ones are written. With
    ``fmt='jdbc'`` it is the table name for a reporting database whose ``url``, ``user`` and ``password`` come as options
    from the job's configuration; other formats are Spark's own writers, which delete first.
    """
    if fmt == "snapshot":
        parts = snapshots.write_folder(df, target)
        schema = df.schema.json()
        snapshots.change(df.sparkSession, target, lambda m: m.with_table(_DERIVED, parts).with_note("schema", schema))
        return
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    if fmt == "jdbc":
        writer.option("dbtable", target).save()
    else:
        writer.save(target)


def read_derived(spark: SparkSession, target: str) -> DataFrame:
    """What ``replace_table`` last wrote."""
    state = snapshots.current(spark, target)
    if "schema" not in state.notes:
        raise FileNotFoundError(f"{target}: no table was ever written")
    return snapshots.read(spark, target, _DERIVED, T._parse_datatype_json_string(state.notes["schema"]), state)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each frame, as one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
