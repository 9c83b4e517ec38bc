"""Facts and customers laid out by customer, so that joins and sums by customer move no fact row.

Both tables are cut into the same number of buckets by the hash of the customer id, at the price of one shuffle when they
are written. A bucket is read by one task, so customers that hold many rows are kept aside, in a table without buckets.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators.joins import hot_keys
from tillwise.sources import snapshots

KEY = "customer_id"
LAYOUT = "layout"  # note of the store: the layout in use


@dataclass(frozen=True)
class ByCustomer:
    """Facts of known customers, in buckets but for the rows of ``hot`` ones, and the customers in the same buckets."""

    facts: DataFrame
    customers: DataFrame
    aside: DataFrame
    hot: list[str]


def lay_out(transactions: DataFrame, customers: DataFrame, target: str, buckets: int, columns: list[str]) -> ByCustomer:
    """Write ``columns`` of the facts, and the customers, by customer; replaces the layout under ``target`` when done.

    Rows without a customer are left out. ``buckets`` should make a bucket some hundred MB. A layout is the state of its
    tables when it was written; lay out again to see later rows.
    """
    spark, base = transactions.sparkSession, target.rstrip("/")
    facts = transactions.where(F.col(KEY).isNotNull()).select(KEY, *columns)
    hot = hot_keys(facts, KEY)
    is_hot = F.col(KEY).isin(hot) if hot else F.lit(False)
    note = {"buckets": buckets, "hot": hot}
    for name, rows in (("facts", facts.where(~is_hot)), ("customers", customers.where(F.col(KEY).isNotNull()))):
        note[name] = {"folder": f"data/{name}-{uuid.uuid4().hex}", "schema": rows.schema.json()}
        _write(rows, f"{base}/{note[name]['folder']}", buckets)
    note["aside"] = {"schema": facts.schema.json()}
    parts = snapshots.write_folder(facts.where(is_hot), target)
    snapshots.change(spark, target, lambda m: m.with_table("aside", parts).with_note(LAYOUT, note))
    return attach(spark, target)


def _write(rows: DataFrame, path: str, buckets: int) -> None:
    # Spark writes buckets through its catalog only; the table there is forgotten at once, its files stay
    table = f"written_{uuid.uuid4().hex}"
    rows.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(table)
    rows.sparkSession.sql(f"DROP TABLE {table}")


def attach(spark: SparkSession, target: str) -> ByCustomer:
    """The layout under ``target``, for this session."""
    state = snapshots.current(spark, target)
    note = state.notes.get(LAYOUT)
    if note is None:
        raise FileNotFoundError(f"{target}: nothing was laid out")
    schemas = {n: T._parse_datatype_json_string(note[n]["schema"]) for n in ("facts", "customers", "aside")}
    tables = {}
    for name in ("facts", "customers"):
        folder = note[name]["folder"]
        table = folder.split("/")[1].replace("-", "_")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas[name])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {note['buckets']} BUCKETS LOCATION '{target.rstrip('/')}/{folder}'"
        )
        tables[name] = spark.table(table)
    aside = snapshots.read(spark, target, "aside", schemas["aside"], state)
    return ByCustomer(tables["facts"], tables["customers"], aside, note["hot"])
