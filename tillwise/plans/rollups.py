"""Reports from partial sums kept by month: a slicer over months reads no fact row.

The roll-up of a month holds its sums and counts per product, per store, per channel and per payment method, and the
number of its customers. Sums of months add up to those of years, so every report but those that count customers over
several months follows from it, to the cent; for distinct customers of longer spans see ``sketches``.

``refresh`` keeps a roll-up beside a fact table. Its manifest notes from which data folders each month was summed, and
folders never change, so a month is summed again exactly if its folders are others now: after a load, a batch, a
replaced or a compacted month. Other months are neither read nor written. Roll-up and note are committed together; a
refresh that dies leaves the old ones, and the next one does what is still to do.

Months without sales or returns have no rows; rows without a date are a month of their own (null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.numbers import ratio
from tillwise.operators.joins import sum_by_labels
from tillwise.operators.shares import share_of_total
from tillwise.sources import snapshots
from tillwise.sources.warehouse import FACTS, MONTH, read_parts_of

ROLLUP, BUILT, SCHEMA = "rollup", "built", "schema"
SIDES = {"product": "product_id", "store": "store_id", "channel": "channel", "payment": "payment_method"}


def month_sums(facts: DataFrame) -> DataFrame:
    """Partial sums of ``facts`` (with their month) by month and each of ``SIDES``, and customers by month.

    ``side`` names what a row is summed by; the columns of the other sides are null. One scan serves all sums: each row
    is summed four times inside its task before anything is shuffled. Counting customers scans two columns once more.
    """
    sold, back = F.col("quantity") > 0, F.col("quantity") < 0
    sums = {
        "sold": F.count(F.when(sold, F.col("transaction_id"))), "sold_rows": F.count_if(sold),
        "units": F.sum(F.when(sold, F.col("quantity"))), "revenue": F.sum(F.when(sold, F.col("total_value"))),
        "priced": F.count(F.when(sold, F.col("total_value"))), "returned": F.count(F.when(back, F.col("transaction_id"))),
        "returned_rows": F.count_if(back), "returned_value": F.sum(F.when(back, F.col("total_value"))),
    }
    keys = list(SIDES.values())
    # grouping() is 0 for the column that a set groups by
    side = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(s)) for s, c in SIDES.items()]).alias("side")
    sets = [[F.col(MONTH), F.col(c)] for c in keys]
    rows = facts.where("quantity != 0").groupingSets(sets, MONTH, *keys).agg(side, *[m.alias(n) for n, m in sums.items()])
    customers = facts.where(sold).groupBy(MONTH).agg(F.count_distinct("customer_id").alias("customers"))
    return rows.unionByName(customers.withColumn("side", F.lit("customers")), allowMissingColumns=True)


def stale_months(facts: snapshots.Parts, built: snapshots.Parts) -> list[str]:
    """Parts of the fact table whose folders are not those that the roll-up was summed from."""
    return sorted(v for v, own in facts.items() if built.get(v) != own)


def refresh(spark: SparkSession, root: str, target: str) -> list[str]:
    """Bring the roll-up ``target`` up to date with the facts under ``root``; the months that were summed again."""
    state, kept = snapshots.current(spark, root), snapshots.current(spark, target)
    facts = state.tables.get(FACTS, {})
    stale = stale_months(facts, kept.notes.get(BUILT, {}))
    sums = month_sums(read_parts_of(spark, root, {v: facts[v] for v in stale}))
    fresh = snapshots.write_folder(sums.repartition(MONTH), target, MONTH) if stale else {}
    old = {v: own for v, own in kept.tables.get(ROLLUP, {}).items() if v in facts and v not in stale}
    new = kept.with_table(ROLLUP, {**old, **fresh}).with_note(BUILT, facts).with_note(SCHEMA, sums.schema.json())
    snapshots.commit(spark, target, new)
    return stale


def read(spark: SparkSession, target: str) -> DataFrame:
    """The roll-up as last refreshed."""
    state = snapshots.current(spark, target)
    if SCHEMA not in state.notes:
        raise FileNotFoundError(f"{target}: no roll-up was ever written")
    return snapshots.read(spark, target, ROLLUP, T._parse_datatype_json_string(state.notes[SCHEMA]), state)


def in_year(rollup: DataFrame, year: int) -> DataFrame:
    """Months of one year; the folders of others are not listed."""
    return rollup.where(F.col(MONTH).between(f"{year}-01", f"{year}-12"))


def _side(rollup: DataFrame, side: str, kind: str = "sold") -> DataFrame:
    return rollup.where((F.col("side") == side) & (F.col(f"{kind}_rows") > 0))


def _total(rollup: DataFrame, name: str) -> Column:
    """Sum of months in the type that the sum over the rows has: a sum of sums is declared wider than it can get."""
    return F.sum(name).cast(rollup.schema[name].dataType)


def _totals(rollup: DataFrame, *names: str) -> dict[str, Column]:
    return {n: _total(rollup, n) for n in names}


def _by(rollup: DataFrame, column: str, *names: str) -> DataFrame:
    return rollup.groupBy(column).agg(*[m.alias(n) for n, m in _totals(rollup, *names).items()])


def _first(label: str) -> Column:
    return F.col(label).desc_nulls_first()


def _revenue() -> Column:
    return F.round("revenue", 2).alias("total_revenue")


def _average() -> Column:
    return ratio(F.col("revenue"), F.col("priced"), 2)


def monthly_trend(rollup: DataFrame) -> DataFrame:
    sums = _by(_side(rollup, "channel"), MONTH, "sold", "revenue", "priced")
    customers = rollup.where("side = 'customers'").select(F.col(MONTH).alias("_month"), "customers")
    # at most one row for each month on either side
    both = sums.join(customers, F.col(MONTH).eqNullSafe(F.col("_month")))
    return both.select(
        F.to_date(F.concat(MONTH, F.lit("-01"))).alias("month"), F.col("sold").alias("num_transactions"),
        F.col("customers").alias("unique_customers"), F.round("revenue", 2).alias("monthly_revenue"),
        _average().alias("avg_order_value"),
    ).orderBy(F.col("month").asc_nulls_last())


def revenue_by_category(rollup: DataFrame, products: DataFrame) -> DataFrame:
    rows = _side(rollup, "product")
    sums = sum_by_labels(rows, products, "product_id", ["category"], _totals(rows, "sold", "units", "revenue", "priced"))
    return sums.select(
        "category", F.col("sold").alias("num_transactions"), F.col("units").alias("units_sold"), _revenue(),
        _average().alias("avg_order_value"), share_of_total("revenue").alias("revenue_pct"),
    ).orderBy(_first("total_revenue"), "category")


def top_products(rollup: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    rows, labels = _side(rollup, "product"), ["product_name", "category"]
    sums = sum_by_labels(rows, products, "product_id", labels, _totals(rows, "sold", "units", "revenue"))
    named = sums.select(*labels, F.col("sold").alias("times_purchased"), F.col("units").alias("total_units"), _revenue())
    return named.orderBy(_first("total_revenue"), *labels).limit(n)


def revenue_by_region(rollup: DataFrame, stores: DataFrame) -> DataFrame:
    per_store = _by(_side(rollup, "store").where("store_id IS NOT NULL"), "store_id", "sold", "revenue")
    per_region = per_store.join(stores.select("store_id", "region"), "store_id").groupBy("region").agg(
        F.count("store_id").alias("num_stores"), F.sum("sold").alias("num_transactions"), F.sum("revenue").alias("revenue"))
    average = ratio(F.col("revenue"), F.col("num_stores"), 2).alias("revenue_per_store")
    return per_region.select("region", "num_stores", "num_transactions", _revenue(), average).orderBy(_first("total_revenue"), "region")


def channel_share(rollup: DataFrame) -> DataFrame:
    sums = _by(_side(rollup, "channel"), "channel", "revenue")
    return sums.select("channel", _revenue(), share_of_total("revenue").alias("revenue_pct")).orderBy(_first("total_revenue"), "channel")


def returns_by_category(rollup: DataFrame, products: DataFrame) -> DataFrame:
    rows = _side(rollup, "product", "returned")
    measures = _totals(rows, "returned", "returned_value")
    sums = sum_by_labels(rows, products, "product_id", ["category"], measures)
    everything = rows.agg(F.sum("returned_rows")).scalar()
    return sums.select(
        "category", F.col("returned").alias("num_returns"), F.abs("returned_value").alias("value_returned"),
        ratio(F.col("returned").cast("decimal(20,0)") * 100, everything, 1).alias("pct_of_all_returns"),
    ).orderBy(_first("num_returns"), "category")


def payment_breakdown(rollup: DataFrame) -> DataFrame:
    sums = _by(_side(rollup, "payment"), "payment_method", "sold_rows", "revenue", "priced")
    return sums.select(
        "payment_method", F.col("sold_rows").alias("transactions"), _revenue(), _average().alias("avg_value")
    ).orderBy(_first("transactions"), "payment_method")
