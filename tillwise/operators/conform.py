"""Fit transactions to the dimensions: repair references, drop what cannot be sold, dedupe."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillwise.functions.numbers import FALLBACK_PRICE, MONEY, parse_price
from tillwise.operators import narrow
from tillwise.operators.cleanse import (
    PASS, ROW, accepted, first_accepted, in_range, left_out, marked, row_bits, row_ranges, type_transactions,
)
from tillwise.operators.dedupe import keep_first
from tillwise.operators.joins import keep_known, look_up, null_unknown
from tillwise.sources.feeds import ORDINAL
from tillwise.sources.scratch import materialise


def conform_references(
    facts: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """Unknown customers and stores become null, rows of unknown products go. Channel stays as it was."""
    return repair(keep_known(facts, products, "product_id"), customers, stores)


def clean_transactions(
    raw: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame, strict: bool = False
) -> DataFrame:
    """The fact rows to load: the first acceptable copy with a known product of each id.

    Unknown customers and stores do not decide which copy that is, so copies and rejects are gone before
    those two lookups. Typed rows are written once and judged by narrow columns, so whole rows are not shuffled; the
    result of more than ``PASS`` rows is made in passes, as each has bits broadcast for its rows. A strict run is lazy and
    judges whole rows, as it has to fail on the row itself.
    """
    if strict:
        return conform_typed(type_transactions(raw), customers, products, stores, strict)
    counted, hot, key = Observation("transactions to clean"), narrow.Hot(), "transaction_id"
    typed = type_transactions(raw).observe(counted, F.count(F.lit(1)).alias("rows"))
    typed = materialise(typed.withColumn(ROW, F.monotonically_increasing_id()), "typed-to-clean")
    read = counted.get["rows"]
    sold = narrow.with_sold(typed, products, key, None, read)
    unknown = F.when(F.col("_sold").isNull(), F.lit("product_id: unknown"))
    bits = materialise(row_bits(left_out(sold, key, unknown, single=True)), "out-bits-to-clean")
    passes = []
    for first, last, hot.rows in row_ranges(typed, PASS) if read > PASS else [(None, None, read)]:
        some = (typed, bits) if first is None else in_range(typed, bits, first, last)
        kept = accepted(marked(*some, "_out", hot.rows)).where("NOT _out").drop("_out", ORDINAL)
        kept = narrow.repair(kept, customers, stores, hot).drop(ROW)
        passes.append(kept if first is None else materialise(kept, "cleaned"))
    return reduce(DataFrame.unionByName, passes)


def conform_typed(
    typed: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame, strict: bool = False
) -> DataFrame:
    sold = keep_known(typed, products, "product_id")
    return repair(first_accepted(sold, "transaction_id", strict), customers, stores)


def repair(facts: DataFrame, customers: DataFrame, stores: DataFrame, hot: dict[str, list] | None = None) -> DataFrame:
    """Unknown customers and stores become null. ``hot`` lists frequent keys by column."""
    spread, hot = F.col("transaction_id"), hot or {}
    facts = null_unknown(facts, stores, "store_id", spread, hot.get("store_id"))
    return null_unknown(facts, customers, "customer_id", spread, hot.get("customer_id"))


def derive_channel(facts: DataFrame) -> DataFrame:
    """Sales without a store happened online."""
    channel = F.when(F.col("store_id").isNull(), F.lit("Online")).otherwise(F.lit("In-Store"))
    return facts.withColumn("channel", channel)


def look_up_price(facts: DataFrame, raw_products: DataFrame) -> DataFrame:
    """Add unit_price from the product feed; the fallback price where product or price is unusable.

    Should the feed list a product twice, its last row counts.
    """
    last = keep_first(raw_products, "product_id", [F.col(ORDINAL).desc()])
    prices = last.select("product_id", parse_price(F.col("sell_price")).alias("_price"))
    price = F.coalesce("_price", F.lit(FALLBACK_PRICE).cast(MONEY)).alias("unit_price")
    kept = [c for c in facts.columns if c != "unit_price"]
    return look_up(facts.select(kept), prices, "product_id", F.col("transaction_id")).select(*kept, price)


def append_extracts(base: DataFrame, *extracts: DataFrame) -> DataFrame:
    """Stack extracts of the same feed, copies and all."""
    for extract in extracts:
        base = base.unionByName(extract)
    return base
