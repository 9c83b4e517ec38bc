"""Look-ups of whole rows that lie in a written table, by their narrow columns: whole rows get answers as bits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators.cleanse import REJECT, ROW, marked, row_bits
from tillwise.operators.joins import fits_broadcast, look_up, null_unknown
from tillwise.sources.scratch import materialise


def with_sold(typed: DataFrame, products: DataFrame, key: str, hot: list | None, read: int) -> DataFrame:
    """``typed`` with ``_sold``, unset where the product is unknown.

    Products too many to broadcast meet the numbers of the rows; the rows get the answer as bits and are not shuffled.
    """
    sold = products.select("product_id", F.lit(True).alias("_sold"))
    if fits_broadcast(sold):
        return look_up(typed, sold, "product_id", F.col(key), hot)
    good = typed.where(F.col(REJECT).isNull()).select(ROW, "product_id")
    lost = look_up(good, sold, "product_id", F.col(ROW), hot).where("_sold IS NULL")
    bits = materialise(row_bits(lost), "unknown-bits")
    found = marked(typed, bits, "_unsold", read)
    return found.select(*typed.columns, F.when(~F.col("_unsold"), F.lit(True)).alias("_sold"))


class Hot(dict):
    """The frequent keys of a feed by column, and the number of its rows."""

    rows = 0


def repair(kept: DataFrame, customers: DataFrame, stores: DataFrame, hot: Hot) -> DataFrame:
    """``conform.repair`` of rows with ``ROW``; against a large dimension only its key is shuffled, as for products."""
    for key, dimension in (("store_id", stores), ("customer_id", customers)):
        if fits_broadcast(dimension.select(key, F.col(key).alias("_known"))):
            kept = null_unknown(kept, dimension, key, F.col("transaction_id"), hot.get(key))
            continue
        known = dimension.select(key, F.lit(True).alias("_known"))
        # a row without a key has none to lose
        asked = kept.where(F.col(key).isNotNull()).select(ROW, key)
        lost = look_up(asked, known, key, F.col(ROW), hot.get(key)).where("_known IS NULL")
        bits = materialise(row_bits(lost), f"{key}-bits")
        kept = marked(kept, bits, f"_no_{key}", hot.rows).withColumn(key, F.when(~F.col(f"_no_{key}"), F.col(key))).drop(f"_no_{key}")
    return kept
