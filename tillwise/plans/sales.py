"""Sales reports over transactions and dimensions. Money stays DECIMAL; averages and shares are exact.

Every report takes sales only (quantity above zero) except the returns report. Ties in the report
order are broken by the label, nulls sort as a database does: first when descending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.dates import month_start
from tillwise.functions.numbers import ratio
from tillwise.operators.joins import sum_by_labels
from tillwise.operators.shares import share_of_total
from tillwise.sources.warehouse import MONTH


def _count() -> Column:
    return F.count("transaction_id")


def _revenue() -> Column:
    return F.sum("total_value")


def _average() -> Column:
    """Mean over the sales that have a value."""
    return ratio(F.sum("total_value"), F.count("total_value"), 2)


def _first(label: str) -> Column:
    return F.col(label).desc_nulls_first()


def sales(transactions: DataFrame) -> DataFrame:
    return transactions.where("quantity > 0")


def in_year(transactions: DataFrame, year: int) -> DataFrame:
    """Rows of one year, as a date range that reaches the scan; partitioned tables skip other months."""
    rows = transactions.where(
        F.col("transaction_date").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date"))
    )
    if MONTH in transactions.columns:
        rows = rows.where(F.col(MONTH).between(f"{year}-01", f"{year}-12"))
    return rows


def business_summary(transactions: DataFrame, unique_ids: bool = False) -> DataFrame:
    """One row of totals over all sales.

    The distinct ids are counted by a scan of their own. Counted together with the other columns,
    their sheer number would push customers, products and stores out of the hash maps that merge
    these before the shuffle. ``unique_ids`` says that transaction_id is a key, as in a table this
    package loaded: then rows are counted, in the one scan.
    """
    rows = sales(transactions)
    totals = rows.agg(
        _count().alias("ids"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("store_id").alias("stores_trading"),
        F.round(_revenue(), 2).alias("total_revenue"),
        _average().alias("avg_transaction_value"),
        F.min("transaction_date").alias("earliest_date"),
        F.max("transaction_date").alias("latest_date"),
    )
    ids = F.col("ids") if unique_ids else rows.agg(F.count_distinct("transaction_id")).scalar()
    return totals.select(ids.alias("total_transactions"), *totals.columns[1:])


def monthly_trend(transactions: DataFrame) -> DataFrame:
    return (
        sales(transactions)
        .groupBy(month_start(F.col("transaction_date")).alias("month"))
        .agg(
            _count().alias("num_transactions"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.round(_revenue(), 2).alias("monthly_revenue"),
            _average().alias("avg_order_value"),
        )
        .orderBy(F.col("month").asc_nulls_last())
    )


def revenue_by_category(transactions: DataFrame, products: DataFrame) -> DataFrame:
    measures = {
        "num_transactions": _count(), "units_sold": F.sum("quantity"), "revenue": _revenue(), "priced": F.count("total_value"),
    }
    per_category = sum_by_labels(sales(transactions), products, "product_id", ["category"], measures)
    return per_category.select(
        "category",
        "num_transactions",
        "units_sold",
        F.round("revenue", 2).alias("total_revenue"),
        ratio(F.col("revenue"), F.col("priced"), 2).alias("avg_order_value"),
        share_of_total("revenue").alias("revenue_pct"),
    ).orderBy(_first("total_revenue"), "category")


def top_products(transactions: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Best sellers by revenue; products of the same name and category count as one."""
    measures = {"times_purchased": _count(), "total_units": F.sum("quantity"), "revenue": _revenue()}
    labels = ["product_name", "category"]
    per_name = sum_by_labels(sales(transactions), products, "product_id", labels, measures)
    return (
        per_name.select(*labels, "times_purchased", "total_units", F.round("revenue", 2).alias("total_revenue"))
        .orderBy(_first("total_revenue"), *labels)
        .limit(n)
    )


def revenue_by_region(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue of the regions the stores are in; online sales have no store and stay out.

    Summing per store first makes the distinct store count a plain row count.
    """
    per_store = (
        sales(transactions)
        .where("store_id IS NOT NULL")
        .groupBy("store_id")
        .agg(_count().alias("n"), _revenue().alias("revenue"))
    )
    per_region = (
        per_store.join(stores.select("store_id", "region"), "store_id")
        .groupBy("region")
        .agg(
            F.count("store_id").alias("num_stores"),
            F.sum("n").alias("num_transactions"),
            F.sum("revenue").alias("revenue"),
        )
    )
    return per_region.select(
        "region",
        "num_stores",
        "num_transactions",
        F.round("revenue", 2).alias("total_revenue"),
        ratio(F.col("revenue"), F.col("num_stores"), 2).alias("revenue_per_store"),
    ).orderBy(_first("total_revenue"), "region")


def channel_split(transactions: DataFrame) -> DataFrame:
    return (
        sales(transactions)
        .groupBy("channel")
        .agg(
            _count().alias("transactions"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.round(_revenue(), 2).alias("total_revenue"),
            _average().alias("avg_order_value"),
        )
        .orderBy(_first("total_revenue"), "channel")
    )


def returns_by_category(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Returns per category. The percentage is of all returns, also those of unknown products."""
    returns = transactions.where("quantity < 0")
    measures = {"num_returns": _count(), "value": _revenue()}
    per_category = sum_by_labels(returns, products, "product_id", ["category"], measures)
    all_returns = returns.agg(F.count(F.lit(1))).scalar()
    return per_category.select(
        "category",
        "num_returns",
        F.abs("value").alias("value_returned"),
        ratio(F.col("num_returns").cast("decimal(20,0)") * 100, all_returns, 1).alias("pct_of_all_returns"),
    ).orderBy(_first("num_returns"), "category")


def payment_breakdown(transactions: DataFrame) -> DataFrame:
    return (
        sales(transactions)
        .groupBy("payment_method")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.round(_revenue(), 2).alias("total_revenue"),
            _average().alias("avg_value"),
        )
        .orderBy(_first("transactions"), "payment_method")
    )
