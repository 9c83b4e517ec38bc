"""The tables behind the three dashboard pages: sales overview, RFM segments, product performance.

Revenue counts sales only, as the reports do. Year and segment slicers are arguments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.numbers import ratio, round_half_even
from tillwise.operators.shares import share_of_total
from tillwise.plans import sales
from tillwise.schemas import CUSTOMER_RFM_COLUMNS


def kpi_by_year(transactions: DataFrame) -> DataFrame:
    """The four cards (revenue, transactions, customers, average order value) for every year."""
    revenue, priced = F.sum("total_value"), F.count("total_value")
    return (
        sales.sales(transactions)
        .groupBy(F.year("transaction_date").alias("year"))
        .agg(
            F.round(revenue, 2).alias("total_revenue"),
            F.count("transaction_id").alias("transactions"),
            F.count_distinct("customer_id").alias("customers"),
            ratio(revenue, priced, 2).alias("avg_order_value"),
        )
        .orderBy("year")
    )


def channel_share(transactions: DataFrame) -> DataFrame:
    revenue = sales.sales(transactions).groupBy("channel").agg(F.sum("total_value").alias("revenue"))
    return revenue.select(
        "channel", F.round("revenue", 2).alias("total_revenue"), share_of_total("revenue").alias("revenue_pct")
    ).orderBy(F.col("total_revenue").desc_nulls_first(), "channel")


def sales_overview(transactions: DataFrame, stores: DataFrame, year: int | None = None) -> dict[str, DataFrame]:
    """All visuals of the sales page, cut to one year if given."""
    rows = transactions if year is None else sales.in_year(transactions, year)
    return {
        "kpi": kpi_by_year(rows),
        "monthly_trend": sales.monthly_trend(rows),
        "revenue_by_region": sales.revenue_by_region(rows, stores),
        "channel_share": channel_share(rows),
    }


def in_segments(rfm: DataFrame, segments: list[str] | None) -> DataFrame:
    return rfm if segments is None else rfm.where(F.col("segment").isin(segments))


def customers_per_segment(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(F.count("customer_id").alias("customers")).orderBy("segment")


def revenue_per_segment(rfm: DataFrame) -> DataFrame:
    spent = F.sum(F.col("monetary").cast("decimal(22,2)"))
    return rfm.groupBy("segment").agg(spent.alias("total_revenue")).orderBy("segment")


def avg_spend_by_segment(rfm: DataFrame) -> DataFrame:
    spent = F.sum(F.col("monetary").cast("decimal(22,2)")).cast("double")
    mean = round_half_even(spent / F.count("customer_id"), 2)
    return rfm.groupBy("segment").agg(mean.alias("avg_monetary")).orderBy("segment")


def avg_score_by_segment(rfm: DataFrame) -> DataFrame:
    """Mean score per segment, summed as decimals so that the order of rows cannot matter."""
    points = F.sum(F.col("rfm_score").cast("decimal(5,2)")).cast("double")
    mean = round_half_even(points / F.count("rfm_score"), 2)
    return rfm.groupBy("segment").agg(mean.alias("avg_rfm_score")).orderBy("segment")


def segment_detail(rfm: DataFrame, segments: list[str] | None = None) -> DataFrame:
    return in_segments(rfm, segments).select(CUSTOMER_RFM_COLUMNS)


def segment_page(rfm: DataFrame, segments: list[str] | None = None) -> dict[str, DataFrame]:
    """All visuals of the segment page, cut to some segments if given."""
    rows = in_segments(rfm, segments)
    return {
        "customers_per_segment": customers_per_segment(rows),
        "revenue_per_segment": revenue_per_segment(rows),
        "avg_score_by_segment": avg_score_by_segment(rows),
        "segment_detail": segment_detail(rows),
    }


def stock_status(products: DataFrame) -> DataFrame:
    stock = products.groupBy("in_stock").agg(F.count("product_id").alias("products"))
    counts = stock.withColumn("n", F.col("products").cast("decimal(20,0)"))
    return counts.select("in_stock", "products", share_of_total("n").alias("pct")).orderBy("in_stock")


def product_page(transactions: DataFrame, products: DataFrame, year: int | None = None) -> dict[str, DataFrame]:
    """All visuals of the product page, cut to one year if given; stock has no date."""
    rows = transactions if year is None else sales.in_year(transactions, year)
    return {
        "revenue_by_category": sales.revenue_by_category(rows, products),
        "top_products": sales.top_products(rows, products),
        "returns_by_category": sales.returns_by_category(rows, products),
        "stock_status": stock_status(products),
    }


def headline_facts(
    transactions: DataFrame, products: DataFrame, stores: DataFrame, rfm: DataFrame, lines: DataFrame | None = None
) -> DataFrame:
    """(fact, label, amount): best month, category and region by revenue; customers to win back.

    ``lines`` are the transactions without date and customer, where these cost a join to attach.
    """
    lines = transactions if lines is None else lines

    def best(fact: str, report: DataFrame, label: str, amount: str) -> DataFrame:
        top = report.orderBy(F.col(amount).desc(), F.col(label).asc()).limit(1)
        return top.select(
            F.lit(fact).alias("fact"),
            F.col(label).cast("string").alias("label"),
            F.col(amount).cast("decimal(32,2)").alias("amount"),
        )

    # One row per fact even when nobody is in the segment.
    segments = {"hibernating_customers": "Hibernating", "at_risk_customers": "At Risk"}
    sizes = [
        rfm.agg(F.count_if(F.col("segment") == name).cast("decimal(32,2)").alias("amount")).select(
            F.lit(fact).alias("fact"), F.lit(name).alias("label"), "amount"
        )
        for fact, name in segments.items()
    ]
    return reduce(DataFrame.unionByName, [
        best("peak_month", sales.monthly_trend(transactions), "month", "monthly_revenue"),
        best("top_category", sales.revenue_by_category(lines, products), "category", "total_revenue"),
        best("top_region", sales.revenue_by_region(lines, stores), "region", "total_revenue"),
        *sizes,
    ])
