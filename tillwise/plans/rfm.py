"""Recency, frequency and monetary scores per customer, and the segments built on them.

The work is split like an estimator: ``customer_totals`` reduces the facts to one row per customer
and writes that down, ``fit`` reads the dozen numbers that divide the customers into fifths, and
``score`` applies them as literals, without a join, shuffle or window.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.lookups import action_for
from tillwise.functions.numbers import round_half_even
from tillwise.functions.segments import segment_of_scores
from tillwise.operators.ranking import SAMPLE, bucket_by_cuts, rank_cuts
from tillwise.operators.shares import histogram
from tillwise.plans.sales import sales
from tillwise.schemas import CUSTOMER_RFM_COLUMNS
from tillwise.sources.buckets import ByCustomer
from tillwise.sources.scratch import materialise

DETAILS = ["full_name", "region", "age_group", "loyalty_member"]


@dataclass(frozen=True)
class Cuts:
    """What divides customers into fifths.

    ``recency_fifths`` are the 20/40/60/80 % quantiles of recency in days, times five: on whole days
    they lie on fifths of a day, so as integers they carry no floating-point noise.
    """

    reference_date: datetime.date | None
    recency_fifths: list[int]
    frequency: list[tuple]
    monetary: list[tuple]


def purchases(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales to known customers with the customer's details: the rows RFM looks at."""
    facts = sales(transactions).select("customer_id", "transaction_date", "total_value")
    return facts.join(customers.select("customer_id", *DETAILS), "customer_id").select(
        "customer_id", "transaction_date", "total_value", *DETAILS
    )


def purchases_by_customer(layout: ByCustomer) -> DataFrame:
    """``purchases`` from tables in buckets: no fact row is shuffled."""
    rows = purchases(layout.facts, layout.customers)
    return rows.unionByName(purchases(layout.aside, _hot(layout))) if layout.hot else rows


def _hot(layout: ByCustomer) -> DataFrame:
    """The customers whose facts are kept aside; as many as ``hot_keys`` gives at most."""
    return F.broadcast(layout.customers.where(F.col("customer_id").isin(layout.hot)))


def totals_by_customer(layout: ByCustomer, details: bool = False) -> DataFrame:
    """``customer_totals`` from tables in buckets: summed where the rows are; of a hot customer, a row for each task moves."""
    extra = DETAILS if details else []
    rows = _per_customer(layout.facts).join(layout.customers.select("customer_id", *extra), "customer_id")
    if layout.hot:
        rows = rows.unionByName(_per_customer(layout.aside).join(_hot(layout).select("customer_id", *extra), "customer_id"))
    return materialise(rows.drop("row_count"), "totals")


def coverage(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """(transactions, customers) that RFM looks at."""
    per_customer = _per_customer(transactions).join(customers.select("customer_id"), "customer_id")
    return per_customer.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("transactions"), F.count("customer_id").alias("customers")
    )


def customer_details(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """First known value of each detail per buying customer.

    The buyers are reduced to their ids before they meet the customers, so no fact row carries
    details through a shuffle.
    """
    buyers = _per_customer(transactions).select("customer_id")
    rows = customers.select("customer_id", *DETAILS).join(buyers, "customer_id", "left_semi")
    return rows.groupBy("customer_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in DETAILS])


def _per_customer(transactions: DataFrame) -> DataFrame:
    # Map-side sums make one row per task of the busiest customer.
    return (
        sales(transactions)
        .where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.max("transaction_date").alias("last_purchase"),
            F.count("transaction_date").alias("frequency"),
            F.coalesce(F.sum("total_value"), F.lit(0).cast("decimal(12,2)")).alias("monetary"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )


def customer_totals(transactions: DataFrame, customers: DataFrame, details: bool = False) -> DataFrame:
    """(customer_id, last_purchase, frequency, monetary[, details]) of known customers who bought.

    Written to scratch, as scoring reads it several times. Summing before the join leaves one row
    per customer on both sides, already partitioned by the join key.
    """
    extra = DETAILS if details else []
    totals = _per_customer(transactions).drop("row_count")
    return materialise(totals.join(customers.select("customer_id", *extra), "customer_id"), "totals")


def _with_recency(totals: DataFrame, reference_date: datetime.date | None) -> DataFrame:
    days = F.datediff(F.lit(reference_date).cast("date"), F.col("last_purchase"))
    return totals.withColumn("recency", days.cast("long"))


def reference_date(totals: DataFrame) -> DataFrame:
    """The day after the last purchase of anybody."""
    return totals.agg(F.date_add(F.max("last_purchase"), 1).alias("reference_date"))


def base(totals: DataFrame) -> DataFrame:
    """(customer_id, recency in days, frequency, monetary)."""
    day = reference_date(totals).scalar()
    recency = F.datediff(day, F.col("last_purchase")).cast("long").alias("recency")
    return totals.select("customer_id", recency, "frequency", "monetary")


def summary(totals: DataFrame) -> DataFrame:
    """Customers and their mean recency, frequency and spend."""
    means = base(totals).agg(
        F.count("customer_id").alias("customers"),
        F.avg("recency").alias("recency"),
        F.avg("frequency").alias("frequency"),
        (F.sum("monetary").cast("double") / F.nullif(F.count("monetary"), F.lit(0))).alias("monetary"),
    )
    return means.select(
        "customers",
        round_half_even(F.col("recency"), 0).alias("avg_recency"),
        round_half_even(F.col("frequency"), 1).alias("avg_frequency"),
        round_half_even(F.col("monetary"), 2).alias("avg_monetary"),
    )


def fit(totals: DataFrame, sample: int = SAMPLE) -> Cuts:
    """Find the fifths. Raises where they are not defined, as quantile binning must.

    Frequency and spend are cut at exact ranks; ``sample`` rows bracket them (see ``rank_cuts``).

    The quantiles of the last purchase day are exact: the aggregate keeps a count per distinct day,
    and there are only so many days. Recency counts the days the other way round.
    """
    day = F.unix_date("last_purchase")
    found = totals.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count("last_purchase").alias("dated"),
        F.max("last_purchase").alias("last"),
        F.min(day).alias("lo"),
        F.max(day).alias("hi"),
        F.percentile(day, F.array(*[F.lit(p) for p in (0.8, 0.6, 0.4, 0.2)])).alias("days"),
    ).first()
    if found.customers == 0:
        return Cuts(None, [], [], [])
    if found.dated < found.customers:
        raise ValueError("a customer without any dated purchase has no recency")
    today = found.hi + 1
    fifths = [round(5 * (today - d)) for d in found.days]
    edges = [5, *fifths, 5 * (today - found.lo)]
    if any(upper <= lower for lower, upper in zip(edges, edges[1:])):
        raise ValueError("recency quintile edges must be unique")
    ranked = rank_cuts(totals, "customer_id", ["frequency", "monetary"], sample=sample)
    return Cuts(found.last + datetime.timedelta(days=1), fifths, ranked["frequency"], ranked["monetary"])


def score(totals: DataFrame, cuts: Cuts) -> DataFrame:
    """Add recency, the three scores from 1 to 5 and their mean."""
    rows = _with_recency(totals, cuts.reference_date)
    r_score = F.lit(1)
    for points, edge in zip((2, 3, 4, 5), reversed(cuts.recency_fifths)):
        r_score = F.when(F.col("recency") * 5 <= F.lit(edge), F.lit(points)).otherwise(r_score)
    rows = rows.withColumns({
        "r_score": r_score,
        "f_score": bucket_by_cuts("frequency", "customer_id", cuts.frequency),
        "m_score": bucket_by_cuts("monetary", "customer_id", cuts.monetary),
        "monetary": F.col("monetary").cast("double"),
    })
    mean = (F.col("r_score") + F.col("f_score") + F.col("m_score")) / F.lit(3.0)
    return rows.withColumn("rfm_score", round_half_even(mean, 2)).drop("last_purchase")


def segment(scored: DataFrame) -> DataFrame:
    return scored.withColumn("segment", segment_of_scores())


def scored_customers(transactions: DataFrame, customers: DataFrame, details: bool = False) -> DataFrame:
    """Everybody's scores and segment, from transactions in one go."""
    totals = customer_totals(transactions, customers, details)
    return segment(score(totals, fit(totals)))


def customer_rfm(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """The derived customer table: scores, segment and details of every customer who bought."""
    return scored_customers(transactions, customers, details=True).select(CUSTOMER_RFM_COLUMNS)


def segment_summary(rfm: DataFrame) -> DataFrame:
    """Size, means and revenue per segment, largest revenue first."""
    spent = F.col("monetary").cast("decimal(22,2)")
    grouped = rfm.groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        F.avg("recency").alias("recency"),
        F.avg("frequency").alias("frequency"),
        F.sum(spent).cast("double").alias("revenue"),
    )
    return grouped.select(
        "segment",
        "customers",
        round_half_even(F.col("recency"), 2).alias("avg_recency"),
        round_half_even(F.col("frequency"), 2).alias("avg_frequency"),
        round_half_even(F.col("revenue") / F.col("customers"), 2).alias("avg_monetary"),
        F.col("revenue").alias("total_revenue"),
    ).orderBy(F.col("total_revenue").desc(), "segment")


def segment_actions(rfm: DataFrame) -> DataFrame:
    """Segments by size with the action each calls for."""
    sizes = rfm.groupBy("segment").agg(F.count("customer_id").alias("customers"))
    return sizes.withColumn("action", action_for(F.col("segment"))).orderBy(F.col("customers").desc(), "segment")


def score_histogram(rfm: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(rfm, "rfm_score", bins).withColumnRenamed("row_count", "customers")
