"""Distinct counts from sketches kept by month, beside the exact ones of the reports.

A sketch (HyperLogLog, as Spark's ``hll_sketch_agg`` makes it) has a fixed size however many ids it has seen, and sketches
of months merge into those of years or of all time. So the facts of a month are read once, when the month changes, and a
distinct count over any span of months reads one small row a month. Exact counts shuffle every id once.

An estimate deviates from the true count by a relative standard error of ``standard_error()``, 0.81 % for the default
size; ``BOUND`` standard errors are exceeded in fewer than one of ten thousand counts. Small counts are exact or nearly so.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import month_start
from tillwise.plans.sales import sales
from tillwise.sources.warehouse import read_derived, replace_table

LG_SIZE = 14  # sketches of 2**14 registers
BOUND = 4
COUNTED = ["customer_id", "store_id", "product_id"]


def standard_error(lg_size: int = LG_SIZE) -> float:
    """Relative standard error of a merged sketch."""
    return 1.04 / sqrt(2**lg_size)


def month_sketches(transactions: DataFrame, lg_size: int = LG_SIZE) -> DataFrame:
    """(month, one sketch per counted column) of the sales of each month; a null month holds sales without a date."""
    month = month_start(F.col("transaction_date")).alias("month")
    sketches = [F.hll_sketch_agg(c, F.lit(lg_size)).alias(c) for c in COUNTED]
    return sales(transactions).groupBy(month).agg(*sketches)


def refreshed(kept: DataFrame, changed: DataFrame) -> DataFrame:
    """Sketches with those of the changed months in place of their old ones; other months are not computed again."""
    old = kept.join(changed.select(F.col("month").alias("_month")), F.col("month").eqNullSafe(F.col("_month")), "left_anti")
    return old.unionByName(changed)


def keep(spark: SparkSession, sketches: DataFrame, target: str) -> DataFrame:
    """Write the table of sketches and read it back."""
    replace_table(sketches, target)
    return read_derived(spark, target)


def distinct_counts(sketches: DataFrame, by: Column | None = None) -> DataFrame:
    """Estimated distinct ids per value of ``by`` (a column over ``month``, named), or of all months together."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in COUNTED]
    return sketches.agg(*merged) if by is None else sketches.groupBy(by).agg(*merged)


def beside_exact(transactions: DataFrame, sketches: DataFrame) -> DataFrame:
    """(year, kind, ids, within): exact distinct ids of each year, and whether the merged estimate is within its bound."""
    year = F.year("month").alias("year")
    guessed = distinct_counts(sketches, year)
    exact = sales(transactions).groupBy(F.year("transaction_date").alias("year")).agg(*[F.count_distinct(c).alias(c) for c in COUNTED])
    true, found = exact.unpivot("year", COUNTED, "kind", "ids"), guessed.unpivot("year", COUNTED, "kind", "guess")
    found = found.select(F.col("year").alias("_year"), F.col("kind").alias("_kind"), "guess")
    both = true.join(found, F.col("year").eqNullSafe(F.col("_year")) & (F.col("kind") == F.col("_kind")))
    off, most = F.abs(F.col("guess") - F.col("ids")), F.greatest(F.lit(1.0), F.col("ids") * (BOUND * standard_error()))
    return both.select("year", "kind", "ids", (off <= most).alias("within"))
