"""Shares of a grand total and equal-width histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.numbers import ratio


def share_of_total(value: str, digits: int = 1) -> Column:
    """Percentage of the sum over all rows, for frames that are already aggregated.

    The empty window gathers its input in one task, so use it only after grouping by a small fixed
    set of labels (categories, channels, stock states).
    """
    total = F.sum(value).over(Window.partitionBy())
    return ratio(F.col(value) * F.lit(100), total, digits)


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in ``bins`` equal-width bins from minimum to maximum, empty bins included.

    Bins are closed below and open above, the last is closed on both sides. If all values are equal
    the range reaches half a unit to either side. Returns bin (from 1), lower_edge, upper_edge,
    row_count; no row when ``df`` has no value.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x IS NOT NULL")
    half = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    bound = (
        values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        .where("lo IS NOT NULL")
        .select(F.struct((F.col("lo") - half).alias("lo"), (F.col("hi") + half).alias("hi")))
        .scalar()
    )
    numbered = df.sparkSession.range(1, bins + 1).select(
        F.col("id").cast("int").alias("bin"), bound["lo"].alias("lo"), bound["hi"].alias("hi")
    )
    edges = numbered.where("lo IS NOT NULL").select(
        "bin",
        _edge("lo", "hi", F.col("bin") - 1, bins).alias("lower_edge"),
        _edge("lo", "hi", F.col("bin"), bins).alias("upper_edge"),
    )
    per_value = values.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    placed = per_value.select("x", "n", bound["lo"].alias("lo"), bound["hi"].alias("hi"))
    guess = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int") + 1
    placed = placed.withColumn("bin", F.least(guess, F.lit(bins)))
    # Floating point may put a value that equals an edge one bin off; the edges decide.
    exact = (
        F.when(F.col("x") < _edge("lo", "hi", F.col("bin") - 1, bins), F.col("bin") - 1)
        .when((F.col("x") >= _edge("lo", "hi", F.col("bin"), bins)) & (F.col("bin") < bins), F.col("bin") + 1)
        .otherwise(F.col("bin"))
    )
    counts = placed.groupBy(exact.alias("bin")).agg(F.sum("n").alias("n"))
    return edges.join(counts, "bin", "left").select(
        "bin", "lower_edge", "upper_edge", F.coalesce("n", F.lit(0)).alias("row_count")
    )


def _edge(lo: str, hi: str, steps: Column, bins: int) -> Column:
    """Edge ``steps`` bins above the minimum; the last one is exactly the maximum."""
    width = (F.col(hi) - F.col(lo)) / bins
    return F.when(steps == bins, F.col(hi)).otherwise(F.col(lo) + steps * width)
