"""Date columns. Each parser gives null for text it cannot read; the caller decides whether that rejects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso_date(col: Column) -> Column:
    """``yyyy-MM-dd``, also with a midnight time behind it, as date columns are often exported.

    Nothing else: the cast alone would also take a bare year or any timestamp. It reads the text several
    times faster than a pattern parser does.
    """
    # the usual cell is told by its length and three characters; only others are matched with a pattern
    last = F.substring(col, 10, 1)
    usual = (F.length(col) == 10) & (F.substring(col, 5, 1) == "-") & (F.substring(col, 8, 1) == "-") & last.between("0", "9")
    midnight = col.rlike(r"^\d{4}-\d{2}-\d{2} 00:00:00(\.0+)?$")
    return F.when(usual, col.try_cast("date")).when(midnight, F.substring(col, 1, 10).try_cast("date"))


def parse_mixed_date(col: Column) -> Column:
    """ISO dates stay ISO; slashed dates are day first and fall back to month first."""
    return F.coalesce(
        parse_iso_date(col),
        F.try_to_date(col, "d/M/yyyy"),
        F.try_to_date(col, "M/d/yyyy"),
    )


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def month_label(col: Column) -> Column:
    """``yyyy-MM``: the partition value of the fact table, comparable as text."""
    return F.date_format(col, "yyyy-MM")
