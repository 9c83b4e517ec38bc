"""Prices, line totals and the two rounding rules."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of the sell price taken as cost, and the price of a product nobody can price.
COST_SHARE = "0.60"
FALLBACK_PRICE = "9.99"

MONEY = "decimal(10,2)"


def parse_price(col: Column) -> Column:
    """Drop every pound sign and surrounding space; null when the rest is no number that fits."""
    return F.trim(F.replace(col, F.lit("£"), F.lit(""))).try_cast(MONEY)


def impute_cost(cost: Column, sell: Column) -> Column:
    return F.coalesce(cost, F.round(sell * F.lit(COST_SHARE).cast("decimal(3,2)"), 2)).cast(MONEY)


def line_total(price: Column, quantity: Column, discount: Column) -> Column:
    return F.round(price * quantity * (F.lit(1).cast("decimal(1,0)") - discount), 2)


# Digits behind the point that a ratio's operands may have, as the factor that makes them whole numbers.
_WHOLE = Decimal(10**6)
_WIDE = "decimal(38,0)"


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Exact decimal division rounded half away from zero, as a database rounds NUMERIC; null over zero.

    Decimal division keeps as few as six digits when its operands are declared wide, and rounding these
    again can cross a tie. So both are made whole numbers (up to six decimals) and divided with
    remainder. The result is DECIMAL(28, digits) whatever the declared width of the operands.
    """
    above = F.abs(numerator * F.lit(_WHOLE)).cast(_WIDE)
    below = F.abs(F.nullif(denominator, F.lit(0)) * F.lit(_WHOLE)).cast(_WIDE)
    doubled = above * F.lit(Decimal(2 * 10**digits)) + below
    size = F.call_function("div", doubled, below * F.lit(Decimal(2))).cast("decimal(19,0)")
    scaled = (size * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(28,{digits})")
    return F.when((numerator < 0) != (denominator < 0), -scaled).otherwise(scaled)


def round_half_even(col: Column, digits: int) -> Column:
    """Round a double the way numpy and pandas do: scale, round ties to even, scale back."""
    scale = F.lit(float(10**digits))
    return F.rint(col.cast("double") * scale) / scale
