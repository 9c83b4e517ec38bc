"""Small fixed mappings applied as literal maps."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region names of the store system and what the customer system calls them.
REGION_NAMES = {
    "Greater London": "London",
    "SE England": "South East",
    "NW England": "North West",
    "Yorkshire & Humber": "Yorkshire",
    "W. Midlands": "West Midlands",
    "East England": "East of England",
    "SW England": "South West",
    "NE England": "North East",
    "Scotland": "Scotland",
    "Wales": "Wales",
}

# The action recommended for a segment; the two segments left out have none.
SEGMENT_ACTIONS = {
    "Hibernating": "Win-back campaign — biggest opportunity",
    "Loyal Customer": "Upsell premium products",
    "New Customer": "Welcome nurture sequence",
    "At Risk": "Urgent retention offer this week",
    "Potential Loyalist": "Loyalty programme invitation",
    "Champion": "VIP rewards, early access",
    "Lost": "Final reactivation attempt",
}


def lookup(col: Column, mapping: dict[str, str]) -> Column:
    """Mapped value, null when the key is not in the mapping."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(literal, col)


def harmonise_region(col: Column) -> Column:
    """Unknown names stay as they are."""
    return F.coalesce(lookup(col, REGION_NAMES), col)


def action_for(segment: Column) -> Column:
    return lookup(segment, SEGMENT_ACTIONS)
