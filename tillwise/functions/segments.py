"""Customer segments from the three scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rules in order; the first that holds names the segment. "Needs Attention" and
# "Cannot Lose Them" can never be reached, but the order of the rules is part of the result.
SEGMENT_RULES = [
    ("Champion", "r_score >= 4 AND f_score >= 4 AND m_score >= 4"),
    ("Loyal Customer", "r_score >= 3 AND f_score >= 3 AND m_score >= 3"),
    ("New Customer", "r_score >= 4 AND f_score <= 2"),
    ("Potential Loyalist", "r_score >= 3 AND f_score >= 2 AND m_score <= 2"),
    ("Needs Attention", "r_score = 3 AND f_score = 3"),
    ("At Risk", "r_score <= 2 AND f_score >= 3 AND m_score >= 3"),
    ("Cannot Lose Them", "r_score <= 2 AND f_score >= 4 AND m_score >= 4"),
    ("Lost", "r_score <= 2 AND f_score <= 2 AND m_score <= 2"),
]
OTHER_SEGMENT = "Hibernating"


def segment_of_scores() -> Column:
    """Segment of a row that has r_score, f_score and m_score."""
    first, *rest = SEGMENT_RULES
    cascade = reduce(
        lambda chain, rule: chain.when(F.expr(rule[1]), F.lit(rule[0])),
        rest,
        F.when(F.expr(first[1]), F.lit(first[0])),
    )
    return cascade.otherwise(F.lit(OTHER_SEGMENT))
