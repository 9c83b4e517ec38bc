import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillwise.functions import dates, lookups, numbers, text
from tillwise.functions.segments import SEGMENT_RULES, segment_of_scores


def values(spark, function, cells, kind="string"):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}").coalesce(1)
    return [r[0] for r in rows.select(function(F.col("c")).alias("v"), "i").orderBy("i").select("v").collect()]


def test_title_case_is_that_of_python(spark):
    cells = ["o'brien SMITH-ward 3rd a_b", "MC DONALD", "HOME & GARDEN", "", "  x  y ", "éCOLE", "straße",
             "中文abc", "a1b2", "ÀÉÎ õü", None]
    assert values(spark, text.title_case, cells) == [c if c is None else c.title() for c in cells]


def test_strip_removes_what_python_strips(spark):
    cells = ["  a b ", "\t\na\r", " a ", "\x1ca\x1f", "", None]
    assert values(spark, text.strip, cells) == [c if c is None else c.strip() for c in cells]


def test_null_tokens_are_whole_cells(spark):
    cells = ["NA", "n/a", "", "nan", " NA", "NAN", "Nadia", None]
    assert values(spark, text.null_if_token, cells) == [None, None, None, None, " NA", "NAN", "Nadia", None]


def test_mixed_dates_are_day_first(spark):
    cells = ["2020-01-03", "12/03/2018", "15/05/2019", "05/13/2019", "x", "2019-13-05", "31/02/2019", None]
    day = datetime.date
    assert values(spark, dates.parse_mixed_date, cells) == [
        day(2020, 1, 3), day(2018, 3, 12), day(2019, 5, 15), day(2019, 5, 13), None, None, None, None]


def test_iso_dates_take_nothing_else(spark):
    cells = ["2020-02-29", "2021-02-29", "2020", "2020-1-3", "2020-01-03 10:00:00", "03/01/2020", None]
    assert values(spark, dates.parse_iso_date, cells) == [datetime.date(2020, 2, 29)] + [None] * 6


def test_prices(spark):
    cells = ["£9.99", "9.99", " £ 9.99 ", "££1", "call us", "100000000000", "-0.5", None]
    got = values(spark, numbers.parse_price, cells)
    assert [None if v is None else str(v) for v in got] == [
        "9.99", "9.99", "9.99", "1.00", None, None, "-0.50", None]


def test_cost_is_imputed_only_where_missing(spark):
    rows = spark.sql("SELECT CAST(5.99 AS DECIMAL(10,2)) AS sell, CAST(NULL AS DECIMAL(10,2)) AS missing, "
                     "CAST(2 AS DECIMAL(10,2)) AS cost")
    got = rows.select(numbers.impute_cost(F.col("missing"), F.col("sell")),
                      numbers.impute_cost(F.col("cost"), F.col("sell"))).first()
    assert [str(v) for v in got] == ["3.59", "2.00"]


def test_line_total_rounds_half_up(spark):
    rows = spark.sql("SELECT CAST(0.25 AS DECIMAL(10,2)) AS p, 1 AS q, CAST(0.50 AS DECIMAL(5,2)) AS d")
    assert str(rows.select(numbers.line_total(F.col("p"), F.col("q"), F.col("d"))).first()[0])[:4] == "0.13"


def test_half_even_rounds_as_numpy(spark):
    import numpy as np

    cells = [0.125, 0.375, 2.675, 1.115, 1.005, 2.5, -0.125, 1234567.885]
    assert values(spark, lambda c: numbers.round_half_even(c, 2), cells, "double") == list(np.round(cells, 2))


def test_ratio_over_zero_is_null(spark):
    rows = spark.sql("SELECT CAST(1 AS DECIMAL(10,2)) AS a, 0L AS b")
    assert rows.select(numbers.ratio(F.col("a"), F.col("b"), 2)).first()[0] is None


def test_unknown_regions_stay(spark):
    cells = ["NW England", "W. Midlands", "Scotland", "Atlantis", None]
    assert values(spark, lookups.harmonise_region, cells) == [
        "North West", "West Midlands", "Scotland", "Atlantis", None]


def test_segments_of_all_score_triples(spark):
    triples = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    rows = spark.createDataFrame(triples, "r_score int, f_score int, m_score int")
    assert Counter(r[0] for r in rows.select(segment_of_scores()).collect()) == {
        "Champion": 8, "Loyal Customer": 19, "New Customer": 20, "Potential Loyalist": 20, "At Risk": 18,
        "Lost": 8, "Hibernating": 32}


@pytest.mark.parametrize("segment", [s for s, _ in SEGMENT_RULES])
def test_actions(spark, segment):
    action = spark.range(1).select(lookups.action_for(F.lit(segment))).first()[0]
    assert (action is None) == (segment in ("Needs Attention", "Cannot Lose Them"))
