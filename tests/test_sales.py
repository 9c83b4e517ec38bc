import datetime
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tillwise.plans import dashboards, sales
from tillwise.sources import warehouse

D = datetime.date
ROWS = [
    # id, date, customer, product, store, quantity, value, payment, channel
    ("T1", D(2022, 1, 5), "C1", "P1", "S1", 2, "10.00", "Card", "In-Store"),
    ("T2", D(2022, 1, 9), "C1", "P2", "S2", 1, "20.00", "Cash", "In-Store"),
    ("T3", D(2022, 2, 1), None, "P3", None, 3, "5.01", "Card", "Online"),
    ("T4", D(2023, 2, 1), "C2", "P1", "S1", 1, "0.02", None, "In-Store"),
    ("T5", D(2023, 2, 2), "C2", "P1", "S1", -1, "-7.00", "Card", "In-Store"),
    ("T6", D(2023, 2, 2), "C3", "gone", "S9", -1, "-1.00", "Card", "In-Store"),
    ("T7", D(2023, 2, 3), "C3", "P2", "S1", 0, "99.00", "Card", "In-Store"),
    ("T8", None, "C3", "P2", "S9", 1, None, "Card", "In-Store"),
]


@pytest.fixture(scope="module")
def tables(spark):
    schema = ("transaction_id string, transaction_date date, customer_id string, product_id string, "
              "store_id string, quantity int, total_value string, payment_method string, channel string")
    tx = spark.createDataFrame(ROWS, schema).withColumn("total_value", F.col("total_value").cast("decimal(10,2)"))
    products = spark.createDataFrame(
        [("P1", "Lamp", "Home", True), ("P2", "Tea", "Food", True), ("P3", "Lamp", "Home", False)],
        "product_id string, product_name string, category string, in_stock boolean")
    stores = spark.createDataFrame(
        [("S1", "Wales"), ("S2", "Wales"), ("S3", "London")], "store_id string, region string")
    return tx, products, stores


def got(df):
    return [tuple(str(v) if isinstance(v, Decimal) else v for v in r) for r in df.collect()]


def test_business_summary(tables):
    want = [(5, 3, 3, 3, "35.03", "8.76", D(2022, 1, 5), D(2023, 2, 1))]
    assert got(sales.business_summary(tables[0])) == want
    assert got(sales.business_summary(tables[0], unique_ids=True)) == want


def test_summary_of_nothing(tables):
    empty = sales.business_summary(tables[0].where("quantity > 1000"))
    assert got(empty) == [(0, 0, 0, 0, None, None, None, None)]


def test_monthly_trend_has_the_undated_last(tables):
    months = got(sales.monthly_trend(tables[0]))
    assert months == [
        (D(2022, 1, 1), 2, 1, "30.00", "15.00"), (D(2022, 2, 1), 1, 0, "5.01", "5.01"),
        (D(2023, 2, 1), 1, 1, "0.02", "0.02"), (None, 1, 1, None, None)]


def check_dimensions(tx, products, stores):
    assert got(sales.revenue_by_category(tx, products)) == [
        ("Food", 2, 2, "20.00", "20.00", "57.1"), ("Home", 3, 6, "15.03", "5.01", "42.9")]
    # Two products named Lamp count as one.
    assert got(sales.top_products(tx, products, 1)) == [("Tea", "Food", 2, 2, "20.00")]
    assert got(sales.top_products(tx, products))[1] == ("Lamp", "Home", 3, 6, "15.03")
    assert got(sales.revenue_by_region(tx, stores)) == [("Wales", 2, 3, "30.02", "15.01")]
    # The return of an unknown product counts in the total only.
    assert got(sales.returns_by_category(tx, products)) == [("Home", 1, "7.00", "50.0")]


def test_reports_over_dimensions(tables):
    check_dimensions(*tables)


def test_reports_over_large_dimensions(tables, no_broadcast):
    check_dimensions(*tables)


def test_null_groups_stay_and_sort_first_descending(tables):
    assert got(sales.payment_breakdown(tables[0])) == [
        ("Card", 3, "15.01", "7.51"), (None, 1, "0.02", "0.02"), ("Cash", 1, "20.00", "20.00")]
    assert got(sales.channel_split(tables[0])) == [
        ("In-Store", 4, 3, "30.02", "10.01"), ("Online", 1, 0, "5.01", "5.01")]


def test_dashboards(tables):
    tx, products, stores = tables
    assert got(dashboards.channel_share(tx)) == [("In-Store", "30.02", "85.7"), ("Online", "5.01", "14.3")]
    assert got(dashboards.stock_status(products)) == [(False, 1, "33.3"), (True, 2, "66.7")]
    page = dashboards.sales_overview(tx, stores, 2022)
    assert got(page["kpi"]) == [(2022, "35.01", 3, 1, "11.67")]
    assert set(dashboards.product_page(tx, products, 2022)) == {
        "revenue_by_category", "top_products", "returns_by_category", "stock_status"}


def test_year_slicer_prunes_months_and_reaches_the_scan(spark, tables, tmp_path):
    rows = tables[0].withColumn("unit_price", F.lit(1)).withColumn("discount_pct", F.lit(0))
    warehouse.write_table(rows, str(tmp_path), "transactions")
    loaded = warehouse.read_table(spark, str(tmp_path), "transactions")
    one_year = sales.in_year(loaded, 2022)
    assert one_year.count() == 3
    plan = plan_of(sales.monthly_trend(one_year))
    assert "PartitionFilters: [isnotnull(transaction_month" in plan
    assert re.search(r"PushedFilters: \[[^\]]*\(transaction_date", plan)
    read = plan[plan.index("ReadSchema"):]
    assert "payment_method" not in read and "store_id" not in read


REPORTS = {
    "business_summary": lambda tx, p, s: sales.business_summary(tx),
    "monthly_trend": lambda tx, p, s: sales.monthly_trend(tx),
    "revenue_by_category": lambda tx, p, s: sales.revenue_by_category(tx, p),
    "top_products": lambda tx, p, s: sales.top_products(tx, p),
    "revenue_by_region": lambda tx, p, s: sales.revenue_by_region(tx, s),
    "channel_split": lambda tx, p, s: sales.channel_split(tx),
    "returns_by_category": lambda tx, p, s: sales.returns_by_category(tx, p),
    "payment_breakdown": lambda tx, p, s: sales.payment_breakdown(tx),
    "stock_status": lambda tx, p, s: dashboards.stock_status(p),
    "channel_share": lambda tx, p, s: dashboards.channel_share(tx),
}


@pytest.mark.parametrize("name", REPORTS)
def test_size_of_a_dimension_changes_neither_types_nor_values(spark, tables, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before, found = spark.conf.get(key), []
    for threshold in (before, "-1"):
        spark.conf.set(key, threshold)
        report = REPORTS[name](*tables)
        found.append((report.dtypes, got(report)))
    spark.conf.set(key, before)
    assert found[0] == found[1]


def test_share_of_large_totals_is_rounded_once(spark, no_broadcast):
    tx = spark.sql("""SELECT t.*, CAST(v AS DECIMAL(12,2)) AS total_value FROM VALUES
        ('T1', 'P1', 1, '1234999997.00'), ('T2', 'P2', 1, '8765000003.00') AS t(transaction_id, product_id, quantity, v)""")
    products = spark.sql("SELECT * FROM VALUES ('P1', 'Home'), ('P2', 'Food') AS t(product_id, category)")
    found = {r.category: str(r.revenue_pct) for r in sales.revenue_by_category(tx, products).collect()}
    assert found == {"Home": "12.3", "Food": "87.7"}


def test_headline_facts_need_the_order_header_once(spark):
    from tillwise.sources.retail_views import view

    sf = "/root/testdata/sf0.001"
    tx, lines = view(spark, sf, "transactions"), view(spark, sf, "lines")
    scored = spark.createDataFrame([("Lost",)], "segment string")
    plan = plan_of(dashboards.headline_facts(tx, view(spark, sf, "products"), view(spark, sf, "stores"), scored, lines))
    assert len(re.findall(r"orders\.parquet", plan)) == 1
