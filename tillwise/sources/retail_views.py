"""Retail views and messy raw feeds derived from order, part, customer and supplier tables.

The input tables are clean, so the defects a feed must show are put in by rules on the keys. The
texts below are plain SELECTs without dialect features: Spark runs them over the parquet tables, and
a checker can run the same texts elsewhere to get the same inputs.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators.conform import append_extracts
from tillwise.schemas import STAR
from tillwise.sources.feeds import ORDINAL, normalise

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# A line is a return when it is flagged and untaxed.
_IS_RETURN = "(l_returnflag = 'R' AND l_tax = 0)"

_LINE_COLUMNS = f"""
    l_orderkey * 10 + l_linenumber AS transaction_id,
    l_partkey AS product_id,
    CASE WHEN l_orderkey % 7 <> 0 THEN l_suppkey END AS store_id,
    CASE WHEN {_IS_RETURN} THEN -1 ELSE CAST(l_quantity AS INT) END AS quantity,
    CAST(l_discount AS DECIMAL(5,2)) AS discount_pct,
    CAST(CASE WHEN {_IS_RETURN} THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(12,2))
        AS total_value,
    CASE WHEN l_orderkey % 7 = 0 THEN 'Online' ELSE 'In-Store' END AS channel"""

VIEWS = {
    # Lines alone: enough for every report that needs neither date, customer nor payment.
    "lines": f"SELECT {_LINE_COLUMNS} FROM {{lineitem}}",
    # Lines with their order header. A line without a header stays, undated and without customer, so
    # that "lines" and "transactions" have the same rows as long as o_orderkey is unique.
    "transactions": f"""
SELECT {_LINE_COLUMNS},
    CAST(o_orderdate AS DATE) AS transaction_date,
    CASE WHEN l_orderkey % 12 <> 0 THEN o_custkey END AS customer_id,
    o_orderpriority AS payment_method
FROM {{lineitem}} LEFT JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "customers": """
SELECT c_custkey AS customer_id, c_name AS full_name, r_name AS region, c_mktsegment AS age_group,
    c_acctbal >= 0 AS loyalty_member
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "products": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
    CAST(p_retailprice AS DECIMAL(10,2)) AS sell_price,
    CASE WHEN p_partkey % 8 <> 0 THEN CAST(p_size AS DECIMAL(10,2)) END AS cost_price,
    p_brand AS supplier, p_size > 12 AS in_stock
FROM {part}""",
    "stores": """
SELECT s_suppkey AS store_id, s_name AS store_name, r_name AS region,
    DATE '1994-01-01' + CAST(s_suppkey * 37 % 3000 AS INT) AS opening_date
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
}


def _slashed(date: str, day_first: bool) -> str:
    parts = [f"lpad(CAST({part}({date}) AS STRING), 2, '0')" for part in ("day", "month")]
    first, second = parts if day_first else reversed(parts)
    return f"{first} || '/' || {second} || '/' || CAST(year({date}) AS STRING)"


_CUSTOMER_ROW = """
SELECT {id} AS customer_id, {name} AS full_name, {email} AS email,
    '07' || CAST(100000000 + k AS STRING) AS phone, region, 'PC' || CAST(k % 977 AS STRING) AS postcode,
    CASE WHEN k % 601 = 600 THEN 'soon' ELSE CAST(DATE '2019-01-01' + CAST(k % 1000 AS INT) AS STRING) END
        AS signup_date,
    CASE WHEN loyal THEN 'True' ELSE 'False' END AS loyalty_member, age_group, {copy} AS o1, k AS o2
FROM people {where}"""

_PERSON_NAME = "CASE WHEN k % 20 < 3 THEN upper(name) WHEN k % 20 < 5 THEN lower(name) ELSE name END"
_PERSON_EMAIL = """CASE WHEN k % 12 = 0 THEN '' WHEN k % 12 = 5 THEN 'N/A'
        ELSE 'Cust.' || CAST(k AS STRING) || '@Example.COM' END"""

_PEOPLE = """
WITH people AS (
    SELECT c_custkey AS k, c_mktsegment || ' o''' || n_name || '-' || r_name || ' ' ||
        CAST(c_custkey % 10 AS STRING) || 'rd' AS name,
        r_name AS region, c_mktsegment AS age_group, c_acctbal >= 0 AS loyal
    FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey)"""

# Three customer extracts: everybody; the same person again under a new id; the same id again with
# another name.
CUSTOMER_EXTRACTS = {
    "base": _PEOPLE + _CUSTOMER_ROW.format(
        id="'C' || CAST(k AS STRING)", name=_PERSON_NAME, email=_PERSON_EMAIL, copy=0, where=""),
    "renumbered": _PEOPLE + _CUSTOMER_ROW.format(
        id="'D' || CAST(k AS STRING)", name=_PERSON_NAME, email=f"replace({_PERSON_EMAIL}, '.', '_')",
        copy=1, where="WHERE k % 33 = 1"),
    "repeated": _PEOPLE + _CUSTOMER_ROW.format(
        id="'C' || CAST(k AS STRING)", name="'Impostor ' || CAST(k AS STRING)", email=_PERSON_EMAIL,
        copy=2, where="WHERE k % 50 = 7"),
}

_OPENED = "(DATE '2016-01-01' + CAST(s_suppkey * 37 % 3000 AS INT))"

# Cells and place of one row of the transaction feed.
_TRANSACTION_CELLS = """'T' || CAST(l_orderkey * 10 + l_linenumber AS STRING) AS transaction_id,
    CASE WHEN l_orderkey % 113 = 5 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE){late} AS STRING) END AS transaction_date,
    CASE WHEN l_orderkey % 24 = 0 THEN 'NA' WHEN l_orderkey % 12 = 0 THEN ''
         WHEN l_orderkey % 40 = 1 THEN 'C-' || CAST(o_custkey AS STRING)
         ELSE 'C' || CAST(o_custkey AS STRING) END AS customer_id,
    CASE WHEN l_orderkey % 50 = 3 THEN 'X' || CAST(l_partkey AS STRING)
         ELSE 'P' || CAST(l_partkey AS STRING) END AS product_id,
    CASE WHEN l_orderkey % 7 = 0 THEN '' WHEN l_orderkey % 45 = 2 THEN 'Z' || CAST(l_suppkey AS STRING)
         ELSE 'S' || CAST(l_suppkey AS STRING) END AS store_id,
    CASE WHEN l_partkey % 307 = 9 THEN 'some' ELSE CAST(
        CASE WHEN {is_return} THEN -1 WHEN l_partkey % 211 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END
        AS STRING) END AS quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) AS unit_price,
    CAST(CAST(l_discount AS DECIMAL(5,2)) AS STRING) AS discount_pct,
    CAST(CAST(CASE WHEN {is_return} THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(10,2)) AS STRING)
        AS total_value,
    o_orderpriority AS payment_method,
    CASE WHEN l_orderkey % 7 = 0 THEN 'Online' ELSE 'In-Store' END AS channel,
    l_partkey + {later} AS o1, l_suppkey AS o2, l_quantity AS o3, l_extendedprice AS o4, l_discount AS o5,
    l_tax AS o6, l_returnflag AS o7, l_linestatus AS o8, l_shipdate AS o9"""

# One row of the transaction feed. Some come again at the end of the feed with a date in another month.
_TRANSACTION_ROW = f"""
SELECT {_TRANSACTION_CELLS}
FROM {{{{lineitem}}}} LEFT JOIN {{{{orders}}}} ON l_orderkey = o_orderkey {{where}}"""
_LATE_DAYS, _LATE_PLACES, _IS_LATE = 45, 100_000_000, "l_orderkey % 97 = 11"

# The last columns (o1, o2, ...) say where the row stood in the feed.
FEEDS = {
    "products": """
SELECT 'P' || CAST(p_partkey AS STRING) AS product_id, p_name AS product_name,
    CASE WHEN p_partkey % 10 = 0 THEN upper(p_type || ' & Garden')
         WHEN p_partkey % 10 = 1 THEN '  ' || lower(p_type || ' & Garden') || ' '
         ELSE p_type || ' & Garden' END AS category,
    CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 40 = 39 THEN repeat(p_name || ' ', 25)
         ELSE p_brand || ' ' || p_name END AS description,
    CASE WHEN p_partkey % 501 = 500 THEN 'call us' WHEN p_partkey % 499 = 498 THEN '100000000000'
         WHEN p_partkey % 97 = 0 THEN 'nan'
         WHEN p_partkey % 24 = 0 THEN ' £ ' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING)
         WHEN p_partkey % 12 = 0 THEN '£' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING)
         ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) END AS sell_price,
    CASE WHEN p_partkey % 8 = 0 THEN ''
         ELSE CAST(CAST(p_size AS DECIMAL(10,2)) AS STRING) END AS cost_price,
    p_brand AS supplier, CASE WHEN p_size > 12 THEN 'True' ELSE 'False' END AS in_stock,
    CAST(DATE '2015-01-01' + CAST(p_partkey % 2000 AS INT) AS STRING) AS launch_date, p_partkey AS o1
FROM {part}""",
    "stores": f"""
SELECT 'S' || CAST(s_suppkey AS STRING) AS store_id, s_name AS store_name,
    CASE WHEN s_suppkey % 37 = 36 THEN 'Atlantis' WHEN s_nationkey % 10 = 0 THEN 'Greater London'
         WHEN s_nationkey % 10 = 1 THEN 'SE England' WHEN s_nationkey % 10 = 2 THEN 'NW England'
         WHEN s_nationkey % 10 = 3 THEN 'Yorkshire & Humber' WHEN s_nationkey % 10 = 4 THEN 'W. Midlands'
         WHEN s_nationkey % 10 = 5 THEN 'East England' WHEN s_nationkey % 10 = 6 THEN 'SW England'
         WHEN s_nationkey % 10 = 7 THEN 'NE England' WHEN s_nationkey % 10 = 8 THEN 'Scotland'
         ELSE 'Wales' END AS region,
    'ST' || CAST(s_suppkey % 89 AS STRING) AS postcode,
    CAST(2000 + s_suppkey * 13 % 23000 AS STRING) AS store_size_sqft,
    CAST(10 + s_suppkey % 140 AS STRING) AS num_staff,
    CASE WHEN s_suppkey % 10 = 5 THEN '' ELSE 'Manager ' || CAST(s_suppkey AS STRING) END AS manager_name,
    CASE WHEN s_suppkey % 41 = 40 THEN 'not yet' WHEN s_suppkey % 53 = 52 THEN ''
         WHEN s_suppkey % 10 = 9 AND day({_OPENED}) > 12 THEN {_slashed(_OPENED, day_first=False)}
         WHEN s_suppkey % 3 = 0 THEN {_slashed(_OPENED, day_first=True)}
         ELSE CAST({_OPENED} AS STRING) END AS opening_date,
    CASE WHEN s_suppkey % 7 = 0 THEN 'True' ELSE 'False' END AS is_flagship, s_suppkey AS o1
FROM {{supplier}}""",
    "transactions": _TRANSACTION_ROW.format(is_return=_IS_RETURN, late="", later=0, where="") + " UNION ALL " + _TRANSACTION_ROW.format(
        is_return=_IS_RETURN, late=f" + {_LATE_DAYS}", later=_LATE_PLACES, where=f"WHERE {_IS_LATE}"),
}


@lru_cache(maxsize=1024)
def _schema(spark: SparkSession, path: str) -> T.StructType:
    # Reading a schema from parquet footers is a job of its own; once per table is enough.
    return spark.read.parquet(path).schema


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def _run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {t: _table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One clean retail view: lines, transactions, customers, products or stores."""
    return _run(spark, sf_dir, VIEWS[name])


def raw_feed(spark: SparkSession, sf_dir: str, feed: str, extract: str | None = None) -> DataFrame:
    """One messy feed as text columns plus its ordinal, null tokens already nulls."""
    return normalise(untouched_feed(spark, sf_dir, feed, extract), STAR[feed])


def untouched_feed(spark: SparkSession, sf_dir: str, feed: str, extract: str | None = None) -> DataFrame:
    """The feed exactly as a CSV file would hold it, plus its ordinal.

    The customer feed stacks its extracts; ``extract`` names a single one.
    """
    if feed != "customers":
        raw = _run(spark, sf_dir, FEEDS[feed])
    elif extract:
        raw = _run(spark, sf_dir, CUSTOMER_EXTRACTS[extract])
    else:
        raw = append_extracts(*[_run(spark, sf_dir, text) for text in CUSTOMER_EXTRACTS.values()])
    columns = STAR[feed].columns
    place = [c for c in raw.columns if c not in columns]
    return raw.select(*columns, F.struct(*place).alias(ORDINAL))


def ordered_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """``untouched_feed`` in the order of its ordinal.

    Rows of the transaction feed are put in order as the numbers and dates they are made of, once for both of its parts,
    and written out as cells after that: so the sort moves and holds about half the bytes, and the rows are the same.
    """
    if feed != "transactions":
        return untouched_feed(spark, sf_dir, feed).orderBy(ORDINAL)
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    used = lines.select([c for c in lines.columns if c in _TRANSACTION_CELLS + _IS_RETURN + _IS_LATE])
    day = F.col("o_orderdate").cast("date").alias("o_orderdate")  # no cell shows more of it
    headed = used.join(orders.select("o_orderkey", "o_custkey", day, "o_orderpriority"), F.expr("l_orderkey = o_orderkey"), "left")
    copies = F.when(F.expr(_IS_LATE), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    headed = headed.drop("o_orderkey").withColumn("late", F.explode(copies))
    text = _TRANSACTION_CELLS.format(
        is_return=_IS_RETURN, late=f" + late * {_LATE_DAYS}", later=f"late * {_LATE_PLACES}")
    later = F.expr(f"l_partkey + late * {_LATE_PLACES}")
    place = ["l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    cells = spark.sql(f"SELECT {text} FROM {{headed}}", headed=headed.orderBy(later, *place))
    numbered = [c for c in cells.columns if c not in STAR[feed].columns]
    return cells.select(*STAR[feed].columns, F.struct(*numbered).alias(ORDINAL))
