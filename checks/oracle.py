"""DuckDB statements that say what each registered query must return.

Only the derivation of views and feeds from the tables is shared with the package; the operators are
stated again in SQL, with integer arithmetic wherever a rounding tie could be seen differently.
"""

from __future__ import annotations

import re

from tillwise.functions.lookups import REGION_NAMES, SEGMENT_ACTIONS
from tillwise.functions.text import NULL_TOKENS
from tillwise.schemas import STAR
from tillwise.sources.retail_views import CUSTOMER_EXTRACTS, FEEDS, TABLES, VIEWS

_NAMES = {t: t for t in TABLES}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _case(column: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {default} END"


def _half_up(num: str, den: str) -> str:
    """Integer quotient rounded half away from zero."""
    return f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def _cents(value: str) -> str:
    return f"CAST(({value}) * 100 AS HUGEINT)"


def _mean2(total: str, count: str) -> str:
    """Money total over a count, two digits."""
    return f"CASE WHEN ({count}) > 0 THEN CAST({_half_up(_cents(total), count)} AS DOUBLE) / 100 END"


def _pct1(part: str, whole: str) -> str:
    """100 * part / whole, one digit; both integers."""
    return f"CAST({_half_up(f'({part}) * 1000', whole)} AS DOUBLE) / 10"


def _even(value: str, digits: int) -> str:
    """Scale, round ties to even, scale back."""
    scale = float(10**digits)
    return f"round_even(({value}) * {scale}, 0) / {scale}"


def _title(column: str) -> str:
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    runs = f"regexp_extract_all({column}, '[{cased}]+|[^{cased}]+')"
    return f"array_to_string(list_transform({runs}, lambda x: upper(x[1]) || lower(x[2:])), '')"


def _view(name: str) -> str:
    return VIEWS[name].format(**_NAMES)


def _untouched(feed: str) -> str:
    if feed == "customers":
        return " UNION ALL ".join(f"SELECT * FROM ({t.format(**_NAMES)})" for t in CUSTOMER_EXTRACTS.values())
    return FEEDS[feed].format(**_NAMES)


def _feed(feed: str) -> str:
    tokens = ", ".join(_text(t) for t in NULL_TOKENS)
    cells = ", ".join(f"CASE WHEN {c} NOT IN ({tokens}) THEN {c} END AS {c}" for c in STAR[feed].columns)
    return f"SELECT * REPLACE ({cells}) FROM ({_untouched(feed)})"


# ---- building blocks, each a named subquery -----------------------------------------------------

_SELL = "TRY_CAST(trim(replace(sell_price, '£', '')) AS DECIMAL(10,2))"
_COST = "TRY_CAST(cost_price AS DECIMAL(10,2))"
_MIXED = """CAST(coalesce(try_strptime(opening_date, '%Y-%m-%d'), try_strptime(opening_date, '%d/%m/%Y'),
    try_strptime(opening_date, '%m/%d/%Y')) AS DATE)"""
_ISO = "CAST(try_strptime({0}, '%Y-%m-%d') AS DATE)"


def _iso(column: str) -> str:
    return _ISO.format(column)


_BLOCKS = {
    **{name: _view(name) for name in VIEWS if name not in ("customers", "products", "stores")},
    **{f"{name}_view": _view(name) for name in ("customers", "products", "stores")},
    **{f"{name}_feed": _feed(name) for name in STAR},
    "typed_customers": f"""
        SELECT * REPLACE ({_title('full_name')} AS full_name, lower(email) AS email,
            {_iso('signup_date')} AS signup_date, CAST(loyalty_member AS BOOLEAN) AS loyalty_member),
            CASE WHEN signup_date IS NOT NULL AND {_iso('signup_date')} IS NULL
                THEN 'signup_date: unreadable' END AS reason
        FROM customers_feed""",
    "typed_products": f"""
        SELECT * REPLACE ({_title("trim(category)")} AS category, {_SELL} AS sell_price,
            CAST(coalesce({_COST}, {_SELL} * 0.60) AS DECIMAL(10,2)) AS cost_price,
            CAST(in_stock AS BOOLEAN) AS in_stock, {_iso('launch_date')} AS launch_date),
            CASE WHEN length(description) > 200 THEN 'description: too long'
                 WHEN sell_price IS NOT NULL AND {_SELL} IS NULL THEN 'sell_price: unreadable' END AS reason
        FROM products_feed""",
    "typed_stores": f"""
        SELECT * REPLACE ({_case('region', REGION_NAMES, 'region')} AS region,
            CAST(store_size_sqft AS INT) AS store_size_sqft, CAST(num_staff AS INT) AS num_staff,
            {_MIXED} AS opening_date, CAST(is_flagship AS BOOLEAN) AS is_flagship),
            CASE WHEN opening_date IS NOT NULL AND {_MIXED} IS NULL
                THEN 'opening_date: unreadable' END AS reason
        FROM stores_feed""",
    "clean_customers": """
        SELECT * FROM typed_customers WHERE reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY o1, o2) = 1""",
    "clean_products": """
        SELECT * FROM typed_products WHERE reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY o1) = 1""",
    "clean_stores": """
        SELECT * FROM typed_stores WHERE reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY o1) = 1""",
    "typed_transactions": f"""
        SELECT *, CASE WHEN transaction_date IS NOT NULL AND {_iso('transaction_date')} IS NULL
                THEN 'transaction_date: unreadable'
            WHEN quantity IS NOT NULL AND TRY_CAST(quantity AS INT) IS NULL THEN 'quantity: unreadable'
            END AS reason
        FROM transactions_feed""",
    "repaired": f"""
        SELECT t.* REPLACE (
            CASE WHEN t.customer_id IN (SELECT customer_id FROM clean_customers) THEN t.customer_id END
                AS customer_id,
            CASE WHEN t.store_id IN (SELECT store_id FROM clean_stores) THEN t.store_id END AS store_id,
            {_iso('transaction_date')} AS transaction_date, TRY_CAST(quantity AS INT) AS quantity,
            CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
            CAST(discount_pct AS DECIMAL(5,2)) AS discount_pct,
            CAST(total_value AS DECIMAL(10,2)) AS total_value)
        FROM typed_transactions t WHERE product_id IN (SELECT product_id FROM clean_products)""",
    "clean_transactions": """
        SELECT * FROM repaired WHERE reason IS NULL QUALIFY row_number() OVER (
            PARTITION BY transaction_id ORDER BY o1, o2, o3, o4, o5, o6, o7, o8, o9) = 1""",
    "purchases": """
        SELECT t.customer_id, t.transaction_date, t.total_value, c.full_name, c.region, c.age_group,
            c.loyalty_member
        FROM transactions t JOIN customers_view c ON t.customer_id = c.customer_id
        WHERE t.quantity > 0""",
    "today": "SELECT CAST(max(transaction_date) + INTERVAL 1 DAY AS DATE) AS reference_date FROM purchases",
    "base": """
        SELECT customer_id,
            date_diff('day', max(transaction_date), (SELECT reference_date FROM today)) AS recency,
            count(transaction_date) AS frequency, coalesce(sum(total_value), 0) AS monetary
        FROM purchases GROUP BY customer_id""",
    "edges": "SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS e FROM base",
    "ranked": """
        SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY frequency, customer_id) AS f_rank,
            row_number() OVER (ORDER BY monetary, customer_id) AS m_rank
        FROM base""",
    "scored": """
        SELECT customer_id, recency, frequency, monetary,
            CAST(CASE WHEN recency <= floor(e[1] + 1e-6) THEN 5 WHEN recency <= floor(e[2] + 1e-6) THEN 4
                WHEN recency <= floor(e[3] + 1e-6) THEN 3 WHEN recency <= floor(e[4] + 1e-6) THEN 2
                ELSE 1 END AS INT) AS r_score,
            CAST(greatest(1, ceil(5.0 * (f_rank - 1) / (n - 1))) AS INT) AS f_score,
            CAST(greatest(1, ceil(5.0 * (m_rank - 1) / (n - 1))) AS INT) AS m_score
        FROM ranked, edges""",
    # The two segments that no score can reach are left out here on purpose.
    "rfm": f"""
        SELECT *, {_even('(r_score + f_score + m_score) / 3.0::DOUBLE', 2)} AS rfm_score,
            CASE WHEN least(r_score, f_score, m_score) >= 4 THEN 'Champion'
                 WHEN least(r_score, f_score, m_score) = 3 THEN 'Loyal Customer'
                 WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customer'
                 WHEN r_score >= 3 AND f_score >= 2 AND m_score <= 2 THEN 'Potential Loyalist'
                 WHEN r_score <= 2 AND least(f_score, m_score) >= 3 THEN 'At Risk'
                 WHEN greatest(r_score, f_score, m_score) <= 2 THEN 'Lost'
                 ELSE 'Hibernating' END AS segment
        FROM scored""",
    "sold": "SELECT * FROM transactions WHERE quantity > 0",
}


def _needed(text: str) -> list[str]:
    """Blocks a statement uses, directly or through others, in the order they must be defined."""
    order: list[str] = []

    def visit(fragment: str) -> None:
        for name in _BLOCKS:
            if name not in order and re.search(rf"\b(FROM|JOIN|,)\s*{name}\b", fragment):
                visit(_BLOCKS[name])
                order.append(name)

    visit(text)
    return order


def _with_blocks(text: str) -> str:
    blocks = ",\n".join(f"{name} AS ({_BLOCKS[name]})" for name in _needed(text))
    return f"WITH {blocks}\n{text}" if blocks else text


def _columns(feed: str) -> str:
    """Loaded columns of a feed; decimals as doubles."""
    table = STAR[feed]
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in table.decimals else c for c in table.columns)


_REVENUE = "CAST(sum(total_value) AS DOUBLE)"
_AVERAGE = _mean2("sum(total_value)", "count(total_value)")


def _by_month(source: str) -> str:
    return f"""
        SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month,
            count(transaction_id) AS num_transactions, count(DISTINCT customer_id) AS unique_customers,
            {_REVENUE} AS monthly_revenue, {_AVERAGE} AS avg_order_value
        FROM {source} GROUP BY 1"""


def _by_category(source: str) -> str:
    return f"""
        SELECT category, num_transactions, units_sold, CAST(revenue AS DOUBLE) AS total_revenue,
            {_mean2('revenue', 'priced')} AS avg_order_value,
            {_pct1(_cents('revenue'), _cents('sum(revenue) OVER ()'))} AS revenue_pct
        FROM (SELECT category, count(transaction_id) AS num_transactions,
                CAST(sum(quantity) AS BIGINT) AS units_sold, sum(total_value) AS revenue,
                count(total_value) AS priced
              FROM {source} JOIN products_view USING (product_id) GROUP BY category)"""


def _by_region(source: str) -> str:
    return f"""
        SELECT region, count(DISTINCT store_id) AS num_stores, count(transaction_id) AS num_transactions,
            {_REVENUE} AS total_revenue, {_mean2('sum(total_value)', 'count(DISTINCT store_id)')}
                AS revenue_per_store
        FROM {source} JOIN stores_view USING (store_id) GROUP BY region"""


def _channel_share(source: str) -> str:
    return f"""
        SELECT channel, CAST(revenue AS DOUBLE) AS total_revenue,
            {_pct1(_cents('revenue'), _cents('sum(revenue) OVER ()'))} AS revenue_pct
        FROM (SELECT channel, sum(total_value) AS revenue FROM {source} GROUP BY channel)"""


def _top_products(source: str) -> str:
    return f"""
        SELECT product_name, category, count(transaction_id) AS times_purchased,
            CAST(sum(quantity) AS BIGINT) AS total_units, {_REVENUE} AS total_revenue
        FROM {source} JOIN products_view USING (product_id) GROUP BY product_name, category
        ORDER BY sum(total_value) DESC, product_name, category LIMIT 10"""


def _returns(source: str) -> str:
    return f"""
        SELECT category, count(transaction_id) AS num_returns,
            CAST(abs(sum(total_value)) AS DOUBLE) AS value_returned,
            {_pct1('count(transaction_id)', f'(SELECT count(*) FROM {source} WHERE quantity < 0)')}
                AS pct_of_all_returns
        FROM {source} JOIN products_view USING (product_id) WHERE quantity < 0 GROUP BY category"""


def _kpi(source: str) -> str:
    return f"""
        SELECT CAST(year(transaction_date) AS INT) AS year, {_REVENUE} AS total_revenue,
            count(transaction_id) AS transactions, count(DISTINCT customer_id) AS customers,
            {_AVERAGE} AS avg_order_value
        FROM {source} GROUP BY 1"""


_IN_1997 = "(SELECT * FROM transactions WHERE transaction_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31')"
_SOLD_1997 = f"(SELECT * FROM {_IN_1997} WHERE quantity > 0)"

_RFM_ROW = """customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score,
    m_score, rfm_score, segment"""
_CUSTOMER_RFM = f"""
    SELECT {_RFM_ROW}, full_name, region, age_group, loyalty_member
    FROM rfm JOIN customers_view USING (customer_id)"""

_COUNT_FEED = "SELECT '{0}' AS {1}, count(*) AS {2} FROM {3}"


def _stacked(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _missing() -> str:
    return _stacked([
        f"SELECT '{n}' AS table_name, count(*) FILTER ({t.key} IS NULL) AS missing FROM {n}_feed" for n, t in STAR.items()
    ])


def _too_long() -> str:
    return _stacked([
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name, {n} AS declared,
            CAST(max(length({c})) AS INT) AS longest, count(*) FILTER (length({c}) > {n}) AS too_long
            FROM {name}_feed"""
        for name, table in STAR.items() for c, n in table.lengths.items()
    ])


def _too_large() -> str:
    def one(name: str, c: str, kind) -> str:
        number = f"trim(replace({c}, '£', ''))"
        spark_type = kind.simpleString()
        return f"""SELECT '{name}' AS table_name, '{c}' AS column_name, '{spark_type}' AS declared,
            count(*) FILTER (TRY_CAST({number} AS DOUBLE) IS NOT NULL
                AND TRY_CAST({number} AS {spark_type}) IS NULL) AS too_large
            FROM {name}_feed"""

    return _stacked([one(n, c, k) for n, t in STAR.items() for c, k in t.decimals.items()])


def _defects() -> str:
    name = "full_name"
    found = {
        ("customers", "name in one case"): f"""count(*) FILTER (({name} = upper({name})
            OR {name} = lower({name})) AND {name} <> {_title(name)})""",
        ("customers", "repeated id"): "count(*) - count(DISTINCT customer_id)",
        ("products", "price with pound sign"): "count(*) FILTER (contains(sell_price, '£'))",
        ("products", "cost missing"): "count(*) FILTER (cost_price IS NULL)",
        ("stores", "date not ISO"): f"count(*) FILTER (opening_date IS NOT NULL AND {_iso('opening_date')} IS NULL)",
        ("stores", "region variant"):
            f"count(*) FILTER ({_case('region', REGION_NAMES, 'region')} <> region)",
        ("transactions", "guest checkout"): "count(*) FILTER (customer_id IS NULL)",
        ("transactions", "no store"): "count(*) FILTER (store_id IS NULL)",
    }
    return _stacked([
        f"""SELECT '{feed}' AS feed, '{defect}' AS defect, {count} AS row_count,
            {_pct1(count, 'count(*)')} AS pct FROM {feed}_feed"""
        for (feed, defect), count in found.items()
    ])


_KEYS = {"customers": "clean_customers", "products": "clean_products", "stores": "clean_stores",
         "transactions": "clean_transactions"}

def _left_out() -> str:
    """Rows a load leaves out: bad cells, products nobody sells, and all but the first copy of an id."""
    parts = []
    for name, order in _PLACES.items():
        key = STAR[name].key
        unknown = "WHEN product_id NOT IN (SELECT product_id FROM clean_products) OR product_id IS NULL THEN 'product_id: unknown'"
        parts.append(f"""
            SELECT feed, row_key, coalesce(cause, CASE WHEN nth > 1 THEN '{key}: repeated' END) AS reason
            FROM (SELECT *, row_number() OVER (PARTITION BY row_key, cause IS NULL ORDER BY {order}) AS nth
                FROM (SELECT *, '{name}' AS feed, {key} AS row_key, CASE WHEN reason IS NOT NULL THEN reason
                    {unknown if name == 'transactions' else ''} END AS cause FROM typed_{name}))
            WHERE cause IS NOT NULL OR nth > 1""")
    return _stacked(parts)


_PLACES = {"customers": "o1, o2", "products": "o1", "stores": "o1", "transactions": "o1, o2, o3, o4, o5, o6, o7, o8, o9"}
_LEFT_OUT = _left_out()

_ACCOUNTS = f"""
        SELECT feed, reason AS cause, count(*) AS row_count FROM ({_LEFT_OUT}) GROUP BY 1, 2
        UNION ALL {_stacked([f"SELECT '{n}', 'read', count(*) FROM {n}_feed" for n in STAR])}
        UNION ALL {_stacked([f"SELECT '{n}', 'loaded', count(*) FROM clean_{n}" for n in STAR])}"""

_STATEMENTS = {
    # sales reports
    "business_summary": f"""
        SELECT count(DISTINCT transaction_id) AS total_transactions,
            count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products,
            count(DISTINCT store_id) AS stores_trading, {_REVENUE} AS total_revenue,
            {_AVERAGE} AS avg_transaction_value, min(transaction_date) AS earliest_date,
            max(transaction_date) AS latest_date
        FROM sold""",
    "monthly_trend": _by_month("sold"),
    "revenue_by_category": _by_category("sold"),
    "top_products": _top_products("sold"),
    "revenue_by_region": _by_region("sold"),
    "channel_split": f"""
        SELECT channel, count(transaction_id) AS transactions,
            count(DISTINCT customer_id) AS unique_customers, {_REVENUE} AS total_revenue,
            {_AVERAGE} AS avg_order_value
        FROM sold GROUP BY channel""",
    "returns_by_category": _returns("transactions"),
    "distinct_counts_from_sketches": _stacked([
        f"""SELECT year(transaction_date) AS year, '{c}' AS kind, count(DISTINCT {c}) AS ids, true AS within
            FROM sold GROUP BY 1""" for c in ("customer_id", "store_id", "product_id")]),
    "payment_breakdown": f"""
        SELECT payment_method, count(*) AS transactions, {_REVENUE} AS total_revenue, {_AVERAGE} AS avg_value
        FROM sold GROUP BY payment_method""",
    # cleaning
    "title_case_names": f"""
        SELECT customer_id, full_name AS raw_name, {_title('full_name')} AS full_name FROM customers_feed""",
    "lower_case_emails": "SELECT customer_id, email AS raw_email, lower(email) AS email FROM customers_feed",
    "trim_title_categories": f"""
        SELECT product_id, category AS raw_category, {_title('trim(category)')} AS category FROM products_feed""",
    "parse_prices": f"""
        SELECT product_id, sell_price AS raw_price, CAST({_SELL} AS DOUBLE) AS sell_price FROM products_feed""",
    "impute_cost": f"""
        SELECT product_id, CAST({_SELL} AS DOUBLE) AS sell_price,
            CAST(CAST(coalesce({_COST}, {_SELL} * 0.60) AS DECIMAL(10,2)) AS DOUBLE) AS cost_price
        FROM products_feed""",
    "harmonise_regions": f"""
        SELECT store_id, region AS raw_region, {_case('region', REGION_NAMES, 'region')} AS region
        FROM stores_feed""",
    "parse_iso_dates": f"""
        SELECT customer_id, signup_date AS raw_date, {_iso('signup_date')} AS signup_date FROM customers_feed""",
    "parse_mixed_dates": f"""
        SELECT store_id, opening_date AS raw_date, {_MIXED} AS opening_date FROM stores_feed""",
    "dedupe_keep_first": """
        SELECT transaction_id, product_id, store_id, quantity, CAST(total_value AS DOUBLE) AS total_value
        FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY product_id,
                store_id NULLS FIRST, quantity, total_value, discount_pct) AS nth FROM lines)
        WHERE nth = 1""",
    **{f"clean_{n}": f"SELECT {_columns(n)} FROM clean_{n}" for n in STAR},
    "rejected_rows": _stacked([
        f"SELECT '{n}' AS feed, {STAR[n].key} AS row_key, reason FROM typed_{n} WHERE reason IS NOT NULL"
        for n in STAR
    ]),
    # conforming
    "valid_keys": _stacked([
        f"SELECT '{n}' AS dimension, {STAR[n].key} AS valid_key FROM clean_{n}"
        for n in ("customers", "products", "stores")
    ]),
    "valid_product_filter": """
        SELECT transaction_id, product_id, quantity FROM transactions_feed
        WHERE product_id IN (SELECT product_id FROM clean_products)""",
    "null_orphan_customers": """
        SELECT transaction_id, t.customer_id AS raw_customer_id, c.customer_id
        FROM transactions_feed t LEFT JOIN clean_customers c ON t.customer_id = c.customer_id""",
    "null_orphan_stores": """
        SELECT transaction_id, channel, t.store_id AS raw_store_id, s.store_id
        FROM transactions_feed t LEFT JOIN clean_stores s ON t.store_id = s.store_id""",
    "line_totals": f"""
        SELECT transaction_id, CAST({_half_up(
            '''CAST(CAST(unit_price AS DECIMAL(10,2)) * 100 AS HUGEINT) * TRY_CAST(quantity AS INT)
               * (100 - CAST(CAST(discount_pct AS DECIMAL(5,2)) * 100 AS HUGEINT))''', '100')} AS DOUBLE) / 100
            AS line_total
        FROM transactions_feed""",
    "price_lookup_default": f"""
        SELECT t.transaction_id, t.product_id, CAST(coalesce(price, 9.99) AS DOUBLE) AS unit_price
        FROM transactions_feed t LEFT JOIN (SELECT product_id, {_SELL} AS price FROM products_feed) p
            ON t.product_id = p.product_id""",
    "price_lookup_hot_key": f"""
        SELECT transaction_id, t.product_id, CAST(price AS DOUBLE) AS unit_price
        FROM (SELECT transaction_id, CASE WHEN payment_method IN ('1-URGENT', '2-HIGH') THEN 'P1' ELSE product_id END
            AS product_id FROM transactions_feed) t
        LEFT JOIN (SELECT product_id, {_SELL} AS price FROM products_feed) p ON t.product_id = p.product_id""",
    "channel_from_store": """
        SELECT transaction_id, store_id, CASE WHEN store_id IS NULL THEN 'Online' ELSE 'In-Store' END AS channel
        FROM repaired""",
    "union_duplicate_customers": """
        SELECT customer_id, full_name, email, phone, postcode FROM customers_feed""",
    # recency, frequency, monetary
    "rfm_purchases": """
        SELECT customer_id, transaction_date, CAST(total_value AS DOUBLE) AS total_value, full_name, region,
            age_group, loyalty_member FROM purchases""",
    "bucketed_rfm_purchases": """
        SELECT customer_id, transaction_date, CAST(total_value AS DOUBLE) AS total_value, full_name, region,
            age_group, loyalty_member FROM purchases""",
    "rfm_coverage": """
        SELECT count(*) AS transactions, count(DISTINCT customer_id) AS customers FROM purchases""",
    "customer_details": """
        SELECT DISTINCT customer_id, full_name, region, age_group, loyalty_member FROM purchases""",
    "rfm_reference_date": "SELECT reference_date FROM today",
    "rfm_base": "SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary FROM base",
    "bucketed_rfm_base": "SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary FROM base",
    "rfm_summary": f"""
        SELECT count(*) AS customers, {_even('avg(recency)', 0)} AS avg_recency,
            {_even('avg(frequency)', 1)} AS avg_frequency,
            {_even('CAST(sum(monetary) AS DOUBLE) / count(*)', 2)} AS avg_monetary
        FROM base""",
    "recency_quintiles": "SELECT customer_id, recency, r_score FROM scored",
    "frequency_ranks": "SELECT customer_id, frequency, f_rank AS first_rank FROM ranked",
    "rank_quintiles": "SELECT customer_id, f_score, m_score FROM scored",
    "rank_quintiles_by_selection": "SELECT customer_id, f_score, m_score FROM scored",
    "rfm_scores": """
        SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score,
            rfm_score FROM rfm""",
    "rfm_segments": "SELECT customer_id, r_score, f_score, m_score, segment FROM rfm",
    "customer_rfm": _CUSTOMER_RFM,
    "segment_summary": f"""
        SELECT segment, count(*) AS customers, {_even('avg(recency)', 2)} AS avg_recency,
            {_even('avg(frequency)', 2)} AS avg_frequency,
            {_even('CAST(sum(monetary) AS DOUBLE) / count(*)', 2)} AS avg_monetary,
            CAST(sum(monetary) AS DOUBLE) AS total_revenue
        FROM rfm GROUP BY segment""",
    "segment_actions": f"""
        SELECT segment, count(*) AS customers, {_case('segment', SEGMENT_ACTIONS, 'NULL')} AS action
        FROM rfm GROUP BY segment""",
    "score_histogram": """
        SELECT * FROM (WITH span AS (SELECT min(rfm_score) AS lo, max(rfm_score) AS hi FROM rfm),
        bins AS (SELECT CAST(b AS INT) AS bin, lo + (b - 1) * ((hi - lo) / 20) AS lower_edge,
            CASE WHEN b = 20 THEN hi ELSE lo + b * ((hi - lo) / 20) END AS upper_edge
            FROM span, range(1, 21) AS steps(b))
        SELECT bin, lower_edge, upper_edge, count(rfm_score) AS customers
        FROM bins LEFT JOIN rfm ON rfm_score >= lower_edge
            AND (rfm_score < upper_edge OR (bin = 20 AND rfm_score = upper_edge))
        GROUP BY bin, lower_edge, upper_edge)""",
    # quality
    "pk_violations": _stacked([
        f"""SELECT '{n}' AS table_name, CAST({t.key} AS VARCHAR) AS row_key, count(*) AS copies
            FROM {n}_feed WHERE {t.key} IS NOT NULL GROUP BY {t.key} HAVING count(*) > 1"""
        for n, t in STAR.items()
    ]),
    "missing_keys": _missing(),
    "fk_orphans": _stacked([
        f"""SELECT '{k}' AS foreign_key, {k} AS orphan, count(*) AS row_count FROM transactions_feed
            WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM clean_{d}) GROUP BY {k}"""
        for k, d in (("customer_id", "customers"), ("product_id", "products"), ("store_id", "stores"))
    ]),
    "length_overflow": _too_long(),
    "numeric_overflow": _too_large(),
    "defect_profile": _defects(),
    "near_duplicate_customers": f"""
        SELECT * FROM (
            SELECT full_name, phone, postcode, customer_id, count(*) OVER (PARTITION BY full_name, phone, postcode) AS ids
            FROM (SELECT DISTINCT {_title('full_name')} AS full_name, phone, postcode, customer_id FROM customers_feed
                WHERE customer_id IS NOT NULL AND coalesce(phone, postcode) IS NOT NULL))
        WHERE ids > 1""",
    "store_opened_after_sales": """
        SELECT store_id, opening_date, min(transaction_date) AS first_sale, count(*) AS early_sales
        FROM sold JOIN stores_view USING (store_id) WHERE transaction_date < opening_date
        GROUP BY store_id, opening_date""",
    "load_counts": _stacked([_COUNT_FEED.format(n, "table_name", "row_count", c) for n, c in _KEYS.items()]),
    "load_audit": _stacked([
        f"""SELECT '{n}' AS feed, raw_rows, loaded_rows, raw_rows - loaded_rows AS dropped
            FROM (SELECT (SELECT count(*) FROM {n}_feed) AS raw_rows, (SELECT count(*) FROM {c}) AS loaded_rows)"""
        for n, c in _KEYS.items()
    ]),
    # dashboards
    "kpi_by_year": _kpi("sold"),
    "kpi_in_year": _kpi(_SOLD_1997),
    "monthly_trend_in_year": _by_month(_SOLD_1997),
    "revenue_by_region_in_year": _by_region(_SOLD_1997),
    "channel_share": _channel_share("sold"),
    "channel_share_in_year": _channel_share(_SOLD_1997),
    "revenue_by_category_in_year": _by_category(_SOLD_1997),
    "top_products_in_year": _top_products(_SOLD_1997),
    "returns_by_category_in_year": _returns(_IN_1997),
    "customers_per_segment": "SELECT segment, count(*) AS customers FROM rfm GROUP BY segment",
    "revenue_per_segment": """
        SELECT segment, CAST(sum(monetary) AS DOUBLE) AS total_revenue FROM rfm GROUP BY segment""",
    "avg_spend_by_segment": f"""
        SELECT segment, {_even('CAST(sum(monetary) AS DOUBLE) / count(*)', 2)} AS avg_monetary
        FROM rfm GROUP BY segment""",
    "avg_score_by_segment": f"""
        SELECT segment, {_even('CAST(sum(CAST(rfm_score AS DECIMAL(5,2))) AS DOUBLE) / count(*)', 2)}
            AS avg_rfm_score
        FROM rfm GROUP BY segment""",
    "segment_detail": f"{_CUSTOMER_RFM} WHERE segment IN ('At Risk', 'Hibernating')",
    "stock_status": f"""
        SELECT in_stock, products, {_pct1('products', 'CAST(sum(products) OVER () AS BIGINT)')} AS pct
        FROM (SELECT in_stock, count(*) AS products FROM products_view GROUP BY in_stock)""",
    "headline_facts": f"""
        (SELECT 'peak_month' AS fact, CAST(month AS VARCHAR) AS label, monthly_revenue AS amount
            FROM ({_by_month('sold')}) ORDER BY 3 DESC, 2 LIMIT 1)
        UNION ALL (SELECT 'top_category', category, total_revenue FROM ({_by_category('sold')})
            ORDER BY 3 DESC, 2 LIMIT 1)
        UNION ALL (SELECT 'top_region', region, total_revenue FROM ({_by_region('sold')})
            ORDER BY 3 DESC, 2 LIMIT 1)
        UNION ALL SELECT 'hibernating_customers', 'Hibernating',
            CAST(count(*) FILTER (segment = 'Hibernating') AS DOUBLE) FROM rfm
        UNION ALL SELECT 'at_risk_customers', 'At Risk',
            CAST(count(*) FILTER (segment = 'At Risk') AS DOUBLE) FROM rfm""",
    # files and tables
    **{f"csv_{n}": f"SELECT {', '.join(STAR[n].columns)} FROM {n}_feed" for n in STAR},
    **{f"loaded_{n}": f"SELECT {_columns(n)} FROM clean_{n}" for n in STAR},
    "loaded_twice": _stacked([_COUNT_FEED.format(n, "table_name", "row_count", c) for n, c in _KEYS.items()]),
    "appended_transactions": f"SELECT {_columns('transactions')} FROM clean_transactions",
    "replaced_months": f"SELECT {_columns('transactions')} FROM clean_transactions",
    "incremental_load": f"SELECT {_columns('transactions')} FROM clean_transactions",
    "incremental_months": f"SELECT {_columns('transactions')} FROM clean_transactions",
    "load_rejects": _LEFT_OUT,
    "incremental_rejects": _LEFT_OUT,
    "load_accounting": _ACCOUNTS,
    "incremental_accounting": _ACCOUNTS,
    "catalog_counts": _stacked([_COUNT_FEED.format(n, "table_name", "row_count", c) for n, c in _KEYS.items()]),
    **{f"csv_{n}_of_unlike_headers": f"SELECT {', '.join(STAR[n].columns)} FROM {n}_feed" for n in STAR},
    "landed_of_unlike_headers": f"SELECT {', '.join(STAR['transactions'].columns)} FROM transactions_feed",
    "observed_audits": f"""
        SELECT 'missing_keys' AS audit, table_name AS feed, 'key' AS subject, missing AS found FROM ({_missing()})
        UNION ALL SELECT 'longest', table_name, column_name, longest FROM ({_too_long()})
        UNION ALL SELECT 'too_long', table_name, column_name, too_long FROM ({_too_long()})
        UNION ALL SELECT 'too_large', table_name, column_name, too_large FROM ({_too_large()})
        UNION ALL SELECT 'defects', feed, defect, row_count FROM ({_defects()})""",
    **{f"csv_{n}_by_header": f"SELECT {', '.join(STAR[n].columns)} FROM {n}_feed" for n in STAR},
    "replaced_customer_rfm": _CUSTOMER_RFM,
}


# the same reports, from partial sums
_STATEMENTS |= {f"rolled_{n}": _STATEMENTS[n] for n in (
    "monthly_trend", "revenue_by_category", "top_products", "revenue_by_region", "revenue_by_region_in_year",
    "channel_share_in_year", "returns_by_category", "payment_breakdown")}


def statements() -> dict[str, str]:
    return {name: _with_blocks(text) for name, text in _STATEMENTS.items()}
