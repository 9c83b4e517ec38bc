"""Registry of every query over the given tables, with the statement that checks it."""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import oracle
from tillwise.functions import dates, lookups, numbers, text
from tillwise.operators import cleanse, conform, joins, quality, ranking
from tillwise.operators.dedupe import keep_first
from tillwise.operators.joins import keep_known, null_unknown
from tillwise.plans import dashboards, load, rfm, rollups, sales, sketches
from tillwise.schemas import STAR
from tillwise.sources import buckets, warehouse
from tillwise.sources.feeds import ORDINAL, write_feed
from tillwise.sources.retail_views import CUSTOMER_EXTRACTS, ordered_feed, raw_feed, untouched_feed, view
from tillwise.sources.scratch import scratch_path
from tillwise.streaming import incremental

_SPEC = importlib.util.find_spec("tillwise.llm")
if _SPEC is not None and _SPEC.origin:  # the subpackage may be left out
    from tillwise.llm import registry as llm
else:
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

_YEAR = 1997
_WIN_BACK = ["At Risk", "Hibernating"]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the one number type both engines print alike."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema
    ])


def _over_views(function: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf: _plain(function(*[view(spark, sf, n) for n in names]))


def _over_feed(feed: str, function: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: _plain(function(raw_feed(spark, sf, feed)))


def _over_feeds(function: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf: _plain(function({n: raw_feed(spark, sf, n) for n in STAR}))


def _over_totals(function: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        totals = rfm.customer_totals(view(spark, sf, "transactions"), view(spark, sf, "customers"))
        return _plain(function(totals))

    return run


def _over_scores(function: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        scored = rfm.scored_customers(view(spark, sf, "transactions"), view(spark, sf, "customers"))
        return _plain(function(scored))

    return run


def _over_year(function: Callable[..., DataFrame], *names: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = sales.in_year(view(spark, sf, "transactions"), _YEAR)
        return _plain(function(rows, *[view(spark, sf, n) for n in names]))

    return run


# ---- cleaning ------------------------------------------------------------------------------------


def _dimensions(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """Cleaned dimensions as tables, loaded before the facts that refer to them."""
    names = names or tuple(load.DIMENSIONS)
    root = scratch_path(spark, "star")
    for n in names:
        warehouse.write_table(cleanse.clean_dimension(raw_feed(spark, sf, n), n), root, n)
    return {n: warehouse.read_table(spark, root, n) for n in names}


def _clean_dimension(feed: str) -> Query:
    return lambda spark, sf: _plain(cleanse.clean_dimension(raw_feed(spark, sf, feed), feed))


def _clean_transactions(spark: SparkSession, sf: str) -> DataFrame:
    facts = raw_feed(spark, sf, "transactions")
    return _plain(conform.clean_transactions(facts, **_dimensions(spark, sf)))


def _dedupe(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["transaction_id", "product_id", "store_id", "quantity", "total_value"]
    rows = view(spark, sf, "lines").select(*columns, "discount_pct")
    first = keep_first(rows, "transaction_id", [*columns[1:], "discount_pct"])
    return _plain(first.select(columns))


def _impute_cost(raw: DataFrame) -> DataFrame:
    sell = numbers.parse_price(F.col("sell_price"))
    cost = F.col("cost_price").try_cast(numbers.MONEY)
    return raw.select(
        "product_id", sell.alias("sell_price"), numbers.impute_cost(cost, sell).alias("cost_price")
    )


# ---- conforming ----------------------------------------------------------------------------------


def _valid_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = [
        df.select(F.lit(n).alias("dimension"), F.col(STAR[n].key).alias("valid_key")).distinct()
        for n, df in _dimensions(spark, sf).items()
    ]
    return keys[0].unionByName(keys[1]).unionByName(keys[2])


def _valid_products(spark: SparkSession, sf: str) -> DataFrame:
    facts = raw_feed(spark, sf, "transactions").select("transaction_id", "product_id", "quantity")
    return keep_known(facts, _dimensions(spark, sf, "products")["products"], "product_id")


def _null_orphans(key: str, owner: str, *also: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        facts = raw_feed(spark, sf, "transactions").select(
            "transaction_id", *also, key, F.col(key).alias(f"raw_{key}")
        )
        return null_unknown(facts, _dimensions(spark, sf, owner)[owner], key, F.col("transaction_id"))

    return run


def _line_totals(raw: DataFrame) -> DataFrame:
    typed = cleanse.type_transactions(raw)
    total = numbers.line_total(F.col("unit_price"), F.col("quantity"), F.col("discount_pct"))
    return typed.select("transaction_id", total.alias("line_total"))


def _price_lookup(spark: SparkSession, sf: str) -> DataFrame:
    facts = raw_feed(spark, sf, "transactions").select("transaction_id", "product_id")
    return _plain(conform.look_up_price(facts, raw_feed(spark, sf, "products")))


_RUSH = ["1-URGENT", "2-HIGH"]  # two rows of five


def _price_lookup_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """Prices by shuffle, as for products too many to broadcast, where one product has two fifths of the rows."""
    product = F.when(F.col("payment_method").isin(_RUSH), F.lit("P1")).otherwise(F.col("product_id"))
    facts = raw_feed(spark, sf, "transactions").select("transaction_id", product.alias("product_id"))
    last = keep_first(raw_feed(spark, sf, "products"), "product_id", [F.col(ORDINAL).desc()])
    prices = last.select("product_id", numbers.parse_price(F.col("sell_price")).alias("unit_price"))
    hot = joins.hot_keys(facts, "product_id")
    return _plain(joins.look_up_large(facts, prices, "product_id", F.col("transaction_id"), hot))


def _channel_from_store(spark: SparkSession, sf: str) -> DataFrame:
    typed = cleanse.type_transactions(raw_feed(spark, sf, "transactions"))
    repaired = conform.conform_references(typed, **_dimensions(spark, sf))
    return conform.derive_channel(repaired).select("transaction_id", "store_id", "channel")


def _stacked_customers(spark: SparkSession, sf: str) -> DataFrame:
    parts = [raw_feed(spark, sf, "customers", extract) for extract in CUSTOMER_EXTRACTS]
    stacked = conform.append_extracts(*parts)
    return stacked.select("customer_id", "full_name", "email", "phone", "postcode")


# ---- recency, frequency, monetary ----------------------------------------------------------------


def _recency_quintiles(totals: DataFrame) -> DataFrame:
    return rfm.score(totals, rfm.fit(totals)).select("customer_id", "recency", "r_score")


def _rank_quintiles(totals: DataFrame) -> DataFrame:
    return rfm.score(totals, rfm.fit(totals)).select("customer_id", "f_score", "m_score")


def _over_buckets(function: Callable[..., DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        facts, columns = view(spark, sf, "transactions"), ["transaction_date", "quantity", "total_value"]
        target = scratch_path(spark, "by-customer")
        return _plain(function(buckets.lay_out(facts, view(spark, sf, "customers"), target, 8, columns)))

    return run


def _selected_quintiles(totals: DataFrame) -> DataFrame:
    """The quintiles with cuts bracketed by a sample much smaller than the table."""
    cuts = rfm.fit(totals, sample=max(1, totals.count() // 4))
    return rfm.score(totals, cuts).select("customer_id", "f_score", "m_score")


def _frequency_ranks(totals: DataFrame) -> DataFrame:
    ranks = ranking.first_rank(totals, "customer_id", "frequency")
    return ranks.withColumnRenamed("rank", "first_rank")


def _scores(totals: DataFrame) -> DataFrame:
    return rfm.score(totals, rfm.fit(totals)).select(
        "customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score"
    )


def _headline_facts(spark: SparkSession, sf: str) -> DataFrame:
    transactions = view(spark, sf, "transactions")
    scored = rfm.scored_customers(transactions, view(spark, sf, "customers"))
    return _plain(dashboards.headline_facts(
        transactions, view(spark, sf, "products"), view(spark, sf, "stores"), scored, view(spark, sf, "lines")
    ))


def _replaced_customer_rfm(spark: SparkSession, sf: str) -> DataFrame:
    table = rfm.customer_rfm(view(spark, sf, "transactions"), view(spark, sf, "customers"))
    target = scratch_path(spark, "customer_rfm")
    warehouse.replace_table(table, target)
    warehouse.replace_table(table, target)
    return warehouse.read_derived(spark, target)


def _sketched_counts(spark: SparkSession, sf: str) -> DataFrame:
    transactions = view(spark, sf, "transactions")
    kept = sketches.keep(spark, sketches.month_sketches(transactions), scratch_path(spark, "sketches"))
    return sketches.beside_exact(transactions, kept)


def _rolled(function: Callable[..., DataFrame], *names: str, year: int | None = None) -> Query:
    """A report from a roll-up that was refreshed once for the early months and again for the later ones."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = view(spark, sf, "transactions")
        # columns of the stored table that no report reads
        rest = [c for c in STAR["transactions"].columns if c not in rows.columns]
        rows = rows.withColumns({c: F.lit(None) for c in rest})
        root, target = scratch_path(spark, "star"), scratch_path(spark, "rollup")
        early = F.coalesce(F.year("transaction_date") < _YEAR, F.lit(True))
        warehouse.write_table(rows.where(early), root, "transactions")
        rollups.refresh(spark, root, target)
        warehouse.replace_months(rows.where(~early), root)
        rollups.refresh(spark, root, target)
        kept = rollups.read(spark, target)
        kept = kept if year is None else rollups.in_year(kept, year)
        return _plain(function(kept, *[view(spark, sf, n) for n in names]))

    return run


# ---- quality -------------------------------------------------------------------------------------


def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    return quality.orphans(raw_feed(spark, sf, "transactions"), _dimensions(spark, sf))


# ---- files and tables ----------------------------------------------------------------------------


def _stage(spark: SparkSession, sf: str, feeds: list[str], max_rows_per_file: int = 0) -> str:
    """Write feeds as CSV the way a source system would: in order, with all their defects."""
    raw_dir = scratch_path(spark, "raw")
    for feed in feeds:
        write_feed(ordered_feed(spark, sf, feed), f"{raw_dir}/{feed}", max_rows_per_file)
    return raw_dir


def _csv(feed: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw_dir = _stage(spark, sf, [feed])
        return load.read_feed(spark, feed, f"{raw_dir}/{feed}").select(STAR[feed].columns)

    return run


def _loaded_dimension(feed: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw_dir = _stage(spark, sf, [feed])
        root = scratch_path(spark, "star")
        raw = load.read_feed(spark, feed, f"{raw_dir}/{feed}")
        warehouse.write_table(cleanse.clean_dimension(raw, feed), root, feed)
        return _plain(warehouse.read_table(spark, root, feed))

    return run


def _load(spark: SparkSession, sf: str) -> tuple[str, str, dict[str, DataFrame]]:
    raw_dir = _stage(spark, sf, list(STAR))
    root = scratch_path(spark, "star")
    return raw_dir, root, load.load_star(spark, raw_dir, root)


def _declared(transactions: DataFrame) -> DataFrame:
    return _plain(transactions.select(STAR["transactions"].columns))


def _loaded_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _declared(_load(spark, sf)[2]["transactions"])


def _load_counts(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.row_counts(_load(spark, sf)[2])


def _loaded_twice(spark: SparkSession, sf: str) -> DataFrame:
    raw_dir, root, _ = _load(spark, sf)
    return warehouse.row_counts(load.load_star(spark, raw_dir, root))


def _load_audit(spark: SparkSession, sf: str) -> DataFrame:
    raw_dir, _, loaded = _load(spark, sf)
    return load.load_audit(load.read_feeds(spark, raw_dir), loaded)


def _observed_audits(spark: SparkSession, sf: str) -> DataFrame:
    """The audits of all feeds as the load measured them on the way, a row for each number."""
    raw_dir, root = _stage(spark, sf, list(STAR)), scratch_path(spark, "star")
    load.load_star(spark, raw_dir, root, audit=True)
    found = load.audits(spark, root)
    parts = [
        ("missing_keys", "missing", found["missing_keys"].selectExpr("table_name AS feed", "'key' AS subject", "missing")),
        ("longest", "longest", found["too_long"].selectExpr("table_name AS feed", "column_name AS subject", "longest")),
        ("too_long", "too_long", found["too_long"].selectExpr("table_name AS feed", "column_name AS subject", "too_long")),
        ("too_large", "too_large", found["too_large"].selectExpr("table_name AS feed", "column_name AS subject", "too_large")),
        ("defects", "row_count", found["defects"].selectExpr("feed", "defect AS subject", "row_count")),
    ]
    rows = [df.select(F.lit(n).alias("audit"), "feed", "subject", F.col(c).cast("long").alias("found")) for n, c, df in parts]
    return reduce(DataFrame.unionByName, rows)


def _appended_transactions(spark: SparkSession, sf: str) -> DataFrame:
    _, root, loaded = _load(spark, sf)
    target = scratch_path(spark, "appended")
    for _ in range(2):
        warehouse.write_table(loaded["transactions"], target, "transactions", mode="append")
    return _declared(warehouse.read_table(spark, target, "transactions"))


def _replaced_months(spark: SparkSession, sf: str) -> DataFrame:
    _, root, loaded = _load(spark, sf)
    target = scratch_path(spark, "months")
    warehouse.write_table(loaded["transactions"], target, "transactions")
    warehouse.replace_months(sales.in_year(loaded["transactions"], _YEAR), target)
    return _declared(warehouse.read_table(spark, target, "transactions"))


def _incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    raw_dir = _stage(spark, sf, list(STAR), max_rows_per_file=20_000)
    root = scratch_path(spark, "star")
    load.load_dimensions({n: load.read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    incremental.land_feed(
        spark, "transactions", f"{raw_dir}/transactions", landing, checkpoint, files_per_batch=2
    )
    load.load_transactions(incremental.landed(spark, "transactions", landing), root)
    return _declared(warehouse.read_table(spark, root, "transactions"))


def _loaded_by_batches(spark: SparkSession, sf: str) -> str:
    """Root of a star schema whose facts came as batches of files, into their months."""
    raw_dir = _stage(spark, sf, list(STAR), max_rows_per_file=20_000)
    root = scratch_path(spark, "star")
    load.load_dimensions({n: load.read_feed(spark, n, f"{raw_dir}/{n}") for n in load.DIMENSIONS}, root)
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    incremental.load_new_files(spark, f"{raw_dir}/transactions", root, landing, checkpoint, files_per_batch=2)
    return root


def _incremental_months(spark: SparkSession, sf: str) -> DataFrame:
    return _declared(warehouse.read_table(spark, _loaded_by_batches(spark, sf), "transactions"))


def _incremental_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return load.accounting(spark, _loaded_by_batches(spark, sf))


def _incremental_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return load.rejects(spark, _loaded_by_batches(spark, sf))


def _load_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return load.accounting(spark, _load(spark, sf)[1])


def _load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return load.rejects(spark, _load(spark, sf)[1])


def _catalog_counts(spark: SparkSession, sf: str) -> DataFrame:
    _, root, _ = _load(spark, sf)
    database = f"star_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    warehouse.create_tables(spark, root, database)
    return warehouse.row_counts({n: spark.table(f"{database}.{n}") for n in STAR})


def _shuffled_csv(feed: str) -> Query:
    """The feed with its columns in another order: the header says which is which."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_path(spark, "shuffled")
        rows = ordered_feed(spark, sf, feed)
        write_feed(rows.select(*sorted(STAR[feed].columns, reverse=True)), path)
        return load.read_feed(spark, feed, path).select(STAR[feed].columns)

    return run


def _unlike_files(spark: SparkSession, sf: str, feed: str) -> str:
    """The feed as files of two kinds: half of the rows with the columns in another order."""
    path = scratch_path(spark, "unlike")
    rows, columns = untouched_feed(spark, sf, feed), STAR[feed].columns
    half = F.pmod(F.xxhash64(*columns), F.lit(2))
    write_feed(rows.where(half == 0), f"{path}/a")
    write_feed(rows.where(half == 1).select(*sorted(columns)), f"{path}/b")
    return f"{path}/*"


def _unlike_csv(feed: str) -> Query:
    return lambda spark, sf: load.read_feed(spark, feed, _unlike_files(spark, sf, feed)).select(STAR[feed].columns)


def _landed_unlike(spark: SparkSession, sf: str) -> DataFrame:
    raw, landing = _unlike_files(spark, sf, "transactions"), scratch_path(spark, "landing")
    incremental.land_feed(spark, "transactions", raw, landing, scratch_path(spark, "stream"), files_per_batch=8)
    return incremental.landed(spark, "transactions", landing).select(STAR["transactions"].columns)


# ---- the contract --------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return queries()["revenue_by_category"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return core_queries() | (llm.QUERIES if llm else {})


def core_queries() -> dict[str, Query]:
    return {
        # sales reports
        "business_summary": _over_views(sales.business_summary, "transactions"),
        "monthly_trend": _over_views(sales.monthly_trend, "transactions"),
        "revenue_by_category": _over_views(sales.revenue_by_category, "lines", "products"),
        "top_products": _over_views(sales.top_products, "lines", "products"),
        "revenue_by_region": _over_views(sales.revenue_by_region, "lines", "stores"),
        "channel_split": _over_views(sales.channel_split, "transactions"),
        "returns_by_category": _over_views(sales.returns_by_category, "lines", "products"),
        "distinct_counts_from_sketches": _sketched_counts,
        "rolled_monthly_trend": _rolled(rollups.monthly_trend),
        "rolled_revenue_by_category": _rolled(rollups.revenue_by_category, "products"),
        "rolled_top_products": _rolled(rollups.top_products, "products"),
        "rolled_revenue_by_region": _rolled(rollups.revenue_by_region, "stores"),
        "rolled_revenue_by_region_in_year": _rolled(rollups.revenue_by_region, "stores", year=_YEAR),
        "rolled_channel_share_in_year": _rolled(rollups.channel_share, year=_YEAR),
        "rolled_returns_by_category": _rolled(rollups.returns_by_category, "products"),
        "rolled_payment_breakdown": _rolled(rollups.payment_breakdown),
        "payment_breakdown": _over_views(sales.payment_breakdown, "transactions"),
        # cleaning
        "title_case_names": _over_feed("customers", lambda df: df.select(
            "customer_id", F.col("full_name").alias("raw_name"),
            text.title_case(F.col("full_name")).alias("full_name"))),
        "lower_case_emails": _over_feed("customers", lambda df: df.select(
            "customer_id", F.col("email").alias("raw_email"), F.lower("email").alias("email"))),
        "trim_title_categories": _over_feed("products", lambda df: df.select(
            "product_id", F.col("category").alias("raw_category"),
            text.title_case(text.strip(F.col("category"))).alias("category"))),
        "parse_prices": _over_feed("products", lambda df: df.select(
            "product_id", F.col("sell_price").alias("raw_price"),
            numbers.parse_price(F.col("sell_price")).alias("sell_price"))),
        "impute_cost": _over_feed("products", _impute_cost),
        "harmonise_regions": _over_feed("stores", lambda df: df.select(
            "store_id", F.col("region").alias("raw_region"),
            lookups.harmonise_region(F.col("region")).alias("region"))),
        "parse_iso_dates": _over_feed("customers", lambda df: df.select(
            "customer_id", F.col("signup_date").alias("raw_date"),
            dates.parse_iso_date(F.col("signup_date")).alias("signup_date"))),
        "parse_mixed_dates": _over_feed("stores", lambda df: df.select(
            "store_id", F.col("opening_date").alias("raw_date"),
            dates.parse_mixed_date(F.col("opening_date")).alias("opening_date"))),
        "dedupe_keep_first": _dedupe,
        **{f"clean_{n}": _clean_dimension(n) for n in load.DIMENSIONS},
        "clean_transactions": _clean_transactions,
        "rejected_rows": _over_feeds(load.all_rejected),
        # conforming
        "valid_keys": _valid_keys,
        "valid_product_filter": _valid_products,
        "null_orphan_customers": _null_orphans("customer_id", "customers"),
        "null_orphan_stores": _null_orphans("store_id", "stores", "channel"),
        "line_totals": _over_feed("transactions", _line_totals),
        "price_lookup_default": _price_lookup,
        "price_lookup_hot_key": _price_lookup_hot_key,
        "channel_from_store": _channel_from_store,
        "union_duplicate_customers": _stacked_customers,
        # recency, frequency, monetary
        "rfm_purchases": _over_views(rfm.purchases, "transactions", "customers"),
        "bucketed_rfm_purchases": _over_buckets(rfm.purchases_by_customer),
        "bucketed_rfm_base": _over_buckets(lambda layout: rfm.base(rfm.totals_by_customer(layout))),
        "rfm_coverage": _over_views(rfm.coverage, "transactions", "customers"),
        "customer_details": _over_views(rfm.customer_details, "transactions", "customers"),
        "rfm_reference_date": _over_totals(rfm.reference_date),
        "rfm_base": _over_totals(rfm.base),
        "rfm_summary": _over_totals(rfm.summary),
        "recency_quintiles": _over_totals(_recency_quintiles),
        "frequency_ranks": _over_totals(_frequency_ranks),
        "rank_quintiles": _over_totals(_rank_quintiles),
        "rank_quintiles_by_selection": _over_totals(_selected_quintiles),
        "rfm_scores": _over_totals(_scores),
        "rfm_segments": _over_scores(lambda df: df.select(
            "customer_id", "r_score", "f_score", "m_score", "segment")),
        "customer_rfm": _over_views(rfm.customer_rfm, "transactions", "customers"),
        "segment_summary": _over_scores(rfm.segment_summary),
        "segment_actions": _over_scores(rfm.segment_actions),
        "score_histogram": _over_scores(rfm.score_histogram),
        # quality
        "pk_violations": _over_feeds(quality.duplicate_keys),
        "missing_keys": _over_feeds(quality.missing_keys),
        "fk_orphans": _orphans,
        "length_overflow": _over_feeds(quality.too_long),
        "numeric_overflow": _over_feeds(quality.too_large),
        "defect_profile": _over_feeds(quality.defects),
        "near_duplicate_customers": _over_feed("customers", quality.near_duplicates),
        "store_opened_after_sales": _over_views(quality.sold_before_opening, "transactions", "stores"),
        "load_counts": _load_counts,
        "load_audit": _load_audit,
        # dashboards
        "kpi_by_year": _over_views(dashboards.kpi_by_year, "transactions"),
        "kpi_in_year": _over_year(dashboards.kpi_by_year),
        "monthly_trend_in_year": _over_year(sales.monthly_trend),
        "revenue_by_region_in_year": _over_year(sales.revenue_by_region, "stores"),
        "channel_share": _over_views(dashboards.channel_share, "lines"),
        "channel_share_in_year": _over_year(dashboards.channel_share),
        "revenue_by_category_in_year": _over_year(sales.revenue_by_category, "products"),
        "top_products_in_year": _over_year(sales.top_products, "products"),
        "returns_by_category_in_year": _over_year(sales.returns_by_category, "products"),
        "customers_per_segment": _over_scores(dashboards.customers_per_segment),
        "revenue_per_segment": _over_scores(dashboards.revenue_per_segment),
        "avg_spend_by_segment": _over_scores(dashboards.avg_spend_by_segment),
        "avg_score_by_segment": _over_scores(dashboards.avg_score_by_segment),
        "segment_detail": lambda spark, sf: dashboards.segment_detail(
            rfm.customer_rfm(view(spark, sf, "transactions"), view(spark, sf, "customers")), _WIN_BACK),
        "stock_status": _over_views(dashboards.stock_status, "products"),
        "headline_facts": _headline_facts,
        # files and tables
        **{f"csv_{n}": _csv(n) for n in STAR},
        **{f"loaded_{n}": _loaded_dimension(n) for n in load.DIMENSIONS},
        "loaded_transactions": _loaded_transactions,
        "loaded_twice": _loaded_twice,
        "appended_transactions": _appended_transactions,
        "replaced_months": _replaced_months,
        "incremental_load": _incremental_load,
        "incremental_months": _incremental_months,
        "incremental_accounting": _incremental_accounting,
        "incremental_rejects": _incremental_rejects,
        "load_accounting": _load_accounting,
        "load_rejects": _load_rejects,
        "catalog_counts": _catalog_counts,
        **{f"csv_{n}_by_header": _shuffled_csv(n) for n in STAR},
        **{f"csv_{n}_of_unlike_headers": _unlike_csv(n) for n in STAR},
        "landed_of_unlike_headers": _landed_unlike,
        "observed_audits": _observed_audits,
        "replaced_customer_rfm": _replaced_customer_rfm,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | (llm.SQL if llm else {})
