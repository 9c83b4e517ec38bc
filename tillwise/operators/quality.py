"""Audits of keys, references, declared limits and feed defects. They report; nothing is dropped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import parse_iso_date
from tillwise.functions.lookups import harmonise_region
from tillwise.functions.text import title_case
from tillwise.schemas import FOREIGN_KEYS, STAR

def _rows() -> Column:
    return F.count(F.lit(1))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_key, copies) for every key that several rows share."""
    return _stack([
        df.where(F.col(STAR[name].key).isNotNull())
        .groupBy(F.col(STAR[name].key).cast("string").alias("row_key"))
        .agg(_rows().alias("copies"))
        .where("copies > 1")
        .select(F.lit(name).alias("table_name"), "row_key", "copies")
        for name, df in tables.items()
    ])


def missing_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, missing) number of rows without a key."""
    return _stack([_report(name, "missing_keys", _measured(name, df, "missing_keys")) for name, df in tables.items()])


def orphans(facts: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """(foreign_key, orphan, row_count): referenced keys no dimension row has.

    One scan of the facts counts all keys, so the anti join moves one row per key.
    """
    cells = [F.struct(F.lit(k).alias("foreign_key"), F.col(k).cast("string").alias("orphan")) for k in FOREIGN_KEYS]
    per_key = (
        facts.select(F.inline(F.array(*cells))).where("orphan IS NOT NULL")
        .groupBy("foreign_key", "orphan").agg(_rows().alias("row_count"))
    )
    known = _stack([
        dimensions[owner].select(F.lit(key).alias("foreign_key"), F.col(key).cast("string").alias("orphan"))
        for key, owner in FOREIGN_KEYS.items()
    ])
    return per_key.join(known, ["foreign_key", "orphan"], "left_anti")


def too_long(feeds: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, declared, longest, too_long) per VARCHAR column, one scan a table."""
    return _stack([_report(name, "too_long", _measured(name, df, "too_long")) for name, df in feeds.items()])


def too_large(feeds: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, declared, too_large): numbers that overflow their DECIMAL column.

    Text that is no number at all is not counted here.
    """
    return _stack([
        _report(name, "too_large", _measured(name, df, "too_large")) for name, df in feeds.items() if STAR[name].decimals
    ])


def defects(feeds: dict[str, DataFrame]) -> DataFrame:
    """(feed, defect, row_count, pct) for the known defects of the four raw feeds, one scan a feed."""
    return _stack([_report(name, "defects", _measured(name, df, "defects")) for name, df in feeds.items()])


def _defects(feed: str) -> dict[str, Column]:
    name, region = F.col("full_name"), F.col("region")
    other_case = ((name == F.upper(name)) | (name == F.lower(name))) & (name != title_case(name))
    not_iso = F.col("opening_date").isNotNull() & parse_iso_date(F.col("opening_date")).isNull()
    return {
        "customers": {"name in one case": F.count_if(other_case)},
        "products": {
            "price with pound sign": F.count_if(F.contains("sell_price", F.lit("£"))),
            "cost missing": F.count_if(F.col("cost_price").isNull()),
        },
        "stores": {
            "date not ISO": F.count_if(not_iso), "region variant": F.count_if(harmonise_region(region) != region),
        },
        "transactions": {
            "guest checkout": F.count_if(F.col("customer_id").isNull()),
            "no store": F.count_if(F.col("store_id").isNull()),
        },
    }[feed]


def _overflows(column: str, kind) -> Column:
    number = F.replace(F.col(column), F.lit("£"), F.lit(""))
    return F.count_if(number.try_cast("double").isNotNull() & number.try_cast(kind).isNull())


def _repeated(key: str) -> Column:
    return _rows() - F.count_distinct(key) - F.max(F.col(key).isNull().cast("int"))


def _wanted(feed: str, report: str) -> dict[str, Column]:
    """What a report needs of a feed, by name: aggregates of one pass."""
    table = STAR[feed]
    if report == "too_long":
        longest = {f"longest:{c}": F.max(F.length(c)).cast("int") for c in table.lengths}
        return longest | {f"too_long:{c}": F.count_if(F.length(c) > n) for c, n in table.lengths.items()}
    if report == "too_large":
        return {f"too_large:{c}": _overflows(c, kind) for c, kind in table.decimals.items()}
    if report == "missing_keys":
        return {"missing": F.count_if(F.col(table.key).isNull())}
    return {"rows": _rows()} | {f"defect:{d}": m for d, m in _defects(feed).items()}


_REPEATED = "defect:repeated id"
REPORTS = ["missing_keys", "too_long", "too_large", "defects"]


def measures(feed: str) -> list[Column]:
    """All that can be observed of a feed on its way: what the reports need, but for repeated ids."""
    return [m.alias(n) for report in REPORTS for n, m in _wanted(feed, report).items()]


def repeated_ids(df: DataFrame, feed: str) -> dict[str, int]:
    """The one measure that takes a distinct count, where a report has it."""
    return {_REPEATED: df.agg(_repeated(STAR[feed].key)).first()[0]} if feed == "customers" else {}


def _measured(feed: str, df: DataFrame, report: str) -> DataFrame:
    wanted = _wanted(feed, report)
    if report == "defects" and feed == "customers":
        wanted[_REPEATED] = _repeated(STAR[feed].key)
    return df.agg(*[m.alias(n) for n, m in wanted.items()])


def _report(feed: str, report: str, measured: DataFrame) -> DataFrame:
    """The rows of a report from the one row of its measures."""
    table, cell = STAR[feed], lambda name: F.col(f"`{name}`")
    if report == "missing_keys":
        return measured.select(F.lit(feed).alias("table_name"), "missing")
    if report == "defects":
        names = [n for n in measured.columns if n.startswith("defect:")]
        cells = [F.struct(F.lit(n[7:]).alias("defect"), F.coalesce(cell(n), F.lit(0)).cast("long").alias("row_count")) for n in names]
        pct = F.round(F.try_divide(F.col("row_count").cast("decimal(20,0)") * 100, F.col("rows")), 1)
        rows = measured.select("rows", F.inline(F.array(*cells)))
        return rows.select(F.lit(feed).alias("feed"), "defect", "row_count", pct.alias("pct"))
    limits = table.lengths if report == "too_long" else {c: kind.simpleString() for c, kind in table.decimals.items()}
    counts = ["longest", "too_long"] if report == "too_long" else ["too_large"]
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(limit).alias("declared"), *[cell(f"{n}:{c}").alias(n) for n in counts])
        for c, limit in limits.items()
    ]
    return measured.select(F.lit(feed).alias("table_name"), F.inline(F.array(*cells)))


def reports(spark: SparkSession, measured: dict[str, dict[str, int]]) -> dict[str, DataFrame]:
    """The reports by name, from measures taken before: by feed, those of ``measures`` and ``repeated_ids``."""
    frames: dict[str, list[DataFrame]] = {}
    for feed, values in measured.items():
        kind = ", ".join(f"`{n}` {'int' if n.startswith('longest:') else 'long'}" for n in values)
        row = spark.createDataFrame([tuple(values.values())], kind)
        for report in REPORTS:
            if report != "too_large" or STAR[feed].decimals:
                frames.setdefault(report, []).append(_report(feed, report, row))
    return {report: _stack(each) for report, each in frames.items()}


def near_duplicates(customers: DataFrame) -> DataFrame:
    """People that appear under several ids: same name, phone and postcode, of which one may be missing.

    One row for each person and id. Customers without phone and postcode share nothing but a name and are
    left out. Ids are counted and joined back, not gathered, since a group may have any number of them.
    """
    person = ["full_name", "phone", "postcode"]
    ids = (
        customers.where("customer_id IS NOT NULL AND (phone IS NOT NULL OR postcode IS NOT NULL)")
        .select(title_case(F.col("full_name")).alias("full_name"), "phone", "postcode", "customer_id")
        .distinct()
    )
    several = ids.groupBy(*person).agg(_rows().alias("ids")).where("ids > 1")
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"s.{c}")) for c in person]
    return ids.alias("i").join(several.alias("s"), same).select("i.*", "s.ids")


def sold_before_opening(facts: DataFrame, stores: DataFrame) -> DataFrame:
    """Stores with sales dated before they opened, with the first date and number of such sales.

    Facts are counted per store and day first: the join sees at most that many rows.
    """
    per_day = (
        facts.where("quantity > 0 AND store_id IS NOT NULL")
        .groupBy("store_id", "transaction_date")
        .agg(_rows().alias("n"))
    )
    opened = stores.select("store_id", "opening_date")
    early = per_day.join(opened, "store_id").where("transaction_date < opening_date")
    return early.groupBy("store_id", "opening_date").agg(
        F.min("transaction_date").alias("first_sale"), F.sum("n").alias("early_sales")
    )
