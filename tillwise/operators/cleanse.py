"""Turn raw text feeds into typed rows, each with a verdict on whether it may be loaded.

A cell that cannot be read or does not fit its declared column makes the row rejected, with the
first such cell as the reason. Rejected rows can be listed; in strict mode the first one ends the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.dates import parse_iso_date, parse_mixed_date
from tillwise.functions.lookups import harmonise_region
from tillwise.functions.numbers import impute_cost, parse_price
from tillwise.functions.text import strip, title_case
from tillwise.operators.dedupe import keep_first
from tillwise.schemas import STAR, Table
from tillwise.sources.feeds import MALFORMED, ORDINAL

REJECT = "_reject"

# Number of a row in a written table of typed rows.
ROW = "_row"

MARKED = 1 << 29  # rows of which a bit each, 64 MB, is broadcast
PASS = 1 << 26  # rows of which a load has the bits with the driver at a time, 9 MB for each question asked about them


def _cast(field: T.StructField) -> Column:
    """The cell as its declared type. Whole numbers may end in .0, as exports of columns with gaps have them."""
    cell = F.col(field.name)
    plain = cell.try_cast(field.dataType)
    if isinstance(field.dataType, T.IntegerType):
        # the pattern runs on cells only that do not cast as they are
        return F.coalesce(plain, F.regexp_replace(cell, r"^([+-]?\d+)\.0+$", "$1").try_cast(field.dataType))
    return plain


def _typed(raw: DataFrame, table: Table, cleaned: dict[str, Column]) -> DataFrame:
    """Declared columns, ordinal and verdict. Columns not in ``cleaned`` are cast to their type.

    Values are made in one step and judged in the next, by name: the optimizer does not merge steps when that would make
    it parse a cell twice, so the code of the stage stays small enough to be compiled.
    """
    values = {f.name: cleaned.get(f.name, _cast(f)) for f in table.stored}
    # Text always reads, so it is only measured; everything else fits if it reads.
    parsed = [name for name in values if name not in table.lengths]
    marked = [MALFORMED] if MALFORMED in raw.columns else []
    step = raw.select(
        *[value.alias(name) for name, value in values.items()],
        *[F.col(name).isNotNull().alias(f"_set_{name}") for name in parsed], *marked, ORDINAL,
    )
    reasons = [F.when(F.col(m), F.lit("row: malformed")) for m in marked]
    reasons.append(F.when(F.col(table.key).isNull(), F.lit(f"{table.key}: missing")))
    for name in values:
        if name in table.lengths:
            wrong, reason = F.length(name) > table.lengths[name], "too long"
        else:
            wrong, reason = F.col(f"_set_{name}") & F.col(name).isNull(), "unreadable"
        reasons.append(F.when(wrong, F.lit(f"{name}: {reason}")))
    return step.select(*values, ORDINAL, F.coalesce(*reasons).alias(REJECT))


def type_customers(raw: DataFrame) -> DataFrame:
    return _typed(raw, STAR["customers"], {
        "full_name": title_case(F.col("full_name")),
        "email": F.lower("email"),
        "signup_date": parse_iso_date(F.col("signup_date")),
    })


def type_products(raw: DataFrame) -> DataFrame:
    sell = parse_price(F.col("sell_price"))
    cost = F.col("cost_price").try_cast("decimal(10,2)")
    # An unreadable cost must not pass as an imputed one.
    readable = F.col("cost_price").isNull() | cost.isNotNull()
    return _typed(raw, STAR["products"], {
        "category": title_case(strip(F.col("category"))),
        "sell_price": sell,
        "cost_price": F.when(readable, impute_cost(cost, sell)),
        "launch_date": parse_iso_date(F.col("launch_date")),
    })


def type_stores(raw: DataFrame) -> DataFrame:
    return _typed(raw, STAR["stores"], {
        "region": harmonise_region(F.col("region")),
        "opening_date": parse_mixed_date(F.col("opening_date")),
    })


def type_transactions(raw: DataFrame) -> DataFrame:
    return _typed(raw, STAR["transactions"], {
        "transaction_date": parse_iso_date(F.col("transaction_date")),
    })


TYPERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": type_customers,
    "products": type_products,
    "stores": type_stores,
    "transactions": type_transactions,
}


def accepted(typed: DataFrame, strict: bool = False) -> DataFrame:
    """Rows that may be loaded. Strict: a rejected row fails the job with its reason."""
    if strict:
        message = F.concat(F.lit("rejected row, "), F.col(REJECT))
        passes = F.when(F.col(REJECT).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    else:
        passes = F.col(REJECT).isNull()
    return typed.where(passes).drop(REJECT)


def first_accepted(typed: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """The first acceptable row of each key; in strict mode a rejected copy surfaces and fails the job.

    The verdict takes part in the order and is filtered on after the dedupe. Filtering before it
    would make the optimizer copy the whole verdict, parsers and all, into the filter.
    """
    good = F.col(REJECT).isNull()
    first = keep_first(typed, key, [good.asc() if strict else good.desc(), ORDINAL])
    return accepted(first, strict).drop(ORDINAL)


def rejected(typed: DataFrame, feed: str) -> DataFrame:
    """(feed, row_key, reason) of every row that may not be loaded.

    The reason is unfolded rather than filtered on: a filter would be pushed below the typing and parse all cells again.
    """
    reason = F.when(F.col(REJECT).isNotNull(), F.array(REJECT))
    return typed.select(F.lit(feed).alias("feed"), F.col(STAR[feed].key).alias("row_key"), F.explode(reason).alias("reason"))


def left_out(rows: DataFrame, key: str, also: Column | None = None, single: bool = False) -> DataFrame:
    """(row, row_key, reason) of the acceptable rows that are not to be loaded: for the reason ``also``, or a repeated key.

    ``rows`` are typed rows with ``ROW``, read several times, so they must come from a written table. Of a key the first
    row by ordinal without a reason is the one to load. Narrow rows without the missing key are numbered, so whole rows
    are gathered for no key, and the rows are shuffled once. Rows with equal ordinals are the same row to their feed and
    stay together, unless ``single`` asks for one row of a key.
    """
    why = F.lit(None).cast("string") if also is None else also
    some = rows.where(F.col(REJECT).isNull()).select(ROW, ORDINAL, F.col(key).alias("row_key"), why.alias("reason"))
    good = some.where(F.col("reason").isNull()).drop("reason")
    order = Window.partitionBy("row_key").orderBy(ORDINAL, ROW) if single else Window.partitionBy("row_key").orderBy(ORDINAL)
    nth = F.row_number().over(order) if single else F.rank().over(order)
    again = good.withColumn("_nth", nth).where("_nth > 1")
    out = again.select(ROW, "row_key", F.lit(f"{key}: repeated").alias("reason"))
    if also is not None:
        out = out.unionByName(some.where(F.col("reason").isNotNull()).select(ROW, "row_key", "reason"))
    return out


def row_bits(rows: DataFrame) -> DataFrame:
    """(_block, _words): the numbers ``ROW`` of some rows as bits, 64 words of 64 bits for each block that has any."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.expr(f"CAST({ROW} & 63 AS INT)"))
    words = rows.groupBy(F.shiftright(ROW, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    entry = F.struct(F.expr("CAST(_word & 63 AS INT)"), "_bits")
    blocks = words.groupBy(F.shiftright("_word", 6).alias("_block")).agg(F.map_from_entries(F.collect_list(entry)).alias("_words"))
    return blocks.select("_block", F.expr("transform(sequence(0, 63), i -> coalesce(_words[i], 0L))").alias("_words"))


def row_ranges(typed: DataFrame, most: int) -> list[tuple[int, int, int]]:
    """(first, last, rows): ranges of ``ROW`` that together have all rows of a written table, at most ``most`` rows each.

    Numbers begin anew with each task that wrote, so what the driver gets is a row for each of these.
    """
    tasks = typed.groupBy(F.shiftright(ROW, 33).alias("task")).agg(F.min(ROW).alias("first"), F.max(ROW).alias("last"))
    ranges: list[tuple[int, int, int]] = []
    for task in sorted(tasks.collect(), key=lambda t: t["first"]):
        for first in range(task["first"], task["last"] + 1, most):
            last = min(first + most - 1, task["last"])
            rows = last - first + 1
            if ranges and ranges[-1][2] + rows <= most:
                ranges[-1] = (ranges[-1][0], last, ranges[-1][2] + rows)
            else:
                ranges.append((first, last, rows))
    return ranges


def in_range(typed: DataFrame, bits: DataFrame, first: int, last: int) -> tuple[DataFrame, DataFrame]:
    """The rows of a range of ``row_ranges``, and the blocks of ``bits`` that tell about them."""
    return typed.where(F.col(ROW).between(first, last)), bits.where(F.col("_block").between(first >> 12, last >> 12))


def marked(rows: DataFrame, bits: DataFrame, into: str, total: int) -> DataFrame:
    """``rows`` with the boolean ``into``: whether ``bits`` has their number.

    Of ``total`` rows, bits take an eighth of a byte each, so a hundred million rows stay where they are and 12 MB go to
    them. Above ``MARKED`` rows the join is left to the session.
    """
    side = F.broadcast(bits) if total <= MARKED else bits
    found = rows.withColumn("_block", F.shiftright(ROW, 12)).join(side, "_block", "left")
    bit = F.expr(f"shiftright(_words[CAST(shiftright({ROW}, 6) & 63 AS INT)], CAST({ROW} & 63 AS INT)) & 1")
    return found.select(*rows.columns, F.coalesce(bit == 1, F.lit(False)).alias(into))


def clean_dimension(raw: DataFrame, feed: str, strict: bool = False) -> DataFrame:
    """Typed, accepted rows of a dimension feed, the first of each key."""
    return first_accepted(TYPERS[feed](raw), STAR[feed].key, strict)
