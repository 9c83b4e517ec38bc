"""Joins and roll-ups against dimensions of unknown size."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NULL_SPREAD = 1024

HOT = 64  # keys at most that a join treats by themselves
TRACKED = 4096  # keys that the sketch of the frequent ones keeps in a task


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate is within the session's broadcast threshold.

    This is the test Spark itself applies to a join side, asked early so that the plan for a large
    side can be a different one. A client that has no plans at hand (Spark Connect) gets no.
    """
    if not hasattr(df, "_jdf"):
        return False
    threshold = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return 0 <= int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= threshold


def _bytes(setting: str) -> int:
    """A size as Spark's settings spell it: 10485760, 10485760b, 256k, 10MB."""
    number, unit = re.fullmatch(r"(-?\d+)([bkmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".find(unit) if unit in tuple("kmgtp") else int(number)


def keep_known(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key the dimension has; null keys are dropped as well."""
    return facts.join(dimension.select(key), key, "left_semi").select(facts.columns)


def top_keys(key: str) -> Column:
    """The most frequent values of ``key`` with their counts, by a sketch of bounded size that merges over tasks.

    Counts are upper bounds, too high by 3.5 / ``TRACKED`` of all rows at most. The aggregate can be observed while the
    rows are on their way somewhere else, so it needs no pass of its own.
    """
    return F.expr(f"approx_top_k(`{key}`, {HOT}, {TRACKED})")


def hot_of(found: list | None, rows: int) -> list:
    """The keys that ``top_keys`` found in at least one of ``HOT`` rows, so there are ``HOT`` at most."""
    return [top["item"] for top in found or [] if top["item"] is not None and top["count"] * HOT >= rows]


def hot_keys(facts: DataFrame, key: str) -> list:
    """The keys that hold at least one of ``HOT`` rows each; one narrow pass over the facts."""
    found = facts.agg(top_keys(key).alias("top"), F.count(F.lit(1)).alias("n")).first()
    return hot_of(found.top, found.n)


def look_up(facts: DataFrame, side: DataFrame, key: str, spread_by: Column, hot: list | None = None) -> DataFrame:
    """Left join: all fact columns, then the columns of ``side`` but its key, which must be unique.

    A ``side`` too big to broadcast is joined as ``look_up_large`` does.
    """
    if fits_broadcast(side):
        side = side.where(F.col(key).isNotNull())
        return facts.join(side, key, "left").select(*facts.columns, *[c for c in side.columns if c != key])
    return look_up_large(facts, side, key, spread_by, hot)


def look_up_large(facts: DataFrame, side: DataFrame, key: str, spread_by: Column, hot: list | None = None) -> DataFrame:
    """``look_up`` by shuffle, where no key may gather its rows in one task.

    Null keys match nothing, yet a shuffle would send them all to one task, so they are replaced by many different ones;
    a leading letter keeps these apart from real keys. ``hot`` lists keys with many rows (see ``hot_keys``): their rows of
    ``side``, one for each key, are broadcast, and facts with such a key are spread like nulls. The facts are read once
    and stay in one frame. A hot key that is not listed is left to adaptive skew join, which can split the fact side of
    a left join: the list changes the plan, never the result.
    """
    side, others = side.where(F.col(key).isNotNull()), [c for c in side.columns if c != key]
    away, given = F.col(key).isNull(), {c: F.col(f"_side.{c}") for c in others}
    rows = facts
    if hot:
        if len(hot) > HOT:
            raise ValueError(f"more than {HOT} hot keys")
        few = side.where(F.col(key).isin(hot)).select(key, F.struct(*others).alias("_few"))
        rows = facts.join(F.broadcast(few), key, "left")
        is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
        away, given = away | is_hot, {c: F.when(is_hot, F.col(f"_few.{c}")).otherwise(g) for c, g in given.items()}
    spread = F.pmod(F.xxhash64(spread_by), F.lit(_NULL_SPREAD)).cast("string")
    real = F.concat(F.lit("k"), F.col(key).cast("string"))
    tagged = side.select(real.alias("_match"), F.struct(*others).alias("_side"))
    rows = rows.withColumn("_match", F.when(away, F.concat(F.lit("n"), spread)).otherwise(real)).join(tagged, "_match", "left")
    return rows.select(*facts.columns, *[g.alias(c) for c, g in given.items()])


def null_unknown(facts: DataFrame, dimension: DataFrame, key: str, spread_by: Column, hot: list | None = None) -> DataFrame:
    """Keep every row; a key the dimension lacks becomes null. ``key`` must be unique in the dimension."""
    known = dimension.select(key, F.col(key).alias("_known"))
    found = look_up(facts, known, key, spread_by, hot)
    return found.select([F.col("_known").alias(c) if c == key else F.col(c) for c in facts.columns])


def sum_by_labels(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    labels: list[str],
    measures: dict[str, Column],
) -> DataFrame:
    """Sum ``measures`` over fact rows per label columns of the dimension (inner join on ``key``).

    ``measures`` must be sums or counts, so that partial results can be added up. A small dimension
    is joined first and the rows aggregate straight to the few labels. A large one is joined only
    after the facts are summed per key: rows of a hot key merge before the shuffle and the join
    moves at most one row per key, never the facts. Types and values are the same either way.
    """
    side = dimension.select(key, *labels)
    if fits_broadcast(side):
        return facts.join(side, key).groupBy(*labels).agg(*[m.alias(n) for n, m in measures.items()])
    per_key = facts.where(F.col(key).isNotNull()).groupBy(key).agg(*[m.alias(n) for n, m in measures.items()])
    # a sum of sums is declared wider; the total is the same as over the rows and fits their type
    types = dict(per_key.dtypes)
    return per_key.join(side, key).groupBy(*labels).agg(*[F.sum(n).cast(types[n]).alias(n) for n in measures])
