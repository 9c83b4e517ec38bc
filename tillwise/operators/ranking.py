"""Ranks and quintiles over whole tables without gathering them in one task, cuts without sorting them.

``row_number`` over an unpartitioned window sorts everything in one task. Here the table is sorted
by a range shuffle, each sorted task numbers its own rows, and the numbers before each task are
added from a table with one row per task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.sources.scratch import materialise


SAMPLE = 1 << 20  # rows that bracket the cuts
_SIGMAS = 6


def _common_type(kinds: list[T.DataType]) -> T.DataType:
    """A type that holds every value of each measure and orders it alike."""
    if len({k.simpleString() for k in kinds}) == 1:
        return kinds[0]
    if all(isinstance(k, (T.IntegralType, T.DecimalType)) for k in kinds):
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
        exact = [(k.precision, k.scale) if isinstance(k, T.DecimalType) else (digits[type(k)], 0) for k in kinds]
        scale = max(s for _, s in exact)
        whole = max(p - s for p, s in exact)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if all(isinstance(k, (T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType)) for k in kinds):
        return T.DoubleType()
    raise TypeError(f"no type holds {', '.join(k.simpleString() for k in kinds)} without loss: rank them one by one")


def sorted_positions(df: DataFrame, id_col: str, measures: list[str]) -> DataFrame:
    """Sort every measure by (value, id) in one range shuffle and freeze each row's position.

    Returns (measure, value, id, pos): ``pos`` grows along the sort and has no gap within a task.
    The sort keys are unique, so ties in the measure, however many, are split between tasks. The
    result is a written table, because range boundaries are sampled anew on every run.
    """
    return _positions(_long(df, id_col, measures))


def _long(df: DataFrame, id_col: str, measures: list[str]) -> DataFrame:
    """(measure, value, id): a row for each measure."""
    common = _common_type([df.schema[m].dataType for m in measures])
    pairs = ", ".join(f"'{m}', CAST({m} AS {common.simpleString()})" for m in measures)
    return df.selectExpr(f"{id_col} AS id", f"stack({len(measures)}, {pairs}) AS (measure, value)").select("measure", "value", "id")


def _positions(long: DataFrame) -> DataFrame:
    ordered = long.orderBy("measure", "value", "id")
    return materialise(ordered.withColumn("pos", F.monotonically_increasing_id()), "positions")


def _task_of(pos: Column) -> Column:
    # monotonically_increasing_id puts the task number above the lower 33 bits.
    return F.shiftrightunsigned(pos, 33)


def _spans(positions: DataFrame) -> DataFrame:
    """One row per measure and sorted task: its first position, row count and rows before it."""
    spans = positions.groupBy("measure", _task_of(F.col("pos")).alias("task")).agg(
        F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n")
    )
    per_measure = Window.partitionBy("measure")
    before = per_measure.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select(
        "measure", "task", "first_pos", "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(per_measure).alias("total"),
    )


def first_rank(df: DataFrame, id_col: str, measure: str) -> DataFrame:
    """(id, measure, rank): unique ranks from 1, ties in id order.

    The broadcast side has one row per sorted task, so the shuffle partition setting bounds it.
    """
    positions = sorted_positions(df, id_col, [measure])
    spans = _spans(positions).select("task", "first_pos", "before")
    ranked = positions.withColumn("task", _task_of(F.col("pos"))).join(F.broadcast(spans), "task")
    return ranked.select(
        F.col("id").alias(id_col),
        F.col("value").cast(df.schema[measure].dataType).alias(measure),
        (F.col("before") + F.col("pos") - F.col("first_pos") + 1).alias("rank"),
    )


def _rows_at(positions: DataFrame, wanted: dict[str, dict[int, int]]) -> dict[tuple[str, int], tuple]:
    """(value, id) by measure and label, for the rank (from 1) that ``wanted`` names; ranks nobody has are left out."""
    cells = [(m, label, rank) for m, ranks in wanted.items() for label, rank in ranks.items()]
    if not cells:
        return {}
    asked = positions.sparkSession.createDataFrame(cells, "measure string, label long, rank long")
    ends = (
        _spans(positions)
        .join(F.broadcast(asked), "measure")
        .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
        .select("measure", "label", (F.col("first_pos") + F.col("rank") - F.col("before") - 1).alias("pos"))
        .collect()
    )
    places = sorted({row.pos for row in ends})
    rows = {r.pos: (r.value, r.id) for r in positions.where(F.col("pos").isin(places)).collect()}
    return {(row.measure, row.label): rows[row.pos] for row in ends}


def _within(value: Column, ident: Column, cut: tuple) -> Column:
    """Whether a row stands at the cut or before it; rows without a value stand first."""
    return F.coalesce((value < F.lit(cut[0])) | ((value == F.lit(cut[0])) & (ident <= F.lit(cut[1]))), F.lit(True))


def _brackets(size: int, sampled: int, last_ranks: dict[int, int]) -> Iterator[tuple[int, int, int]]:
    """(bucket, low, high): ranks in the sample that lie around each wanted rank.

    A sample rank errs by the deviation of a draw without replacement; ``_SIGMAS`` of it on either side.
    """
    for b, rank in last_ranks.items():
        share = rank / size
        spread = _SIGMAS * math.sqrt(sampled * share * (1 - share) * (1 - sampled / size)) + 1
        yield b, math.floor(share * sampled - spread), math.ceil(share * sampled + spread)


def rank_cuts(df: DataFrame, id_col: str, measures: list[str], buckets: int = 5, sample: int = SAMPLE) -> dict[str, list[tuple]]:
    """For each measure the last (value, id) of every bucket but the highest.

    Buckets split the ranks 1..n at the linear quantiles of the ranks, right-closed: bucket b ends
    at rank 1 + floor(b * (n - 1) / buckets). That is not ``ntile``, which sizes buckets otherwise
    unless n mod buckets is 0 or 1.

    The cuts are selected, not sorted out: about ``sample`` rows, chosen by the hash of their id, are ranked and bracket
    each cut. One scan counts the rows before each bracket and keeps the few inside, and only these are ranked. Brackets
    are of (value, id), so ties, however many, do not widen them. The counts prove each cut; should one lie outside its
    bracket, the table is sorted whole. Ids must be unique. Only two rows for each cut reach the driver.
    """
    size = df.count()
    last_ranks = {b: 1 + b * (size - 1) // buckets for b in range(1, buckets)} if size else {}
    long = _long(df, id_col, measures)
    if size > sample:
        found = _selected(df, long, id_col, measures, size, last_ranks, sample)
    else:
        found = _rows_at(_positions(long), {m: last_ranks for m in measures})
    if len(found) < len(measures) * len(last_ranks):
        found = _rows_at(_positions(long), {m: last_ranks for m in measures})
    return {m: [found[m, b] for b in last_ranks] for m in measures}


def _selected(
    df: DataFrame, long: DataFrame, id_col: str, measures: list[str], size: int, last_ranks: dict[int, int], sample: int
) -> dict[tuple[str, int], tuple]:
    """The cuts by measure and bucket, without those that lie outside their brackets."""
    chosen = F.pmod(F.xxhash64("id", F.lit(19)), F.lit(1 << 40)) < math.ceil(sample / size * (1 << 40))
    ranked = _positions(long.where(chosen))
    sampled = ranked.count() // len(measures)
    sides = {b: (low, high) for b, low, high in _brackets(size, sampled, last_ranks)}
    # low ends under label 2b, high ends under 2b + 1; an end beyond the sample is open
    asked = {2 * b + i: rank for b, ends in sides.items() for i, rank in enumerate(ends) if 1 <= rank <= sampled}
    ends = _rows_at(ranked, {m: asked for m in measures})

    common, ident = dict(long.dtypes)["value"], F.col(id_col)
    before, inside = [], []
    for m in measures:
        value = F.col(m).cast(common)
        for b in last_ranks:
            low, high = (ends.get((m, 2 * b + i)) for i in (0, 1))
            # an end without a value is open as well
            under = F.lit(False) if low is None or low[0] is None else _within(value, ident, low)
            upto = F.lit(True) if high is None or high[0] is None else _within(value, ident, high)
            before.append(F.count_if(under).alias(f"{m}:{b}"))
            cell = F.struct(F.lit(f"{m}:{b}").alias("measure"), value.alias("value"), ident.alias("id"))
            inside.append(F.when(~under & upto, cell))
    counted = Observation()
    few = df.observe(counted, *before).select(F.inline(F.filter(F.array(*inside), lambda c: c.isNotNull())))
    positions = _positions(materialise(few, "brackets"))
    ranks = {f"{m}:{b}": {b: rank - counted.get[f"{m}:{b}"]} for m in measures for b, rank in last_ranks.items()}
    return {(m.rsplit(":", 1)[0], b): row for (m, b), row in _rows_at(positions, ranks).items()}


def bucket_by_cuts(measure: str, id_col: str, cuts: list[tuple]) -> Column:
    """Bucket number (from 1) of a row by the cut rows of ``rank_cuts``."""
    value, ident = F.col(measure), F.col(id_col)
    score = F.lit(len(cuts) + 1)
    for bucket in range(len(cuts), 0, -1):
        cut_value, cut_id = cuts[bucket - 1]
        within = (value < F.lit(cut_value)) | ((value == F.lit(cut_value)) & (ident <= F.lit(cut_id)))
        score = F.when(within, F.lit(bucket)).otherwise(score)
    return score
