"""Segmented scans: running values and nearest rows along a key's order, with a hot key spread over many tasks.

A key's rows are cut into chunks of about ``size`` rows. Each chunk is worked on alone; what it hands on is a small
summary, and the summaries of a key, scanned in turn, are carried into its chunks. Cuts are order values picked by
their hash, so that any run of a plan cuts alike; a key of fewer rows stays one chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Picked values a cut, cuts of a table at most (as expected): cuts and carried summaries are broadcast.
PICKS, CUTS = 8, 20_000


def _null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """Join with a small ``right`` on columns that may be null."""
    other = right.select(*[F.col(c).alias(f"_on_{c}") if c in names else F.col(c) for c in right.columns])
    same = None
    for c in names:
        one = F.col(c).eqNullSafe(F.col(f"_on_{c}"))
        same = one if same is None else same & one
    return left.join(F.broadcast(other), same, how).drop(*[f"_on_{c}" for c in names])


def cut_points(df: DataFrame, key: list[str], order: str, size: int) -> DataFrame:
    """key, _cuts: for keys of more than about ``size`` rows the ascending order values at which they are cut.

    A table is cut ``CUTS`` times at most, as expected: beyond ``CUTS`` x ``size`` rows chunks grow with it.
    """
    rows = df.select(*key, order)
    total = F.broadcast(df.agg(F.greatest(F.lit(size), F.floor(F.count(F.lit(1)) / CUTS)).alias("_size")))  # one row
    picked = rows.crossJoin(total).filter(F.col(order).isNotNull() & (F.pmod(F.xxhash64(*key, order), F.col("_size")) < PICKS)).select(*key, order).distinct()
    ranked = picked.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(order))).filter(F.col("_r") % PICKS == 0)
    return ranked.groupBy(*key).agg(F.array_sort(F.collect_list(order)).alias("_cuts"))


def with_cuts(df: DataFrame, key: list[str], order: str, size: int, cuts: DataFrame | None = None) -> DataFrame:
    """``df`` with ``_cuts``, its key's cuts (``cuts``, or those of its own rows), for ``chunk_at``; null without any."""
    return _null_safe(df, cut_points(df, key, order, size) if cuts is None else cuts, key)


def chunk_at(value: Column) -> Column:
    """How many of the row's ``_cuts`` are at or below ``value``, by binary search."""
    steps = F.array(*[F.lit(1 << b) for b in range(CUTS.bit_length(), -1, -1)])
    # A step is taken if the cut before its end isn't above the value.
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("_cuts", at + step - 1) <= value, at + step).otherwise(at))
    return F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(found)


def chunked(df: DataFrame, key: list[str], order: str, size: int) -> DataFrame:
    """``df`` with ``_chunk``, the number of a key's cuts at or below the row's order value."""
    return with_cuts(df, key, order, size).withColumn("_chunk", chunk_at(F.col(order))).drop("_cuts")


def overlapping(df: DataFrame, key: list[str], order: str, reach: Column, size: int, cuts: DataFrame | None = None) -> DataFrame:
    """``df`` with ``_home``, the row's chunk, and ``_chunk``: a copy for every chunk within ``reach`` of the row."""
    at = F.col(order)
    rows = with_cuts(df, key, order, size, cuts).withColumn("_home", chunk_at(at))
    return rows.withColumn("_chunk", F.explode(F.sequence(chunk_at(at - reach), chunk_at(at + reach)))).drop("_cuts")


def carried(rows: DataFrame, key: list[str], summary: dict[str, Column], carry: dict[str, Callable[[WindowSpec, WindowSpec], Column]], through: dict[str, Callable[[WindowSpec], Column]] | None = None) -> DataFrame:
    """``rows`` (with ``_chunk``) with the columns ``carry`` that their chunk is given; null in keys of one chunk.

    ``summary``: aggregates of a chunk. ``carry``: functions of two windows over a key's summaries, all earlier chunks
    and all later ones, from the last to the next: the nearest chunk is the last row of either; before that, ``through`` adds functions of the window up to and with a chunk.
    """
    chunks = rows.groupBy(*key, "_chunk").agg(*[v.alias(k) for k, v in summary.items()])
    line = Window.partitionBy(*key).orderBy("_chunk")
    chunks = chunks.withColumns({k: f(line.rowsBetween(Window.unboundedPreceding, 0)) for k, f in (through or {}).items()})
    before, after = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (line, Window.partitionBy(*key).orderBy(F.desc("_chunk"))))
    many = F.count(F.lit(1)).over(Window.partitionBy(*key)) > 1
    given = chunks.select(*key, "_chunk", many.alias("_many"), *[f(before, after).alias(k) for k, f in carry.items()]).filter("_many").drop("_many")
    return _null_safe(rows, given, [*key, "_chunk"])


def within(key: list[str], order: str, *more: str) -> WindowSpec:
    """The window of a chunk's rows up to the current one."""
    return Window.partitionBy(*key, "_chunk").orderBy(order, *more).rowsBetween(Window.unboundedPreceding, 0)
