"""Training-log operators: best so far, running means, NaN streaks, interval averages.

All are segmented scans (``scan``): a run's rows may spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import carried, chunked, within

#: Rows of a run that a task takes together.
SIZE = 1_000_000


def running_best(df: DataFrame, run: str, it: str, value: str, size: int = SIZE) -> DataFrame:
    """``best``: the value is smaller than all before it in its run. A chunk hands on its minimum."""
    rows = carried(chunked(df, [run], it, size), [run], {"_min": F.min(value)}, {"_least": lambda before, after: F.min("_min").over(before)})
    least = F.least(F.min(value).over(within([run], it).rowsBetween(Window.unboundedPreceding, -1)), F.col("_least"))
    return rows.withColumn("best", least.isNull() | (F.col(value) < least)).drop("_chunk", "_least")


def running_mean(df: DataFrame, epoch: str, step: str, value: str, size: int = SIZE) -> DataFrame:
    """``running_mean`` of the values so far in an epoch, nulls left out. A chunk hands on its sum and count."""
    summary = {"_s": F.sum(F.col(value).cast("double")), "_n": F.count(value)}
    rows = carried(chunked(df, [epoch], step, size), [epoch], summary, {"_sum": lambda before, after: F.sum("_s").over(before), "_count": lambda before, after: F.sum("_n").over(before)})
    w, none = within([epoch], step), F.lit(0)
    total = F.coalesce(F.sum(F.col(value).cast("double")).over(w), none) + F.coalesce("_sum", none)
    return rows.withColumn("running_mean", F.try_divide(total, F.count(value).over(w) + F.coalesce("_count", none))).drop("_chunk", "_sum", "_count")


def nan_streaks(df: DataFrame, tag: str, it: str, bad: Column, n: int = 10, size: int = SIZE) -> DataFrame:
    """The rows at which a run of bad values reaches ``n``; a good value starts anew.

    A chunk hands on how many bad values it ends with, and whether those are all it has.
    """
    w = within([tag], it)
    flagged = chunked(df.withColumn("_bad", F.coalesce(bad, F.lit(False))), [tag], it, size)
    flagged = flagged.withColumn("_island", F.sum(F.when(F.col("_bad"), 0).otherwise(1)).over(w))
    flagged = flagged.withColumn("streak", F.sum(F.col("_bad").cast("int")).over(within([tag, "_island"], it)))
    summary = {"_end": F.max_by("streak", F.struct(it, "_island", "streak")), "_good": F.max("_island") > 0, "_rows": F.count(F.lit(1))}
    # Behind the last chunk with a good value all are bad: their rows, and what that chunk ended with.
    since = lambda before, after: F.sum("_rows").over(before) - F.coalesce(F.last(F.when(F.col("_good"), F.col("_to") - F.col("_end")), ignorenulls=True).over(before), F.lit(0))
    rows = carried(flagged, [tag], summary, {"_since": since}, {"_to": lambda upto: F.sum("_rows").over(upto)})
    streak = F.col("streak") + F.when(F.col("_island") == 0, F.coalesce("_since", F.lit(0))).otherwise(F.lit(0))
    return rows.withColumn("streak", streak).filter(F.col("_bad") & (F.col("streak") == n)).drop("_bad", "_island", "_chunk", "_since")


def _intervals(df: DataFrame, run: str, seconds: Column, size: int) -> DataFrame:
    """run, _t, _chunk, _x (time since the run's row before), _i (number of the interval, from 1): one row an interval."""
    rows = chunked(df.select(run, seconds.alias("_t")).filter("_t IS NOT NULL"), [run], "_t", size)
    summary = {"_end": F.max("_t"), "_rows": F.count(F.lit(1))}
    rows = carried(rows, [run], summary, {"_last": lambda before, after: F.max("_end").over(before), "_before": lambda before, after: F.sum("_rows").over(before)})
    w = Window.partitionBy(run, "_chunk").orderBy("_t")
    rows = rows.withColumn("_x", F.col("_t") - F.coalesce(F.lag("_t").over(w), F.col("_last")))
    return rows.withColumn("_i", F.row_number().over(w) + F.coalesce("_before", F.lit(0)) - 1).filter("_x IS NOT NULL").drop("_last", "_before")


def interval_ema(df: DataFrame, run: str, seconds: Column, alpha: float = 0.7, total: int = 1000, step: int = 1, size: int = SIZE) -> DataFrame:
    """run, updates, mean_interval, ema, remaining (seconds).

    Intervals lie between a run's successive times; the first is discarded, the second seeds, then
    alpha * ema + (1 - alpha) * x. Each update is an affine map; a chunk's composition is ema -> a * ema + b, with a
    power of alpha and a weighted sum, and the chunks' maps compose in turn.
    """
    rows = _intervals(df, run, seconds, size)
    m = F.count(F.lit(1)).over(Window.partitionBy(run, "_chunk"))
    j = F.row_number().over(Window.partitionBy(run, "_chunk").orderBy("_t"))
    share = F.when(F.col("_i") == 1, F.lit(0.0)).when(F.col("_i") == 2, F.lit(1.0)).otherwise(F.lit(1 - alpha))
    maps = rows.withColumn("_w", share * F.pow(F.lit(alpha), m - j)).groupBy(run, "_chunk").agg(F.count(F.lit(1)).alias("_m"), F.sum("_x").alias("_s"), F.sum(F.col("_w") * F.col("_x")).alias("_b"))
    later = F.coalesce(F.sum("_m").over(Window.partitionBy(run).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = maps.withColumn("_b", F.col("_b") * F.pow(F.lit(alpha), later)).groupBy(run).agg(F.sum("_m").alias("updates"), (F.sum("_s") / F.sum("_m")).alias("mean_interval"), F.sum("_b").alias("ema"))
    out = out.withColumn("ema", F.when(F.col("updates") == 1, F.col("mean_interval")).otherwise(F.col("ema")))
    return out.withColumn("remaining", (F.lit(total) - F.col("updates")) * F.col("ema") / F.lit(step))


def interval_means(df: DataFrame, run: str, seconds: Column, every: int, step: int = 1, size: int = SIZE) -> DataFrame:
    """run, log, updates, mean: of each ``every`` successive intervals of a run (the last may have fewer) the mean time a step."""
    rows = _intervals(df, run, seconds, size).withColumn("log", F.floor((F.col("_i") - 1) / F.lit(every)))
    return rows.groupBy(run, "log").agg(F.count(F.lit(1)).alias("updates"), (F.avg("_x") / F.lit(step)).alias("mean"))


def timed_sections(df: DataFrame, run: str, seconds: Column, kind: str, size: int = SIZE) -> DataFrame:
    """run, start, time: the time from each ``start`` row to the ``end`` row that comes next in its run.

    At equal times an end goes before a start. A start not followed by an end gives nothing, nor does an end alone.
    """
    rows = chunked(df.select(run, seconds.alias("_t"), F.col(kind).alias("_kind")).filter("_t IS NOT NULL"), [run], "_t", size)
    here = F.struct("_t", "_kind")
    rows = carried(rows, [run], {"_end": F.max(here)}, {"_last": lambda before, after: F.max("_end").over(before)})
    rows = rows.withColumn("_from", F.coalesce(F.lag(here).over(Window.partitionBy(run, "_chunk").orderBy("_t", "_kind")), F.col("_last")))
    return rows.filter((F.col("_kind") == "end") & (F.col("_from")["_kind"] == "start")).select(run, F.col("_from")["_t"].alias("start"), (F.col("_t") - F.col("_from")["_t"]).alias("time"))
