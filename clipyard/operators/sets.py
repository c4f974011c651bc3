"""Concatenating, oversampling, combining, ordering, sharding and batching datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .manifest import global_rank


def mix(video: list[DataFrame], audio: list[DataFrame], oversample: int = 1) -> DataFrame:
    """All datasets, video first, as ``dataset_ord`` and ``copy``; video rows come ``oversample`` times by one explode."""
    parts = [(df, oversample) for df in video] + [(df, 1) for df in audio]
    tagged = [df.withColumn("dataset_ord", F.lit(i)).withColumn("_times", F.lit(n)) for i, (df, n) in enumerate(parts)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return every.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def global_index(mixed: DataFrame, order: str, ord_col: str = "dataset_ord") -> DataFrame:
    """``sample_idx`` within the dataset and ``global_idx`` over all: earlier datasets' sizes are added."""
    ranked = global_rank(mixed, ord_col, order, name="global_idx")
    first = ranked.groupBy(ord_col).agg(F.min("global_idx").alias("_before"))  # one row a dataset; Spark broadcasts by measured size
    return ranked.join(first, ord_col).withColumn("sample_idx", F.col("global_idx") - F.col("_before")).drop("_before")


def lookup_index(indexed: DataFrame, wanted: DataFrame, i: str = "i") -> DataFrame:
    """The rows of ``indexed`` at the global positions ``i`` of ``wanted``; negative ones count from the end, as ``i`` keeps."""
    total = indexed.agg(F.count(F.lit(1)).alias("_total"))
    at = wanted.crossJoin(F.broadcast(total)).withColumn("global_idx", F.when(F.col(i) < 0, F.col("_total") + F.col(i)).otherwise(F.col(i))).drop("_total")  # one row
    return at.join(indexed, "global_idx")


def combine_shards(df: DataFrame, id_col: str = "id", order: list[str] | None = None, dedup: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, one-row count of dropped duplicates): the first row of each id in order; all rows without ``dedup``."""
    if not dedup:
        return df, df.agg(F.lit(0).cast("long").alias("duplicates"))
    rest = [c for c in df.columns if c != id_col]
    first = df.groupBy(id_col).agg(F.min_by(F.struct(*rest), F.struct(*(order or rest))).alias("r"))
    count = df.agg((F.count(F.lit(1)) - F.count_distinct(F.coalesce(F.col(id_col).cast("string"), F.lit("\0")))).alias("duplicates"))
    return first.select(id_col, *[F.col("r")[c].alias(c) for c in rest]), count


def replicate(df: DataFrame, n: int, id_col: str) -> DataFrame:
    """``n`` copies; copies after the first get ``_copy_k`` on their id."""
    return df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(id_col, F.when(F.col("_k") > 0, F.concat(F.col(id_col).cast("string"), F.lit("_copy_"), F.col("_k").cast("string"))).otherwise(F.col(id_col).cast("string"))).drop("_k")


def shuffle_key(id_: Column, seed: int, epoch: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(epoch)), id_.cast("string")).cast("binary"))


def epoch_order(df: DataFrame, id_col: str, seed: int, epoch: int) -> DataFrame:
    """``pos``: a permutation of the rows that seed and epoch fix."""
    return global_rank(df.withColumn("_key", shuffle_key(F.col(id_col), seed, epoch)), "_key", id_col, name="pos").drop("_key")


def assign_rank(df: DataFrame, pos: str, world: int) -> DataFrame:
    """Rows dealt to ranks in turn; the first rows come again until every rank has as many."""
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    padded = df.crossJoin(F.broadcast(total))  # one row
    pad = F.pmod(-F.col("_n"), F.lit(world))
    again = F.when(F.col("_n") > 0, F.floor((pad - F.col(pos) + F.col("_n") - 1) / F.col("_n"))).otherwise(F.lit(0))
    times = F.greatest(again, F.lit(0)).cast("int")
    rows = padded.withColumn("_t", F.explode(F.sequence(F.lit(0), times)))
    return rows.withColumn("padded_pos", F.col(pos) + F.col("_t") * F.col("_n")).withColumn("rank", F.pmod(F.col("padded_pos"), F.lit(world)).cast("int")).drop("_t", "_n")


def assign_batch(df: DataFrame, pos: str, batch: int, drop_last: bool) -> DataFrame:
    """``batch_id`` by position; without the last batch if it isn't full and ``drop_last``."""
    out = df.withColumn("batch_id", F.floor(F.col(pos) / F.lit(batch)).cast("long"))
    if not drop_last:
        return out
    n = df.agg(F.floor(F.count(F.lit(1)) / F.lit(batch)).alias("_full"))
    return out.crossJoin(F.broadcast(n)).filter(F.col("batch_id") < F.col("_full")).drop("_full")  # one row


def batch_counts(df: DataFrame, batch: int, world: int, drop_last: bool) -> DataFrame:
    """One row: batches (of ``batch`` rows, a last one that isn't full counts unless ``drop_last``) and per_rank, a rank's share of a batch."""
    n = F.count(F.lit(1)) / F.lit(batch)
    return df.agg((F.floor(n) if drop_last else F.ceil(n)).cast("long").alias("batches"), F.lit(batch // world).cast("long").alias("per_rank"))


def pending(df: DataFrame, done: DataFrame, on: str = "id") -> DataFrame:
    """What a resumed job has still to do."""
    return df.join(done.select(on), on, "left_anti")


def condition_dropout(df: DataFrame, id_col: str, p: float, seed: int) -> DataFrame:
    """Independent masks ``drop_video`` and ``drop_text``, true with probability ``p``, from hashes of the id."""
    draw = lambda what: F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}-{what}"), F.col(id_col).cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32) < p
    return df.withColumn("drop_video", draw("video")).withColumn("drop_text", draw("text"))


def fill_missing(df: DataFrame, shapes: dict[str, int]) -> DataFrame:
    """Zero vectors of the given lengths where a feature is null, and ``<feature>_exist``."""
    for name, n in shapes.items():
        df = df.withColumn(f"{name}_exist", F.col(name).isNotNull()).withColumn(name, F.coalesce(F.col(name).cast("array<double>"), F.array_repeat(F.lit(0.0), n)))
    return df
