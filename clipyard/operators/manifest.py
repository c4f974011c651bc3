"""Matching manifests with media: semi and anti joins, last-wins captions, path resolution, audits, splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path


def only_split(df: DataFrame, split: str, col: str = "split") -> DataFrame:
    return df.filter(F.col(col) == split)


def sorted_slice(df: DataFrame, key: str, start: int, end: int = -1) -> DataFrame:
    """Rows [start, end) in the order of ``key``; end -1: to the last.

    Range-partitioned sort with ranks from per-partition counts, so no task holds all rows.
    """
    ranked = global_rank(df, key)
    keep = F.col("_rank") >= start
    return ranked.filter(keep if end < 0 else keep & (F.col("_rank") < end)).drop("_rank")


def global_rank(df: DataFrame, *keys: str | Column, name: str = "_rank") -> DataFrame:
    """``df`` with the 0-based position of each row in the order of ``keys`` (ties to the remaining columns).

    Ranges of the order key are cut from a sample, rows are ranked within a range, and range sizes are summed: no task
    holds more than one range. The cut rows are written once, since another run could cut elsewhere.
    """
    order = [F.col(k) if isinstance(k, str) else k for k in keys]
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*order, *[F.col(c) for c, t in df.dtypes if c not in keys and not t.startswith(("map", "variant"))]]
    cut = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id() % F.lit(1 << 33))
    path = scratch_path(spark, "ranges")
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    sizes = cut.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a range
    return cut.join(F.broadcast(before.select("_part", "_before")), "_part").withColumn(name, F.col("_before") + F.col("_in")).drop("_part", "_in", "_before")


def usable(manifest: DataFrame, inventory: DataFrame, on: str = "id") -> DataFrame:
    """Manifest rows whose media exists."""
    return manifest.join(inventory.select(on), on, "left_semi")


def missing(manifest: DataFrame, inventory: DataFrame, on: str = "id") -> DataFrame:
    """Manifest rows whose media doesn't exist."""
    return manifest.join(inventory.select(on), on, "left_anti")


def missing_counts(manifest: DataFrame, inventory: DataFrame, on: str = "id") -> DataFrame:
    """One row: listed, found and missing manifest rows."""
    has = inventory.select(on).distinct().withColumn("_has", F.lit(True))
    found = F.count_if(F.coalesce("_has", F.lit(False)))
    return manifest.join(has, on, "left").agg(F.count(F.lit(1)).alias("listed"), found.alias("found"), (F.count(F.lit(1)) - found).alias("missing"))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the last in order. Combined before the shuffle, so a hot key stays cheap."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])


def attach_captions(clips: DataFrame, captions: DataFrame, key: str, order: str) -> DataFrame:
    """Clips with their caption, the last one listed; clips without any are dropped. Spark broadcasts by measured size."""
    return clips.join(last_wins(captions, key, order).drop(order), key)


def resolve_paths(manifest: DataFrame, inventory: DataFrame, exts: list[str]) -> DataFrame:
    """``path`` for each manifest id: its exact name; else, for ids without a suffix, the first listed extension that
    exists; else the only file with that stem; else null.

    ``inventory``: name, stem, ext, path.
    """
    rank = reduce(lambda acc, e: acc.when(F.col("ext") == e[1], F.lit(e[0])), enumerate(exts), F.when(F.lit(False), F.lit(0)))
    exact = inventory.groupBy(F.col("name").alias("id")).agg(F.min("path").alias("_exact"))
    by_stem = inventory.withColumn("_r", rank).groupBy(F.col("stem").alias("id")).agg(F.min_by("path", F.struct("_r", "path")).alias("_any"), F.min_by("path", F.when(F.col("_r").isNotNull(), F.struct("_r", "path"))).alias("_listed"), F.count(F.lit(1)).alias("_n"))
    joined = manifest.join(exact, "id", "left").join(by_stem, "id", "left")
    loose = F.coalesce("_listed", F.when(F.col("_n") == 1, F.col("_any")))
    return joined.withColumn("path", F.coalesce("_exact", F.when(~F.col("id").rlike(r"\.[^.]*$"), loose))).drop("_exact", "_any", "_listed", "_n")


def zip_by_position(left: DataFrame, right: DataFrame, left_order: str, right_order: str, fill: dict | None = None) -> DataFrame:
    """Rows of equal position, for importing tables that were stored without keys; the rest of ``left`` gets ``fill``."""
    a, b = global_rank(left, left_order, name="_pos"), global_rank(right, right_order, name="_pos")
    return a.join(b, "_pos", "left").na.fill(fill or {}).drop("_pos")


def remove_overlap(train: DataFrame, held_out: DataFrame, key: Column, held_key: Column) -> DataFrame:
    """Training rows whose normalised key isn't in the held-out set."""
    return train.withColumn("_k", key).join(held_out.select(held_key.alias("_k")).distinct(), "_k", "left_anti").drop("_k")


def completeness(expected: DataFrame, present: DataFrame, on: str = "id") -> DataFrame:
    """Each id with ``status``: ok, missing or unexpected."""
    e, p = expected.select(on).distinct().withColumn("_e", F.lit(1)), present.select(on).distinct().withColumn("_p", F.lit(1))
    status = F.when(F.col("_e").isNull(), "unexpected").when(F.col("_p").isNull(), "missing").otherwise("ok")
    return e.join(p, on, "full_outer").select(on, status.alias("status"))


def checksum_audit(files: DataFrame, registry: DataFrame, content: str = "content") -> DataFrame:
    """id, ok: whether a file's MD5 is the registered one; null where it isn't registered."""
    return files.select("id", F.md5(F.col(content).cast("binary")).alias("actual")).join(registry.select("id", "md5"), "id", "left").select("id", (F.col("actual") == F.col("md5")).alias("ok"))


def split_overlap(splits: dict[str, DataFrame], on: str = "id") -> DataFrame:
    """a, b, shared: the number of ids that each two splits share. One pass: ids with the set of their splits."""
    every = reduce(DataFrame.unionByName, [df.select(F.col(on).alias("_id"), F.lit(name).alias("_s")) for name, df in splits.items()])
    sets = every.groupBy("_id").agg(F.collect_set("_s").alias("s")).filter(F.size("s") > 1)
    names = sorted(splits)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    counts = sets.agg(*[F.count_if(F.array_contains("s", a) & F.array_contains("s", b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{i}`").alias("shared")) for i, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")
