"""Clips, frame clocks and sequence plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import subclip_id
from .scan import carried, chunked


def partition_clips(df: DataFrame, id_col: str, samples: str, rate: int, min_sec: float = 8.1, max_n: int = 5) -> DataFrame:
    """id, name, start_sample, end_sample of up to ``max_n`` evenly spread clips; shorter recordings give none."""
    seg = int(rate * min_sec)
    total = F.col(samples).cast("long")
    fit = df.filter(total >= F.lit(rate * min_sec)).withColumn("_n", F.least(F.lit(max_n).cast("long"), F.expr(f"cast(`{samples}` as bigint) div {seg}")))
    step = F.when(F.col("_n") > 1, F.expr(f"(cast(`{samples}` as bigint) - {seg}) div (_n - 1)")).otherwise(F.lit(0))
    rows = fit.withColumn("_step", step).select(F.col(id_col).cast("string").alias("name"), "_step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_i"))
    start = F.col("_i") * F.col("_step")
    return rows.select(subclip_id(F.col("name"), F.col("_i")).alias("id"), "name", start.alias("start_sample"), (start + seg).alias("end_sample"))


def frame_segments(df: DataFrame, id_col: str, frames_total: Column, fps: Column, frames: int = 240) -> DataFrame:
    """id, segment (%03d), start_frame, start_sec, seconds: whole segments of so many frames."""
    rows = df.select(F.col(id_col).alias("id"), frames_total.cast("long").alias("_t"), fps.alias("_fps")).withColumn("_n", F.expr(f"_t div {frames}")).filter("_n > 0")
    rows = rows.select("id", "_fps", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_i"))
    start = F.col("_i") * frames
    return rows.select("id", F.format_string("%03d", F.col("_i")).alias("segment"), start.alias("start_frame"), (start / F.col("_fps")).alias("start_sec"), (F.lit(float(frames)) / F.col("_fps")).alias("seconds"))


def sequence_plan(df: DataFrame, duration: Column, variants: dict[str, tuple[int, int]]) -> DataFrame:
    """Each row with each variant's (rate, hop): latent_len, clip_len, sync_len, audio_frames for its duration."""
    table = F.explode(F.array(*[F.struct(F.lit(n).alias("variant"), F.lit(r).alias("rate"), F.lit(h).alias("hop")) for n, (r, h) in variants.items()]))
    rows = df.withColumn("_d", duration.cast("double")).withColumn("_v", table).select("*", "_v.*").drop("_v")
    latent = F.ceil(F.col("_d") * F.col("rate") / F.col("hop") / 2).cast("long")
    return rows.withColumn("latent_len", latent).withColumn("clip_len", F.floor(F.col("_d") * 8).cast("long")).withColumn("sync_len", F.lit(192).cast("long")).withColumn("audio_frames", F.col("latent_len") * F.col("hop") * 2).drop("rate", "hop", "_d")


def clamp_duration(df: DataFrame, duration: float, clip_frames: Column, sync_frames: Column, clip_fps: int = 8, sync_fps: int = 25) -> DataFrame:
    """``duration`` that both frame counts cover, and how many frames of each it takes."""
    d = F.least(F.lit(duration), clip_frames.cast("double") / clip_fps, sync_frames.cast("double") / sync_fps)
    return df.withColumn("duration", d).withColumn("clip_n", F.floor(F.col("duration") * clip_fps).cast("long")).withColumn("sync_n", F.floor(F.col("duration") * sync_fps).cast("long"))


def resample_clock(frames: DataFrame, ticks: DataFrame, key: str, time: str, value: str, size: int = 1_000_000) -> DataFrame:
    """Each tick (key, tick_time) with the first frame at or after it; ticks beyond the last frame are left out.

    A forward as-of join: ticks and frames in one ordered window, so each key is sorted once and nothing is paired. A
    long key is cut into chunks (``scan``); a chunk without a frame after a tick is given the next chunks' first one.
    """
    f = frames.select(key, F.col(time).alias("_t"), F.lit(1).alias("_kind"), F.struct(F.col(time).alias("frame_time"), F.col(value).alias(value)).alias("_f"))
    t = ticks.select(key, F.col("tick_time").alias("_t"), F.lit(0).alias("_kind"), F.lit(None).cast(f.schema["_f"].dataType).alias("_f"))
    rows = chunked(f.unionByName(t), [key], "_t", size)
    first = F.min_by("_f", F.when(F.col("_kind") == 1, F.col("_t")))
    rows = carried(rows, [key], {"_first": first}, {"_ahead": lambda before, after: F.last("_first", ignorenulls=True).over(after)})
    # From the end to the start: a frame that grows keeps its value, one that shrinks would be read anew for every row.
    w = Window.partitionBy(key, "_chunk").orderBy(F.desc("_t"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = rows.withColumn("_next", F.coalesce(F.last("_f", ignorenulls=True).over(w), F.col("_ahead"))).filter("_kind = 0 AND _next IS NOT NULL")
    return got.select(key, F.col("_t").alias("tick_time"), "_next.*")


def clock_ticks(df: DataFrame, key: str, fps: float, duration: Column) -> DataFrame:
    """Ticks k / fps of each key below its duration."""
    n = F.ceil(duration * F.lit(fps)).cast("long")
    return df.withColumn("_n", n).filter("_n > 0").select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("k")).withColumn("tick_time", F.col("k") / F.lit(fps))


def nearest_frame(wanted: DataFrame, frames: DataFrame, key: str, idx: str = "idx", size: int = 1_000_000) -> DataFrame:
    """Each wanted index with the nearest available one, the lower of two equally near; null without frames.

    A two-sided as-of join over one ordered window a chunk of a key; chunks are given the nearest frames of the others.
    """
    f = frames.select(key, F.col(idx).alias("_i"), F.lit(0).alias("_kind"))
    q = wanted.select(key, F.col(idx).alias("_i"), F.lit(1).alias("_kind"))
    own = F.when(F.col("_kind") == 0, F.col("_i"))
    ends = {"_low": F.min(own), "_high": F.max(own)}
    rows = carried(chunked(f.unionByName(q), [key], "_i", size), [key], ends, {"_back": lambda before, after: F.max("_high").over(before), "_ahead": lambda before, after: F.min("_low").over(after)})
    # Each way with a frame that grows: one that shrinks would be read anew for every row.
    last = lambda *order: F.last(own, ignorenulls=True).over(Window.partitionBy(key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    got = rows.withColumn("_p", F.coalesce(last("_i", "_kind"), F.col("_back"))).withColumn("_n", F.coalesce(last(F.desc("_i"), "_kind"), F.col("_ahead"))).filter("_kind = 1")
    near = F.when(F.col("_p").isNull(), F.col("_n")).when(F.col("_n").isNull(), F.col("_p")).when(F.col("_i") - F.col("_p") <= F.col("_n") - F.col("_i"), F.col("_p")).otherwise(F.col("_n"))
    return got.select(key, F.col("_i").alias(idx), near.alias("frame_idx"))


def require_samples(df: DataFrame, wave: str, n: int) -> DataFrame:
    """Rows whose wave has ``n`` samples or more, cut to the first ``n``."""
    return df.filter(F.size(wave) >= n).withColumn(wave, F.slice(wave, 1, n))
