"""Segmented scans: a hot key in many chunks gives what one window gives, and spreads over tasks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clipyard.operators import clips as C
from clipyard.operators import runs as U
from clipyard.operators.scan import chunked

SIZE = 40


@pytest.fixture(scope="module")
def log(spark):
    """A hot run, small ones, a null one; repeated and null values, odd extra columns."""
    r = random.Random(1)
    rows = []
    for run, n in (("hot", 3000), ("small", 5), ("one", 1), (None, 300)):
        t = 0.0
        for i in range(n):
            t += r.choice([0.5, 1.0, 2.0])
            rows.append((run, i * 3, r.choice([None, *[r.randrange(400) / 4] * 4]), t, r.random() < 0.8, 7))
    r.shuffle(rows)
    return spark.createDataFrame(rows, "run string, it long, value double, t double, bad boolean, `x.y` int").repartition(6)


def rows(df):
    return sorted((tuple(None if v is None else round(v, 7) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def test_chunks_follow_the_order(log):
    cut = chunked(log, ["run"], "it", SIZE).groupBy("run", "_chunk").agg(F.count(F.lit(1)).alias("n"), F.min("it").alias("a"), F.max("it").alias("b")).collect()
    hot = sorted((r for r in cut if r["run"] == "hot"), key=lambda r: r["_chunk"])
    assert len(hot) > 30 and max(r["n"] for r in hot) < 5 * SIZE
    assert all(x["b"] < y["a"] for x, y in zip(hot, hot[1:], strict=False))
    assert len([r for r in cut if r["run"] in ("small", "one")]) == 2 and len([r for r in cut if r["run"] is None]) > 3


def test_running_values_are_the_windows(log):
    w = Window.partitionBy("run").orderBy("it")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    least = F.min("value").over(before)
    assert rows(U.running_best(log, "run", "it", "value", SIZE)) == rows(log.withColumn("best", least.isNull() | (F.col("value") < least)))
    assert rows(U.running_mean(log, "run", "it", "value", SIZE)) == rows(log.withColumn("running_mean", F.avg("value").over(upto)))
    for n in (1, 4, 25):
        for share in (0.8, 0.99):
            bad = F.pmod(F.xxhash64("it"), F.lit(1000)) < int(share * 1000)
            island = log.withColumn("g", F.sum((~bad).cast("int")).over(upto))
            streak = F.sum(bad.cast("int")).over(Window.partitionBy("run", "g").orderBy("it").rowsBetween(Window.unboundedPreceding, 0))
            want = island.withColumn("streak", streak).filter(bad & (F.col("streak") == n)).drop("g")
            assert rows(U.nan_streaks(log, "run", "it", bad, n, SIZE)) == rows(want)


def test_streaks_longer_than_chunks(spark):
    df = spark.range(2000).select(F.lit("a").alias("run"), F.col("id").alias("it"), (F.col("id") % 700 != 0).alias("bad"))
    got = U.nan_streaks(df, "run", "it", F.col("bad"), 500, 20).select("it").collect()
    assert sorted(r["it"] for r in got) == [500, 1200, 1900]


def test_interval_averages_are_the_recursion(log):
    got = {r["run"]: r for r in U.interval_ema(log, "run", F.col("t"), 0.7, 100, 2, SIZE).collect()}
    means = {(r["run"], r["log"]): (r["updates"], r["mean"]) for r in U.interval_means(log, "run", F.col("t"), 7, 2, SIZE).collect()}
    times = {}
    for r in log.collect():
        times.setdefault(r["run"], []).append(r["t"])
    assert "one" not in got and len(got) == 3
    for run, ts in times.items():
        ts.sort()
        ema, x = None, [b - a for a, b in zip(ts, ts[1:], strict=False)]
        for i, v in enumerate(x):
            ema = v if i < 2 else 0.7 * ema + 0.3 * v
        if x:
            assert got[run]["updates"] == len(x) and abs(got[run]["ema"] - ema) < 1e-9 and abs(got[run]["mean_interval"] - sum(x) / len(x)) < 1e-9
            assert abs(got[run]["remaining"] - (100 - len(x)) * ema / 2) < 1e-6
        for g in range(0, len(x), 7):
            part = x[g : g + 7]
            assert means[run, g // 7] == (len(part), pytest.approx(sum(part) / len(part) / 2))


def test_interval_at_a_chunk_border_by_hand(spark):
    """Chunks of about one row: every interval crosses a border."""
    df = spark.createDataFrame([("a", float(t)) for t in (0, 2, 5, 6, 10)], "run string, t double")
    got = U.interval_ema(df, "run", F.col("t"), 0.5, 10, 1, 1).first()
    assert got["updates"] == 4 and got["ema"] == 0.5 * (0.5 * 3 + 0.5 * 1) + 0.5 * 4


def test_timed_sections(spark):
    kinds = [("a", 1.0, "start"), ("a", 3.0, "end"), ("a", 3.0, "start"), ("a", 4.0, "start"), ("a", 9.0, "end"), ("a", 10.0, "end"), ("b", 1.0, "end"), ("b", 2.0, "start"), ("b", None, "end")]
    df = spark.createDataFrame(kinds, "run string, t double, kind string")
    for size in (1, 1000):
        assert rows(U.timed_sections(df, "run", F.col("t"), "kind", size)) == [("a", 1.0, 2.0), ("a", 4.0, 5.0)]


def test_as_of_joins_over_chunks(spark, log):
    frames = log.select("run", F.col("t").alias("time"), "it")
    ticks = spark.range(0, 4000).select(F.lit("hot").alias("run"), (F.col("id") * 1.3).alias("tick_time"))
    got = C.resample_clock(frames, ticks, "run", "time", "it", SIZE)
    one = C.resample_clock(frames, ticks, "run", "time", "it")
    assert rows(got) == rows(one)
    hot = sorted((r["time"], r["it"]) for r in frames.filter("run = 'hot'").collect())
    want = {x: next(((t, i) for t, i in hot if t >= x), None) for x in (r["tick_time"] for r in ticks.collect())}
    assert {r["tick_time"]: (r["frame_time"], r["it"]) for r in got.collect()} == {k: v for k, v in want.items() if v}
    sparse = log.filter("run = 'hot' AND it % 600 = 0 OR run = 'small'").select("run", F.col("it").alias("idx"))
    wanted = log.select("run", (F.col("it") + 1).alias("idx")).filter("run IS NOT NULL")
    assert rows(C.nearest_frame(wanted, sparse, "run", size=SIZE)) == rows(C.nearest_frame(wanted, sparse, "run"))
    far = [r for r in C.nearest_frame(wanted, sparse, "run", size=SIZE).collect() if r["run"] == "hot"]
    at = [r["idx"] for r in sparse.filter("run = 'hot'").collect()]
    assert all(r["frame_idx"] == min(at, key=lambda a: (abs(a - r["idx"]), a)) for r in far) and len(far) == 3000


def test_one_run_spreads_over_tasks(spark):
    """Five million rows of one run: no task has more than a quarter of them."""
    df = spark.range(5_000_000).select(F.lit("a").alias("run"), F.col("id").alias("it"), (F.col("id") % 1000).cast("double").alias("value"))
    out = U.running_mean(df, "run", "it", "value", 100_000).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("running_mean").alias("s"))
    held = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        n = [r["n"] for r in out.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(n) == 5_000_000 and len(n) >= 8 and max(n) < 1_250_000
