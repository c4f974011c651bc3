"""State that expires, first rows of ids, and reports that are written anew after every micro-batch."""

from pyspark.sql import functions as F

from clipyard.sources.scratch import scratch_path
from clipyard.streaming import streams as T


def drained(spark, batches, schema, build, mode):
    """What a stream over so many micro-batches gives, with the number of each."""
    src, out = scratch_path(spark, "stream-in"), []
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    with T.state_store(spark):
        q = build(stream).writeStream.outputMode(mode).foreachBatch(lambda df, i: out.extend((i, *r) for r in df.collect())).option("checkpointLocation", scratch_path(spark, "stream-state")).trigger(availableNow=True).start()
        q.awaitTermination()
    return out


def test_an_idle_runs_state_expires(spark):
    """A streak of two, hours of other rows, then one bad value more: the streak is three only while the state lives."""
    rows = lambda run, its, hour, bad=True: [(run, "loss", i, bad, f"2024-01-01 {hour:02d}:00:{i % 60:02d}") for i in its]
    fix = lambda b: [(r, t, i, x, __import__("datetime").datetime.fromisoformat(ts)) for r, t, i, x, ts in b]
    batches = [fix(rows("a", [1, 2], 0)), fix(rows("b", [1], 8, False)), fix(rows("b", [2], 16, False)), fix(rows("a", [3], 17))]
    schema = "run string, tag string, it long, bad boolean, ts timestamp"
    for idle, want in (("1 hour", []), ("2 days", [("a", "loss", 3)])):
        got = drained(spark, batches, schema, lambda s, idle=idle: T.stream_nan_alert(s, 3, "1 minute", idle), "append")
        assert [r[1:] for r in got] == want


def test_eta_starts_anew_after_expiry(spark):
    at = lambda s: __import__("datetime").datetime.fromtimestamp(s, __import__("datetime").UTC)
    batches = [[("a", float(s), at(s)) for s in (1000, 1010, 1030)], [("b", 50_000.0, at(50_000))], [("b", 90_000.0, at(90_000))], [("a", 90_001.0, at(90_001)), ("a", 90_005.0, at(90_005))]]
    for idle, want in (("1 hour", (1, 4.0)), ("9 days", (4, None))):
        got = drained(spark, batches, "run string, seconds double, ts timestamp", lambda s, idle=idle: T.stream_eta(s, 0.5, 10, 1, "1 minute", idle), "update")
        last = [r for r in got if r[1] == "a"][-1]
        assert last[2] == want[0] and (want[1] is None or last[3] == want[1])


def test_the_first_row_of_an_id_stays_whole(spark):
    at = lambda s: __import__("datetime").datetime.fromtimestamp(s, __import__("datetime").UTC)
    batches = [[("a", at(5), "second"), ("a", at(3), "first"), ("b", at(4), "only")], [("a", at(1), "late"), ("c", at(9), None)]]
    got = drained(spark, batches, "id string, ts timestamp, what string", lambda s: T.stream_manifest(s, "1 hour"), "append")
    assert sorted((r[1], r[3]) for r in got) == [("a", "first"), ("b", "only"), ("c", None)]


def test_keys_share_buckets_and_expire_apart(spark):
    """Streaks of many keys, some of them null, over three micro-batches and as few groups: as told key by key."""
    import datetime
    import random

    rng, at = random.Random(5), lambda h, s: datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(hours=h, seconds=s)
    keys = [(None if k == 0 else k, None if k % 7 == 3 else f"t{k % 3}") for k in range(60)]
    batches, want, streak = [], [], dict.fromkeys(keys, 0)
    for b in range(3):
        rows = [(*k, 100 * b + i, rng.choice([True, True, True, False, None]), at(b, i)) for k in keys if rng.random() < 0.8 for i in range(rng.randrange(1, 12))]
        for run, tag, it, bad, _ in rows:
            streak[run, tag] = streak[run, tag] + 1 if bad else 0
            want += [(run, tag, it)] if streak[run, tag] == 3 else []
        batches.append(rng.sample(rows, len(rows)))
    schema = "run int, tag string, it long, bad boolean, ts timestamp"
    for buckets in (1, 5):
        got = drained(spark, batches, schema, lambda s, buckets=buckets: T.stream_nan_alert(s, 3, "1 minute", "9 days", buckets), "append")
        assert sorted(map(str, (r[1:] for r in got))) == sorted(map(str, want))
    # Of two keys in one bucket the idle one goes, the other's streak goes on.
    batches = [[(1, "x", i, True, at(0, i)) for i in (1, 2)] + [(2, "x", 1, True, at(0, 1))], [(2, "x", 2, True, at(8, 0))], [(3, "x", 1, False, at(9, 0))], [(1, "x", 3, True, at(9, 1)), (2, "x", 3, True, at(9, 1))]]
    got = drained(spark, batches, schema, lambda s: T.stream_nan_alert(s, 3, "1 minute", "4 hours", 1), "append")
    assert [r[1:] for r in got] == [(2, "x", 3)]


def test_reports_after_each_batch_survive_a_repeat(spark):
    src, out = scratch_path(spark, "stream-in"), scratch_path(spark, "reported")
    schema = "id long, n int"
    for b in ([(1, 5), (2, 0), (3, 0)], [(4, 0)], [(5, 7), (6, 8)]):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
    stream, state = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), scratch_path(spark, "state")

    def run():
        T.stream_reported_ingest(stream, F.when(F.col("n") == 0, F.concat(F.lit("empty "), "id")), f"{out}/ok", f"{out}/bad", f"{out}/report", state, {"n": F.col("n")}, {"n": 5}).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(f"{out}/report/reports").select("after", "dataset_size", "written", "failed", "num_failed_batches", F.col("failed_batches.error"), F.col("failed_batches.failed"), "first_shapes.n").collect())

    want = [(0, 3, 1, 2, 1, ["empty 2"], [2], 5), (1, 4, 1, 3, 2, ["empty 2", "empty 4"], [2, 1], 5), (2, 6, 3, 3, 2, ["empty 2", "empty 4"], [2, 1], 5)]
    assert run() == want
    commit = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/commits/2")
    commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)
    assert run() == want and spark.read.parquet(f"{out}/ok").count() == 3
