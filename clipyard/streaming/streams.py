"""Live metric logs and incoming media as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_metric_means(stream: DataFrame, window: str, delay: str = "10 minutes") -> DataFrame:
    """run, tag, start, mean, n over tumbling event-time windows; later rows than the delay are dropped."""
    rows = stream.withWatermark("ts", delay)
    out = rows.groupBy("run", "tag", F.window("ts", window)).agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
    return out.select("run", "tag", F.col("window.start").alias("start"), "mean", "n")


#: Keyed state is kept on disk, not on the heap.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Stateful queries that are started inside keep their state in RocksDB; the session's setting is as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    try:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Groups that the keys of a stateful stream are dealt to by hash.
BUCKETS = 256


class _Expiring:
    """A few numbers of state a key; they go once no row has come for ``idle_ms`` of event time.

    Keys are dealt to buckets by hash, and a bucket's state is a list of keys with one of each number: what a call and a
    frame cost is paid a bucket and micro-batch, not a key. A bucket wakes when its first key expires.
    """

    kinds: dict[str, str] = {}

    def __init__(self, keys: list[str], idle_ms: int):
        self.keys, self.idle_ms = keys, idle_ms

    def rows(self, rows: pd.DataFrame, code: np.ndarray, states: list[tuple | None]) -> tuple[list[tuple], pd.DataFrame]:
        """New states and what comes out, of a bucket's rows of a micro-batch in any order; ``code``: the place of a row's key in ``states``."""
        raise NotImplementedError

    def run(self, key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, now = len(self.keys), state.getCurrentWatermarkMs()
        held = list(zip(*state.get, strict=True)) if state.exists else []
        known = {(*h[:n],): h[n:] for h in held}
        met: dict[tuple, tuple] = {}
        if not state.hasTimedOut:
            got = pd.concat(list(parts), ignore_index=True).drop(columns="_bucket")
            code = got.groupby(self.keys, sort=False, dropna=False).ngroup().to_numpy()
            heads = got[self.keys].iloc[np.unique(code, return_index=True)[1]].astype(object)
            names = [tuple(r) for r in heads.where(heads.notna(), None).itertuples(index=False)]
            old = [known.get(k) for k in names]
            new, out = self.rows(got, code, [o[:-1] if o else None for o in old])
            latest = got["ts"].groupby(code).max()
            for k, s, o, ts in zip(names, new, old, latest, strict=True):
                timer = int(ts.timestamp() * 1000) + self.idle_ms
                met[k] = (*s, max(timer, o[-1]) if o else timer)
            if len(out):
                yield out
        live = {k: v for k, v in known.items() if k not in met and v[-1] > now} | met
        if live:
            state.update(tuple(map(list, zip(*(k + v for k, v in live.items()), strict=True))))
            state.setTimeoutTimestamp(max(min(v[-1] for v in live.values()), now + 1))
        else:
            state.remove()

    def over(self, rows: DataFrame, out: str, mode: str, buckets: int) -> DataFrame:
        """``rows`` (with a watermark on ``ts``) through this state."""
        own = {f.name: f.dataType.simpleString() for f in rows.schema}
        held = {k: own[k] for k in self.keys} | self.kinds | {"timer": "bigint"}
        kinds = ", ".join(f"`{k if k in self.keys else '_' + k}` array<{kind}>" for k, kind in held.items())
        # Null keys stand apart, so that a frame's whole numbers stay whole.
        empty = sum((F.col(k).isNull().cast("long") * (buckets << i) for i, k in enumerate(self.keys)), F.lit(0))
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(buckets)) + empty).groupBy("_bucket").applyInPandasWithState(self.run, out, kinds, mode, GroupStateTimeout.EventTimeTimeout)


class _Streaks(_Expiring):
    kinds = {"streak": "int"}

    def __init__(self, keys: list[str], idle_ms: int, n: int):
        super().__init__(keys, idle_ms)
        self.n = n

    def rows(self, rows: pd.DataFrame, code: np.ndarray, states: list[tuple | None]) -> tuple[list[tuple], pd.DataFrame]:
        order = np.lexsort((rows["it"].to_numpy(), code))
        code, bad = code[order], rows["bad"].eq(True).to_numpy(bool)[order]
        at = np.arange(len(order))
        first = np.searchsorted(code, np.arange(len(states)))[code]
        carried = np.array([s[0] if s else 0 for s in states])[code]
        good = np.maximum.accumulate(np.where(bad, -1, at))  # the last good row up to here
        streak = np.where(bad, np.where(good >= first, at - good, at - first + 1 + carried), 0)
        ends = np.searchsorted(code, np.arange(len(states)), side="right") - 1
        return [(int(s),) for s in streak[ends]], rows.iloc[order[bad & (streak == self.n)]][[*self.keys, "it"]]


class _Eta(_Expiring):
    kinds = {"last": "double", "ema": "double", "n": "bigint"}

    def __init__(self, keys: list[str], idle_ms: int, alpha: float, total: int, step_size: int):
        super().__init__(keys, idle_ms)
        self.alpha, self.total, self.step_size = alpha, total, step_size

    def rows(self, rows: pd.DataFrame, code: np.ndarray, states: list[tuple | None]) -> tuple[list[tuple], pd.DataFrame]:
        times = rows["seconds"].to_numpy(float)
        order = np.lexsort((times, code))
        new = [s or (None, 0.0, 0) for s in states]
        for k, t in zip(code[order].tolist(), times[order].tolist(), strict=True):
            last, ema, n = new[k]
            if last is not None:
                x, n = t - last, n + 1
                ema = x if n <= 2 else self.alpha * ema + (1 - self.alpha) * x
            new[k] = (t, ema, n)
        out = rows[self.keys].iloc[np.unique(code, return_index=True)[1]]
        n, ema = np.array([s[2] for s in new]), np.array([s[1] for s in new])
        return new, out.assign(updates=n, ema=ema, remaining=(self.total - n) * ema / self.step_size)


class _First(_Expiring):
    kinds = {"seen": "boolean"}

    def __init__(self, keys: list[str], idle_ms: int, order: list[str]):
        super().__init__(keys, idle_ms)
        self.order = order

    def rows(self, rows: pd.DataFrame, code: np.ndarray, states: list[tuple | None]) -> tuple[list[tuple], pd.DataFrame]:
        places = rows.sort_values(self.order, kind="stable").index.to_numpy()
        first = places[np.unique(code[places], return_index=True)[1]]
        return [(True,)] * len(states), rows.iloc[first[[s is None for s in states]]]


def _milliseconds(stream: DataFrame, interval: str) -> int:
    """A length of time such as "1 day" in milliseconds."""
    return int(pd.Timedelta(interval).total_seconds() * 1000)


def stream_nan_alert(stream: DataFrame, n: int = 10, delay: str = "10 minutes", idle: str = "7 days", buckets: int = BUCKETS) -> DataFrame:
    """run, tag, it of the rows (run, tag, it, bad, ts) at which a streak of bad values reaches ``n``; a good one resets.

    The state is one number a (run, tag); it goes once the watermark has passed its last row by ``idle``, and a streak that
    goes on later starts anew. Later rows than the delay are dropped. Start it within ``state_store``.
    """
    own = dict(stream.dtypes)
    rows = stream.select("run", "tag", "it", "bad", "ts").withWatermark("ts", delay)
    return _Streaks(["run", "tag"], _milliseconds(stream, idle), n).over(rows, f"run {own['run']}, tag {own['tag']}, it long", "append", buckets)


def stream_eta(stream: DataFrame, alpha: float = 0.7, total: int = 1000, step_size: int = 1, delay: str = "10 minutes", idle: str = "7 days", buckets: int = BUCKETS) -> DataFrame:
    """run, updates, ema, remaining after each micro-batch from rows (run, seconds, ts).

    Only the last time, the average and a count are kept for a run, until the watermark has passed its last row by ``idle``; the first
    interval is discarded, the second seeds. Start it within ``state_store``.
    """
    own = dict(stream.dtypes)
    rows = stream.select("run", "seconds", "ts").withWatermark("ts", delay)
    return _Eta(["run"], _milliseconds(stream, idle), alpha, total, step_size).over(rows, f"run {own['run']}, updates long, ema double, remaining double", "update", buckets)


def stream_manifest(stream: DataFrame, delay: str, id_col: str = "id", ts: str = "ts", order: list[str] | None = None, idle: str = "7 days", buckets: int = BUCKETS) -> DataFrame:
    """The first row of each id, whole: of a micro-batch's rows the least by ``order`` (``ts`` if not given), of micro-batches the first.

    An id is forgotten once the watermark has passed its last row by ``idle``. Start it within ``state_store``.
    """
    rows = stream.withColumnRenamed(ts, "ts") if ts != "ts" else stream
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    by = [c if c != ts else "ts" for c in order or [ts]]
    out = _First([id_col], _milliseconds(stream, idle), by).over(rows.withWatermark("ts", delay), kinds, "append", buckets)
    return out.withColumnRenamed("ts", ts) if ts != "ts" else out


def stream_ingest(stream: DataFrame, reason: Column, ok_path: str, bad_path: str, checkpoint: str) -> Callable:
    """Starts a query that sends each micro-batch's rows to the good or the bad table; a rerun of a batch replaces it."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("error", reason)
        rows.filter("error IS NULL").drop("error").write.mode("overwrite").parquet(f"{ok_path}/batch={batch_id}")
        rows.filter("error IS NOT NULL").write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_reported_ingest(stream: DataFrame, reason: Column, ok_path: str, bad_path: str, report_path: str, checkpoint: str, shapes: dict[str, Column], expected: dict[str, int], id_col: str = "id") -> Callable:
    """``stream_ingest`` with the run's report written anew after every micro-batch.

    Counts and first shapes are observed while the rows are written, so no row is read for them again. A micro-batch's own line
    stands in ``lines/batch=k``, the report over all lines so far in ``reports/batch=k``: one row ``after`` (the batch), dataset_size,
    written, failed, num_failed_batches, failed_batches (batch, failed, the error of the smallest id), first_shapes, expected_shapes.
    A batch that is run again replaces its rows, line and report by the same ones.
    """
    spark = stream.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("error", reason)
        good, lost = Observation(), Observation()
        size = F.struct(*[v.cast("long").alias(k) for k, v in shapes.items()])
        ok = rows.filter("error IS NULL").observe(good, F.count(F.lit(1)).alias("written"), F.min(F.struct(F.col(id_col).alias("id"), size.alias("sizes"))).alias("first"))
        bad = rows.filter("error IS NOT NULL").observe(lost, F.count(F.lit(1)).alias("failed"), F.min(F.struct(F.col(id_col).alias("id"), "error")).alias("first"))
        ok.drop("error").write.mode("overwrite").parquet(f"{ok_path}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        w, f = good.get, lost.get
        line = (batch_id, w["written"], [w["first"]["sizes"][k] for k in shapes] if w["written"] else None, f["failed"], f["first"]["error"] if f["failed"] else None)
        spark.createDataFrame([line], "batch long, written long, sizes array<long>, failed long, error string").write.mode("overwrite").parquet(f"{report_path}/lines/batch={batch_id}")
        lines = spark.read.schema("written long, sizes array<long>, failed long, error string, batch long").parquet(f"{report_path}/lines").filter(F.col("batch") <= batch_id)
        run_summary(lines, list(shapes), expected).withColumn("after", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{report_path}/reports/batch={batch_id}")

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_summary(lines: DataFrame, shapes: list[str], expected: dict[str, int]) -> DataFrame:
    """One row over the lines (batch, written, sizes, failed, error), one a micro-batch."""
    failed = F.when(F.col("failed") > 0, F.struct("batch", "failed", "error"))
    sizes = F.min_by("sizes", F.when(F.col("written") > 0, F.col("batch")))
    out = lines.agg(F.sum("written").alias("written"), F.sum("failed").alias("failed"), F.array_sort(F.collect_list(failed)).alias("failed_batches"), sizes.alias("sizes"))
    first = F.map_from_arrays(F.array(*map(F.lit, shapes)), "sizes")
    wanted = F.create_map(*[x for k, v in expected.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    return out.select((F.col("written") + F.col("failed")).alias("dataset_size"), "written", "failed", F.size("failed_batches").cast("long").alias("num_failed_batches"), "failed_batches", first.alias("first_shapes"), wanted.alias("expected_shapes"))
