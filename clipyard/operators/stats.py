"""Statistics and health of feature tables, and aggregated metrics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, staged

def latent_stats(df: DataFrame, col: str) -> DataFrame:
    """channel, mean, std (unbiased) over all samples and times of an array<array> column; one row a channel."""
    rows = df.select(F.explode(col).alias("_t")).select(F.posexplode("_t").alias("channel", "_v"))
    v = F.col("_v").cast("double")
    return rows.groupBy("channel").agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))


def stats_arrays(stats: DataFrame) -> DataFrame:
    """One row with ``mu`` and ``sigma`` arrays by channel."""
    row = F.array_sort(F.collect_list(F.struct("channel", "mean", "std")))  # one element a channel
    return stats.agg(row.alias("s")).select(F.col("s.mean").alias("mu"), F.col("s.std").alias("sigma"))


def normalize(df: DataFrame, col: str, stats: DataFrame) -> DataFrame:
    """(x - mean) / std by channel; null where the std is zero."""
    both = df.crossJoin(F.broadcast(stats_arrays(stats)))  # one row
    return both.withColumn(col, F.transform(col, lambda t: F.zip_with(F.zip_with(t, "mu", lambda x, m: x.cast("double") - m), "sigma", lambda x, s: F.try_divide(x, s)))).drop("mu", "sigma")


def unnormalize(df: DataFrame, col: str, stats: DataFrame) -> DataFrame:
    """x * std + mean by channel."""
    both = df.crossJoin(F.broadcast(stats_arrays(stats)))  # one row
    return both.withColumn(col, F.transform(col, lambda t: F.zip_with(F.zip_with(t, "sigma", lambda x, s: x.cast("double") * s), "mu", lambda x, m: x + m))).drop("mu", "sigma")


def duplicate_audit(df: DataFrame, key: str) -> DataFrame:
    """rows, distinct_ids, duplicates; null keys count as one."""
    ids = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    out = ids.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_ids"))
    return out.withColumn("duplicates", F.col("rows") - F.col("distinct_ids"))


def feature_health(df: DataFrame, cols: list[str]) -> DataFrame:
    """feature, nan_rows, inf_rows, null_rows of array columns, in one pass."""
    d = lambda x: x.cast("double")
    rows = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.exists(c, lambda x: F.isnan(d(x))).alias("nan"), F.exists(c, lambda x: F.abs(d(x)) == F.lit(float("inf"))).alias("inf"), F.col(c).isNull().alias("none")) for c in cols
    ])).alias("x")).select("x.*")
    return rows.groupBy("feature").agg(F.count_if("nan").alias("nan_rows"), F.count_if("inf").alias("inf_rows"), F.count_if("none").alias("null_rows"))


def shape_profile(df: DataFrame, col: str, expected: tuple[int, int]) -> DataFrame:
    """t, d, rows, ok for each distinct shape of an array<array> column."""
    shape = df.select(F.size(col).alias("t"), F.coalesce(F.size(F.try_element_at(col, F.lit(1))), F.lit(0)).alias("d"))
    return shape.groupBy("t", "d").agg(F.count(F.lit(1)).alias("rows")).withColumn("ok", (F.col("t") == expected[0]) & (F.col("d") == expected[1]))


def store_size(inventory: DataFrame, suspicious: int = 1 << 20) -> DataFrame:
    """ext, files, total_mb, suspicious: files of that many bytes at most."""
    return inventory.groupBy("ext").agg(F.count(F.lit(1)).alias("files"), (F.sum("length") / F.lit(float(1 << 20))).alias("total_mb"), F.count_if(F.col("length") <= suspicious).alias("suspicious"))


def batch_range(names: DataFrame, name: str) -> DataFrame:
    """rank, first_batch, last_batch, files from shard names ``r<rank>_<batch>``; other names are left out."""
    part = lambda i: F.regexp_extract(name, r"r(\d+)_(\d+)", i).try_cast("long")
    rows = names.select(part(1).alias("rank"), part(2).alias("batch")).filter("batch IS NOT NULL")
    return rows.groupBy("rank").agg(F.min("batch").alias("first_batch"), F.max("batch").alias("last_batch"), F.count(F.lit(1)).alias("files"))


def integrate(df: DataFrame, key: str, rank: str, value: str) -> DataFrame:
    """The unweighted mean of the ranks' means, by key."""
    return df.groupBy(key, rank).agg(F.avg(value).alias("_m")).groupBy(key).agg(F.avg("_m").alias("mean"))


def binned_mean(df: DataFrame, value: str, t: Column, bins: int = 25) -> DataFrame:
    """bin, mean, n of values by t in [0, 1]; t = 1 belongs to the last bin."""
    b = F.least(F.floor(t * F.lit(bins)), F.lit(bins - 1)).cast("long")
    return df.withColumn("bin", b).filter("bin >= 0").groupBy("bin").agg((F.sum(value) / F.count(value)).alias("mean"), F.count(value).alias("n"))


def macro_scores(per_file: DataFrame, files: DataFrame, metrics: list[str], on: str = "file") -> DataFrame:
    """Means over all files; a file without scores counts as zero."""
    joined = files.select(on).distinct().join(per_file, on, "left")
    return joined.agg(*[F.avg(F.coalesce(F.col(m).cast("double"), F.lit(0.0))).alias(m) for m in metrics], F.count(F.lit(1)).alias("files"))


def weighted_loss(df: DataFrame, loss: str, n: str) -> DataFrame:
    return df.agg(F.try_divide(F.sum(F.col(loss) * F.col(n)), F.sum(n)).alias("loss"))


def outcome_counts(df: DataFrame, status: Column) -> DataFrame:
    """processed, skipped, failed."""
    return df.agg(*[F.count_if(status == s).alias(s) for s in ("processed", "skipped", "failed")])


def mismatch_rate(a: DataFrame, b: DataFrame, on: str, left: Column, right: Column, source: str) -> DataFrame:
    """source, rows, mismatched, rate of rows whose two values differ (nulls compare as equal to nulls)."""
    joined = a.join(b, on).withColumn("_bad", ~left.eqNullSafe(right))
    return joined.groupBy(source).agg(F.count(F.lit(1)).alias("rows"), F.count_if("_bad").alias("mismatched")).withColumn("rate", F.col("mismatched") / F.col("rows"))


def with_hooks(agg: DataFrame, hooks: dict[str, Column]) -> DataFrame:
    """Derived metrics computed from the aggregated ones, before they go out."""
    return agg.withColumns(hooks)


def caption_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent captions, ties in order of the caption."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col).limit(k)


def _merged(x: tuple, y: tuple) -> tuple:
    """Count, mean and centred cross products of two parts together."""
    (n, m, c), (k, q, d) = x, y
    if not n or not k:
        return y if not n else x
    gap = q - m
    return n + k, m + gap * (k / (n + k)), c + d + np.outer(gap, gap) * (n * k / (n + k))


def _to_row(n: int, mean: np.ndarray, c: np.ndarray) -> dict:
    return {"n": n, "mean": mean.tobytes(), "products": c[np.triu_indices(len(c))].tobytes()}


def _from_row(n: int, mean: bytes, products: bytes) -> tuple:
    m = np.frombuffer(mean)
    c = np.zeros((len(m), len(m)))
    at = np.triu_indices(len(m))
    c[at] = np.frombuffer(products)
    c.T[at] = c[at]
    return n, m, c


_MOMENTS = "part long, n long, mean binary, products binary"


def centred_moments(df: DataFrame, col: str, dim: int, fan_in: int = 16) -> tuple:
    """(n, mean, sums of centred cross products) of vectors of ``dim`` components; others are left out.

    A task gives one row: its count, mean and products around its own mean, as the packed triangle. Rows are merged
    ``fan_in`` at a time until one is left; means far from zero cancel nothing.
    """
    schema = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("mean", pa.binary()), ("products", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = (0, np.zeros(dim), np.zeros((dim, dim)))
        for batch in batches:
            x = np.array([v for v in batch.column(0).to_pylist() if v is not None and len(v) == dim], float).reshape(-1, dim)
            if len(x):
                mean = x.mean(axis=0)
                total = _merged(total, (len(x), mean, (x - mean).T @ (x - mean)))
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), **_to_row(*total)}], schema)

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        total = (0, np.zeros(dim), np.zeros((dim, dim)))
        for r in rows:
            total = _merged(total, _from_row(r["n"], r["mean"], r["products"]))
        return pa.Table.from_pylist([{"part": min(r["part"] for r in rows) // fan_in, **_to_row(*total)}], schema)

    parts = staged(df.select(col).mapInArrow(run, _MOMENTS), "moments")
    while parts.count() > 1:
        before, parts = parts, staged(parts.groupBy(F.floor(F.col("part") / fan_in)).applyInArrow(merge, _MOMENTS), "moments")
        discard(before)
    row = parts.first()
    discard(parts)
    return _from_row(row["n"], row["mean"], row["products"]) if row else (0, np.zeros(dim), np.zeros((dim, dim)))


def moments(df: DataFrame, col: str, dim: int) -> DataFrame:
    """i, j, n, sx, sxx of vectors: row (i, j) holds the sum of x_i x_j, and on i = j the sum of x_i. From ``centred_moments``."""
    n, mean, c = centred_moments(df, col, dim)
    i, j = np.meshgrid(range(dim), range(dim), indexing="ij")
    sums = pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": n, "sx": np.where(i == j, n * mean[:, None], 0).ravel(), "sxx": (c + n * np.outer(mean, mean)).ravel()})
    return df.sparkSession.createDataFrame(sums, "i long, j long, n long, sx double, sxx double")


def compare_embeddings(pred: DataFrame, truth: DataFrame, col: str, dim: int) -> dict[str, float]:
    """Set-level scores: the Fréchet distance of the two Gaussians and the distance of the means.

    Only the moments, of dim x dim size, reach the driver.
    """
    (n1, m1, c1), (n2, m2, c2) = centred_moments(pred, col, dim), centred_moments(truth, col, dim)
    c1, c2 = c1 / max(n1 - 1, 1), c2 / max(n2 - 1, 1)
    w, u = np.linalg.eigh(c1)
    root = (u * np.sqrt(np.maximum(w, 0))) @ u.T
    cross = np.sqrt(np.maximum(np.linalg.eigvalsh(root @ c2 @ root), 0)).sum()
    gap = float(((m1 - m2) ** 2).sum())
    return {"frechet": gap + float(np.trace(c1) + np.trace(c2) - 2 * cross), "mean_gap": gap**0.5}
