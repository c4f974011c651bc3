"""Writers of manifests, features, reports and metric logs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_manifest(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, escape='"', quote='"')


def write_features(df: DataFrame, path: str, split: str | None = "split") -> None:
    writer = df.write
    if split and split in df.columns:
        writer = writer.partitionBy(split)
    writer.parquet(path)


def run_report(ok: DataFrame, bad: DataFrame, shapes: dict[str, Column], expected: dict[str, int]) -> DataFrame:
    """One row: dataset_size, written, failed, num_failed_batches, first_shapes (those of the smallest id), expected_shapes.

    ``bad`` has the failed items with their ``batch``; the list of failed batches is ``failed_batches``.
    """
    first = F.min_by(F.create_map(*[x for name, size in shapes.items() for x in (F.lit(name), size.cast("long"))]), "id")
    good = ok.agg(F.count(F.lit(1)).alias("written"), first.alias("first_shapes"))
    lost = bad.agg(F.count(F.lit(1)).alias("failed"), F.count_distinct("batch").alias("num_failed_batches"))
    wanted = F.create_map(*[x for name, size in expected.items() for x in (F.lit(name), F.lit(size).cast("long"))])
    return good.crossJoin(lost).select((F.col("written") + F.col("failed")).alias("dataset_size"), "written", "failed", "num_failed_batches", "first_shapes", wanted.alias("expected_shapes"))  # one row each


def failed_batches(bad: DataFrame) -> DataFrame:
    """batch, failed, error: how many items of each batch failed, and the error of the one with the smallest id."""
    return bad.groupBy("batch").agg(F.count(F.lit(1)).alias("failed"), F.min_by("error", "id").alias("error"))


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def format_metrics(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Metrics as text with four decimals."""
    return df.select(*[F.format_string("%.4f", F.col(m).cast("double")).alias(m) if m in metrics else F.col(m) for m in df.columns])


def append_metrics(df: DataFrame, path: str) -> None:
    """Long format: run, tag, it, value, one row a measurement."""
    df.select("run", "tag", "it", "value").write.mode("append").parquet(path)


def split_errors(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(ok, bad with ``error``): rows by whether the expression gives a reason."""
    with_reason = df.withColumn("error", reason)
    return with_reason.filter("error IS NULL").drop("error"), with_reason.filter("error IS NOT NULL")


def guarded(df: DataFrame, work: Callable[[pd.Series], dict], schema: str) -> DataFrame:
    """Each row through ``work``; a row that raises keeps its input columns and gets its error text, the rest go on."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            new: dict[str, list] = {n: [] for n in (*names, "error")}
            for row in batch.to_dict("records"):
                try:
                    got = {**work(row), "error": None}
                except Exception as e:  # noqa: BLE001  any failure of one item is its own
                    got = {"error": f"{type(e).__name__}: {e}"}
                for n, values in new.items():
                    values.append(got.get(n))
            yield batch.assign(**{n: pd.Series(v, dtype=object, index=batch.index).convert_dtypes() for n, v in new.items()})

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{own}, {schema}, error string")
