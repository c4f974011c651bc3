"""A folder for tables that a job writes and reads again: the cluster's shared one; a temporary one only where unset and local."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``. Raises where that is unset and Spark isn't local: executors share no other folder."""
    app = spark.sparkContext.applicationId
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {spark.sparkContext.master})")
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="spark-")
        base = f"file://{_LOCAL[app]}"
    return f"{base.rstrip('/')}/{app}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new scratch path and read again: cuts lineage, is not computed twice, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``staged`` gave and that nothing reads any more."""
    for df in tables:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
