"""Shared helpers of the training-data operators: staged tables, held-out splits, bounded memos."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that normalisation and word splitting use.
SPACES = "[ \\t-\\r]+"

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``); a temporary one only where unset and Spark is local."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="spark-")
    return f"file://{_LOCAL[app]}"


#: While a table is staged: its write's shuffle files go when it has ended, and workers get rows of whole texts in small batches.
STAGING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors.

    The shuffle files of the write go when it has ended: only the written table is read from then on.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    before = {k: spark.conf.get(k, None) for k in STAGING}
    for k, v in STAGING.items():
        spark.conf.set(k, v)
    try:
        writer.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``staged`` returned and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def gives_back(run: Callable) -> Callable:
    """The Arrow function ``run``, after which a worker returns its free memory: workers live on for later stages."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


def all_columns(df: DataFrame) -> list[Column]:
    """Every column by its exact name, dots and backticks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def chunks_by_bytes(texts: list[str], limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts hold about ``limit`` bytes of UTF-8, one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass"))
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


class Memo(dict):
    """unit -> value, filled in batches by ``compute``. Holds the units of late batches: two generations of ``limit``."""

    def __init__(self, compute: Callable[[list], Iterable], limit: int = 250_000):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def fill(self, lists: Iterable[list]) -> None:
        need = set().union(*lists)
        if len(self) + len(need - self.keys()) > self.limit:
            self.old = dict(self)
            self.clear()
        new = []
        for unit in need - self.keys():
            if unit in self.old:
                self[unit] = self.old[unit]
            else:
                new.append(unit)
        if new:
            self.update(zip(new, self.compute(new), strict=True))


#: White space beyond the space and the line feed: ASCII, then the rest.
_ASCII_WS = "\t\v\f\r\x1c\x1d\x1e\x1f"
_OTHER_WS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def _plain(text: str) -> bool:
    """White space is single spaces and line feeds between visible characters."""
    if any(c in text for c in _ASCII_WS) or not text.isascii() and _OTHER_WS.search(text):
        return False
    return text.count(" ") + text.count("\n") + 1 == len(text.split())


def space_units(text: str) -> list[str]:
    """Cut before each single space that stands between two characters which aren't white space.

    No byte-level BPE pre-token crosses such a place: the text's tokens are those of the units in turn.
    """
    if not text:
        return []
    first, *rest = text.split(" ") if _plain(text) else _SAFE.split(text)
    return [first, *[" " + x for x in rest]]


def heaviest(df: DataFrame, weight: str, limit: int) -> DataFrame:
    """The rows of largest ``weight`` (a positive count), at most ``limit``: whole classes of a logarithmic histogram.

    The histogram has under a thousand rows at any size of ``df``.
    """
    cls = F.floor(F.log(F.col(weight).cast("double")) * 20)
    seen, least = 0, None
    for r in sorted(df.groupBy(cls.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["c"]):
        seen += r["n"]
        if seen > limit:
            break
        least = r["c"]
    return df.filter(F.lit(False)) if least is None else df.filter(cls >= F.lit(least))
