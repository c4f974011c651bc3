"""Exact top-k inner-product search over an impact-ordered index, score at a time.

Vectors are integers. A block of them is indexed by dimension: the postings of a dimension (vector and component) stand
by falling quantised impact, its segments. A query reads segments by falling |query component| x impact, over all
dimensions, and adds exact contributions to its accumulators. What a vector has still to come is at most the query's
norm times the norm of the vector's unread components, and at most their number times what the last segment read was
worth, so accumulator and slack bound its score on both sides. A vector
whose upper bound is under the k-th lower bound is proven out. A query stops as soon as rescoring all others costs no
more than reading on; these possible members are rescored exactly, in 64-bit integers.

Query blocks meet vector blocks by an equi-join on the block number; each pair of blocks is one bounded piece of
work, and only k rows a query leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantised(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))


def usable(vector: Column) -> Column:
    """Not null or empty, no null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


class ImpactIndex:
    """Postings of a block by dimension and falling quantised impact."""

    def __init__(self, data: np.ndarray, levels: int = 255):
        self.data, (self.n, self.dim) = data, data.shape
        size = np.abs(data)
        self.top = max(1, int(size.max(initial=0)))
        level = -(-size * levels // self.top)  # a component is at most level * top / levels
        at = np.flatnonzero(level.ravel(order="F"))
        dim = at // self.n
        order = np.argsort(dim * (levels + 1) + levels - level.ravel(order="F")[at], kind="stable")
        at, dim = at[order], dim[order]
        self.owner = (at % self.n).astype(np.int32)
        self.value = data.ravel(order="F")[at].astype(np.float64)
        self.square = self.value**2
        self.first = np.searchsorted(dim, np.arange(self.dim + 1))
        self.segments = np.bincount(dim * (levels + 1) + level.ravel(order="F")[at], minlength=self.dim * (levels + 1)).reshape(self.dim, levels + 1)
        self.above = np.append(np.cumsum(self.segments[:, ::-1], axis=1)[:, ::-1], np.zeros((self.dim, 1), np.int64), axis=1)  # postings of a level or more
        self.unit = self.top / levels
        self.filled = np.bincount(self.owner, minlength=self.n)
        self.norm2 = (data.astype(np.float64) ** 2).sum(axis=1)
        self.exact = data.astype(np.int64)

    def members(self, query: np.ndarray, own: np.ndarray, k: int, steps: tuple[float, ...] = (0.25, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)) -> tuple[np.ndarray, int]:
        """The vectors that may be among the k best, proven, and how many postings were read; ``own`` rows don't count.

        ``steps``: the shares of the postings after which the bounds are looked at.
        """
        q = np.abs(query).astype(np.float64)
        worth = q[:, None] * np.arange(self.segments.shape[1])
        order = np.argsort(-worth, axis=None)
        read_by, total = np.cumsum(self.segments.ravel()[order]), len(self.value)
        acc, left, unread = np.zeros(self.n), self.norm2.copy(), self.filled.copy()
        at, norm, others = self.first[:-1].copy(), np.sqrt((q**2).sum()), np.setdiff1d(np.arange(self.n), own)
        if len(others) <= k:
            return others, 0
        for s in steps:
            least = worth.ravel()[order[np.searchsorted(read_by, s * total)]] if total else 0
            if least <= 0:
                break
            # Of each dimension the segments of this worth or more, which stand first.
            enough = worth >= least
            level = np.where(enough.any(axis=1), enough.argmax(axis=1), worth.shape[1])
            end = self.first[:-1] + self.above[np.arange(self.dim), level]
            new = [slice(a, b) for a, b in zip(at, end, strict=True)]
            who = np.concatenate([self.owner[x] for x in new])
            acc += np.bincount(who, np.concatenate([query[d] * self.value[x] for d, x in enumerate(new)]), self.n)
            left -= np.bincount(who, np.concatenate([self.square[x] for x in new]), self.n)
            unread -= np.bincount(who, minlength=self.n)
            at = end
            slack = np.minimum(norm * np.sqrt(np.maximum(left, 0)), unread * (least * self.unit)) * (1 + 1e-9) + 1e-6 * (1 + np.abs(acc))
            low = (acc - slack)[others]
            may = others[(acc + slack)[others] >= np.partition(low, len(low) - k)[len(low) - k]]
            read = int((at - self.first[:-1]).sum())
            if len(may) * self.dim <= total - read:
                return may, read
        return others, total

    def best(self, query: np.ndarray, ids: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, postings read) of the query's k best, ties to the smaller id, never itself."""
        may, read = self.members(query, np.flatnonzero(ids == query_id), k)
        score = self.exact[may] @ query.astype(np.int64)
        order = np.lexsort((ids[may], -score))[:k]
        return ids[may][order], score[order], read


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matrix(x: pa.Scalar, dim: int) -> np.ndarray:
            return x.values.to_numpy(zero_copy_only=False).reshape(-1, dim)

        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                q_ids, ids = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("q_ids", "ids"))
                queries, data = matrix(batch.column("q_data")[i], dim), matrix(batch.column("data")[i], dim)
                index = ImpactIndex(data)
                out = [(np.full(len(s), q), got, s) for q, (got, s, _) in zip(q_ids, (index.best(x, ids, q, k) for q, x in zip(q_ids, queries, strict=True)), strict=True)]
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return run


def _blocks(rows: DataFrame, components: int, prefix: str) -> DataFrame:
    """Rows of one dimension gathered into blocks of about so many components: dim, block, ids and flat components."""
    n = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) * F.col("dim") / F.lit(components)).alias("blocks"))
    cut = rows.join(n, "dim").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    held = cut.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    return held.select("dim", "block", F.transform("rows", lambda r: r["id"]).alias(f"{prefix}ids"), F.flatten(F.transform("rows", lambda r: r["v"])).alias(f"{prefix}data"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, vector: str = "embedding", vec_id: str = "vec_id", block: int = 1 << 20, query_block: int = 1 << 16) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k largest integer inner products, all if there are fewer.

    Vectors that are null, empty or hold a null or non-finite component take no part, nor do rows with a null id;
    vectors of another length than the query's aren't its candidates. Ties go to the smaller id; a query isn't its
    own candidate. Rows that repeat an id and vector count once. Extra columns are left out; an empty table gives an
    empty one.
    """

    def ints(df: DataFrame) -> DataFrame:
        two = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
        return two.select("id", quantised(F.col("v"), scale).alias("v")).dropDuplicates(["id", "v"]).withColumn("dim", F.size("v"))

    data = _blocks(ints(vectors), block, "")
    asked = _blocks(ints(queries), query_block, "q_")
    pairs = data.withColumnRenamed("block", "d_block").join(asked.withColumnRenamed("block", "q_block"), "dim")
    pairs = pairs.select("dim", "ids", "data", "q_ids", "q_data").repartition("dim", F.hash("ids"), F.hash("q_ids"))
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long").dropDuplicates()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
